"""Sentence-piece encoding and decoding by a table of distinct chunks.

With the word mark put for spaces (and one in front), a text falls into chunks: a run of marks, or a line break, and what follows it up to the next one.
No piece of the vocabulary has a mark after another character or a line break beside one (checked when the model is loaded), so no
merge crosses a chunk's border and the pieces of a text are the pieces of its chunks one after another.

1. Documents fall into blocks of BLOCK_ROWS rows of a file.  A block sends its distinct chunks, sorted and compressed, to the buckets they belong to by hash.
2. A bucket segments each distinct chunk once, however many blocks ask for it, and answers every block with the ids.
3. Documents meet the answers of their block, and their ids are put together by position.

So texts and answers are shuffled once, compressed, by blocks of even size, and chunks by hash; a frequent chunk is one entry of a block.

Decoding is the library's own on the ids so put together.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import located, shared_folder, small_batches

MODEL = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
CHUNK = re.compile(f"(?:{MARK}+|\n)[^{MARK}\n]*")
BLOCK_ROWS = 8192  # rows of a file that form a block
BUNDLE, BUNDLE_SIZE = 256, 500_000  # documents and characters that travel as one row at most (or one longer document)
LEVEL = 6  # of compression


def chunks(text: str) -> list[str]:
    """The chunks of a text, the mark in front included; the empty text has none."""
    return CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


class Segmenter:
    """Ids of chunks by the library; made inside a task from the model's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)

    def check(self) -> Segmenter:
        """Raise unless chunks can be segmented alone under this model."""
        lib = self.library
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        crossing = [n for n in names if MARK in n.lstrip(MARK) or "\n" in n]
        probe = "ﬁ  Å x\t "
        if crossing or "".join(lib.encode(probe, out_type=str)).replace("<0x09>", "\t") != MARK + probe.replace(" ", MARK) or len(names) > 1 << 16:
            raise ValueError("pieces that cross the mark, or a model that rewrites its input, need whole-text encoding")
        return self

    def ids(self, many: list[str]) -> list[np.ndarray]:
        """Ids of each chunk as unsigned 16-bit numbers."""
        # the library puts a mark in front of what it encodes: take one away, or drop its id before a line break; it encodes nothing as nothing
        mark = self.library.encode("\n")[:1]
        found = self.library.encode([c.replace(MARK, " ")[1:] if c[0] == MARK else c for c in many], num_threads=1)
        return [np.array(mark if c == MARK else f if c[0] == MARK else f[1:], np.uint16) for c, f in zip(many, found)]


def model_bytes(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        model = f.read()
    Segmenter(model).check()
    return model


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """A string column, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def _bucket(chunk: str, buckets: int) -> int:
    return zlib.crc32(chunk.encode()) % buckets


def _packed(parts: list[bytes]) -> dict:
    """Byte strings as one compressed value with their sizes."""
    data = b"".join(parts)
    return {"sizes": list(map(len, parts)), "data": pa.Codec("zstd", LEVEL).compress(data, asbytes=True) if data else b""}


def _unpacked(sizes: list[int], data: bytes) -> list[bytes]:
    size = sum(sizes)
    whole, at, out = pa.decompress(data, size, "zstd", asbytes=True) if size else b"", 0, []
    for n in sizes:
        out.append(whole[at:at + n])
        at += n
    return out


ASKED = pa.schema([("bucket", pa.int32()), ("file", pa.int64()), ("block", pa.int64()), ("sizes", pa.list_(pa.int32())), ("data", pa.binary())])


def asked(rows: DataFrame, buckets: int) -> DataFrame:
    """bucket, file, block, and the packed distinct chunks of the block in that bucket."""
    def run(batches):
        now, held = None, set()

        def sent():
            parts: dict[int, list[str]] = {}
            for chunk in sorted(held):
                parts.setdefault(_bucket(chunk, buckets), []).append(chunk)
            return pa.RecordBatch.from_pylist([{"bucket": k, "file": now[0], "block": now[1], **_packed([c.encode() for c in part])} for k, part in parts.items()], schema=ASKED)
        for batch in batches:
            for file, block, text in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strings(batch, "text")):
                if (file, block) != now:
                    if held:
                        yield sent()
                    now, held = (file, block), set()
                held.update(chunks(text))
        if held:
            yield sent()
    return rows.select("file", "block", "text").mapInArrow(run, "bucket int, file bigint, block bigint, sizes array<int>, data binary")


ANSWERED = "file bigint, block bigint, sizes array<int>, data binary, ids_sizes array<int>, ids_data binary"


def answered(asked_rows: DataFrame, model: bytes) -> DataFrame:
    """The asked chunks with their ids; every distinct chunk is segmented once, in its bucket."""
    schema = pa.schema([*list(ASKED)[1:], ("ids_sizes", pa.list_(pa.int32())), ("ids_data", pa.binary())])

    def run(batches):
        segmenter, now, known = Segmenter(model), None, {}
        for batch in batches:
            for bucket, file, block, sizes, data in zip(*(batch.column(c).to_pylist() for c in ASKED.names)):
                if bucket != now:
                    now, known = bucket, {}
                found = _unpacked(sizes, data)
                new = [c for c in found if c not in known]
                known.update(zip(new, [i.tobytes() for i in segmenter.ids([c.decode() for c in new])]))
                ids = _packed([known[c] for c in found])
                yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "sizes": sizes, "data": data, "ids_sizes": ids["sizes"], "ids_data": ids["data"]}], schema=schema)
    return asked_rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ANSWERED)


def bundles(rows: DataFrame) -> DataFrame:
    """file, block, doc_ids, and the packed texts of some neighbouring documents of a block."""
    schema = pa.schema([*list(ASKED)[1:], ("doc_ids", pa.list_(pa.int64()))])

    def run(batches):
        now, ids, texts, size = None, [], [], 0

        def sent():
            return pa.RecordBatch.from_pylist([{"file": now[0], "block": now[1], "doc_ids": ids, **_packed(texts)}], schema=schema)
        for batch in batches:
            for file, block, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "doc_id")), strings(batch, "text")):
                if ids and ((file, block) != now or len(ids) >= BUNDLE or size + len(text) > BUNDLE_SIZE):
                    yield sent()
                    ids, texts, size = [], [], 0
                now, size = (file, block), size + len(text)
                ids.append(doc_id)
                texts.append(text.encode())
        if ids:
            yield sent()
    return rows.mapInArrow(run, "file bigint, block bigint, sizes array<int>, data binary, doc_ids array<bigint>")


def encoded(docs: DataFrame, model: bytes, folder: str, buckets: int | None = None) -> DataFrame:
    """doc_id, ids (packed 16-bit numbers of the whole text); one row per row of ``docs``.

    ``buckets`` grows with the root of the number of rows, as distinct words do.
    """
    located_rows = located(docs, folder)
    # a file is known by the hash of its path; files that share it share blocks, which costs nothing but room
    rows = located_rows.select(F.xxhash64("file").alias("file"), F.floor(F.col("at") / BLOCK_ROWS).cast("bigint").alias("block"),
                               F.col("row.doc_id").cast("bigint").alias("doc_id"), F.col("row.text").cast("string").alias("text"))
    answers = answered(asked(rows, buckets or 16 + math.isqrt(docs.count()) // 8), model)

    def run(batches):
        now, known = None, {}
        for batch in batches:
            for file, block, sizes, data, ids_sizes, ids_data, doc_ids in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "sizes", "data", "ids_sizes", "ids_data", "doc_ids"))):
                if (file, block) != now:
                    now, known = (file, block), {}
                if doc_ids is None:
                    known.update(zip([c.decode() for c in _unpacked(sizes, data)], _unpacked(ids_sizes, ids_data)))
                else:
                    ids = [b"".join([known[c] for c in chunks(t.decode())]) for t in _unpacked(sizes, data)]
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    both = answers.unionByName(bundles(rows), allowMissingColumns=True)
    return both.repartition("file", "block").sortWithinPartitions("file", "block", F.size("doc_ids").asc_nulls_first()).mapInArrow(run, "doc_id bigint, ids binary")


def decoded(ids: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids and text: what the library decodes the ids to."""
    def run(batches):
        library = Segmenter(model).library
        for batch in batches:
            many = [np.frombuffer(i, np.uint16).tolist() for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(library.decode(many, num_threads=1) if many else [], pa.string())],
                                             names=["doc_id", "ids", "text"])
    return ids.mapInArrow(run, "doc_id bigint, ids binary, text string")


def pieces_and_back(docs: DataFrame, path: str = MODEL, buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (packed 16-bit numbers), text (decoded from them); one row per row of ``docs``.

    Null and empty texts have no ids and decode to the empty text; repeated ids and rows stay as they are; an empty table gives an
    empty one; other columns of ``docs`` are not looked at.
    """
    small_batches(docs.sparkSession)
    model = model_bytes(path)
    back = decoded(encoded(docs, model, shared_folder(docs.sparkSession), buckets), model)
    return back.select("doc_id", (F.octet_length("ids") / 2).cast("bigint").alias("n_tokens"), "ids", "text")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256."""
    def run(batches):
        said = [str(k) for k in range(1 << 16)]
        for batch in batches:
            sums = [hashlib.sha256(",".join([said[i] for i in np.frombuffer(ids, np.uint16).tolist()]).encode()).hexdigest() for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(sums, pa.string()), batch.column("decoded_sha256")],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return rows.select("doc_id", "n_tokens", "ids", F.sha2("text", 256).alias("decoded_sha256")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
