"""Alignment of two tokenizers: corpus counts of id pairs by minimal perfect hashing.

Byte offsets where tokens of both end cut a text (a space in front) into groups; all A-B pairs of one group are linked.  Both always end at a
space that follows another character and precedes one that isn't white space, so texts are cut there into chunks, and a task encodes and aligns
each chunk that it meets once.  Pairs are taken as distinct pairs with their number of links, so a long group needs no more room than these.

1. First pass: documents are dealt into blocks (of BLOCK characters, in reading order).  A block's distinct pairs, each with the number of its documents
   that hold it, are written next to its documents, which are kept as the ids of both tokenizers.
2. The distinct pairs of the corpus fall by hash into buckets of about BUCKET keys, and each bucket gets a minimal perfect hash with its keys
   in hash order.
3. Counts are dense vectors indexed by the hash: a task adds up a share of the blocks for a bucket, the vectors of a bucket are summed in
   a second level.  Every looked-up key is verified against the key in its place.
4. Blocks ask the buckets for the counts of their pairs; second pass: documents meet the answers of their block, are aligned again from their ids and
   look their links up.

Nothing grows on the driver but the highest count per A id, bounded by A's vocabulary, which travels with the tasks.  All shuffles are by hashed
buckets, salted, or by blocks of bounded size, so no frequent pair or long group of copies meets in one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.minimal_hash import MinimalHash
from tallyloom.llm.sentence_pieces import MARK, MODEL, Segmenter, model_bytes, strings
from tallyloom.llm.storage import shared_folder, small_batches, stored
from tallyloom.llm.textnp import mix

BYTE_LEVEL = os.environ.get("BYTE_TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.json")
BLOCK = 8_000_000  # characters of a block at most (or one longer document)
SLICE, BUNDLE = 500_000, 512  # characters and documents that are aligned together at most (or one longer document)
BUCKET, SALTS = 4096, 16
LINKS, WIDE = 1 << 20, 4096  # links spread at a time; links of a group from which its distinct pairs are taken
KEPT = 500_000  # chunks that a task keeps aligned
# A's words begin with the space before them, and no piece of B has the mark after another character
CUT = re.compile(rf"(?<=[^ {MARK}])(?= \S)")
LINE = re.compile(rf" [^\s{MARK}](?:[^{MARK}]*[^ {MARK}])?", re.S).fullmatch  # chunks that can stand in one line
PACKED = "u4"  # ids as they are stored, before compression
LOW = 1 << 20  # a pair's key is A's id times this plus B's id


def byte_tokens(byte_level: str) -> tuple[dict[bytes, int], str | None]:
    """Bytes of the tokens of a byte-level file with their ids, and None, or why ids can't serve as merge ranks.

    If ids rise with the merges, and every token comes out whole when its bytes are merged by the listed pairs, then merging by rank of the
    joined bytes gives the same ids as merging by listed pairs: up to the first merge of another pair both go alike, and inside
    the bytes of that pair alone as well, so the pair would be the listed one.
    """
    model = json.loads(byte_level)["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(printable)))}
    tokens = {bytes(letter[c] for c in name): i for name, i in model["vocab"].items()}
    said = {i: t for t, i in tokens.items()}
    rank: dict[tuple[int, int], int] = {}
    for pair in model["merges"]:
        left, right = (model["vocab"][x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
        rank[left, right] = tokens[said[left] + said[right]]
    if list(rank.values()) != sorted(rank.values()):
        return tokens, "ids don't rise with the merges"
    for token, i in tokens.items():
        ids = [tokens[bytes([b])] for b in token]
        while len(ids) > 1:
            best, k = min((rank.get(pair, len(tokens)), k) for k, pair in enumerate(zip(ids, ids[1:])))
            if best == len(tokens):
                return tokens, f"token {i} isn't merged from its bytes"
            ids[k:k + 2] = [best]
    return tokens, None


class Tokenizers:
    """Both tokenizers with the bytes of their tokens; made inside a task.  ``tokens``: of ``byte_tokens``."""
    # words of a byte-level file: fixed by its kind
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, tokens: dict[bytes, int], pieces: bytes):
        import tiktoken
        self.a = tiktoken.Encoding("a", pat_str=self.WORDS, mergeable_ranks=tokens, special_tokens={})
        self.b = Segmenter(pieces).library
        self.bytes_a = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.bytes_a[i] = token
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(MARK, " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.length_a, self.length_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids under A and B of a text that begins with its space; None if a tokenizer doesn't give the bytes back."""
        a, b = self.a.encode_ordinary(text), self.b.encode(text[1:])
        data = text.encode()
        return (a, b) if b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b]) else None

    def encode_all(self, chunks: list[str]) -> tuple[list[str], np.ndarray, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The chunks in a new order, whether each is given back, and for A and B the ids of all and how many each has.

        Chunks that can stand in one line are encoded as one text, whose ids then fall to them by their ends; the others alone.
        """
        line, others = [c for c in chunks if LINE(c)], [c for c in chunks if not LINE(c)]
        whole = self.encode("".join(line)) if line else ([], [])
        if whole is None:
            line, others, whole = [], chunks, ([], [])
        ends = np.cumsum([len(c.encode()) for c in line])
        ids, counts = [], []
        for found, length in zip(whole, (self.length_a, self.length_b)):
            found = np.array(found, np.int64)
            ids.append([found])
            counts.append(np.diff(np.searchsorted(np.cumsum(length[found]), ends, side="right"), prepend=0).tolist())
        given = [True] * len(line)
        for c in others:
            found = self.encode(c)
            given.append(found is not None)
            for side, x in enumerate(found or ([], [])):
                ids[side].append(np.array(x, np.int64))
                counts[side].append(len(x))
        a, b = ((np.concatenate(i), np.array(n, np.int64)) for i, n in zip(ids, counts))
        return line + others, np.array(given, bool), a, b


class Aligned:
    """The groups of several texts; ``a`` and ``b``: all their ids one after another, and how many each text has.

    All texts lie in one line of bytes: as both tokenizers end where a text ends, groups never cross texts.
    """

    def __init__(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], tokenizers: Tokenizers):
        (self.a, self.n_a), (self.b, self.n_b) = a, b
        ends_a, ends_b = np.cumsum(tokenizers.length_a[self.a]), np.cumsum(tokenizers.length_b[self.b])
        same = np.searchsorted(ends_b, ends_a)
        self.last_a = ends_b[same] == ends_a  # tokens that close a group
        self.last_b = np.zeros(len(self.b), bool)
        self.last_b[same[self.last_a]] = True
        self.group_a, self.group_b = (np.cumsum(last) - last for last in (self.last_a, self.last_b))
        groups = int(self.last_a.sum())
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.start_a, self.start_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        self.links = self.size_a * self.size_b
        self.document = np.repeat(np.arange(len(self.n_a)), self.n_a)[self.last_a]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """document, key, times of all links, about LINKS at a time; a long group's pairs are distinct, with their number of links."""
        wide = self.links > WIDE
        for g in np.flatnonzero(wide):
            a, times_a = np.unique(self.a[self.start_a[g]:self.start_a[g] + self.size_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.start_b[g]:self.start_b[g] + self.size_b[g]], return_counts=True)
            step = max(1, LINKS // len(b))
            for k in range(0, len(a), step):
                keys = (a[k:k + step, None] * LOW + b).ravel()
                yield np.full(len(keys), self.document[g]), keys, np.outer(times_a[k:k + step], times_b).ravel()
        links = np.where(wide, 0, self.links)
        ends = np.cumsum(links)
        at = 0
        while at < len(links):
            before = ends[at] - links[at]
            to = max(at + 1, int(np.searchsorted(ends, before + LINKS, side="right")))
            number = np.repeat(np.arange(at, to), links[at:to])
            step = np.arange(len(number)) - (ends[number] - links[number] - before)
            i, j = np.divmod(step, self.size_b[number])
            yield self.document[number], self.a[self.start_a[number] + i] * LOW + self.b[self.start_b[number] + j], np.ones(len(number), np.int64)
            at = to

    def said(self, names: np.ndarray, of_b: int) -> list[str]:
        """The groups of each document as text; ``names``: each id with either mark after it, B's from ``of_b`` on."""
        # a token stands after all tokens of both kinds of earlier groups, B's after A's of the same group
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[np.arange(len(self.a)) + self.start_b[self.group_a]] = 2 * self.a + self.last_a
        out[np.arange(len(self.b)) + (self.start_a + self.size_a)[self.group_b]] = of_b + 2 * self.b + self.last_b
        words = names[out].tolist()
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(words[s:e])[:-1] for s, e in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist())]


def names(tokenizers: Tokenizers) -> tuple[np.ndarray, int]:
    size_a, size_b = len(tokenizers.bytes_a), len(tokenizers.bytes_b)
    said = [f"{i}{mark}" for i in range(size_a) for mark in ",|"] + [f"{i}{mark}" for i in range(size_b) for mark in ",;"]
    return np.array(said, object), 2 * size_a


def summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their ``times``."""
    keys, times = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times[order], first)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Chunks:
    """Distinct chunks that a task has met: their ids and distinct pairs.

    Both tokenizers end a token at every CUT, so a chunk is encoded and aligned alone, once while it is kept, and a text's ids are those of its
    chunks.
    """
    NAMES = ("n_a", "start_a", "n_b", "start_b", "size", "start")

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.given = np.zeros(0, bool)
        self.columns = {name: np.zeros(0, np.int64) for name in self.NAMES}
        self.a, self.b, self.keys = (np.zeros(0, np.int64) for _ in range(3))

    def _learn(self, new: list[str]) -> None:
        new, given, a, b = self.tokenizers.encode_all(new)
        keys = [np.unique(of * (1 << 40) + key) for of, key, _ in Aligned(a, b, self.tokenizers).pairs()]
        keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        size = np.bincount(keys >> 40, minlength=len(new))
        columns = []
        for n, before in ((a[1], self.a), (b[1], self.b), (size, self.keys)):
            columns += [n, len(before) + np.cumsum(n) - n]
        self.columns = {name: np.concatenate((self.columns[name], x)) for name, x in zip(self.NAMES, columns)}
        self.given = np.concatenate((self.given, given))
        self.a, self.b = np.concatenate((self.a, a[0])), np.concatenate((self.b, b[0]))
        self.keys = np.concatenate((self.keys, keys & ((1 << 40) - 1)))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the chunks of each text; none for a text without tokens.  They hold until the next call."""
        parts = [CUT.split(" " + t) if t else [] for t in texts]
        if len(self.number) > KEPT:
            self.clear()
        known = self.number
        new = set().union(*parts) - known.keys()
        if new:
            self._learn(list(new))
        out = [np.array([known[p] for p in found], np.int64) for found in parts]
        return [x if self.given[x].all() else x[:0] for x in out]

    def ids(self, many: list[np.ndarray]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For A and B, the ids of texts given as chunk numbers, and how many each has."""
        number, out = np.concatenate(many), []
        ends = np.cumsum(list(map(len, many)))
        for side, ids in (("a", self.a), ("b", self.b)):
            n = self.columns[f"n_{side}"][number]
            so_far = np.concatenate(([0], np.cumsum(n)))[ends]
            out.append((ids[spread(self.columns[f"start_{side}"][number], n)], np.diff(so_far, prepend=0)))
        return tuple(out)


def _hashed(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys) % np.uint64(buckets)).astype(np.int32)


def _binary(values: np.ndarray) -> bytes:
    return values.tobytes()


FIRST = "block bigint, doc_ids array<bigint>, sizes_a array<int>, sizes_b array<int>, ids binary, keys binary, times binary"
SCHEMA = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes_a", pa.list_(pa.int32())), ("sizes_b", pa.list_(pa.int32())),
                    ("ids", pa.binary()), ("keys", pa.binary()), ("times", pa.binary())])


class _Block:
    """Counts of the distinct pairs of the documents of a block."""

    def __init__(self):
        self.size = self.rows = 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, chunks: Chunks, many: list[np.ndarray]) -> None:
        once = [np.unique(x) for x in many]
        number, document = np.concatenate(once), np.repeat(np.arange(len(once)), list(map(len, once)))
        size = chunks.columns["size"][number]
        keys = np.unique((np.repeat(document, size) << 40) + chunks.keys[spread(chunks.columns["start"][number], size)])
        keys, times = np.unique(keys & ((1 << 40) - 1), return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        if sum(map(len, self.keys)) > 4 * LINKS:
            self.keys, self.times = ([x] for x in summed(self.keys, self.times))

    def row(self, number: int) -> pa.RecordBatch:
        keys, times = summed(self.keys, self.times)
        return pa.RecordBatch.from_pylist([{"block": number, "keys": keys.tobytes(), "times": times.tobytes()}], schema=SCHEMA)


def first_pass(docs: DataFrame, tokenizers: Callable[[], Tokenizers]) -> DataFrame:
    """Rows of bundles of documents (block, doc_ids, sizes_a, sizes_b, ids of both compressed), and rows of blocks (block, keys, times: documents of
    the block that hold each)."""
    def run(batches):
        chunks, block, number = Chunks(tokenizers()), _Block(), None
        packing = pa.Codec("zstd", 3)
        for batch in batches:
            if number is None and batch.num_rows:
                number = batch.column("rid")[0].as_py()  # the task's first row number; a task has no more blocks than rows
            texts, ids = strings(batch, "text"), batch.column("doc_id").to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE) and to - at < BUNDLE:
                    size, to = size + len(texts[to]), to + 1
                if block.rows and block.size + size > BLOCK:
                    yield block.row(number)
                    block, number = _Block(), number + 1
                block.size, block.rows = block.size + size, block.rows + to - at
                many = chunks(texts[at:to])
                block.add(chunks, many)
                (a, n_a), (b, n_b) = chunks.ids(many)
                packed = np.concatenate((a, b)).astype(PACKED).tobytes()
                yield pa.RecordBatch.from_pylist([{"block": number, "doc_ids": ids[at:to], "sizes_a": n_a.tolist(), "sizes_b": n_b.tolist(),
                                                   "ids": packing.compress(packed, asbytes=True) if packed else b""}], schema=SCHEMA)
                at = to
        if block.rows:
            yield block.row(number)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, FIRST)


def requests(blocks: DataFrame, buckets: int) -> DataFrame:
    """bucket, salt, block, keys, times: the pairs of each block, by bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("salt", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("times", pa.binary())])

    def run(batches):
        for batch in batches:
            for block, keys, times in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "times"))):
                keys, times = np.frombuffer(keys, np.uint64), np.frombuffer(times, np.int64)
                bucket = _hashed(keys, buckets)
                order = np.argsort(bucket, kind="stable")
                keys, times, bucket = keys[order], times[order], bucket[order]
                first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
                last = np.concatenate((first[1:], [len(bucket)])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[first]), pa.array([block % SALTS] * len(first), pa.int32()), pa.array([block] * len(first), pa.int64()),
                     pa.array([_binary(keys[s:e]) for s, e in zip(first, last)], pa.binary()), pa.array([_binary(times[s:e]) for s, e in zip(first, last)], pa.binary())], schema=schema)
    return blocks.mapInArrow(run, "bucket int, salt int, block bigint, keys binary, times binary")


def hashes(blocks: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """bucket, hash, keys (in hash order) of the distinct pairs, and the number of buckets."""
    def run(batches):
        for batch in batches:
            for keys in batch.column("keys").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64))], names=["key"])
    distinct = stored(blocks.select("keys").mapInArrow(run, "key bigint").distinct(), f"{folder}/keys")
    buckets = max(1, -(-distinct.count() // BUCKET))

    def dealt(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_hashed(keys.view(np.uint64), buckets)), batch.column("key")], names=["bucket", "key"])

    def built(batches):
        def one(bucket, held):
            keys = np.concatenate(held).astype(np.int64).view(np.uint64)
            found = MinimalHash.of(keys)
            ordered = np.empty_like(keys)
            ordered[found(keys)] = keys
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([found.packed()], pa.binary()), pa.array([_binary(ordered)], pa.binary())],
                                              names=["bucket", "hash", "keys"])
        now, held = None, []
        for batch in batches:
            bucket, keys = batch.column("bucket").to_numpy(), batch.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(bucket)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if held and bucket[s] != now:
                    yield one(now, held)
                    held = []
                now = bucket[s]
                held.append(keys[s:e])
        if held:
            yield one(now, held)
    by_bucket = distinct.mapInArrow(dealt, "bucket int, key bigint").repartition("bucket").sortWithinPartitions("bucket")
    return stored(by_bucket.mapInArrow(built, "bucket int, hash binary, keys binary"), f"{folder}/hashes"), buckets


def met(tables: DataFrame, asked: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Runs over the rows of ``asked`` with the row of their bucket (copied to every salt) in front of them."""
    salted = tables.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("block", F.lit(None).cast("bigint"))
    return (salted.unionByName(asked, allowMissingColumns=True).repartition("bucket", "salt")
            .sortWithinPartitions("bucket", "salt", F.col("block").asc_nulls_first()).mapInArrow(run, schema))


def _placed(hash_, keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places of keys, each verified."""
    at = hash_(asked)
    if (at < 0).any() or (keys[at] != asked).any():
        raise ValueError("a pair is not under its hash")
    return at


def counted(tables: DataFrame, asked: DataFrame, folder: str) -> DataFrame:
    """bucket, hash, keys, counts (documents per pair, in hash order)."""
    def vectors(batches):
        now, hash_, keys, dense = None, None, None, None

        def sent():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_binary(dense)], pa.binary())], names=["bucket", "counts"])
        for batch in batches:
            for bucket, data, k, times in zip(*(batch.column(c).to_pylist() for c in ("bucket", "hash", "keys", "times"))):
                if data is not None:
                    if dense is not None and dense.any():
                        yield sent()
                    now, hash_, keys = bucket, MinimalHash.unpacked(data), np.frombuffer(k, np.uint64)
                    dense = np.zeros(len(keys), np.int64)
                else:
                    dense[_placed(hash_, keys, np.frombuffer(k, np.uint64))] += np.frombuffer(times, np.int64)
        if dense is not None and dense.any():
            yield sent()

    def added(batches):
        now, total = None, None
        for batch in batches:
            for bucket, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "counts"))):
                if total is not None and bucket != now:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_binary(total)], pa.binary())], names=["bucket", "counts"])
                    total = None
                counts = np.frombuffer(counts, np.int64)
                now, total = bucket, counts.copy() if total is None else total + counts
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_binary(total)], pa.binary())], names=["bucket", "counts"])
    parts = met(tables, asked, vectors, "bucket int, counts binary")
    sums = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(added, "bucket int, counts binary")
    return stored(tables.join(sums, "bucket"), f"{folder}/counts")


def answers(tables: DataFrame, asked: DataFrame) -> DataFrame:
    """block, keys, counts: what each block asked for."""
    def run(batches):
        hash_ = keys = counts = None
        for batch in batches:
            blocks, asked_keys, said = [], [], []
            for data, k, c, block in zip(*(batch.column(c).to_pylist() for c in ("hash", "keys", "counts", "block"))):
                if data is not None:
                    hash_, keys, counts = MinimalHash.unpacked(data), np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
                else:
                    blocks.append(block)
                    asked_keys.append(k)
                    said.append(_binary(counts[_placed(hash_, keys, np.frombuffer(k, np.uint64))]))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(asked_keys, pa.binary()), pa.array(said, pa.binary())], names=["block", "keys", "counts"])
    return met(tables, asked.drop("times"), run, "block bigint, keys binary, counts binary")


def best_of(tables: DataFrame) -> dict[int, int]:
    """The highest count of each A id: at most one entry per id of A's vocabulary."""
    def run(batches):
        best: dict[int, int] = {}
        for batch in batches:
            for keys, counts in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts"))):
                a, n = (np.frombuffer(keys, np.uint64) // np.uint64(LOW)).astype(np.int64), np.frombuffer(counts, np.int64)
                order = np.lexsort((n, a))
                a, n = a[order], n[order]
                last = np.flatnonzero(np.concatenate((a[1:] != a[:-1], [True]))) if len(a) else []
                for i, m in zip(a[last].tolist(), n[last].tolist()):
                    best[i] = max(best.get(i, 0), m)
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(best.values(), pa.int64())], names=["a", "best"])
    return {r.a: r.best for r in tables.mapInArrow(run, "a bigint, best bigint").groupBy("a").agg(F.max("best").alias("best")).collect()}


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def second_pass(rows: DataFrame, replies: DataFrame, best: np.ndarray, tokenizers: Callable[[], Tokenizers]) -> DataFrame:
    """RESULT of the documents: aligned again, their links looked up among the answers of their block."""
    def run(batches):
        both, now, held, answer = tokenizers(), None, [], None
        said = names(both)
        for batch in batches:
            columns = ("block", "kind", "doc_ids", "sizes_a", "sizes_b", "ids", "keys", "counts")
            for block, kind, ids, sizes_a, sizes_b, data, keys, counts in zip(*(batch.column(c).to_pylist() for c in columns)):
                if block != now:
                    now, held, answer = block, [], None
                if kind == 0:
                    held.append((np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)))
                    continue
                if answer is None:
                    asked, times = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in (0, 1))
                    order = np.argsort(asked)
                    answer, held = (asked[order], times[order]), []
                total_a = sum(sizes_a)
                room = (total_a + sum(sizes_b)) * np.dtype(PACKED).itemsize
                found = np.frombuffer(pa.decompress(data, room, "zstd", asbytes=True) if room else b"", PACKED).astype(np.int64)
                aligned = Aligned((found[:total_a], np.array(sizes_a, np.int64)), (found[total_a:], np.array(sizes_b, np.int64)), both)
                n = len(ids)
                links, n_best, total = (np.zeros(n, np.int64) for _ in range(3))
                for document, key, times in aligned.pairs():
                    at = np.searchsorted(answer[0], key)
                    if (answer[0][np.minimum(at, len(answer[0]) - 1)] != key).any():
                        raise ValueError("a pair without an answer")
                    count = answer[1][at]
                    np.add.at(total, document, count * times)
                    np.add.at(n_best, document, np.where(count == best[key // LOW], times, 0))
                np.add.at(links, aligned.document, aligned.links)
                groups = np.bincount(aligned.document, minlength=n)
                sums = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligned.said(*said)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (aligned.n_a, aligned.n_b, groups, links, n_best, total)), pa.array(sums, pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    both_kinds = (rows.select("block", F.lit(1).alias("kind"), "doc_ids", "sizes_a", "sizes_b", "ids")
                  .unionByName(replies.withColumn("kind", F.lit(0)), allowMissingColumns=True))
    return both_kinds.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, RESULT)


def alignments(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = MODEL) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row per row of ``docs``.

    Null and empty texts, and texts that either tokenizer doesn't give back byte for byte, have no tokens: zeros and ''.  Repeated rows count as
    documents of their own; an empty table gives an empty one; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = shared_folder(spark)
    with open(byte_level, encoding="utf-8") as f:
        tokens, wrong = byte_tokens(f.read())
    if wrong:
        raise ValueError(f"{byte_level}: {wrong}")
    model = model_bytes(pieces)

    def tokenizers():
        return Tokenizers(tokens, model)
    rows = stored(first_pass(docs, tokenizers), f"{folder}/rows")
    blocks = rows.filter("keys is not null").select("block", "keys", "times")
    tables, buckets = hashes(blocks, folder)
    asked = requests(blocks, buckets)
    tables = counted(tables, asked, folder)
    best = np.zeros(LOW, np.int64)
    for token, n in best_of(tables).items():
        best[token] = n
    return second_pass(rows.filter("keys is null"), answers(tables, asked), best[:len(np.trim_zeros(best, "b")) + 1], tokenizers)
