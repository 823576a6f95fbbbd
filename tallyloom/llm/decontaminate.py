"""Documents that contain benchmark items, verbatim or reworded.

1. Passages are pairs of neighbouring blocks of BLOCK words; an item longer than PIECE words is searched in pieces.  The terms are the
   words of the benchmark; document frequencies over all documents give their IDF.  Terms of more than COMMON of the documents
   have no weight, unless an item would lose most of its own.
2. A randomised SVD (range finder with one power step, then the small eigenproblem) of the TF-IDF matrix of passages gives RANK latent
   directions.  It is fitted on the passages of the items, which count ITEM_WEIGHT times, and on those of all documents,
   by sums that Spark adds up over tasks; the driver only factors matrices of terms x (RANK + OVERSAMPLE).  The texts are cut into words
   once for it: a table of each document's benchmark words by block serves the document frequencies and both steps.
3. Every passage of every document is projected and compared with every item: a candidate holds at least SHARE of the item's latent
   weight, whatever else is in the passage.  A block, and an item, counts each of its terms once, so repeats add nothing.
4. A candidate is confirmed on words around the passage: the longest common subsequence with the item inside a window of 1.5 times the item
   covers LCS of the item, or covers LCS_ANSWER of it while the answer (the rarest third of the item's last words)
   is there too.

Items come in blocks of at most RANK pieces (or one item), so the directions span the items, and what a task holds is bounded
whatever the benchmark's size.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import textnp
from tallyloom.llm.storage import dropped, shared_folder, small_batches, stored
from tallyloom.llm.sums import SCHEMA, chunked, collected

BLOCK, PIECE, RANK, OVERSAMPLE = 32, 48, 256, 16
COMMON, ITEM_WEIGHT = 0.13, 1e4
SHARE, LCS, LCS_ANSWER, ANSWER = 0.35, 0.75, 0.6, 0.8
TABLE = 1 << 20
GROUP, SLICE, STEPS = 1 << 16, 512, 32  # bytes of text cut into words at once, blocks multiplied at once, longest run of one sum
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where each text's begin (and the last one's end).

    Words are lower-cased, ASCII punctuation is white space.
    """
    plain = [(t if t.isascii() else t.decode("utf-8", "replace").lower().encode()).translate(_PLAIN) for t in texts]
    data = np.frombuffer(b" ".join([*plain, b""]), np.uint8)
    inside = np.zeros(len(data) + 1, bool)
    inside[1:] = data != 32
    bounds = np.flatnonzero(inside[1:] != inside[:-1])
    begins = np.cumsum([0] + [len(t) + 1 for t in plain])
    return textnp.range_hashes(data, bounds[::2], bounds[1::2]), np.searchsorted(bounds[::2], begins)


def words(text: bytes) -> np.ndarray:
    return words_of([text])[0]


def grouped(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, about GROUP bytes at once."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > GROUP:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def sums(right: np.ndarray, index: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` groups the sum of its rows ``right[index]``; ``group`` ascends."""
    out = np.zeros((n, right.shape[1]), right.dtype)
    if not len(index):
        return out
    sizes = np.bincount(group, minlength=n)
    starts = np.cumsum(sizes) - sizes  # of each group's rows
    if sizes.max() > STEPS:  # parts of a long group first
        place = np.arange(len(group)) - starts[group]
        first = place % STEPS == 0
        parts = sums(right, index, np.cumsum(first) - 1, int(first.sum()))
        return sums(parts, np.arange(len(parts)), group[first], n)
    order = np.argsort(-sizes, kind="stable")
    longer = len(sizes) - np.cumsum(np.bincount(sizes))  # groups with more than k rows
    starts, part = starts[order], np.zeros((longer[0], right.shape[1]), right.dtype)
    row = np.empty_like(part)
    for k, m in enumerate(longer[:-1]):
        np.take(right, index[starts[:m] + k], axis=0, out=row[:m], mode="clip")
        part[:m] += row[:m]
    out[order[:longer[0]]] = part
    return out


class Terms:
    """Number of a benchmark word by its hash, -1 for others: a direct-mapped table, exact by comparing full hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.slot = np.full(TABLE, -1, np.int32)
        self.slot[(self.hashes % np.uint64(TABLE)).astype(np.int64)] = np.arange(len(self.hashes))
        own = self.slot[(self.hashes % np.uint64(TABLE)).astype(np.int64)]
        self.late = np.flatnonzero(own != np.arange(len(self.hashes)))  # share a slot with another term

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = self.slot[(h & np.uint64(TABLE - 1)).astype(np.int64)]
        if len(out):
            wrong = np.flatnonzero((out >= 0) & (self.hashes[out] != h))
            out[wrong] = -1
            for k in self.late:
                out[wrong[h[wrong] == self.hashes[k]]] = k
        return out


def lcs(masks: dict, length: int, line) -> int:
    """Longest common subsequence of an item (as bit masks per word) and a line of words, bit-parallel."""
    row = (1 << length) - 1
    for w in line:
        m = masks.get(w)
        if m:
            row = (row + (row & m)) | (row & ~m)
            row &= (1 << length) - 1
    return length - row.bit_count()


class Items:
    def __init__(self, ids: list[int], item_words: list[np.ndarray]):
        self.ids, self.words = ids, item_words
        self.terms = Terms(np.concatenate(item_words))
        self.pieces = [(k, at, min(len(w), at + PIECE)) for k, w in enumerate(item_words) for at in range(0, len(w), PIECE)
                       if at == 0 or len(w) - at >= PIECE // 4]
        self.idf = np.zeros(len(self.terms.hashes))
        self.basis = self.latent = None

    def rows(self, h: np.ndarray, first: np.ndarray, weighed: bool = True):
        """(term numbers, their blocks, number of blocks of each text) of the words of texts, a term once a block."""
        t = self.terms(h)
        at = np.flatnonzero((t >= 0) & (self.idf[t] > 0) if weighed else t >= 0)
        lengths = np.diff(first)
        blocks = -(-lengths // BLOCK)
        text = np.repeat(np.arange(len(lengths)), lengths)[at]
        block = (np.cumsum(blocks) - blocks)[text] + (at - first[text]) // BLOCK
        pairs = np.sort(block * len(self.idf) + t[at])
        pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))] if len(pairs) else pairs
        return pairs % len(self.idf), pairs // len(self.idf), blocks

    def weigh(self, counts: np.ndarray, n: float) -> None:
        """IDF of the terms from the documents that hold them."""
        idf = np.log((n + 1) / (counts + 1)) + 1e-3
        keep = np.where(counts > COMMON * n, 0.0, idf)
        for k, a, b in self.pieces:
            t = self.terms(self.words[k][a:b])
            if (keep[t] ** 2).sum() < 0.2 * (idf[t] ** 2).sum():
                keep[t] = idf[t]
        self.idf = keep

    def own_rows(self, projection: np.ndarray) -> np.ndarray:
        return np.array([projection[np.unique(self.terms(self.words[k][a:b]))].sum(axis=0) for k, a, b in self.pieces])


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    ids, lines, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.filter("item_id is not null and text is not null").orderBy("item_id", "text").toLocalIterator():
        w = words(row.text.encode())
        if not len(w):
            continue
        pieces = -(-len(w) // PIECE)
        if ids and size + pieces > RANK:
            yield Items(ids, lines)
            ids, lines, size = [], [], 0
        ids.append(row.item_id)
        lines.append(w)
        size += pieces
    if ids:
        yield Items(ids, lines)


def _term_blocks(texts: DataFrame, items: Items) -> DataFrame:
    """``terms`` of every text: the term numbers of each block in turn, a term once a block; -1 ends a block."""
    def run(batches):
        for batch in batches:
            values, lengths = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
            for group in grouped(textnp.texts(batch, "text")):
                t, block, blocks = items.rows(*words_of(group), weighed=False)
                found = np.full(len(t) + blocks.sum(), -1, np.int32)
                found[np.arange(len(t)) + block] = t
                ends = np.cumsum(blocks)
                lengths.append(np.diff(np.searchsorted(block, ends) + ends, prepend=0))
                values.append(found)
            offsets = np.cumsum(np.concatenate(lengths)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, np.concatenate(values))], names=["terms"])
    return texts.mapInArrow(run, "terms array<int>")


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The values of ``terms`` of all rows, and the number of values of each row."""
    column = batch.column("terms")
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0]:offsets[-1]].astype(np.int64), np.diff(offsets)


def _document_frequencies(found: DataFrame, terms: int) -> tuple[np.ndarray, float]:
    def run(batches):
        counts, n = np.zeros(terms), 0
        for batch in batches:
            t, lengths = _numbers(batch)
            pairs = np.sort((np.repeat(np.arange(len(lengths)), lengths) * terms + t)[t >= 0])
            counts += np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] % terms, minlength=terms)
            n += len(lengths)
        yield chunked(counts, float(n))
    return collected(found.mapInArrow(run, SCHEMA))


def _fewer_tasks(df: DataFrame) -> DataFrame:
    """For steps where every task hands on a whole matrix: no more tasks than cores, or an eighth of the partitions."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions() // 8))


def _gram_times(found: DataFrame, items: Items, right: np.ndarray) -> np.ndarray:
    """A^T A right, with A the passages of the documents (``_term_blocks``) and the pieces of the items."""
    idf = items.idf
    scaled = (right * idf[:, None]).astype(np.float32)

    def run(batches):
        total = np.zeros(right.shape)
        for batch in batches:
            t, lengths = _numbers(batch)
            end = t < 0
            blocks = np.diff(np.append(0, np.cumsum(end))[np.append(0, np.cumsum(lengths))])
            # an empty block behind every document, so that neighbours are of one document
            block = np.cumsum(end) - end + np.repeat(np.arange(len(lengths)), lengths)
            n = int(blocks.sum()) + len(lengths)
            starts = (np.cumsum(blocks + 1) - blocks - 1)[blocks > 0]
            held = np.full((n, 1), 2, np.float32)  # passages that hold a block: it starts one and ends one
            held[starts] = held[starts + blocks[blocks > 0] - 1] = 1
            keep = np.flatnonzero(~end & (idf[t] > 0))
            t, block = t[keep], block[keep]
            for a in range(0, n, SLICE):
                b, low, high = min(a + SLICE, n), max(a - 1, 0), min(a + SLICE + 1, n)
                i, j, k, m = np.searchsorted(block, [low, a, b, high])
                z = sums(scaled, t[i:m], block[i:m] - low, high - low)
                y = z * held[low:high]
                y[1:] += z[:-1]
                y[:-1] += z[1:]
                order = np.argsort(t[j:k], kind="stable")
                own = t[j:k][order]
                if len(own):
                    new = np.concatenate(([True], own[1:] != own[:-1]))
                    total[own[new]] += sums(y, block[j:k][order] - low, np.cumsum(new) - 1, int(new.sum()))
        yield chunked((total * idf[:, None]).ravel(), 1.0)
    total, _ = collected(_fewer_tasks(found).mapInArrow(run, SCHEMA))
    total = total.reshape(right.shape) if len(total) else np.zeros(right.shape)
    y = items.own_rows(scaled)
    for (k, a, b), row in zip(items.pieces, y):
        t = np.unique(items.terms(items.words[k][a:b]))
        np.add.at(total, t, ITEM_WEIGHT * np.outer(items.idf[t], row))
    return total


def _fit(docs: DataFrame, items: Items) -> None:
    """Sets idf, basis and latent of ``items``."""
    folder = shared_folder(docs.sparkSession)
    rows = stored(_term_blocks(docs.select(F.col("text").cast("string").alias("text")), items), folder)
    counts, n = _document_frequencies(rows, len(items.idf))
    items.weigh(counts if len(counts) else np.zeros(len(items.idf)), n)
    width = min(RANK + OVERSAMPLE, len(items.idf))
    start = np.random.default_rng(3).normal(size=(len(items.idf), width))
    found, _ = np.linalg.qr(_gram_times(rows, items, start))
    small = found.T @ _gram_times(rows, items, found)
    dropped(docs.sparkSession, folder)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    basis = found @ vectors[:, np.argsort(values)[::-1][:RANK]]
    items.basis = (basis * items.idf[:, None]).astype(np.float32)
    items.latent = items.own_rows(items.basis)


class Searcher:
    def __init__(self, items: Items):
        self.items = items
        norm = np.linalg.norm(items.latent, axis=1)
        target = items.latent.T.astype(np.float32)
        # a term's weight in each piece by way of the latent directions, unless one long item has more pieces than there are
        self.right, self.target = (items.basis @ target, None) if target.shape[1] <= RANK else (items.basis, target)
        self.least = (SHARE * norm**2).astype(np.float32)
        self.owner = np.array([k for k, _, _ in items.pieces])
        self.masks, self.answers = [], []
        for w in items.words:
            masks: dict[int, int] = {}
            for k, x in enumerate(w.tolist()):
                masks[x] = masks.get(x, 0) | 1 << k
            self.masks.append(masks)
            tail = w[-max(6, len(w) // 3):]
            rare = np.argsort(-items.idf[items.terms(tail)], kind="stable")[:max(2, len(tail) // 3)]
            self.answers.append(set(tail[rare].tolist()))

    def confirm(self, k: int, line: list[int]) -> float:
        """Share of item k found in the best window of ``line``, 0 if that is not enough."""
        n = len(self.items.words[k])
        width = max(n + n // 2, 8)
        best, near = 0.0, False
        for at in range(0, max(1, len(line) - width + max(1, n // 2)), max(1, n // 2)):
            window = line[at:at + width]
            share = lcs(self.masks[k], n, window) / n
            if share >= LCS_ANSWER:
                held = self.answers[k]
                near = near or sum(x in held for x in set(window)) >= ANSWER * len(held)
            best = max(best, share)
        return best if best >= LCS or (best >= LCS_ANSWER and near) else 0.0

    def candidates(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item, passage) worth confirming, of the words of several texts."""
        t, block, blocks = self.items.rows(h, first)
        ends, found = np.cumsum(blocks), set()
        last = np.zeros(int(blocks.sum()), bool)  # no passage begins here, but that of a text of one block
        last[ends[blocks > 1] - 1] = True
        begins = np.zeros(len(last) + 1, bool)  # a text, so it is not in the passage of the block before
        begins[ends] = True
        for a in range(0, len(last), SLICE):
            b = min(a + SLICE, len(last))
            i, j = np.searchsorted(block, [a, b + 1])
            z = sums(self.right, t[i:j], block[i:j] - a, b + 1 - a)
            y = z[:-1] + z[1:]
            single = np.flatnonzero(begins[a + 1:b + 1])
            y[single] = z[single]
            dots = y if self.target is None else y @ self.target
            row, piece = np.nonzero(dots >= self.least)
            live = ~last[a + row]
            row, piece = row[live] + a, piece[live]
            text = np.searchsorted(ends, row, side="right")
            found.update(zip(text.tolist(), self.owner[piece].tolist(), (row - (ends - blocks)[text]).tolist()))
        return sorted(found)

    def search(self, texts: list[bytes]) -> list[list[tuple[int, float]]]:
        h, first = words_of(texts)
        found: list[dict[int, float]] = [{} for _ in texts]
        for text, k, passage in self.candidates(h, first):
            n, best = len(self.items.words[k]), found[text]
            if best.get(k, 0.0) < 1.0:
                line = h[first[text]:first[text + 1]]
                a, b = max(0, passage * BLOCK - n), (passage + 2) * BLOCK + n
                share = self.confirm(k, line[a:b].tolist())
                if share > best.get(k, 0.0):
                    best[k] = share
        return [[(self.items.ids[k], s) for k, s in sorted(best.items())] for best in found]


def _search(items: Items):
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        searcher = Searcher(items)
        for texts in series:
            yield pd.Series([[{"item_id": i, "share": s} for i, s in hits]
                             for group in grouped([(t or "").encode() for t in texts]) for hits in searcher.search(group)])
    return F.pandas_udf(run, "array<struct<item_id: bigint, share: double>>")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """row (the input row), hits: array of (item_id, share of the item found); one row per row of ``docs``.

    Null and empty texts have no hits, nor has any text for an empty benchmark; items without words or id are left out.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    hits = []
    for items in _blocks(benchmark):
        _fit(docs, items)

        hits.append(_search(items)(F.col("row.text").cast("string")))
    if not hits:
        return rows.withColumn("hits", F.array().cast("array<struct<item_id: bigint, share: double>>"))
    return rows.withColumn("hits", F.concat(*hits))
