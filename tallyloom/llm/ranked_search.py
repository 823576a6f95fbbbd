"""Ranked lexical search: a frequent-pattern tree of documents, searched by branch and bound for every item.

1. One scan counts the terms of all documents (N documents with a term, L terms) and writes each document's term vector restricted to the terms of the
   asked items: term numbers and their occurrences.  Document frequencies come from these vectors.
2. Vectors are ordered by document frequency, rarest term first, and range-partitioned along that order, so that documents with the same leading terms
   share a path of the tree wherever they come from, and a tree holds few leading terms.  Copies are dealt on by their id.
3. A task builds trees of up to CELLS / terms documents from its sorted stream.  A node covers the documents that share its path; it knows the
   largest tf of every term and the smallest m below it.  As a score rises with tf and falls with m, these two bound every score below.
4. For an item the tree is searched depth first, best child first; a node whose bound is below the item's 20th best score so far
   in this task is left out with all below it.  Leaves are scored exactly in 64-bit integers.
5. The best of each task are ranked over all tasks.

Items are searched in blocks with at most TERMS different terms (an item with more has a block of its own), so what travels with a task is bounded; one more block is one
more pass over the documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import shared_folder, small_batches, stored
from tallyloom.llm.textnp import texts

TOP = 20
TERMS = 4096  # different terms of a block of items
CELLS = 8_000_000  # documents times terms of a tree
LEAF = 16  # documents of a leaf at most, unless they share all terms
ITEM_BYTES = 1 << 20  # text of a block of items at most, or one item
SCALE, B1, B2 = 1_000_000_000, 75, 25

# bytes of a term: digits, letters (A-Z lower-cased) and all of non-ASCII characters
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a score that a weight multiplies."""
    return (SCALE * tf) // (1000 * tf + 12 * m)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, int | None, Counter]]]:
    """Lists of (number, item_id, terms with repeats); the items pass one partition at a time."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, known, size = [], set(), 0
    for number, row in enumerate(rows.toLocalIterator()):
        found = Counter(terms((row.text or "").encode()))
        if block and (len(known | set(found)) > TERMS or size + len(row.text or "") > ITEM_BYTES):
            yield block
            block, known, size = [], set(), 0
        block.append((number, row.item_id, found))
        known.update(found)
        size += len(row.text or "")
    if block:
        yield block


VECTOR = "doc_id bigint, n bigint, documents bigint, terms binary, tfs binary"


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with a term of the vocabulary (doc_id, n terms with repeats, term numbers and occurrences as packed 32-bit numbers), and one row
    per task with the sums over all documents (documents with a term, n)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("documents", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary())])

    def run(batches):
        documents = total = 0
        for batch in batches:
            ids, sizes, numbers, tfs = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
                words = terms(text)
                documents, total = documents + bool(words), total + len(words)
                found = Counter([vocabulary[w] for w in words if w in vocabulary])
                if found:
                    ids.append(doc_id)
                    sizes.append(len(words))
                    numbers.append(np.fromiter(found, np.int32, len(found)).tobytes())
                    tfs.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(ids), pa.int64()),
                                              pa.array(numbers, pa.binary()), pa.array(tfs, pa.binary())], schema=schema)
        yield pa.RecordBatch.from_pylist([{"n": total, "documents": documents}], schema=schema)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, VECTOR)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents per term number; one row per task and term is summed by Spark."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            held = b"".join(batch.column("terms").to_pylist())
            total += np.bincount(np.frombuffer(held, np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["term", "df"])
    out = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def paths(rows: DataFrame, df: np.ndarray, documents: int, length: int) -> DataFrame:
    """doc_id, m, path (ranks of the terms, rarest first, big-endian so that bytes sort like numbers), tfs along it."""
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))

    def run(batches):
        for batch in batches:
            found, tfs = [], []
            for t, n in zip(batch.column("terms").to_pylist(), batch.column("tfs").to_pylist()):
                ranks = rank[np.frombuffer(t, np.int32)]
                order = np.argsort(ranks)
                found.append(ranks[order].astype(">u4").tobytes())
                tfs.append(np.frombuffer(n, np.int32)[order].tobytes())
            m = [100 - B2 + (B2 * n * documents) // length for n in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(m, pa.int64()), pa.array(found, pa.binary()), pa.array(tfs, pa.binary())],
                                             names=["doc_id", "m", "path", "tfs"])
    return rows.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "doc_id bigint, m bigint, path binary, tfs binary")


class Tree:
    """A frequent-pattern tree over documents sorted by path; ``table`` holds the documents' tf per term rank."""

    def __init__(self, ids: list[int | None], m: np.ndarray, ranks: list[np.ndarray], tfs: list[np.ndarray], size: int):
        self.ids, self.m = ids, m
        self.table = np.zeros((len(ids), size), np.int32)
        for row, (r, t) in enumerate(zip(ranks, tfs)):
            self.table[row, r] = t
        shared = np.zeros(len(ids) + 1, np.int64)  # terms that a document's path shares with the one before it
        for k in range(1, len(ids)):
            a, b = ranks[k - 1], ranks[k]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            shared[k] = differ[0] if len(differ) else n
        # nodes: documents [first, last); children follow their parents
        self.first, self.last, self.children = [0], [len(ids)], [[]]
        waiting = [0]
        for node in waiting:
            lo, hi = self.first[node], self.last[node]
            inner = shared[lo + 1:hi]
            if hi - lo <= LEAF or inner.min() == inner.max() and hi - lo == 1:
                continue
            cuts = [lo, *(lo + 1 + np.flatnonzero(inner == inner.min())).tolist(), hi]
            if len(cuts) - 1 > LEAF:  # many ways on from here, or copies: bounded groups of neighbours
                cuts = cuts[::LEAF] + ([hi] if (len(cuts) - 1) % LEAF else [])
            for s, e in zip(cuts, cuts[1:]):
                self.first.append(s)
                self.last.append(e)
                self.children.append([])
                self.children[node].append(len(self.first) - 1)
                waiting.append(len(self.first) - 1)
        n = len(self.first)
        self.most, self.least = np.zeros((n, size), np.int32), np.zeros(n, np.int64)
        for node in reversed(range(n)):
            below = self.children[node]
            if below:
                self.most[node], self.least[node] = self.most[below].max(axis=0), self.least[below].min()
            else:
                lo, hi = self.first[node], self.last[node]
                self.most[node], self.least[node] = self.table[lo:hi].max(axis=0), m[lo:hi].min()

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: list, top: int) -> None:
        """Pushes onto the heap ``best`` of (score, order, doc_id) every document that can be among the ``top``."""
        # bounds of all nodes in one step; which of them are visited is settled depth first below
        bound = (impact(self.most[:, ranks].astype(np.int64), self.least[:, None]) * weights).sum(axis=1).tolist()
        waiting = [0]
        while waiting:
            node = waiting.pop()
            if bound[node] <= 0 or len(best) == top and bound[node] < best[0][0]:
                continue
            below = self.children[node]
            if below:
                waiting.extend(sorted(below, key=bound.__getitem__))
                continue
            lo, hi = self.first[node], self.last[node]
            scores = (impact(self.table[lo:hi, ranks].astype(np.int64), self.m[lo:hi, None]) * weights).sum(axis=1).tolist()
            for k, score in enumerate(scores, lo):
                if score > 0:
                    doc_id = self.ids[k]
                    # the worst entry is the smallest: low score, then large id, a null id worst
                    entry = (score, -math.inf if doc_id is None else -doc_id, doc_id)
                    if len(best) < top:
                        heapq.heappush(best, entry)
                    elif entry[:2] > best[0][:2]:
                        heapq.heapreplace(best, entry)


FOUND = "number int, doc_id bigint, score bigint"


def searched(rows: DataFrame, asked: list[tuple[int, np.ndarray, np.ndarray]], size: int, top: int) -> DataFrame:
    """number of the item, doc_id, score: the best of every task.  ``rows`` as of ``paths``; ``asked``: (number, term ranks, weights)."""
    most = max(LEAF, CELLS // max(size, 1))

    def run(batches):
        best = {number: [] for number, _, _ in asked}
        held = [[], [], [], []]

        def done():
            tree = Tree(held[0], np.array(held[1], np.int64), held[2], held[3], size)
            for number, ranks, weights in asked:
                tree.search(ranks, weights, best[number], top)
        for batch in batches:
            for doc_id, m, path, tfs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "m", "path", "tfs"))):
                for into, value in zip(held, (doc_id, m, np.frombuffer(path, ">u4").astype(np.int64), np.frombuffer(tfs, np.int32))):
                    into.append(value)
                if len(held[0]) >= most:
                    done()
                    held = [[], [], [], []]
        if held[0]:
            done()
        out = [(number, doc_id, score) for number, found in best.items() for score, _, doc_id in found]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())],
                                         names=["number", "doc_id", "score"])
    # the first terms settle where a document goes, so the sample of keys that Spark takes stays small
    along = rows.repartitionByRange(F.substring("path", 1, 16), "doc_id").sortWithinPartitions("path", "doc_id")
    return along.mapInArrow(run, FOUND)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` highest-scoring documents of each row of ``items`` with a score above 0; equal scores by
    ascending doc_id, a null doc_id last.

    Null and empty texts have no terms: such documents are found by nothing and such items find nothing.  Repeated rows of either table are ranked
    as rows of their own; an empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = shared_folder(spark)
    out = None
    for k, block in enumerate(item_blocks(items)):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, _, found in block for w in found}))}
        rows = stored(vectors(docs, vocabulary), f"{folder}/vectors-{k}")
        sums = rows.filter("documents is not null").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n")).first()
        documents, length = sums.documents or 0, sums.n or 0
        rows = rows.filter("documents is null")
        df = document_frequencies(rows, len(vocabulary))
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df]
        rank = np.empty(len(df), np.int64)
        rank[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))
        asked = [(number, rank[[vocabulary[w] for w in found]], np.array([weight[vocabulary[w]] * n for w, n in found.items()], np.int64))
                 for number, _, found in block if found]
        found = searched(paths(rows, df, documents, max(length, 1)), asked, len(vocabulary), top)
        names = spark.createDataFrame([(number, item_id) for number, item_id, _ in block], "number int, item_id bigint")
        order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(F.broadcast(names), "number")
        best = best.select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
