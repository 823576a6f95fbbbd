"""Near-duplicate documents by fast similarity sketching, banding and an exact check of full sets.

A document is the set of its runs of words.  Its sketch has T coordinates, filled in rounds: in round i every
element goes to a hashed bin with value i + (hash fraction) and a bin keeps its least value; rounds 0..T-1 choose the bin
by hash, rounds T..2T-1 take bin i - T, so after 2T rounds at the latest no coordinate is empty, and almost always after a few.
Two sets agree in a coordinate with probability equal to their Jaccard similarity, and the number of agreements concentrates at
least as well as for independent coordinates.

* Equal sets become one class first, so exact copies never meet in a bucket.
* T = bands x rows.  A pair of similarity s shares no bucket with probability at most (1 - s^rows)^bands: 5e-7 at the
  threshold for 48 x 6.
* In a bucket every member is compared with one leader; what stays unconnected is compared with everything it shares
  a bucket with (``_rest``).  Both give every link that could join two components; pairs inside a component already found
  are not needed.
* A candidate whose sketches agree so rarely that similarity at the threshold would give it with
  probability under 1e-7 (Hoeffding) is dropped before the texts are fetched; the others are confirmed on full sets.

Rows, not ids, are the nodes, so repeated and missing ids do no harm.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import textnp
from tallyloom.llm.graph import components
from tallyloom.llm.storage import located, shared_folder, small_batches, stored

BANDS, ROWS = 48, 6
PER_BLOCK = 256
TILE = 1024


class Sketcher:
    def __init__(self, bands: int, rows: int, seed: int = 11):
        self.bands, self.rows, self.t = bands, rows, bands * rows
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(0, 2**64, 2 * self.t, dtype=np.uint64)
        self.weights = rng.integers(0, 2**64, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def sketch(self, elements: np.ndarray) -> np.ndarray:
        t, n = self.t, len(elements)
        out = np.full(t, np.uint64(2**64 - 1))
        at = 0
        while at < 2 * t and (at == 0 or (out == np.uint64(2**64 - 1)).any()):
            rounds = min(t - at if at < t else 2 * t - at, max(1, 4096 // n))
            h = textnp.mix(elements[None, :] ^ self.seeds[at:at + rounds, None])
            number = np.arange(at, at + rounds, dtype=np.uint64)[:, None]
            value = (number << np.uint64(52)) | (h >> np.uint64(12))  # the round first, then the fraction
            if at < t:
                np.minimum.at(out, ((h & np.uint64(0xFFFFFFFF)) % np.uint64(t)).ravel().astype(np.int64), value.ravel())
            else:
                bins = np.arange(at - t, at - t + rounds)
                out[bins] = np.minimum(out[bins], value.min(axis=1))
            at += rounds
        return out

    def band_keys(self, sketch: np.ndarray) -> np.ndarray:
        return textnp.mix((textnp.mix(sketch).reshape(self.bands, self.rows) * self.weights).sum(axis=1, dtype=np.uint64)
                          + np.arange(self.bands, dtype=np.uint64))


def sketches(rows: DataFrame, words: int, bands: int, per_band: int) -> DataFrame:
    """``rows``: row.doc_id, row.text, file, at.  Adds n (set size), two 64-bit sums that name the set, keys (one per
    band) and coords (one byte per coordinate)."""
    def run(batches):
        sketcher = Sketcher(bands, per_band)
        for batch in batches:
            out = {k: [] for k in ("n", "s1", "s2", "keys", "coords")}
            for text in textnp.texts(batch, "text"):
                a = textnp.shingle_set(text, words)
                s = sketcher.sketch(a) if len(a) else None
                sums = np.array([a.sum(dtype=np.uint64), textnp.mix(a ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64)
                s1, s2 = textnp.signed(sums).tolist()
                for k, v in (("n", len(a)), ("s1", s1), ("s2", s2), ("keys", textnp.signed(sketcher.band_keys(s)) if len(a) else []),
                             ("coords", (textnp.mix(s) & np.uint64(255)).astype(np.uint8).tobytes() if len(a) else b"")):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("file").cast(pa.string()), batch.column("at"), pa.array(out["n"], pa.int64()),
                 pa.array(out["s1"], pa.int64()), pa.array(out["s2"], pa.int64()), pa.array(out["keys"], pa.list_(pa.int64())),
                 pa.array(out["coords"], pa.binary())],
                names=["doc_id", "file", "at", "n", "s1", "s2", "keys", "coords"])
    return rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), F.col("row.text").cast("string").alias("text"), "file", "at").mapInArrow(
        run, "doc_id bigint, file string, at bigint, n bigint, s1 bigint, s2 bigint, keys array<bigint>, coords binary")


def least_agreement(t: int, threshold: float, failure: float = 1e-7) -> int:
    """Fewest equal coordinates that a pair at the threshold shows, but with probability ``failure`` (binomial tail)."""
    total = 0.0
    for k in range(t + 1):
        total += math.comb(t, k) * threshold**k * (1 - threshold) ** (t - k)
        if total > failure:
            return k
    return t


def _agree(pairs: DataFrame, reps: DataFrame, t: int, threshold: float) -> DataFrame:
    """Candidates whose sketches agree often enough; ``pairs``: a, b."""
    least = least_agreement(t, threshold)
    left = pairs.join(reps.select(F.col("node").alias("a"), F.col("coords").alias("ca"), F.col("n").alias("na")), "a")
    both = left.join(reps.select(F.col("node").alias("b"), F.col("coords").alias("cb"), F.col("n").alias("nb")), "b")
    both = both.filter((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * round(threshold * 100)))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, t) for c in ("ca", "cb"))
            hit = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(hit), batch.column("b").filter(hit)], names=["a", "b"])
    return both.select("a", "b", "ca", "cb").mapInArrow(run, "a bigint, b bigint")


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, threshold: float, folder: str) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    The pairs of one ``a`` are cut into blocks of at most about PER_BLOCK; its text travels once per block, and so does
    each ``b``.  A task holds one set of a block's ``a`` and one of a ``b`` at a time.
    """
    percent = round(threshold * 100)
    sizes = pairs.groupBy("a").agg((F.count(F.lit(1)) / PER_BLOCK).cast("bigint").alias("blocks"))
    blocks = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks") + 1).alias("block"), F.col("b").alias("node"), F.lit(1).alias("role"))
    heads = blocks.groupBy("a", "block").agg(F.lit(0).alias("role")).select("a", "block", F.col("a").alias("node"), "role")
    rows = (blocks.unionByName(heads).join(texts, "node")
            .repartition("a", "block").sortWithinPartitions("a", "block", "role"))

    def run(batches):
        key, head = None, None
        for batch in batches:
            a, b, block, role = (batch.column(c).to_pylist() for c in ("a", "node", "block", "role"))
            out = ([], [])
            for i, text in enumerate(textnp.texts(batch, "text")):
                mine = textnp.shingle_set(text, words)
                if role[i] == 0:
                    key, head = (a[i], block[i]), mine
                    continue
                assert key == (a[i], block[i])
                at = np.searchsorted(head, mine)
                both = int((head[np.minimum(at, len(head) - 1)] == mine).sum())
                if 100 * both >= percent * (len(head) + len(mine) - both):
                    out[0].append(a[i])
                    out[1].append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])
    return stored(rows.mapInArrow(run, "a bigint, b bigint"), folder)


def _link(pairs: DataFrame, reps: DataFrame, rows: DataFrame, words: int, threshold: float, t: int, folder: str) -> DataFrame:
    """The candidate pairs (a, b) of class nodes that are links."""
    likely = stored(_agree(pairs, reps, t, threshold), f"{folder}/likely")
    wanted = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    places = reps.select("node", "file", "at").join(wanted, "node")
    texts = stored(rows.select("file", "at", F.col("row.text").cast("string").alias("text")).join(places, ["file", "at"])
                   .select("node", "text"), f"{folder}/texts")
    return _confirm(likely, texts, words, threshold, f"{folder}/links")


def _rest(members: DataFrame, comps: DataFrame, reps: DataFrame, rows: DataFrame, words: int, threshold: float, t: int, folder: str) -> DataFrame:
    """Links of buckets that still hold several components.

    The largest component of a bucket isn't compared with itself: the rows outside it are compared with all rows of the
    bucket, in tiles of about TILE x TILE rows.  Inside a tile a pair is looked at in the first band it shares only, its sketches
    are compared first, and nothing is checked between rows that the tile has already connected.
    """
    tagged = members.join(comps, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("comp"))
    parts = tagged.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = (parts.groupBy("band", "key").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("m"), F.count(F.lit(1)).alias("parts"))
             .filter("parts > 1").select("band", "key", F.col("top.comp").alias("largest"),
                                         F.ceil((F.col("m") - F.col("top.k")) / TILE).cast("int").alias("few"), F.ceil(F.col("m") / TILE).cast("int").alias("all")))
    held = stored(tagged.join(mixed, ["band", "key"]), f"{folder}/open")

    def tile(count):
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    def every(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    key = ["band", "key", "i", "j"]
    left = held.filter("comp <> largest").select("band", "key", "node", "comp", F.lit(0).alias("role"), tile("few").alias("i"), every("all").alias("j"))
    right = held.select("band", "key", "node", "comp", F.lit(1).alias("role"), every("few").alias("i"), tile("all").alias("j"))
    places = reps.join(held.select("node").distinct(), "node")
    load = stored(rows.select("file", "at", F.col("row.text").cast("string").alias("text")).join(places, ["file", "at"])
                  .select("node", "n", "keys", "coords", "text"), f"{folder}/load")
    tiles = left.unionByName(right).join(load, "node").repartition(*key).sortWithinPartitions(*key, "role")
    least, percent = least_agreement(t, threshold), round(threshold * 100)

    def run(batches):
        key, few, stacked, out, parent, sets = None, [], None, [], {}, {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def elements(row):
            if row[0] not in sets:
                sets[row[0]] = textnp.shingle_set(row[5], words)
            return sets[row[0]]

        for batch in batches:
            ids, comp, role, n, band = (batch.column(c).to_pylist() for c in ("node", "comp", "role", "n", "band"))
            groups = list(zip(band, *(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
            coords = np.frombuffer(b"".join(batch.column("coords").to_pylist()), np.uint8).reshape(-1, t)
            keys = batch.column("keys").flatten().to_numpy().reshape(batch.num_rows, -1)
            for at, text in enumerate(textnp.texts(batch, "text")):
                row = (ids[at], comp[at], n[at], coords[at], keys[at], text)
                if groups[at] != key:
                    key, few, stacked, parent, sets = groups[at], [], None, {}, {}
                if role[at] == 0:
                    few.append(row)
                    continue
                if stacked is None:
                    stacked = [np.array([r[k] for r in few]) for k in range(5)]
                other, theirs, size, co, ke = stacked
                like = ((co == row[3]).sum(axis=1) >= least) & (theirs != row[1]) & (
                    100 * np.minimum(size, row[2]) >= percent * np.maximum(size, row[2])) & ((ke == row[4]).argmax(axis=1) == band[at])
                for k in np.flatnonzero(like):
                    x, y = root(few[k][1]), root(row[1])
                    if x == y:
                        continue
                    a, b = elements(few[k]), elements(row)
                    where = np.minimum(np.searchsorted(a, b), len(a) - 1)
                    both = int((a[where] == b).sum())
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        parent[x] = y
                        out.append((few[k][0], row[0]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
            out = []
    return stored(tiles.mapInArrow(run, "a bigint, b bigint"), f"{folder}/links")


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8, bands: int = BANDS, per_band: int = ROWS,
                    folder: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id), and
    file, at, stays: of the rows of a component exactly one stays, also where rows repeat a doc_id.

    One row per input row.  Documents without words have an empty set and are linked with nothing.  Rows without a doc_id
    take part; their component has the smallest doc_id there is, null if there is none.  The result reads tables under ``folder``
    (default: a new one).
    """
    spark, folder = docs.sparkSession, folder or shared_folder(docs.sparkSession)
    small_batches(spark)
    rows = located(docs, folder)
    t = bands * per_band
    base = stored(sketches(rows, words, bands, per_band).withColumn("node", F.monotonically_increasing_id()), f"{folder}/sketches")
    narrow = base.select("node", "doc_id", "file", "at", "n", "s1", "s2")
    name = ["n", "s1", "s2"]
    # an empty set is a class of its own row
    named = narrow.withColumn("s1", F.when(F.col("n") == 0, F.col("node")).otherwise(F.col("s1")))
    classes = stored(named.groupBy(*name).agg(F.min("node").alias("rep"), F.min("doc_id").alias("low")), f"{folder}/classes")
    reps = stored(base.join(classes.filter("n > 0").select(F.col("rep").alias("node")), "node").select("node", "file", "at", "n", "keys", "coords"), f"{folder}/reps")
    buckets = reps.select("node", F.posexplode("keys").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    members = stored(buckets.join(shared, ["band", "key"]), f"{folder}/members")
    # the original of a family of copies shares more buckets than its copies do, so it leads where it can
    weight = members.groupBy("node").agg(F.sum("k").alias("weight"))
    leaders = members.join(weight, "node").groupBy("band", "key").agg(F.max(F.struct("weight", "node"))["node"].alias("leader"))
    first = members.join(leaders, ["band", "key"]).filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    first = stored(first.distinct(), f"{folder}/first")
    links = _link(first, reps, rows, words, threshold, t, f"{folder}/one")
    comps = components(links, f"{folder}/comps1")
    more = _rest(members.drop("k"), comps, reps, rows, words, threshold, t, f"{folder}/two")
    if not more.isEmpty():
        comps = components(links.unionByName(more), f"{folder}/comps2")
    placed = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    lows = placed.groupBy("comp").agg(F.min("low").alias("component_id"))
    placed = stored(placed.select(*name, "comp").join(lows, "comp"), f"{folder}/placed")
    out = named.join(placed, name)
    firsts = out.filter("doc_id <=> component_id").groupBy("comp").agg(F.min("node").alias("first"))
    return out.join(firsts, "comp").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.expr("doc_id <=> component_id").alias("kept"),
        "file", "at", (F.col("node") == F.col("first")).alias("stays"))
