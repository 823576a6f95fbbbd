"""Masked pseudo-likelihood of documents under a bidirectional window network trained in numpy.

Tokens are the lower-cased words.  The vocabulary holds the most frequent words of all documents, GROWTH times the square root of the number of
tokens (words that occur once are left out), so it grows with the corpus; id 0 stands for all other words.  The network reads the SIDE tokens on
each side of a position (embeddings, one hidden layer) and predicts the hidden token in three softmax steps, one for each digit of its id given the
digits before it, sized to the cube root of the vocabulary; all are exact probabilities, so an id's probability is their product.  A word outside the
vocabulary has the probability of id 0 times that of its bytes under a byte model with an end mark, fitted on all distinct words and
normalised over the strings that aren't in the vocabulary.  No two words share a probability mass.  A document's score is the sum over all its
positions of log p(token | both sides).

* Corpus counts of all ids (every document) start the output biases, so the untrained network is the unigram model.
* Training reads every document, and every position is hidden and predicted from its sides once per round; each
  task starts from the common weights, runs Adagrad over its own rows and sends its weights times its tokens; the next
  round starts from the weighted mean.  Sums of weights are taken in two salted levels, streaming, so no task holds more than one model.
* The driver holds the vocabulary and one model (about 18 numbers a word).
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import textnp
from tallyloom.llm.storage import dropped, shared_folder, small_batches, stored
from tallyloom.llm.sums import SCHEMA, chunked, collected

SIDE, WIDTH, HIDDEN = 2, 16, 32
V = 4096  # ids of a model of three digits below 16
BATCH, RATE = 2048, 0.05
GROWTH, HELD = 8, 500_000  # words a square root of tokens; distinct words that a counting task holds
END = 256


LEVELS = 3


def shapes(base: int) -> dict[str, tuple[int, ...]]:
    out = {"E": (base**LEVELS + 1, WIDTH), "W": (2 * SIDE * WIDTH, HIDDEN), "b": (HIDDEN,)}
    for k in range(LEVELS):  # U, u: logits of a digit; D: what the digits before it add to the hidden layer
        out |= {f"U{k}": (HIDDEN, base), f"u{k}": (base**k, base)} | ({f"D{k}": (base**k, HIDDEN)} if k else {})
    return out


def digits(size: int) -> int:
    """The base whose three-digit numbers are enough for ``size`` ids."""
    base = max(2, round(max(size, 1) ** (1 / LEVELS)))
    return base if base**LEVELS >= size else base + 1


def steps(target: np.ndarray, base: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(number of the digits before, digit) of every step."""
    return [(target // base ** (LEVELS - k), target // base ** (LEVELS - 1 - k) % base) for k in range(LEVELS)]


def word_counts(docs: DataFrame) -> DataFrame:
    """hash, word (bytes), n of every distinct word of all documents."""
    def run(batches):
        held: Counter[bytes] = Counter()

        def sent():
            words = list(held)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        for batch in batches:
            for text in textnp.texts(batch, "text"):
                held.update(text.lower().split())
                if len(held) > HELD:
                    yield sent()
                    held.clear()
        yield sent()
    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def byte_counts(words: DataFrame) -> np.ndarray:
    """How often every byte, and the end, occurs in the distinct words."""
    def run(batches):
        total = np.zeros(END + 1)
        for batch in batches:
            found = batch.column("word").to_pylist()
            total[:END] += np.bincount(np.frombuffer(b"".join(found), np.uint8), minlength=END)
            total[END] += len(found)
        yield chunked(total, 1.0)
    counts, _ = collected(words.select("word").mapInArrow(run, SCHEMA))
    return counts if len(counts) else np.zeros(END + 1)


class Vocabulary:
    """Ids of words, most frequent first from 1 on, 0 for the others; ``counts`` of the ids; log p of the bytes of the others."""

    def __init__(self, words: list[bytes], counts: np.ndarray, byte_counts: np.ndarray):
        self.counts = counts
        hashes = np.array([textnp.word_hashes(w)[0] for w in words], np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.numbers = hashes[order], order + 1
        # the sorted hashes by their first bits, some four slots a word, so that most slots hold one word or none
        self.shift = np.uint64(64 - max(8, len(words).bit_length() + 2))
        slots = np.arange((1 << 64 - int(self.shift)) + 1, dtype=np.uint64)
        self.slots = np.searchsorted(self.hashes >> self.shift, slots)
        self.bytes = np.log((byte_counts + 0.5) / (byte_counts + 0.5).sum())
        taken = sum(math.exp(self.bytes[np.frombuffer(w, np.uint8)].sum() + self.bytes[END]) for w in words)
        self.rest = self.bytes[END] - math.log1p(-min(taken, 1 - 1e-9))

    def _ids(self, h: np.ndarray) -> np.ndarray:
        ids = np.zeros(len(h), np.int64)
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.slots[slot], self.slots[slot + 1]
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        while len(left):
            hit = self.hashes[at] == h
            ids[left[hit]] = self.numbers[at[hit]]
            at += 1
            more = ~hit & (at < end)
            left, at, end, h = left[more], at[more], end[more], h[more]
        return ids

    def __call__(self, text: bytes, spelling: bool = True) -> tuple[np.ndarray, float]:
        """Ids of the words of a text, and (if asked) log p of the spelling of all words outside the vocabulary."""
        data = np.frombuffer(text.lower(), np.uint8)
        if not len(data):
            return np.empty(0, np.int64), 0.0
        starts, ends = textnp.word_bounds(data)
        ids = self._ids(textnp.range_hashes(data, starts, ends))
        others = np.flatnonzero(ids == 0) if spelling else ()
        if not len(others):
            return ids, 0.0
        sums = np.concatenate(([0.0], np.cumsum(self.bytes[data])))
        return ids, float((sums[ends[others]] - sums[starts[others]]).sum() + len(others) * self.rest)


def vocabulary(docs: DataFrame) -> Vocabulary:
    folder = shared_folder(docs.sparkSession)
    words = stored(word_counts(docs), folder)
    tokens = words.agg(F.sum("n")).first()[0] or 0
    top = words.filter("n > 1").orderBy(F.col("n").desc(), "word").limit(int(GROWTH * math.sqrt(tokens)) + 1).toArrow()
    n = top.column("n").to_numpy().astype(float)
    found = Vocabulary([bytes(w) for w in top.column("word").to_pylist()], np.concatenate(([tokens - n.sum()], n)), byte_counts(words))
    dropped(docs.sparkSession, folder)
    return found


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in shapes(2)]).astype(np.float64)


def shaped(vector: np.ndarray, base: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(base).items():
        size = int(np.prod(shape))
        out[name] = vector[at:at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def initial(counts: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    base = digits(len(counts))
    model = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in shapes(base).items()}
    # numbers after the last id are no words and get no probability
    below = np.concatenate((counts + 0.5, np.full(base**LEVELS - len(counts), 1e-20)))
    for k in reversed(range(LEVELS)):
        grid = below.reshape(base**k, base)
        below = grid.sum(axis=1)
        model[f"u{k}"] = np.log(grid / below[:, None]).astype(np.float32)
    model["b"][:] = 0
    return model


def _softmax(z: np.ndarray, digit: np.ndarray, scale: float) -> tuple[np.ndarray | None, np.ndarray]:
    """Probabilities times ``scale`` (None if that is 0) and log p of each row's digit; ``z`` is overwritten.

    Rows are shifted by their own greatest logit only where a sum of exponentials could leave the range of the numbers.
    """
    p = np.exp(z) if len(z) and z.max() < 60 else None
    total = None if p is None else p @ np.ones(z.shape[1], z.dtype)
    if total is None or total.min() < 1e-25:
        z -= z.max(axis=1, keepdims=True, initial=-np.inf)
        p = np.exp(z)
        total = p.sum(axis=1)
    chosen = z[np.arange(len(z)), digit] - np.log(total)
    if not scale:
        return None, chosen
    p *= (scale / total)[:, None]
    return p, chosen


def forward(model, context: np.ndarray, target: np.ndarray, scale: float = 1.0):
    """Input and hidden layer, and of every step: digits before, digit, its hidden layer, probabilities times ``scale``, log p of the digit."""
    x = model["E"][context].reshape(len(context), -1)
    h = x @ model["W"]
    h += model["b"]
    np.maximum(h, 0, out=h)
    found = []
    for k, (before, digit) in enumerate(steps(target, model["u0"].shape[1])):
        g = h
        if k:
            g = model[f"D{k}"][before]
            g += h
            np.maximum(g, 0, out=g)
        z = g @ model[f"U{k}"]
        z += model[f"u{k}"][before]
        found.append((before, digit, g, *_softmax(z, digit, scale)))
    return x, h, found


def log_p(model, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p of each target given its context."""
    return sum(x.astype(float) for *_, x in forward(model, context, target, scale=0.0)[2])


BY_ROW = {"E"} | {f"{x}{k}" for x in "Du" for k in range(1, LEVELS)}


class Trainer:
    """Adagrad on masked positions."""

    def __init__(self, model):
        self.model = {k: v.copy() for k, v in model.items()}
        self.seen = {k: np.full((len(v), 1) if k in BY_ROW else v.shape, 0.1, np.float32) for k, v in model.items()}

    def _dense(self, name, grad):
        self.seen[name] += grad * grad
        self.model[name] -= RATE * grad / np.sqrt(self.seen[name])

    def _by_row(self, name, rows, grad):
        # 16 bits at a time are sorted by radix
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        for shift in range(16, (len(self.model[name]) - 1).bit_length(), 16):
            order = order[np.argsort((rows[order] >> shift).astype(np.uint16), kind="stable")]
        rows = rows[order]
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        total, rows = np.add.reduceat(grad[order], first, axis=0), rows[first]
        seen = self.seen[name][rows]
        seen += np.einsum("ij,ij->i", total, total)[:, None] / total.shape[1]
        self.seen[name][rows] = seen
        total *= RATE / np.sqrt(seen)
        self.model[name][rows] -= total

    def step(self, context, target):
        m, n = self.model, len(target)
        x, h, found = forward(m, context, target, 1 / n)
        back_h = np.zeros_like(h)
        for k, (before, digit, g, p, _) in enumerate(found):
            p[np.arange(n), digit] -= np.float32(1 / n)
            back = p @ m[f"U{k}"].T
            back *= g > 0
            back_h += back
            self._dense(f"U{k}", g.T @ p)
            if k:
                self._by_row(f"D{k}", before, back)
                self._by_row(f"u{k}", before, p)
            else:
                self._dense("u0", p.sum(axis=0, keepdims=True))
        back_h *= h > 0
        back_x = (back_h @ m["W"].T).reshape(-1, WIDTH)
        self._dense("W", x.T @ back_h)
        self._dense("b", back_h.sum(axis=0))
        self._by_row("E", context.ravel(), back_x)


def windows(docs_ids: list[np.ndarray], none: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of several documents with SIDE pads (id ``none``) around each, and the positions of the real ones."""
    pad = np.full(SIDE, none, np.int64)
    line = np.concatenate([pad, *[part for ids in docs_ids for part in (ids, pad)]])
    return line, np.flatnonzero(line != none)


OFFSETS = np.array([k for k in range(-SIDE, SIDE + 1) if k])


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = 1) -> dict[str, np.ndarray]:
    texts = docs.select(F.col("text").cast("string").alias("text"))
    size = digits(len(vocabulary.counts))
    vector = flat(initial(vocabulary.counts))
    for _ in range(rounds):
        start = vector.astype(np.float32)

        def run(batches, start=start):
            trainer, tokens, held = Trainer(shaped(start, size)), 0, [[], []]
            none = size**LEVELS
            for batch in batches:
                for text in textnp.texts(batch, "text"):
                    ids, _ = vocabulary(text, spelling=False)
                    if not len(ids):
                        continue
                    tokens += len(ids)
                    line, at = windows([ids], none)
                    held[0].append(line[at[:, None] + OFFSETS])
                    held[1].append(line[at])
                    if sum(map(len, held[1])) >= BATCH:
                        context, target = map(np.concatenate, held)
                        whole = len(target) - len(target) % BATCH
                        for k in range(0, whole, BATCH):
                            trainer.step(context[k:k + BATCH], target[k:k + BATCH])
                        held = [[context[whole:]], [target[whole:]]]
            if held[1] and sum(map(len, held[1])):
                trainer.step(*map(np.concatenate, held))
            if tokens:
                yield chunked(flat(trainer.model) * tokens, float(tokens))
        total, tokens = collected(texts.mapInArrow(run, SCHEMA))
        if tokens:
            vector = total / tokens
    return shaped(vector, size)


def log_probabilities(model, docs_ids: list[np.ndarray], step: int = 4096) -> list[np.ndarray]:
    line, at = windows(docs_ids, len(model["E"]) - 1)
    out = np.empty(len(at))
    for k in range(0, len(at), step):
        here = at[k:k + step]
        out[k:k + step] = log_p(model, line[here[:, None] + OFFSETS], line[here])
    return np.split(out, np.cumsum([len(i) for i in docs_ids])[:-1])


def lm_scores(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over positions), mean_log_likelihood (0 without tokens); one row per row.

    Null and empty texts have no tokens and score 0.
    """
    small_batches(docs.sparkSession)
    known = vocabulary(docs)
    model = train(docs, known, rounds)

    def run(batches):
        for batch in batches:
            read = [known(t) for t in textnp.texts(batch, "text")]
            ids = [i for i, _ in read]
            sums, at = [], 0
            while at < len(ids):  # about 65,000 tokens at a time, or one long document
                to, size = at, 0
                while to < len(ids) and (to == at or size + len(ids[to]) <= 65536):
                    size += len(ids[to])
                    to += 1
                sums += [float(x.sum()) for x in log_probabilities(model, ids[at:to])]
                at = to
            sums = [s + spelled for s, (_, spelled) in zip(sums, read)]
            n = [len(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums, pa.float64()),
                 pa.array([s / k if k else 0.0 for s, k in zip(sums, n)], pa.float64())],
                names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, log_likelihood double, mean_log_likelihood double")
