"""Toxicity from a lexicon met through Levenshtein automata.

The lexicon (seed terms and terms learned from labelled rows) is a trie.  A word is read by the product of the trie with
the Levenshtein automaton: a state is a set of (trie node, edits so far), built when first met and kept, so reading a character
is one lookup and a word that no term is near leaves the automaton after a few characters.  Longer terms allow more edits, at any
letter.  Learned terms are whole words; a learned stem matches any ending, allows no edits, and stands beside the words only where
other words than those bear it out.

Hits are weighed in their context window: inside quotation marks or after a word of saying they count apart from hits
next to a second person or an intensifier.  A logistic model over these counts, fitted in numpy, gives the score.

The model is fitted on cross-fitted counts: the terms that score a half of the sample are learned on the other half, so a term that
is there by chance shows as such; the final lexicon is learned on both.

Learning reads at most SAMPLE labelled rows (smallest hash of the id first) outside the held-out quarter, written once to the shared
folder.  Of near copies with the same label (five-word sets, similarity ALIKE by the agreement of their sketches) one row counts, and all
rows of a family are in the same half, so that no word gets evidence from being copied.  Term counts over those rows are summed by
Spark; what reaches the driver is the sketches and feature rows of the sample and the terms with enough evidence, which no rank cuts.
Scoring is one map over the documents.
"""

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.near_dedup import BANDS, ROWS, sketches
from tallyloom.llm.storage import shared_folder, small_batches, stored

SEED_TERMS = ("idiot moron stupid imbecile loser clown scum trash garbage worthless pathetic disgusting vermin filth "
              "dumb retard bastard jerk freak pig coward liar creep fool hate despise").split()
SAYING = frozenset("said says wrote writes called quoted quote reported allegedly term word".split())
AIMED = frozenset("you your youre u yourself such so total absolute complete utter".split())
QUOTES = "\"'“”«»„‘’"
SAMPLE = 6000
ALIKE = 0.8
STEMS = range(4, 9)
EVIDENCE = 20.0  # log-likelihood ratio that a term needs; chance alone gives this about once in 10^5 terms
WINDOW = 5
STATES = 50_000  # states that an automaton keeps before it starts afresh
CUT = 0.3
FEATURES = 8
WORD = re.compile(r"\w+")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class TermAutomaton:
    """``terms``: (text, is_stem, weight).  ``read`` gives (term number, edits) of a word or None; ``anywhere``: edits at the first letter too."""

    def __init__(self, terms: list[tuple[str, bool, float]], anywhere: bool = False):
        self.terms, self.anywhere = terms, anywhere
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.budget = [0]
        for number, (text, stem, _) in enumerate(terms):
            most, node = 0 if stem else edits_allowed(text), 0
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], most)
            self.ends[node].append(number)
            self.budget[0] = max(self.budget[0], most if anywhere else 0)
        self.words: dict[str, tuple[int, int] | None] = {}
        self._afresh()

    def _afresh(self) -> None:
        self.names: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.stems: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, edits: dict[int, int]) -> int:
        todo = list(edits)
        while todo:  # skipping letters of a term
            node = todo.pop()
            if (node or self.anywhere) and edits[node] < self.budget[node]:
                for child in self.children[node].values():
                    e = edits[node] + 1
                    if e <= self.budget[child] and e < edits.get(child, 99):
                        edits[child] = e
                        todo.append(child)
        key = frozenset(edits.items())
        if key not in self.names:
            self.names[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            whole = [(e, number) for node, e in edits.items() for number in self.ends[node]
                     if not self.terms[number][1] and e <= edits_allowed(self.terms[number][0])]
            stems = [(-len(self.terms[number][0]), number) for node, e in edits.items() if e == 0 for number in self.ends[node] if self.terms[number][1]]
            self.accepts.append((min(whole)[1], min(whole)[0]) if whole else None)
            self.stems.append((min(stems)[1], 0) if stems else None)
        return self.names[key]

    def _move(self, state: int, c: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.states[state]:
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if (node or self.anywhere or letter == c) and cost <= self.budget[child] + (letter == c and e == 0) * 99 and cost < out.get(child, 99):
                    out[child] = cost
            if (node or self.anywhere) and e < self.budget[node] and e + 1 < out.get(node, 99):  # a letter too many
                out[node] = e + 1
        to = self._state(out) if out else -1
        self.moves[state][c] = to
        return to

    def read(self, word: str) -> tuple[int, int] | None:
        if word in self.words:
            return self.words[word]
        if len(self.states) > STATES:
            self._afresh()
        state, found = self.start, None
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                break
            found = self.stems[state] or found
        hit = (self.accepts[state] if state >= 0 else None) or found
        if len(self.words) > 100_000:
            self.words.clear()
        self.words[word] = hit
        return hit


def features(text: str | None, automaton: TermAutomaton) -> list[float]:
    low = (text or "").lower()
    words = WORD.findall(low)
    hits = {w: h for w in set(words) if (h := automaton.read(w))}
    exact = fuzzy = quoted = aimed = strongest = total = 0.0
    if hits:
        quotes = [m.start() for m in re.finditer(f"[{QUOTES}]", low)]
        spans = [(m.group(), m.start(), m.end()) for m in WORD.finditer(low)]
        for k, (word, start, end) in enumerate(spans):
            if word not in hits:
                continue
            number, edits = hits[word]
            weight = automaton.terms[number][2]
            around = [w for w, _, _ in spans[max(0, k - WINDOW):k]] + [w for w, _, _ in spans[k + 1:k + 1 + WINDOW]]
            left, right = spans[max(0, k - WINDOW)][1], spans[min(len(spans) - 1, k + WINDOW)][2]
            at = np.searchsorted(quotes, [left, start, end, right + 1]) if quotes else (0, 0, 0, 0)
            inside = (at[1] > at[0] and at[3] > at[2]) or not SAYING.isdisjoint(around)
            quoted += inside
            exact += edits == 0 and not inside
            fuzzy += edits > 0 and not inside
            aimed += not inside and not AIMED.isdisjoint(around)
            strongest = max(strongest, weight if edits == 0 else weight / 2)
            total += weight if edits == 0 else weight / 2
    distinct = len({n for n, _ in hits.values()})
    return [math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), math.log1p(aimed), float(min(distinct, 10)),
            strongest, 100 * (exact + fuzzy) / (len(words) + 10), math.log1p(total)]


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of at most SAMPLE labelled rows; the ids (8 bytes each, so at most 48 KB) are broadcast."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")


def families(rows: Iterable[tuple[int, list[int], bytes]]) -> dict[int, int]:
    """First member of each row's family; ``rows``: id, band keys, sketch bytes, at most SAMPLE of them.

    In order of id a row joins the first of the families that share a band with it and whose first member's sketch agrees in ALIKE
    of the bytes; else it begins one.  A text without words is alone.
    """
    least = math.ceil(ALIKE * BANDS * ROWS)
    buckets: dict[int, list[int]] = defaultdict(list)
    firsts: dict[int, np.ndarray] = {}
    family = {}
    for doc_id, keys, coords in sorted(rows):
        mine = np.frombuffer(coords, np.uint8)
        near = sorted({i for k in keys for i in buckets.get(k, ())})
        alike = np.flatnonzero((np.stack([firsts[i] for i in near]) == mine).sum(axis=1) >= least) if near else []
        if len(alike):
            family[doc_id] = near[alike[0]]
            continue
        family[doc_id] = doc_id
        firsts[doc_id] = mine
        for k in keys:
            buckets[k].append(doc_id)
    return family


def independent(rows: DataFrame) -> DataFrame:
    """text, toxic, half: one row of each family and label of the sample ``rows``; the ids kept (12 bytes each, at most SAMPLE) are broadcast."""
    spark = rows.sparkSession
    located = rows.select(F.struct("doc_id", "text").alias("row"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("at"))
    family = families((r.doc_id, r["keys"], bytes(r.coords)) for r in sketches(located, 5, BANDS, ROWS).select("doc_id", "keys", "coords").collect())
    first: dict[tuple[int, int], int] = {}
    for r in sorted(rows.select("doc_id", "toxic").collect()):
        first.setdefault((family[r.doc_id], r.toxic), r.doc_id)
    kept = [(doc_id, zlib.crc32(str(f).encode()) >> 8 & 1) for (f, _), doc_id in first.items()]
    return rows.join(F.broadcast(spark.createDataFrame(kept, "doc_id bigint, half int")), "doc_id").select("text", "toxic", "half")


def term_counts(rows: DataFrame) -> list[tuple[str, list[int]]]:
    """Whole words ("w$") and stems of toxic rows with the rows that have them, [clean, toxic] of half 0 and of half 1; "" counts the rows.

    Terms come back if five toxic rows and four times as many toxic as clean ones have them, in one half or both.
    """
    names = ["c0", "t0", "c1", "t1"]

    def count(frames):
        for frame in frames:
            seen: dict[str, list[int]] = {"": [0, 0, 0, 0]}
            for text, toxic, half in zip(frame["text"], frame["toxic"], frame["half"]):
                at = 2 * half + toxic
                seen[""][at] += 1
                words = {w for w in WORD.findall((text or "").lower()) if len(w) >= 4}
                for term in {w + "$" for w in words} | {w[:k] for w in words for k in STEMS if k <= len(w)}:
                    seen.setdefault(term, [0, 0, 0, 0])[at] += 1
            yield pd.DataFrame({"term": list(seen), **{n: [x[k] for x in seen.values()] for k, n in enumerate(names)}})
    sums = rows.mapInPandas(count, "term string, " + ", ".join(f"{n} bigint" for n in names)).groupBy("term").agg(*[F.sum(n).alias(n) for n in names])
    likely = "term = '' or (t0 + t1 >= 5 and t0 + t1 >= 4 * (c0 + c1)) or (t0 >= 5 and t0 >= 4 * c0) or (t1 >= 5 and t1 >= 4 * c1)"
    return [(r.term, [r[n] for n in names]) for r in sums.filter(likely).collect()]


def learned_terms(counts: list[tuple[str, list[int]]], halves=(0, 1)) -> tuple[list[tuple[str, bool, float]], int, int]:
    """(terms, clean rows, toxic rows) of the halves: the whole words with enough evidence, most frequent first, then stems.

    A stem needs evidence without its most frequent word (or longer stem): the toxic rows beyond that one's, against all its clean rows.
    """
    whole = {term: (sum(c[2 * h] for h in halves), sum(c[2 * h + 1] for h in halves)) for term, c in counts}
    n0, n1 = whole.pop("", (0, 0))
    if not n0 or not n1:
        return [], n0, n1
    rate = n1 / (n0 + n1)

    def enough(clean, toxic):
        if toxic < 5 or toxic < 4 * clean:
            return False
        p = toxic / (clean + toxic)
        return 2 * (toxic * math.log(p / rate) + (clean * math.log((1 - p) / (1 - rate)) if clean else 0.0)) >= EVIDENCE

    def weight(clean, toxic):
        return math.log((toxic + 0.5) / (clean + 0.5) * n0 / n1)
    good = [(term, *c) for term, c in sorted(whole.items(), key=lambda x: (-x[1][1], len(x[0]), x[0])) if enough(*c)]
    words = [(term[:-1], clean, toxic) for term, clean, toxic in good if term.endswith("$")]
    kept = [(text, False, weight(clean, toxic)) for text, clean, toxic in words]
    parts = {text: toxic for text, _, toxic in words}
    stems = []
    for text, clean, toxic in sorted((x for x in good if not x[0].endswith("$")), key=lambda x: (-len(x[0]), -x[2], x[0])):
        under = [p for p in parts if p.startswith(text)]
        own = toxic - max((parts[p] for p in under), default=0)
        if enough(clean, own):
            stems.append((own, text, weight(clean, own)))
            for p in under:
                del parts[p]
            parts[text] = toxic
    return kept + [(text, True, w) for _, text, w in sorted(stems, key=lambda x: (-x[0], x[1]))], n0, n1


def lexicon(terms: list[tuple[str, bool, float]]) -> list[tuple[str, bool, float]]:
    """Learned terms and the seed terms that aren't among the learned words."""
    known = {t for t, stem, _ in terms if not stem}
    return terms + [(t, False, 2.0) for t in SEED_TERMS if t not in known]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


#: used where no labels of both kinds exist: any clear hit outside a quotation passes the cut
DEFAULT = np.array([2.0, 1.0, 0.2, 0.5, 0.5, 0.2, 0.1, 0.2, -3.0])


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, bool, float]], np.ndarray]:
    rows = independent(stored(sample(docs, labels), f"{shared_folder(docs.sparkSession)}/sample"))
    counts = term_counts(rows)
    terms, n0, n1 = learned_terms(counts)
    if not n0 or not n1:
        return lexicon(terms), DEFAULT
    others = [lexicon(learned_terms(counts, (1 - h,))[0]) for h in (0, 1)]

    def run(frames):
        automata = [TermAutomaton(terms, anywhere=True) for terms in others]
        for frame in frames:
            yield pd.DataFrame({"x": [features(t, automata[h]) for t, h in zip(frame["text"], frame["half"])], "toxic": frame["toxic"]})
    found = rows.mapInPandas(run, "x array<double>, toxic int").collect()
    return lexicon(terms), fit(np.array([r.x for r in found]), np.array([r.toxic for r in found], float))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """row (the input row), doc_id, held_out, score, predicted; one row per row of ``docs``, empty and null texts included.

    Null or unknown labels are left out; an id with several labels counts as toxic if one of them says so, and of several labelled
    rows with one id the smallest text is learned from.  With no labels of
    both kinds the seed terms and fixed weights apply.
    """
    small_batches(docs.sparkSession)
    terms, weights = train(docs, labels)

    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = TermAutomaton(terms, anywhere=True)
        for texts in series:
            x = np.array([features(t, automaton) for t in texts]).reshape(-1, FEATURES)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))
    scored = F.pandas_udf(score, "double")
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).select(
        "row", F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"),
        scored(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
