"""Ranked search, tokenizer alignment and sentence pieces against plain versions; odd rows and empty tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import alignment, queries, ranked_search, sentence_pieces
from tallyloom.llm.minimal_hash import MinimalHash

SCHEMA = "doc_id bigint, text string, file string, block bigint, chunk string, at bigint, rid bigint"
LONG = " ".join(f"w{k % 977}x{k}" for k in range(40_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here at all"), (5, "same"), (5, "same"), (6, LONG), (7, "ünïcode ☃ 😀 text"),
       (8, "a▁b  c"), (9, "<s>x</s><|endoftext|>\r\n  <0x0A>"), (10, "x" * 30_000), (11, "\n\nsame\n"), (None, None)]
PIECES = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
BYTES = Tokenizer.from_file(alignment.BYTE_LEVEL)
BYTES.encode_special_tokens = True


def made(spark, tmp_path, texts, name="docs"):
    path = str(tmp_path / name)
    spark.createDataFrame([(i, t, "p", 1, "c", 2, 3) for i, t in texts], SCHEMA).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- 13

def plain_pieces(text):
    ids = PIECES.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(PIECES.decode(ids))


@pytest.mark.parametrize("rows, buckets", [(8192, None), (2, 1), (3, 5)])
def test_pieces_of_odd_rows(spark, tmp_path, monkeypatch, rows, buckets):
    monkeypatch.setattr(sentence_pieces, "BLOCK_ROWS", rows)
    monkeypatch.setattr(sentence_pieces, "BUNDLE", rows)
    rows = sentence_pieces.digests(sentence_pieces.pieces_and_back(made(spark, tmp_path, ODD), buckets=buckets)).collect()
    assert Counter(map(tuple, rows)) == Counter((i, *plain_pieces(t)) for i, t in ODD)


def test_pieces_of_a_table(spark, sf_dir):
    rows = queries.queries()["op13_sentence_pieces"](spark, sf_dir).collect()
    texts = queries.documents(spark, sf_dir).select("doc_id", "text").collect()
    assert sorted(map(tuple, rows)) == sorted((r.doc_id, *plain_pieces(r.text)) for r in texts)


def test_chunks_of_random_strings():
    rng = random.Random(1)
    letters = [*" ▁\n\ta b.éñ😀<s>0x0A\r中 \x00'", "  ", "    ", "\n\n", "word", "the "]
    segmenter = sentence_pieces.Segmenter(sentence_pieces.model_bytes())
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(1, 25)))
        assert [i for part in segmenter.ids(sentence_pieces.chunks(text)) for i in part] == PIECES.encode(text)


# ---------------------------------------------------------------- 11

def tokenizers():
    tokens, wrong = alignment.byte_tokens(open(alignment.BYTE_LEVEL, encoding="utf-8").read())
    assert wrong is None
    return alignment.Tokenizers(tokens, sentence_pieces.model_bytes())


def plain_alignment(texts):
    """(doc_id, columns of the contract) of each row, by loops over tokens."""
    both = tokenizers()
    found, documents = [], Counter()
    for i, text in texts:
        a, b = BYTES.encode(" " + (text or ""), add_special_tokens=False).ids, PIECES.encode(text or "")
        of_a, of_b = [both.bytes_a[x] for x in a], [both.bytes_b[x] for x in b]
        data = (" " + (text or "")).encode()
        if not text or b"".join(of_a) != data or b"".join(of_b) != data:
            found.append((i, None))
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (of_a, of_b)]
        shared = set(ends[0]) & set(ends[1])
        groups, at = [], [0, 0]
        while at[0] < len(a):
            group = ([], [])
            for side, ids in enumerate((a, b)):
                while True:
                    group[side].append(ids[at[side]])
                    at[side] += 1
                    if ends[side][at[side] - 1] in shared:
                        break
            groups.append(group)
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        documents.update(set(links))
        found.append((i, (len(a), len(b), groups, links)))
    best = defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    for i, f in found:
        if f is None:
            yield i, 0, 0, 0, 0, 0, 0, ""
        else:
            said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in f[2])
            yield i, f[0], f[1], len(f[2]), len(f[3]), sum(documents[k] == best[k[0]] for k in f[3]), sum(documents[k] for k in f[3]), sha(said)


def test_alignment_of_odd_rows(spark, tmp_path):
    rows = alignment.alignments(made(spark, tmp_path, ODD)).collect()
    assert Counter(map(tuple, rows)) == Counter(plain_alignment(ODD))


def test_alignment_in_small_blocks_and_long_groups(spark, sf_dir, monkeypatch):
    for name, value in (("BLOCK", 20_000), ("SLICE", 5_000), ("BUCKET", 500), ("LINKS", 64), ("WIDE", 2)):
        monkeypatch.setattr(alignment, name, value)
    texts = [(r.doc_id, r.text) for r in queries.documents(spark, sf_dir).select("doc_id", "text").collect()]
    rows = queries.queries()["op11_tokenizer_alignment"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(plain_alignment(texts))


def test_chunks_are_aligned_alone():
    rng = random.Random(3)
    letters = [*" \n\ta b.é😀'\r中\x1c\x85 　́_-²½١Ǆ▁", "  ", "\n\n", "word", "the ", "'s", "'ll", "<|endoftext|>", "12", "!", "?", ";"]
    both = tokenizers()
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 25))) for _ in range(3000)]
    for text in texts:
        chunks = alignment.CUT.split(" " + text)
        order, given, a, b = both.encode_all(chunks)
        assert given.all() == ("▁" not in text)
        if given.all():
            ids = [dict(zip(order, np.split(i, np.cumsum(n)[:-1]))) for i, n in (a, b)]
            assert [i for c in chunks for i in ids[0][c]] == BYTES.encode(" " + text, add_special_tokens=False).ids
            assert [i for c in chunks for i in ids[1][c]] == PIECES.encode(text)


def test_every_character_under_a():
    both = tokenizers()
    texts = [f" a{chr(k)}1{chr(k)} {chr(k)}" for k in range(0x11000) if not 0xD800 <= k < 0xE000]
    assert [both.a.encode_ordinary(t) for t in texts] == [x.ids for x in BYTES.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 20_000])
def test_hash_is_minimal_and_perfect(size):
    keys = np.unique(np.random.default_rng(size).integers(0, 1 << 40, size, dtype=np.uint64))
    found = MinimalHash.unpacked(MinimalHash.of(keys).packed())
    assert sorted(found(keys).tolist()) == list(range(len(keys)))


# ---------------------------------------------------------------- 12

def words(text):
    return [re.sub("[A-Z]", lambda x: x.group().lower(), w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_ranking(texts, items, top=20):
    found = [(i, Counter(words(t))) for i, t in texts]
    n = [sum(c.values()) for _, c in found]
    documents, length = sum(x > 0 for x in n), sum(n)
    df = Counter(w for _, c in found for w in c)
    for item, text in items:
        scores = []
        for (i, c), size in zip(found, n):
            score = 0
            for w, times in Counter(words(text)).items():
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[w] + 1)))
                    score += times * weight * ((10**9 * c[w]) // (1000 * c[w] + 12 * (100 - 25 + (25 * size * documents) // length)))
            if score > 0:
                scores.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            yield item, rank, i, -score


@pytest.mark.parametrize("limits", [{}, {"TERMS": 3, "CELLS": 40, "LEAF": 2}])
def test_ranking_of_odd_rows(spark, tmp_path, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ranked_search, name, value)
    texts = ODD + [(20 + k, f"same one two{k % 3}" + " here" * (k % 4)) for k in range(60)]
    items = [(1, "Same ONE"), (2, None), (3, ""), (None, "here here two1 here"), (1, "w5x5 unknown"), (4, "ünïcode no")]
    rows = ranked_search.ranked(made(spark, tmp_path, texts), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, rank int")).collect()
    assert Counter(map(tuple, rows)) == Counter(plain_ranking(texts, items))


def test_ranking_of_a_table(spark, sf_dir):
    rows = queries.queries()["op12_ranked_search"](spark, sf_dir).collect()
    texts = [(r.doc_id, r.text) for r in queries.documents(spark, sf_dir).select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert sorted(map(tuple, rows)) == sorted(plain_ranking(texts, items))


# ---------------------------------------------------------------- all

def test_empty_tables(spark, tmp_path):
    none, some = made(spark, tmp_path, []), made(spark, tmp_path, ODD, "some")
    items = spark.createDataFrame([(1, "same")], "item_id bigint, text string")
    for df in (sentence_pieces.digests(sentence_pieces.pieces_and_back(none)), alignment.alignments(none), ranked_search.ranked(none, items),
               ranked_search.ranked(some, items.limit(0))):
        assert df.count() == 0
