"""The parts that run inside tasks, against plain versions."""

import random

import numpy as np
import pytest

from tallyloom.llm import decontaminate, lm_scoring, mixing, near_dedup, textnp, token_counts, toxicity


def greedy(word, first, rest):
    n, at, allowed = 0, 0, first
    while at < len(word):
        end = next((k for k in range(len(word), at, -1) if word[at:k] in allowed), None)
        if end is None:
            return 0
        n, at, allowed = n + 1, end, rest
    return n


def test_longest_match_counts():
    rng = random.Random(1)

    def some(n, size):
        return {"".join(rng.choices("abc", k=rng.randint(1, size))) for _ in range(n)}
    for _ in range(100):
        first, rest = some(6, 4), some(6, 4)
        automaton = token_counts.PieceAutomaton(sorted(first), sorted(rest))
        for word in some(40, 12):
            assert automaton.count(word) == greedy(word, first, rest)


def greedy_file(word, names, spelled):
    """Longest match over the pieces of the file as they are, from the marked word on."""
    line, n, at = "▁" + word, 0, 0
    while at < len(line):
        end = next((k for k in range(min(len(line), at + 40), at, -1) if line[at:k] in names), None)
        if end is None and not spelled:
            return 0
        n, at = (n + 1, end) if end else (n + len(line[at].encode()), at + 1)
    return n


def test_counts_against_the_raw_file():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.VOCABULARY)
    size = range(model.get_piece_size())
    names = {model.id_to_piece(i) for i in size if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    spelled = token_counts.has_bytes()
    assert spelled == all(f"<0x{b:02X}>" in {model.id_to_piece(i) for i in size} for b in range(256))
    automaton = token_counts.PieceAutomaton(*token_counts.pieces(), spelled)
    words = ["2024", "7" * 5000, "ñandú", "Ünder", "Ωmega", "the", "x😀y", "\U00012345", "a\U00012345b", "È", "9th", "-", "日本語", "don't", "_"]
    for word in words:
        assert automaton.count(word) == greedy_file(word, names, spelled) > 0, word[:20]


def test_bare_mark_and_bytes_against_greedy():
    rng = random.Random(8)
    for spelled in (False, True):
        for _ in range(100):
            names = {"▁"} | {rng.choice(["▁", ""]) + "".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(9)}
            automaton = token_counts.PieceAutomaton(sorted(n[1:] for n in names if n[0] == "▁"), sorted(n for n in names if n[0] != "▁"), spelled)
            for _ in range(40):
                word = "".join(rng.choices("abcdé", k=rng.randint(1, 10)))
                assert automaton.count(word) == greedy_file(word, names, spelled), (names, word)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_levenshtein_automaton():
    rng = random.Random(2)
    terms = [(t, False, 1.0) for t in ("abcabca", "bcabca", "cab", "abcabcabcab", "aaaaaab")] + [("bca", True, 1.0), ("acc", True, 1.0)]
    automaton = toxicity.TermAutomaton(terms)
    for _ in range(5000):
        w = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        whole = [distance(w[1:], t[1:]) for t, stem, _ in terms
                 if not stem and w[0] == t[0] and distance(w[1:], t[1:]) <= toxicity.edits_allowed(t)]
        stems = [k for k, (t, stem, _) in enumerate(terms) if stem and w.startswith(t)]
        got = automaton.read(w)
        if whole:
            assert got[1] == min(whole)
        elif stems:
            assert got[0] in stems and got[1] == 0
        else:
            assert got is None


def test_quotation_counts_apart():
    automaton = toxicity.TermAutomaton([("worthless", False, 1.0)])
    plain, typo = toxicity.features("you are worthless", automaton), toxicity.features("so wrothless but worthles", automaton)
    quoted = toxicity.features('the word "worthless" was removed', automaton)
    assert plain[0] > 0 and plain[2] == 0 and plain[3] > 0
    assert typo[1] > 0 and typo[0] == 0
    assert quoted[2] > 0 and quoted[0] == 0
    assert toxicity.features(None, automaton) == [0.0] * toxicity.FEATURES


def test_edits_at_any_letter():
    rng = random.Random(5)
    texts = ("abcabca", "bcabca", "cab", "abcabcabcab", "aaaaab", "ccbaa")
    automaton = toxicity.TermAutomaton([(t, False, 1.0) for t in texts], anywhere=True)
    for _ in range(5000):
        w = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        near = [d for t in texts if (d := distance(w, t)) <= toxicity.edits_allowed(t)]
        got = automaton.read(w)
        assert (got and got[1]) == (min(near) if near else None)


def test_learned_words_stand_beside_stems():
    words = "disgusting idiot trash pathetic".split()
    counts = [("", [1000, 100, 1000, 100])]
    for w in words:
        counts += [(w + "$", [0, 20, 0, 20])] + [(w[:k], [0, 20, 0, 20]) for k in toxicity.STEMS if k <= len(w)]
    counts += [("grum$", [0, 4, 0, 4]), ("grum", [0, 30, 0, 30])]  # many rare words with one beginning
    terms = toxicity.lexicon(toxicity.learned_terms(counts)[0])
    assert set(words) | set(toxicity.SEED_TERMS) <= {t for t, stem, _ in terms if not stem}
    assert [t for t, stem, _ in terms if stem] == ["grum"]
    automaton = toxicity.TermAutomaton(terms, anywhere=True)
    for typo, word in {"dsgusting": "disgusting", "patehtic": "pathetic", "idiots": "idiot", "xdiot": "idiot", "diot": "idiot",
                       "trrash": "trash", "wortless": "worthless"}.items():
        hit = automaton.read(typo)
        assert (hit and automaton.terms[hit[0]][0]) == word, typo
    for clean in "disguise path pathway ideology tradition worth worthy".split():
        assert automaton.read(clean) is None, clean
    assert automaton.read("grumble") is not None


def test_bit_parallel_lcs():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, n))] for n in (20, 30))
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
        masks = {}
        for k, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << k
        assert decontaminate.lcs(masks, len(a), b) == row[-1]


def test_terms_that_share_a_slot():
    h = np.array([5, 5 + decontaminate.TABLE, 5 + 2 * decontaminate.TABLE, 9], np.uint64)
    terms = decontaminate.Terms(h)
    assert terms.hashes[terms(h)].tolist() == h.tolist()
    assert terms(np.array([6, 5 + 3 * decontaminate.TABLE], np.uint64)).tolist() == [-1, -1]


def test_sketch_fills_and_estimates():
    sketcher, rng = near_dedup.Sketcher(48, 6), np.random.default_rng(1)
    a = rng.integers(0, 2**64, 400, dtype=np.uint64)
    b = np.concatenate([a[:360], rng.integers(0, 2**64, 40, dtype=np.uint64)])
    for part in (a[:1], a[:3], a):
        assert (sketcher.sketch(part) < np.uint64(2**64 - 1)).all()
    assert abs((sketcher.sketch(a) == sketcher.sketch(b)).mean() - 360 / 440) < 0.08


def test_word_and_shingle_hashes():
    assert textnp.word_hashes(b"A b\t\xc3\x89 a").tolist() == textnp.word_hashes(b" a  B \xc3\x89\na ").tolist()
    assert textnp.word_hashes("É".encode()).tolist() != textnp.word_hashes("é".encode()).tolist()
    assert len(textnp.shingle_set(b"", 4)) == 0 and len(textnp.shingle_set(b" \n", 4)) == 0
    assert len(textnp.shingle_set(b"a b", 4)) == 1 and len(textnp.shingle_set(b"a b c d e", 4)) == 2
    assert len(textnp.shingle_set(b"a a a a a a", 4)) == 1


def test_gradients():
    rng = np.random.default_rng(1)
    model = {k: v.astype(float) for k, v in lm_scoring.initial(rng.integers(1, 99, lm_scoring.V).astype(float)).items()}
    context, target = rng.integers(0, lm_scoring.V + 1, (7, 4)), rng.integers(0, lm_scoring.V, 7)

    class Grads(lm_scoring.Trainer):
        def __init__(self, model):
            self.model, self.found = model, {}

        def _dense(self, name, grad):
            self.found[name] = grad

        def _by_row(self, name, rows, grad):
            self.found[name] = np.zeros_like(self.model[name])
            np.add.at(self.found[name], rows, grad)

    def loss():
        return -lm_scoring.log_p(model, context, target).mean()
    grads = Grads(model)
    grads.step(context, target)
    for name, grad in grads.found.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        model[name][at] += 1e-5
        up = loss()
        model[name][at] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(grad[at], rel=1e-4)
        model[name][at] += 1e-5


def test_temperature():
    tokens = {"a": 1000, "b": 100, "c": 10, "d": 0}
    t, w = mixing.weights(tokens, 4.0, 1.0)
    ratio = [w[s] / (tokens[s] / 1110) for s in w]
    assert sum(w.values()) == pytest.approx(1) and max(ratio) / min(ratio) == pytest.approx(4, rel=1e-6) and 0 < t < 1
    assert mixing.weights({"a": 5, "b": 5}, 2.0, 1.0)[1] == {"a": 0.5, "b": 0.5}
    assert mixing.weights({}, 2.0)[1] == {}


def test_softmax_far_from_zero():
    """Logits beyond the range of the exponential give the same log p as in exact steps."""
    rng = np.random.default_rng(3)
    for shift in (0.0, 50.0, 500.0, -500.0):
        z = rng.normal(0, 3, (40, 9)).astype(np.float32) + np.float32(shift)
        digit = rng.integers(0, 9, 40)
        wide = z.astype(float)
        p = np.exp(wide - wide.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        got, log_p = lm_scoring._softmax(z.copy(), digit, 0.5)
        assert np.allclose(got, p / 2, atol=1e-5) and np.allclose(log_p, np.log(p[np.arange(40), digit]), atol=1e-3)
        assert lm_scoring._softmax(z.copy(), digit, 0.0)[0] is None


def test_vocabulary_lookup():
    words = [f"word{k}".encode() for k in range(3000)]
    known = lm_scoring.Vocabulary(words, np.ones(3001), np.ones(257))
    text = b" ".join([*words, b"unseen", b"word3000"])
    assert known(text)[0].tolist() == [*range(1, 3001), 0, 0]
    assert known(text, spelling=False)[1] == 0.0 > known(text)[1]
    none = lm_scoring.Vocabulary([], np.ones(1), np.ones(257))
    assert none(b"any words")[0].tolist() == [0, 0]


def test_rows_beyond_sixteen_bits():
    """Row updates of a table of more than 65,536 rows equal sums by row."""
    trainer = lm_scoring.Trainer({"E": np.zeros((200_000, 2), np.float32)})
    rows = np.array([5, 70_000, 5, 131_077, 65_541, 70_000, 199_999])
    grad = np.arange(14, dtype=np.float32).reshape(7, 2)
    trainer._by_row("E", rows, grad)
    for row in set(rows.tolist()):
        total = grad[rows == row].sum(axis=0)
        assert np.allclose(trainer.model["E"][row], -lm_scoring.RATE * total / np.sqrt(0.1 + (total**2).mean()))
    assert np.count_nonzero(trainer.model["E"].any(axis=1)) == 5
