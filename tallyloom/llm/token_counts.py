"""Word-piece token counts by linear longest-match, without building a piece.

The vocabulary is a trie with two roots (pieces that begin a word, pieces that continue one).  Every node has a failure link:
where longest-match continues if the node has no child for the next character, and the number of pieces popped on the way.  A
word is thus counted in one pass over its characters, however long it is.  The bare mark is a beginning piece too (the empty string), after
which continuing pieces follow.  A character without a piece is counted as its UTF-8 byte pieces if the file holds all 256 of
them; if not, a word with such a character is one unknown token.

The vocabulary comes from a public tokenizer file (path a parameter); it has a fixed size and travels with the task.
"""

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import small_batches

VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
WORD = re.compile(r"[^\s▁]+")


def pieces(path: str = VOCABULARY) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, of a sentence-piece model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    first = sorted({n[1:] for n in names if n.startswith(MARK) and MARK not in n[1:]})
    return first, sorted({n for n in names if MARK not in n})


def has_bytes(path: str = VOCABULARY) -> bool:
    """Whether the file holds a piece for every byte."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(model.is_byte(i) for i in range(model.get_piece_size())) == 256


class PieceAutomaton:
    """Counts greedy longest-match pieces of a word: first a beginning piece, then continuing ones.

    An empty string in ``first`` is the bare mark.  ``spelled``: a character without a piece counts as its bytes.
    """

    def __init__(self, first: list[str], rest: list[str], spelled: bool = False):
        self.spelled = spelled
        self.go: list[dict[str, int]] = [{}, {}]  # 0: start of a word, 1: after a piece
        piece = [0, 0]  # tokens of the piece that ends here
        for root, words in ((0, first), (1, rest)):
            for word in words:
                node = root
                for c in word:
                    if c not in self.go[node]:
                        self.go[node][c] = len(self.go)
                        self.go.append({})
                        piece.append(0)
                    node = self.go[node][c]
                piece[node] = 1
        if spelled:
            piece[0] = piece[0] or len(MARK.encode())
            for c in sorted({c for word in (*first, *rest) for c in word}):
                if c not in self.go[1]:
                    self.go[1][c] = len(self.go)
                    self.go.append({})
                    piece.append(0)
                piece[self.go[1][c]] = piece[self.go[1][c]] or len(c.encode())
        self.fail = [-1] * len(self.go)
        self.pops = [0] * len(self.go)
        if piece[0]:  # the bare mark is popped where no other beginning piece fits
            self.fail[0], self.pops[0] = 1, piece[0]
        queue = [(root, child, c) for root in (0, 1) for c, child in self.go[root].items()]
        for parent, node, c in queue:
            if piece[node]:
                self.fail[node], self.pops[node] = 1, piece[node]
            else:
                back, popped = self.fail[parent], self.pops[parent]
                while back >= 0 and c not in self.go[back]:
                    popped += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = self.go[back][c], popped
            queue.extend((node, child, x) for x, child in self.go[node].items())
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the word, 0 if some rest of it is in no piece."""
        known = self.known.get(word)
        if known is not None:
            return known
        go, fail, pops = self.go, self.fail, self.pops
        node = total = 0
        for c in word:
            while c not in go[node]:
                if node == 1 and self.spelled:
                    break
                total += pops[node]
                node = fail[node]
                if node < 0:
                    break
            if node < 0:
                break
            if c not in go[node]:
                total += len(c.encode("utf-8", "replace"))
            else:
                node = go[node][c]
        while node > 1:
            total += pops[node]
            node = fail[node]
        out = total if node == 1 else 0
        if len(word) <= 32:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[word] = out
        return out


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown (words that became one unknown token); null and empty texts count 0.

    Words are runs without white space; one row per row of ``docs``.
    """
    small_batches(docs.sparkSession)
    first, rest = pieces(vocabulary)
    spelled = has_bytes(vocabulary)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = PieceAutomaton(first, rest, spelled)
        for texts in series:
            out = []
            for text in texts:
                words = WORD.findall(text or "")
                counts = [automaton.count(w) for w in words]
                unknown = counts.count(0)
                out.append((len(words), sum(counts) + unknown, unknown))
            yield pd.DataFrame(out, columns=["n_words", "n_tokens", "n_unknown"])
    counted = F.pandas_udf(run, "n_words bigint, n_tokens bigint, n_unknown bigint")
    return docs.select("doc_id", counted(F.col("text").cast("string")).alias("c")).select("doc_id", "c.*")
