"""Token counts of a unigram tokenizer by a count-only Viterbi.

An Aho-Corasick automaton over the vocabulary gives the pieces that end at each character of a word;
dynamic programming carries (best score, pieces) and no path.  Tie rules are those of the tokenizers
library's Unigram: a later candidate replaces one only if its score is strictly greater, and
candidates for a place come in the order of their starts, so of equal scores the longest last piece
wins; a character without a piece of its own scores 10 below the least piece, and stands for its
UTF-8 bytes.  Pieces never cross the mark that stands for a blank, so words are counted one by one.
"""

from __future__ import annotations

from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import map_texts, schema, slices, with_columns

MARK = "▁"
UNKNOWN = 10.0
_CACHE = 250_000


def vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores in id order, and the id of the unknown piece, of a sentencepiece model file."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size())], p.unk_id()


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0):
        self.auto = ahocorasick.Automaton()
        self.single, self.spelled = set(), pieces[unknown][0] if 0 <= unknown < len(pieces) else ""
        for k, (piece, score) in enumerate(pieces):
            if piece:  # only the unknown piece pays in bytes
                self.auto.add_word(piece, (len(piece), score, len(piece.encode()) if k == unknown else 0))
                if len(piece) == 1:
                    self.single.add(piece)
        self.auto.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN
        self.cache: dict[str, tuple[int, float]] = {}
        self.older: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of one word, its mark included.  A run of unknown characters counts its bytes."""
        n = len(word)
        if self.single.issuperset(word) and not (self.spelled and self.spelled in word):  # no unknown piece can win
            best, count, width = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
            for end, (size, score, _) in self.auto.iter(word):
                at, end = end + 1 - size, end + 1
                value, w = best[at] + score, width[end]
                if not w or value > best[end] or (value == best[end] and size > w):
                    best[end], count[end], width[end] = value, count[at] + 1, size
            return count[n], best[n]
        ends: list[list[tuple[int, float, int]]] = [[] for _ in range(n)]
        for end, piece in self.auto.iter(word):
            ends[end].append(piece)
        best, count, run = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for e in range(n):
            found = sorted(ends[e], reverse=True)
            top, last = None, (0, 0.0, 0)
            if word[e] not in self.single:
                found.append((1, self.unknown, len(word[e].encode())))
            for piece in found:
                value = best[e + 1 - piece[0]] + piece[1]
                if top is None or value > top:
                    top, last = value, piece
            size, _, pays = last
            at = e + 1 - size
            best[e + 1], count[e + 1] = top, count[at] + (pays or 1)
            if pays and size > 1 and not run[at]:  # the unknown piece by itself is one piece
                count[e + 1], run[e + 1] = count[at] + 1, pays
            elif pays:  # in a run of unknowns it counts its bytes, and so does one before
                count[e + 1], run[e + 1] = count[at] + pays + max(0, run[at] - 1), 1
        return count[n], best[n]

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and score of a whole text."""
        if not text:
            return 0, 0.0
        text = text.replace(" ", MARK)
        words = (text[1:] if text[0] == MARK else text).split(MARK)
        got = list(map(self.cache.get, words))
        if None in got:
            got = [self._miss(w) if g is None else g for g, w in zip(got, words, strict=True)]
        counts, scores = zip(*got, strict=True)
        return sum(counts), float(sum(scores))

    def _miss(self, word: str) -> tuple[int, float]:
        """From the older words, or anew; the cache has two generations of bounded size."""
        got = self.older.get(word)
        if got is None:
            got = self.word(MARK + word)
        if len(word) <= 64:
            if len(self.cache) >= _CACHE:
                self.older, self.cache = self.cache, {}
            self.cache[word] = got
        return got


@cache
def counter(path: str) -> Counter:
    return Counter(*vocabulary(path))


def count_tokens(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """docs with n_tokens (long) and score (double) of `column` under the vocabulary in `path`.

    Null and empty texts have no tokens and score 0.  Columns of docs of these names are replaced;
    rows stand alone, so repeats and ties don't matter.
    """

    def run(batches):
        count = counter(path)
        for whole in batches:
            for batch in slices(whole, column):
                rows = [count.text(t or "") for t in batch.column(column).to_pylist()]
                yield with_columns(batch, n_tokens=pa.array([r[0] for r in rows], pa.int64()), score=pa.array(np.array([r[1] for r in rows], np.float64)))

    return map_texts(docs, run, schema(docs, n_tokens="long", score="double"))
