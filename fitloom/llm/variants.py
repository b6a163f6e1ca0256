"""Spelling variants: words one insertion, deletion or replacement apart, by two-dimensional range reporting.

Words of one length are points of a grid: their place in the order of their letters, and in the order of their
letters from the last back.  What starts with the letters before an edit is an interval of the first order, what
ends with those after it an interval of the second, and the words in both are the answer; a wavelet tree over the
second order, laid out by the first, reports them.  A replacement looks among words of the same length, an
insertion among those one longer; deletions are insertions seen from the other word.

The dictionary is cut into strips twice, by ranges of either order, with bounds from a bounded sample.  A word asks
the strips of the first order about edits from letter t on, those of the second about edits before t; t is chosen
so that both intervals lie in few strips, mostly one, so a common beginning or ending is asked about by the other
end.  Strips hold each word once, so every edit is found exactly once, wherever the bounds are.  A task holds the
words of one strip and streams what asks it.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, removed, schema, slices, stored, texts

#: Words of a strip, most strips of an order, sampled words for each bound, letters of a bound.
STRIP, STRIPS, SAMPLE, LETTERS = 8192, 8192, 32, 64
#: Distinct words after which a task sends out its counts, and letters looked at in one go.
HELD, CHUNK = 200_000, 1 << 20
_KINDS = {"strip": "int", "kind": "int", "word": "string", "n": "long", "cut": "int"}


def count_words(docs: DataFrame, least: int = 6, occurrences: int = 5, misspell: int | None = None) -> DataFrame:
    """(word, n): maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, of at least `least` code points
    that occur at least `occurrences` times in all of docs.

    Null and empty texts have no words; rows count whatever their doc_id, also if it is null or repeats.  With
    `misspell`, a run loses code point h % length where h, the crc32 of 'doc_id:run', is a multiple of it (null ids
    as empty); what is left counts."""
    run = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def count(batches):
        tally = Counter()
        for whole in batches:
            for batch in slices(whole, "text"):
                for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                    runs = Counter(run.findall(text.lower().decode("utf-8", "replace")))
                    if misspell:
                        head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                        for word, h in [(w, h) for w in runs if (h := zlib.crc32(w.encode(), head)) % misspell == 0]:
                            n, at = runs.pop(word), h % len(word)
                            if len(word) > least:
                                tally[word[:at] + word[at + 1 :]] += n
                    tally.update(runs)
            if len(tally) > HELD:
                yield _counts(tally)
                tally = Counter()
        yield _counts(tally)

    got = map_texts(docs.select("doc_id", "text"), count, schema(None, word="string", n="long"))
    return got.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _counts(tally: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())], names=["word", "n"])


class WaveletTree:
    """A permutation in bit planes, high bits first, each with its running count of ones."""

    def __init__(self, values: np.ndarray):
        self.planes = []
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            one = values >> bit & 1
            self.planes.append((bit, len(values) - int(one.sum()), np.concatenate(([0], np.cumsum(one)))))
            values = np.concatenate((values[one == 0], values[one == 1]))

    def report(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query (its number, value) of the values in least .. most - 1 at places low .. high - 1."""
        query, value = np.arange(len(low)), np.zeros(len(low), np.int64)
        for bit, zeros, ones in self.planes:
            a, b = ones[low], ones[high]
            query, value = np.concatenate((query, query)), np.concatenate((value, value | 1 << bit))
            low, high = np.concatenate((low - a, zeros + a)), np.concatenate((high - b, zeros + b))
            keep = np.flatnonzero((low < high) & (value < most[query]) & (value + (1 << bit) > least[query]))
            query, value, low, high = query[keep], value[keep], low[keep], high[keep]
        return query, value


class Grid:
    """The words of one length of a strip."""

    def __init__(self, words: list[str], n: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words, self.n = [words[k] for k in order], [n[k] for k in order]
        self.letters = _letters(self.words)
        back = sorted(range(len(words)), key=lambda k: self.words[k][::-1])
        self.back = np.array(back)  # from the place in the second order to that in the first
        place = np.empty(len(words), np.int64)
        place[self.back] = np.arange(len(words))
        self.tree = WaveletTree(place)

    def intervals(self, asked: np.ndarray, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """low and high of what starts (or ends, with reverse) with the first 0, 1, ... letters of the words asked."""
        mine = self.letters[self.back, ::-1] if reverse else self.letters
        asked = asked[:, ::-1] if reverse else asked
        steps = min(asked.shape[1], mine.shape[1])
        low, high = np.zeros((steps + 1, len(asked)), np.int64), np.zeros((steps + 1, len(asked)), np.int64)
        high[0] = len(mine)
        first, rows = np.zeros(len(mine), np.int64), np.arange(len(mine))  # first row that shares the letters so far
        for j in range(steps):
            key = first * 256 + mine[:, j]
            wanted = np.where(high[j] > low[j], low[j] * 256 + asked[:, j], -1)
            low[j + 1], high[j + 1] = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
            if (high[j + 1] <= low[j + 1]).all():
                break
            first = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), rows, 0))
        return low, high

    def near(self, asked: np.ndarray, cut: np.ndarray, after: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of a word asked, place of a word here) one replacement or, if words here are longer, one insertion
        apart, for edits from letter cut on (after) or before it."""
        length, more = asked.shape[1], self.letters.shape[1] - asked.shape[1]
        low, high = self.intervals(asked, False)
        least, most = self.intervals(asked, True)
        at = np.arange(length + more)
        back = length - 1 + more - at  # letters after the edit
        mine = (at[:, None] >= cut) if after else (at[:, None] < cut)
        # an interval of a replacement that holds one word holds the word asked, if that is here
        few = 1 + (high[length] > low[length]) if not more else np.ones(len(asked), np.int64)
        ask, who = np.nonzero(mine & (high[at] - low[at] >= few) & (most[back] - least[back] >= few))
        query, value = self.tree.report(low[ask, who], high[ask, who], least[back[ask], who], most[back[ask], who])
        at, who, found = ask[query], who[query], self.back[value]
        letter, before = self.letters[found, at], np.maximum(at - 1, 0)
        # a letter put into a run of the same letter counts at the run's start
        new = (at == 0) | (letter != asked[who, before]) if more else letter != asked[who, at]
        return who[new], found[new]


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


class _Strip:
    def __init__(self):
        self.words: dict[int, tuple[list[str], list[int]]] = {}
        self.grids: dict[int, Grid] = {}

    def add(self, words: list[str], n: list[int]) -> None:
        for word, many in zip(words, n, strict=True):
            mine = self.words.setdefault(len(word), ([], []))
            mine[0].append(word)
            mine[1].append(many)

    def answer(self, words: list[str], n: list[int], cut: list[int], after: bool):
        """Rows (word, near, n of near), as columns."""
        out: tuple[list, list, list] = ([], [], [])
        by: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by.setdefault(len(word), []).append(k)
        for length, rows in by.items():
            for other in (length, length + 1):
                if other not in self.words or self.words[other][0] == [words[rows[0]]] and len(rows) == 1:  # nothing, or itself
                    continue
                if other not in self.grids:
                    self.grids[other] = Grid(*self.words[other])
                grid, step = self.grids[other], max(1, CHUNK // length)
                for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                    who, found = grid.near(_letters([words[k] for k in part]), np.array([cut[k] for k in part]), after)
                    for w, f in zip(who.tolist(), found.tolist(), strict=True):
                        pairs = [(words[part[w]], grid.words[f], grid.n[f])]
                        if other > length:
                            pairs.append((grid.words[f], words[part[w]], n[part[w]]))
                        for pair in pairs:
                            for column, x in zip(out, pair, strict=True):
                                column.append(x)
        return out


def _cut(word: str, first: list[str], last: list[str]) -> tuple[int, range, range]:
    """Where to part the edits of a word between the orders, and the strips of either that it asks."""
    back, middle, best = word[::-1], len(word) // 2, None
    for t in sorted(range(max(1, middle - LETTERS), min(len(word), middle + LETTERS)), key=lambda t: abs(t - middle)):
        head, tail = word[:t], back[: len(word) - t]
        a, b = bisect_right(first, head), bisect_right(first, head + "\uffff")
        c, d = bisect_right(last, tail), bisect_right(last, tail + "\uffff")
        if best is None or b - a + d - c < best[0]:
            best = b - a + d - c, (t, range(a, b + 1), range(c, d + 1))
        if a == b and c == d:
            break
    return best[1]


def _bounds(words: DataFrame, strip: int) -> tuple[list[str], list[str]]:
    """Words between the strips of either order: at most STRIPS, from SAMPLE words for each."""
    total = words.count()
    strips = max(1, min(STRIPS, -(-total // strip)))
    if strips == 1:
        return [], []
    step = max(1, total // (strips * SAMPLE))
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(step)) == 0).select(F.substring("word", 1, LETTERS).alias("a"), F.substring(F.reverse("word"), 1, LETTERS).alias("b")).limit(4 * STRIPS * SAMPLE).toArrow()  # the limit only bounds the driver

    def cut(values: list[str]) -> list[str]:
        values = sorted(values)
        return sorted({values[len(values) * k // strips] for k in range(1, strips)}) if values else []

    return cut(some.column("a").to_pylist()), cut(some.column("b").to_pylist())


def near_words(words: DataFrame, strip: int = STRIP) -> DataFrame:
    """(word, near, near_n), one row for each ordered pair of words that differ by one edit.

    words has distinct words of two code points or more, all below U+0100, and their n."""
    first, last = _bounds(words, strip)
    ours = len(first) + 1

    def deal(batches):
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                t, some, others = _cut(word, first, last)
                rows += [(bisect_right(first, word), 0, word, n, 0), (ours + bisect_right(last, word[::-1]), 0, word, n, 0)]
                rows += [(s, 1, word, n, t) for s in some] + [(ours + s, 1, word, n, t) for s in others]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32()), strict=True)], names=list(_KINDS))

    def work(batches):
        now, held = None, _Strip()
        for batch in batches:
            strips, kinds = batch.column("strip").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(strips) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(strips)], strict=True):
                if a == b:
                    continue
                if strips[a] != now:
                    now, held = strips[a], _Strip()
                word, n, cut = (batch.column(c).slice(a, b - a).to_pylist() for c in ("word", "n", "cut"))
                if not kinds[a]:
                    held.add(word, n)
                    continue
                got = held.answer(word, n, cut, now < ours)
                yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.string()), pa.array(got[1], pa.string()), pa.array(got[2], pa.int64())], names=["word", "near", "near_n"])

    dealt = words.select("word", "n").mapInArrow(deal, schema(None, **_KINDS))
    dealt = dealt.repartition(ours + len(last) + 1, "strip").sortWithinPartitions("strip", "kind")
    return dealt.mapInArrow(work, schema(None, word="string", near="string", near_n="long"))


def grouped(words: DataFrame, factor: int = 5, strip: int = STRIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n): form is the near word of largest n (ties: least in code-point order)
    if that is at least `factor` times the word's n, which makes forms acyclic; root is the last of the forms
    from a word, itself if it has none.  Words as near_words() takes them; none give an empty table."""
    spark = words.sparkSession
    words, _ = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = near_words(words, strip).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    has = -F.col("best.n") >= F.col("n") * factor
    found, _ = stored(words.join(near, "word", "left").select("word", F.when(has, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, -F.col("best.n")).alias("form_n")), "forms")
    to, path = stored(found.where("form is not null").select("word", F.col("form").alias("to"), F.lit(True).alias("moved")), "roots")
    while not to.where("moved").isEmpty():
        on = to.select(F.col("word").alias("to"), F.col("to").alias("next"))
        old, (to, path) = path, stored(to.join(on, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "roots")
        removed(spark, old)
    return found.join(to.select("word", F.col("to").alias("root")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
