"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers and number words one token, units another, words with a capital
that don't start a sentence or line a third, all else its lower case without outer punctuation.  A second
view of each text doesn't look at lines and sentences: there every word with a capital is a name.  In a third
one neighbouring slots of a kind with no punctuation between them make one slot besides.

Each window of WINDOW tokens has a key: the hash of its template, or of its words themselves if it has too
few tokens outside slots to be evidence, so that slots alone match nothing but the same values.  Windows of
a benchmark item are joined by key with those of documents, view by view: only the item's rarest ones, as
an item that is held in a share s of its windows can't miss more than 1 - s of them.  On each line of
alignment (document place minus item place) that they give, all windows are compared, and the slots that
equal ones cover must translate consistently: one item value always to one document value.  A document
holds an item if consistent windows make up at least `share` of the item's windows in one of the views.
An item of fewer than WINDOW words is held only by a document of just its words.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .frames import map_texts, schema, slices, stored, texts, with_columns

# Number words and units that make slots.
NUMBER_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion"]
UNITS = ["mm", "cm", "km", "mg", "kg", "lb", "oz", "ml", "mph", "kmh", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "mile", "miles", "foot", "feet", "inch", "inches", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent"]

WINDOW = 5
#: Tokens outside slots that a window needs for its slots to take other values than the item's, view by view.
PLAIN = (1, 2, 2)
SHARE = 0.8
#: Counters of window keys, by hash, that order them by rarity; bits of the filter that documents' keys pass before a
#: shuffle.  Neither number depends on the data.
COUNTERS, BITS = 1 << 18, 1 << 25
#: Windows of benchmark items that may be broadcast (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST = 1 << 20

#: Bytes that may stand in a number, and that end a sentence; ASCII letters, digits and bytes of other scripts are inside words.
_FIGURE = np.zeros(256, bool)
_FIGURE[list(b"0123456789.,:/%+-$")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:")] = True
_INNER = np.zeros(256, bool)
_INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), 37, 36, 95]] = True


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(tx.Words([w.encode() for w in words]).hashes())


_NUM, _UNIT, _NAME = (tx.mix(np.arange(k, k + 1, dtype=np.uint64))[0] for k in (11, 12, 13))


class Template:
    """Of several texts: for each word a template hash, the hash of its plain form (outer punctuation
    off, A-Z and Latin-1 capitals lowered), and whether it is a slot; views has all views."""

    def __init__(self, raw: list[bytes]):
        w = self.words = tx.Words(raw)
        data = w.data
        # capitals of two bytes are C3 80 to C3 9E
        second = np.concatenate(([False], data[:-1] == 0xC3)) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97) if len(data) else np.zeros(0, bool)
        capital = ((data >= 65) & (data <= 90)) | np.concatenate((second[1:], [False]))[: len(data)]
        start, end = w.start.copy(), w.end.copy()
        first, last = w.start, w.end
        n = len(start)
        stops = np.zeros(n, bool)
        if n:
            stops = _STOP[data[last - 1]] | ((last - first > 1) & _STOP[data[np.maximum(last - 2, 0)]])
        todo = np.arange(n)  # words whose ends may still be outer punctuation
        while len(todo):
            todo = todo[(start[todo] < end[todo]) & ~_INNER[data[np.minimum(start[todo], len(data) - 1)]]]
            start[todo] += 1
        todo = np.arange(n)
        while len(todo):
            todo = todo[(start[todo] < end[todo]) & ~_INNER[data[end[todo] - 1]]]
            end[todo] -= 1
        lines = np.concatenate(([0], np.cumsum(data == 10, dtype=np.int32)))
        begins = np.ones(n, bool)
        if n:
            begins[1:] = stops[:-1] | (lines[first[1:]] > lines[last[:-1]])
            begins[w.bounds[:-1][w.counts > 0]] = True
        figures, digits = (np.concatenate(([0], np.cumsum(t[data], dtype=np.int32))) for t in (_FIGURE, _DIGIT))
        number = (figures[end] - figures[start] == end - start) & (digits[end] > digits[start])
        upper = (end > start) & capital[np.minimum(start, max(0, len(data) - 1))] if n else np.zeros(0, bool)
        w.data = tx._LOWER[data] + np.where(second, 0x20, 0).astype(np.uint8)
        w.start, w.end = start, end
        self.plain = w.hashes()
        w.start, w.end = first, last
        number |= _member(self.plain, _NUMBERS)
        unit = _member(self.plain, _UNIT_SET) & ~number
        title = upper & ~number & ~unit
        fixed = np.where(number, _NUM, np.where(unit, _UNIT, self.plain))
        self.views = [View(np.where(name, _NAME, fixed), self.plain, number | unit | name, w.bounds) for name in (title & ~begins, title)]
        touch = np.zeros(n, bool)  # words with no punctuation between them and the word before
        if n:
            touch[1:] = (end[:-1] == last[:-1]) & (start[1:] == first[1:])
            touch[w.bounds[:-1][w.counts > 0]] = False
        self.views.append(self.views[1].merged(touch))

    def whole(self, i: int) -> bytes | None:
        """The words of text i if it has any but fewer than WINDOW."""
        a, b = self.words.bounds[i], self.words.bounds[i + 1]
        return self.plain[a:b].tobytes() if 0 < b - a < WINDOW else None


class View:
    """One reading of several texts: for each token its template hash, its value, whether it is a slot and its words."""

    def __init__(self, tokens: np.ndarray, value: np.ndarray, slot: np.ndarray, bounds: np.ndarray, size: np.ndarray | None = None):
        self.tokens, self.value, self.slot, self.bounds = tokens, value, slot, bounds
        self.size = np.ones(len(tokens), np.int64) if size is None else size

    def merged(self, touch: np.ndarray) -> View:
        """Runs of slots of one kind that touch as one slot, whose value is that of all their words in order."""
        joins = touch & self.slot
        joins[1:] &= self.tokens[1:] == self.tokens[:-1]
        head = np.flatnonzero(~joins)
        size = np.diff(np.append(head, len(joins)))
        value = self.value[head]
        long = np.flatnonzero(size > 1)
        if len(long):
            m = size[long]
            to = np.concatenate(([0], np.cumsum(m)[:-1]))
            k = np.arange(m.sum()) - np.repeat(to, m)
            value[long] = np.add.reduceat(tx.mix(self.value[np.repeat(head[long], m) + k] + (k + 1).astype(np.uint64) * tx._ODD), to)
        return View(self.tokens[head], value, self.slot[head], np.searchsorted(head, self.bounds), size)

    def keys(self, view: int) -> np.ndarray:
        """The key of each window, across the bounds of texts too."""
        if len(self.tokens) < WINDOW:
            return np.zeros(0, np.uint64)
        plain = np.concatenate(([0], np.cumsum(~self.slot)))
        free = plain[WINDOW:] - plain[:-WINDOW] >= PLAIN[view]
        return np.where(free, tx.windows(self.tokens, WINDOW), tx.mix(tx.windows(self.value, WINDOW)))


def _member(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of many hashes are in a small sorted set: a table of 16 bits first, then a search."""
    table = np.zeros(1 << 16, bool)
    table[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    out = table[(h & np.uint64(0xFFFF)).astype(np.int64)]
    at = np.flatnonzero(out)
    if len(at):
        place = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
        out[at] = known[place] == h[at]
    return out


_NUMBERS, _UNIT_SET = _hashes(NUMBER_WORDS), _hashes(UNITS)


def consistent(item: np.ndarray, doc: np.ndarray) -> bool:
    """Whether each slot value of the item has one value of the document along an alignment."""
    there: dict[int, int] = {}
    return all(there.setdefault(a, b) == b for a, b in zip(item.tolist(), doc.tolist(), strict=True))


class Item:
    """One view of a benchmark item of WINDOW tokens or more."""

    def __init__(self, item_id: int, view: int, t: View, share: float):
        self.id, self.view = item_id, view
        self.value, self.slot, self.size, self.keys = t.value, t.slot, t.size, t.keys(view)
        self.few = len(self.keys) - math.ceil(share * len(self.keys) - 1e-9) + 1

    def rarest(self, counts: np.ndarray) -> np.ndarray:
        """Places of windows of which a document that holds the item has one, by counters of keys."""
        return np.lexsort((self.keys, counts[(self.keys % np.uint64(COUNTERS)).astype(np.int64)]))[: self.few]

    def check(self, keys: np.ndarray, value: np.ndarray, size: np.ndarray, shift: int, share: float) -> float:
        """Share of the item's windows on one alignment with consistent slots; 0 below `share`.
        keys, value and size are of one document."""
        low, high = max(0, -shift), min(len(self.keys), len(keys) - shift)
        at = low + np.flatnonzero(self.keys[low:high] == keys[low + shift : high + shift]) if high > low else ()
        got = len(at) / len(self.keys)
        if got < share:
            return 0.0
        cover = np.flatnonzero(tx.spread(at, WINDOW, len(self.slot)) & self.slot)
        # a slot at the item's edge may have grown together with words around the item
        edge = ((cover == 0) | (cover == len(self.slot) - 1)) & (size[cover + shift] > self.size[cover])
        cover = cover[~edge]
        return got if consistent(self.value[cover], value[cover + shift]) else 0.0


def views(item_id: int, text: str, share: float) -> tuple[list[Item], bytes | None]:
    """The views of an item that have windows, and its words if they are fewer than WINDOW."""
    t = Template([text.encode()])
    return [Item(item_id, k, v, share) for k, v in enumerate(t.views) if len(v.tokens) >= WINDOW], t.whole(0)


def counters(keys: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    return np.bincount((every % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)


class Bench:
    """Benchmark items with their rarest windows as a sorted table of each view."""

    def __init__(self, items: list[tuple[int, str]], counts: np.ndarray | None, share: float):
        self.share, self.whole, self.items = share, defaultdict(list), []
        for i, text in items:
            found, words = views(i, text, share)
            self.items += found
            if words:
                self.whole[words].append(i)
        counts = counters([x.keys for x in self.items]) if counts is None else counts
        self.tables = {}
        for v in {x.view for x in self.items}:
            own = [(k, x.rarest(counts)) for k, x in enumerate(self.items) if x.view == v]
            key = np.concatenate([self.items[k].keys[at] for k, at in own])
            which, place = np.repeat([k for k, _ in own], [len(at) for _, at in own]), np.concatenate([at for _, at in own])
            order = np.argsort(key, kind="stable")
            self.tables[v] = key[order], which[order], place[order]

    def find(self, t: Template, n: int) -> tuple[list[list[int]], list[float]]:
        """Of n texts the items that each holds, and the largest share."""
        found, top = [set() for _ in range(n)], [0.0] * n
        if self.whole:
            for r in np.flatnonzero((t.words.counts > 0) & (t.words.counts < WINDOW)).tolist():
                if some := self.whole.get(t.whole(r)):
                    found[r].update(some)
                    top[r] = 1.0
        for v, (known, which, place) in self.tables.items():
            view = t.views[v]
            keys, bounds = view.keys(v), view.bounds
            at = np.flatnonzero(_member(keys, known) & tx.inside(bounds, WINDOW, len(view.tokens)))
            if not len(at):
                continue
            low, high = np.searchsorted(known, keys[at]), np.searchsorted(known, keys[at], "right")
            many = high - low
            of = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            row = np.repeat(np.searchsorted(bounds, at, "right") - 1, many)
            shift = np.repeat(at, many) - bounds[row] - place[of]
            for r, k, s in np.unique(np.stack((row, which[of], shift), 1), axis=0).tolist():
                a, b = bounds[r], bounds[r + 1]
                got = self.items[k].check(keys[a : b - WINDOW + 1], view.value[a:b], view.size[a:b], s, self.share)
                if got:
                    found[r].add(self.items[k].id)
                    top[r] = max(top[r], got)
        return [sorted(f) for f in found], top


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """docs with items (ids of the benchmark items it holds, ascending), coverage (the largest share) and kept.

    kept is false if there are items.  Null and empty texts hold nothing; null or empty items are
    ignored, as is an item without words; items of fewer than WINDOW words are held by documents of just
    these words.  Items of one text each count; repeated rows of either table change nothing for other
    rows.  A column of docs with one of the three names is replaced.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and trim(text) <> ''").distinct()
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if size // 2 <= BROADCAST:  # a word and its blank take two characters at least
        return _broadcast(docs, Bench([tuple(r) for r in items.collect()], None, share))
    return _shuffled(docs, items, share)


def _found(batch: pa.RecordBatch, found: list[list[int]], top: list[float], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    return with_columns(batch, drop, items=pa.array(found, pa.list_(pa.int64())), coverage=pa.array(top, pa.float64()), kept=pa.array([not f for f in found], pa.bool_()))


def _broadcast(docs: DataFrame, bench: Bench) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(bench)  # BROADCAST windows at most

    def run(batches):
        known = sent.value
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                yield _found(batch, *known.find(Template(texts(batch.column("text"))), batch.num_rows))

    return map_texts(docs, run, schema(docs, items="array<long>", coverage="double", kept="boolean"))


def _shuffled(docs: DataFrame, items: DataFrame, share: float) -> DataFrame:
    """The same with the rarest windows of items joined by a shuffle; the join brings the texts of items
    that share one with a document.  Only keys that a filter of BITS bits lets through are shuffled."""
    spark = docs.sparkSession

    def batch_of(**columns):
        kinds = {"binary": pa.binary(), "long": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for k, x in columns.values()], names=list(columns))

    def count(batches):
        for batch in batches:
            keys = [x.keys for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for x in views(i, t, share)[0]]
            counts = counters(keys)
            slot = np.flatnonzero(counts)
            yield batch_of(slot=("long", slot), many=("long", counts[slot]))

    got = map_texts(items, count, schema(None, slot="long", many="long")).groupBy("slot").agg(F.sum("many").alias("many")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[got.column("slot").to_numpy()] = got.column("many").to_numpy()
    ranks = spark.sparkContext.broadcast(counts)  # COUNTERS numbers

    def of_items(batches):
        for batch in batches:
            own, view, key = [], [], []
            for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found, words = views(i, text, share)
                for v, keys in [(x.view, np.unique(x.keys[x.rarest(ranks.value)])) for x in found] + ([(len(PLAIN), _whole_key(words))] if words else []):
                    own += [i] * len(keys)
                    view += [v] * len(keys)
                    key.append(keys.view(np.int64))
            yield batch_of(item_id=("long", own), view=("long", view), key=("long", np.concatenate(key) if key else []))

    grams, _ = stored(map_texts(items, of_items, schema(None, item_id="long", view="long", key="long")), "windows")
    slot = F.pmod("key", F.lit(BITS))
    bits = grams.select((slot / 64).cast("long").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(pmod(key, {BITS}), 64) as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(BITS // 64, np.int64)
    table[bits.column("at").to_numpy()] = bits.column("bits").to_numpy()
    passes = spark.sparkContext.broadcast(table)  # BITS bits

    def let_by(keys: np.ndarray) -> np.ndarray:
        at = keys % BITS
        return keys[passes.value[at // 64] >> (at % 64) & 1 == 1]

    def of_docs(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                for d, raw in zip(batch.column("__row").to_pylist(), texts(batch.column("text")), strict=True):
                    t = Template([raw])
                    views_ = [x.keys(v) for v, x in enumerate(t.views)]
                    words = t.whole(0)
                    for v, keys in enumerate([*views_, _whole_key(words)] if words else views_):
                        some = let_by(np.unique(keys).view(np.int64))
                        if len(some):
                            yield batch_of(__row=("binary", [d] * len(some)), view=("long", [v] * len(some)), key=("long", some))

    def decide(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                found, top = [], []
                for raw, some in zip(texts(batch.column("text")), batch.column("__items").to_pylist(), strict=True):
                    (one,), (best,) = Bench([(x["item_id"], x["text"]) for x in some], None, share).find(Template([raw]), 1) if some else (([],), (0.0,))
                    found.append(one)
                    top.append(best)
                yield _found(batch, found, top, ("__row", "__items"))

    keyed = docs.withColumn("__row", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    seen = map_texts(keyed.select("__row", "text"), of_docs, schema(None, __row="binary", view="long", key="long"))
    pairs = seen.join(grams, ["view", "key"]).select("__row", "item_id").distinct().join(items, "item_id")
    brought = pairs.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("item_id", "text"))).alias("__items"))
    out = keyed.join(brought, "__row", "left")
    return map_texts(out, decide, schema(docs, items="array<long>", coverage="double", kept="boolean"))


def _whole_key(words: bytes) -> np.ndarray:
    h = np.frombuffer(words, np.uint64)
    return tx.windows(h, len(h))
