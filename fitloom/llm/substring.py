"""Removal of word runs that a document with a smaller id already has, by suffix automata.

Sending an automaton of every shard of a corpus to every document is quadratic in the corpus.  Here a
document meets only the shards that can hold its passages:

1. Every window of `n` words has an anchor, the least hash of its runs of ANCHOR words; equal windows
   have equal anchors.  Anchors go, once for each part of documents, to buckets that find those of
   several documents and the first of these documents.
2. Those buckets answer each part.  A part cuts its documents into reference pieces (the document is
   the first with these anchors) and later pieces (another is the first), and sends both to shards.
3. A shard builds one suffix automaton of its reference pieces, with the least document below each
   state, and streams the later pieces through it: the matching statistic, kept at n words, says which
   windows the first document has.  Windows that it doesn't have make a second automaton, through which
   their pieces go once more: it names the least document in the shard with a window, and settles all
   others.  The least one goes to a bucket of the window's hash, where such documents of all shards meet.
4. Parts join what was found with their documents and cut the words out.

Parts are of bounded rows and bytes.  A first document whose anchors many documents have is copied to
several shards, which share these documents' parts.
Words are compared as 64-bit hashes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import text as tx
from .frames import dealt, give_back, ids, lean_group, parts, schema, table, texts, with_columns

ANCHOR = 5
#: Documents that one copy of a reference piece serves, about; shards for each part.
SERVES, SHARDS = 256, 4
_ANSWER = np.dtype([("anchor", "u8"), ("doc", "i8"), ("docs", "i8")])
_SEEN = np.dtype([("anchor", "u8"), ("low", "i8"), ("docs", "i4")])
_SPOT = np.dtype([("doc", "i8"), ("text", "u8"), ("at", "i4")])
_OPEN = np.dtype([("window", "u8"), ("doc", "i8"), ("text", "u8"), ("at", "i4"), ("part", "i4")])
_KINDS = {"dest": pa.int64(), "kind": pa.int32(), "part": pa.int32(), "data": pa.binary()}


class SuffixAutomaton:
    """Suffix automaton of several sequences of integers with the least label of each state's sequences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.label = [-1], [0], [1 << 63]
        self.last, self.marks = 0, -1

    def add(self, sequence: list[int], label: int) -> None:
        nxt, link, length, labels = self.next, self.link, self.length, self.label
        last = self.last
        for c in [*sequence, self.marks]:
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            labels.append(label)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    labels.append(1 << 63)
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        self.marks -= 1  # ends each sequence with a symbol of its own
        self.last = last

    def close(self) -> None:
        """Brings each state's least label up from the states below it."""
        label, link = self.label, self.link
        for v in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if label[v] < label[link[v]]:
                label[link[v]] = label[v]

    def windows(self, sequence: list[int], n: int) -> list[int]:
        """For each window of n symbols the least label of the sequences that have it, or -1."""
        nxt, link, length, label = self.next, self.link, self.length, self.label
        state, size, out = 0, 0, []
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            to = nxt[state].get(c)
            if to is None:
                state, size = 0, 0
            else:
                state, size = to, size + 1
                if size > n or length[link[state]] >= n:
                    size = min(size, n)
                    while length[link[state]] >= n:
                        state = link[state]
            out.append(label[state] if size >= n else -1)
        return out[n - 1 :]


def anchors(h: np.ndarray, n: int) -> np.ndarray:
    """The anchor of each window of n words."""
    a, w = tx.windows(h, min(ANCHOR, n)), n - min(ANCHOR, n) + 1
    step = 1
    while step < w:
        s = min(step, w - step)
        a = np.minimum(a[: len(a) - s], a[s:])
        step += s
    return a


class _Part:
    """Word hashes of the documents of a part and, for each window, its anchor."""

    def __init__(self, group: pa.Table, n: int):
        self.raw = texts(group.column("text"))
        self.doc = ids(group.column("doc_id"))
        self.words = tx.Words(self.raw)
        self.h = self.words.hashes()
        total = len(self.h)
        self.anchor = anchors(self.h, n)
        self.ok = tx.inside(self.words.bounds, n, total)
        self.row = self.words.owner()[: len(self.ok)]

    def spots(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), _SPOT)
        out["doc"], out["at"] = self.doc[rows], at - self.words.bounds[rows]
        some = {r: xxhash.xxh64_intdigest(self.raw[r]) for r in np.unique(rows).tolist()}
        out["text"] = [some[r] for r in rows.tolist()]
        return out


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _first(key: np.ndarray, *by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key and then by, and for each place in it the number of its key."""
    order = np.lexsort((*by[::-1], key))
    k = key[order]
    return order, np.cumsum(np.concatenate(([True], k[1:] != k[:-1]))[: len(k)]) - 1


def rest(text: bytes, cut: list[bool], spaces: bool) -> bytes:
    """What is left of a text without the words that are cut: joined by single spaces, or each with the white space
    that was before it, and the white space at the end if the last word is left."""
    if not spaces:
        return b" ".join(w for w, c in zip(text.split(), cut, strict=True) if not c)
    out, at = [], 0
    for found, c in zip(_WORD.finditer(text), cut, strict=True):
        if not c:
            out.append(text[at : found.end()])
        at = found.end()
    if not cut or not cut[-1]:
        out.append(text[at:])
    return b"".join(out)


def remove_repeats(docs: DataFrame, n: int = 13, spaces: bool = False) -> DataFrame:
    """docs with its text cut, and long columns n_words and n_removed (replaced if docs has such).

    Cut is every word that a window of n words covers which a document of smaller doc_id has too; the
    rest is joined by single spaces, or keeps the white space before each word that is left (spaces), so that a
    text of which nothing is cut stays as it is.  Windows are judged on the input.  Null and empty texts give an
    empty text.  A null doc_id counts as larger than any other; rows of one doc_id don't cut each other.
    """
    count = parts(docs)
    if docs.schema["doc_id"].dataType.simpleString() != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    base = dealt(docs, count)

    def tell(group):
        p = _Part(group, n)
        ok = np.flatnonzero(p.ok)
        if not len(ok):
            return table(_KINDS, [])
        a, d = p.anchor[ok], p.doc[p.row[ok]]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])))
        a, d = a[new], d[new]
        order, number = _first(a, d)
        a, d = a[order], d[order]
        head = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        seen = np.empty(len(head), _SEEN)
        new = np.concatenate(([True], (number[1:] != number[:-1]) | (d[1:] != d[:-1])))
        seen["anchor"], seen["low"], seen["docs"] = a[head], d[head], np.add.reduceat(new.astype(np.int32), head)
        bucket = (seen["anchor"] >> np.uint64(20)) % np.uint64(count)
        return _deal(bucket, seen, 0, group.column("__part")[0].as_py())

    def answer(group):
        part = np.array(group.column("part").to_pylist())
        data = [np.frombuffer(x, _SEEN) for x in group.column("data").to_pylist()]
        part, seen = np.repeat(part, [len(x) for x in data]), np.concatenate(data)
        order, number = _first(seen["anchor"], seen["low"])
        seen, part = seen[order], part[order]
        low = seen["low"][np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))]
        many = np.bincount(number, seen["docs"]).astype(np.int64)[number]
        shared = many > 1
        out = np.empty(int(shared.sum()), _ANSWER)
        out["anchor"], out["doc"], out["docs"] = seen["anchor"][shared], low[number][shared], many[shared]
        return _deal(part[shared], out, 0, 0)

    def cut(key, group, answers):
        try:
            return pieces_of(key, group, answers)
        finally:
            give_back()

    def pieces_of(key, group, answers):
        if not answers.num_rows or not group.num_rows:
            return table(_KINDS, [])
        own = key[0].as_py()
        p = _Part(group, n)
        known = np.concatenate([np.frombuffer(x, _ANSWER) for x in answers.column("data").to_pylist()])
        known = known[np.argsort(known["anchor"], kind="stable")]
        at = np.minimum(np.searchsorted(known["anchor"], p.anchor), len(known) - 1)
        doc = p.doc[p.row]
        first = known["doc"][at]
        use = p.ok & (known["anchor"][at] == p.anchor) & (first <= doc)
        place = np.flatnonzero(use)
        if not len(place):
            return table(_KINDS, [])
        f, r = first[place], p.row[place]
        start = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1] + 1) | (f[1:] != f[:-1]) | (r[1:] != r[:-1]))))
        end = np.concatenate((start[1:], [len(place)])) - 1
        serve = np.minimum(-(-np.maximum.reduceat(known["docs"][at[place]], start) // SERVES), count)
        rows, spots = [], p.spots(r[start], place[start])
        later: dict[tuple[int, int, bytes], list[bytes]] = {}
        copies: dict[int, int] = {}
        mine = f[start] == doc[place[start]]
        for d, s in zip(f[start][mine].tolist(), serve[mine].tolist(), strict=True):
            copies[d] = max(copies.get(d, 1), s)
        for a, b, d, ref, s, spot in zip(place[start].tolist(), place[end].tolist(), f[start].tolist(), mine.tolist(), serve.tolist(), spots, strict=True):
            piece = p.h[a : b + n].tobytes()
            if ref:
                for c in range(copies[d]):
                    rows.append((_shard(d, c, SHARDS * count), 0, own, np.int64(d).tobytes() + piece))
            else:
                later.setdefault((d, own % s, piece), []).append(spot.tobytes())
        for (d, c, piece), where in later.items():
            rows.append((_shard(d, c, SHARDS * count), 1, own, np.array([d, len(where)], np.int64).tobytes() + b"".join(where) + piece))
        return table(_KINDS, rows)

    def match(group):
        kind, part, data = (group.column(c).to_pylist() for c in ("kind", "part", "data"))
        names: dict[int, int] = {}
        auto = SuffixAutomaton()
        for d in sorted({d for k, d in zip(kind, data, strict=True) if not k}):
            auto.add(_named(np.frombuffer(d, np.uint64, offset=8), names), int.from_bytes(d[:8], "little", signed=True))
        auto.close()
        hits: dict[int, list[np.ndarray]] = {}
        answers, open_ = {}, []
        for k, own, d in zip(kind, part, data, strict=True):
            if not k:
                continue
            doc, many = np.frombuffer(d, np.int64, 2).tolist()
            where, piece = np.frombuffer(d, _SPOT, many, 16), d[16 + many * _SPOT.itemsize :]
            if (got := answers.get((doc, piece))) is None:
                h = np.frombuffer(piece, np.uint64)
                low = np.array(auto.windows([names.get(w) for w in h.tolist()], n))
                got = answers[doc, piece] = np.flatnonzero(low == doc), np.flatnonzero(low != doc), h
            hit, miss, h = got
            hits.setdefault(own, []).append(_moved(where, hit))
            if len(miss):
                open_.append((own, where, miss, h))
        away = [np.zeros(0, _OPEN)]
        for own, where, miss, h, low in _later(open_, n):
            spots = _moved(where, miss)
            low = np.tile(low, len(where))
            hits[own].append(spots[spots["doc"] > low])
            least = spots["doc"] == low
            away.append(_opened(spots[least], np.tile(tx.windows(h, n)[miss], len(where))[least], own))
        away = np.concatenate(away)
        rows = [(own, 0, own, np.concatenate(x).tobytes()) for own, x in hits.items()]
        return pa.concat_tables([table(_KINDS, rows), _deal((away["window"] >> np.uint64(20)) % np.uint64(SHARDS * count), away, 1, 0)])

    def settle(key, group):
        data = group.column("data").to_pylist()
        if not key[1].as_py():
            return table(_KINDS, [(key[0].as_py(), 0, 0, b"".join(data))])
        later = _least(np.concatenate([np.frombuffer(x, _OPEN) for x in data]))
        return _deal(later["part"], _spots(later), 0, 0)

    def finish(key, group, found):
        try:
            return rest_of(key, group, found)
        finally:
            give_back()

    def rest_of(key, group, found):
        if not group.num_rows:
            return schema_out.empty_table()
        doc, raw = ids(group.column("doc_id")), texts(group.column("text"))
        by: dict[tuple[int, int], np.ndarray] = {}
        if found.num_rows:
            spots = np.frombuffer(b"".join(found.column("data").to_pylist()), _SPOT)
            order, _ = _first(spots["doc"], spots["text"])
            spots = spots[order]
            head = np.flatnonzero(np.concatenate(([True], (spots["doc"][1:] != spots["doc"][:-1]) | (spots["text"][1:] != spots["text"][:-1]))))
            for a, b in zip(head, [*head[1:], len(spots)], strict=True):
                by[int(spots["doc"][a]), int(spots["text"][a])] = spots["at"][a:b]
        kept, many, gone = [], [], []
        for d, t in zip(doc.tolist(), raw, strict=True):
            words = t.split()
            at = by.get((d, xxhash.xxh64_intdigest(t))) if by else None
            many.append(len(words))
            if at is None:
                gone.append(0)
            else:
                cover = tx.spread(np.unique(at), n, len(words))
                gone.append(int(cover.sum()))
                t = rest(t, cover.tolist(), spaces)
            kept.append((t if spaces or at is not None else b" ".join(words)).decode())
        others = [c for c in group.column_names if c not in ("text", "n_words", "n_removed", "__part")]
        cols = {c: group.column(c) for c in others} | {"text": pa.array(kept, pa.string()), "n_words": pa.array(many, pa.int64()), "n_removed": pa.array(gone, pa.int64())}
        return pa.table({c: cols[c] for c in order_out})

    out = schema(docs, n_words="long", n_removed="long")
    order_out = out.names
    schema_out = to_arrow_schema(out)
    rows = schema(None, dest="long", kind="int", part="int", data="binary")
    told = base.groupBy("__part").applyInArrow(lean_group(tell, False), rows)
    answers = told.groupBy("dest").applyInArrow(lean_group(answer, False), rows)
    pieces = base.groupBy("__part").cogroup(answers.withColumn("dest", F.col("dest").cast("int")).groupBy("dest")).applyInArrow(cut, rows)
    matched = pieces.groupBy("dest").applyInArrow(lean_group(match, False), rows)
    settled = matched.groupBy("dest", "kind").applyInArrow(lean_group(settle), rows)
    return base.groupBy("__part").cogroup(settled.withColumn("dest", F.col("dest").cast("int")).groupBy("dest")).applyInArrow(finish, out)


def _shard(doc: int, copy: int, count: int) -> int:
    return xxhash.xxh64_intdigest(np.array([doc, copy], np.int64).tobytes()) % count


def _deal(to: np.ndarray, data: np.ndarray, kind: int, part: int) -> pa.Table:
    """One row of packed data for each destination."""
    if not len(data):
        return table(_KINDS, [])
    order = np.argsort(to, kind="stable")
    to, data = np.asarray(to)[order].astype(np.int64), data[order]
    head = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
    return table(_KINDS, [(int(to[a]), kind, part, data[a:b].tobytes()) for a, b in zip(head, [*head[1:], len(to)], strict=True)])


def _named(h: np.ndarray, names: dict[int, int]) -> list[int]:
    """Word hashes as small numbers, new ones added to names."""
    return [names.setdefault(w, len(names)) for w in h.tolist()]


def _later(open_: list[tuple], n: int):
    """Open windows of later pieces, each with the least document among these pieces that has the window: a
    second automaton, of just the runs of open windows, says which."""
    auto, names, seen = SuffixAutomaton(), {}, set()
    for _, where, miss, h in open_:
        doc = int(where["doc"].min())
        for run in np.split(miss, np.flatnonzero(np.diff(miss) > 1) + 1):
            words = h[run[0] : run[-1] + n]
            if (doc, words.tobytes()) not in seen:
                seen.add((doc, words.tobytes()))
                auto.add(_named(words, names), doc)
    auto.close()
    for own, where, miss, h in open_:
        yield own, where, miss, h, np.array(auto.windows([names.get(w) for w in h.tolist()], n))[miss]


def _least(away: np.ndarray) -> np.ndarray:
    """Of open windows those that aren't of the least document with them."""
    order, number = _first(away["window"], away["doc"])
    away = away[order]
    low = away["doc"][np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))]
    return away[away["doc"] > low[number]]


def _spots(away: np.ndarray) -> np.ndarray:
    out = np.empty(len(away), _SPOT)
    for c in ("doc", "text", "at"):
        out[c] = away[c]
    return out


def _opened(spots: np.ndarray, windows: np.ndarray, part: int) -> np.ndarray:
    out = np.empty(len(spots), _OPEN)
    for c in ("doc", "text", "at"):
        out[c] = spots[c]
    out["window"], out["part"] = windows, part
    return out


def _moved(where: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each spot moved on by each of `at`."""
    out = np.empty(len(where) * len(at), _SPOT)
    for c in ("doc", "text"):
        out[c] = np.repeat(where[c], len(at))
    out["at"] = (where["at"][:, None] + at[None, :]).ravel()
    return out
