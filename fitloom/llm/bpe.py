"""Byte-level BPE as a streaming transducer with bounded lookahead, and the way back.

Appending bytes to a text can change its merges only near the end.  If rule i = (u, v) takes u away
at the right, the next rule to notice is a later one, j > i, whose right part is u or uv; it takes or
spares its own left part, and so on, always with later rules.  The longest such chain, measured in
the bytes of left parts, is the merge list's sufficient lookahead (after Berglund and van der Merwe
2023): a token that ends that far before the last byte read is stable.  As no merge crosses a token
bound, encoding may start anew at any stable bound, so the state is a bounded carry.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import map_texts, schema, slices, with_columns

PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A run of one pre-token class that a chunk's end may have cut, by its first (non-blank) character.
_RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]
#: Pieces that no pre-token crosses: an optional blank with what isn't white space, or white space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK = re.compile(rf"[{_WHITE}]+")
_UNITS = re.compile(rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
CHUNK = 1 << 16
_CACHE = 200_000
_ENDS = (",", ".")


def byte_chars() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """A byte-level BPE model: vocabulary, ranked merges and their sufficient lookahead in bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in vocab.items():
            self.bytes_of[i] = bytes(chars[c] for c in t)
        for t, i in special.items():
            self.bytes_of[i] = t.encode()
        self.byte_id = [0] * 256
        for c, b in chars.items():
            self.byte_id[b] = vocab[c]
        rules = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rules = [(vocab[u], vocab[v], vocab[u + v]) for u, v in rules]
        self.rank = {(u, v): (k, t) for k, (u, v, t) in reversed(list(enumerate(self.rules)))}
        self.pair = {p: k << 32 | t for p, (k, t) in self.rank.items()}
        self.lookahead = self._lookahead()
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def _lookahead(self) -> int:
        """Longest chain of left parts.  It needs every rule to come after the rules that make its parts."""
        made = {}
        for k, (u, v, t) in enumerate(self.rules):
            if max(made.get(u, -1), made.get(v, -1)) >= k:
                raise ValueError("a merge comes before the merges of its parts")
            made.setdefault(t, k)
        best: dict[int, int] = {}
        longest = 1
        for u, v, t in reversed(self.rules):
            reach = len(self.bytes_of[u]) + max(best.get(u, 0), best.get(t, 0))
            best[v] = max(best.get(v, 0), reach)
            longest = max(longest, reach)
        return longest

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one piece of bytes: always the first of the merges of lowest rank."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        if n <= 40:
            return self._merge_short(ids)
        rank, after, before = self.rank, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get((ids[i], ids[i + 1]))
            if r:
                heap.append((r[0], i, ids[i], ids[i + 1], r[1]))
        heapq.heapify(heap)
        while heap:
            _, i, u, v, t = heapq.heappop(heap)
            j = after[i]
            if ids[i] != u or j >= n or ids[j] != v:
                continue
            ids[i], ids[j] = t, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = rank.get((t, ids[k]))
                if r:
                    heapq.heappush(heap, (r[0], i, t, ids[k], r[1]))
            p = before[i]
            if p >= 0:
                r = rank.get((ids[p], t))
                if r:
                    heapq.heappush(heap, (r[0], p, ids[p], t, r[1]))
        return [x for x in ids if x >= 0]


    def _merge_short(self, ids: list[int]) -> list[int]:
        """merge() without a heap: rank and result of each pair in one number, the least taken each time."""
        get, none = self.pair.get, 1 << 62
        pairs = [get((u, v), none) for u, v in zip(ids, ids[1:])]
        while True:
            low = min(pairs)
            if low == none:
                return ids
            i = pairs.index(low)
            t = ids[i] = low & 0xFFFFFFFF
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get((t, ids[i + 1]), none)
            if i:
                pairs[i - 1] = get((ids[i - 1], t), none)
            if not pairs:
                return ids


class Transducer:
    """Bytes of one pre-token in, stable tokens out; holds at most the lookahead, one token and one chunk."""

    def __init__(self, merges: Merges):
        self.m, self.carry = merges, b""

    def feed(self, data: bytes) -> list[int]:
        self.carry += data
        if len(self.carry) < 2 * self.m.lookahead:
            return []
        out, end, size = [], 0, self.m.bytes_of
        for t in self.m.merge(self.carry):
            if end + len(size[t]) > len(self.carry) - self.m.lookahead:
                break
            end += len(size[t])
            out.append(t)
        self.carry = self.carry[end:]
        return out

    def finish(self) -> list[int]:
        out, self.carry = self.m.merge(self.carry), b""
        return out


class Encoder:
    """Text in chunks of any size in, ids out.  Short pieces of text come from a bounded cache."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held, self.run, self.pipe = "", None, Transducer(merges)

    def _piece(self, unit: str) -> bytes:
        """Ids of a unit that is whole, as packed 32-bit integers."""
        packed = self.older.get(unit)
        if packed is None:
            packed = self._new(unit)
        if len(unit) <= 64:
            if len(self.cache) >= _CACHE:
                self.older, self.cache = self.cache, {}
            self.cache[unit] = packed
        return packed

    def _new(self, unit: str) -> bytes:
        core = unit[1:] if unit[0] == " " else unit
        if core.isalpha() and len(core) < CHUNK:  # one pre-token
            return array("I", self._whole(unit)).tobytes()
        if core[-1:] in _ENDS and core[:-1].isalpha() and len(core) < CHUNK:  # two, of which one is a word
            word = unit[:-1]
            return (self.cache.get(word) or self._piece(word)) + array("I", [self.m.byte_id[ord(unit[-1])]]).tobytes()
        out: list[int] = []
        for p in PATTERN.findall(unit):
            out += self.pipe.feed(p.encode())
            out += self.pipe.finish()
        return array("I", out).tobytes()

    def feed(self, text: str) -> bytes:
        """Packed ids that are stable by now.  What may go on is held back: of a long run of white space the
        last character, which may belong to the next piece, of other long runs nothing but the transducer's state."""
        out = []
        if self.run is _BLANK:
            m = self.run.match(text)
            inner = m.end() if m else 0
            white, text = self.held + text[:inner], text[inner:]
            self.held = white[-1:]
            out.append(np.array(self.pipe.feed(white[:-1].encode()), np.uint32).tobytes())
            if not text:
                return b"".join(out)
            out.append(np.array(self.pipe.finish(), np.uint32).tobytes())
            self.run = None
        elif self.run:  # inside a long run of one class
            m = self.run.match(text)
            inner = m.end() if m else 0
            out.append(np.array(self.pipe.feed(text[:inner].encode()), np.uint32).tobytes())
            if inner == len(text):
                return b"".join(out)
            out.append(np.array(self.pipe.finish(), np.uint32).tobytes())
            self.run, text = None, text[inner:]
        text = self.held + text
        units = _UNITS.findall(text)
        if not units:
            self.held = text
            return b"".join(out)
        last = units.pop()
        if units and units[-1].isspace() and last.isspace():
            last = units.pop() + last
        get = self.cache.get
        out += [get(u) or self._piece(u) for u in units]
        self.held = last
        if len(last) > max(8, CHUNK):
            if _BLANK.fullmatch(last):
                self.held, self.run = last[-1], _BLANK
                out.append(np.array(self.pipe.feed(last[:-1].encode()), np.uint32).tobytes())
            elif not last.isspace():
                out.append(self._long(last))
        return b"".join(out)

    def _long(self, unit: str) -> bytes:
        """A piece longer than a chunk: all but its last pre-token is whole, of that the stable part is."""
        pieces = PATTERN.findall(unit)
        last = pieces.pop()
        if pieces and pieces[-1] == "'" and len(last) == 1:  # may become 'll, 're or 've
            last = pieces.pop() + last
        self.held = last if last[:1] == "'" and len(last) < 4 else ""
        out = [np.array(self.m.merge(p.encode()) if len(p) <= 64 else self._whole(p), np.uint32).tobytes() for p in pieces]
        if self.held:
            return b"".join(out)
        self.run = next(r for r in _RUNS if r.match(last.lstrip(" ")))
        out.append(np.array(self.pipe.feed(last.encode()), np.uint32).tobytes())
        return b"".join(out)

    def _whole(self, p: str) -> list[int]:
        pipe = Transducer(self.m)
        return pipe.feed(p.encode()) + pipe.finish()

    def finish(self) -> bytes:
        out = []
        if self.run is _BLANK:  # at the end all of the white space is one piece
            out.append(np.array(self.pipe.feed(self.held.encode()), np.uint32).tobytes())
            self.held = ""
        if self.run:
            out.append(np.array(self.pipe.finish(), np.uint32).tobytes())
            self.run = None
        get = self.cache.get
        out += [get(u) or self._piece(u) for u in _UNITS.findall(self.held)]
        self.held = ""
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens become those tokens."""
        self.held, self.run, self.pipe.carry = "", None, b""
        out = []
        sp = self.m.split_special
        for k, part in enumerate(sp.split(text) if sp and any(s in text for s in self.m.special) else [text]):
            if k % 2:
                out.append(np.array([self.m.special[part]], np.uint32).tobytes())
                continue
            for at in range(0, len(part), CHUNK):
                out.append(self.feed(part[at : at + CHUNK]))
            out.append(self.finish())
        return np.frombuffer(b"".join(out), np.uint32)


class ByteToText:
    """UTF-8 bytes in pieces to text: a state machine over lead and continuation bytes.  Each longest
    start of a character that can't go on becomes one U+FFFD."""

    #: lead byte: (continuation bytes, least and greatest first continuation) of well-formed UTF-8
    LEADS = {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)} | {b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)} | {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}
    LEADS |= {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F), 0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)}

    def __init__(self):
        self.part, self.left, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.left:
                if self.low <= b <= self.high:
                    self.part.append(b)
                    self.left, self.low, self.high = self.left - 1, 0x80, 0xBF
                    if not self.left:
                        out.append(self.part.decode())
                        self.part.clear()
                    continue
                out.append("�")
                self.part.clear()
                self.left, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif b in self.LEADS:
                self.left, self.low, self.high = self.LEADS[b]
                self.part.append(b)
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        out = "�" if self.left else ""
        self.__init__()
        return out


class Decoder:
    """Ids to text.  Tokens that are whole characters pass as they are between characters; the rest
    goes through the state machine."""

    def __init__(self, merges: Merges):
        self.bytes_of = merges.bytes_of
        self.text_of: list[str | None] = []
        for b in merges.bytes_of:
            try:
                self.text_of.append(b.decode())
            except UnicodeDecodeError:
                self.text_of.append(None)
        self.partial = np.array([t is None for t in self.text_of])

    def decode(self, ids: np.ndarray) -> str:
        if not self.partial[ids].any():
            return "".join(map(self.text_of.__getitem__, ids.tolist()))
        machine, out = ByteToText(), []
        for i in ids.tolist():
            t = self.text_of[i]
            if t is not None and not machine.left:
                out.append(t)
            else:
                out.append(machine.feed(self.bytes_of[i]))
        return "".join(out) + machine.finish()


@cache
def model(path: str) -> Merges:
    return Merges(path)


@cache
def encoder(path: str) -> Encoder:
    """One a process: a worker's tasks share the pieces met."""
    return Encoder(model(path))


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """docs with a column of token ids of `column`; null and empty texts give an empty list.  With
    `decoded` the ids are decoded again in the same pass, into a column of that name.  A column of docs
    that has one of these names is replaced; others stay, whatever they are."""

    def run(batches):
        coder, decoder = encoder(path), Decoder(model(path)) if decoded else None
        for whole in batches:
            for batch in slices(whole, column):
                rows = [coder.encode(t or "") for t in batch.column(column).to_pylist()]
                ends = np.cumsum([0, *map(len, rows)])
                flat = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
                extra = {ids: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))}
                if decoder:
                    extra[decoded] = pa.array([decoder.decode(r) for r in rows], pa.string())
                yield with_columns(batch, **extra)

    own = [ids, decoded] if decoded else [ids]
    fields = [f for f in docs.schema.fields if f.name not in own] + [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    return map_texts(docs, run, T.StructType(fields + [T.StructField(decoded, T.StringType())] * bool(decoded)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of its token ids, special tokens included; null ids give an empty text."""

    def run(batches):
        decoder = Decoder(model(path))
        for batch in batches:
            column = batch.column(ids)
            rows = [decoder.decode(np.asarray(r.values, np.int64)) if r.is_valid else "" for r in column]
            yield with_columns(batch, **{text: pa.array(rows, pa.string())})

    return map_texts(df, run, schema(df, **{text: "string"}))
