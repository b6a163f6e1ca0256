"""Token ids in wavelet matrices (Claude, Navarro, Ordonez 2015), one compressed file a shard.

A shard file holds its documents' ids in ascending doc_id order as bit planes, most significant bit
first.  Each plane is a bit vector with a rank count every 1024 bits, compressed on its own; the
zeros of a plane go first in the next.  One file answers: the id at a place, how often an id occurs
in a range, and where its k-th occurrence is, each in a step a plane.

Layout: MAGIC, length of the head (4 bytes), the head (JSON: tokens, docs, planes with length and
zeros), the compressed document table (doc_id and token count as int64), the compressed planes.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as tx
from .bpe import byte_chars
from .frames import map_texts, readers, schema, shared_folder, slices, table, texts, written

MAGIC = b"FLWM0001"
BLOCK = 1024
#: Tokens after which a shard is closed; a document is never cut.
SHARD = 1 << 21
_CACHE = 600_000
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, bits: np.ndarray, n: int, counts: np.ndarray | None = None):
        self.bits, self.n = bits, n
        self.counts = counts if counts is not None else self.directory(bits)

    @staticmethod
    def directory(bits: np.ndarray) -> np.ndarray:
        """Ones before each block."""
        pad = np.zeros(-(-len(bits) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        pad[: len(bits)] = _ONES[bits]
        return np.concatenate(([0], np.cumsum(pad.reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)))).astype(np.uint32)

    def get(self, i: int) -> int:
        return int(self.bits[i >> 3] >> (7 - (i & 7))) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        block = i // BLOCK
        low, high = block * BLOCK // 8, i >> 3
        got = int(self.counts[block]) + int(_ONES[self.bits[low:high]].sum())
        return got + (int(_ONES[self.bits[high] >> (8 - (i & 7))]) if i & 7 else 0)

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of this kind."""
        starts = np.arange(len(self.counts), dtype=np.int64) * BLOCK
        before = self.counts.astype(np.int64) if bit else starts - self.counts
        block = int(np.searchsorted(before, k, "right")) - 1
        piece = np.unpackbits(self.bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(piece == bit)[k - int(before[block])])


class WaveletMatrix:
    def __init__(self, n: int, planes: list[tuple[Plane, int]]):
        self.n, self.planes = n, planes

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, now = [], ids
        for b in range(bits - 1, -1, -1):
            one = (now >> b & 1).astype(bool)
            planes.append((Plane(np.packbits(one), len(ids)), int(len(ids) - one.sum())))
            now = np.concatenate((now.take(np.flatnonzero(~one)), now.take(np.flatnonzero(one))))  # masks would mispredict
        return cls(len(ids), planes)

    def all(self) -> np.ndarray:
        """Every id in order, from the last plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for b, (plane, zeros) in enumerate(reversed(self.planes)):
            one = np.unpackbits(plane.bits, count=self.n).view(bool)
            now[zeros:] |= kind(1 << b)
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~one)] = now[:zeros]
            up[np.flatnonzero(one)] = now[zeros:]
            now = up
        return now.astype(np.uint32)

    def access(self, i: int) -> int:
        got = 0
        for plane, zeros in self.planes:
            bit = plane.get(i)
            got = got << 1 | bit
            i = zeros + plane.rank1(i) if bit else plane.rank(0, i)
        return got

    def _down(self, token: int, i: int) -> int:
        for b, (plane, zeros) in zip(range(len(self.planes) - 1, -1, -1), self.planes, strict=True):
            i = zeros + plane.rank1(i) if token >> b & 1 else plane.rank(0, i)
        return i

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of token in places low..high."""
        if token >> len(self.planes):
            return 0
        return self._down(token, self.n if high is None else high) - self._down(token, low)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of token; IndexError if there are fewer."""
        if k < 0 or k >= self.count(token):
            raise IndexError(k)
        i = self._down(token, 0) + k
        for b, (plane, zeros) in enumerate(reversed(self.planes)):
            i = plane.select(1, i - zeros) if token >> b & 1 else plane.select(0, i)
        return i


def dump(docs: list[tuple[int | None, int]], ids: np.ndarray, bits: int) -> bytes:
    """A shard file of the documents (doc_id, tokens) whose ids stand one after another."""
    m, z = WaveletMatrix.build(ids, bits), zstandard.ZstdCompressor(level=1)
    rows = z.compress(np.array([(np.iinfo(np.int64).min if d is None else d, n) for d, n in docs], np.int64).tobytes())
    planes = [z.compress(p.counts.tobytes() + p.bits.tobytes()) for p, _ in m.planes]
    head = json.dumps({"tokens": len(ids), "docs": len(docs), "table": len(rows), "planes": [[len(c), zeros] for c, (_, zeros) in zip(planes, m.planes, strict=True)]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, rows, *planes])


def load(data: bytes) -> tuple[list[tuple[int | None, int]], WaveletMatrix]:
    if data[:8] != MAGIC:
        raise ValueError("not a shard file")
    size = int.from_bytes(data[8:12], "little")
    head, at = json.loads(data[12 : 12 + size]), 12 + size
    z = zstandard.ZstdDecompressor()
    rows = np.frombuffer(z.decompress(data[at : at + head["table"]]), np.int64).reshape(-1, 2)
    docs = [(None if d == np.iinfo(np.int64).min else int(d), int(n)) for d, n in rows]
    at, n, planes = at + head["table"], head["tokens"], []
    marks = 4 * (-(-(-(-n // 8)) // (BLOCK // 8)) + 1)
    for length, zeros in head["planes"]:
        raw = z.decompress(data[at : at + length])
        planes.append((Plane(np.frombuffer(raw, np.uint8, offset=marks), n, np.frombuffer(raw, np.uint32, marks // 4)), zeros))
        at += length
    return docs, WaveletMatrix(n, planes)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """The tokenizers library, word by word, for a tokenizer whose pieces never cross ASCII white space:
    the ids of a text are those of its words.  Each distinct word of a batch is looked up once, in a
    bounded cache of two generations; new words of plain Latin letters, which a case-folding normaliser
    leaves as they are, go to the library's model alone.  A comma or stop after a letter is a piece of
    its own, so such words share an entry.  Texts with special tokens go to the library whole."""

    _PLAIN = re.compile(r"[a-z\u00e0-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        self.t, self.cache, self.older = _tokenizer(path), {}, {}
        self.kind = np.uint16 if self.t.get_vocab_size() <= 1 << 16 else np.uint32
        self.chars = {b: c for c, b in byte_chars().items()}
        spec = json.loads(self.t.to_str())
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if "Lowercase" not in steps or not spec["model"]["end_of_word_suffix"]:
            raise ValueError("the tokenizer must fold case and mark word ends")
        self.marks = [t["content"][:2].encode() for t in spec["added_tokens"]]

    def _new(self, word: bytes) -> bytes:
        text = word.decode()
        if self._PLAIN.fullmatch(text):
            ids = [x.id for x in self.t.model.tokenize(text if text.isascii() else "".join(self.chars[b] for b in word))]
        else:
            ids = self.t.encode(text, add_special_tokens=False).ids
        return array("H" if self.kind is np.uint16 else "I", ids).tobytes()

    def _miss(self, word: bytes) -> bytes:
        """From the older words, or anew; rare words pass through, frequent ones come back."""
        packed = self.older.get(word)
        if packed is None:
            packed = self._new(word)
        if len(self.cache) >= _CACHE:
            self.older, self.cache = self.cache, {}
        self.cache[word] = packed
        return packed

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        odd = {i for i, t in enumerate(texts) if any(m in t for m in self.marks)}
        w = tx.Words([b"" if i in odd else t for i, t in enumerate(texts)], lower=True)
        stop = np.zeros(len(w), bool)
        if len(w):
            last, before = w.data[w.end - 1], w.data[np.maximum(w.end - 2, 0)]
            stop = ((last == 44) | (last == 46)) & (w.end - w.start > 1) & ((before >= 97) & (before <= 122) | (before >= 48) & (before <= 57))
            w.end = w.end - stop
        _, first, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
        data, get = w.data.tobytes(), self.cache.get
        names = [data[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)]
        packed = [get(x) or self._miss(x) for x in names]
        flat = np.frombuffer(b"".join(packed), self.kind)
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // self.kind().itemsize
        of, n = (np.cumsum(size) - size)[which], size[which]  # place in flat and length of each word
        core = np.cumsum(n) - n
        place = core + np.cumsum(stop) - stop
        out = np.empty(int(n.sum() + stop.sum()), self.kind)
        step = np.arange(int(n.sum()))
        out[np.repeat(place - core, n) + step] = flat[np.repeat(of - core, n) + step]
        if stop.any():
            comma, dot = (np.frombuffer(self._new(x), self.kind)[0] for x in (b",", b"."))
            out[(place + n)[stop]] = np.where(last[stop] == 44, comma, dot)
        ends = np.concatenate((place, [len(out)]))[w.bounds]
        rows = [out[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in odd:
            rows[i] = np.array(self.t.encode(texts[i].decode(), add_special_tokens=False).ids, self.kind)
        return rows


@cache
def encoder(path: str) -> WordEncoder:
    """One a process: a worker's tasks share the words met."""
    return WordEncoder(path)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def put(path: str, data: bytes) -> None:
    """Writes a file under another name first, so that a repeated task leaves a whole one."""
    fs, at = open_fs(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    own = f"{at}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}.part"
    with fs.open_output_stream(own, compression=None) as out:
        out.write(data)
    fs.move(own, at)


def get(path: str) -> bytes:
    fs, at = open_fs(path)
    with fs.open_input_stream(at, compression=None) as f:
        return f.read()


def write_shards(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, shard: int = SHARD) -> DataFrame:
    """Encodes doc_id and text of docs and writes shard files in ascending doc_id order; the manifest
    (shard, path, docs, tokens) comes back, read from the shared folder.

    Null and empty texts give the end id alone.  Rows of a null doc_id come first, rows that repeat a
    doc_id stand side by side, in the order of a hash of the text, by which they are also dealt out.  An
    empty table makes no file.  File names hold the task's attempt, and only files that the manifest names,
    those of attempts that Spark committed, are read.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "wavelet")

    def run(batches):
        coder, bits = encoder(tokenizer), max(1, (_tokenizer(tokenizer).get_vocab_size() - 1).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        tail, part, attempt = np.array([end], kind), TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        rows, chunks, size, k, made = [], [], 0, 0, []

        def close():
            nonlocal rows, chunks, size, k
            path = f"{folder}/shard-{part:07d}-{k:05d}-{attempt}.wm"
            put(path, dump(rows, np.concatenate(chunks), bits))
            made.append((part << 24 | k, path, len(rows), size))
            rows, chunks, size, k = [], [], 0, k + 1

        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(texts(batch.column("text"))), strict=True):
                    rows.append((doc, len(ids) + 1))
                    chunks += [ids, tail]
                    size += len(ids) + 1
                    if size >= shard:
                        close()
        if rows:
            close()
        yield from table({"shard": pa.int64(), "path": pa.string(), "docs": pa.int64(), "tokens": pa.int64()}, made).to_batches()

    order = ("doc_id", F.xxhash64("text"))
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return written(map_texts(ordered, run, schema(None, shard="long", path="string", docs="long", tokens="long")), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): reads the files; start counts the tokens of all documents before."""

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                docs, matrix = load(get(path))
                ids = matrix.all()
                for low in range(0, len(docs), 1000):
                    some = docs[low : low + 1000]
                    ends = np.cumsum([0, *(n for _, n in some)])
                    here = ids[: ends[-1]]
                    ids = ids[ends[-1] :]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d for d, _ in some], pa.int64()), pa.array(start + ends[:-1], pa.int64()), pa.array([n for _, n in some], pa.int64()), pa.array([here[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    start += int(ends[-1])

    # tokens before a shard: those of earlier partitions, one row each, and those before it in its own
    earlier = lambda column, window: F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    manifest = manifest.withColumn("part", F.shiftright("shard", 24))
    totals = manifest.groupBy("part").agg(F.sum("tokens").alias("sum"))
    totals = totals.select("part", earlier("sum", Window.orderBy("part")).alias("base"))
    own = earlier("tokens", Window.partitionBy("part").orderBy("shard"))
    placed = manifest.select("part", "path", "shard", own.alias("own")).join(totals, "part").select("path", (F.col("base") + F.col("own")).cast("long").alias("start"), "shard")
    return map_texts(placed.repartition(readers(manifest.count()), "shard"), run, schema(None, doc_id="long", start="long", n_tokens="long", ids="binary"))


def crc(column: str = "ids"):
    """Unsigned CRC-32 of packed ids."""
    return F.crc32(F.col(column))
