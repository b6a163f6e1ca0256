"""Quality rules: base counts and bands of zstandard compression ratios.

A ratio is compressed size over size.  Very small ratios mean repetition, ratios near one mean noise
such as keys, dumps or ciphers.  Upper limits lie above natural text of a length and below base64 from
192 bytes on, random letters from 2 KB and hexadecimal digits from 8 KB; below that the ratios of
noise and of natural text overlap.  Small texts compress badly whatever they are, so limits depend on
length: a band holds from its length up to the next.  Whole texts have one set of bands; chunks of
CHUNK bytes another; a text of several chunks may have a share of its bytes in chunks outside it that
falls with its length, and no BAD_RUN whole chunks in a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import text as tx
from .frames import map_texts, schema, slices, texts, with_columns

CHUNK = 4096
LEVEL = 3
#: (least bytes, least ratio, greatest ratio) of whole texts.
WHOLE = [(0, 0.0, 9.0), (192, 0.0, 0.91), (256, 0.25, 0.85), (384, 0.25, 0.82), (512, 0.25, 0.78), (768, 0.25, 0.75), (1024, 0.20, 0.69), (1536, 0.20, 0.64), (2048, 0.20, 0.585), (4096, 0.18, 0.56), (8192, 0.18, 0.515), (16384, 0.15, 0.50)]
#: The same of chunks; only a last chunk is shorter than CHUNK.
PIECE = [(0, 0.0, 9.0), (192, 0.0, 0.91), (256, 0.0, 0.85), (384, 0.0, 0.82), (512, 0.0, 0.78), (768, 0.0, 0.75), (1024, 0.20, 0.69), (1536, 0.20, 0.64), (2048, 0.20, 0.585), (4096, 0.18, 0.56)]
#: (least bytes, share of chunks, weighted by bytes, that may lie outside their band).
BAD_CHUNKS = [(0, 0.25), (32768, 0.15), (65536, 0.10), (262144, 0.05)]
#: Whole chunks in a row outside their band that a text may not have.
BAD_RUN = 2
SYMBOLS = b"#*$%&|<>"


def within(size: int, ratio: float, bands: list[tuple[int, float, float]]) -> bool:
    low, high = next((lo, hi) for least, lo, hi in reversed(bands) if size >= least)
    return low <= ratio <= high


def compression(text: bytes, z: zstandard.ZstdCompressor) -> tuple[float | None, float, bool]:
    """Ratio of the whole text, share of bytes in chunks outside their band, and the verdict."""
    if not text:
        return None, 0.0, True
    ratio = len(z.compress(text)) / len(text)
    bad = run = longest = 0
    if len(text) > CHUNK:
        for at in range(0, len(text), CHUNK):
            c = text[at : at + CHUNK]
            if not within(len(c), len(z.compress(c)) / len(c), PIECE):
                bad += len(c)
                run += len(c) == CHUNK
                longest = max(longest, run)
            else:
                run = 0
    share = bad / len(text)
    most = next(m for least, m in reversed(BAD_CHUNKS) if len(text) >= least)
    return ratio, share, within(len(text), ratio, WHOLE) and share <= most and longest < BAD_RUN


def base_counts(raw: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    w = tx.Words(raw)
    n, own = len(raw), w.owner()
    head = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int32)))  # code points before each byte
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    marks = np.concatenate(([0], np.cumsum(symbol[w.data], dtype=np.int32)))
    h = w.hashes()
    out = {"n_words": w.counts, "word_chars": np.bincount(own, head[w.end] - head[w.start], n).astype(np.int64)}
    out["n_symbols"] = marks[w.text_start[1:] - 1] - marks[w.text_start[:-1]] if n else np.zeros(0, np.int64)
    g = tx.windows(h, 5)
    ok = np.flatnonzero(tx.inside(w.bounds, 5, len(h)))
    key = g[ok] ^ tx.mix(own[ok].astype(np.uint64) + np.uint64(1))  # equal only for equal windows of one text
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(ok), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = tx.spread(ok[order][twice], 5, len(h))
    out["n_repeat_words"] = np.bincount(own, covered, n).astype(np.int64)
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(raw):
        if b"\n" in t:
            lines = [x for x in t.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            dup[i] = len(lines) - len(set(lines))
    out["n_dup_lines"] = dup
    return out


def rules(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio, bad_chunks, base_failed, kept.

    Null texts count as empty: no words, so base_failed; ratio is then null.  Columns of docs with
    these names are replaced; ties and repeated rows don't matter, as each row stands alone.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches):
        z = zstandard.ZstdCompressor(level=LEVEL)
        for whole in batches:
            for batch in slices(whole, "text"):
                raw = texts(batch.column("text"))
                c = base_counts(raw)
                ratio, share, good = zip(*(compression(t, z) for t in raw), strict=True)
                failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
                kept = ~failed & np.array(good)
                yield with_columns(batch, **{k: pa.array(c[k], pa.int64()) for k in names}, ratio=pa.array(ratio, pa.float64()), bad_chunks=pa.array(share, pa.float64()), base_failed=pa.array(failed), kept=pa.array(kept))

    return map_texts(docs, run, schema(docs, **dict.fromkeys(names, "long"), ratio="double", bad_chunks="double", base_failed="boolean", kept="boolean"))
