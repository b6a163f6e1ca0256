"""The contract queries against plain versions on a whole small table, and on rows that go wrong."""

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from fitloom.llm import minhash, queries, quality, substring, warc, wavelet

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def odd():
    """Null, empty and blank texts, one very long, ties, repeats, accents, special tokens, odd white space."""
    base = " ".join(f"word{i % 97}" for i in range(60))
    rows = [None, "", " \n\t ", "one", "one two", base, base, base.upper(), base + " tail", "x " * 30000, "a" * 40000, "é É <|endoftext|> <|startoftext|> '' 'll", "line\nline\n\nline two\n", "\x0b\x1c\x85   end", "no spaces," * 50, base.replace("word5 ", "wordX ")]
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


def rows(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def run(spark, tmp_path, name, table, data, column="text"):
    """A registered query on a table made of (id, text) rows, with extra columns."""
    key = "page_id" if table == "pages" else "doc_id"
    df = spark.createDataFrame(data, f"{key} long, {column} string").withColumns({"lang": F.lit("en"), "n_words": F.lit("clash"), "kept": F.lit(1), "url": F.lit("http://x/")})
    df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
    return queries.queries()[name](spark, str(tmp_path))


COLUMNS = {
    "op1_wavelet_tokens": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_bpe_transducer": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_minmax_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_quality_bands": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_whole_table(spark, docs, name):
    got = rows(queries.queries()[name](spark, SF), COLUMNS[name])
    assert got == sorted(getattr(brute, name.partition("_")[0])(docs))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_odd_rows(spark, tmp_path, odd, name):
    got = rows(run(spark, tmp_path, name, "documents", odd), COLUMNS[name])
    assert got == sorted(getattr(brute, name.partition("_")[0])(odd))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_empty_table(spark, tmp_path, name):
    assert run(spark, tmp_path, name, "documents", []).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


WARC = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_warc(spark, tmp_path):
    pages = [(5, "same"), (3, "same"), (9, None), (1, ""), (4, "é" * 70000), (8, "same"), (7, "\r\n\r\n"), (2, "only")]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    got = [tuple(r) for r in run(spark, tmp_path, "op9_warc_zstd", "pages", pages, "html").select(*WARC).collect()]
    assert sorted(got, key=key) == sorted(brute.op9(pages), key=key)
    assert run(spark, tmp_path, "op9_warc_zstd", "pages", [], "html").count() == 0
    whole = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = [tuple(r) for r in queries.queries()["op9_warc_zstd"](spark, SF).select(*WARC).collect()]
    assert sorted(got, key=key) == sorted(brute.op9(whole), key=key)


def test_warc_payloads_and_faults(spark):
    recs = [warc.record(k, "http://x/", b"body %d" % k * 40, None) for k in range(40)]
    data = warc.archive(recs)
    assert list(warc.frames(data)) == recs
    assert [warc.parse(r)["payload"] for r in recs][3] == b"body 3" * 40
    for broken in (data[4:], data[:-3], data[:9], b""):
        with pytest.raises(ValueError):
            list(warc.frames(broken))
    for old, new in ((b"Content-Length: 240", b"Content-Length: 241"), (b"Content-Length: 240", b"Content-Length: x"), (b"sha1:", b"sha1:A"), (b"WARC/1.1", b"HTTP/1.1"), (b"WARC-Type: response\r\n", b"")):
        with pytest.raises(ValueError):
            warc.parse(recs[3].replace(old, new))


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (2, text), (2, text), (1, text + " x"), (None, None)], "doc_id long, text string")
    cut = substring.remove_repeats(df, 13).collect()
    assert sorted((r["doc_id"] or 99, r["n_words"], r["n_removed"]) for r in cut) == [(1, 41, 0), (2, 40, 40), (2, 40, 40), (99, 0, 0), (99, 40, 40)]
    dup = minhash.near_duplicates(df, 3, 80).collect()
    assert sorted((r["doc_id"] or 99, r["component_id"] or 99, r["kept"]) for r in dup) == [(1, 1, True), (2, 1, False), (2, 1, False), (99, 1, False), (99, 99, True)]
    assert [r["doc_id"] for r in minhash.keep_first(df, 3, 80).collect() if r["text"]] == [1]


def test_null_ids_join_nothing_else(spark):
    """Null ids, and ids that rows of other words repeat, don't merge the groups that they meet."""
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    data = [(3, a), (None, a + " zz"), (9, b), (None, b + " zz"), (None, "q w e r t"), (None, "Q w  e r t"), (5, "c d e f g h"), (5, "i j k l m n"), (12, "i j k l m n"), (None, None), (None, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, 3, 85).collect()}
    assert got == {(3, 38, 3, True), (None, 39, 3, False), (9, 38, 9, True), (None, 39, 9, False), (None, 3, None, True), (5, 4, 5, True), (12, 4, 5, False), (None, 0, None, True)}
    kept = [(r["doc_id"], r["text"]) for r in minhash.keep_first(df, 3, 85).collect()]
    assert len(kept) == 7 and {k[0] for k in kept} == {3, 5, 9, None} and sum((t or "").lower().startswith("q") for _, t in kept) == 1


def test_extra_columns_pass_through(spark):
    """keep_first returns the columns it got, also where they have the names that results use."""
    df = spark.createDataFrame([(1, "a b c d e f", 7, "x", True), (2, "a b c d e f", 8, "y", False)], "doc_id long, text string, component_id long, kept string, n_shingles boolean")
    assert [tuple(r) for r in minhash.keep_first(df).collect()] == [(1, "a b c d e f", 7, "x", True)]
    assert minhash.keep_first(df.limit(0)).count() == 0


def test_blocks_of_a_large_group(spark, monkeypatch):
    """A group of near copies that is cut into many blocks links as one that isn't."""
    monkeypatch.setattr(minhash, "BLOCK", 2000)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 20)
    base = [f"w{i}" for i in range(60)]
    data = []
    for k in range(60):
        words = list(base)
        words[k % 55] = f"x{k}"
        if k % 3 == 0:
            words[(k * 7) % 50] = f"y{k}"
        if k % 4 == 0:
            words[(k * 11) % 50] = f"z{k}"
        data.append((k, " ".join(words)))
    got = rows(minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 3, 85), COLUMNS["op5_minmax_dedup"])
    assert got == brute.op5(data)


def test_shared_boilerplate_makes_no_pairs(spark):
    """Documents that share half their shingles fall in one group of candidates; their rarest shingles part them."""
    import random

    rnd = random.Random(8)
    common = [f"c{i}" for i in range(60)]
    data = [(k, " ".join([*common, *(f"u{rnd.randrange(10**6)}" for _ in range(60))])) for k in range(700)]
    data += [(1000 + k, data[k * 50][1] + " end") for k in range(10)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 3, 85).collect()}
    assert got == {d: (d - 1000) * 50 if d >= 1000 else d for d, _ in data}


def test_wavelet_answers(spark, tmp_path):
    import numpy as np

    ids = np.random.default_rng(3).integers(0, 300, 5000).astype(np.uint16)
    docs, m = wavelet.load(wavelet.dump([(None, 4000), (7, 1000)], ids, 9))
    assert docs == [(None, 4000), (7, 1000)] and (m.all() == ids).all()
    assert [m.access(i) for i in (0, 1, 1023, 1024, 4999)] == ids[[0, 1, 1023, 1024, 4999]].tolist()
    for t in (0, 5, 299, 511):
        at = np.flatnonzero(ids == t)
        assert m.count(t) == len(at) and m.count(t, 100, 2000) == ((at >= 100) & (at < 2000)).sum()
        assert [m.select(t, k) for k in range(len(at))] == at.tolist()
        with pytest.raises(IndexError):
            m.select(t, len(at))


def test_shards_keep_the_order(spark):
    df = spark.createDataFrame([(k, "some words " * (k % 7)) for k in range(200)], "doc_id long, text string").repartition(5)
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    one, many = (rows(wavelet.read_shards(wavelet.write_shards(df, path, 2, shard=n)), ["doc_id", "start", "n_tokens"]) for n in (1 << 21, 50))
    assert one == many


def test_quality_bands():
    import os

    z = __import__("zstandard").ZstdCompressor(level=3)
    assert quality.compression(b"", z) == (None, 0.0, True)
    assert not quality.compression(b"abc " * 1000, z)[2]
    assert not quality.compression(os.urandom(9000), z)[2]


def noise(symbols, size, width, seed=1):
    import random

    s = "".join(random.Random(seed).choices(symbols, k=size))
    return " ".join(s[i : i + width] for i in range(0, size, width))[:size].encode()


def test_noise_fails_and_natural_text_stays():
    import string

    z = __import__("zstandard").ZstdCompressor(level=3)
    alnum = string.ascii_letters + string.digits
    kinds = [(alnum + "+/", 8, 192), (alnum + "+/", 76, 192), (alnum, 10, 192), (string.printable[:94], 8, 192), (string.ascii_lowercase, 6, 2048), ("0123456789abcdef", 8, 8192), ("0123456789abcdef", 64, 8192)]
    for symbols, width, least in kinds:
        for size in (192, 250, 256, 383, 400, 511, 512, 767, 800, 1023, 1024, 1500, 2000, 3000, 4095, 5000, 8192, 16000, 20000, 100000, 1 << 20):
            if size >= least:
                assert not quality.compression(noise(symbols, size, width), z)[2], (symbols, width, size)
    texts = [r[0].encode() for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    for t in texts:
        ratio = quality.compression(t, z)[0]
        assert ratio is None or len(t) < 192 or quality.within(len(t), max(ratio, 0.3), quality.WHOLE)


def test_noise_within_a_long_text():
    import string

    z = __import__("zstandard").ZstdCompressor(level=3)
    texts = [r[0].encode() for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()]
    good = b" ".join(t for t in texts if len(t) > 500 and quality.compression(t, z)[2])
    good = (good * (1 + (1 << 20) // len(good)))[: 1 << 20]

    def kept(size, *places):
        t = bytearray(good[:size])
        for k in places:
            t[k * 4096 : k * 4096 + 4096] = noise(string.ascii_letters + string.digits, 4096, 8, k)
        return quality.compression(bytes(t), z)[2]

    assert kept(40960) and kept(40960, 3) and kept(1 << 20, 5)
    assert not kept(40960, 3, 4) and not kept(40960, 3, 7) and not kept(1 << 20, 5, 6)
    assert kept(1 << 20, *range(0, 24, 2)) and not kept(1 << 20, *range(0, 120, 2))
