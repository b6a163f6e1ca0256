"""Prefix trie, spelling variants and personal data against plain versions, on whole tables and on rows that go wrong."""

import random
import re

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from fitloom.llm import pii, queries, trie, variants

SF = "/root/testdata/sf0.001"
LONG = "some words that go on and on, again and again. " * 25000
TEXTS = [(1, "Accomodation and accommodation"), (1, "Accomodation and accommodation"), (1, "another text"), (None, "accommodation without id"), (None, None), (7, None), (8, ""), (9, " \n\t "), (10, LONG), (-3, "é ß 漢字 😀 \x1c \x85 end"), (11, "x" * 70000)]


def plain(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def save(spark, path, name, rows, schema, **clash):
    spark.createDataFrame(rows, schema).selectExpr("*", *(f"{v} AS `{k}`" for k, v in clash.items())).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return str(path)


# trie -----------------------------------------------------------------------------------------------
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def talks(spark, path, rows):
    return queries.queries()["op11_prefix_trie"](spark, save(spark, path, "conversations", rows, TURNS, depth="1", node="'n'", key="2", pos="3", n_convs="'x'"))


def test_trie_of_whole_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert plain(queries.queries()["op11_prefix_trie"](spark, SF), NODE) == sorted(brute.op11(rows), key=str)


def test_trie_of_odd_rows(spark, tmp_path, monkeypatch):
    """Nulls anywhere, ties and repeats, negative ids, an absent base, copies, and a long conversation; lists and chains in pieces."""
    monkeypatch.setattr(trie, "LIST_BITS", 2)
    monkeypatch.setattr(trie, "CHAIN", 7)
    monkeypatch.setattr(trie, "CELL", 4)
    rnd = random.Random(3)
    rows = [(None, 0, "user", "no id"), (5, None, None, None), (5, None, "user", ""), (5, 1, "a", "b"), (5, 1, "ab", ""), (5, 1, "a", "b"), (6, None, "user", "x"), (-7, 0, "user", "é"), (-5, 1, "user", "é"), (13, 0, "user", "own")]
    rows += [(100 + i, t, "user" if t % 2 == 0 else "assistant", "same" if t < 3 else rnd.choice("ab")) for i in range(60) for t in range(rnd.randint(1, 6))]
    rows += [(200, t, "user", f"turn {t}") for t in range(400)] + [(201, t, "user", "long text " * 20000) for t in range(3)]
    assert plain(talks(spark, tmp_path, rows), NODE) == sorted(brute.op11(rows), key=str)


def test_trie_of_few_conversations(spark, tmp_path):
    assert talks(spark, tmp_path / "a", []).count() == 0
    assert talks(spark, tmp_path / "b", [(None, 1, "user", "x")]).count() == 0
    for i, rows in enumerate(([(3, 0, "user", "x")], [(10, t, "user", "x") for t in range(3)], [(10, t, "u", "x") for t in range(2)] + [(15, t, "u", "x") for t in range(2)])):
        assert plain(talks(spark, tmp_path / f"c{i}", rows), NODE) == sorted(brute.op11(rows), key=str)


# variants -------------------------------------------------------------------------------------------
WORD = ["word", "form", "root", "n", "n_near", "form_n"]


def spelled(spark, path, rows):
    return queries.queries()["op12_spelling_variants"](spark, save(spark, path, "documents", rows, "doc_id long, text string", word="1", n="'n'", strip="2", root="3"))


def test_variants_of_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert plain(queries.queries()["op12_spelling_variants"](spark, SF), WORD) == sorted(brute.op12(rows), key=str)


def test_variants_of_odd_rows(spark, tmp_path):
    many = [(100 + i, "Accommodation ACCOMODATION ÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÀÀÀÀÀÀ colour color colours " + "accommodation " * 6) for i in range(30)]
    rows = [*TEXTS, *many, *((500 + i, "x" * 12000 + " " + "x" * 11999) for i in range(5))]
    assert plain(spelled(spark, tmp_path / "a", rows), WORD) == sorted(brute.op12(rows), key=str)
    assert spelled(spark, tmp_path / "b", []).count() == 0
    assert spelled(spark, tmp_path / "c", [(1, "short few words"), (2, None)]).count() == 0


@pytest.mark.parametrize("strip", [1, 3, 40, 10_000])
def test_near_words_in_strips(spark, strip):
    """Strips of any size find each pair once, also where a third of the words share a beginning or an ending."""
    rnd = random.Random(strip)
    words = {"".join(rnd.choices("aab", k=rnd.randint(2, 8))) for _ in range(150)}
    words |= {"internation" + "".join(rnd.choices("abc", k=rnd.randint(1, 4))) for _ in range(60)} | {"".join(rnd.choices("abc", k=rnd.randint(1, 4))) + "isations" for _ in range(60)} | {"aa", "aaa", "ÿÿ", "ÿÿÿ", "àÿ"}
    edits = lambda w: {w[:i] + w[i + 1 :] for i in range(len(w))}
    holes = lambda w: {(i, w[:i], w[i + 1 :]) for i in range(len(w))}
    want = sorted((a, b, len(b)) for a in words for b in words if a != b and (a in edits(b) or b in edits(a) or holes(a) & holes(b)))
    got = variants.near_words(spark.createDataFrame([(w, len(w)) for w in sorted(words)], "word string, n long"), strip=strip)
    assert sorted(map(tuple, got.collect())) == want


def test_roots_follow_forms(spark):
    words = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("zzzzzz", 9), ("zzzzzy", 44)]
    got = {r["word"]: (r["form"], r["root"]) for r in variants.grouped(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got == {"aaaaaa": ("aaaaab", "aabbbb"), "aaaaab": ("aaaabb", "aabbbb"), "aaaabb": ("aaabbb", "aabbbb"), "aaabbb": ("aabbbb", "aabbbb"), "aabbbb": (None, "aabbbb"), "zzzzzz": (None, "zzzzzz"), "zzzzzy": (None, "zzzzzy")}


# personal data --------------------------------------------------------------------------------------
ENDLESS = ["1", "1 ", "1-", "a", "a.", "1.", "a@", "a@b.", "+", "+1", "@", "+(", "A1", "a@b.c ", "1.2.3.4 ", "0"]
BASE = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]


def data(spark, path, rows):
    return queries.queries()["op13_pii"](spark, save(spark, path, "documents", rows, "doc_id long, text string", pii="1", n_email="'x'", spans="2", kind="3"))


def test_base_spans_of_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert plain(queries.queries()["op13_pii"](spark, SF), BASE) == sorted(brute.op13(rows), key=str)


def test_base_spans_of_odd_rows(spark, tmp_path):
    """Random texts of the patterns' characters, code points beyond the first plane, marks of our own, and texts of one endless run."""
    rnd = random.Random(8)
    pieces = ["a@b.c", "x", "_", "@", ".", "..", "-", " ", "  ", "+", "+1 ", "(", ")", "1", "22", "256", "255", "0", "00255", "4111111111111111", "5500 0000 0000 0004", "😀", "é", "\x01", "\x02", "\x03", "%", "\n", "1.2.3.4", "a.b", "a@b", "+44 20 7946 0958"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(1, 40))) for _ in range(3000)]
    texts += ["".join(rnd.choices("0123456789 -.+@a", k=rnd.randint(1, 120))) for _ in range(3000)]
    texts += [c * 2000 for c in ENDLESS]
    rows = [*TEXTS, *((1000 + i, t) for i, t in enumerate(texts))]
    assert plain(data(spark, tmp_path / "a", rows), BASE) == sorted(brute.op13(rows), key=str)
    assert data(spark, tmp_path / "b", []).count() == 0


def test_endless_runs_stay_linear(spark):
    """No recursion, and no scan from each place, also where the plain patterns would take hours."""
    rows = [(i, c * 100_000) for i, c in enumerate(ENDLESS)]
    got = {r["doc_id"]: r["n"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.size("pii").alias("n")).collect()}
    assert {ENDLESS[i]: n for i, n in got.items() if n} == {"1.": 25_000, "a@b.": 50_000, "a@b.c ": 100_000, "1.2.3.4 ": 100_000}


def found(spark, *texts):
    df = pii.find(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    return [[(s["kind"], t[s["start"] : s["end"]], s["base"]) for s in r["pii"]] for t, r in zip(texts, df.orderBy("doc_id").collect(), strict=True)]


def test_added_spans(spark):
    """Checksums confirm, context words raise and lower; what has neither stays out."""
    got = found(
        spark,
        "IBAN DE89 3704 0044 0532 0130 00, or GB82WEST12345698765432",
        "DE89 3704 0044 0532 0130 01 is wrong, FR82WEST12345698765432 has another length",
        "call me: 555 123-4567",
        "555 123-4567 units",
        "+1 (826) 555-4081 190.137.223.204",
        "SSN 078-05-1120", "serial 078-05-1120", "000-12-3456 and 123-00-4567",
        "7536784127813050 4845168114407329 4111111111111111",
        "write to jane.doe [at] example [dot] org (at) noon",
        "host 2001:0db8:0000:0000:0000:ff00:0042:8329 is up",
        "no data here, 3.14 and 2024-01-31 or 12:30:45",
    )
    assert got == [
        [("iban", "DE89 3704 0044 0532 0130 00", False), ("iban", "GB82WEST12345698765432", False)],
        [],
        [("phone", "555 123-4567", False)],
        [],
        [("ip", "190.137.223.204", True), ("phone", "+1 (826) 555-4081", False)],
        [("ssn", "078-05-1120", False)], [], [],
        [("card", "4845168114407329", False), ("card", "4111111111111111", False)],
        [("email", "jane.doe [at] example [dot] org", False)],
        [("ip", "2001:0db8:0000:0000:0000:ff00:0042:8329", False)],
        [],
    ]


def test_checksums(spark):
    rnd = random.Random(2)
    cards = ["".join(rnd.choices("0123456789", k=rnd.randint(13, 19))) for _ in range(500)]
    accounts = ["DE" + "".join(rnd.choices("0123456789", k=20)) for _ in range(500)] + ["GB82WEST12345698765432", "NO9386011117947"]
    moved = lambda a: int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97 == 1
    got = spark.createDataFrame([(c,) for c in cards], "c string").select("c", pii.luhn(F.col("c"))).collect()
    assert all(ok == brute.luhn(c) for c, ok in got)
    assert all(ok == moved(a) for a, ok in spark.createDataFrame([(a,) for a in accounts], "a string").select("a", pii.mod97(F.col("a"))).collect())


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cc or é😀 +44 20 7946 0958!"), (2, None), (3, "clean")], "doc_id long, text string")
    assert [r["text"] for r in pii.redacted(pii.find(docs)).orderBy("doc_id").collect()] == ["mail <email> or é😀 <phone>!", None, "clean"]


def test_no_python_in_the_plan(spark):
    plan = queries.queries()["op13_pii"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
