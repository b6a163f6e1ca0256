"""Hand-written rows for branches that tables don't reach."""

import pytest
from pyspark.sql import functions as F

from fitloom.functions import coerce as C
from fitloom.functions import match as M
from fitloom.functions import score as S
from fitloom.functions import skills as K
from fitloom.functions import text as T
from fitloom.operators import corpus, external, generate, joins, sampling
from fitloom.sources import readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [(None, ""), ("", ""), (" a\t\nb ", "a b")])
def test_clean(spark, text, want):
    assert one(spark, T.clean(F.lit(text))) == want


def test_trims_without_blanks(spark):
    long = "x" * 5000
    assert one(spark, T.trim_budget(F.lit(long), 300)) == "x" * 840 + T.CUT + "x" * 347
    assert one(spark, T.summary(F.lit(long))) == "x" * 700
    assert one(spark, T.trim_chars(F.lit("a b"))) == "a b"


@pytest.mark.parametrize(("years", "required", "want"), [(2.0, 0, 1.0), (5.0, 0, 0.7), (9.0, 0, 0.38), (20.0, 0, 0.3), (3.0, 6, 0.5), (9.0, 6, 1.0)])
def test_experience(spark, years, required, want):
    assert one(spark, S.experience(F.lit(years), F.lit(required))) == pytest.approx(want)


@pytest.mark.parametrize(
    ("wanted", "degree", "school", "want"),
    [("Master's", "MBA", "", 1.0), ("Master's", "BSc", "", 0.45), ("Bachelor", "", "", 0.6), ("Bachelor", "BSc", "", 1.0), ("IIT graduate", "BSc", "IIT Delhi", 1.0), ("IIT graduate", "BSc", "City College", 0.55), (None, "BSc", "", 0.5)],
)
def test_education(spark, wanted, degree, school, want):
    assert one(spark, S.education(F.lit(wanted).cast("string"), F.lit(degree), F.lit(school))) == pytest.approx(want)


@pytest.mark.parametrize(("seen", "want"), [([], 0.35), (["x banking services y"], 0.8), (["retail", "services of banking", "banking services"], 0.8), (["banking services"], 1.0)])
def test_domain_first_hit_counts(spark, seen, want):
    observed = F.array(*map(F.lit, seen)) if seen else F.array().cast("array<string>")
    assert one(spark, S.domain(F.lit("banking and services"), observed)) == pytest.approx(want if seen != ["banking services"] else 0.8)
    assert one(spark, S.domain(F.lit(""), observed)) == 0.5


def test_management_and_role(spark):
    grid = [[one(spark, S.management(F.lit(a), F.lit(b))) for b in (True, False)] for a in (True, False)]
    assert grid == [[1.0, 0.45], [0.7, 1.0]]
    assert [one(spark, S.role(F.lit(a), F.lit(b))) for a, b in ((True, True), (False, True), (False, False))] == [1.0, 0.6, 0.2]


def test_skill_matching(spark):
    pairs = [("Java", "JavaScript", True), ("C", "C#", True), ("SQL", "NoSQL", False), ("", "x", False), ("Spring-Boot", "spring boot", True)]
    assert [one(spark, M.skill_match(F.lit(a), F.lit(b))) for a, b, _ in pairs] == [w for *_, w in pairs]


def test_skills_keep_first_of_a_key(spark):
    raw = F.array(*map(F.lit, ["React JS", "react", "JavaScript/TypeScript", "AI", "aws (s3)", "Kafka", "KAFKA", "", "a/b"]))
    assert one(spark, K.normalize(raw)) == ["React", "JavaScript", "TypeScript", "AWS", "Kafka", "a", "b"]
    assert one(spark, K.normalize(F.lit(None).cast("array<string>"))) == []


def test_scores_need_all_fields(spark):
    base = {n: F.lit("1") for n in [*C.SCORE_FIELDS, "core_technical_skills"]}
    full = C.normal_scores(base | {"overall_score": F.lit(None).cast("string")})
    assert one(spark, full["overall_score"]) == 1.0
    assert one(spark, C.normal_scores(base | {"domain": F.lit("?"), "overall_score": F.lit("50%")})["valid"]) is False


def test_pairs_at_the_gaps(spark):
    rows = spark.createDataFrame([(1, "a", 0.9, 0), (1, "b", 0.8, 1), (1, "c", 0.5, 2), (1, "d", 0.8, 3), (2, "e", 0.3, 0)], "jd int, name string, s double, n int")
    ranked = corpus.rank(rows, "jd", "s", "n")
    assert [r["name"] for r in ranked.where("jd = 1").orderBy("rank").collect()] == ["a", "b", "d", "c"]
    found = {(r["chosen_id"], r["rejected_id"]): (r["score_gap"], r["pair_type"]) for r in corpus.pairs(ranked, "jd", "s", "name").collect()}
    assert found == {("a", "b"): (0.1, "hard_example"), ("a", "d"): (0.1, "hard_example"), ("a", "c"): (0.4, "clean_preference"), ("b", "c"): (0.3, "clean_preference"), ("d", "c"): (0.3, "clean_preference")}


def test_keep_last_ignores_tombstones(spark):
    rows = spark.createDataFrame([("a", 1, "good"), ("a", 2, None), ("b", 1, "x"), ("b", 2, "y")], "id string, line int, t string")
    assert {(r["id"], r["t"]) for r in joins.keep_last(rows, ["id"], ["line"], F.col("t").isNotNull()).collect()} == {("a", "good"), ("b", "y")}


def test_splits_are_disjoint_and_stable(spark):
    rows = spark.range(1000).withColumn("g", F.col("id") % 7)
    a = {(r["id"], r["split"]) for r in sampling.split(rows, "g", "id").collect()}
    b = {(r["id"], r["split"]) for r in sampling.split(rows.repartition(13), "g", "id").collect()}
    assert a == b and len(a) == 1000
    assert sampling.stratified(rows, "g", "id", "id", 50).count() == 50


def test_candidates_do_not_depend_on_partitions(spark):
    from fitloom.plans import profiles as P
    from fitloom.plans import q_generate

    jds = q_generate.jds(spark, "/root/testdata/sf0.001").where("jd_id < 6")
    make = lambda n: sorted(map(str, generate.candidates(jds.repartition(n), P.profiles(spark), P.companies(spark), P.colleges(spark), P.ADJACENT, P.MISMATCH, P.METRIC_BRANCHES, P.METRIC_NAMES).select("jd_id", "preset", "overall", "experience", "projects").collect()))
    assert make(1) == make(5)


def test_salvage():
    assert external.salvage('Sure! {"a": 1} and {"job_title": "x", "domain": "y"} done') == {"job_title": "x", "domain": "y"}
    assert external.salvage("<think>{\"job_title\": 1}</think>```json\n[{\"a\": 1}, {\"domain\": \"d\"}]\n```") == {"domain": "d"}
    assert external.salvage("nothing") is None and external.salvage(None) is None


def test_calls_retry_and_keep_tombstones():
    class Flaky:
        def __init__(self):
            self.n = 0

        def complete(self, prompt, settings):
            self.n += 1
            if prompt == "bad" or self.n == 1:
                raise external.CallError("busy", 429, retry_after=2)
            return prompt.upper()

    slept = []
    clock = [0.0]
    pace = external.Limiter(60, now=lambda: clock[0], sleep=lambda s: (slept.append(s), clock.__setitem__(0, clock[0] + s)))
    assert external.call(Flaky(), ["x", "y", "z"], pace, {}) == ("Y", None, 2)
    assert external.call(Flaky(), ["bad", "bad"], pace, {}) == (None, "busy", 2)
    assert external.call(Flaky(), ["x", "a", "b"], pace, {}, good=lambda t: t == "B")[0] == "B"
    assert slept[0] == 2


def test_round_trip_and_restart(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é", None), (2, "b", "x")], "id int, t string, n string")
    path = f"file://{tmp_path}/out"
    sinks.append_new(rows, path, "id")
    sinks.append_new(rows.union(spark.createDataFrame([(3, "c", "z")], rows.schema)), path, "id")
    got = readers.jsonl(spark, path, "id int, t string, n string").collect()
    assert sorted(r["id"] for r in got) == [1, 2, 3]
    assert '"n":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))


def test_stream_reads_each_file_once(spark, tmp_path):
    from fitloom.streaming.restart import incremental

    src, out, check = (f"file://{tmp_path}/{n}" for n in ("in", "out", "check"))
    sinks.write_jsonl(spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string"), src)
    for _ in range(2):
        incremental(spark, src, out, check, "id int, t string", "id", lambda df: df.withColumn("t", F.upper("t"))).awaitTermination()
    sinks.write_jsonl(spark.createDataFrame([(2, "b"), (3, "c")], "id int, t string"), src, "append")
    incremental(spark, src, out, check, "id int, t string", "id", lambda df: df.withColumn("t", F.upper("t"))).awaitTermination()
    assert sorted((r["id"], r["t"]) for r in spark.read.schema("id int, t string").json(out).collect()) == [(1, "A"), (2, "B"), (3, "C")]


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "env").write_text('# c\nA_KEY="1"\nB_KEY=\'2\'\nbad\n')
    monkeypatch.setenv("B_KEY", "9")
    assert readers.settings(str(tmp_path / "env")) == {"A_KEY": "1", "B_KEY": "9"}


def test_tables_and_tiers(spark, tmp_path):
    (tmp_path / "c.md").write_text("# x\n## TIER 2: A\n### Pay\n| Company | CTC |\n|---|---|\n| Acme | ₹20 LPA | a | b | Fast |\n| | ₹1 | a | b | c |\n## SPECIALIZED SECTORS\n| Zed | ₹12-33 LPA | a | b | |\n")
    got = readers.companies(readers.lines(spark, f"file://{tmp_path}/c.md")).select("tier", "name", "domain", "tags").collect()
    assert [tuple(r) for r in got] == [("tier_2", "Acme", "Pay", ["fast"]), ("tier_1", "Zed", "Pay", [])]


def test_entry_module_stands_alone(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(3).count() == 3
