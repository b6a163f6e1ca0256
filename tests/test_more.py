"""Scores as published, row numbers, headings and lines in blocks, calls over HTTP, jobs and training."""

import datetime as dt
import http.server
import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from fitloom import catalog, job
from fitloom.functions import score as S
from fitloom.functions import skills
from fitloom.operators import corpus, external, generate, http as calls, joins, packing, sampling, training
from fitloom.sources import manifest, readers
from fitloom.streaming import restart

SF = "/root/testdata/sf0.001"

# Published scores and what the functions must make of their axes.
SCORES = """index,job_title,overall_relevance_score,skill_coverage,experience_fit,role_alignment,domain_alignment,education_fit,deployment_alignment,management_alignment,matched_jd_skills,score_rationale
1,Senior Fullstack Developer,0.842,0.667,0.975,1.0,1.0,1.0,0.5,1.0,JavaScript;TypeScript;React;Next.js;Git;CI/CD,"Matches 6/9 JD skills including JavaScript, TypeScript, React. Shows 7.8 years against a 8-year target. Same role family. Domain alignment 1.00."
2,Android Developer,0.739,0.5,0.81,1.0,1.0,1.0,0.5,1.0,Java;Kotlin;NXP;STMicro,"Matches 4/8 JD skills including Java, Kotlin, NXP. Shows 3.9 years, slightly above fresher expectations. Same role family. Domain alignment 1.00."
3,iOS Developer,0.79,0.75,0.625,1.0,1.0,1.0,0.5,1.0,Swift;UIKit;Objective-C,"Matches 3/4 JD skills including Swift, UIKit, Objective-C. Shows 2.5 years against a 4-year target. Same role family. Domain alignment 1.00."
7,Product Manager,0.785,0.5,1.0,1.0,1.0,1.0,0.5,1.0,,Shows 8.7 years against a 8-year target. Same role family. Domain alignment 1.00. Management scope aligned.
14,Engineering Manager,0.596,0.182,0.78,1.0,1.0,1.0,0.2,1.0,JavaScript;Node.js;Docker;Git,"Matches 4/22 JD skills including JavaScript, Node.js, Docker. Shows 7.8 years against a 10-year target. Same role family. Domain alignment 1.00. Management scope aligned."
19,Data Scientist 1,0.676,0.4,0.81,1.0,1.0,1.0,0.0,1.0,SQL;Python,"Matches 2/5 JD skills including SQL, Python. Shows 3.9 years, slightly above fresher expectations. Same role family. Domain alignment 1.00."
27,Validation Engineering Manager,0.595,0.0,1.0,1.0,1.0,1.0,0.5,1.0,,Matches 0/7 JD skills. Shows 5.4 years against a 5-year target. Same role family. Domain alignment 1.00. Management scope aligned.
46,Frontend Developer,0.626,0.286,0.79,1.0,1.0,0.45,0.5,1.0,HTML;CSS;JavaScript;React,"Matches 4/14 JD skills including HTML, CSS, JavaScript. Shows 4.1 years, slightly above fresher expectations. Same role family. Domain alignment 1.00."
72,"Sr. Product Manager - Tech, OPTIMA",0.848,0.667,1.0,1.0,1.0,1.0,0.5,1.0,Tableau;QuickSight,"Matches 2/3 JD skills including Tableau, QuickSight. Shows 8.6 years against a 8-year target. Same role family. Domain alignment 1.00. Management scope aligned."
"""


def test_published_scores(spark, tmp_path):
    """Weights, coverage, experience curve and rationale give the published figures."""
    (tmp_path / "scores.csv").write_text(SCORES, encoding="utf-8")
    rows = readers.scores(spark, f"file://{tmp_path}/scores.csv")
    why = F.col("score_rationale")
    wanted = F.nullif(F.regexp_extract(why, r"Matches \d+/(\d+)", 1), F.lit("")).cast("int")
    years = F.regexp_extract(why, r"Shows ([\d.]+) years", 1).cast("double")
    need = F.coalesce(F.nullif(F.regexp_extract(why, r"against a (\d+)-year", 1), F.lit("")).cast("int"), F.lit(0))
    skills_ = F.when(wanted.isNull(), F.array().cast("array<string>")).otherwise(F.array_repeat(F.lit("x"), wanted))
    said = S.rationale(skills_, F.col("matched_jd_skills"), years, need, F.col("role_alignment"), F.col("domain_alignment"), why.contains("Management"), F.col("management_alignment"))
    got = rows.select(
        "*", S.overall({a: F.col(a) for a in S.WEIGHTS}).alias("again"), said.alias("said"),
        S.coverage(F.size("matched_jd_skills"), F.size(skills_)).alias("covered"), S.experience(years, need).alias("fit"),
    ).collect()
    assert len(got) == 9
    for r in got:
        assert r["again"] == pytest.approx(r["overall_relevance_score"], abs=0.0011)
        assert r["said"] == r["score_rationale"]
        assert r["covered"] == pytest.approx(r["skill_coverage"], abs=0.0006)
        assert r["fit"] == pytest.approx(r["experience_fit"], abs=0.006)


def test_numbers_in_cells(spark, monkeypatch):
    """Places and splits through many cells equal a plain count, null strata and negative keys too."""
    data = [(k * 37 % 1009 - 300, ["a", "b", None][k % 3 if k < 30 else 0]) for k in range(400)]
    df = spark.createDataFrame(data, "k long, s string")
    got = {(r["k"], r["s"]): r["n"] for r in sampling.ordinals(df, "s", "k", "n").collect()}
    for s in ("a", "b", None):
        assert [got[k, s] for k in sorted(k for k, x in data if x == s)] == list(range(1, sum(x == s for _, x in data) + 1))
    parts = {(r["k"], r["s"]): r["split"] for r in sampling.split(df, "s", "k").collect()}
    monkeypatch.setattr(sampling, "DIGITS", 1)
    assert parts == {(r["k"], r["s"]): r["split"] for r in sampling.split(df, "s", "k").collect()}
    for s in ("a", "b", None):
        assert sum(v == "train" for (_, x), v in parts.items() if x == s) == int(sum(x == s for _, x in data) * 0.8)
    assert sampling.split(df.limit(0), "s", "k").count() == sampling.ordinals(df.limit(0), "s", "k", "n").count() == 0


def test_headings_across_chunks(spark, monkeypatch):
    lines = ["| a | ₹31 LPA | x | y | n |", "## TIER 2: X", "| b | ₹5 LPA | x | y | n |", "### Health", "text", "", "| c | ₹5 LPA | x | y | n |", "## Specialized Sectors", "| d | ₹16 LPA | x | y |  |"]
    df = spark.createDataFrame([(f, k, v) for f in ("p", "q") for k, v in enumerate(lines if f == "p" else lines[::-1])], "file string, line_no long, value string")
    want = sorted(tuple(r) for r in readers.companies(df).select("line_no", "tier", "name", "domain").collect())
    assert (6, "tier_2", "c", "Health") in want and (8, "tier_3", "d", "Health") in want
    monkeypatch.setattr(readers, "CHUNK", 2)
    assert sorted(tuple(r) for r in readers.companies(df).select("line_no", "tier", "name", "domain").collect()) == want


def test_lines_in_blocks(spark, tmp_path):
    text = [f"line {k} " + "x" * (k % 50) if k % 9 else "" for k in range(4000)]
    (tmp_path / "a.txt").write_text("\n".join(text), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.lines(spark, f"file://{tmp_path}/a.txt")
        got = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["value"] for r in sorted(got, key=lambda r: r["line_no"])] == text
    assert sorted(r["line_no"] for r in got) == list(range(1, 4001))


def test_raw_skills(spark):
    got = spark.range(1).select(readers.raw_skills(F.lit("react js, aws (ec2); leadership\nPython")).alias("s")).first()["s"]
    assert "Python" in got and "leadership" not in got
    assert skills.GENERIC


def test_windowed_counts(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")]
    spark.createDataFrame(rows, "t string, k string").select(F.to_timestamp("t").alias("ts"), "k").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, k string").parquet(f"{tmp_path}/in")
    q = restart.windowed_counts(stream, "ts", "k").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination(60)
    assert sorted((str(r["window_start"]), r["k"], r["n"]) for r in spark.table("counted").collect()) == [("2024-01-01 00:00:00", "a", 2), ("2024-01-01 01:00:00", "b", 1)]


class Chat(http.server.BaseHTTPRequestHandler):
    protocol_version, seen = "HTTP/1.1", []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Chat.seen.append((dict(self.headers), body))
        text = body["messages"][0]["content"]
        code = {"busy": 429, "long": 400, "odd": 200}.get(text, 200)
        out = {"busy": '{"error": "wait"}', "long": '{"error": {"message": "maximum context length exceeded"}}', "odd": "[]"}.get(text, json.dumps({"choices": [{"message": {"content": text.upper()}}]}))
        self.send_response(code)
        self.send_header("Content-Length", str(len(out.encode())))
        if code == 429:
            self.send_header("Retry-After", "7")
        self.end_headers()
        self.wfile.write(out.encode())

    def log_message(self, *_):
        pass


def test_client_over_http(monkeypatch):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Chat)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("MODEL_API_KEY", "k1")
    c = calls.Client(f"http://127.0.0.1:{server.server_port}/v1/chat", "small")
    assert c.complete("é hi", {"temperature": 0}) == "É HI"
    headers, body = Chat.seen[0]
    assert headers["Authorization"] == "Bearer k1" and all(headers[k] == v for k, v in calls.HEADERS.items())
    assert body == {"model": "small", "messages": [{"role": "user", "content": "é hi"}], "temperature": 0}
    with pytest.raises(external.CallError) as e:
        c.complete("busy", {})
    assert (e.value.status, e.value.retry_after, e.value.overflow) == (429, 7.0, False)
    with pytest.raises(external.CallError) as e:
        c.complete("long", {})
    assert e.value.status == 400 and e.value.overflow
    with pytest.raises(external.CallError):
        c.complete("odd", {})
    server.shutdown()
    server.server_close()
    c.line.close()
    with pytest.raises(external.CallError):
        c.complete("x", {})


def test_job(spark, tmp_path):
    args = ["SMP1", "--data", SF, "--out", f"file://{tmp_path}/out"]
    assert job.run(spark, job.options([*args, "--order", "c_custkey", "--limit", "5"])).count() == 5
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 5
    job.run(spark, job.options([*args[:-1], f"file://{tmp_path}/lines", "--format", "jsonl"]))
    assert spark.read.json(f"file://{tmp_path}/lines").count() == 75
    for bad in (["nothing", *args[1:]], [*args, "--limit", "3"], args[:3]):
        with pytest.raises(SystemExit):
            job.options(bad)


def test_training_examples(spark):
    df = spark.createDataFrame([("a b", "1"), ("a b", "0"), ("c", None), ("w " * 30 + "w", "1")], "prompt string, answer string")
    rows = training.examples(df, most=20).collect()
    assert sorted((r["text"], r["n_prompt"], r["n_all"]) for r in rows) == [("a b 0", 2, 3), ("a b 1", 2, 3)]
    model = training.fit(training.examples(df), training.Mean)
    assert sorted(float(r["answer"]) for r in training.generate(model, df).collect()) == [0.0, 0.5, 0.5, 1.0]


def test_dimensions_are_checked(spark, monkeypatch):
    few = spark.range(10)
    assert "broadcast" in joins.bounded(few, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in joins.bounded(few, 9)._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(joins, "SMALL", 1)
    with pytest.raises(ValueError, match="roles"):
        catalog.queries()["JOI11"](spark, SF)
    monkeypatch.setattr(generate, "POOL", 3)
    with pytest.raises(Exception, match="more than 3 companies"):
        catalog.queries()["SMP11"](spark, SF).collect()


def test_accepted_keeps_rows_and_columns(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert [tuple(r) for r in corpus.accepted(df, lambda r: r["x"] > 4).collect()] == [(3, 6), (4, 8)]


def test_attempts_end(spark):
    """Every row gets one candidate: the first accepted attempt, or the last."""
    tries = []

    def make(rows):
        tries.append(rows.count())
        n = F.col("attempt")
        return rows.withColumns({"overall": F.when(F.col("id") % 3 == n % 3, 0.9).otherwise(0.1), "experience_fit": F.lit(0.1), "jd_role": F.lit("a"), "role": F.lit("a")})

    rows = spark.range(9).withColumn("preset", F.when(F.col("id") == 8, "mismatch").otherwise("full_match"))
    got = sorted((r["id"], r["attempt"], r["accepted"]) for r in generate.accepted(rows, ["id"], make, lambda df: df, 4).collect())
    assert got == [(i, 4, False) if i == 8 else (i, {1: 1, 2: 2, 0: 3}[i % 3], True) for i in range(9)]
    assert tries == [9, 6, 4, 1]
    once = generate.accepted(rows, ["id"], make, lambda df: df, 4, at_once=True).collect()
    assert sorted((r["id"], r["attempt"], r["accepted"]) for r in once) == got and tries[4:] == [9, 18]


def test_company_usage_in_rounds_flattens(spark):
    """Companies that earlier rounds drew are drawn less: the counts of eight rounds are flatter than those of one."""
    from collections import Counter

    from fitloom.operators import generate as G
    from fitloom.plans import profiles as P
    from fitloom.plans import q_generate as q
    from fitloom.plans.tools import stored

    jds = q.jds(spark, SF).withColumn("domain", F.lit("Retail"))
    make = lambda rows, usage: q.generate(rows, spark, "companies", usage)

    def spread(rounds):
        out = G.in_rounds(jds, F.pmod("jd_id", F.lit(rounds)), rounds, P.companies(spark), make, lambda df: stored(df, "round")).select("jd_id", "round", "company.name", "company.tier").collect()
        assert len(out) == jds.count() and {r["round"] for r in out} == set(range(rounds))
        n = Counter(r["name"] for r in out)
        tiers = Counter(r["tier"] for r in out)
        return sum(v * v for v in n.values()) / sum(n.values()) ** 2, tiers

    one, _ = spread(1)
    eight, _ = spread(8)
    assert eight < one


def test_parts_of_a_candidate(spark):
    """A part makes its own columns and what it needs; no row carries the pool or a profile on."""
    from fitloom.plans import q_generate as q

    jds = q.jds(spark, SF).limit(3)
    companies = q.generate(jds, spark, "companies")
    assert {"company", "previous", "preferred"} <= set(companies.columns) and "bundle" not in companies.columns
    scored = q.generate(jds, spark)
    assert "projects" in scored.columns and not [c for c in scored.columns if c.startswith(("p_", "f_", "c_"))]
    plan = companies._jdf.queryExecution().optimizedPlan().toString()
    assert "project_name" not in plan


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_fuzzy_join_of_tables(spark, block):
    """All pairs that match and no others, whatever the blocks of common runs; no product of the tables in the plan."""
    import random

    from fitloom.operators import fuzzy

    rnd = random.Random(block)
    words = lambda n: ["".join(rnd.choices("ab", k=rnd.randint(0, 9))) for _ in range(n)] + [None, "", "  ", "Aa-bb", "prefix" + "ab" * 3, "Prefix"]
    a, b = words(80), words(120)
    plain = lambda x: "".join(c for c in (x or "").lower() if c.isalnum())
    match = lambda x, y: bool(x and y and (x == y or len(x) >= 4 and x in y or len(y) >= 4 and y in x))
    left, right = spark.createDataFrame([(i, x) for i, x in enumerate(a)], "i int, x string"), spark.createDataFrame([(i, y) for i, y in enumerate(b)], "k int, y string")
    got = fuzzy.fuzzy_join(left, right, "x", "y", block)
    assert sorted((r["i"], r["k"]) for r in got.collect()) == [(i, k) for i, x in enumerate(a) for k, y in enumerate(b) if match(plain(x), plain(y))]
    assert "CartesianProduct" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    missing = fuzzy.fuzzy_missing(left, right, "x", "y", block)
    assert sorted(r["i"] for r in missing.collect()) == [i for i, x in enumerate(a) if not any(match(plain(x), plain(y)) for y in b)]


def test_calls_of_a_killed_task_are_paid_once(spark, tmp_path):
    """A worker dies half way; the run after it reads the log and calls for the rest only."""
    import os
    import uuid

    class Paid:
        """A fake server: it notes every call it answers, and takes its worker down at one of them, once."""

        def complete(self, prompt, settings):
            if len(os.listdir(tmp_path / "paid")) >= 25 and not (tmp_path / "died").exists():
                (tmp_path / "died").touch()
                os._exit(1)
            (tmp_path / "paid" / f"{prompt}.{uuid.uuid4().hex}").touch()
            return "bad" if prompt.endswith("-0") else prompt.upper()

    (tmp_path / "paid").mkdir()
    rows = spark.createDataFrame([(i, [f"p{i}-0", f"p{i}-1", f"p{i}-2"]) for i in range(40)], "id int, prompts array<string>").repartition(3)
    run = lambda: external.complete(rows, "prompts", Paid, rpm=1e9, good=lambda t: t != "bad", log=f"file://{tmp_path}/log", key="id", tasks=1).collect()
    with pytest.raises(Exception):
        run()
    assert len(os.listdir(tmp_path / "paid")) == 25
    got = run()
    assert sorted((r["id"], r["answer"], r["tries"]) for r in got) == [(i, f"P{i}-1", 2) for i in range(40)]
    paid = [x.partition(".")[0] for x in os.listdir(tmp_path / "paid")]
    assert sorted(paid) == sorted(f"p{i}-{n}" for i in range(40) for n in (0, 1))
    run()
    assert len(os.listdir(tmp_path / "paid")) == 80


def test_window_of_calls(spark):
    """Calls in flight overlap, and keep to the rate together."""
    import time

    class Slow:
        def complete(self, prompt, settings):
            time.sleep(0.2)
            return prompt

    rows = spark.createDataFrame([(i, [f"p{i}"]) for i in range(32)], "id int, prompts array<string>").coalesce(1)
    began = time.time()
    assert len(external.complete(rows, "prompts", Slow, rpm=1e9, tasks=1, in_flight=16).collect()) == 32
    assert time.time() - began < 5
    clock = external.Limiter(60, 1, now=lambda: 0.0, sleep=lambda x: None)
    for _ in range(5):
        clock.wait()
    assert clock.free == 5.0


def test_commits_of_a_table(spark, tmp_path, monkeypatch):
    """Repeats add nothing, null keys and repeated keys have their rule, a writer that dies or loses leaves the old state."""
    from fitloom.sources.manifest import Conflict, Table

    t = Table(spark, f"file://{tmp_path}/t", "k int, v string")
    rows = lambda: sorted(((r["k"], r["v"]) for r in t.read().collect()), key=str)
    batch = spark.createDataFrame([(1, "a"), (None, "n"), (2, "z"), (2, "b"), (None, "m")], "k int, v string")
    assert rows() == [] and t.append(batch, "one", "k") == 1
    assert rows() == [(1, "a"), (2, "b"), (None, "m")]
    assert t.append(batch, "one", "k") == 1 and t.append(batch, "again", "k") == 2 and len(rows()) == 3
    more = spark.createDataFrame([(3, "c"), (None, "x")], "k int, v string")
    with monkeypatch.context() as m:
        m.setattr(t, "_commit", lambda *_: (_ for _ in ()).throw(OSError("killed after its files, before its manifest")))
        with pytest.raises(OSError):
            t.append(more, "two", "k")
        with pytest.raises(OSError):
            t.replace(t.read().where("k = 1"))
    assert t.version() == 2 and len(rows()) == 3
    with pytest.raises(Conflict):
        t._commit(1, {"folders": [], "batches": []})
    assert t.append(more, "two", "k") == 3 and rows() == [(1, "a"), (2, "b"), (3, "c"), (None, "m")]
    t.replace(t.read().withColumn("v", F.upper("v")))
    assert rows() == [(1, "A"), (2, "B"), (3, "C"), (None, "M")]
    assert t.read(3).count() == 4 and t.vacuum() > 0 and len(rows()) == 4 and t.append(more, "two", "k") == 4


def test_appends_of_null_and_repeated_keys(spark, tmp_path):
    from fitloom.sources import sinks

    df = spark.createDataFrame([(1, "a"), (None, "n"), (2, "z"), (2, "b")], "k int, v string")
    for _ in range(3):
        sinks.append_new(df, f"{tmp_path}/t", "k")
    assert sorted(((r["k"], r["v"]) for r in readers.jsonl(spark, f"{tmp_path}/t", "k int, v string").collect()), key=str) == [(1, "a"), (2, "b"), (None, "n")]


def test_elements_go_to_their_own_end(spark):
    """Nested, unclosed, void-like, commented and oddly written tags against a plain parser."""
    import random
    from html.parser import HTMLParser

    class First(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.depth, self.found, self.text = 0, False, []

        def handle_starttag(self, tag, attrs):
            if tag == "div" and self.depth:
                self.depth += 1
            elif tag == "div" and not self.found and "job-desc" in (dict(attrs).get("class") or ""):
                self.depth, self.found = 1, True

        def handle_startendtag(self, tag, attrs):
            if tag == "div" and not self.depth and "job-desc" in (dict(attrs).get("class") or ""):
                self.found = True

        def handle_endtag(self, tag):
            self.depth -= bool(self.depth and tag == "div")

        def handle_data(self, data):
            self.text += [data] if self.depth else []

    rnd = random.Random(6)
    parts = ['<div class="job-desc">', "<div class='x job-desc y'>", "<DIV id=a>", "<div>", "</div>", "</div>", "</DIV >", "<p>", "</p>", "<divide>", "<br/>", "<div/>", "<!-- <div> -->", " words ", "more", "<section class='job-desc'>", "</section>", "\n"]
    pages = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(1500)] + ["<div class=job-desc>" + "<div>a" * 3000 + "</div>" * 3000 + "b</div>c", ""]
    want = []
    for page in pages:
        p = First()
        p.feed(page)
        p.close()
        want.append(" ".join("".join(x if x.strip() else " " for x in p.text).split()) if p.found else None)
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", readers.strip_tags(readers.element(F.col("html"), "div", "(?i:job-desc)")).alias("t"), readers.element(F.col("html"), "div", "(?i:job-desc)").isNull().alias("none")).orderBy("i").collect()
    squeeze = lambda x: "".join((x or "").split())
    assert [None if r["none"] else squeeze(r["t"]) for r in df] == [None if w is None else squeeze(w) for w in want]


def plain_bins(sizes, room):
    """Best fit from the largest down, each bin looked at."""
    out = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        free = [(room - sum(sizes[j] for j in b), n) for n, b in enumerate(out)]
        fits = [x for x in free if x[0] >= sizes[i]]
        if fits:
            out[min(fits)[1]].append(i)
        else:
            out.append([i])
    return out


def test_bins_against_plain_best_fit():
    rnd = random.Random(3)
    for n in (0, 1, 7, 300):
        sizes = [rnd.randint(1, 50) for _ in range(n)]
        assert packing.bins(sizes, 50) == plain_bins(sizes, 50)


def test_packed_rows_against_plain_tokens(spark, monkeypatch):
    """Every example once and whole, prompts masked, whatever the partitions; odd chats have their defined results."""
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CELL", 100)
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    rnd = random.Random(4)
    some = lambda n: " ".join(f"word{rnd.randrange(50)}" for _ in range(rnd.randint(1, n)))
    chats = [(str(k), [("system", "Judge."), ("user", some(40)), ("assistant", some(15))]) for k in range(600)]
    chats += [("two", [("user", "a"), ("assistant", "b"), ("user", "c\nd"), ("assistant", "é")]), (None, [("user", "x"), ("assistant", "y")])] + [("same", [("user", "x"), ("assistant", "y")])] * 250
    chats += [("null", None), ("none", []), ("asks", [("user", "only a question")]), ("long prompt", [("user", "long " * 300), ("assistant", "z")]), ("long answer", [("user", "q"), ("assistant", "long " * 300)]), ("gaps", [(None, "x"), ("assistant", None)])]
    want = []
    for key, chat in chats:
        ids, labels = [], []
        for role, content in chat or []:
            head, body = (coder.encode(t, add_special_tokens=False).ids for t in (f"<|im_start|>{role or ''}\n", (content or "") + "<|im_end|>\n"))
            ids += head + body
            labels += [-100] * len(head) + (body if role == "assistant" else [-100] * len(body))
        if any(x != -100 for x in labels[:256]):
            want.append((key, ids[:256], labels[:256]))
    assert {"two", "same", "long answer", "gaps"} <= {k for k, _, _ in want} and not {"null", "none", "asks", "long prompt"} & {k for k, _, _ in want}
    df = spark.createDataFrame(chats, "id string, messages array<struct<role: string, content: string>>")
    results = []
    for n in (1, 7):
        rows = packing.tokenised(df.repartition(n), "id", path, most=256)
        assert rows.where("id = 'same'").select("copy").distinct().count() == 250
        packs = packing.packed(rows, "id", room=256, tasks=2).collect()
        got = []
        for p in packs:
            assert len(p["ids"]) == len(p["labels"]) == sum(p["lengths"]) <= 256 and len(p["keys"]) == len(p["lengths"])
            at = 0
            for k, m in zip(p["keys"], p["lengths"], strict=True):
                got.append((k, p["ids"][at : at + m], p["labels"][at : at + m]))
                at += m
        order = lambda x: (x[0] or "", x[1])
        assert sorted(got, key=order) == sorted(want, key=order)
        assert len({p["pack"] for p in packs}) == len(packs)
        assert sum(len(p["ids"]) for p in packs) > 0.9 * 256 * len(packs)
        results.append(sorted((p["pack"], p["keys"], p["ids"]) for p in packs if None not in p["keys"]))
    assert results[0] == results[1]
    assert packing.packed(packing.tokenised(df.limit(0), "id", path), "id").count() == 0
    with pytest.raises(Exception, match="is the most"):
        packing.packed(packing.tokenised(df, "id", path, most=256), "id", room=200).count()


def test_whole_table_is_packed_full(spark):
    got = catalog.queries()["EXT9_packed"](spark, SF).collect()
    chats = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert sum(r["n_examples"] for r in got) >= chats and all(0 < r["n_trained"] < r["n_tokens"] <= 1024 for r in got)
    assert sum(r["n_tokens"] for r in got) > 0.95 * 1024 * (len(got) - 8)


def test_stream_adds_each_key_once(spark, tmp_path):
    """A key comes again within a delivery, in the next run and after a crash between commit and checkpoint."""
    schema = "k long, ts timestamp, v string"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    day = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    t = manifest.Table(spark, f"{tmp_path}/t", schema)
    run = lambda table: restart.once(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), table, f"{tmp_path}/cp", "k", "ts", "2 hours").awaitTermination()
    put([(1, day(1), "a"), (1, day(1), "a"), (2, day(2), "b"), (None, day(2), "c"), (3, None, "d")])
    run(t)
    put([(2, day(2), "b"), (4, day(3), "e")])

    class Dies:
        has = staticmethod(t.has)

        def append(self, batch, name):
            t.append(batch, name)
            raise RuntimeError("lost after the commit")

    with pytest.raises(Exception, match="lost after the commit"):
        run(Dies())
    assert sorted(r["k"] for r in t.read().collect()) == [1, 2, 4]
    run(t)
    run(t)
    put([(4, day(3), "e"), (5, day(9), "f"), (6, day(1, 30), "late, but the newest time so far is 3")])
    run(t)
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [(1, "a"), (2, "b"), (4, "e"), (5, "f"), (6, "late, but the newest time so far is 3")]
