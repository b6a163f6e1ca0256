"""Queries of sampling inside a row, candidate generation, prompts and external calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rng
from ..functions import score as S
from ..functions.coerce import half_up
from ..functions.match import compacted
from ..functions.text import COMPLETE_ENDINGS, CUT
from ..operators import external as X
from ..operators import generate as G
from ..operators import http, training
from . import profiles as P
from . import sql_generate as sql
from .flagship import bought
from .tools import DOMAINS, TITLES, WANTED, pick, read, scratch, sql_clean, sql_pick, sql_text, sql_trim, sql_u, stored

Q: dict = {}
K = F.col
_SKILLS = ["Python", "Kafka", "AWS", "React", "SQL", "Docker", "Java", "TypeScript", "Terraform", "Airflow"]
_ROLE = list(P.ADJACENT)


def jds(s, d):
    """Customers as job descriptions, each with the four presets, for a first attempt."""
    k = K("c_custkey")
    base = read(s, d, "customer").select(
        k.alias("jd_id"), pick(TITLES, k).alias("job_title"), pick(_ROLE, k).alias("jd_role"),
        F.array_distinct(F.array(*(pick(_SKILLS, k, t, p) for t, p in ((1, 0), (3, 1), (7, 2), (9, 5))))).alias("skills"),
        pick(DOMAINS, k, 3).alias("domain"), F.pmod(k, F.lit(9)).cast("int").alias("min_years"), (F.pmod(k, F.lit(6)) == 0).alias("manages"), pick(WANTED, k, 5).alias("education"),
    )
    return base.withColumn("preset", F.explode(F.array(*map(F.lit, S.PRESETS)))).withColumn("attempt", F.lit(1))


def generate(rows, s, part="scored", usage=None):
    return G.candidates(rows, P.profiles(s), P.companies(s), P.colleges(s), P.ADJACENT, P.MISMATCH, P.METRIC_BRANCHES, P.METRIC_NAMES, usage=usage, part=part)


def made(s, d, part="scored"):
    return generate(jds(s, d), s, part)


def _keyed(s, d):
    return jds(s, d).withColumn("__key", F.concat_ws("|", "jd_id", "preset", "attempt"))


# draws inside a row ---------------------------------------------------------------------------------
_CHAIN = sql.chain(_SKILLS, _ROLE)
_U = lambda salt: sql_u("k", salt)
Q["SMP3"] = (
    lambda s, d: _keyed(s, d).select("__key", F.array_join(rng.subset(K("skills"), F.lit(2), K("__key"), "some"), ",").alias("kept")),
    _CHAIN + f"SELECT key AS __key, array_to_string({sql.subset('skills', '2', 'some')}, ',') AS kept FROM jd",
)
Q["SMP4"] = (
    lambda s, d: read(s, d, "customer").select(K("c_custkey").alias("k"), half_up(rng.jitter(F.lit(0.5), K("c_custkey"), "j"), 6).alias("dial")),
    f"SELECT k, floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE + 0.06::DOUBLE * (sqrt(-2.0::DOUBLE * ln({_U('j.a')})) * cos(2.0::DOUBLE * pi() * {_U('j.b')})))) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS dial FROM (SELECT c_custkey AS k FROM customer)",
)
Q["SMP5"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", half_up(rng.truncated(K("c_custkey"), "t", F.lit(5.0), F.lit(2.0), F.lit(4.5), F.lit(5.5)), 6).alias("x")),
    f"SELECT key AS c_custkey, {sql.half_up(sql.truncated('t', *map(sql.number, (5, 2, 4.5, 5.5))), 6)} AS x FROM (SELECT c_custkey AS key FROM customer)",
)
Q["SMP6"] = (
    lambda s, d: _keyed(s, d).select("__key", "preset", G.match_count(F.pmod("jd_id", F.lit(9)).cast("int"), F.lit(0.5), K("preset"), K("__key")).alias("n")),
    _CHAIN + f"SELECT key AS __key, preset, {sql.match_count('CAST(jd_id % 9 AS INT)', sql.number(0.5))} AS n FROM jd",
)

# candidates -----------------------------------------------------------------------------------------
_flat = lambda c: F.array_join(c, ",").alias(c)
_lists = lambda c: F.array_join(F.transform(c, lambda x: F.array_join(x, "+")), ",")


def _jobs():
    one = lambda e: F.array_join(F.array(e["company"], e["company_domain"], e["role_domain"], F.format_string("%.1f", e["duration_years"]), e["role_title"], F.array_join(e["primary_tech_stack"], "+"), F.array_join(e["focus_areas"], "+")), "/")
    return F.array_join(F.transform("experience", one), ",")


def _figures(m):
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "+")


def _projects():
    one = lambda p: F.array_join(F.array(p["project_name"], p["project_domain"], p["business_problem"], p["architecture_type"], F.array_join(p["technologies_used"], "+"), p["complexity_tier"], F.array_join(p["impact_signals"], "+"), _figures(p["quantitative_metrics"]), p["resume_fit_reason"]), "/")
    return F.array_join(F.transform("projects", one), ",")


for _id, _part, _cols, _sql in (
    ("SMP7", "skills", lambda: [_flat("kept"), _flat("bundle"), _flat("available")], "array_to_string(kept, ',') AS kept, array_to_string(bundle, ',') AS bundle, array_to_string(available, ',') AS available"),
    ("SMP8", "paths", lambda: [_lists("paths").alias("paths")], "array_to_string(list_transform(paths, lambda p: array_to_string(p, '+')), ',') AS paths"),
    ("SMP9", "persona", lambda: [K("target")], "target"),
    ("SMP10", "persona", lambda: [K("years")], "years"),
    ("SMP11", "companies", lambda: [K("company.name").alias("company"), K("company.tier").alias("company_tier"), K("previous.name").alias("previous"), K("previous.tier").alias("previous_tier")], "company.name AS company, company.tier AS company_tier, previous.name AS previous, previous.tier AS previous_tier"),
    ("SMP12", "school", lambda: [K("school.institution").alias("institution"), K("school.degree").alias("degree"), K("school.graduation_year").alias("graduation_year"), K("stage")], "institution, degree, graduation_year, stage"),
    ("SMP13", "focus", lambda: [F.array_join("now_focus", ",").alias("focus")], "array_to_string(now_focus, ',') AS focus"),
    ("SMP14", "experience", lambda: [_jobs().alias("experience")], "array_to_string(experience, ',') AS experience"),
    ("SMP16", "persona", lambda: [G.label(K("target"), K(G.KEY), "context").alias("context")], sql.label("context") + " AS context"),
    ("SMP17", "metrics", lambda: [F.array_join(F.transform("metrics", _figures), ",").alias("metrics")], "array_to_string(metrics, ',') AS metrics"),
    ("SMP18", "projects", lambda: [_projects().alias("projects"), F.array_join(F.transform("projects", lambda p: F.array_join(p["impact_signals"], "+")), ",").alias("impacts")], "array_to_string(done, ',') AS projects, array_to_string(shown, ',') AS impacts"),
    ("WIN5", "paths", lambda: [_lists(F.transform("ranked", lambda r: r["p"])).alias("ranked")], "array_to_string(list_transform(every_path, lambda p: array_to_string(p, '+')), ',') AS ranked"),
    ("WIN6", "templates", lambda: [F.array_join(F.transform("chosen", lambda t: t["name"]), ",").alias("templates")], "array_to_string(list_transform(chosen, lambda t: t.name), ',') AS templates"),
):
    Q[_id] = (lambda s, d, p=_part, c=_cols: made(s, d, p).select("jd_id", "preset", *c()), _CHAIN + f"SELECT jd_id, preset, {_sql} FROM made")
Q["SMP11_usage"] = (
    lambda s, d: G.in_rounds(jds(s, d), F.pmod("jd_id", F.lit(2)), 2, P.companies(s), lambda rows, usage: generate(rows, s, "companies", usage), lambda df: stored(df, "round")).select("jd_id", "preset", "round", K("company.name").alias("company"), K("previous.name").alias("previous")),
    sql.in_rounds(_SKILLS, _ROLE, 2) + "SELECT jd_id, preset, CAST(round AS INT) AS round, company.name AS company, previous.name AS previous FROM drawn",
)
_SCORES = [*S.WEIGHTS, "total_years", "overall", "rationale"]
Q["SMP20"] = (lambda s, d: made(s, d).select("jd_id", "preset", *_SCORES), sql.scored(_SKILLS, _ROLE) + f"SELECT jd_id, preset, {', '.join(_SCORES)} FROM scored")
Q["SMP15"] = (
    lambda s, d: jds(s, d).where("preset = 'balanced'").select("jd_id", F.array_join(G.stack(F.array(F.array(F.lit("Java"), F.lit("Git"))), K("skills"), 4), ",").alias("stack")),
    "SELECT c_custkey AS jd_id, array_to_string(list_transform(list_sort(list_transform(list_filter(range(1, 7), lambda i: list_position(a, a[i]) = i), lambda i: i))[1:4], lambda i: a[i]), ',') AS stack FROM (SELECT c_custkey, ['Java', 'Git'] || [" + ", ".join(f"({'[' + ', '.join(map(sql_text, _SKILLS)) + ']'})[CAST((c_custkey * {t} + {p}) % 10 + 1 AS BIGINT)]" for t, p in ((1, 0), (3, 1), (7, 2), (9, 5))) + "] AS a FROM customer)",
)
Q["SMP19"] = (
    lambda s, d: G.accepted(jds(s, d).drop("attempt"), ["jd_id", "preset"], lambda rows: generate(rows, s).select("jd_id", "preset", "attempt", "jd_role", "role", "experience_fit", "overall"), lambda df: stored(df, "attempt"), ends=(1, 3, 6)).select("jd_id", "preset", "attempt", "accepted", "overall"),
    sql.scored(_SKILLS, _ROLE, 6) + f", tried AS (SELECT *, {sql.ACCEPTED} AS accepted FROM scored) SELECT jd_id, preset, CAST(attempt AS INT) AS attempt, accepted, overall FROM tried QUALIFY row_number() OVER (PARTITION BY jd_id, preset ORDER BY CASE WHEN accepted THEN attempt ELSE 1000 - attempt END) = 1",
)
Q["SMP21"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", G.contact(K("c_name")).alias("c")).select("c_custkey", "c.*"),
    f"SELECT c_custkey, name, city, phone, translate(lower(name), ' ', '.') || {sql.integer('m', 1, 99)} || '@' || {sql.choice(sql.lit(G.MAILS), 'd')} AS email FROM (SELECT c_custkey, c_name AS key, {sql.choice(sql.lit(G.FIRST_NAMES), 'first')} || ' ' || {sql.choice(sql.lit(G.LAST_NAMES), 'last')} AS name, {sql.choice(sql.lit(G.CITIES), 'city')} AS city, "
    f"'+91 ' || {sql.integer('p1', 6, 9)} || lpad(CAST({sql.integer('p2', 100_000_000, 999_999_999)} AS VARCHAR), 9, '0') AS phone FROM (SELECT *, c_name AS key FROM customer))",
)
_NAMED = f"SELECT p_partkey AS key, p_name, {sql_pick(DOMAINS, 'p_partkey')} AS target FROM part"
Q["TXT15"] = (
    lambda s, d: read(s, d, "part").select("p_partkey", G.project_name(K("p_name"), pick(DOMAINS, K("p_partkey")), K("p_partkey"), "n").alias("name"), G.problem(F.lit("Made it work."), pick(DOMAINS, K("p_partkey")), F.lit("mid"), K("p_partkey"), "p").alias("problem")),
    f"WITH named AS ({_NAMED}), " + sql.project_steps("named", "x", "p_name", "n", "name") + f" SELECT key AS p_partkey, name, {sql.problem(sql_text('Made it work.'), sql_text('mid'), 'p')} AS problem FROM x",
)


# external calls -------------------------------------------------------------------------------------
class Echo:
    """A stand-in client: it fails on some prompts, once or always, and else answers with chat around JSON."""

    def __init__(self):
        self.seen: dict[int, int] = {}

    def complete(self, prompt: str, settings: dict) -> str:
        n = self.seen[hash(prompt)] = self.seen.get(hash(prompt), 0) + 1
        if len(prompt) % 11 == 0:
            raise X.CallError("prompt is too long", 400, overflow=True)
        if len(prompt) % 7 == 0 and n == 1:
            raise X.CallError("slow down", 429, retry_after=0.0)
        return f'Sure.\n```json\n{{"job_title": "t{len(prompt) % 5}", "domain": "d", "note": [1, {{"x": 2}}]}}\n```\nDone (1 LPA.'


def _echo(length: str) -> str:
    """SQL of Echo's answer to a prompt of this length."""
    return f"""'Sure.' || chr(10) || '```json' || chr(10) || '{{"job_title": "t' || ({length} % 5) || '", "domain": "d", "note": [1, {{"x": 2}}]}}' || chr(10) || '```' || chr(10) || 'Done (1 LPA.'"""


def _calls(rows: str, key: str, prompts: list[str], passing: str | None = None) -> str:
    """SQL of what calls with Echo make of a table's prompts p1, p2, ...: key, answer, _error and tries; passing is a
    test of an answer's prompt length n."""
    n = len(prompts)
    over = lambda i: f"length(p{i}) % 11 = 0"
    again = lambda i: " OR ".join(f"p{j} = p{i}" for j in range(1, i)) or "false"
    good = lambda i: f"(NOT {over(i)} AND (length(p{i}) % 7 <> 0 OR {again(i)}))"
    done = lambda i: f"{good(i)} AND {passing.format(n=f'length(p{i})')}" if passing else good(i)
    tries = "CASE " + " ".join(f"WHEN {done(i)} THEN {i}" for i in range(1, n + 1)) + f" ELSE {n} END"
    length = "CASE " + " ".join(f"WHEN tries >= {i} AND {good(i)} THEN length(p{i})" for i in range(n, 0, -1)) + " END"
    made_ = f"SELECT {key}, " + ", ".join(f"{p} AS p{i}" for i, p in enumerate(prompts, 1)) + f" FROM ({rows})"
    return f"SELECT {key}, {_echo('n')} AS answer, CASE WHEN n IS NULL THEN CASE WHEN {over(n)} THEN 'prompt is too long' ELSE 'slow down' END END AS _error, CAST(tries AS INT) AS tries FROM (SELECT *, {length} AS n FROM (SELECT *, {tries} AS tries FROM ({made_})))"


def _fast(rpm: float, tasks: int) -> X.Limiter:
    return X.Limiter(rpm, tasks, now=lambda: 0.0, sleep=lambda _: None)


def _answers(s, d):
    docs = read(s, d, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", X.extraction_prompts(F.concat(F.lit("Title "), "doc_id"), K("text")).alias("prompts"))
    return X.complete(rows, "prompts", Echo, limiter=_fast)


def _paced(s, d):
    """When each call of a task may start, at 55 a minute over four tasks, on a clock that only waiting moves."""
    def run(pdf):
        clock = [0.0]
        pace = X.Limiter(55, 4, now=lambda: clock[0], sleep=lambda x: clock.__setitem__(0, clock[0] + x))
        starts = []
        for _ in range(len(pdf)):
            pace.wait()
            starts.append(clock[0])
        return pdf.sort_values("c_custkey").assign(start=starts)[["c_custkey", "start"]]

    rows = read(s, d, "customer").select("c_custkey", F.pmod("c_custkey", F.lit(4)).alias("task"))
    return rows.groupBy("task").applyInPandas(run, "c_custkey long, start double").select("c_custkey", half_up(K("start"), 3).alias("start"))


Q["EXT4"] = (_paced, "SELECT c_custkey, floor((row_number() OVER (PARTITION BY c_custkey % 4 ORDER BY c_custkey) - 1) * 240.0::DOUBLE / 55.0::DOUBLE * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS start FROM customer")


def _extraction(step: float) -> str:
    """SQL of the prompt of one try."""
    most = 4 * max(X.LEAST_TOKENS, int(X.TOKENS * step))
    head = int(most * 0.7)
    return f"{sql_text(X.EXTRACT)} || 'Title ' || doc_id || chr(10) || chr(10) || 'Text:' || chr(10) || {sql_trim('t', most, head, most - head - len(CUT), False)}"


def _judge(text: str, record: str) -> str:
    return f"{sql_text(X.JUDGE)} || {sql_trim(text, 2500, 1800, 2500 - 1800 - len(CUT), True)} || chr(10) || chr(10) || 'Record:' || chr(10) || {record}"


_EXTRACTED = _calls(f"SELECT doc_id, {sql_clean('text')} AS t FROM documents", "doc_id", [_extraction(x) for x in X.TRIM_STEPS])
_JUDGED = f"SELECT d.doc_id, {sql_clean('text')} AS t, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
_RECORD = """'{"doc_id":' || doc_id || ',"quality":' || quality || ',"toxic":' || toxic || '}'"""
Q["EXT1"] = (lambda s, d: _answers(s, d).select("doc_id", "answer", "_error", "tries"), _EXTRACTED)
Q["EXT2"] = (
    lambda s, d: X.complete(read(s, d, "documents").join(read(s, d, "labels"), "doc_id").select("doc_id", X.judge_prompts(K("text"), F.struct("doc_id", "quality", "toxic")).alias("prompts")), "prompts", Echo, rpm=10, settings={"temperature": 0}, limiter=_fast).select("doc_id", "answer", "_error", "tries"),
    _calls(_JUDGED, "doc_id", [_judge("t", _RECORD)] * 3),
)


def _repeated(start: str, mark: str, times: int = 1) -> str:
    """SQL, for either engine, of a prompt of a customer whose length goes with the id."""
    return f"concat({sql_text(start)}, c_name, repeat({sql_text(mark)}, CAST(c_custkey % 23 * {times} AS INT)))"


Q["EXT3"] = (
    lambda s, d: X.complete(read(s, d, "customer").select("c_custkey", F.array_repeat(F.expr(_repeated("Write a resume for ", "!")), 3).alias("prompts")), "prompts", Echo, settings={"temperature": 0.7, "max_tokens": 800}, limiter=_fast).select("c_custkey", "answer", "_error"),
    f"SELECT c_custkey, answer, _error FROM ({_calls('SELECT * FROM customer', 'c_custkey', [_repeated('Write a resume for ', '!')] * 3)})",
)
Q["EXT7"] = (
    lambda s, d: X.complete(read(s, d, "customer").select("c_custkey", F.array(*(F.expr(_repeated("Again for ", "?", i)) for i in range(1, 5))).alias("prompts")), "prompts", Echo, good=lambda t: "t3" in t, limiter=_fast).select("c_custkey", "answer", "tries"),
    f"SELECT c_custkey, answer, tries FROM ({_calls('SELECT * FROM customer', 'c_custkey', [_repeated('Again for ', '?', i) for i in range(1, 5)], '{n} % 5 = 3')})",
)
Q["JSN5"] = (
    lambda s, d: X.salvaged(_answers(s, d).select("doc_id", "answer"), "answer").select("doc_id", "json"),
    f"""SELECT doc_id, '{{"job_title": "' || regexp_extract(answer, '"job_title": "([^"]*)"', 1) || '", "domain": "d", "note": [1, {{"x": 2}}]}}' AS json FROM ({_EXTRACTED})""",
)
#: Chatter with two objects: the second has a required field in two of three rows, else it equals the first in rank, and the first counts.
_SECOND = ['{"z": 1}', '{"k": 1, "job_title": "x"}']
Q["WIN9"] = (
    lambda s, d: X.salvaged(read(s, d, "events").select("event_id", F.concat(F.lit("Here: "), "props", F.lit(" or "), F.when(K("event_id") % 3 == 0, _SECOND[0]).otherwise(_SECOND[1])).alias("answer")), "answer").select("event_id", "json"),
    f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props ELSE {sql_text(_SECOND[1])} END AS json FROM events",
)
Q["TXT14"] = (
    lambda s, d: read(s, d, "documents").select("doc_id", X.judge_prompts(K("text"), F.struct("doc_id", "lang"))[0].alias("prompt")),
    "SELECT doc_id, " + _judge("t", """'{"doc_id":' || doc_id || ',"lang":"' || lang || '"}'""") + f" AS prompt FROM (SELECT doc_id, lang, {sql_clean('text')} AS t FROM documents)",
)
class Silent:
    """A client that must not be called."""

    def complete(self, prompt: str, settings: dict) -> str:
        raise RuntimeError("called again")


def _resumed(s, d):
    """Extraction as a job that is run again with the log of a first run: no call is made twice."""
    docs = read(s, d, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", X.extraction_prompts(F.concat(F.lit("Title "), "doc_id"), K("text")).alias("prompts"))
    log = scratch(s, "calls")
    X.complete(rows, "prompts", Echo, limiter=_fast, log=log, key="doc_id", in_flight=1, group=256).write.format("noop").mode("overwrite").save()
    return X.complete(rows, "prompts", Silent, limiter=_fast, log=log, key="doc_id", in_flight=8)


Q["EXT1_resumed"] = (lambda s, d: _resumed(s, d).select("doc_id", "answer", "_error", "tries"), _EXTRACTED)
_HEADERS = """'{"Content-Type":"application/json","Accept":"application/json","User-Agent":"fitloom/1.0"}'"""
Q["EXT8"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", http.request(F.concat(F.lit("Hello "), "c_name"), "small", {"temperature": 0.7, "max_tokens": 800}).alias("r")).select("c_custkey", F.to_json("r.headers").alias("headers"), "r.body"),
    f"""SELECT c_custkey, {_HEADERS} AS headers, '{{"model":"small","messages":[{{"role":"user","content":"Hello ' || c_name || '"}}],"temperature":0.7,"max_tokens":800}}' AS body FROM customer""",
)
_ENDS = " OR ".join(rf"ends_with(regexp_replace(answer, '\s+$', ''), {sql_text(e)})" for e in COMPLETE_ENDINGS)
Q["to_retry"] = (lambda s, d: X.failed(_answers(s, d)).select("doc_id", "_error"), f"SELECT doc_id, _error FROM ({_EXTRACTED}) WHERE _error IS NOT NULL OR answer IS NULL OR NOT ({_ENDS})")


def _chats(s, d):
    """Documents as prompts, with the label as the answer where there is one."""
    rows = read(s, d, "documents").select("doc_id", F.concat_ws(" ", F.lit("Rate"), "lang", "source").alias("prompt"))
    return rows.join(read(s, d, "labels").select("doc_id", K("quality").cast("string").alias("answer")), "doc_id", "left")


Q["EXT9"] = (
    lambda s, d: training.generate(training.fit(training.examples(_chats(s, d)), training.Mean), _chats(s, d)).select("doc_id", "n_prompt", half_up(K("answer").cast("double"), 6).alias("predicted")),
    f"SELECT d.doc_id, CAST(len(string_split(prompt, ' ')) AS INT) AS n_prompt, {sql.half_up('coalesce(m, 0.0::DOUBLE)', 6)} AS predicted FROM (SELECT doc_id, 'Rate ' || lang || ' ' || source AS prompt FROM documents) d LEFT JOIN (SELECT 'Rate ' || lang || ' ' || source AS p, CAST(avg(quality) AS DOUBLE) AS m FROM documents x JOIN labels l ON x.doc_id = l.doc_id GROUP BY 1) t ON prompt = p",
)
Q["inventory_match"] = (lambda s, d: bought(s, d).groupBy("o_custkey").agg(F.array_sort(F.collect_set("p_name")).alias("inventory")).select("o_custkey", F.size(compacted(K("inventory"))).alias("n")), "SELECT o_custkey, CAST(count(DISTINCT p_name) AS INT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey")
