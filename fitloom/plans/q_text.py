"""Queries of text functions, filters and coercions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce as C
from ..functions import text as T
from ..operators.external import error_fields
from .tools import ERRORS, LINES_SQL, TITLES, VALUES, contains_sql, first_case, lines_of_orders, pick, read, sql_clean, sql_compact, sql_key, sql_head, sql_normal, sql_pick, sql_text, sql_trim

Q: dict = {}


def docs(name: str, fn, sql: str) -> None:
    """A column function of documents.text against SQL over `text`."""
    Q[name] = (lambda s, d: read(s, d, "documents").select("doc_id", fn(F.col("text")).alias("out")), f"SELECT doc_id, {sql} AS out FROM documents")


def sampled(name: str, values: list[str], fn, sql: str) -> None:
    """A column function of sample values spread over customers, against SQL over `v`."""
    Q[name] = (
        lambda s, d: read(s, d, "customer").select("c_custkey", pick(values, F.col("c_custkey")).alias("v")).select("c_custkey", fn(F.col("v")).alias("out")),
        f"SELECT c_custkey, {sql} AS out FROM (SELECT c_custkey, {sql_pick(values, 'c_custkey')} AS v FROM customer)",
    )


docs("TXT1", T.clean, sql_clean("text"))
docs("TXT2", T.normal, sql_normal("text"))
docs("TXT3", T.compact, sql_compact("text"))
docs("TXT5", T.token_estimate, "CAST(greatest(1, floor((length(text) + 3) / 4)) AS INT)")
docs("TXT6", lambda c: T.trim_budget(c, 300), sql_trim(sql_clean("text"), 1200, 840, 347, False))
docs("TXT7", lambda c: T.trim_chars(c, 2500), sql_trim(sql_clean("text"), 2500, 1800, 687, True))
docs("TXT8", T.summary, f"CASE WHEN length({sql_clean('text')}) > 700 THEN {sql_head(f'substr({sql_clean("text")}, 1, 700)')} ELSE {sql_clean('text')} END")
docs("FLT6", T.looks_complete, "(" + " OR ".join(rf"ends_with(regexp_replace(coalesce(text, ''), '\s+$', ''), '{e}')" for e in T.COMPLETE_ENDINGS) + ")")
docs("JSN7", lambda c: F.to_json(F.struct(F.length(c).alias("n"), F.lit("x").alias("k"))), """'{"n":' || CAST(length(text) AS VARCHAR) || ',"k":"x"}'""")

_KEYED = ["Redis – Cluster", "a / b", "CI /CD", "  Spring   Boot ", "x—y", "Plain"]
sampled("TXT4", _KEYED, T.key, sql_key("v"))
sampled("TXT9", ["senior AWS engineer", "iOS DEV lead", "PYTHON programmer", "", "sql DBA"], T.titleize, f"array_to_string(list_transform(string_split({sql_clean('v')}, ' '), lambda w: CASE WHEN upper(w) = w AND lower(w) <> w AND length(w) <= 5 THEN w ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ')")
_MARKED = ["<think>plan\nmore</think>```json\n{}\n```", "  {\"a\":1} ", "<THINK>x</THINK>yes", "no </think> end", "```JSON x```"]
sampled("TXT10", _MARKED, T.strip_markup, r"trim(regexp_replace(regexp_replace(regexp_replace(trim(replace(v, chr(65279), '')), '(?is)<think>.*?</think>', ' ', 'g'), '(?i)</?think>', ' ', 'g'), '(?i)```json', '```', 'g'))")
sampled("TXT11", ["Asha Rao", "Miles O'Neil", "Li Na Wu"], T.email_slug, "replace(replace(lower(v), ' ', '.'), '''', '')")
sampled("TXT16", TITLES, T.role_family, first_case("lower(v)", [(w, sql_text(f)) for w, f in T.ROLE_FAMILIES], "'Other'"))
sampled("FLT12", ERRORS, T.is_overflow, contains_sql("lower(v)", T.OVERFLOW_MARKERS))
_PLACED = ["worked at XYZ", "WXYZ corp", "abc company ltd", "ABC Corp.", "fine text"]
sampled("FLT3", _PLACED, T.has_placeholder, r"regexp_matches(v, '(?i)\bXYZ\b|ABC Company|ABC Corp')")

Q["TXT12"] = (
    lambda s, d: read(s, d, "part").select("p_partkey", T.sentences(F.array("p_name", F.when(F.col("p_size") > 20, F.col("p_type")), F.lit(""), "p_brand")).alias("out")),
    "SELECT p_partkey, array_to_string(list_transform(list_filter([p_name, CASE WHEN p_size > 20 THEN p_type END, '', p_brand], lambda p: coalesce(p, '') <> ''), lambda p: upper(substr(p, 1, 1)) || substr(p, 2)), '. ') || '.' AS out FROM part",
)
Q["TXT13"] = (lambda s, d: lines_of_orders(s, d), LINES_SQL)
_ERR = "CASE WHEN {0} IS NULL OR regexp_matches(trim({0}), '^[\\[{{]') THEN NULL ELSE nullif(" + sql_clean("{0}") + ", '') END"


def _error_sql(v: str) -> str:
    safe = f"CASE WHEN json_valid({v}) THEN {v} ELSE '{{}}' END"
    parts = []
    for name in ("error", "message", "detail"):
        parts.append(_ERR.format(f"json_extract_string({safe}, '$.{name}')"))
        parts += [f"nullif({sql_clean(f'json_extract_string({safe}, ' + chr(39) + f'$.{name}.{inner}' + chr(39) + ')')}, '')" for inner in ("message", "detail")]
    return f"coalesce({', '.join(parts)}, nullif({sql_clean(v)}, ''), 'HTTP 500')"


sampled("TXT17", ERRORS, lambda c: T.error_message(c, F.lit(500)), _error_sql("v"))

_EMP = "list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(regexp_extract(x, 'at (.+?) \\(', 1))), lambda n: n <> '')"
_DUPE = f"len({_EMP}) <> len(list_distinct({_EMP}))"
Q["FLT4"] = (lambda s, d: lines_of_orders(s, d).select("l_orderkey", T.has_repeated_employer(F.col("body")).alias("out")), f"SELECT l_orderkey, {_DUPE} AS out FROM ({LINES_SQL})")
Q["AGG9"] = (
    lambda s, d: lines_of_orders(s, d).where(T.has_repeated_employer(F.col("body"))).agg(F.count("*").alias("n")),
    f"SELECT count(*) AS n FROM ({LINES_SQL}) WHERE {_DUPE}",
)
Q["FLT5"] = (
    lambda s, d: lines_of_orders(s, d).where(T.quality_ok(F.col("body"))).select("l_orderkey"),
    rf"SELECT l_orderkey FROM ({LINES_SQL}) WHERE NOT regexp_matches(body, '(?i)\bXYZ\b|ABC Company|ABC Corp') AND NOT ({_DUPE})",
)
_GATED = ["Summary\nSkills\nsummary", "Here is the resume", "Name: [Your Name]", "a@b.com and c@d.org", "Skills\nPlain text.", "sure, done"]


def _gates_sql() -> str:
    heads = "list_filter(list_transform(string_split(v, chr(10)), lambda x: lower(trim(x))), lambda x: x IN ('summary', 'skills', 'experience', 'projects', 'details'))"
    return (
        f"CAST(len({heads}) <> len(list_distinct({heads})) AS INT) + 2 * CAST(regexp_matches(lower(v), '^\\s*(here is|here''s|sure|certainly|below is)') AS INT)"
        r" + 4 * CAST(regexp_matches(v, '\[(?:[A-Za-z]+ ?)+\]') AS INT) + 8 * CAST(len(regexp_extract_all(v, '[\w.+-]+@[\w-]+\.[\w.]+')) > 1 AS INT)"
    )


def _gates(c):
    g = T.documented_gates(c)
    return sum((g[n].cast("int") * k for n, k in (("generic_opener", 2), ("bracket_placeholder", 4), ("email_bleed", 8))), g["repeated_header"].cast("int"))


sampled("FLT11", _GATED, _gates, _gates_sql())
Q["FLT7"] = (
    lambda s, d: read(s, d, "documents").join(read(s, d, "labels"), "doc_id", "left").withColumn("_error", F.when(F.col("quality") == 0, "low quality").when(F.col("quality").isNull(), "")).where(F.length(F.coalesce("_error", F.lit(""))) > 0).select("doc_id", "_error"),
    "SELECT doc_id, _error FROM (SELECT d.doc_id, CASE WHEN quality = 0 THEN 'low quality' WHEN quality IS NULL THEN '' END AS _error FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) WHERE length(coalesce(_error, '')) > 0",
)

# coercions
_INT = "CASE WHEN {t} IN ('', 'true', 'false') THEN 90 WHEN contains({t}, 'immediate') THEN 0 ELSE coalesce(try_cast(nullif(regexp_extract({t}, '\\d+', 0), '') AS BIGINT), 90) END"
_LOW = f"lower({sql_clean('v')})"
_SCORE = r"CASE WHEN {t} IN ('correct', 'yes', 'true', 'pass') THEN 1.0::DOUBLE WHEN {t} IN ('incorrect', 'no', 'false', 'fail') THEN 0.0::DOUBLE ELSE coalesce(try_cast(nullif(regexp_extract({t}, '(-?\d+(?:\.\d+)?)\s*%', 1), '') AS DOUBLE) / 100.0::DOUBLE, try_cast(nullif(regexp_extract({t}, '-?\d+(?:\.\d+)?', 0), '') AS DOUBLE)) END"
sampled("JSN1", VALUES, lambda c: C.to_int(c, 90), _INT.format(t=_LOW))
sampled("JSN2", VALUES, lambda c: C.to_bool(c, False), f"CASE WHEN {_LOW} IN ('true', 'yes', '1') THEN true ELSE false END")
sampled("JSN3", VALUES, C.to_score, _SCORE.format(t=_LOW))


def _scores(s, d):
    names = [*C.SCORE_FIELDS, "core_technical_skills", "overall_score"]
    base = read(s, d, "customer").select("c_custkey", *(pick(VALUES, F.col("c_custkey"), 1, k).alias(n) for k, n in enumerate(names)))
    got = C.normal_scores({n: F.col(n) for n in names})
    return base.select("c_custkey", *(got[n].alias("s_" + n) for n in (*names, "valid"))).where("s_valid").drop("s_valid")


def _scores_sql() -> str:
    names = [*C.SCORE_FIELDS, "core_technical_skills", "overall_score"]
    raw = ", ".join(f"{_SCORE.format(t=f'lower({sql_clean(sql_pick(VALUES, chr(99) + "_custkey", 1, k))})')} AS r{k}" for k, n in enumerate(names))
    clamp = lambda x: f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {x}))"
    seven = " + ".join(clamp(f"r{k}") for k in range(7))
    cols = ", ".join(f"{clamp(f'r{k}')} AS s_{n}" for k, n in enumerate(names[:-1]))
    ok = " AND ".join(f"r{k} IS NOT NULL" for k in range(7))
    return f"SELECT c_custkey, {cols}, {clamp(f'coalesce(r7, ({seven}) / 7.0::DOUBLE)')} AS s_overall_score FROM (SELECT c_custkey, {raw} FROM customer) WHERE {ok}"


Q["JSN4"] = (_scores, _scores_sql())
Q["JSN6"] = (
    lambda s, d: read(s, d, "events").select("event_id", F.from_json("props", "k bigint, z bigint").alias("p")).select("event_id", F.col("p.k").isNotNull().alias("has_k"), F.col("p.z").isNotNull().alias("has_z"), F.col("p.k").alias("k")),
    "SELECT event_id, json_extract(props, '$.k') IS NOT NULL AS has_k, json_extract(props, '$.z') IS NOT NULL AS has_z, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
Q["MTH1"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", C.clamp(F.col("c_acctbal") / 5000.0).alias("out")),
    "SELECT c_custkey, greatest(0.0::DOUBLE, least(1.0::DOUBLE, c_acctbal / 5000.0::DOUBLE)) AS out FROM customer",
)
Q["MTH2"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", (F.lit(2025) - F.greatest(F.lit(1), F.bround(F.pmod("c_custkey", F.lit(17)) / 2.0 + F.pmod("c_custkey", F.lit(3)), 0).cast("int"))).alias("graduation_year")),
    "SELECT c_custkey, CAST(2025 - greatest(1, round_even(CAST(c_custkey % 17 AS DOUBLE) / 2.0::DOUBLE + c_custkey % 3, 0)) AS INT) AS graduation_year FROM customer",
)
Q["MTH3"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", *(C.half_up(F.col("c_acctbal") / 7.0, k).alias(f"r{k}") for k in (1, 2, 3))),
    "SELECT c_custkey, " + ", ".join(f"floor(c_acctbal / 7.0::DOUBLE * {10.0**k}::DOUBLE + 0.5::DOUBLE) / {10.0**k}::DOUBLE AS r{k}" for k in (1, 2, 3)) + " FROM customer",
)
Q["MTH4"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", C.half_up(F.abs("c_acctbal"), 3).alias("a"), C.half_up(F.log1p(F.abs("c_acctbal")), 6).alias("l"), C.half_up(F.sqrt(F.abs("c_acctbal")), 6).alias("r"), F.least(F.col("c_acctbal"), F.lit(100.0)).alias("lo"), F.greatest(F.col("c_acctbal"), F.lit(100.0)).alias("hi")),
    "SELECT c_custkey, floor(abs(c_acctbal) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS a, floor(ln(1.0::DOUBLE + abs(c_acctbal)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS l, floor(sqrt(abs(c_acctbal)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS r, least(c_acctbal, 100.0::DOUBLE) AS lo, greatest(c_acctbal, 100.0::DOUBLE) AS hi FROM customer",
)
_STATUS = "CASE c_custkey % 4 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 400 END"


def _backoff(s, d):
    k = F.col("c_custkey")
    status = F.element_at(F.array(F.lit(429), F.lit(503), F.lit(400), F.lit(None).cast("int")), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    wait = C.retry_after(pick(["3", "0.2", "soon", "", "7"], k))
    return read(s, d, "customer").select("c_custkey", C.backoff(F.pmod(k, F.lit(9)) + 1, status, wait, F.pmod(k, F.lit(5)) == 0).alias("seconds"))


_WAIT = f"greatest(0.0::DOUBLE, try_cast(trim({sql_pick(['3', '0.2', 'soon', '', '7'], 'c_custkey')}) AS DOUBLE))"
Q["EXT5"] = (
    _backoff,
    f"SELECT c_custkey, CASE WHEN w > 0 THEN greatest(1.0::DOUBLE, w) WHEN st = 429 THEN a * 5.0::DOUBLE WHEN st >= 500 THEN least(12.0::DOUBLE, a * 2.0::DOUBLE) WHEN c_custkey % 5 = 0 THEN 1.0::DOUBLE ELSE least(8.0::DOUBLE, a) END AS seconds FROM (SELECT c_custkey, CAST(c_custkey % 9 + 1 AS DOUBLE) AS a, {_STATUS} AS st, CASE WHEN try_cast(trim({sql_pick(['3', '0.2', 'soon', '', '7'], 'c_custkey')}) AS DOUBLE) IS NULL THEN NULL ELSE {_WAIT} END AS w FROM customer)",
)
sampled("EXT6", ["3", "0.2", "soon", "", "7", "-4", " 12 "], lambda c: C.retry_after(c), "CASE WHEN try_cast(trim(v) AS DOUBLE) IS NULL THEN NULL ELSE greatest(0.0::DOUBLE, try_cast(trim(v) AS DOUBLE)) END")
_WAITS = ["3", "0.2", "soon", "", "7"]
Q["EXT11"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", error_fields(pick(ERRORS, F.col("c_custkey")), F.lit(500), pick(_WAITS, F.col("c_custkey"), 3)).alias("e")).select("c_custkey", "e.*"),
    f"SELECT c_custkey, m AS message, 500 AS status, CASE WHEN try_cast(trim(w) AS DOUBLE) IS NULL THEN NULL ELSE greatest(0.0::DOUBLE, try_cast(trim(w) AS DOUBLE)) END AS retry_after, {contains_sql('lower(m)', T.OVERFLOW_MARKERS)} AS overflow FROM (SELECT c_custkey, w, {_error_sql('v')} AS m FROM (SELECT c_custkey, {sql_pick(ERRORS, 'c_custkey')} AS v, {sql_pick(_WAITS, 'c_custkey', 3)} AS w FROM customer))",
)
_PAY = ["₹80-90 LPA", "₹67.3 LPA", "₹4,00,000/month", "n/a", "₹12-18 LPA", "10"]
_MAX = r"coalesce(list_max(list_transform(regexp_extract_all(replace(v, ',', ''), '\d+\.?\d*'), lambda x: CAST(x AS DOUBLE))), 0.0::DOUBLE)"
sampled("AGG12", _PAY, C.largest_number, _MAX)
sampled("SCR16", _PAY, lambda c: C.pay_tier(C.largest_number(c)), f"CASE WHEN {_MAX} >= 30 THEN 'tier_1' WHEN {_MAX} >= 20 THEN 'tier_2' WHEN {_MAX} >= 15 THEN 'tier_3' WHEN {_MAX} >= 10 THEN 'tier_4' ELSE 'tier_5' END")


def _record(s, d):
    """Defaulted structured record of loosely typed fields."""
    k = F.col("c_custkey")
    title = T.clean(pick(TITLES, k))
    return read(s, d, "customer").select(
        "c_custkey",
        F.when(title != "", title).otherwise(T.clean(F.col("c_name"))).alias("job_title"),
        F.greatest(F.lit(0).cast("long"), C.to_int(pick(VALUES, k), 0)).alias("min_experience_years"),
        F.when(F.pmod(k, F.lit(3)) == 0, "Not Specified").otherwise(F.col("c_mktsegment")).alias("domain"),
        C.to_bool(pick(VALUES, k, 1, 3)).alias("is_management_role"),
        F.greatest(F.lit(0).cast("long"), C.to_int(pick(VALUES, k, 1, 5), 90)).alias("max_notice_period_days"),
        F.substring(F.coalesce(F.nullif(T.clean(pick(ERRORS, k)), F.lit("")), F.lit("Unknown error")), 1, 500).alias("_error"),
    )


Q["PRJ11"] = (
    _record,
    f"SELECT c_custkey, CASE WHEN {sql_clean(sql_pick(TITLES, 'c_custkey'))} <> '' THEN {sql_clean(sql_pick(TITLES, 'c_custkey'))} ELSE {sql_clean('c_name')} END AS job_title, greatest(0, {_INT.format(t=f'lower({sql_clean(sql_pick(VALUES, chr(99) + "_custkey"))})').replace('THEN 90', 'THEN 0').replace(', 90) END', ', 0) END')}) AS min_experience_years, "
    f"CASE WHEN c_custkey % 3 = 0 THEN 'Not Specified' ELSE c_mktsegment END AS domain, CASE WHEN lower({sql_clean(sql_pick(VALUES, 'c_custkey', 1, 3))}) IN ('true', 'yes', '1') THEN true ELSE false END AS is_management_role, "
    f"greatest(0, {_INT.format(t=f'lower({sql_clean(sql_pick(VALUES, chr(99) + "_custkey", 1, 5))})')}) AS max_notice_period_days, substr(coalesce(nullif({sql_clean(sql_pick(ERRORS, 'c_custkey'))}, ''), 'Unknown error'), 1, 500) AS _error FROM customer",
)
