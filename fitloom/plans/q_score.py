"""Queries of skills, matching, roles and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import match as M
from ..functions import score as S
from ..functions import skills as K
from ..functions.coerce import half_up
from ..functions.text import normal
from ..operators import corpus, fuzzy, joins
from . import flagship
from .tools import DEGREES, DOMAINS, SCHOOLS, SKILLS, TITLES, WANTED, contains_sql, pick, read, sql_clean, sql_compact, sql_key, sql_list, sql_match, sql_normal, sql_pick, sql_text, stored

Q: dict = {}


def sampled(name: str, values: list[str], fn, sql: str) -> None:
    Q[name] = (
        lambda s, d: read(s, d, "customer").select("c_custkey", pick(values, F.col("c_custkey")).alias("v")).select("c_custkey", fn(F.col("v")).alias("out")),
        f"SELECT c_custkey, {sql} AS out FROM (SELECT c_custkey, {sql_pick(values, 'c_custkey')} AS v FROM customer)",
    )


def _generic_sql(x: str) -> str:
    k = sql_key(x)
    inside = " OR ".join(f"contains({k}, {sql_text(p)})" for p in K.GENERIC_PARTS)
    ends = " OR ".join(f"ends_with({k}, {sql_text(p)})" for p in K.GENERIC_ENDINGS)
    exact = ", ".join(map(sql_text, K.GENERIC))
    kept = ", ".join(map(sql_text, K.KEPT))
    return f"CASE WHEN {k} = '' THEN true WHEN {k} IN ({kept}) THEN false ELSE {k} IN ({exact}) OR {ends} OR {inside} END"


def _titleize_sql(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: CASE WHEN upper(w) = w AND lower(w) <> w AND length(w) <= 5 THEN w ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ')"


def _canonical_sql(x: str) -> str:
    t, k = sql_clean(x), sql_key(x)
    exact = " ".join(f"WHEN {sql_text(a)} THEN {sql_text(b)}" for a, b in K.CANONICAL.items())
    return (
        f"CASE WHEN {t} = '' THEN '' ELSE coalesce(CASE {k} {exact} END, CASE WHEN regexp_matches({k}, '^aws\\s*\\(.*\\)$') THEN 'AWS' WHEN regexp_matches({k}, '^azure\\s*\\(.*\\)$') THEN 'Azure' "
        f"WHEN regexp_matches({k}, '^gcp\\s*\\(.*\\)$') THEN 'GCP' WHEN starts_with({k}, 'oracle ') AND contains({k}, 'database') THEN 'Oracle Database' WHEN {k} = 'rest' THEN 'REST APIs' WHEN {k} = 'apis' THEN 'APIs' "
        f"WHEN {k} IN ({', '.join(map(sql_text, K.CAPITALS))}) THEN upper({t}) WHEN {k} IN ({', '.join(map(sql_text, K.TITLES))}) THEN {_titleize_sql(t)} ELSE {t} END) END"
    )


def _expand_sql(x: str) -> str:
    t, k = sql_clean(x), sql_key(x)
    multi = " ".join(f"WHEN {sql_text(a)} THEN {sql_list(b)}" for a, b in K.MULTI.items())
    parts = f"list_filter(list_transform(string_split({t}, '/'), lambda p: trim(p)), lambda p: p <> '')"
    return f"coalesce(CASE {k} {multi} END, CASE WHEN contains({t}, '/') AND {k} <> 'ci/cd' AND len({parts}) BETWEEN 2 AND 3 THEN {parts} END, [{t}])"


#: Skill texts of a key: four sample skills with mixed delimiters.
def _skill_text(key):
    return F.concat(pick(SKILLS, key), F.lit(","), pick(SKILLS, key, 7, 3), F.lit("; "), pick(SKILLS, key, 3, 1), F.lit("|"), pick(SKILLS, key, 11, 5), F.lit("\n"), pick(SKILLS, key, 13, 2))


def _skill_text_sql(key: str) -> str:
    return f"({sql_pick(SKILLS, key)} || ',' || {sql_pick(SKILLS, key, 7, 3)} || '; ' || {sql_pick(SKILLS, key, 3, 1)} || '|' || {sql_pick(SKILLS, key, 11, 5)} || chr(10) || {sql_pick(SKILLS, key, 13, 2)})"


_ITEMS = f"SELECT p_partkey, generate_subscripts(items, 1) AS i, unnest(items) AS item FROM (SELECT p_partkey, regexp_split_to_array({_skill_text_sql('p_partkey')}, '[,;\\n\\r|]+') AS items FROM part)"
_WIDE = f"SELECT p_partkey, i, generate_subscripts(subs, 1) AS j, unnest(subs) AS sub FROM (SELECT p_partkey, i, {_expand_sql('item')} AS subs FROM ({_ITEMS}))"
_CANON = f"SELECT p_partkey, i, j, {_canonical_sql('sub')} AS skill FROM ({_WIDE})"
_KEPT_SQL = f"SELECT p_partkey, i, j, skill, {sql_key('skill')} AS k FROM ({_CANON}) WHERE NOT ({_generic_sql('skill')})"
_FIRST = f"SELECT p_partkey, i, j, skill, row_number() OVER (PARTITION BY p_partkey, k ORDER BY i, j) AS n FROM ({_KEPT_SQL})"
SKILL_LIST_SQL = f"SELECT p_partkey, string_agg(skill, '~' ORDER BY i, j) AS skills FROM ({_FIRST}) WHERE n = 1 GROUP BY p_partkey"


def _normalized(s, d):
    return read(s, d, "part").select("p_partkey", K.normalize(K.split_list(_skill_text(F.col("p_partkey")))).alias("a"))


Q["SK1"] = (
    lambda s, d: read(s, d, "part").select("p_partkey", F.array_join(K.split_list(_skill_text(F.col("p_partkey"))), "~").alias("items")),
    f"SELECT p_partkey, array_to_string(regexp_split_to_array({_skill_text_sql('p_partkey')}, '[,;\\n\\r|]+'), '~') AS items FROM part",
)
sampled("SK2", SKILLS, lambda c: F.array_join(K.expand(c), "~"), f"array_to_string({_expand_sql('v')}, '~')")
sampled("SK3", SKILLS, K.canonical, _canonical_sql("v"))
sampled("FLT2", SKILLS, K.is_generic, _generic_sql("v"))
Q["SK4"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", pick(SKILLS, F.col("c_custkey")).alias("skill")).where(~K.is_generic(F.col("skill"))),
    f"SELECT c_custkey, skill FROM (SELECT c_custkey, {sql_pick(SKILLS, 'c_custkey')} AS skill FROM customer) WHERE NOT ({_generic_sql('skill')})",
)
Q["SK5"] = (lambda s, d: _normalized(s, d).where(F.size("a") > 0).select("p_partkey", F.array_join("a", "~").alias("skills")), SKILL_LIST_SQL)
Q["DED2"] = (lambda s, d: _normalized(s, d).select("p_partkey", F.size("a").alias("n")), f"SELECT p_partkey, CAST(coalesce(n, 0) AS INT) AS n FROM part LEFT JOIN (SELECT p_partkey AS pk, count(*) AS n FROM ({_FIRST}) WHERE n = 1 GROUP BY 1) ON p_partkey = pk")

# matching: part names and brands of an order against those of another
_NAMES = "SELECT l_orderkey, list_sort(list(DISTINCT p_name)) AS names, list_sort(list(DISTINCT p_brand)) AS brands FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"
_PAIRED = f"SELECT a.l_orderkey, a.names, a.brands, b.names AS onames, b.brands AS obrands FROM ({_NAMES}) a JOIN ({_NAMES}) b ON b.l_orderkey = a.l_orderkey + 1"


def _paired(s, d):
    line = read(s, d, "lineitem").join(read(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sets = line.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_name")).alias("names"), F.array_sort(F.collect_set("p_brand")).alias("brands"))
    other = sets.select((F.col("l_orderkey") - 1).alias("l_orderkey"), F.col("names").alias("onames"), F.col("brands").alias("obrands"))
    return sets.join(other, "l_orderkey").withColumns({"nc": M.compacted(F.col("onames")), "bc": M.compacted(F.col("obrands"))})


_MATCHED = lambda mine, theirs: f"list_filter({mine}, lambda r: len(list_filter({theirs}, lambda o: {sql_match(sql_compact('r'), sql_compact('o'))})) > 0)"
Q["JOI6"] = (
    lambda s, d: read(s, d, "part").select("p_partkey", M.skill_match(F.col("p_brand"), F.concat(F.lit("Brand#"), (F.pmod("p_partkey", F.lit(3)) + 1).cast("string"))).alias("out")),
    f"SELECT p_partkey, {sql_match(sql_compact('p_brand'), sql_compact('w'))} AS out FROM (SELECT p_partkey, p_brand, 'Brand#' || CAST(p_partkey % 3 + 1 AS VARCHAR) AS w FROM part)",
)


def _words(s, d, table):
    """Distinct words of a table's texts."""
    return read(s, d, table).select(F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("word")).distinct()


def _forms(df):
    return stored(df, "forms")


_WORDS = "SELECT DISTINCT c FROM (SELECT {c} AS c FROM (SELECT unnest(string_split(coalesce(text, ''), ' ')) AS w FROM {t})) WHERE c <> ''"
_PAIRS = f"SELECT b.c AS item, d.c AS word FROM ({_WORDS.format(c=sql_compact('w'), t='benchmark')}) b JOIN ({_WORDS.format(c=sql_compact('w'), t='documents')}) d ON {sql_match('b.c', 'd.c')}"
Q["JOI6_tables"] = (
    lambda s, d: fuzzy.matching_forms(_words(s, d, "benchmark"), _words(s, d, "documents"), store=_forms).groupBy(F.col("left_form").alias("item")).agg(F.count("*").alias("n"), F.min("right_form").alias("first"), F.max("right_form").alias("last"), F.sum(F.length("right_form")).alias("letters")),
    f"SELECT item, count(*) AS n, min(word) AS first, max(word) AS last, CAST(sum(length(word)) AS BIGINT) AS letters FROM ({_PAIRS}) GROUP BY item",
)
Q["JOI9_tables"] = (
    lambda s, d: fuzzy.fuzzy_missing(_words(s, d, "benchmark"), _words(s, d, "documents"), "word", "word", store=_forms).select("word"),
    f"SELECT DISTINCT w AS word FROM (SELECT unnest(string_split(coalesce(text, ''), ' ')) AS w FROM benchmark) WHERE {sql_compact('w')} NOT IN (SELECT item FROM ({_PAIRS}))",
)
Q["JOI7"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", M.first_match(F.col("brands")[0], F.col("obrands")).alias("out")),
    f"SELECT l_orderkey, list_filter(obrands, lambda o: {sql_match(sql_compact('brands[1]'), sql_compact('o'))})[1] AS out FROM ({_PAIRED})",
)
Q["JOI8"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", M.matched(F.col("brands"), F.col("bc")).alias("m")).select("l_orderkey", F.size("m").alias("n"), F.array_join("m", ",").alias("items")),
    f"SELECT l_orderkey, CAST(len(m) AS INT) AS n, array_to_string(m, ',') AS items FROM (SELECT l_orderkey, {_MATCHED('brands', 'obrands')} AS m FROM ({_PAIRED}))",
)
Q["JOI9"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", F.array_join(M.unmatched(F.col("names"), F.col("nc")), ",").alias("items")),
    f"SELECT l_orderkey, array_to_string(list_filter(names, lambda r: len(list_filter(onames, lambda o: {sql_match(sql_compact('r'), sql_compact('o'))})) = 0), ',') AS items FROM ({_PAIRED})",
)
_DOM = lambda w, o: f"({w} <> '' AND (contains({o}, {w}) OR contains({w}, {o}) OR len(list_intersect(string_split({w}, ' '), string_split({o}, ' '))) >= 2))"
Q["JOI10"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", M.domains_match(pick(DOMAINS, F.col("c_custkey")), pick(DOMAINS, F.col("c_custkey"), 3, 1)).alias("out")),
    f"SELECT c_custkey, {_DOM('w', 'o')} AS out FROM (SELECT c_custkey, {sql_normal(sql_pick(DOMAINS, 'c_custkey'))} AS w, {sql_normal(sql_pick(DOMAINS, 'c_custkey', 3, 1))} AS o FROM customer)",
)
Q["FLT10"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", M.is_delivery(F.array(pick(SKILLS, F.col("c_custkey")), pick(SKILLS, F.col("c_custkey"), 3, 2))).alias("out")),
    f"SELECT c_custkey, {contains_sql(sql_normal(sql_pick(SKILLS, 'c_custkey')), M.DELIVERY)} OR {contains_sql(sql_normal(sql_pick(SKILLS, 'c_custkey', 3, 2)), M.DELIVERY)} AS out FROM customer",
)
Q["SCR14"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", M.path_score(F.col("brands"), F.col("bc")).alias("out")),
    f"SELECT l_orderkey, CAST(3 * len({_MATCHED('brands', 'obrands')}) AS INT) AS out FROM ({_PAIRED})",
)
Q["DED1"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", F.array_join(M.distinct_in_order(F.array("c_mktsegment", F.lit(""), pick(["BUILDING", "x", "MACHINERY"], F.col("c_custkey")), F.lit(None), F.lit("x"))), ",").alias("out")),
    f"SELECT c_custkey, string_agg(x, ',' ORDER BY i) AS out FROM (SELECT c_custkey, x, min(i) AS i FROM (SELECT c_custkey, unnest([c_mktsegment, '', {sql_pick(['BUILDING', 'x', 'MACHINERY'], 'c_custkey')}, NULL, 'x']) AS x, unnest([1, 2, 3, 4, 5]) AS i FROM customer) WHERE coalesce(x, '') <> '' GROUP BY 1, 2) GROUP BY 1",
)
Q["DED5"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", F.size(F.array_intersect(F.split(normal(pick(DOMAINS, F.col("c_custkey"))), " "), F.split(normal(pick(DOMAINS, F.col("c_custkey"), 3, 1)), " "))).alias("out")),
    f"SELECT c_custkey, CAST(len(list_intersect(string_split({sql_normal(sql_pick(DOMAINS, 'c_custkey'))}, ' '), string_split({sql_normal(sql_pick(DOMAINS, 'c_custkey', 3, 1))}, ' '))) AS INT) AS out FROM customer",
)
Q["DED6"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", F.array_join(F.array_except("names", "onames"), ",").alias("out")),
    f"SELECT l_orderkey, array_to_string(list_filter(names, lambda x: NOT list_contains(onames, x)), ',') AS out FROM ({_PAIRED})",
)
Q["DED7"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", F.size(M.distinct_in_order(F.concat("names", "brands", "onames"))).alias("out")),
    f"SELECT l_orderkey, CAST(len(list_distinct(list_concat(list_concat(names, brands), onames))) AS INT) AS out FROM ({_PAIRED})",
)
Q["SCR13"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", F.array_join(F.array_sort(M.distinct_in_order(F.concat("names", F.flatten(F.array("brands", "obrands"))))), ",").alias("out")),
    f"SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_concat(names, list_concat(brands, obrands)))), ',') AS out FROM ({_PAIRED})",
)
Q["WIN7"] = (
    lambda s, d: _paired(s, d).select("l_orderkey", F.array_join(F.slice("names", 1, 3), ",").alias("out")),
    f"SELECT l_orderkey, array_to_string(names[1:3], ',') AS out FROM ({_PAIRED})",
)

# titles, bands, degrees
_BAND = "CASE " + " ".join(f"WHEN {contains_sql('t', w)} THEN '{b}'" for b, _, w in S.BANDS) + " ELSE 'unspecified' END"
_YEARS = "CASE " + " ".join(f"WHEN {contains_sql('t', w)} THEN {y}" for _, y, w in S.BANDS) + " ELSE 0 END"
_TITLED = f"SELECT c_custkey, {sql_normal(sql_pick(TITLES, 'c_custkey'))} AS t, c_custkey % 4 AS e FROM customer"
Q["SCR9"] = (lambda s, d: read(s, d, "customer").select("c_custkey", S.band(pick(TITLES, F.col("c_custkey"))).alias("band"), S.band_years(S.band(pick(TITLES, F.col("c_custkey")))).alias("years")), f"SELECT c_custkey, {_BAND} AS band, {_YEARS} AS years FROM ({_TITLED})")
Q["SCR11"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", S.required_years(F.pmod("c_custkey", F.lit(4)), pick(TITLES, F.col("c_custkey"))).alias("r")).select("c_custkey", "r.years", "r.signal"),
    f"SELECT c_custkey, CAST(CASE WHEN e > 0 THEN e ELSE {_YEARS} END AS INT) AS years, CASE WHEN e > 0 THEN 'explicit' WHEN {_YEARS} > 0 THEN 'title_inferred' ELSE 'unknown' END AS signal FROM ({_TITLED})",
)
Q["SCR10"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", S.stage(F.col("c_acctbal") / 1000.0).alias("out")),
    "SELECT c_custkey, CASE WHEN c_acctbal / 1000.0 >= 7 THEN 'senior' WHEN c_acctbal / 1000.0 >= 2.5 THEN 'mid' ELSE 'entry' END AS out FROM customer",
)
Q["SCR12"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", S.college_tier(pick(WANTED, F.col("c_custkey")), F.pmod("c_custkey", F.lit(10)) / 10.0).alias("out")),
    f"SELECT c_custkey, CASE WHEN {contains_sql('w', [*S.ELITE_WANTED, *S.MASTER_WANTED])} THEN 'tier_1' WHEN {contains_sql('w', S.BACHELOR_WANTED)} THEN 'tier_2' WHEN dl >= 0.8::DOUBLE THEN 'tier_1' WHEN dl >= 0.4::DOUBLE THEN 'tier_2' ELSE 'tier_3' END AS out FROM (SELECT c_custkey, {sql_normal(sql_pick(WANTED, 'c_custkey'))} AS w, CAST(c_custkey % 10 AS DOUBLE) / 10.0::DOUBLE AS dl FROM customer)",
)
Q["SCR17"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", S.notice(F.pmod("c_custkey", F.lit(20)) / 20.0).alias("out")),
    "SELECT c_custkey, CASE WHEN x > 0.65::DOUBLE THEN 'Immediate' WHEN x > 0.35::DOUBLE THEN '30 Days' ELSE '90 Days' END AS out FROM (SELECT c_custkey, CAST(c_custkey % 20 AS DOUBLE) / 20.0::DOUBLE AS x FROM customer)",
)
Q["SCR19"] = (
    lambda s, d: read(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).select("o_custkey", half_up(S.usage_weight(F.col("n").cast("double")), 9).alias("w")),
    "SELECT o_custkey, floor(1.0::DOUBLE / (1.0::DOUBLE + ln(1.0::DOUBLE + count(*))) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS w FROM orders GROUP BY o_custkey",
)
_MW, _BW, _EW = (contains_sql("w", x) for x in (S.MASTER_WANTED, S.BACHELOR_WANTED, S.ELITE_WANTED))
_BASE = f"CASE WHEN {_MW} THEN CASE WHEN {contains_sql('dg', S.MASTER_HELD)} THEN 1.0::DOUBLE ELSE 0.45::DOUBLE END WHEN {_BW} THEN CASE WHEN dg <> '' THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END ELSE 0.5::DOUBLE END"
Q["SCR5"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", S.education(pick(WANTED, F.col("c_custkey")), pick(DEGREES, F.col("c_custkey"), 5, 1), pick(SCHOOLS, F.col("c_custkey"), 3)).alias("out")),
    f"SELECT c_custkey, CASE WHEN {_EW} THEN CASE WHEN {contains_sql('i', S.ELITE_HELD)} THEN least(1.0::DOUBLE, b + 0.1::DOUBLE) ELSE least(b, 0.55::DOUBLE) END ELSE b END AS out FROM (SELECT *, {_BASE} AS b FROM (SELECT c_custkey, {sql_normal(sql_pick(WANTED, 'c_custkey'))} AS w, {sql_normal(sql_pick(DEGREES, 'c_custkey', 5, 1))} AS dg, {sql_normal(sql_pick(SCHOOLS, 'c_custkey', 3))} AS i FROM customer))",
)
_OBS = [sql_normal(sql_pick(DOMAINS, "c_custkey", t, p)) for t, p in ((3, 1), (7, 2), (1, 4))]
Q["SCR4"] = (
    lambda s, d: read(s, d, "customer").select("c_custkey", S.domain(pick(DOMAINS, F.col("c_custkey")), F.array(*(pick(DOMAINS, F.col("c_custkey"), t, p) for t, p in ((3, 1), (7, 2), (1, 4))))).alias("out")),
    f"SELECT c_custkey, CASE WHEN w = '' THEN 0.5::DOUBLE ELSE coalesce(list_filter(list_transform(list_filter(o, lambda x: x <> ''), lambda x: CASE WHEN contains(x, w) OR contains(w, x) THEN 1.0::DOUBLE WHEN len(list_intersect(string_split(w, ' '), string_split(x, ' '))) >= 2 THEN 0.8::DOUBLE END), lambda x: x IS NOT NULL)[1], 0.35::DOUBLE) END AS out FROM (SELECT c_custkey, {sql_normal(sql_pick(DOMAINS, 'c_custkey'))} AS w, [{', '.join(_OBS)}] AS o FROM customer)",
)

# roles: argmax over a small dimension
ROLES = {
    "full_stack_developer": ["full stack", "fullstack", "mern", "mean", "web developer"],
    "frontend_developer": ["front end", "frontend", "ui developer", "react developer"],
    "backend_developer": ["backend", "api developer", "services engineer"],
    "data_engineer": ["data engineer", "etl engineer", "analytics engineer"],
    "machine_learning_engineer": ["machine learning", "ml engineer", "ai engineer", "artificial intelligence"],
    "devops_engineer": ["devops", "site reliability", "sre", "platform engineer"],
    "cloud_architect": ["cloud architect", "solution architect", "platform architect"],
    "android_developer": ["android"],
    "ios_developer": ["ios", "swift"],
    "product_manager": ["product manager", "product owner", "technical product"],
    "generic_engineering": [],
}
CASCADE = [(["duck creek", "guidewire", "billing developer"], "enterprise_platform_developer"), (["database administrator", "dba"], "database_administrator"), (["full stack", "fullstack"], "full_stack_developer"), (["front end", "frontend"], "frontend_developer"), (["backend"], "backend_developer"), (["spring"], "java_spring_boot_developer"), (["cloud architect"], "cloud_architect"), (["devops", "sre"], "devops_engineer"), (["machine learning", "artificial intelligence"], "machine_learning_engineer"), (["data engineer"], "data_engineer"), (["data scientist"], "data_scientist"), (["android"], "android_developer"), (["ios"], "ios_developer"), (["qa", "test"], "qa_automation_engineer"), (["security"], "cyber_security_analyst")]
#: Edges target -> adjacent role.
ADJACENT = [("full_stack_developer", "frontend_developer"), ("full_stack_developer", "backend_developer"), ("frontend_developer", "full_stack_developer"), ("backend_developer", "full_stack_developer"), ("machine_learning_engineer", "data_engineer"), ("data_engineer", "machine_learning_engineer"), ("devops_engineer", "cloud_architect"), ("cloud_architect", "devops_engineer"), ("android_developer", "ios_developer"), ("ios_developer", "android_developer")]


def role_score(title, alias, hints):
    """Score of a role's own name and hints against a normalised title."""
    words = F.size(F.split(alias, " "))
    shared = F.size(F.array_intersect(F.split(alias, " "), F.split(title, " ")))
    base = F.when(title.contains(alias) | alias.contains(title), words * 4).otherwise(F.greatest(F.lit(0), shared * 2))
    return base + 4 * F.size(F.filter(hints, lambda h: title.contains(h)))


def _roles(s):
    rows = [(r, k, r.replace("_", " "), [h for h in hints]) for k, (r, hints) in enumerate(ROLES.items())]
    return s.createDataFrame(rows, "role string, ord int, alias string, hints array<string>")


def _cascade(t):
    out = F.when(F.lit(False), "")
    for words, role in CASCADE:
        test = M.contains_any(t, words)
        out = out.when(test | (t.startswith("ai ") if role == "machine_learning_engineer" else F.lit(False)), role)
    return out


def _assigned(s, d):
    titles = read(s, d, "customer").select("c_custkey", normal(pick(TITLES, F.col("c_custkey"))).alias("title"), (F.col("c_acctbal") > 5000).alias("manages"))
    t = F.col("title")
    return joins.best_role(titles, "title", _roles(s), role_score(t, F.col("alias"), F.col("hints")), _cascade(t), t.contains("product") & F.col("manages"))


_ROLE_ROWS = ", ".join(f"({sql_text(r)}, {k}, {sql_text(r.replace('_', ' '))}, {sql_list(h) if h else 'CAST([] AS VARCHAR[])'})" for k, (r, h) in enumerate(ROLES.items()))
_RSCORE = "(CASE WHEN contains(title, alias) OR contains(alias, title) THEN 4 * len(string_split(alias, ' ')) ELSE greatest(0, 2 * len(list_intersect(string_split(alias, ' '), string_split(title, ' ')))) END + 4 * len(list_filter(hints, lambda h: contains(title, h))))"
_CASC = "CASE " + " ".join(f"WHEN {contains_sql('title', w)}{" OR starts_with(title, 'ai ')" if r == 'machine_learning_engineer' else ''} THEN '{r}'" for w, r in CASCADE) + " END"
ROLE_SQL = (
    f"WITH roles(role, ord, alias, hints) AS (VALUES {_ROLE_ROWS}), t AS (SELECT c_custkey, {sql_normal(sql_pick(TITLES, 'c_custkey'))} AS title, c_acctbal > 5000 AS manages FROM customer), "
    f"sc AS (SELECT title, role, ord, {_RSCORE} AS sc FROM (SELECT DISTINCT title FROM t), roles), best AS (SELECT title, role AS top, sc FROM sc QUALIFY row_number() OVER (PARTITION BY title ORDER BY sc DESC, ord) = 1), "
    f"named AS (SELECT title, top, sc, CASE WHEN sc <= 0 THEN {_CASC} END AS casc FROM best) "
    "SELECT c_custkey, t.title, manages, CAST(sc AS INT) AS role_score, CASE WHEN casc IS NOT NULL THEN casc WHEN contains(t.title, 'product') AND manages THEN 'product_manager' ELSE top END AS role FROM t JOIN named ON t.title = named.title"
)
Q["JOI11"] = (_assigned, ROLE_SQL)
Q["SCR15"] = (
    lambda s, d: _assigned(s, d).groupBy("role").agg(F.max("role_score").alias("best"), F.count("*").alias("n")),
    f"SELECT role, max(role_score) AS best, count(*) AS n FROM ({ROLE_SQL}) GROUP BY role",
)
_EDGES = ", ".join(f"('{a}', '{b}')" for a, b in ADJACENT)
Q["JOI12"] = (
    lambda s, d: _assigned(s, d).select("c_custkey", "role").join(F.broadcast(s.createDataFrame(ADJACENT, "role string, adjacent string")), "role").select("c_custkey", "role", "adjacent"),
    f"SELECT c_custkey, r.role, adjacent FROM ({ROLE_SQL}) r JOIN (VALUES {_EDGES}) e(role, adjacent) ON r.role = e.role",
)

# the flagship and what follows from it
_AXES = (
    "WITH bought AS (SELECT o_orderkey, o_custkey, o_orderdate, p_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey), "
    "skills AS (SELECT o_orderkey, list_sort(list(DISTINCT p_name)) AS jd_skills FROM bought GROUP BY o_orderkey), "
    "inv AS (SELECT o_custkey, list_sort(list(DISTINCT p_name)) AS inventory, CAST(count(DISTINCT year(o_orderdate)) AS DOUBLE) AS total_years FROM bought GROUP BY o_custkey), "
    "who AS (SELECT c_custkey, n_name, n_regionkey, c_mktsegment, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey), "
    "jd AS (SELECT o.o_orderkey, o.o_custkey, jd_skills, n_name AS jd_role, n_regionkey AS jd_region, c_mktsegment AS jd_domain, o_orderpriority = '1-URGENT' AS jd_manages, len(jd_skills) AS required_years FROM orders o JOIN skills s ON o.o_orderkey = s.o_orderkey JOIN who ON o.o_custkey = c_custkey), "
    f"pre AS (SELECT unnest([0, 1, 2, 3]) AS k, unnest({sql_list(S.PRESETS)}) AS preset), "
    "pairs AS (SELECT *, (o_custkey + 31 * k) % (SELECT count(*) FROM who) AS custkey FROM jd, pre), "
    "cand AS (SELECT c_custkey AS custkey, n_name AS cand_role, n_regionkey AS cand_region, c_mktsegment AS cand_domain, c_acctbal > 5000 AS cand_manages, coalesce(inventory, CAST([] AS VARCHAR[])) AS inventory, coalesce(total_years, 0.0::DOUBLE) AS total_years FROM who LEFT JOIN inv ON c_custkey = o_custkey), "
    "compacted AS (SELECT *, list_transform(inventory, lambda x: " + sql_compact("x") + ") AS cmp FROM cand), "
    "m AS (SELECT p.*, c.* EXCLUDE (custkey), list_filter(jd_skills, lambda r: len(list_filter(cmp, lambda o: " + sql_match(sql_compact("r"), "o") + ")) > 0) AS matched FROM pairs p JOIN compacted c ON p.custkey = c.custkey), "
    "dep AS (SELECT *, list_filter(jd_skills, lambda s: contains(" + sql_normal("s") + ", 'hot') OR contains(" + sql_normal("s") + ", 'cold')) AS needed FROM m), "
    "axes AS (SELECT *, CASE WHEN len(jd_skills) = 0 THEN 0.5::DOUBLE ELSE CAST(len(matched) AS DOUBLE) / len(jd_skills) END AS skill_coverage, least(1.0::DOUBLE, total_years / required_years) AS experience_fit, "
    "CASE WHEN jd_role = cand_role THEN 1.0::DOUBLE WHEN jd_region = cand_region THEN 0.6::DOUBLE ELSE 0.2::DOUBLE END AS role_alignment, "
    "CASE WHEN jd_domain = cand_domain THEN 1.0::DOUBLE ELSE 0.35::DOUBLE END AS domain_alignment, 0.5::DOUBLE AS education_fit, "
    "CASE WHEN len(needed) = 0 THEN 0.5::DOUBLE ELSE CAST(len(list_filter(needed, lambda r: list_contains(matched, r))) AS DOUBLE) / len(needed) END AS deployment_alignment, "
    "CASE WHEN jd_manages THEN CASE WHEN cand_manages THEN 1.0::DOUBLE ELSE 0.45::DOUBLE END ELSE CASE WHEN cand_manages THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END END AS management_alignment FROM dep), "
    "scored AS (SELECT *, floor((" + " + ".join(f"{a} * {w}::DOUBLE" for a, w in S.WEIGHTS.items()) + ") * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS overall, "
    "'jd_' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(5, length(CAST(o_orderkey AS VARCHAR))) AS INT), '0') || '_cand_' || lpad(CAST(k + 1 AS VARCHAR), 2, '0') || '_' || preset AS candidate_id FROM axes), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY overall DESC, k) AS rank FROM scored) "
)
_ALL = ["o_orderkey", "candidate_id", *S.WEIGHTS, "overall"]


def _ranked(s, d):
    return corpus.rank(flagship.scored(s, d), "o_orderkey", "overall", "k")


def entry(s, d):
    return _ranked(s, d).where("rank = 1").select(*_ALL)


for _id, _axis in (("SCR1", "skill_coverage"), ("SCR2", "experience_fit"), ("SCR3", "role_alignment"), ("SCR6", "management_alignment"), ("SCR7", "deployment_alignment"), ("AGG4", "overall")):
    Q[_id] = (lambda s, d, a=_axis: flagship.scored(s, d).select("candidate_id", a), _AXES + f"SELECT candidate_id, {_axis} FROM scored")
_SCR8_TEXT = (
    "array_to_string(['Matches ' || len(matched) || '/' || len(jd_skills) || ' JD skills' || CASE WHEN len(matched) > 0 THEN ' including ' || array_to_string(matched[1:3], ', ') ELSE '' END, "
    "'Shows ' || printf('%.1f', total_years) || ' years against a ' || required_years || '-year target', "
    "CASE WHEN role_alignment = 1.0 THEN 'Same role family' WHEN role_alignment >= 0.6 THEN 'Adjacent role family' ELSE 'Different role family' END, "
    "'Domain alignment ' || printf('%.2f', domain_alignment)] || CASE WHEN jd_manages THEN [CASE WHEN management_alignment >= 0.8 THEN 'Management scope aligned' ELSE 'Limited management evidence' END] ELSE CAST([] AS VARCHAR[]) END, '. ') || '.'"
)


def _scored_full(s, d):
    r = flagship.scored(s, d)
    why = S.rationale(F.col("jd_skills"), F.col("matched"), F.col("total_years"), F.col("required_years"), F.col("role_alignment"), F.col("domain_alignment"), F.col("jd_manages"), F.col("management_alignment"))
    return r.select(*_ALL, why.alias("rationale"))


Q["SCR8"] = (_scored_full, _AXES + f"SELECT {', '.join(_ALL)}, {_SCR8_TEXT} AS rationale FROM scored")
Q["WIN1"] = (lambda s, d: _ranked(s, d).select("o_orderkey", "candidate_id", "overall", F.col("rank").cast("long").alias("rank")), _AXES + "SELECT o_orderkey, candidate_id, overall, rank FROM ranked")
_OK = "CASE preset WHEN 'full_match' THEN overall >= 0.72::DOUBLE WHEN 'balanced' THEN overall >= 0.5::DOUBLE AND overall <= 0.82::DOUBLE WHEN 'hard_negative' THEN overall >= 0.32::DOUBLE AND overall <= 0.72::DOUBLE AND experience_fit <= 0.85::DOUBLE ELSE overall <= 0.45::DOUBLE AND jd_role <> cand_role END"
Q["FLT1"] = (
    lambda s, d: corpus.accepted(flagship.scored(s, d).select("candidate_id", "preset", "overall", "experience_fit", "jd_role", "cand_role"), lambda r: S.fits_preset(r["preset"], r["overall"], r["experience_fit"], r["jd_role"] == r["cand_role"])).select("candidate_id", "preset", "overall"),
    _AXES + f"SELECT candidate_id, preset, overall FROM scored WHERE {_OK}",
)
_PAIRS = _AXES + "SELECT a.o_orderkey, a.candidate_id AS chosen_id, b.candidate_id AS rejected_id, floor((a.overall - b.overall) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS score_gap FROM ranked a JOIN ranked b ON a.o_orderkey = b.o_orderkey AND a.rank < b.rank"
Q["JOI5"] = (lambda s, d: corpus.pairs(_ranked(s, d), "o_orderkey", "overall", "candidate_id", least=-1.0).select("o_orderkey", "chosen_id", "rejected_id", "score_gap"), _PAIRS)
Q["FLT8"] = (lambda s, d: corpus.pairs(_ranked(s, d), "o_orderkey", "overall", "candidate_id").select("o_orderkey", "chosen_id", "rejected_id", "score_gap"), f"SELECT * FROM ({_PAIRS}) WHERE score_gap >= 0.1::DOUBLE")
Q["SCR18"] = (
    lambda s, d: corpus.pairs(_ranked(s, d), "o_orderkey", "overall", "candidate_id").groupBy("pair_type").agg(F.count("*").alias("n")),
    f"SELECT CASE WHEN score_gap >= 0.3::DOUBLE THEN 'clean_preference' ELSE 'hard_example' END AS pair_type, count(*) AS n FROM ({_PAIRS}) WHERE score_gap >= 0.1::DOUBLE GROUP BY 1",
)
Q["JOI15"] = (lambda s, d: flagship.scored(s, d).groupBy("preset").agg(F.count("*").alias("n"), F.min("k").alias("k")), _AXES + "SELECT preset, count(*) AS n, min(k) AS k FROM scored GROUP BY preset")
Q["PRJ8"] = (
    lambda s, d: flagship.scored(s, d).select(F.format_string("jd_%05d", "o_orderkey").alias("jd_id"), "candidate_id"),
    _AXES + "SELECT 'jd_' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(5, length(CAST(o_orderkey AS VARCHAR))) AS INT), '0') AS jd_id, candidate_id FROM scored",
)
Q["PRJ7"] = (
    lambda s, d: flagship.scored(s, d).select("candidate_id", F.regexp_replace("candidate_id", r"_cand_\d+_", "_").alias("resume_id")),
    _AXES + r"SELECT candidate_id, regexp_replace(candidate_id, '_cand_\d+_', '_', 'g') AS resume_id FROM scored",
)
Q["PRJ3"] = (
    lambda s, d: corpus.pointwise(flagship.scored(s, d), "overall").select("o_orderkey", "candidate_id", "instruction", "relevance_score", "relevance_score_0_to_1", "preset"),
    _AXES + f"SELECT o_orderkey, candidate_id, {sql_text(corpus.INSTRUCTION)} AS instruction, floor(overall * 10 * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS relevance_score, overall AS relevance_score_0_to_1, preset FROM scored",
)
Q["PRJ1"] = (
    lambda s, d: flagship.scored(s, d).where("k = 0").select("o_orderkey", F.array_join("jd_skills", ",").alias("core_technical_skills"), F.col("required_years").cast("int").alias("min_experience_years"), F.col("jd_domain").alias("domain"), F.col("jd_manages").alias("is_management_role"), F.col("jd_role").alias("job_title")),
    _AXES + "SELECT o_orderkey, array_to_string(jd_skills, ',') AS core_technical_skills, CAST(required_years AS INT) AS min_experience_years, jd_domain AS domain, jd_manages AS is_management_role, jd_role AS job_title FROM scored WHERE k = 0",
)
Q["PRJ2"] = (lambda s, d: flagship.scored(s, d).select("candidate_id", F.struct("inventory", "total_years", "cand_role", "cand_domain").alias("structured_profile"), F.col("preset").alias("profile_preset"), "overall", F.struct(*S.WEIGHTS).alias("score_breakdown")).select("candidate_id", F.array_join("structured_profile.inventory", ",").alias("skills"), "structured_profile.total_years", "structured_profile.cand_role", "structured_profile.cand_domain", "profile_preset", "overall", "score_breakdown.*"), _AXES + f"SELECT candidate_id, array_to_string(inventory, ',') AS skills, total_years, cand_role, cand_domain, preset AS profile_preset, overall, {', '.join(S.WEIGHTS)} FROM scored")
