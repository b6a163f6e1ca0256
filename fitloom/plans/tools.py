"""Helpers of the registered queries: tables, literal samples for Spark and SQL, shared SQL pieces."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CUT
from .flagship import read

__all__ = ["read", "pick", "sql_pick", "sql_text", "sql_list", "sql_clean", "sql_normal", "sql_compact", "sql_key", "sql_match", "sql_u", "contains_sql", "first_case", "lines_of_orders", "LINES_SQL", "scratch", "stored", "sql_trim", "sql_head"]

TITLES = ["Senior Java Developer", "Data Engineer II", "Principal Cloud Architect", "DevOps / SRE Lead", "Frontend Developer", "iOS Engineer", "Product Manager", "QA Automation", "", "Machine Learning Engineer", "Full Stack Developer (MERN)", "Database Administrator", "UI/UX Designer", "Site Reliability Engineer", "Back End Dev", "Guidewire Billing Developer", "Head of Engineering", "Android Developer III", "Security Analyst", "Office Clerk"]
SKILLS = ["react js", "REST API", "aws (ec2, s3)", "CI/CD", "ci cd pipelines", "JavaScript/TypeScript", "ECS/EKS", "machine learning algorithms", "leadership", "Azure Synapse Analytics", "data quality frameworks", "agile methodologies", "oracle 12c database", "rest", "apis", "sql", "docker", "JENKINS", "Spring  Boot", "Java / Kotlin / Scala", "a/b/c/d", "", "  ", "AI", "helm chart", "Node JS", "postgres", "PostgreSQL", "Redis–Cluster", "gcp", "Azure (AKS)", "problem solving", "C#", "grafana", "ChatGPT", "Kafka", "kafka", "vector databases", "public, private and hybrid cloud technologies", "dbt"]
VALUES = ["5", "immediate", "Immediate joiner", "30 days", "true", "false", "", "yes", "no", "90", "85%", "0.75", "-0.5 points", "correct", "fail", "n/a", "7.5 years", "100 %", "pass", "1", "0", "about 12 to 15", "incorrect", " 42 "]
ERRORS = ['{"error":{"message":"maximum context length exceeded"}}', '{"error":"rate limited"}', '{"message":"bad  key"}', '{"detail":"no such model"}', '{"error":{"detail":"too many tokens in the request"}}', "plain text failure", "", '{"code":7}', '{"error":{"code":1},"message":"prompt is too long"}']
DOMAINS = ["Fintech", "Retail Banking", "Health Care", "IT Services and Consulting", "Banking", "E-commerce Retail", "", "Consulting IT Services", "Automobile", "Health"]
DEGREES = ["B Tech CSE", "M Tech", "MBA", "", "BSc", "MCA"]
WANTED = ["Bachelor's degree required", "Master's preferred", "Not Specified", "M.Tech from IIT or NIT", "Any graduate", "MBA from top institute", "BITS or IIIT graduate", "PhD"]
SCHOOLS = ["IIT Bombay", "Anna University", "College of Technology", "BITS Pilani", "City College"]


def pick(values: list[str], key: Column, times: int = 1, plus: int = 0) -> Column:
    """A sample value by key: values[(key * times + plus) % n]."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key * times + plus, F.lit(len(values))) + 1).cast("int"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(map(sql_text, values)) + "]"


def sql_pick(values: list[str], key: str, times: int = 1, plus: int = 0) -> str:
    return f"({sql_list(values)})[CAST(({key} * {times} + {plus}) % {len(values)} + 1 AS BIGINT)]"


def sql_clean(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g'))"


def sql_normal(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def sql_compact(x: str) -> str:
    return f"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]', '', 'g')"


def sql_key(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(translate(lower({sql_clean(x)}), '–—', '--'), '\s*/\s*', '/', 'g'), '\s+', ' ', 'g'))"


def sql_match(a: str, b: str) -> str:
    """Of two compacted texts."""
    return f"({a} <> '' AND {b} <> '' AND ({a} = {b} OR (length({a}) >= 4 AND contains({b}, {a})) OR (length({b}) >= 4 AND contains({a}, {b}))))"


def sql_u(key: str, salt: str, i: str = "0") -> str:
    return f"((('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}|' || CAST({i} AS VARCHAR)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def sql_head(x: str) -> str:
    return f"trim(regexp_replace({x}, ' [^ ]*$', ''))"


def sql_tail(x: str) -> str:
    return f"trim(regexp_replace({x}, '^[^ ]* ', ''))"


def sql_trim(x: str, most: int, head: int, tail: int, or_: bool) -> str:
    h, t = sql_head(f"substr({x}, 1, {head})"), sql_tail(f"right({x}, {tail})")
    whole = f"trim(substr({x}, 1, {most}))"
    cases = f"WHEN {h} = '' OR {t} = '' THEN {whole}" if or_ else f"WHEN {h} = '' THEN {whole} WHEN {t} = '' THEN {h}"
    return f"CASE WHEN length({x}) <= {most} THEN {x} ELSE CASE {cases} ELSE {h} || '{CUT}' || {t} END END"


def contains_sql(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {sql_text(w)})" for w in words) + ")"


def first_case(x: str, pairs: list[tuple[str, str]], other: str) -> str:
    """CASE over 'contains' tests in order; results are SQL."""
    return "CASE " + " ".join(f"WHEN contains({x}, {sql_text(w)}) THEN {out}" for w, out in pairs) + f" ELSE {other} END"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that executors share; only a local master, as in tests, may do without one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(top or 'file://' + tempfile.mkdtemp(prefix='fitloom-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lines_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, body): an order's lines as 'NAME at BRAND (n years)', one below the other."""
    line = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    text = F.concat(F.lit("  - "), "p_name", F.lit(" at "), "p_brand", F.lit(" ("), F.col("l_quantity").cast("int").cast("string"), F.lit(" years)"))
    rows = line.select("l_orderkey", F.struct("l_linenumber", text.alias("t")).alias("r"))
    return rows.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["t"]), "\n").alias("body"))


_LINE = "'  - ' || p_name || ' at ' || p_brand || ' (' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' years)'"
LINES_SQL = f"SELECT l_orderkey, string_agg({_LINE}, chr(10) ORDER BY l_linenumber, {_LINE}) AS body FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"
