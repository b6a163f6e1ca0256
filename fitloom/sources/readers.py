"""Readers: line JSON, whole JSON, Markdown tables, tiered lines, HTML pages, score reports."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import match as M
from ..functions.coerce import largest_number, pay_tier
from ..functions.skills import normalize, split_list
from ..functions.text import clean

JD = ("job_title string, min_experience_years int, core_technical_skills array<string>, domain string, is_management_role boolean, education_requirement string, max_notice_period_days int, executive_summary string, source_url string, _status string, _line_number int, _error string")
PROFILE = (
    "role string, aliases array<string>, skill_paths array<array<string>>, supporting_skills array<string>, project_templates array<struct<name:string,skills:array<string>,business_problem:string,outcomes:array<string>,architecture:array<string>>>, "
    "jd_domain_preferences array<string>, preferred_company_domains array<string>, education_options array<string>, stage_titles map<string,array<string>>, experience_themes array<string>"
)
SCORES = ("index int, job_title string, overall_relevance_score double, skill_coverage double, experience_fit double, role_alignment double, domain_alignment double, education_fit double, deployment_alignment double, management_alignment double, matched_jd_skills string, score_rationale string")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files.  A large file is read in blocks: lines are numbered within their
    block, in the order that its task reads them, and blocks start where the counts of those before end."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    counts = raw.groupBy(F.col("file").alias("__f"), F.col("__block").alias("__b")).agg(F.count("*").alias("__many"))
    before = F.sum("__many").over(Window.partitionBy("__f").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__f", "__b", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("file", "__block").orderBy("__id"))
    both = raw.withColumn("__n", place).join(counts, (F.col("file") == F.col("__f")) & (F.col("__block") == F.col("__b")))
    return both.select("file", (F.col("__before") + F.col("__n")).alias("line_no"), "value")


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Line JSON with an explicit schema, given as DDL.  Strict fails on a bad line; otherwise bad and blank lines go."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def jds(spark: SparkSession, path: str) -> DataFrame:
    """Tolerant scan of job descriptions: no skipped rows, skills normalised again."""
    rows = jsonl(spark, path, JD).where(F.coalesce("_status", F.lit("")) != "skipped")
    return rows.withColumn("core_technical_skills", normalize(F.col("core_technical_skills")))


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Role profiles, the last of each role, files in the order of their names; a profile without a role fails the query."""
    numbered = lines(spark, path).where(F.trim("value") != "").select("file", "line_no", F.from_json("value", PROFILE).alias("p"))
    role = F.when(F.col("p.role").isNotNull(), F.col("p.role")).otherwise(F.raise_error(F.lit("a role profile has no role")).cast("string"))
    last = numbered.select("file", "line_no", F.col("p").withField("role", role).alias("p")).select("file", "line_no", "p.*").withColumn("__n", F.row_number().over(Window.partitionBy("role").orderBy(F.desc("file"), F.desc("line_no"))))
    return last.where("__n = 1").drop("__n", "file").withColumnRenamed("line_no", "ord")


def whole_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def first_rows(df: DataFrame, by: str, limit: int) -> DataFrame:
    """The first `limit` rows in order; all of them for a limit of 0 or less."""
    return df.orderBy(by).limit(limit) if limit > 0 else df


#: Lines that one task fills headings in.
CHUNK = 1 << 16


def filled(numbered: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with nulls replaced by the last value before, by line_no, within a file if there is a column of
    that name.  Lines are filled in chunks; what a chunk starts with comes from the last values of the chunks before it."""
    file = F.col("file") if "file" in numbered.columns else F.lit("")
    rows = numbered.withColumns({"__file": file, "__chunk": F.floor(F.col("line_no") / CHUNK)})
    last = rows.groupBy("__file", "__chunk").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))).alias(c) for c in columns))
    w = Window.partitionBy("__file").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = last.select(F.col("__file").alias("__f"), F.col("__chunk").alias("__c"), *(F.last(c, True).over(w).alias(f"__start{i}") for i, c in enumerate(columns)))
    w = Window.partitionBy("__file", "__chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.withColumns({c: F.last(c, True).over(w) for c in columns}).join(start, (F.col("__file") == F.col("__f")) & (F.col("__chunk") == F.col("__c")))
    return both.withColumns({c: F.coalesce(c, f"__start{i}") for i, c in enumerate(columns)}).drop("__file", "__chunk", "__f", "__c", *(f"__start{i}" for i in range(len(columns))))


def companies(numbered: DataFrame) -> DataFrame:
    """Company rows of Markdown pipe tables under sticky tier and domain headings.

    numbered has line_no and value (and file, if of several files).
    """
    t = F.trim("value")
    digit = F.regexp_extract(t, r"(?i)## TIER (\d)", 1)
    special = F.upper(t).contains("## SPECIALIZED SECTORS")
    heading = F.when(digit != "", F.concat(F.lit("tier_"), digit)).when(special, "specialized")
    domain = F.when(heading.isNull() & t.startswith("### "), F.trim(F.replace(t, F.lit("### "), F.lit(""))))
    rows = filled(numbered.withColumns({"__tier": heading, "__domain": domain}), ["__tier", "__domain"])
    rows = rows.select("*", F.coalesce("__domain", F.lit("General Software Engineering")).alias("domain"), F.split(t, r"\|").alias("__parts"), t.alias("__line"))
    table = rows.where(F.col("__line").startswith("|") & ~F.col("__line").contains("Company") & ~F.col("__line").contains("---") & (F.size("__parts") >= 6))
    cell = lambda i: F.trim(F.col("__parts")[i])
    paid = pay_tier(largest_number(cell(2)))
    tier = F.when(F.col("__tier").isNull() | (F.col("__tier") == "specialized"), paid).otherwise(F.col("__tier"))
    notes = F.lower(cell(5))
    out = table.select("line_no", tier.alias("tier"), cell(1).alias("name"), "domain", F.when(notes != "", F.array(notes)).otherwise(F.array().cast("array<string>")).alias("tags"), cell(2).alias("estimated_ctc"))
    return out.where((F.col("name") != "") & F.col("tier").rlike("^tier_[1-5]$"))


def colleges(numbered: DataFrame) -> DataFrame:
    """(tier, name) of lines 'NAME Tier n', each once."""
    t = F.trim("value")
    name = F.trim(F.regexp_extract(t, r"(?i)^(.*?)\s*Tier\s*([123])$", 1))
    digit = F.regexp_extract(t, r"(?i)^(.*?)\s*Tier\s*([123])$", 2)
    rows = numbered.where(digit != "").select(F.concat(F.lit("tier_"), digit).alias("tier"), name.alias("name"))
    return rows.where((F.col("name") != "") & ~F.col("name").contains("Institution Name")).distinct()


def links(pages: DataFrame, html: str, wanted: str, keep: list[str]) -> DataFrame:
    """Distinct link targets with `wanted` in them."""
    found = F.explode(F.regexp_extract_all(F.col(html), F.lit(r"<a\b[^>]*?\bhref=\"([^\"]*)\""), 1))
    return pages.select(*keep, found.alias("href")).where(F.col("href").contains(wanted)).distinct()


def search_pages(url: Column, pages: int = 3) -> Column:
    """The URLs of a search's result pages: '-2', '-3', ... after the first."""
    return F.transform(F.sequence(F.lit(1), F.lit(pages)), lambda i: F.when(i > 1, F.concat(url, F.lit("-"), i.cast("string"))).otherwise(url))


def strip_tags(c: Column) -> Column:
    return clean(F.regexp_replace(c, r"<[^>]*>", " "))


#: Elements that never have an end tag.
_VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]


def element(html: Column, tag: str, kind: str | None = None) -> Column:
    """Markup within the first `tag` element (whose class has the text `kind`, if given), to its own end tag, also if
    it holds elements of the same tag; to the end of the page if it has none.  Null if there is no such element.

    The page is cut into pieces that start with a start or end tag of this kind; a running depth over them tells
    where the element ends.  Depth is a fold over pieces of this tag alone, so it costs a step a tag."""
    opens = rf"(?is)^<{tag}(?=[\s/>])[^>]*"
    wanted = opens + (rf"""\bclass\s*=\s*(?:"[^"]*{kind}[^"]*"|'[^']*{kind}[^']*'|[^\s>"']*{kind}[^\s>]*)[^>]*>""" if kind else ">")
    cut = F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?-->", " "), rf"(?i)<(?=/?{tag}[\s/>])", "\x01<")
    pieces = F.slice(F.split(cut, "\x01"), 2, 1 << 30)
    nothing = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("ended"))

    def step(a: Column, x: Column) -> Column:
        depth = a["depth"] + F.when(x.rlike(rf"(?i)^</{tag}"), -1).when(x.rlike(r"(?s)^<[^>]*/>"), 0).otherwise(1)
        more = F.struct(depth.alias("depth"), (a["n"] + (depth > 0).cast("int")).alias("n"), (depth <= 0).alias("ended"))
        return F.when(a["ended"], a).otherwise(more)

    def inner(p: Column) -> Column:
        text = lambda n: F.when(n > 0, F.concat(F.regexp_replace(p[0], r"(?s)^<[^>]*>", ""), F.array_join(F.slice(p, F.lit(2), n - 1), ""))).otherwise("")
        return M.let(F.aggregate(p, nothing, step, lambda a: a["n"]), text)

    first = lambda p: F.array_position(F.transform(p, lambda x: x.rlike(wanted)), F.lit(True)).cast("int")
    return M.let(pieces, lambda p: M.let(first(p), lambda k: F.when(k > 0, M.let(F.slice(p, k, F.lit(1 << 30)), inner))))


def details(pages: DataFrame, url: str, html: str, body: str = "job-desc") -> DataFrame:
    """(source_url, job_title, raw_jd_text): first h1 and the first div, else section, of a matching class, each to
    its own end tag; pages without text go."""
    h = F.replace(F.col(html), F.lit("\x01"), F.lit(" "))
    title = F.coalesce(F.nullif(strip_tags(element(h, "h1")), F.lit("")), F.lit("Unknown Title"))
    piece = lambda tag: strip_tags(element(h, tag, f"(?i:{body})"))
    text = F.coalesce(F.nullif(piece("div"), F.lit("")), F.nullif(piece("section"), F.lit("")))
    return pages.select(F.col(url).alias("source_url"), title.alias("job_title"), text.alias("raw_jd_text")).where(F.col("raw_jd_text").isNotNull())


def scores(spark: SparkSession, path: str) -> DataFrame:
    """A score report with its skill list split."""
    rows = spark.read.schema(SCORES).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return rows.withColumn("matched_jd_skills", F.when(F.coalesce("matched_jd_skills", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("matched_jd_skills", ";")))


def raw_skills(c: Column) -> Column:
    """A skill field given as a delimited string."""
    return normalize(split_list(c))


def settings_table(lines: DataFrame, environment: dict[str, str] | None = None) -> DataFrame:
    """(name, value) of KEY=VALUE lines in column value, quotes stripped; comments and other lines go, the environment wins."""
    t = F.trim("value")
    at = F.instr(t, "=")
    name = F.trim(F.substring(t, F.lit(1), at - 1))
    value = F.regexp_replace(F.trim(F.substring(t, at + 1, F.length(t))), "^[\"']+|[\"']+$", "")
    rows = lines.where((at > 1) & ~t.startswith("#")).select(name.alias("name"), value.alias("value"))
    if not environment:
        return rows
    known = F.create_map(*(F.lit(x) for pair in environment.items() for x in pair))
    return rows.select("name", F.coalesce(F.try_element_at(known, F.col("name")), F.col("value")).alias("value"))


def settings(path: str) -> dict[str, str]:
    """KEY=VALUE lines with quotes stripped; the environment wins."""
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            name, eq, value = line.strip().partition("=")
            if eq and name and not name.startswith("#"):
                out[name.strip()] = os.environ.get(name.strip(), value.strip().strip("\"'"))
    return out
