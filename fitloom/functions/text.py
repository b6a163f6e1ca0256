"""Text normalisation as column expressions; every function takes and returns columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CUT = " [TRUNCATED] "

# Ordered keyword -> role family; the first keyword that a title contains decides.
ROLE_FAMILIES = [
    ("android", "Android Developer"), ("ios", "iOS Developer"), ("machine learning", "ML Engineer"),
    ("data scientist", "Data Scientist"), ("data engineer", "Data Engineer"), ("devops", "DevOps/SRE"),
    ("site reliability", "DevOps/SRE"), ("sre", "DevOps/SRE"), ("qa", "QA Engineer"),
    ("frontend", "Frontend Developer"), ("front end", "Frontend Developer"), ("ui/ux", "UI/UX Designer"),
    ("ux", "UI/UX Designer"), ("database", "DBA"), ("java", "Java Developer"),
    ("fullstack", "Fullstack Developer"), ("full stack", "Fullstack Developer"), ("cloud architect", "Cloud Architect"),
    ("blockchain", "Blockchain Developer"), ("backend", "Backend Developer"), ("back end", "Backend Developer"),
    ("engineering manager", "Engineering Manager"), ("product manager", "Product Manager"),
]
# Message parts that tell of a context overflow; endings of a complete text.
OVERFLOW_MARKERS = ["context length", "maximum context", "maximum token", "too many tokens", "input too long", "input too large", "context window", "prompt is too long"]
COMPLETE_ENDINGS = ["LPA", "Days", "days", "N/A", ".", ")", "]"]


def clean(c: Column) -> Column:
    """White space runs to one blank, ends stripped; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))


def normal(c: Column) -> Column:
    """Lower case; runs of other than a-z and 0-9 to one blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def compact(c: Column) -> Column:
    """Lower case a-z and 0-9 only."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def key(c: Column) -> Column:
    """Comparison key of a skill: clean, lower, dashes to '-', no blanks around '/'."""
    t = F.translate(F.lower(clean(c)), "–—", "--")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"(?U)\s*/\s*", "/"), r"(?U)\s+", " "))


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor((F.length(c) + 3) / 4).cast("int"))


def _head(c: Column) -> Column:
    """All before the last blank; the whole if there is none."""
    return F.trim(F.regexp_replace(c, " [^ ]*$", ""))


def _tail(c: Column) -> Column:
    """All after the first blank; the whole if there is none."""
    return F.trim(F.regexp_replace(c, "^[^ ]* ", ""))


def trim_budget(c: Column, tokens: int) -> Column:
    """Head and tail of a text that is over a token budget of 4 characters a token."""
    most, text = tokens * 4, clean(c)
    head = int(most * 0.7)
    tail = most - head - len(CUT)
    if tail < 200:
        tail = min(200, most // 4)
        head = most - tail - len(CUT)
    first, last = _head(F.substring(text, 1, head)), _tail(F.right(text, F.lit(tail)))
    short = F.when(first == "", F.trim(F.substring(text, 1, most))).when(last == "", first).otherwise(F.concat(first, F.lit(CUT), last))
    return F.when(F.length(text) <= most, text).otherwise(short)


def trim_chars(c: Column, most: int = 2500) -> Column:
    """Head and tail of a text of more than `most` characters."""
    text, head = clean(c), int(most * 0.72)
    tail = most - head - len(CUT)
    if tail < 200:
        tail = 200
        head = most - tail - len(CUT)
    first, last = _head(F.substring(text, 1, head)), _tail(F.right(text, F.lit(tail)))
    short = F.when((first == "") | (last == ""), F.trim(F.substring(text, 1, most))).otherwise(F.concat(first, F.lit(CUT), last))
    return F.when(F.length(text) <= most, text).otherwise(short)


def summary(c: Column, most: int = 700) -> Column:
    """At most `most` characters, cut at a blank."""
    text = clean(c)
    return F.when(F.length(text) > most, _head(F.substring(text, 1, most))).otherwise(text)


def titleize(c: Column) -> Column:
    """Capitalised words; upper-case words of up to five characters stay."""
    def one(t: Column) -> Column:
        stays = (F.upper(t) == t) & (F.lower(t) != t) & (F.length(t) <= 5)
        return F.when(stays, t).otherwise(F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30))))

    return F.array_join(F.transform(F.split(clean(c), " "), one), " ")


def strip_markup(c: Column) -> Column:
    """Model response without byte-order marks, thinking blocks and the json mark of fences."""
    t = F.trim(F.replace(c, F.lit("﻿"), F.lit("")))
    t = F.regexp_replace(t, r"(?is)<think>.*?</think>", " ")
    t = F.regexp_replace(t, r"(?i)</?think>", " ")
    return F.trim(F.regexp_replace(t, r"(?i)```json", "```"))


def email_slug(c: Column) -> Column:
    return F.translate(F.lower(c), " '", ".")


def sentences(parts: Column) -> Column:
    """Parts of an array as sentences; null and empty parts are left out."""
    kept = F.filter(parts, lambda p: F.coalesce(p, F.lit("")) != "")
    return F.concat(F.array_join(F.transform(kept, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), ". "), F.lit("."))


def role_family(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for word, family in ROLE_FAMILIES:
        out = out.when(low.contains(word), F.lit(family))
    return out.otherwise("Other")


def error_message(payload: Column, status: Column) -> Column:
    """First text among error, message and detail of a JSON payload, or message and detail below them; else the payload; else HTTP and the status."""
    found = []
    for name in ("error", "message", "detail"):
        value = F.get_json_object(payload, f"$.{name}")
        plain = F.when(~F.trim(value).rlike(r"^[\[{]"), clean(value))
        found += [F.nullif(plain, F.lit(""))]
        found += [F.nullif(clean(F.get_json_object(payload, f"$.{name}.{inner}")), F.lit("")) for inner in ("message", "detail")]
    return F.coalesce(*found, F.nullif(clean(payload), F.lit("")), F.concat(F.lit("HTTP "), status.cast("string")))


def is_overflow(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(False)
    for m in OVERFLOW_MARKERS:
        out = out | low.contains(m)
    return out


def has_placeholder(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?i)\bXYZ\b|ABC Company|ABC Corp")


def has_repeated_employer(c: Column) -> Column:
    """Whether two lines name the same employer as 'at NAME ('."""
    names = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.trim(F.regexp_extract(x, r"at (.+?) \(", 1)))
    names = F.filter(names, lambda n: n != "")
    return F.size(names) != F.size(F.array_distinct(names))


def quality_ok(c: Column) -> Column:
    return ~has_placeholder(c) & ~has_repeated_employer(c)


def looks_complete(c: Column) -> Column:
    """Whether the text, right-stripped, has one of the endings."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+$", "")
    out = F.lit(False)
    for e in COMPLETE_ENDINGS:
        out = out | t.endswith(e)
    return out


def documented_gates(c: Column) -> Column:
    """Gates that are only described: repeated section headers, generic openers, bracket placeholders, addresses in the text body."""
    t = F.coalesce(c, F.lit(""))
    heads = F.filter(F.transform(F.split(t, "\n"), lambda x: F.lower(F.trim(x))), lambda x: x.isin("summary", "skills", "experience", "projects", "details"))
    return F.struct(
        (F.size(heads) != F.size(F.array_distinct(heads))).alias("repeated_header"),
        F.lower(t).rlike(r"^\s*(here is|here's|sure|certainly|below is)").alias("generic_opener"),
        t.rlike(r"\[(?:[A-Za-z]+ ?)+\]").alias("bracket_placeholder"),
        (F.size(F.regexp_extract_all(t, F.lit(r"[\w.+-]+@[\w-]+\.[\w.]+"), 0)) > 1).alias("email_bleed"),
    )
