"""Coercion of loosely typed text to numbers, flags and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean

SCORE_FIELDS = ["job_title", "min_experience_years", "domain", "is_management_role", "education_requirement", "max_notice_period_days"]


def to_int(c: Column, default: int) -> Column:
    """First digit run; 0 for 'immediate'; else the default.  true and false give the default."""
    t = F.lower(clean(c))
    found = F.try_to_number(F.nullif(F.regexp_extract(t, r"\d+", 0), F.lit("")), F.lit("9" * 18)).cast("long")
    return F.when(t.isin("", "true", "false"), F.lit(default).cast("long")).when(t.contains("immediate"), F.lit(0).cast("long")).otherwise(F.coalesce(found, F.lit(default).cast("long")))


def to_bool(c: Column, default: bool = False) -> Column:
    t = F.lower(clean(c))
    return F.when(t.isin("true", "yes", "1"), True).when(t.isin("false", "no", "0"), False).otherwise(default)


def to_score(c: Column) -> Column:
    """Words of success and failure, percentages, the first signed number, or null."""
    t = F.lower(clean(c))
    number = lambda pattern, group: F.nullif(F.regexp_extract(t, pattern, group), F.lit("")).try_cast("double")
    return (
        F.when(t.isin("correct", "yes", "true", "pass"), 1.0)
        .when(t.isin("incorrect", "no", "false", "fail"), 0.0)
        .otherwise(F.coalesce(number(r"(-?\d+(?:\.\d+)?)\s*%", 1) / 100.0, number(r"-?\d+(?:\.\d+)?", 0)))
    )


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def half_up(c: Column, digits: int) -> Column:
    """Rounding that engines agree on: floor(x * 10^d + 0.5) / 10^d."""
    scale = float(10**digits)
    return F.floor(c * scale + 0.5).cast("double") / scale


def normal_scores(fields: dict[str, Column]) -> dict[str, Column]:
    """Judge scores clamped to 0..1; `valid` tells whether all fields but overall_score parse, and the
    mean of the seven stands in for a missing overall_score."""
    names = [*SCORE_FIELDS, "core_technical_skills"]
    got = {n: to_score(fields[n]) for n in names}
    valid = F.lit(True)
    for n in names:
        valid = valid & got[n].isNotNull()
    out = {n: F.when(got[n].isNotNull(), clamp(got[n])) for n in names}
    mean = sum((out[n] for n in names[1:]), out[names[0]]) / float(len(names))
    return out | {"overall_score": clamp(F.coalesce(to_score(fields["overall_score"]), mean)), "valid": valid}


def backoff(attempt: Column, status: Column, retry_after: Column, overflow: Column) -> Column:
    """Seconds to wait after a failed call."""
    a = attempt.cast("double")
    return (
        F.when(retry_after > 0, F.greatest(F.lit(1.0), retry_after))
        .when(status == 429, a * 5.0)
        .when(status >= 500, F.least(F.lit(12.0), a * 2.0))
        .when(overflow, F.lit(1.0))
        .otherwise(F.least(F.lit(8.0), a))
    )


def retry_after(header: Column, reset: Column | None = None) -> Column:
    """Seconds of a Retry-After header (or of a rate-limit reset header), never negative; null if it isn't a number."""
    value = F.trim(header) if reset is None else F.coalesce(F.nullif(F.trim(header), F.lit("")), F.trim(reset))
    seconds = value.try_cast("double")
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))


def largest_number(c: Column) -> Column:
    """Greatest number of a pay text such as "12-18 LPA", thousands commas left out; 0 if it has none."""
    found = F.regexp_extract_all(F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit("")), F.lit(r"\d+\.?\d*"), 0)
    return F.coalesce(F.array_max(F.transform(found, lambda x: x.cast("double"))), F.lit(0.0))


def pay_tier(pay: Column) -> Column:
    """Tier by pay: 30, 20, 15 and 10 are the least of tiers 1 to 4."""
    return F.when(pay >= 30, "tier_1").when(pay >= 20, "tier_2").when(pay >= 15, "tier_3").when(pay >= 10, "tier_4").otherwise("tier_5")
