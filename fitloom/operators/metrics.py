"""Counts, means and errors that the pipeline reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_means(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, mean, percent, n): means over the rows that have the field."""
    aggs = [x for f in fields for x in (F.avg(f).alias(f"{f}__m"), F.count(f).alias(f"{f}__n"))]
    row = df.agg(*aggs)
    parts = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}__m").alias("mean"), F.col(f"{f}__n").alias("n")) for f in fields))
    return row.select(F.explode(parts).alias("r")).select("r.field", "r.mean", (F.col("r.mean") * 100).alias("percent"), "r.n")


def absolute_errors(df: DataFrame, pairs: dict[str, tuple[Column, Column]], parsed: Column) -> DataFrame:
    """Mean absolute error of each axis over rows that parse and have both sides, and the count of parse failures."""
    aggs = [F.avg(F.when(parsed, F.abs(p - t))).alias(f"mae_{name}") for name, (p, t) in pairs.items()]
    return df.agg(*aggs, F.count_if(~parsed).alias("parse_failures"))


def interval(p: Column, n: Column) -> list[Column]:
    """Bounds of the normal approximation's 95 % interval of a share."""
    half = 1.96 * F.sqrt(p * (1 - p) / n)
    return [(p - half).alias("low"), (p + half).alias("high")]


def length_profile(c: Column) -> list[Column]:
    return [F.avg(c).alias("mean_len"), F.percentile(c, 0.95).alias("p95_len"), F.max(c).alias("max_len")]
