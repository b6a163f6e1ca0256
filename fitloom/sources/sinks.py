"""Sinks: line JSON, appends that can be repeated, pools by tier, change statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, UTF-8 as it is, explicit nulls."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends the rows whose key the target doesn't have yet; running it again adds nothing.  A null key counts as
    one key, and of rows that share a key the least stays.  A run that is cut off may leave part of its rows, which
    the next one completes; sources.manifest has appends that are there as a whole or not at all."""
    spark = df.sparkSession
    try:
        done = spark.read.schema(df.schema).json(path).select(F.col(key).alias("__done")).distinct()
    except Exception as e:  # noqa: BLE001  no target yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = spark.createDataFrame([], df.select(F.col(key).alias("__done")).schema)
    new = df.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*df.columns)).alias("__row"))
    new = new.join(done, F.col("__key").eqNullSafe(F.col("__done")), "left_anti")
    write_jsonl(new.select(*(F.col("__row")[c].alias(c) for c in df.columns)), path, "append")


def write_pool(df: DataFrame, path: str) -> None:
    """A pool as JSON, one folder a tier."""
    df.write.mode("overwrite").partitionBy("tier").json(path)


def change_stats(before: DataFrame, after: DataFrame, key: str, items: str) -> DataFrame:
    """total, changed, removed and added items of an array column between two versions of a table."""
    both = before.select(key, F.col(items).alias("__b")).join(after.select(key, F.col(items).alias("__a")), key)
    less, more = F.size("__b") - F.size("__a"), F.size("__a") - F.size("__b")
    return both.agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("__b").eqNullSafe(F.col("__a"))).alias("changed"),
        F.coalesce(F.sum(F.greatest(F.lit(0), less)), F.lit(0)).cast("long").alias("removed"),
        F.coalesce(F.sum(F.greatest(F.lit(0), more)), F.lit(0)).cast("long").alias("added"),
    )


def stats_json(stats: DataFrame) -> DataFrame:
    """A one-row table as one JSON text."""
    return stats.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
