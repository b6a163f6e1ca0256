"""Seeded samples and splits, and row numbers: exact, the same for any partitioning.

No task sees a whole stratum: rows are numbered within cells of it (a stratum and a bucket), cells are
counted, and a running sum over the counts of a stratum's cells, at most BUCKETS of them, says where each
cell starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rng

#: Cells of a stratum.
DIGITS = 4
BUCKETS = 16**DIGITS


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement: a top-n by a hash, so no more than n rows a partition move."""
    return df.orderBy(rng.order(F.col(key), seed), key).limit(n)


def quotas(df: DataFrame, stratum: str, first: str, n: int) -> DataFrame:
    """(stratum, size, quota): proportional shares of n by largest remainder; ties in order of first appearance."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("size"), F.min(first).alias("__first"))
    total = sizes.agg(F.sum("size").alias("__total"))
    exact = sizes.crossJoin(F.broadcast(total)).withColumn("__exact", F.lit(float(n)) * F.col("size") / F.col("__total"))  # one row
    exact = exact.withColumn("__base", F.floor("__exact"))
    w = Window.orderBy(F.desc(F.col("__exact") - F.col("__base")), F.asc("__first"))  # one row a stratum
    left = exact.agg((F.lit(n) - F.sum("__base")).alias("__left"))
    ranked = exact.withColumn("__n", F.row_number().over(w)).crossJoin(F.broadcast(left))  # one row
    return ranked.select(stratum, "size", (F.col("__base") + (F.col("__n") <= F.col("__left")).cast("int")).cast("long").alias("quota"))


def stratified(df: DataFrame, stratum: str, key: str, first: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(quota, size) rows of each stratum.  No quota is above n, so each task keeps n rows of a
    stratum at most before any row moves."""
    w = Window.partitionBy(stratum).orderBy(rng.order(F.col(key), seed), F.asc(key))
    ranked = df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n)
    share = quotas(df, stratum, first, n).withColumnRenamed(stratum, "__stratum")
    return ranked.join(share, F.col(stratum).eqNullSafe(F.col("__stratum"))).where("__n <= quota").drop("__n", "size", "__stratum")


def numbered(df: DataFrame, by: str, bucket: Column, order: list[Column], out: str, total: str | None = None) -> DataFrame:
    """Adds out, the place of each row among those of its stratum from 1, and total, their number.  bucket
    must rise with the order."""
    rows = df.withColumn("__cell", bucket)
    place = F.row_number().over(Window.partitionBy(by, "__cell").orderBy(*order))
    cells = rows.groupBy(F.col(by).alias("__by"), F.col("__cell").alias("__at")).agg(F.count("*").alias("__many"))
    w = Window.partitionBy("__by")
    before = F.sum("__many").over(w.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("__by", "__at", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__many").over(w).alias("__all"))
    both = rows.withColumn("__n", place).join(cells, F.col(by).eqNullSafe(F.col("__by")) & F.col("__cell").eqNullSafe(F.col("__at")))
    both = both.withColumn(out, F.col("__before") + F.col("__n"))
    if total:
        both = both.withColumn(total, F.col("__all"))
    return both.drop("__cell", "__n", "__by", "__at", "__before", "__all")


def ordinals(df: DataFrame, by: str, key: str, out: str) -> DataFrame:
    """Adds out, the place of each row of a stratum in the order of an integer key; buckets are of equal width."""
    bounds = df.agg(F.min(key).alias("__low"), F.max(key).alias("__high"))
    rows = df.crossJoin(F.broadcast(bounds))  # one row
    bucket = F.floor((F.col(key) - F.col("__low")) / (F.greatest(F.col("__high") - F.col("__low") + 1, F.lit(1)) / F.lit(float(BUCKETS))))
    return numbered(rows, by, bucket, [F.asc(key)], out).drop("__low", "__high")


def split(df: DataFrame, by: str, key: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds split: the first floor(n * share) rows of each group in hash order are 'train', others 'val'."""
    order = rng.order(F.col(key), seed)
    rows = numbered(df, by, F.substring(order, 1, DIGITS), [order, F.asc(key)], "__place", "__size")
    return rows.withColumn("split", F.when(F.col("__place") <= F.floor(F.col("__size") * share), "train").otherwise("val")).drop("__place", "__size")


def split_by_group(df: DataFrame, group: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds split by a hash of the group, so that all rows of a group fall on one side."""
    return df.withColumn("split", F.when(rng.uniform(F.col(group), str(seed)) < share, "train").otherwise("val"))
