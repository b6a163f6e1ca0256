"""Joins of the training pipeline: keep-last lookups, upserts, retries and role assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that a dimension may have to be broadcast.
SMALL = 20_000


def bounded(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """df marked for broadcast if it has `rows` rows at most, which is checked; else as it is, for Spark to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def keep_last(df: DataFrame, key: list[str], order: list[str], where: Column | None = None) -> DataFrame:
    """The last row of each key; rows that fail `where` never hide an earlier one."""
    rows = df if where is None else df.where(where)
    w = Window.partitionBy(*key).orderBy(*(F.desc(o) for o in order))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def lookup(facts: DataFrame, side: DataFrame, key: list[str]) -> DataFrame:
    """Inner join on a key that is unique on the lookup's side."""
    return facts.join(side, key)


def missing(facts: DataFrame, side: DataFrame, key: list[str]) -> DataFrame:
    """Rows of facts without a partner."""
    return facts.join(side, key, "left_anti")


def upsert(order: DataFrame, old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A new row replaces an old one by key; only keys of `order` that have either come out."""
    o = old.select(key, F.struct(*fields).alias("__old"))
    n = new.select(key, F.struct(*fields).alias("__new"))
    both = order.join(n, key, "left").join(o, key, "left").withColumn("__row", F.coalesce("__new", "__old"))
    return both.where(F.col("__row").isNotNull()).select(*order.columns, *(F.col(f"__row.{f}").alias(f) for f in fields), F.col("__new").isNotNull().alias("replaced"))


def remaining(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without an output: the restart rule, by key and not by line count."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def best_role(titles: DataFrame, title: str, roles: DataFrame, score: Column, cascade: Column, product: Column) -> DataFrame:
    """Role of greatest score for each distinct title (ties: least ord); where no score is positive,
    the cascade's role, else the first role; `product` titles of managers become product_manager.

    roles is a small dimension (role, ord, ...), SMALL rows at most: the join is distinct titles by roles.
    """
    if roles.limit(SMALL + 1).count() > SMALL:
        raise ValueError(f"more than {SMALL} roles")
    w = Window.partitionBy(title).orderBy(F.desc("__score"), F.asc("ord"))
    every = titles.select(title).distinct().crossJoin(F.broadcast(roles)).withColumn("__score", score)
    top = every.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(title, F.col("role").alias("__role"), F.col("__score").alias("role_score"))
    named = top.withColumn("__cascade", F.when(F.col("role_score") <= 0, cascade))
    out = titles.join(named, title)
    role = F.when(F.col("__cascade").isNotNull(), F.col("__cascade")).when(product, F.lit("product_manager")).otherwise(F.col("__role"))
    return out.withColumn("role", role).drop("__role", "__cascade")
