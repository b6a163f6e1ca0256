"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import removed, stored


def _small(edges: DataFrame) -> DataFrame:
    """edges u > v: every v and u itself to the least v of u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v"))).distinct()


def _large(edges: DataFrame, spent: list[str]) -> DataFrame:
    """edges u > v: for every node, its larger neighbours to its least neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that both sides of the join are plain exchanges and a hub's edges can be split over tasks
    least, path = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc")
    spent.append(path)
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
    return back.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether edges u > v make stars: every u has one v, which is no u itself.  Then each v is the least of its component."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up")).unionAll(edges.select("v", F.lit(0)))
    nodes = ends.groupBy("n").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("low") == 0)))).first()[0] == 0


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, v): v is the least node of u's component, for every u that isn't itself the least.

    edges has long columns u and v; order, repeats and loops don't matter.  Only one count a round
    reaches the driver; each round is written to the shared folder, and deleted when the next one is there.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, path = stored(e, "cc")
    for _ in range(most_rounds):
        if _stars(e):
            return e
        spent = [path]
        e, path = stored(_small(_large(e, spent)), "cc")
        removed(e.sparkSession, *spent)
    raise RuntimeError("components did not settle")
