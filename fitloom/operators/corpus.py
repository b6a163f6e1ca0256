"""Ranking and the three corpora: pointwise, pairwise, grouped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import half_up

# Fixed value: the instruction field of each pointwise record.
INSTRUCTION = "Given the job description and candidate profile, rate the candidate's fit on a scale from 0 to 10."


def accepted(scored: DataFrame, test) -> DataFrame:
    """Rows that pass test(row).  A plain filter on worked-out columns is pushed below them, and works them
    out again for each use; here the row is made first, once, and the test looks at it."""
    return scored.select(F.inline(F.filter(F.array(F.struct(*scored.columns)), test)))


def rank(scored: DataFrame, by: str, score: str, serial: str) -> DataFrame:
    """Adds rank: 1 for the greatest score of a group, ties in order of `serial`."""
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(score), F.asc(serial))))


def pairs(ranked: DataFrame, by: str, score: str, name: str, least: float = 0.1, clean: float = 0.3) -> DataFrame:
    """Ordered pairs of a group with their score gap, those of at least `least`."""
    side = ranked.select(by, "rank", score, name)
    left = side.select(by, F.col("rank").alias("rank_l"), F.col(score).alias("score_l"), F.col(name).alias("chosen_id"))
    right = side.select(by, F.col("rank").alias("rank_r"), F.col(score).alias("score_r"), F.col(name).alias("rejected_id"))
    both = left.join(right, by).where("rank_l < rank_r").withColumn("score_gap", half_up(F.col("score_l") - F.col("score_r"), 3))
    return both.where(F.col("score_gap") >= least).withColumn("pair_type", pair_type(F.col("score_gap"), clean))


def pair_type(gap: Column, clean: float = 0.3) -> Column:
    return F.when(gap >= clean, "clean_preference").otherwise("hard_example")


def pointwise(scored: DataFrame, score: str) -> DataFrame:
    """Adds the fixed instruction and the score on a scale of ten."""
    return scored.withColumns({"instruction": F.lit(INSTRUCTION), "relevance_score": half_up(F.col(score) * 10, 2), "relevance_score_0_to_1": F.col(score)})


def grouped(ranked: DataFrame, by: str, fields: list[str], least: int = 1) -> DataFrame:
    """One row a group with its candidates in rank order; ranks stay as they are."""
    rows = ranked.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("candidates"))
    return rows.where(F.size("candidates") >= least)
