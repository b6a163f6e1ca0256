"""The registered queries of the engine's own operators, and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import q_data, q_generate, q_score, q_text

MODULES = [q_text, q_score, q_data, q_generate]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scored candidate of each order with its seven-axis breakdown."""
    return q_score.entry(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"flagship": flagship} | {name: run for m in MODULES for name, (run, _) in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: sql for m in MODULES for name, (_, sql) in m.Q.items() if sql}
    return {"flagship": q_score._AXES + f"SELECT {', '.join(q_score._ALL)} FROM ranked WHERE rank = 1"} | found
