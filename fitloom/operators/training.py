"""Fine-tuning as an interface: examples as a table, a pluggable trainer, answers of the trained model as a column.

A trainer is made on the driver and gets the table of examples, not rows: it may write it for another
system, or aggregate it with Spark.  What it returns is a factory of clients as operators.external uses.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .external import Limiter, complete


class Trainer(Protocol):
    def fit(self, examples: DataFrame) -> Callable[[], object]:
        """examples has text, n_prompt and n_all; returns a factory of clients."""


def examples(df: DataFrame, prompt: str = "prompt", answer: str = "answer", most: int = 1024) -> DataFrame:
    """Rows with an answer as text, with the number of its words and of those of the prompt, which no loss
    counts.  Longer texts than `most` words are cut at the end, as a trainer's context is; without any word of
    the answer left they go."""
    rows = df.where(F.col(answer).isNotNull()).withColumns({"__p": F.split(prompt, " "), "__a": F.split(answer, " ")})
    rows = rows.withColumn("text", F.array_join(F.slice(F.concat("__p", "__a"), 1, most), " "))
    return rows.withColumns({"n_prompt": F.size("__p"), "n_all": F.least(F.size("__p") + F.size("__a"), F.lit(most))}).where("n_all > n_prompt").drop("__p", "__a")


def fit(rows: DataFrame, trainer: Callable[[], Trainer]) -> Callable[[], object]:
    return trainer().fit(rows)


def generate(model: Callable[[], object], df: DataFrame, prompt: str = "prompt", rpm: float | None = None) -> DataFrame:
    """df with n_prompt and the model's answer to each prompt, in the table's own partitions unless a rate is given."""
    out = complete(df.drop("answer").withColumn("__prompts", F.array(prompt)), "__prompts", model, rpm=rpm or 1e9, limiter=lambda r, n: Limiter(r, n), tasks=4 if rpm else None)
    return out.withColumn("n_prompt", F.size(F.split(prompt, " "))).drop("__prompts")


class Mean:
    """A trainer for tests: the model answers with the mean of the numbers that its prompt had as answers."""

    MOST = 10_000

    def fit(self, examples: DataFrame) -> Callable[[], object]:
        rows = examples.select(F.expr("array_join(slice(split(text, ' '), 1, n_prompt), ' ')").alias("prompt"), F.element_at(F.split("text", " "), -1).cast("double").alias("y"))
        means = rows.groupBy("prompt").agg(F.avg("y").alias("y")).limit(self.MOST + 1).collect()
        if len(means) > self.MOST:
            raise ValueError(f"more than {self.MOST} kinds of prompts")
        known = {r["prompt"]: r["y"] for r in means}

        class Model:
            def complete(self, prompt: str, settings: dict) -> str:
                return repr(known.get(prompt, 0.0))

        return Model
