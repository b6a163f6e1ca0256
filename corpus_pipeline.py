"""Corpus pipeline: toxicity, near copies, repeated passages, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last
return the columns of documents, whatever their names.  run() writes each stage's result to the shared
folder and rereads it, so that a lost executor costs a stage's tasks and not its predecessors; what a
stage put there besides its result is deleted when the stage ends.

In every stage null texts count as empty; rows that stay keep their null ids and all other columns; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.llm import decontam, minhash, queries, substring, toxicity
from fitloom.llm.frames import scratch, written


def _where(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], test: str) -> DataFrame:
    """Rows of the operator's result that pass a test of its columns, with the columns of docs: these get other
    names on the way, as the operator replaces columns of the names it adds."""
    own = [c if c in ("doc_id", "text") else f"__column{i}" for i, c in enumerate(docs.columns)]
    return operator(docs.toDF(*own)).where(test).select(*map(F.col, own)).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the ordinal model calls toxic; each row is judged alone, so repeated rows share a fate.
    Labels of null ids are left out, and of labels that repeat an id the greatest counts."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _where(docs, lambda d: toxicity.predict(d, model), "kept")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group that links at 0.8 of five-word shingles, nulls last; of rows alike in
    doc_id and text one stays.  Documents without words link with nothing."""
    return minhash.keep_first(docs, n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 13-word windows that a document of smaller id has, a null id being the largest; documents that are left
    without words go, those that had none stay.  Words that stay keep their white space.  Rows of one doc_id don't cut
    each other."""
    return _where(docs, lambda d: substring.remove_repeats(d, n=13, spaces=True), "n_words = 0 or n_removed < n_words")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item's template; null and empty items are left out."""
    return _where(docs, lambda d: decontam.contaminated(d, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "kept")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of what is left, a row for each row."""
    return queries.bpe_digests(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("substring_dedup", cut_repeats), ("decontamination", drop_leaks), ("bpe", tokens)]

#: Tokenizers and the fitted model have no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark) as spent:
            docs = written(stage(spark, docs, sf_dir), name)
            spent.pop()  # the result stays
    return docs
