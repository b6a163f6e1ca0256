"""Incremental runs: a file stream of line JSON through a transform, each file once; deliveries that repeat rows, each row once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.manifest import Table
from ..sources.sinks import append_new


def incremental(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str, transform: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Handles all files that are new since the last run and appends rows with keys that are new, so a
    repeated micro-batch changes nothing."""
    rows = spark.readStream.schema(schema).json(source)
    return transform(rows).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: append_new(batch.dropDuplicates([key]), target, key)).start()


def once(rows: DataFrame, target: Table, checkpoint: str, key: str, ts: str, delay: str, name: str = "batch") -> StreamingQuery:
    """Appends each key of a stream once to target, and ends when what is there has been read.

    Keys seen are state of the stream, kept until the newest time is `delay` past theirs, so neither the state nor the
    work of a batch grows with the table.  A key may be delivered again within delay of its time, also in a later run;
    what is older than delay when its batch begins counts as delivered before and is left out.  A micro-batch that is
    repeated after a crash carries its number to the commit and adds nothing.  ts must be a timestamp; rows without a
    time or key go, as no run could tell whether they were there before."""
    known = rows.where(F.col(ts).isNotNull() & F.col(key).isNotNull())
    new = known.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])

    def add(batch: DataFrame, n: int) -> None:
        if target.has(f"{name}-{n}"):
            batch.write.format("noop").mode("overwrite").save()  # the state that the lost run didn't keep is made again
        else:
            target.append(batch, f"{name}-{n}")

    return new.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start()


def windowed_counts(events: DataFrame, ts: str, by: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of a stream by event-time window, late rows dropped after the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")
