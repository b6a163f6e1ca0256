"""Small helpers for Arrow batches, schemas and the folder that executors share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for a null id inside the operators: larger than every real one.
NO_ID = np.iinfo(np.int64).max
_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType(), "double": T.DoubleType(), "array<double>": T.ArrayType(T.DoubleType()), "array<long>": T.ArrayType(T.LongType()), "array<string>": T.ArrayType(T.StringType())}


#: Paths given out inside scratch() blocks, innermost last.
_open: list[list[str]] = []


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new path below spark.checkpoint.dir.  Where that is unset, a local master, as in tests, gets a
    folder of this machine; on a cluster, whose executors would not see it, that is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="fitloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    path = f"{top.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def removed(spark: SparkSession, *paths: str) -> None:
    """Deletes tables of the shared folder that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Deletes, at its end, what was put into the shared folder within it and is still in the list it gives."""
    _open.append([])
    try:
        yield _open[-1]
    finally:
        removed(spark, *_open.pop())


def modest(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the rows of an Arrow batch: whole texts are long, and JVM and Python each hold batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > rows or int(spark.conf.get(name, "10000")) <= 0:
        spark.conf.set(name, str(rows))


def give_back() -> None:
    """Hands freed memory back to the machine: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(work):
    """A batch function that gives memory back when its partition ends."""

    def run(batches):
        yield from work(batches)
        give_back()

    return run


def lean_group(work, keyed: bool = True):
    """The same for a group function, after each group of some size."""

    def run(*args):
        out = work(*(args if keyed else args[-1:]))
        if sum(t.nbytes for t in args if isinstance(t, pa.Table)) > 1 << 20:
            give_back()
        return out

    return (lambda key, group: run(key, group)) if keyed else (lambda group: run(group))


def map_texts(df: DataFrame, work, out) -> DataFrame:
    """df.mapInArrow with modest batches and a lean function."""
    modest(df.sparkSession)
    return df.mapInArrow(lean(work), out)


def stored(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, and its path."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared folder: later reads survive lost executors and don't repeat the work."""
    return stored(df, what)[0]


def schema(df: DataFrame | None, **extra: str) -> T.StructType:
    """The columns of df followed by extra ones; a column of df that has the name of an extra one is replaced."""
    fields = [] if df is None else [f for f in df.schema.fields if f.name not in extra]
    return T.StructType([*fields, *(T.StructField(k, _TYPES[v]) for k, v in extra.items())])


def with_columns(batch: pa.RecordBatch | pa.Table, drop: tuple[str, ...] = (), **extra) -> pa.RecordBatch:
    """The batch with extra columns at its end, in the order of schema()."""
    keep = [n for n in batch.schema.names if n not in extra and n not in drop]
    kind = pa.Table if isinstance(batch, pa.Table) else pa.RecordBatch
    return kind.from_arrays([*(batch.column(n) for n in keep), *extra.values()], names=[*keep, *extra])


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts take about `most` bytes; one longer text makes a piece of its own."""
    sizes = np.fromiter((0 if v is None else v for v in pa.compute.binary_length(batch.column(column)).to_pylist()), np.int64, batch.num_rows)
    total, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as int64, nulls as NO_ID."""
    return np.asarray(pa.compute.fill_null(column.cast(pa.int64()), int(NO_ID)).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else pa.compute.fill_null(column.cast(pa.int64()), int(NO_ID)).to_numpy())


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def table(kinds: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.table({k: pa.array(list(c), t) for (k, t), c in zip(kinds.items(), columns, strict=True)})


def parts(docs: DataFrame, rows: int = 1500, size: int = 8 << 20) -> int:
    """How many parts of about `rows` rows, or `size` bytes of text where texts are long, a table makes."""
    many, total = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return max(1, -(-many // rows), -(-total // size))


def readers(files: int) -> int:
    """Tasks that read so many files back: one a file, and beyond 2,000 files up to eight in a task, however many."""
    return max(1, min(2000, files), -(-files // 8))


def dealt(docs: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """docs with a column __part that deals rows out by a hash of the key; null keys go by the text."""
    by = F.xxhash64(key, "text") if "text" in docs.columns else F.xxhash64(key)
    return docs.withColumn("__part", F.pmod(by, F.lit(n)).cast("int"))
