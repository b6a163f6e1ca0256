"""Tables that change by commits: each version is one manifest that names the folders its rows are in.

A change writes a new folder first, then a manifest under another name, and then renames that to the next number,
which is the one moment when it becomes visible; of two writers one fails.  Readers follow the newest manifest, so
a writer that dies anywhere leaves the old state, and folders that no manifest names are only waste for vacuum().
Appends carry a batch id: a batch that is in the manifest adds nothing when it is repeated.  A replacement may read
the table that it replaces.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer committed first; nothing was changed."""


class Table:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = spark.createDataFrame([], schema).schema
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """Number of the newest manifest; 0 before the first commit."""
        folder = self._at(f"{self.path}/manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def _manifest(self, version: int) -> dict:
        if not version:
            return {"folders": [], "batches": []}
        lines = self.spark.read.text(f"{self.path}/manifests/{version}.json").collect()  # one line
        return json.loads(lines[0]["value"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given."""
        folders = self._manifest(self.version() if version is None else version)["folders"]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def has(self, batch: str) -> bool:
        """Whether a batch was committed."""
        return batch in self._manifest(self.version())["batches"]

    def _written(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, after: int, manifest: dict) -> int:
        staged, final = f"{self.path}/manifests/{uuid.uuid4().hex}.open", f"{self.path}/manifests/{after + 1}.json"
        self._fs.mkdirs(self._at(f"{self.path}/manifests"))
        out = self._fs.create(self._at(staged), False)
        out.write(bytearray((json.dumps(manifest) + "\n").encode()))
        out.close()
        if self._fs.exists(self._at(final)) or not self._fs.rename(self._at(staged), self._at(final)):
            self._fs.delete(self._at(staged), False)
            raise Conflict(f"version {after + 1} is there already")
        return after + 1

    def append(self, df: DataFrame, batch: str, key: str | None = None) -> int:
        """Appends the rows whose key the table doesn't have, or all rows without a key, and returns the version.

        A null key is a key like others: the table holds one row of it.  Of rows of a batch that share a key the
        least stays, by the order of the columns.  A batch that was committed before adds nothing."""
        now = self.version()
        manifest = self._manifest(now)
        if batch in manifest["batches"]:
            return now
        if key is None:
            return self._commit(now, {"folders": [*manifest["folders"], self._written(df)], "batches": [*manifest["batches"], batch]})
        row = F.struct(*self.schema.names)
        new = df.groupBy(F.col(key).alias("__key")).agg(F.min(row).alias("__row"))
        done = self.read(now).select(F.col(key).alias("__done")).distinct()
        new = new.join(done, F.col("__key").eqNullSafe(F.col("__done")), "left_anti").select("__row.*")
        return self._commit(now, {"folders": [*manifest["folders"], self._written(new)], "batches": [*manifest["batches"], batch]})

    def replace(self, df: DataFrame) -> int:
        """Makes df the table, which it may be worked out from; batches stay known."""
        now = self.version()
        return self._commit(now, {"folders": [self._written(df)], "batches": self._manifest(now)["batches"]})

    def vacuum(self) -> int:
        """Deletes folders and manifests that the newest version doesn't need; how many.  No writer may be at work."""
        now = self.version()
        keep = {f.rpartition("/")[2] for f in self._manifest(now)["folders"]} | {f"{now}.json"}
        old = [s.getPath() for part in ("data", "manifests") if self._fs.exists(self._at(f"{self.path}/{part}")) for s in self._fs.listStatus(self._at(f"{self.path}/{part}")) if s.getPath().getName() not in keep]
        for path in old:
            self._fs.delete(path, True)
        return len(old)
