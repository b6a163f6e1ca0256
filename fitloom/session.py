"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors' Python workers this package, once an application; Spark's file server carries it."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        home = Path(__file__).resolve().parent
        at = os.path.join(tempfile.mkdtemp(prefix="fitloom-"), "fitloom.zip")
        with zipfile.ZipFile(at, "w") as z:
            for f in sorted(home.rglob("*.py")):
                z.write(f, f.relative_to(home.parent))
        sc.addPyFile(at)
        _shipped.add(sc.applicationId)
    return spark


def session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that tests and the benchmark use."""
    build = SparkSession.builder.master(f"local[{cores}]").appName("fitloom")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for k, v in settings.items():
        build = build.config(k, v)
    spark = build.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
