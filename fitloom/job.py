"""Runs one registered query on a folder of tables and writes its result: python -m fitloom.job QUERY --data DIR --out PATH."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from . import catalog
from .session import ship
from .sources.readers import first_rows
from .sources.sinks import write_jsonl


def options(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="fitloom.job", description=__doc__)
    p.add_argument("query", choices=sorted(catalog.queries()))
    p.add_argument("--data", required=True, help="folder of the input tables")
    p.add_argument("--out", required=True, help="where the result goes")
    p.add_argument("--format", choices=["parquet", "jsonl"], default="parquet")
    p.add_argument("--mode", choices=["overwrite", "append", "errorifexists"], default="errorifexists")
    p.add_argument("--order", help="column that --limit goes by")
    p.add_argument("--limit", type=int, default=0, help="rows of the result; 0 for all")
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="a setting of the Spark session")
    found = p.parse_args(args)
    if found.limit > 0 and not found.order:
        p.error("--limit needs --order")
    return found


def run(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    df = catalog.queries()[o.query](ship(spark), o.data)
    df = first_rows(df, o.order, o.limit) if o.limit > 0 else df
    if o.format == "jsonl":
        write_jsonl(df, o.out, o.mode)
    else:
        df.write.mode(o.mode).parquet(o.out)
    return df


def main(args: list[str] | None = None) -> None:
    o = options(args)
    build = SparkSession.builder.appName(f"fitloom {o.query}")
    for pair in o.conf:
        name, _, value = pair.partition("=")
        build = build.config(name, value)
    run(build.getOrCreate(), o)


if __name__ == "__main__":
    main()
