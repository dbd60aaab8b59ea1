"""spark-submit job: load a table, analyse it, write every result table."""

from __future__ import annotations

import argparse
import sys
from pathlib import PurePosixPath

from pyspark.sql import SparkSession

from ..functions.tables import staged
from ..sources.reader import load_table
from ..sources.sink import write_tables
from .analyze import analyze


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="rolewise")
    run = out.add_subparsers(dest="command", required=True).add_parser("run", help="analyse one table")
    run.add_argument("data", help="CSV or Parquet file, folder or glob")
    run.add_argument("--target", default=None, help="column to model; left out: no models")
    run.add_argument("--out", default=None, help="folder for the result tables")
    run.add_argument("--name", default=None, help="name of the dataset")
    run.add_argument("--format", default="parquet", choices=("parquet", "json"))
    run.add_argument("--intervention-date", default=None)
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("rolewise").config("spark.ui.enabled", "false").getOrCreate()
    try:
        table = load_table(spark, args.data)
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        print(f"error: not found: {args.data}", file=sys.stderr)
        return 1
    if "parquet" not in PurePosixPath(args.data.rstrip("/*")).suffix:
        table = staged(table)                       # the chain reads it many times: parse it once
    name = args.name or PurePosixPath(args.data).stem
    result = analyze(table, args.target, name, intervention_date=args.intervention_date)
    out = args.out or f"reports/{name}"
    write_tables(result.tables, out, args.format)
    print(f"Rows x columns: {result.roles.n_rows} x {len(result.roles.columns)}")
    if result.models:
        print(f"Task: {result.roles.task}, best model: {result.models.best}")
        for metric, value in result.models.scores[result.models.best].items():
            print(f"  {metric}: {value:.4f}")
    print(f"Tables written to: {out}")
    return 0
