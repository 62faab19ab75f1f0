"""Command line: ``python -m marquee {etl,serve,report} ...``.

- ``etl``    raw directory -> lake, prints the row count per dataset
- ``serve``  lake -> serving tables (full refresh), prints validation counts
- ``report`` runs the eight reports over the lake or the serving tables

Each command runs on the session ``spark-submit`` provides (or a local one).
"""

from __future__ import annotations

import argparse
import sys

from pyspark import SparkConf
from pyspark.sql import SparkSession

from marquee import schemas as S
from marquee.operators import (
    avg_rating_by_type,
    genre_popularity,
    runtime_by_genre,
    top_people_in_categories,
    top_people_typed,
    top_rated_by_decade,
    top_regions,
    top_series_by_episode_count,
)
from marquee.operators.analytics import MEDIAN_METHODS
from marquee.plans import read_table, refresh_serving, run_etl_from_dir, validate_counts
from marquee.plans.etl import counts_frame, lake_path
from marquee.session import apply_session_defaults, input_bytes, size_shuffles
from marquee.sources import path_exists, read_lake

REPORTS = {
    "top_rated_by_decade": ("titles", top_rated_by_decade),
    "avg_rating_by_type": ("titles", avg_rating_by_type),
    "top_series_by_episode_count": ("episodes", top_series_by_episode_count),
    "genre_popularity": ("titles", genre_popularity),
    "runtime_by_genre": ("titles", runtime_by_genre),
    "top_actors": ("principals", top_people_in_categories),
    "top_regions": ("akas", top_regions),
    "top_directors": ("principals", top_people_typed),
}


def _session() -> SparkSession:
    """The session spark-submit provides; library defaults fill only the
    settings the cluster left unset. The web UI stays off unless the launch
    configuration turns it on (``--conf spark.ui.enabled=true``)."""
    builder = SparkSession.builder.appName("marquee")
    if not SparkConf().contains("spark.ui.enabled"):
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    apply_session_defaults(spark)
    return spark


def _size_for(spark: SparkSession, path: str) -> None:
    """Size the initial shuffle partitions from the input (unless set)."""
    count = size_shuffles(spark, input_bytes(spark, path))
    if count is not None:
        print(f"initial shuffle partitions: {count}", file=sys.stderr)


def _etl(spark: SparkSession, args) -> int:
    if path_exists(spark, args.raw):
        _size_for(spark, args.raw)
    counts = run_etl_from_dir(spark, args.raw, args.lake, mode=args.mode, quote=args.quote)
    counts_frame(spark, counts).show(truncate=False)
    return 0


def _serve(spark: SparkSession, args) -> int:
    if path_exists(spark, args.lake):
        _size_for(spark, args.lake)
    counts = refresh_serving(spark, args.lake, args.database, args.location)
    for name, found in counts.out_of_range.items():
        for column, n in found.items():
            print(f"{name}.{column}: {n} value(s) outside the serving range, kept", file=sys.stderr)
    validate_counts(spark, args.database).show(truncate=False)
    return 0


def _report(spark: SparkSession, args) -> int:
    names = args.only or list(REPORTS)
    for name in names:
        dataset, fn = REPORTS[name]
        if args.database:
            df = read_table(spark, args.database, dataset)
        else:
            try:
                df = read_lake(spark, lake_path(args.lake, dataset), S.LAKE[dataset])
            except FileNotFoundError:
                print(f"{name}: dataset {dataset} not in the lake, skipped")
                continue
        print(f"== {name}")
        report = fn(df, median=args.median) if fn is runtime_by_genre else fn(df)
        report.show(truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marquee")
    sub = parser.add_subparsers(dest="command", required=True)

    etl = sub.add_parser("etl", help="raw TSV directory -> partitioned Parquet lake")
    etl.add_argument("--raw", required=True)
    etl.add_argument("--lake", required=True)
    etl.add_argument("--mode", choices=("static", "dynamic"), default="static")
    etl.add_argument("--quote", default="", help="quote character ('' = quoting off)")

    serve = sub.add_parser("serve", help="lake -> serving tables, then validation counts")
    serve.add_argument("--lake", required=True)
    serve.add_argument("--database", default=S.SERVING_DATABASE)
    serve.add_argument("--location", default=None)

    report = sub.add_parser("report", help="run the reports")
    src = report.add_mutually_exclusive_group(required=True)
    src.add_argument("--lake")
    src.add_argument("--database")
    report.add_argument("--only", nargs="*", choices=list(REPORTS))
    report.add_argument("--median", choices=MEDIAN_METHODS, default=MEDIAN_METHODS[0],
                        help="median strategy of runtime_by_genre (exact unless 'approx')")

    args = parser.parse_args(argv)
    spark = _session()
    try:
        if args.command == "etl":
            return _etl(spark, args)
        if args.command == "serve":
            return _serve(spark, args)
        return _report(spark, args)
    except FileNotFoundError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return 1
