"""Partitioned Parquet writes of the lake.

Layout: one Hive-style directory per partition value, Snappy Parquet
files. Before the write the rows are ``rebalance``-d on the partition
columns instead of hash-repartitioned into a fixed number of tasks: with
AQE a hot partition value (``Unknown`` region, the ``actor`` category, a
recent year) is split into several tasks of the advisory size, and tiny
ones are merged, so one value can hold a third of all rows without one
task writing it alone.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import LakeSpec
from marquee.sources.manifest import POOL_PREFIX, POOLED, partition_key

OVERWRITE_MODES = ("static", "dynamic")


def sort_columns(sort_by: Sequence) -> list[Column]:
    cols: list[Column] = []
    for item in sort_by:
        if isinstance(item, tuple):
            name, default = item
            cols.append(F.coalesce(F.col(name), F.lit(default)))
        elif isinstance(item, Column):
            cols.append(item)
        else:
            cols.append(F.col(item))
    return cols


def layout_for_write(
    df: DataFrame,
    partition_by: Sequence[str],
    sort_by: Sequence = (),
    observation: Observation | None = None,
    metrics: Sequence[Column] = (),
) -> DataFrame:
    """Distribute by the partition columns (skew-aware).

    With ``sort_by`` the rows are dealt by ranges of partition columns and
    sort key instead and sorted in each task: the files of one partition value
    hold disjoint key ranges, so file and row-group min/max let later scans
    skip. A hot value covers many ranges and so many tasks.

    An ``observation`` counts rows after the shuffle, i.e. in the write
    stage itself: metrics of that final stage are merged once per output
    partition, so a task retried after a lost executor is not counted twice
    (a map stage before the shuffle may be re-run as a whole).
    """
    if sort_by:
        out = df.repartitionByRange(*partition_by, *sort_columns(sort_by))
    else:
        out = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_columns(sort_by))
    return out


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    mode: str = "static",
    sort_by: Sequence = (),
    observation: Observation | None = None,
) -> None:
    """Overwrite ``path`` with ``df`` partitioned by ``partition_by``.

    ``mode="static"`` replaces the whole dataset (a full rebuild: titles
    whose year or type changed leave no stale copy behind).
    ``mode="dynamic"`` replaces only the partitions present in ``df`` and
    keeps the others.
    """
    if mode not in OVERWRITE_MODES:
        raise ValueError(f"mode must be one of {OVERWRITE_MODES}, got {mode!r}")
    writer = (
        layout_for_write(df, partition_by, sort_by, observation)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "snappy")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_counted(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    mode: str = "static",
    sort_by: Sequence = (),
    probe: DataFrame | None = None,
) -> int:
    """Write ``df`` unless it is empty; return the number of rows written.

    The emptiness test runs on ``probe`` — a narrow frame that is empty
    exactly when ``df`` is (the left side of ``df``'s left joins) — so it
    stops at the first row instead of computing the joins. The row count is
    collected by ``observe`` in the write stage: one pass over the data
    instead of a separate ``count()``. An empty input writes nothing and
    leaves existing data as it is.
    """
    if (probe if probe is not None else df).isEmpty():
        return 0
    observation = Observation("rows_written")
    write_partitioned(
        df, path, partition_by, mode=mode, sort_by=sort_by, observation=observation
    )
    return int(observation.get["rows"])


def write_routed(
    df: DataFrame,
    path: str,
    spec: LakeSpec,
    large: Collection[str] | None = None,
    observation: Observation | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write a new lake segment, in one job.

    Rows whose partition value is in ``large`` (all, for ``None``) go to a
    directory per value below ``pooled=false``. The others share files below
    ``pooled=true``: one directory, clustered and sorted by the partition
    columns, so that row-group statistics take the place of directories. Files
    of small values are thereby as large as the tasks that write them, and
    their number follows the bytes written instead of the number of values.

    A task's rows of one value are sorted by the dataset's key: equal titles lie
    together, so the files and the shuffles that read them take fewer bytes.

    ``finish`` adds the columns that ``df`` still lacks by a broadcast lookup,
    in the tasks that write: they are not shuffled.
    """
    pooled = F.lit(False) if large is None else ~partition_key(spec).isin(list(large))
    keys = [POOL_PREFIX + c for c in spec.partition_by]
    routed = df.withColumn(POOLED, pooled)
    for c in spec.partition_by:
        kind = spec.schema[c].dataType
        value = F.nullif(F.col(c), F.lit("")) if isinstance(kind, T.StringType) else F.col(c)
        routed = routed.withColumn(POOL_PREFIX + c, F.when(F.col(POOLED), value))
    for c in spec.partition_by:
        routed = routed.withColumn(c, F.when(~F.col(POOLED), F.col(c)))
    # values of both kinds are dealt by value; a hot one is split (see layout_for_write)
    dealt = routed.hint("rebalance", POOLED, *spec.partition_by, *keys)
    if finish is not None:
        dealt = finish(dealt).select(*spec.columns, POOLED, *keys)
    if observation is not None:
        dealt = dealt.observe(observation, F.count(F.lit(1)).alias("rows"))
    # Last: below another step Spark drops it for the writer's own sort by directory.
    ordered = dealt.sortWithinPartitions(POOLED, *spec.partition_by, *keys, *spec.key)
    ordered.write.option("compression", "snappy").partitionBy(POOLED, *spec.partition_by).parquet(path)
