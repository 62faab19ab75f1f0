"""Writing lake versions: whole rebuilds, partial updates, expiry.

A version is written beside the current one and becomes visible with its
manifest row (``marquee.sources.manifest.commit``). Nothing of an older version
is changed or removed before that, so a run that fails leaves the lake as it
was.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.operators.sinks import OVERWRITE_MODES, write_routed
from marquee.sources.manifest import (
    LakeState,
    Segment,
    commit,
    measure,
    new_version,
    partition_key,
    read_history,
    read_segments,
    read_state,
)
from marquee.sources.tsv import can_delete, delete_path, path_exists

log = logging.getLogger(__name__)

# A partition value with fewer rows shares files with others (0: none does).
POOL_ROWS = 50_000
# A dataset patched together from more folders is rewritten into one.
MAX_SEGMENTS = 8
# Committed versions whose files stay: the current one and the one that readers
# who came before the last commit still use.
KEEP_VERSIONS = 2


def version_path(version: str, name: str, part: str = "") -> str:
    return f"versions/{version}/{name}" + (f"-{part}" if part else "")


def large_values(df: DataFrame, spec: S.LakeSpec, pool_rows: int) -> set[str] | None:
    """Partition values of at least ``pool_rows`` rows (``None``: all count as large).

    Rows are counted before they are written, over the partition columns alone;
    at most rows / pool_rows values reach the driver.
    """
    if pool_rows <= 0:
        return None
    counts = df.groupBy(partition_key(spec).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return {r["key"] for r in counts.where(F.col("n") >= pool_rows).select("key").collect()}


def write_segment(
    spark: SparkSession, lake_dir: str, path: str, df: DataFrame, spec: S.LakeSpec, large: Collection[str] | None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[Segment, int]:
    """Write ``df`` as a segment; return it with the rows observed in the write."""
    observation = Observation(f"segment_{spec.name}")
    write_routed(df, f"{lake_dir.rstrip('/')}/{path}", spec, large, observation, finish)
    rows = int(observation.get["rows"])
    segment = measure(spark, lake_dir, path, spec)
    if sum(segment.rows.values()) != rows:
        raise RuntimeError(f"{path}: {rows} rows were written, {sum(segment.rows.values())} are there")
    return segment, rows


def update_dataset(
    spark: SparkSession, lake_dir: str, version: str, df: DataFrame, spec: S.LakeSpec,
    old: tuple[Segment, ...] = (), large: Collection[str] | None = None, pool_rows: int = POOL_ROWS,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[tuple[Segment, ...], int]:
    """The dataset ``old`` with the partitions present in ``df`` replaced by it
    (a rebuild where there is no ``old``); its segments and the rows written.

    Rows that moved are found by key: an old row of another partition whose key
    comes again in ``df`` is stale. The partitions that hold such rows are
    written anew without them, all others stay where they are. One join of keys
    with the old rows (key and partition columns only) finds them. ``finish``:
    see ``write_routed``.
    """
    root = lake_dir.rstrip("/")
    new, rows = write_segment(spark, root, version_path(version, spec.name), df, spec, large, finish)
    if not new.rows:
        return old, 0
    replaced = set(new.rows)
    kept = tuple(s.without(replaced) for s in old)
    kept = tuple(s for s in kept if s.rows)
    segments = [new]
    if kept:
        keys = read_segments(spark, root, (new,), spec).select(*spec.key).distinct()
        before = read_segments(spark, root, kept, spec)
        moved = before.join(keys, list(spec.key), "left_semi")
        stale = {r["key"] for r in moved.select(partition_key(spec).alias("key")).distinct().collect()}
        if stale:
            survivors = before.where(partition_key(spec).isin(list(stale))).join(keys, list(spec.key), "left_anti")
            rest, _ = write_segment(
                spark, root, version_path(version, spec.name, "rest"), survivors, spec,
                large_values(survivors, spec, pool_rows))
            segments += [rest] if rest.rows else []
            kept = tuple(s for s in (s.without(stale) for s in kept) if s.rows)
    segments += kept
    if len(segments) > MAX_SEGMENTS:
        whole = read_segments(spark, root, segments, spec)
        live: dict[str, int] = {}
        for s in segments:
            for k, n in s.rows.items():
                live[k] = live.get(k, 0) + n
        merged = {k for k, n in live.items() if n >= pool_rows} if pool_rows > 0 else None
        one, _ = write_segment(spark, root, version_path(version, spec.name, "merged"), whole, spec, merged)
        segments = [one]
    return tuple(segments), rows


def write_lake(
    spark: SparkSession, lake_dir: str, datasets: dict[str, DataFrame], mode: str = "static",
    pool_rows: int = POOL_ROWS, keep_versions: int = KEEP_VERSIONS,
) -> dict[str, int]:
    """Commit a version with the given datasets (of the lake's schemas); return
    the rows written.

    ``"static"``: the version holds these datasets and no others. ``"dynamic"``:
    each replaces the partitions it has rows for (see ``update_dataset``).
    """
    if mode not in OVERWRITE_MODES:
        raise ValueError(f"mode must be one of {OVERWRITE_MODES}, got {mode!r}")
    base, version = current_state(spark, lake_dir), new_version()
    state = dict(base.datasets) if base is not None and mode == "dynamic" else {}
    counts = {}
    try:
        for name, df in datasets.items():
            spec = S.LAKE[name]
            old = state.get(name, ()) if mode == "dynamic" else ()
            segments, counts[name] = update_dataset(
                spark, lake_dir, version, df, spec, old, large_values(df, spec, pool_rows), pool_rows)
            state[name] = segments
        commit(spark, lake_dir, version, {n: s for n, s in state.items() if s}, base)
    except BaseException:
        discard(spark, lake_dir, version)
        raise
    expire_versions(spark, lake_dir, keep_versions)
    return counts


def current_state(spark: SparkSession, lake_dir: str) -> LakeState | None:
    """The newest version; for a lake of plain dataset folders (written without
    versions) these folders as version 0, so that an update can build on them."""
    state = read_state(spark, lake_dir)
    if state is not None:
        return state
    found = {}
    for name, spec in S.LAKE.items():
        if path_exists(spark, f"{lake_dir.rstrip('/')}/{name}"):
            segment = measure(spark, lake_dir, name, spec, plain=True)
            if segment.rows:
                found[name] = (segment,)
    return LakeState(datasets=found) if found else None


def discard(spark: SparkSession, lake_dir: str, version: str) -> None:
    """Remove the files of a version that was not committed (or is expired)."""
    path = f"{lake_dir.rstrip('/')}/versions/{version}"
    if can_delete(spark):
        delete_path(spark, path)
    else:
        log.warning("%s is left behind: this session cannot delete files", path)


def expire_versions(spark: SparkSession, lake_dir: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Remove the files that only versions older than the newest ``keep`` use.

    Returns the folders removed. A folder that a newer version still reads (an
    update keeps untouched partitions where they are) stays.
    """
    if keep < 1:
        raise ValueError("at least the current version must be kept")
    if not can_delete(spark):
        log.warning("%s: old versions stay, this session cannot delete files", lake_dir)
        return []
    history = read_history(spark, lake_dir)
    if history is None:
        return []
    paths = F.expr("flatten(map_values(from_json(state, 'map<string, array<struct<path: string>>>')))").path
    used = history.select("sequence", F.explode(paths).alias("path"))
    newest = [r["sequence"] for r in history.select("sequence").distinct().orderBy(F.desc("sequence")).limit(keep).collect()]
    last = used.groupBy("path").agg(F.max("sequence").alias("last")).where(F.col("last") < min(newest))
    root = lake_dir.rstrip("/")
    gone = [p for p in sorted(r["path"] for r in last.collect()) if path_exists(spark, f"{root}/{p}")]
    for path in gone:
        delete_path(spark, f"{root}/{path}")
    return gone
