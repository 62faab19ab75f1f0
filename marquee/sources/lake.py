"""Scans of the partitioned Parquet lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from marquee.schemas import LAKE, LakeSpec
from marquee.sources.manifest import LakeState, not_found, read_segments, read_state
from marquee.sources.tsv import path_exists


def _spec(spec: LakeSpec | str) -> LakeSpec:
    return LAKE[spec] if isinstance(spec, str) else spec


def read_lake(spark: SparkSession, path: str, spec: LakeSpec | str) -> DataFrame:
    """Read one lake dataset with its declared schema.

    In a lake with a manifest ``path`` (``<lake>/<dataset>``) names a dataset of
    the newest committed version; anywhere else it is a folder written by
    ``write_partitioned``. The explicit schema fixes the types of the partition
    columns too: without it a region directory ``region=01`` would re-read as
    the integer 1. Partition discovery still runs, so filters on partition
    columns prune directories (``PartitionFilters``) and other filters reach
    the Parquet reader (``PushedFilters``).
    """
    spec = _spec(spec)
    lake_dir, _, name = path.rstrip("/").rpartition("/")
    state = read_state(spark, lake_dir)
    if state is not None and name in LAKE:
        return read_version(spark, lake_dir, state, name)
    return _read_folder(spark, path, spec)


def read_version(spark: SparkSession, lake_dir: str, state: LakeState, name: str) -> DataFrame:
    """A dataset of a given version. Readers of several datasets resolve the
    state once, so that all of them come from the same version."""
    if name not in state.datasets:
        raise FileNotFoundError(f"lake dataset {name} not found in version {state.version} of {lake_dir}")
    return read_segments(spark, lake_dir, state.datasets[name], LAKE[name])


def _read_folder(spark: SparkSession, path: str, spec: LakeSpec) -> DataFrame:
    try:
        df = spark.read.schema(spec.schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if not_found(error):
            raise FileNotFoundError(f"lake dataset {spec.name} not found at {path}") from None
        raise
    # a write under way or interrupted has a _temporary folder and no _SUCCESS
    # (which a dynamic overwrite never writes)
    torn = path_exists(spark, f"{path}/_temporary") and not path_exists(spark, f"{path}/_SUCCESS")
    if torn or not df.inputFiles():
        raise FileNotFoundError(f"lake dataset {spec.name}: no committed Parquet file in {path}")
    return df.select(*spec.columns)


def lake_project(
    spark: SparkSession, path: str, spec: LakeSpec | str, columns: Sequence[str]
) -> DataFrame:
    """Read only ``columns`` (partition columns included) of a lake dataset.

    Column pruning reaches the scan, so only the selected Parquet columns
    are decoded (``ReadSchema`` lists just those).
    """
    spec = _spec(spec)
    unknown = [c for c in columns if c not in spec.columns]
    if unknown:
        raise ValueError(f"{spec.name}: unknown column(s) {unknown}")
    return read_lake(spark, path, spec).select(*columns)
