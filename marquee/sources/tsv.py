"""Raw catalogue files: tab-separated text with a header and ``\\N`` for null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

from marquee.schemas import RAW_COLUMNS, RAW_NULL_TOKEN

RAW_SUFFIXES = (".tsv", ".tsv.gz")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on the file system Spark resolves it on.

    Asks the Hadoop file system of the path (local, HDFS or object store)
    through the session's Hadoop configuration. Where no JVM gateway is at
    hand (Spark Connect), resolving a text source answers the same question
    without running a job.
    """
    jvm = getattr(spark, "_jvm", None)
    jsc = getattr(spark, "_jsc", None)
    if jvm is not None and jsc is not None:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(jsc.hadoopConfiguration()).exists(hpath))
    try:
        spark.read.format("text").load(path).schema  # resolves the path
        return True
    except AnalysisException as exc:
        condition = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass")
        if condition() == "PATH_NOT_FOUND":
            return False
        raise


def is_file(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is one file (assumed where no JVM is at hand)."""
    jvm, jsc = getattr(spark, "_jvm", None), getattr(spark, "_jsc", None)
    if jvm is None or jsc is None:
        return True
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(jsc.hadoopConfiguration()).getFileStatus(hpath).isFile())


def can_delete(spark: SparkSession) -> bool:
    """True when files can be removed from here: Spark offers no DataFrame
    source that deletes, so this takes the JVM (not Spark Connect)."""
    return getattr(spark, "_jvm", None) is not None and getattr(spark, "_jsc", None) is not None


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and all below it, if it exists (see ``can_delete``)."""
    if not can_delete(spark):
        raise RuntimeError(f"cannot delete {path}: the session has no JVM gateway")
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def resolve_raw_path(spark: SparkSession, raw_dir: str, base_name: str) -> str | None:
    """``<raw_dir>/<base_name>.tsv`` or ``.tsv.gz``; the first that exists wins."""
    for suffix in RAW_SUFFIXES:
        candidate = f"{raw_dir.rstrip('/')}/{base_name}{suffix}"
        if path_exists(spark, candidate):
            return candidate
    return None


def read_tsv_path(
    spark: SparkSession,
    path: str,
    required_columns: Iterable[str] = (),
    quote: str = "",
) -> DataFrame:
    """Scan one raw file (or a directory of parts) as all-string columns.

    No schema is passed: the CSV reader takes the column names from a
    header line and types every column as string, so a file with reordered or
    extra columns still binds by name. The parts of a directory must agree:
    every part's header is checked against those names, and a part with
    another order or other columns raises instead of being read by position. ``quote=""`` turns quote
    handling off, so a field starting with ``"`` cannot swallow the next tab
    and shift the row; pass ``quote='"'`` for the reader's default handling.
    A single ``.gz`` file is decompressed by one task; its rows are dealt
    anew right after the scan, so that cleaning and joins run in parallel.
    """
    df = (
        spark.read.option("header", True)
        .option("sep", "\t")
        .option("nullValue", RAW_NULL_TOKEN)
        .option("quote", quote)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    missing = [c for c in required_columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing required column(s) {missing}; found {df.columns}")
    return df.hint("rebalance") if path.endswith(".gz") and is_file(spark, path) else df


def read_tsv(
    spark: SparkSession,
    raw_dir: str,
    base_name: str,
    required: bool = True,
    quote: str = "",
) -> DataFrame | None:
    """Scan ``<raw_dir>/<base_name>.tsv[.gz]``.

    A missing required file raises ``FileNotFoundError``; a missing optional
    file returns ``None`` so that the datasets depending on it are skipped.
    """
    path = resolve_raw_path(spark, raw_dir, base_name)
    if path is None:
        if required:
            raise FileNotFoundError(
                f"raw input {base_name}: none of {[base_name + s for s in RAW_SUFFIXES]} exists under {raw_dir}"
            )
        return None
    return read_tsv_path(spark, path, RAW_COLUMNS.get(base_name, ()), quote=quote)


def read_raw_inputs(
    spark: SparkSession,
    raw_dir: str,
    required: Iterable[str],
    optional: Iterable[str],
    quote: str = "",
) -> dict[str, DataFrame | None]:
    """All raw inputs of the pipeline: required ones must exist."""
    inputs: dict[str, DataFrame | None] = {}
    for name in required:
        inputs[name] = read_tsv(spark, raw_dir, name, required=True, quote=quote)
    for name in optional:
        inputs[name] = read_tsv(spark, raw_dir, name, required=False, quote=quote)
    return inputs
