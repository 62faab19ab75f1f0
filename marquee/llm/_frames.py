"""DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.session import scratch_path

WORD_SPLIT = r"[\x20\x09-\x0D]+"
CHUNK_ROWS = 500


# Once a staged table is written nothing reads the shuffle files of its job
# again, so Spark may delete them when the job ends (lost tasks are retried
# while it runs; later jobs read the table).
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Rows and bytes of an Arrow batch for rows that carry whole token lists: Spark
# bounds batches by 10,000 rows otherwise, whatever their size.
WIDE_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def staged(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back. ``wide``: in
    Arrow batches of few rows.

    Cuts the lineage: the next jobs read files that every executor can see,
    so a lost executor costs only its running tasks.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    settings = {_SHUFFLE_CLEANUP: "true", **(WIDE_BATCH if wide else {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


ROW_KEY = "struct<file:bigint,row:bigint>"


def with_row_key(df: DataFrame, out: str, name: str) -> DataFrame:
    """``df`` with a key of type ROW_KEY, different for every row and the same
    at every evaluation: the file (a 64-bit hash of its path) and the row in it.

    A frame that is not a plain read of files is staged first, since rows of
    one file may have been repeated by then.
    """
    plan = df._jdf.queryExecution().analyzed().getClass().getSimpleName()
    rows = df if plan == "LogicalRelation" else staged(df, name)
    key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.select(*rows.columns, key.alias(out))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    For sessions started without it on PYTHONPATH; on a cluster whose nodes do
    not share that folder, ship the package with ``--py-files``.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (root, known.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_SPLIT)
    blanks = (
        F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
        + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    )
    return (F.size(parts) - blanks).cast("long")


def spread_chunk(key: Column, chunks: int) -> Column:
    """Chunk number 0..chunks-1 of an integer key by a multiplicative step.

    Plain integer arithmetic that DuckDB evaluates alike. Nulls go to chunk 0.
    """
    mixed = F.pmod(F.pmod(F.coalesce(key, F.lit(0)).cast("long"), F.lit(2147483647).cast("long")) * F.lit(48271).cast("long"), F.lit(2147483647).cast("long"))
    return F.pmod(mixed, F.lit(chunks).cast("long"))


def chunk_count(rows: int, chunk_rows: int = CHUNK_ROWS) -> int:
    return max(1, -(-rows // chunk_rows))


def with_offset(
    df: DataFrame, groups: list[str], weight: str, chunk: str, order: list[Column], out: str
) -> DataFrame:
    """Exclusive running sum of ``weight`` per group, in (chunk, order) order.

    No task holds a group: rows are windowed per (group, chunk) and the chunk
    totals, one small row per chunk, are windowed per group. ``order`` must
    order the rows of a chunk totally for a repeatable result.
    """
    totals = df.groupBy(*groups, chunk).agg(F.sum(weight).alias("_t"))
    before = W.partitionBy(*groups).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col(chunk).alias("_c"),
        F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"),
    )
    keys = [df[g].eqNullSafe(bases[f"_g{i}"]) for i, g in enumerate(groups)]
    joined = df.join(bases, [*keys, df[chunk] == bases["_c"]])
    inside = W.partitionBy(*groups, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return joined.withColumn(
        out, (F.col("_base") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).cast("long")
    ).drop("_base", "_c", *[f"_g{i}" for i in range(len(groups))])
