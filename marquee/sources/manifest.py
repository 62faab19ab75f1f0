"""Lake versions: the manifest that names what a lake holds now.

Every run of the pipeline writes its files into folders of its own,
``<lake>/versions/<version>/<dataset>``, and then appends one row to
``<lake>/manifest``. That row is the commit: it lists, for all datasets
together, the folders ("segments") a reader has to read. It is written by one
task into one file, which a committed Spark write makes visible as a whole, so
readers see all datasets of the version before or all of the version after.
Readers that resolved the older version keep reading its files, which stay
until the version is expired.

A segment holds each value of the partition columns either in a directory of
its own (``pooled=false/start_year=1994/...``) or, when the value has few rows,
together with other small values in shared files (``pooled=true/...``), where
the partition columns are ordinary columns (``key_start_year``). Values that a
later version replaced are listed as dropped and filtered out: pruned
directories on the one side, a row filter on the other.

A lake has one writer at a time; a commit whose base is no longer the newest
version is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import LAKE, LakeSpec
from marquee.sources.tsv import path_exists

MANIFEST_SCHEMA = "sequence bigint, version string, state string"
POOL_PREFIX = "key_"
POOLED = "pooled"


@dataclass(frozen=True)
class Segment:
    """One written folder of a dataset, relative to the lake.

    ``rows`` holds the live rows per partition value (see ``partition_key``),
    ``pooled`` the values that share files, ``dropped`` the values that are in
    the files but no longer live. ``plain`` marks a folder written without the
    ``pooled=`` level.
    """

    path: str
    rows: dict[str, int]
    pooled: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    files: int = 0
    bytes: int = 0
    plain: bool = False

    def without(self, keys: Iterable[str]) -> Segment:
        gone = set(keys) & set(self.rows)
        return replace(self, rows={k: n for k, n in self.rows.items() if k not in gone},
                       dropped=tuple(sorted({*self.dropped, *gone})))


@dataclass(frozen=True)
class LakeState:
    """What a committed version holds: segments per dataset."""

    sequence: int = 0
    version: str = ""
    datasets: dict[str, tuple[Segment, ...]] = field(default_factory=dict)

    def row_count(self, name: str) -> int:
        return sum(sum(s.rows.values()) for s in self.datasets.get(name, ()))


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def not_found(error: AnalysisException) -> bool:
    condition = getattr(error, "getCondition", None) or getattr(error, "getErrorClass")
    return condition() == "PATH_NOT_FOUND"


def _manifest_path(lake_dir: str) -> str:
    return f"{lake_dir.rstrip('/')}/manifest"


def read_history(spark: SparkSession, lake_dir: str) -> DataFrame | None:
    """All commits, ``(sequence, version, state)``; ``None`` without a manifest."""
    path = _manifest_path(lake_dir)
    if not path_exists(spark, path):
        return None
    return spark.read.schema(MANIFEST_SCHEMA).json(path).where("state IS NOT NULL")


def read_state(spark: SparkSession, lake_dir: str) -> LakeState | None:
    """The newest committed version, or ``None`` for a lake without one."""
    history = read_history(spark, lake_dir)
    if history is None:
        return None
    newest = history.agg(F.max(F.struct("sequence", "version", "state")).alias("row")).first()["row"]
    return None if newest is None else _parse(newest)


def _parse(row) -> LakeState:
    datasets = {
        name: tuple(Segment(**{**s, "pooled": tuple(s["pooled"]), "dropped": tuple(s["dropped"])}) for s in segments)
        for name, segments in json.loads(row["state"]).items()
    }
    return LakeState(row["sequence"], row["version"], datasets)


def commit(
    spark: SparkSession, lake_dir: str, version: str, datasets: dict[str, tuple[Segment, ...]], base: LakeState | None
) -> LakeState:
    """Make ``datasets`` the lake's content: the only step readers can see."""
    now = read_state(spark, lake_dir)
    if (now.sequence if now else 0) != (base.sequence if base else 0):
        raise RuntimeError(f"{lake_dir}: another run committed version {now.version if now else None} meanwhile")
    sequence = (base.sequence if base else 0) + 1
    state = json.dumps({name: [asdict(s) for s in segments] for name, segments in datasets.items()})
    row = spark.range(0, 1, 1, 1).select(
        F.lit(sequence).cast("bigint").alias("sequence"), F.lit(version).alias("version"), F.lit(state).alias("state"))
    row.write.mode("append").json(_manifest_path(lake_dir))
    return LakeState(sequence, version, dict(datasets))


def partition_key(spec: LakeSpec, prefix: str = "") -> Column:
    """A row's partition value as JSON text; '' counts as null, as in a directory name."""
    return F.to_json(F.array(*[F.nullif(F.col(prefix + c).cast("string"), F.lit("")) for c in spec.partition_by]))


def _direct(spark: SparkSession, root: str, segment: Segment, spec: LakeSpec) -> DataFrame:
    path = f"{root}/{segment.path}" + ("" if segment.plain else f"/{POOLED}=false")
    return spark.read.schema(spec.schema).option("basePath", path).parquet(path)


def _pool(spark: SparkSession, root: str, segment: Segment, spec: LakeSpec) -> DataFrame:
    fields = [T.StructField(POOL_PREFIX + f.name if f.name in spec.partition_by else f.name, f.dataType)
              for f in spec.schema.fields]
    return (
        spark.read.schema(T.StructType(fields)).option("recursiveFileLookup", True)
        .parquet(f"{root}/{segment.path}/{POOLED}=true")
    )


def read_segment(spark: SparkSession, lake_dir: str, segment: Segment, spec: LakeSpec) -> list[DataFrame]:
    """The live rows of a segment: at most one frame per kind of file.

    Dropped values of directories are a filter over partition columns alone
    (the directories are not read).
    """
    root, pooled, frames = lake_dir.rstrip("/"), set(segment.pooled), []
    if any(k not in pooled for k in segment.rows):
        df, dropped = _direct(spark, root, segment, spec), [k for k in segment.dropped if k not in pooled]
        frames.append((df.where(~partition_key(spec).isin(dropped)) if dropped else df).select(*spec.columns))
    if any(k in pooled for k in segment.rows):
        df, dropped = _pool(spark, root, segment, spec), [k for k in segment.dropped if k in pooled]
        df = df.where(~partition_key(spec, POOL_PREFIX).isin(dropped)) if dropped else df
        names = {POOL_PREFIX + c: c for c in spec.partition_by}
        frames.append(df.withColumnsRenamed(names).select(*spec.columns))
    return frames


def read_segments(
    spark: SparkSession, lake_dir: str, segments: Iterable[Segment], spec: LakeSpec
) -> DataFrame:
    frames = [df for s in segments for df in read_segment(spark, lake_dir, s, spec)]
    if not frames:
        return spark.createDataFrame([], spec.schema)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def measure(spark: SparkSession, lake_dir: str, path: str, spec: LakeSpec, plain: bool = False) -> Segment:
    """The segment written at ``path``: rows per partition value, files, bytes.

    One small row per partition value reaches the driver, as many as there are
    directories for Spark to list. Directories are counted from their footers
    (no column is read), shared files from their partition columns.
    """
    root = lake_dir.rstrip("/")
    if plain:
        df, key, shared = _direct(spark, root, Segment(path, {}, plain=True), spec), partition_key(spec), F.lit(False)
    else:
        fields = [T.StructField(POOL_PREFIX + c, spec.schema[c].dataType) for c in spec.partition_by]
        schema = T.StructType([*spec.schema.fields, *fields, T.StructField(POOLED, T.BooleanType())])
        df, shared = spark.read.schema(schema).parquet(f"{root}/{path}"), F.col(POOLED)
        key = F.when(shared, partition_key(spec, POOL_PREFIX)).otherwise(partition_key(spec))
    seen = df.select(shared.alias("shared"), key.alias("key"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_size").alias("size"))
    per_file = seen.groupBy("shared", "key", "file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    found = per_file.groupBy("shared", "key").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("size").alias("size")).collect()
    own = [r for r in found if not r["shared"]]
    files, size = sum(r["files"] for r in own), sum(r["size"] for r in own)
    pooled = tuple(sorted(r["key"] for r in found if r["shared"]))
    if pooled:
        # shared files hold many values: each is counted once
        sizes = per_file.where("shared").groupBy("file").agg(F.max("size").alias("size"))
        total = sizes.agg(F.count("*").alias("files"), F.sum("size").alias("size")).first()
        files, size = files + total["files"], size + total["size"]
    return Segment(path, {r["key"]: r["rows"] for r in found}, pooled, (), files, size, plain)


def file_report(spark: SparkSession, lake_dir: str) -> DataFrame:
    """``(dataset, segments, partition_values, files, bytes, rows)`` of the lake."""
    state = read_state(spark, lake_dir) or LakeState()
    out = [
        (name, len(segs), len({k for s in segs for k in s.rows}), sum(s.files for s in segs),
         sum(s.bytes for s in segs), state.row_count(name))
        for name, segs in ((n, state.datasets[n]) for n in LAKE if n in state.datasets)
    ]
    return spark.createDataFrame(
        out, "dataset string, segments int, partition_values int, files int, bytes bigint, rows bigint")
