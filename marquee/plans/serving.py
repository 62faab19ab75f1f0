"""Serving tables: typed, sorted, partitioned Spark catalog tables.

The lake is refreshed into one table per dataset (``CREATE TABLE ... USING
parquet PARTITIONED BY``). Each load conforms the lake rows to the
serving types, deals them by ranges of partition column and sort key, sorts
every task's rows by that key so file and row-group statistics allow
data skipping, and writes them in a distributed job.

A refresh writes new tables, ``titles__<version>`` and so on, and the database
property ``marquee.version`` names the version that counts. Setting it is one
catalog operation and the commit point of all five tables: ``read_table`` and
``validate_counts`` see every table of the old version or every table of the
new one. For SQL there is a view of each dataset's name. Views are switched one
by one before the commit and switched back when a step fails; after a process
died between two of them, ``repair_views`` (also the first step of the next
refresh) points them at the committed version. The version before the current
one keeps its tables for readers already under way.

All of this is Spark SQL and DataFrames: no file system is touched directly.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas as S
from marquee.functions import lenient_cast
from marquee.operators.sinks import layout_for_write
from marquee.plans.etl import in_turns, lake_path
from marquee.session import shuffles_released, warn_without_adaptive
from marquee.sources.lake import read_lake, read_version
from marquee.sources.manifest import new_version, read_state
from marquee.sources.tsv import path_exists

log = logging.getLogger(__name__)


def _spec(spec: S.ServingSpec | str) -> S.ServingSpec:
    return S.SERVING[spec] if isinstance(spec, str) else spec


def table_name(database: str, spec: S.ServingSpec | str, version: str | None = None) -> str:
    """The dataset's table of a version; without one the dataset's view (or a
    table created by hand under that name)."""
    name = _spec(spec).name
    return f"{database}.{name}__{version}" if version else f"{database}.{name}"


def create_table_sql(database: str, spec: S.ServingSpec | str, version: str | None = None) -> str:
    spec = _spec(spec)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
    partitions = ", ".join(f"`{c}`" for c in spec.partition_by)
    return (
        f"CREATE TABLE IF NOT EXISTS {table_name(database, spec, version)} ({columns}) "
        f"USING parquet PARTITIONED BY ({partitions})"
    )


def _run(spark: SparkSession, sql: str) -> DataFrame:
    """Every catalog statement goes through here."""
    return spark.sql(sql)


VERSION_PROPERTY = "marquee.version"
PREVIOUS_PROPERTY = "marquee.previous"


def _properties(spark: SparkSession, database: str) -> dict[str, str]:
    found = _run(spark, f"DESCRIBE DATABASE EXTENDED {database}").where("info_name = 'Properties'").collect()
    text = found[0]["info_value"] if found else ""
    return dict(re.findall(r"\((marquee\.\w+),(\w*)\)", text))


def current_version(spark: SparkSession, database: str) -> str | None:
    """The committed version of the database's serving tables."""
    return _properties(spark, database).get(VERSION_PROPERTY) or None


def _set_version(spark: SparkSession, database: str, version: str, previous: str | None) -> None:
    """The commit: both properties in one statement."""
    _run(spark, f"ALTER DATABASE {database} SET DBPROPERTIES "
                f"('{VERSION_PROPERTY}' = '{version}', '{PREVIOUS_PROPERTY}' = '{previous or ''}')")


def _tables_of(spark: SparkSession, database: str, version: str) -> list[str]:
    return [n for n in S.SERVING if spark.catalog.tableExists(table_name(database, n, version))]


def _show(spark: SparkSession, database: str, name: str, version: str) -> None:
    columns = ", ".join(f"`{c}`" for c in _spec(name).columns)
    _run(spark, f"CREATE OR REPLACE VIEW {table_name(database, name)} AS "
                f"SELECT {columns} FROM {table_name(database, name, version)}")


def repair_views(spark: SparkSession, database: str) -> None:
    """Point every dataset's view at the committed version."""
    version = current_version(spark, database)
    for name in _tables_of(spark, database, version) if version else ():
        _show(spark, database, name, version)


def _drop_version(spark: SparkSession, database: str, version: str) -> None:
    for name in S.SERVING:
        _run(spark, f"DROP TABLE IF EXISTS {table_name(database, name, version)}")


def _publish(spark: SparkSession, database: str, version: str) -> None:
    """Views, then the commit. A failing step puts the views back."""
    before = _properties(spark, database)
    old, oldest = before.get(VERSION_PROPERTY) or None, before.get(PREVIOUS_PROPERTY) or None
    try:
        for name in _tables_of(spark, database, version):
            _show(spark, database, name, version)
        _set_version(spark, database, version, old)
    except BaseException:
        if old:
            repair_views(spark, database)
        else:
            for name in S.SERVING:
                _run(spark, f"DROP VIEW IF EXISTS {table_name(database, name)}")
        raise
    if oldest:
        try:
            _drop_version(spark, database, oldest)
        except (AnalysisException, Py4JJavaError) as error:
            log.warning("%s: tables of version %s were not dropped (%s)", database, oldest, str(error).splitlines()[0])


def _create_database(spark: SparkSession, database: str, location: str | None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    _run(spark, f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_serving_tables(
    spark: SparkSession,
    database: str = S.SERVING_DATABASE,
    location: str | None = None,
    specs: Sequence[S.ServingSpec] = tuple(S.SERVING.values()),
) -> list[str]:
    """Create the database and, in its current version, every serving table
    that does not exist yet; return the names under which they can be read."""
    _create_database(spark, database, location)
    current = current_version(spark, database)
    version = current or new_version()
    for spec in specs:
        _run(spark, create_table_sql(database, spec, version))
        _show(spark, database, spec.name, version)
    if current is None:
        _set_version(spark, database, version, None)
    return [table_name(database, spec) for spec in specs]


OUT_OF_RANGE_PREFIX = "_out_of_range_"


def conform(df: DataFrame, spec: S.ServingSpec | str, with_flags: bool = False) -> DataFrame:
    """Lake rows -> serving types, in the table's column order.

    Text columns are non-null ('' for null; 'Unknown' for null or '' where the
    column is the partition key, which cannot hold ''). Numbers are cast
    leniently to the serving type, nulls of columns with a default take it.
    A value outside the unsigned range of its column is kept as it is and
    reported: with ``with_flags`` a boolean ``_out_of_range_<col>`` column per
    unsigned column marks it, so a load can count it.
    """
    spec = _spec(spec)
    exprs = []
    for f in spec.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            text = c.cast(T.StringType())
            if f.name in spec.partition_by:
                text = F.when(text != "", text)
                exprs.append(F.coalesce(text, F.lit(S.UNKNOWN)).alias(f.name))
            else:
                exprs.append(F.coalesce(text, F.lit("")).alias(f.name))
        else:
            cast = lenient_cast(c, f.dataType)
            if f.name in spec.numeric_defaults:
                cast = F.coalesce(cast, F.lit(spec.numeric_defaults[f.name]).cast(f.dataType))
            exprs.append(cast.alias(f.name))
    if with_flags:
        for c, top in spec.unsigned_max.items():
            exprs.append(_out_of_range(F.col(c), top).alias(OUT_OF_RANGE_PREFIX + c))
    return df.select(*exprs)


def _out_of_range(c: Column, top: int) -> Column:
    """True for a value that is no number in [0, top]; nulls are in range."""
    number = lenient_cast(c, T.LongType())
    return F.coalesce(c.isNotNull() & (number.isNull() | (number < 0) | (number > top)), F.lit(False))


class LoadCounts(dict):
    """Rows per dataset (None: not in the lake), with the values found out of
    range: ``out_of_range[dataset][column]`` holds every count above zero."""

    def __init__(self, stats: dict[str, dict[str, int] | None]):
        super().__init__({n: None if s is None else s["rows"] for n, s in stats.items()})
        suffix = "_out_of_range"
        self.out_of_range = {
            n: {k.removesuffix(suffix): v for k, v in s.items() if k.endswith(suffix) and v}
            for n, s in stats.items() if s is not None
        }


def _laid_out(df: DataFrame, spec: S.ServingSpec, observation: Observation) -> DataFrame:
    conformed = conform(df, spec, with_flags=True)
    flags = [c for c in conformed.columns if c.startswith(OUT_OF_RANGE_PREFIX)]
    metrics = [F.sum(F.col(c).cast("long")).alias(c[len(OUT_OF_RANGE_PREFIX):] + "_out_of_range") for c in flags]
    return layout_for_write(conformed, spec.partition_by, spec.sort_by, observation, metrics)


def load_table(
    spark: SparkSession, df: DataFrame, database: str, spec: S.ServingSpec | str, version: str | None = None
) -> dict[str, int]:
    """Append conformed, sorted rows to a serving table (of the current version).

    Returns ``{"rows": n, "<col>_out_of_range": k, ...}``, observed in the
    write stage of the same job.
    """
    spec = _spec(spec)
    table = table_name(database, spec, version or current_version(spark, database))
    observation = Observation(f"load_{spec.name}")
    # insertInto is positional: Spark stores partition columns last.
    _laid_out(df, spec, observation).select(*spark.table(table).columns).write.insertInto(table)
    return {k: int(v or 0) for k, v in observation.get.items()}


def _lake_datasets(spark: SparkSession, lake_dir: str) -> dict[str, DataFrame]:
    """The lake's datasets, all of one version (plain folders where the lake
    has no manifest). Raises without the required ones."""
    state, present = read_state(spark, lake_dir), {}
    for name, spec in S.LAKE.items():
        path = lake_path(lake_dir, name)
        if state is not None and name in state.datasets:
            present[name] = read_version(spark, lake_dir, state, name)
        elif state is None and path_exists(spark, path):
            present[name] = read_lake(spark, path, spec)  # raises without data files
        elif name in S.REQUIRED_SERVING:
            raise FileNotFoundError(f"serving refresh needs the {name} dataset; the lake has none at {path}")
    return present


def refresh_serving(
    spark: SparkSession,
    lake_dir: str,
    database: str = S.SERVING_DATABASE,
    location: str | None = None,
    concurrent: bool = True,
) -> LoadCounts:
    """Full refresh of every serving table from the lake.

    All datasets are read from one version of the lake and loaded into new
    tables, which become the database's at one commit point after the last load
    (see the module's text): a missing dataset, a failed load or a failed
    catalog statement leaves all five tables as they were. An absent optional
    dataset empties its table (row count None). The loads run as concurrent
    Spark jobs, those of the facts one after another; each job's shuffle files
    go when it ends.
    """
    present = _lake_datasets(spark, lake_dir)
    warn_without_adaptive(spark, log)
    _create_database(spark, database, location)
    repair_views(spark, database)
    version = new_version()

    def load(name: str) -> dict[str, int] | None:
        return load_table(spark, present[name], database, name, version) if name in present else None

    def load_all(names: Iterable[str]) -> dict[str, dict[str, int] | None]:
        return {name: load(name) for name in names}

    stats: dict[str, dict[str, int] | None] = {}
    try:
        for spec in S.SERVING.values():
            _run(spark, create_table_sql(database, spec, version))
        with shuffles_released(spark):
            if concurrent:
                turns = in_turns(S.SERVING)
                with ThreadPoolExecutor(max_workers=len(turns), thread_name_prefix="serve") as pool:
                    for future in [pool.submit(load_all, names) for names in turns]:
                        stats.update(future.result())
            else:
                stats.update(load_all(S.SERVING))
        _publish(spark, database, version)
    except BaseException:
        _drop_version(spark, database, version)
        raise
    counts = LoadCounts({name: stats[name] for name in S.SERVING})
    for name, found in counts.out_of_range.items():
        for column, n in found.items():
            log.warning("%s.%s: %s value(s) outside the serving range were kept", name, column, n)
    return counts


VALIDATION_SCHEMA = "dataset string, rows bigint, out_of_range bigint"


def validate_counts(
    spark: SparkSession,
    database: str = S.SERVING_DATABASE,
    names: Sequence[str] = S.DATASET_ORDER,
) -> DataFrame:
    """``(dataset, rows, out_of_range)`` per serving table, in the given order.

    ``out_of_range`` counts the values outside the unsigned range of their
    column. The tables are counted in one job, each from its footers and the
    ranged columns. A table that is missing or cannot be read has nulls ("not
    loaded"); the others are then counted one by one and still reported.
    """
    version = current_version(spark, database)
    found = _count_tables(spark, database, version, names)
    if found is None:
        found = {}
        for name in names:
            found.update(_count_tables(spark, database, version, [name]) or {})
    return spark.createDataFrame([(n, *found.get(n, (None, None))) for n in names], VALIDATION_SCHEMA)


def _count_tables(
    spark: SparkSession, database: str, version: str | None, names: Sequence[str]
) -> dict[str, tuple[int, int]] | None:
    out = None
    try:
        for name in names:
            bad = [F.sum(_out_of_range(F.col(c), top).cast("long")) for c, top in _spec(name).unsigned_max.items()]
            total = sum((F.coalesce(b, F.lit(0)) for b in bad), F.lit(0)).cast("long")
            part = spark.table(table_name(database, name, version)).agg(
                F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"), total.alias("out_of_range"))
            out = part if out is None else out.unionByName(part)
        return {} if out is None else {r["dataset"]: (r["rows"], r["out_of_range"]) for r in out.collect()}
    except (AnalysisException, SparkRuntimeException, Py4JJavaError) as error:
        log.warning("%s: %s not loaded (%s)", database, ", ".join(names), str(error).splitlines()[0])
        return None


def read_table(spark: SparkSession, database: str, spec: S.ServingSpec | str) -> DataFrame:
    """A serving table of the committed version, in its declared column order."""
    spec = _spec(spec)
    return spark.table(table_name(database, spec, current_version(spark, database))).select(*spec.columns)
