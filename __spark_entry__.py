"""

The library works on catalogue data (raw TSV -> lake -> serving). Here the
driver's tables are bound to it: each raw input is a projection of a whole
driver table into the raw catalogue shape (all strings, raw column names),
and every registered query runs the real builders, writers and reports on
it. The projections are written once as SQL expressions, used by Spark's
``selectExpr`` and by the DuckDB oracle alike; the oracle then restates
each *operator* (cleaning, joins, defaults, aggregates) in plain SQL.

Bindings (driver table -> raw input):

- title.basics     <- part       (p_type is the title type)
- title.ratings    <- part       (MEDIUM parts' ratings match no title)
- title.episode    <- lineitem   (episode = part, parent = part with the
                                  supplier's key; ECONOMY parts are series)
- name.basics      <- supplier
- title.akas       <- customer
- title.principals <- lineitem   (credit of supplier on part)

Titles shaped directly from ``orders`` (status = type, order year = start
year) feed the decade, popularity and lake layout queries; ``lineitem``
joined with ``part`` feeds the runtime median report.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

# The package lives next to this file; make it importable however this
# module is loaded (by name or from its path).
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marquee import schemas as S  # noqa: E402
from marquee.operators import (  # noqa: E402
    avg_rating_by_type,
    build_akas,
    build_episodes,
    build_episodes_from_basics,
    build_names,
    build_principals,
    build_titles,
    clean_basics,
    genre_popularity,
    runtime_by_genre,
    top_people_in_categories,
    top_people_typed,
    top_rated_by_decade,
    top_regions,
    top_series_by_episode_count,
    write_counted,
    write_partitioned,
)
from marquee.operators.sinks import layout_for_write  # noqa: E402
from marquee.plans import conform, counts_frame, read_table, refresh_serving, run_etl, write_lake  # noqa: E402
from marquee.plans.etl import lake_path  # noqa: E402
from marquee.session import scratch_path  # noqa: E402
from marquee.sources import lake_project, read_lake, read_tsv  # noqa: E402

# The text operators and their pipeline are an optional part of the library.
try:
    import corpus_pipeline
    from marquee.llm.queries import ORACLE_SQL as _LLM_ORACLE
    from marquee.llm.queries import QUERIES as _LLM_QUERIES
except ImportError as _error:
    if not (_error.name or "").startswith(("marquee.llm", "corpus_pipeline")):
        raise
    _LLM_QUERIES, _LLM_ORACLE = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLE = {**_LLM_ORACLE, "pipeline": corpus_pipeline.ORACLE_SQL}

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the bindings (test-table values standing in for catalogue ones).
SERIES_TYPE = "ECONOMY"        # parent title type matched by the episode join
EPISODE_TYPE = "PROMO"         # title type taken by the episode fallback
MOVIE_TYPE = "F"               # order status standing in for 'movie'
MIN_VOTES = 100                # votes threshold of the decade report
AS_OF_YEAR = 2001              # the order dates span 1995-2001
LOOKBACK_YEARS = 2
RUNTIME_TYPE = "ECONOMY"       # part type standing in for 'movie' in the median report
MIN_GROUP = 100
SERVING_MIN_GROUP = 1          # the serving titles have few titles per genre
SERVING_MOVIE_TYPE = "ECONOMY" # part-shaped serving titles: a title type with ratings
SERVING_LOOKBACK_YEARS = 20    # their start years span 1951-2000
ACTOR_CATEGORIES = ("actor", "actress")
DIRECTOR = "director"

# --------------------------------------------------------------------------
# Raw projections: name -> expression, valid in Spark SQL and in DuckDB.
# --------------------------------------------------------------------------

BASICS_FROM_PART = {
    "tconst": "CAST(p_partkey AS STRING)",
    "titleType": "p_type",
    "primaryTitle": "p_name",
    "originalTitle": "upper(p_name)",
    "isAdult": "CASE WHEN p_size <= 2 THEN NULL WHEN p_size <= 4 THEN 'yes' "
               "WHEN p_size <= 6 THEN '1' ELSE '0' END",
    "startYear": "CASE WHEN p_type = 'LARGE' AND p_size > 40 THEN p_name "
                 "ELSE CAST(1950 + p_size AS STRING) END",
    "endYear": "CASE WHEN p_size > 25 THEN NULL ELSE CAST(2000 + p_size AS STRING) END",
    "runtimeMinutes": "CASE WHEN p_brand = 'Brand#1' THEN 'n/a' "
                      "ELSE replace(p_brand, 'Brand#', '') END",
    "genres": "CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_type = 'PROMO' AND p_size > 25 "
              "THEN '' ELSE replace(p_name, ' ', ',') END",
}
# MEDIUM parts get a key no title has: titles without a rating and ratings
# without a title, over the whole table.
RATINGS_FROM_PART = {
    "tconst": "CASE WHEN p_type = 'MEDIUM' THEN 'r' || CAST(p_partkey AS STRING) "
              "ELSE CAST(p_partkey AS STRING) END",
    "averageRating": "CAST(p_retailprice / 100 AS STRING)",
    "numVotes": "CAST(p_size * 1000 AS STRING)",
}
EPISODE_FROM_LINEITEM = {
    "tconst": "CAST(l_partkey AS STRING)",
    "parentTconst": "CAST(l_suppkey AS STRING)",
    "seasonNumber": "CAST(l_linenumber AS STRING)",
    "episodeNumber": "CASE WHEN l_returnflag = 'N' THEN NULL "
                     "ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) END",
}
NAMES_FROM_SUPPLIER = {
    "nconst": "CAST(s_suppkey AS STRING)",
    "primaryName": "s_name",
    "birthYear": "CAST(1900 + s_nationkey AS STRING)",
    "deathYear": "CASE WHEN s_acctbal < 0 THEN CAST(2000 + s_nationkey AS STRING) END",
    "primaryProfession": "CASE WHEN s_nationkey < 3 THEN NULL WHEN s_nationkey < 5 THEN '' "
                         "ELSE 'role' || CAST(s_nationkey % 4 AS STRING) || ',writer' END",
    "knownForTitles": "CAST(s_suppkey AS STRING)",
}
AKAS_FROM_CUSTOMER = {
    "titleId": "CAST(c_nationkey AS STRING)",
    "ordering": "CAST(c_custkey AS STRING)",
    "title": "c_name",
    "region": "CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN chr(92) || 'N' "
              "ELSE lpad(CAST(c_nationkey AS STRING), 2, '0') END",
    "language": "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL "
                "WHEN c_acctbal < 0 THEN chr(92) || 'N' ELSE lower(c_mktsegment) END",
    "types": "c_mktsegment",
    "isOriginalTitle": "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '1' ELSE '0' END",
}
PRINCIPALS_FROM_LINEITEM = {
    "tconst": "CAST(l_partkey AS STRING)",
    "ordering": "CAST(l_linenumber AS STRING)",
    "nconst": "CAST(l_suppkey AS STRING)",
    "category": "CASE WHEN l_returnflag = 'A' THEN 'actor' "
                "WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'actress' "
                "WHEN l_returnflag = 'R' THEN 'director' END",
    "job": "CASE WHEN l_linestatus = 'F' THEN NULL ELSE 'job ' || l_linestatus END",
    "characters": "CAST(l_orderkey AS STRING)",
}
# Lake-shaped titles straight from orders.
TITLES_FROM_ORDERS = {
    "tconst": "CAST(o_orderkey AS STRING)",
    "title_type": "o_orderstatus",
    "primary_title": "'Order ' || CAST(o_orderkey AS STRING)",
    "original_title": "o_orderpriority",
    "start_year": "CAST(year(o_orderdate) AS INT)",
    "end_year": "CAST(month(o_orderdate) AS INT)",
    "runtime_minutes": "CAST(floor(o_totalprice / 1000) AS INT)",
    "genres": "o_orderpriority",
    "primary_genre": "substr(o_orderpriority, 3)",
    "average_rating": "CAST(o_totalprice / 50000 AS FLOAT)",
    "num_votes": "o_custkey",
}
# Titles-shaped rows of lineitem x part for the runtime report.
RUNTIME_FROM_LINEITEM_PART = {
    "title_type": "p_type",
    "primary_genre": "p_brand",
    "runtime_minutes": "CAST(floor(l_quantity) AS INT)",
}


# The same with a wide 64-bit value in place of minutes.
WIDE_RUNTIME = "CAST(l_orderkey * 1048576 + l_partkey * 64 + l_linenumber AS BIGINT)"


def _select_list(exprs: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in exprs.items()]


def _sql_proj(exprs: dict[str, str], source: str, where: str | None = None) -> str:
    sql = f"SELECT {', '.join(_select_list(exprs))} FROM {source}"
    return sql + (f" WHERE {where}" if where else "")


# --------------------------------------------------------------------------
# Spark side of the bindings
# --------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = _table(spark, sf_dir, "part")
    lineitem = _table(spark, sf_dir, "lineitem")
    return {
        S.RAW_BASICS: part.selectExpr(*_select_list(BASICS_FROM_PART)),
        S.RAW_RATINGS: part.selectExpr(*_select_list(RATINGS_FROM_PART)),
        S.RAW_EPISODE: lineitem.selectExpr(*_select_list(EPISODE_FROM_LINEITEM)),
        S.RAW_NAMES: _table(spark, sf_dir, "supplier").selectExpr(*_select_list(NAMES_FROM_SUPPLIER)),
        S.RAW_AKAS: _table(spark, sf_dir, "customer").selectExpr(*_select_list(AKAS_FROM_CUSTOMER)),
        S.RAW_PRINCIPALS: lineitem.selectExpr(*_select_list(PRINCIPALS_FROM_LINEITEM)),
    }


def _titles(spark, sf_dir) -> DataFrame:
    raw = raw_inputs(spark, sf_dir)
    return build_titles(clean_basics(raw[S.RAW_BASICS]), raw[S.RAW_RATINGS])


def _episodes(spark, sf_dir) -> DataFrame:
    raw = raw_inputs(spark, sf_dir)
    return build_episodes(raw[S.RAW_EPISODE], _titles(spark, sf_dir), series_type=SERIES_TYPE)


def _names(spark, sf_dir) -> DataFrame:
    return build_names(raw_inputs(spark, sf_dir)[S.RAW_NAMES])


def _akas(spark, sf_dir) -> DataFrame:
    return build_akas(raw_inputs(spark, sf_dir)[S.RAW_AKAS])


def _principals(spark, sf_dir) -> DataFrame:
    raw = raw_inputs(spark, sf_dir)
    return build_principals(raw[S.RAW_PRINCIPALS], _names(spark, sf_dir), _titles(spark, sf_dir))


def orders_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*_select_list(TITLES_FROM_ORDERS))


def runtime_titles(spark: SparkSession, sf_dir: str, runtime: str | None = None) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    part = _table(spark, sf_dir, "part")
    joined = lineitem.join(part, lineitem.l_partkey == part.p_partkey, "inner")
    exprs = dict(RUNTIME_FROM_LINEITEM_PART)
    if runtime:
        exprs["runtime_minutes"] = runtime
    return joined.selectExpr(*_select_list(exprs))


# Lakes written by the layout queries, built once per session and input.
_LAKES: dict[tuple, str] = {}


def _session_key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    # spark.app.id is set in classic and Spark Connect sessions alike
    return (spark.conf.get("spark.app.id", None) or id(spark), sf_dir, what)


def orders_lake(spark: SparkSession, sf_dir: str) -> str:
    """Orders-shaped titles written as a (start_year, title_type) lake."""
    key = _session_key(spark, sf_dir, "orders_lake")
    if key not in _LAKES:
        path = scratch_path(spark, "orders-titles-lake")
        write_partitioned(orders_titles(spark, sf_dir), path, S.TITLES.partition_by)
        _LAKES[key] = path
    return _LAKES[key]


def etl_lake(
    spark: SparkSession, sf_dir: str, with_all: bool = True, mode: str = "static"
) -> tuple[str, dict]:
    """Run the whole pipeline on the bound raw inputs into a fresh lake.

    ``with_all=False`` runs it with title.basics only (no ratings, episodes,
    names, akas or principals): titles without ratings and the episode
    fallback.
    """
    key = _session_key(spark, sf_dir, f"etl_lake_{with_all}_{mode}")
    if key not in _LAKES:
        raw = raw_inputs(spark, sf_dir)
        if not with_all:
            raw = {S.RAW_BASICS: raw[S.RAW_BASICS]}
        path = scratch_path(spark, "etl-lake")
        counts = run_etl(spark, raw, path, mode=mode, series_type=SERIES_TYPE, episode_type=EPISODE_TYPE)
        _LAKES[key] = (path, counts)
    return _LAKES[key]


def serving_db(spark: SparkSession, sf_dir: str) -> str:
    """A serving database refreshed twice: from the full lake, then from a
    lake built from title.basics alone."""
    key = _session_key(spark, sf_dir, "serving_db")
    if key not in _LAKES:
        database = f"marquee_{uuid.uuid4().hex[:10]}"
        location = scratch_path(spark, "serving")
        full_lake, _ = etl_lake(spark, sf_dir, with_all=True)
        refresh_serving(spark, full_lake, database, location)
        basics_lake, _ = etl_lake(spark, sf_dir, with_all=False)
        refresh_serving(spark, basics_lake, database, location)
        _LAKES[key] = database
    return _LAKES[key]


def full_serving_db(spark: SparkSession, sf_dir: str) -> str:
    """A serving database refreshed once, from the full lake."""
    key = _session_key(spark, sf_dir, "full_serving_db")
    if key not in _LAKES:
        database = f"marquee_{uuid.uuid4().hex[:10]}"
        full_lake, _ = etl_lake(spark, sf_dir, with_all=True)
        refresh_serving(spark, full_lake, database, scratch_path(spark, "serving-full"))
        _LAKES[key] = database
    return _LAKES[key]


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------


def q_clean_basics(spark, sf_dir):
    return clean_basics(raw_inputs(spark, sf_dir)[S.RAW_BASICS])


def q_titles_with_ratings(spark, sf_dir):
    return _titles(spark, sf_dir)


def q_titles_without_ratings(spark, sf_dir):
    return build_titles(clean_basics(raw_inputs(spark, sf_dir)[S.RAW_BASICS]), None)


def q_episodes_two_level(spark, sf_dir):
    return _episodes(spark, sf_dir)


def q_episodes_fallback(spark, sf_dir):
    return build_episodes_from_basics(_titles(spark, sf_dir), episode_type=EPISODE_TYPE)


def q_names_first_token(spark, sf_dir):
    return _names(spark, sf_dir)


def q_akas_defaults(spark, sf_dir):
    return _akas(spark, sf_dir)


def q_bridge_enriched(spark, sf_dir):
    return _principals(spark, sf_dir)


def q_top_rated_by_decade(spark, sf_dir):
    return top_rated_by_decade(orders_titles(spark, sf_dir), MOVIE_TYPE, MIN_VOTES)


def q_avg_by_type(spark, sf_dir):
    return avg_rating_by_type(_titles(spark, sf_dir))


def q_top_parents_by_child_count(spark, sf_dir):
    return top_series_by_episode_count(_episodes(spark, sf_dir))


def q_recent_popularity(spark, sf_dir):
    return genre_popularity(orders_titles(spark, sf_dir), AS_OF_YEAR, LOOKBACK_YEARS)


def q_runtime_by_group(spark, sf_dir):
    return runtime_by_genre(runtime_titles(spark, sf_dir), RUNTIME_TYPE, MIN_GROUP)


def q_runtime_by_group_percentile(spark, sf_dir):
    return runtime_by_genre(runtime_titles(spark, sf_dir), RUNTIME_TYPE, MIN_GROUP,
                            median="percentile")


def q_runtime_by_group_bounded(spark, sf_dir):
    """J5 by radix select over a 64-bit value with about one distinct value a row."""
    titles = runtime_titles(spark, sf_dir, WIDE_RUNTIME)
    return runtime_by_genre(titles, RUNTIME_TYPE, MIN_GROUP, median="bounded")


def q_runtime_by_group_approx(spark, sf_dir):
    return runtime_by_genre(runtime_titles(spark, sf_dir), RUNTIME_TYPE, MIN_GROUP, median="approx")


def q_top_people_in_categories(spark, sf_dir):
    return top_people_in_categories(_principals(spark, sf_dir), ACTOR_CATEGORIES)


def q_top_regions(spark, sf_dir):
    return top_regions(_akas(spark, sf_dir))


def q_top_people_typed(spark, sf_dir):
    return top_people_typed(_principals(spark, sf_dir), DIRECTOR, SERIES_TYPE)


SCAN_TSV_NULLED = "c_mktsegment"


def q_scan_tsv(spark, sf_dir):
    """Whole customer table written as gzip TSV (header, \\N nulls), read
    back through the raw reader and cast back leniently."""
    customer = _table(spark, sf_dir, "customer").withColumn(
        SCAN_TSV_NULLED, F.expr(f"nullif({SCAN_TSV_NULLED}, 'BUILDING')")
    )
    raw_dir = scratch_path(spark, "raw")
    (
        customer.write.option("header", True)
        .option("sep", "\t")
        .option("nullValue", S.RAW_NULL_TOKEN)
        .option("compression", "gzip")
        .csv(f"{raw_dir}/customer.tsv.gz")
    )
    raw = read_tsv(spark, raw_dir, "customer")
    return raw.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
        F.col("c_acctbal").try_cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


def q_lake_roundtrip(spark, sf_dir):
    return read_lake(spark, orders_lake(spark, sf_dir), S.TITLES)


def q_scan_lake(spark, sf_dir):
    lake = read_lake(spark, orders_lake(spark, sf_dir), S.TITLES)
    return genre_popularity(lake, AS_OF_YEAR, LOOKBACK_YEARS)


LAKE_PROJECTION = ["tconst", "start_year", "title_type", "average_rating"]


def q_lake_project(spark, sf_dir):
    return lake_project(spark, orders_lake(spark, sf_dir), S.TITLES, LAKE_PROJECTION)


OVERWRITE_FROM_YEAR = 2000


def q_partition_overwrite(spark, sf_dir):
    """Full write, then a dynamic overwrite of the (year >= 2000, 'F')
    partitions with runtime + 1; the other partitions must stay."""
    path = scratch_path(spark, "overwrite-lake")
    titles = orders_titles(spark, sf_dir)
    write_partitioned(titles, path, S.TITLES.partition_by, mode="static")
    changed = titles.filter(
        (F.col("title_type") == MOVIE_TYPE) & (F.col("start_year") >= OVERWRITE_FROM_YEAR)
    ).withColumn("runtime_minutes", F.col("runtime_minutes") + 1)
    write_partitioned(changed, path, S.TITLES.partition_by, mode="dynamic")
    return read_lake(spark, path, S.TITLES)


UPDATE_YEARS_BACK = 3


def q_lake_moved_rows(spark, sf_dir):
    """A lake of all orders titles, then an update with the (year >= 2000, 'F')
    titles, runtime + 1, a third of which now carry an earlier year: the
    partitions of the update are replaced, and titles that moved into them
    leave the partition they were in."""
    lake = scratch_path(spark, "moved-lake")
    titles = orders_titles(spark, sf_dir)
    write_lake(spark, lake, {"titles": titles})
    changed = titles.filter(
        (F.col("title_type") == MOVIE_TYPE) & (F.col("start_year") >= OVERWRITE_FROM_YEAR)
    ).withColumns({
        "runtime_minutes": F.col("runtime_minutes") + 1,
        "title_type": F.when(F.col("tconst").cast("long") % 3 == 0, F.lit("moved")).otherwise(F.col("title_type")),
        "start_year": F.when(F.col("tconst").cast("long") % 3 == 0, F.col("start_year") - UPDATE_YEARS_BACK)
        .otherwise(F.col("start_year")),
    }).filter("start_year <> 2001")
    write_lake(spark, lake, {"titles": changed}, mode="dynamic", pool_rows=MOVED_POOL_ROWS)
    return read_lake(spark, lake_path(lake, "titles"), S.TITLES)


MOVED_POOL_ROWS = 500  # the update has both small and large partition values


def q_guarded_write_count(spark, sf_dir):
    titles = orders_titles(spark, sf_dir)
    empty = titles.filter(F.col("title_type") == "no such type")
    counts = {
        "titles": write_counted(titles, scratch_path(spark, "guarded"), S.TITLES.partition_by),
        "empty": write_counted(empty, scratch_path(spark, "guarded"), S.TITLES.partition_by),
    }
    return counts_frame(spark, counts)


def q_etl_counts(spark, sf_dir):
    _, counts = etl_lake(spark, sf_dir, with_all=True)
    return counts_frame(spark, counts)


def q_conform_schema(spark, sf_dir):
    return conform(_akas(spark, sf_dir), "akas")


# Values outside the serving ranges (and nulls) over the whole customer table.
OUT_OF_RANGE_REGION = "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END"
OUT_OF_RANGE_ORDERING = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey * 100 - 2000 END"
OUT_OF_RANGE_FLAG = "CAST(c_custkey % 400 - 20 AS INT)"


def q_conform_out_of_range(spark, sf_dir):
    """Conformed akas rows whose numbers leave the unsigned ranges: the values
    are kept, the flags count them."""
    akas = _table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS title_id", f"CAST({OUT_OF_RANGE_ORDERING} AS INT) AS ordering",
        "c_name AS title", f"{OUT_OF_RANGE_REGION} AS region", "'' AS language", "'' AS types",
        f"{OUT_OF_RANGE_FLAG} AS is_original_title")
    flagged = conform(akas, "akas", with_flags=True)
    return flagged.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("ordering").alias("ordering_sum"),
        F.sum(F.col("_out_of_range_ordering").cast("long")).alias("ordering_out_of_range"),
        F.sum(F.col("_out_of_range_is_original_title").cast("long")).alias("flag_out_of_range"))


def _lake_dataset(name: str, mode: str = "static"):
    def query(spark, sf_dir):
        lake, _ = etl_lake(spark, sf_dir, mode=mode)
        return read_lake(spark, lake_path(lake, name), name)

    return query


def _serving_dataset(name: str):
    return lambda spark, sf_dir: read_table(spark, full_serving_db(spark, sf_dir), name)


def q_sorted_layout(spark, sf_dir):
    """Serving layout of the orders titles written to files and read back."""
    spec = S.SERVING["titles"]
    path = scratch_path(spark, "sorted-layout")
    laid_out = layout_for_write(conform(orders_titles(spark, sf_dir), spec),
                                spec.partition_by, spec.sort_by)
    laid_out.write.mode("overwrite").partitionBy(*spec.partition_by).parquet(path)
    return spark.read.schema(spec.schema).parquet(path).select(*spec.columns)


def q_serving_refresh(spark, sf_dir):
    return read_table(spark, serving_db(spark, sf_dir), "titles")


def _serving(spark, sf_dir, name):
    return read_table(spark, full_serving_db(spark, sf_dir), name)


def q_serving_top_rated_by_decade(spark, sf_dir):
    return top_rated_by_decade(_serving(spark, sf_dir, "titles"), SERVING_MOVIE_TYPE, MIN_VOTES)


def q_serving_avg_by_type(spark, sf_dir):
    return avg_rating_by_type(_serving(spark, sf_dir, "titles"))


def q_serving_recent_popularity(spark, sf_dir):
    return genre_popularity(_serving(spark, sf_dir, "titles"), AS_OF_YEAR, SERVING_LOOKBACK_YEARS)


def q_serving_top_people_in_categories(spark, sf_dir):
    return top_people_in_categories(_serving(spark, sf_dir, "principals"), ACTOR_CATEGORIES)


def q_serving_top_regions(spark, sf_dir):
    return top_regions(_serving(spark, sf_dir, "akas"))


def q_serving_top_parents_by_child_count(spark, sf_dir):
    """J3 over the serving episodes table (the reference's SQL side)."""
    return top_series_by_episode_count(read_table(spark, full_serving_db(spark, sf_dir), "episodes"))


def q_serving_top_people_typed(spark, sf_dir):
    """J8 over the serving principals table: a missing name is '' there."""
    return top_people_typed(read_table(spark, full_serving_db(spark, sf_dir), "principals"),
                            DIRECTOR, SERIES_TYPE)


def q_serving_runtime_by_group(spark, sf_dir):
    """J5 over the serving titles table, whose runtime
    column has the 64-bit serving type."""
    return runtime_by_genre(read_table(spark, full_serving_db(spark, sf_dir), "titles"),
                            RUNTIME_TYPE, SERVING_MIN_GROUP)


def q_validate_counts(spark, sf_dir):
    from marquee.plans import validate_counts

    return validate_counts(spark, serving_db(spark, sf_dir))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_basics": q_clean_basics,
    "titles_with_ratings": q_titles_with_ratings,
    "titles_without_ratings": q_titles_without_ratings,
    "episodes_two_level": q_episodes_two_level,
    "episodes_fallback": q_episodes_fallback,
    "names_first_token": q_names_first_token,
    "akas_defaults": q_akas_defaults,
    "bridge_enriched": q_bridge_enriched,
    "top_rated_by_decade": q_top_rated_by_decade,
    "avg_by_type": q_avg_by_type,
    "top_parents_by_child_count": q_top_parents_by_child_count,
    "recent_popularity": q_recent_popularity,
    "runtime_by_group": q_runtime_by_group,
    "runtime_by_group_percentile": q_runtime_by_group_percentile,
    "runtime_by_group_bounded": q_runtime_by_group_bounded,
    "runtime_by_group_approx": q_runtime_by_group_approx,
    "top_people_in_categories": q_top_people_in_categories,
    "top_regions": q_top_regions,
    "top_people_typed": q_top_people_typed,
    "scan_tsv": q_scan_tsv,
    "lake_roundtrip": q_lake_roundtrip,
    "scan_lake": q_scan_lake,
    "lake_project": q_lake_project,
    "partition_overwrite": q_partition_overwrite,
    "lake_moved_rows": q_lake_moved_rows,
    "guarded_write_count": q_guarded_write_count,
    "etl_counts": q_etl_counts,
    "conform_schema": q_conform_schema,
    "conform_out_of_range": q_conform_out_of_range,
    "lake_episodes": _lake_dataset("episodes"),
    "lake_names": _lake_dataset("names"),
    "lake_principals": _lake_dataset("principals"),
    "lake_principals_dynamic": _lake_dataset("principals", "dynamic"),
    "serving_episodes": _serving_dataset("episodes"),
    "serving_names": _serving_dataset("names"),
    "serving_akas": _serving_dataset("akas"),
    "serving_principals": _serving_dataset("principals"),
    "sorted_layout": q_sorted_layout,
    "serving_refresh": q_serving_refresh,
    "validate_counts": q_validate_counts,
    "serving_top_rated_by_decade": q_serving_top_rated_by_decade,
    "serving_avg_by_type": q_serving_avg_by_type,
    "serving_top_parents_by_child_count": q_serving_top_parents_by_child_count,
    "serving_recent_popularity": q_serving_recent_popularity,
    "serving_runtime_by_group": q_serving_runtime_by_group,
    "serving_top_people_in_categories": q_serving_top_people_in_categories,
    "serving_top_regions": q_serving_top_regions,
    "serving_top_people_typed": q_serving_top_people_typed,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: average rating by title type over titles built by the
    pipeline (raw basics cleaned, left-joined with ratings) on sf0.001."""
    return q_avg_by_type(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB): the same raw projections, operators restated in SQL.
# --------------------------------------------------------------------------


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final


def _first_token_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'Unknown' ELSE split_part({c}, ',', 1) END"


RAW_BASICS_CTE = ("raw_basics", _sql_proj(BASICS_FROM_PART, "part"))
RAW_RATINGS_CTE = ("raw_ratings", _sql_proj(RATINGS_FROM_PART, "part"))
RAW_EPISODE_CTE = ("raw_episode", _sql_proj(EPISODE_FROM_LINEITEM, "lineitem"))
RAW_NAMES_CTE = ("raw_names", _sql_proj(NAMES_FROM_SUPPLIER, "supplier"))
RAW_AKAS_CTE = ("raw_akas", _sql_proj(AKAS_FROM_CUSTOMER, "customer"))
RAW_PRINCIPALS_CTE = ("raw_principals", _sql_proj(PRINCIPALS_FROM_LINEITEM, "lineitem"))

BASICS_CTE = ("basics", f"""
SELECT tconst, titleType AS title_type, primaryTitle AS primary_title,
       originalTitle AS original_title,
       coalesce(try_cast(startYear AS INTEGER), 0) AS start_year,
       try_cast(endYear AS INTEGER) AS end_year,
       try_cast(runtimeMinutes AS INTEGER) AS runtime_minutes,
       genres, {_first_token_sql('genres')} AS primary_genre
FROM raw_basics WHERE isAdult = '0'""")

TITLE_BASE_COLS = ("tconst, title_type, primary_title, original_title, start_year, "
                   "end_year, runtime_minutes, genres, primary_genre")

TITLES_CTE = ("titles", f"""
SELECT b.tconst, b.title_type, b.primary_title, b.original_title, b.start_year,
       b.end_year, b.runtime_minutes, b.genres, b.primary_genre,
       try_cast(r.averageRating AS FLOAT) AS average_rating,
       try_cast(r.numVotes AS BIGINT) AS num_votes
FROM basics b LEFT JOIN raw_ratings r ON b.tconst = r.tconst""")

TITLES_NO_RATINGS_SQL = (f"SELECT {TITLE_BASE_COLS}, CAST(NULL AS FLOAT) AS average_rating, "
                         "CAST(NULL AS BIGINT) AS num_votes FROM basics")

EPISODES_CTE = ("episodes", f"""
SELECT e.tconst AS episode_tconst, e.parentTconst AS parent_tconst,
       try_cast(e.seasonNumber AS INTEGER) AS season_number,
       try_cast(e.episodeNumber AS INTEGER) AS episode_number,
       t.primary_title AS episode_title, s.primary_title AS series_title,
       coalesce(t.start_year, 0) AS start_year,
       coalesce(s.primary_genre, 'Unknown') AS primary_genre,
       t.average_rating, t.num_votes, t.runtime_minutes
FROM raw_episode e
LEFT JOIN titles t ON e.tconst = t.tconst
LEFT JOIN (SELECT * FROM titles WHERE title_type = '{SERIES_TYPE}') s
       ON e.parentTconst = s.tconst""")

EPISODES_FALLBACK_SQL = f"""
SELECT tconst AS episode_tconst, CAST(NULL AS VARCHAR) AS parent_tconst,
       CAST(NULL AS INTEGER) AS season_number, CAST(NULL AS INTEGER) AS episode_number,
       primary_title AS episode_title, CAST(NULL AS VARCHAR) AS series_title,
       start_year, primary_genre, average_rating, num_votes, runtime_minutes
FROM titles WHERE title_type = '{EPISODE_TYPE}'"""

NAMES_CTE = ("names", f"""
SELECT nconst, primaryName AS primary_name,
       try_cast(birthYear AS INTEGER) AS birth_year,
       try_cast(deathYear AS INTEGER) AS death_year,
       primaryProfession AS primary_profession,
       {_first_token_sql('primaryProfession')} AS primary_role,
       knownForTitles AS known_for_titles
FROM raw_names""")

AKAS_CTE = ("akas", """
SELECT titleId AS title_id, try_cast(ordering AS INTEGER) AS ordering, title,
       CASE WHEN region IS NULL OR region = chr(92) || 'N' THEN 'Unknown' ELSE region END AS region,
       CASE WHEN language IS NULL OR language = chr(92) || 'N' THEN 'Unknown' ELSE language END
           AS language,
       types, try_cast(isOriginalTitle AS INTEGER) AS is_original_title
FROM raw_akas""")

PRINCIPALS_CTE = ("principals", """
SELECT p.tconst, try_cast(p.ordering AS INTEGER) AS ordering, p.nconst, n.primary_name,
       coalesce(p.category, 'Unknown') AS category, p.job, p.characters,
       t.title_type, t.primary_title, t.primary_genre, n.birth_year, n.primary_role
FROM raw_principals p
LEFT JOIN names n ON p.nconst = n.nconst
LEFT JOIN titles t ON p.tconst = t.tconst""")

ORDERS_TITLES_CTE = ("otitles", _sql_proj(TITLES_FROM_ORDERS, "orders"))
RUNTIME_CTE = ("rtitles", _sql_proj(
    RUNTIME_FROM_LINEITEM_PART, "lineitem JOIN part ON l_partkey = p_partkey"))

WIDE_RUNTIME_CTE = ("rtitles", _sql_proj(
    {**RUNTIME_FROM_LINEITEM_PART, "runtime_minutes": WIDE_RUNTIME}, "lineitem JOIN part ON l_partkey = p_partkey"))

TITLES_CTES = [RAW_BASICS_CTE, RAW_RATINGS_CTE, BASICS_CTE, TITLES_CTE]
EPISODES_CTES = TITLES_CTES + [RAW_EPISODE_CTE, EPISODES_CTE]
PRINCIPALS_CTES = TITLES_CTES + [RAW_NAMES_CTE, NAMES_CTE, RAW_PRINCIPALS_CTE, PRINCIPALS_CTE]

J1_TEMPLATE = f"""
SELECT CAST(floor(start_year / 10) * 10 AS INTEGER) AS decade, primary_title, start_year,
       average_rating, num_votes
FROM {{src}}
WHERE title_type = '{{movie_type}}' AND num_votes >= {MIN_VOTES}
  AND average_rating IS NOT NULL AND start_year > 0
ORDER BY decade DESC, average_rating DESC, tconst ASC NULLS LAST
LIMIT 20"""
J1_SQL = J1_TEMPLATE.format(src="otitles", movie_type=MOVIE_TYPE)

J2_TEMPLATE = """
SELECT title_type, round(avg(average_rating), 2) AS avg_rating, count(*) AS title_count
FROM {src} WHERE average_rating IS NOT NULL
GROUP BY title_type ORDER BY title_count DESC, title_type ASC NULLS LAST"""

J4_TEMPLATE = f"""
SELECT primary_genre, count(*) AS title_count, round(avg(average_rating), 2) AS avg_rating
FROM {{src}}
WHERE start_year >= {AS_OF_YEAR} - {{lookback}} AND start_year > 0
  AND average_rating IS NOT NULL
GROUP BY primary_genre
ORDER BY title_count DESC, primary_genre ASC NULLS LAST
LIMIT 20"""
J4_SQL = J4_TEMPLATE.format(src="otitles", lookback=LOOKBACK_YEARS)

J6_TEMPLATE = f"""
SELECT primary_name, count(*) AS title_count FROM {{src}}
WHERE category IN {ACTOR_CATEGORIES!r}
GROUP BY primary_name ORDER BY title_count DESC, primary_name ASC NULLS LAST LIMIT 20"""

J7_TEMPLATE = """
SELECT region, count(*) AS aka_count FROM {src}
GROUP BY region ORDER BY aka_count DESC, region ASC NULLS LAST LIMIT 20"""

J5_TEMPLATE = f"""
SELECT primary_genre, round(avg(runtime_minutes), 1) AS avg_runtime,
       quantile_cont(runtime_minutes, 0.5) AS median_runtime, count(*) AS movie_count
FROM {{src}}
WHERE title_type = '{RUNTIME_TYPE}' AND runtime_minutes IS NOT NULL AND runtime_minutes > 0
GROUP BY primary_genre HAVING count(*) >= {{min_group}}
ORDER BY avg_runtime DESC, primary_genre ASC NULLS LAST LIMIT 20"""
J5_SQL = J5_TEMPLATE.format(src="rtitles", min_group=MIN_GROUP)

J3_SQL = """
SELECT series_title, count(*) AS episode_count,
       round(avg(runtime_minutes), 1) AS avg_runtime_minutes
FROM episodes WHERE series_title IS NOT NULL AND series_title <> ''
GROUP BY series_title
ORDER BY episode_count DESC, series_title ASC NULLS LAST LIMIT 10"""

J8_SQL = f"""
SELECT primary_name, count(*) AS movie_count FROM {{src}}
WHERE category = '{DIRECTOR}' AND title_type = '{SERIES_TYPE}'
GROUP BY primary_name ORDER BY movie_count DESC, primary_name ASC NULLS LAST LIMIT 20"""

# Serving principals: text columns are non-null ('' for null).
SERVING_PRINCIPALS_CTE = ("sprincipals", """
SELECT coalesce(tconst, '') AS tconst, coalesce(ordering, 0) AS ordering, coalesce(nconst, '') AS nconst,
       coalesce(primary_name, '') AS primary_name, coalesce(nullif(category, ''), 'Unknown') AS category,
       coalesce(job, '') AS job, coalesce(characters, '') AS characters,
       coalesce(title_type, '') AS title_type, coalesce(primary_title, '') AS primary_title,
       coalesce(primary_genre, '') AS primary_genre, birth_year, coalesce(primary_role, '') AS primary_role
FROM principals""")
SERVING_EPISODES_SQL = """
SELECT coalesce(episode_tconst, '') AS episode_tconst, coalesce(parent_tconst, '') AS parent_tconst,
       season_number, episode_number, coalesce(episode_title, '') AS episode_title,
       coalesce(series_title, '') AS series_title, coalesce(start_year, 0) AS start_year,
       coalesce(primary_genre, '') AS primary_genre, average_rating, num_votes,
       CAST(runtime_minutes AS BIGINT) AS runtime_minutes
FROM episodes"""
SERVING_NAMES_SQL = """
SELECT coalesce(nconst, '') AS nconst, coalesce(primary_name, '') AS primary_name, birth_year, death_year,
       coalesce(primary_profession, '') AS primary_profession,
       coalesce(nullif(primary_role, ''), 'Unknown') AS primary_role,
       coalesce(known_for_titles, '') AS known_for_titles
FROM names"""
SERVING_AKAS_SQL = """
SELECT coalesce(title_id, '') AS title_id, coalesce(ordering, 0) AS ordering, coalesce(title, '') AS title,
       coalesce(nullif(region, ''), 'Unknown') AS region, coalesce(language, '') AS language,
       coalesce(types, '') AS types, coalesce(CAST(is_original_title AS SMALLINT), 0::SMALLINT) AS is_original_title
FROM akas"""

SERVING_TITLES_SQL = """
SELECT coalesce(tconst, '') AS tconst, coalesce(title_type, '') AS title_type,
       coalesce(primary_title, '') AS primary_title,
       coalesce(original_title, '') AS original_title,
       coalesce(start_year, 0) AS start_year, end_year,
       CAST(runtime_minutes AS BIGINT) AS runtime_minutes,
       coalesce(genres, '') AS genres, coalesce(primary_genre, '') AS primary_genre,
       average_rating, num_votes
FROM {src}"""


SERVING_TITLES_CTES = TITLES_CTES + [("stitles", SERVING_TITLES_SQL.format(src="titles"))]
SERVING_AKAS_CTE = ("sakas", "SELECT coalesce(nullif(region, ''), 'Unknown') AS region FROM akas")


def _count_union(parts: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dataset, CAST(count(*) AS BIGINT) AS rows FROM ({sql})"
        for name, sql in parts
    )


_ORACLE: dict[str, str] = {
    "clean_basics": _with([RAW_BASICS_CTE, BASICS_CTE], "SELECT * FROM basics"),
    "titles_with_ratings": _with(TITLES_CTES, "SELECT * FROM titles"),
    "titles_without_ratings": _with([RAW_BASICS_CTE, BASICS_CTE], TITLES_NO_RATINGS_SQL),
    "episodes_two_level": _with(EPISODES_CTES, "SELECT * FROM episodes"),
    "episodes_fallback": _with(TITLES_CTES, EPISODES_FALLBACK_SQL),
    "names_first_token": _with([RAW_NAMES_CTE, NAMES_CTE], "SELECT * FROM names"),
    "akas_defaults": _with([RAW_AKAS_CTE, AKAS_CTE], "SELECT * FROM akas"),
    "bridge_enriched": _with(PRINCIPALS_CTES, "SELECT * FROM principals"),
    "top_rated_by_decade": _with([ORDERS_TITLES_CTE], J1_SQL),
    "avg_by_type": _with(TITLES_CTES, J2_TEMPLATE.format(src="titles")),
    "top_parents_by_child_count": _with(EPISODES_CTES, J3_SQL),
    "recent_popularity": _with([ORDERS_TITLES_CTE], J4_SQL),
    "runtime_by_group": _with([RUNTIME_CTE], J5_SQL),
    "runtime_by_group_percentile": _with([RUNTIME_CTE], J5_SQL),
    "runtime_by_group_bounded": _with([WIDE_RUNTIME_CTE], J5_SQL),
    "runtime_by_group_approx": _with([RUNTIME_CTE], J5_SQL.replace(
        "quantile_cont(runtime_minutes, 0.5)", "CAST(quantile_disc(runtime_minutes, 0.5) AS DOUBLE)")),
    "top_people_in_categories": _with(PRINCIPALS_CTES, J6_TEMPLATE.format(src="principals")),
    "top_regions": _with([RAW_AKAS_CTE, AKAS_CTE], J7_TEMPLATE.format(src="akas")),
    "top_people_typed": _with(PRINCIPALS_CTES, J8_SQL.format(src="principals")),
    "scan_tsv": f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       nullif({SCAN_TSV_NULLED}, 'BUILDING') AS c_mktsegment
FROM customer""",
    "lake_roundtrip": _with([ORDERS_TITLES_CTE], "SELECT * FROM otitles"),
    "scan_lake": _with([ORDERS_TITLES_CTE], J4_SQL),
    "lake_project": _with([ORDERS_TITLES_CTE],
                          f"SELECT {', '.join(LAKE_PROJECTION)} FROM otitles"),
    "partition_overwrite": _with([ORDERS_TITLES_CTE], f"""
SELECT tconst, title_type, primary_title, original_title, start_year, end_year,
       CASE WHEN title_type = '{MOVIE_TYPE}' AND start_year >= {OVERWRITE_FROM_YEAR}
            THEN runtime_minutes + 1 ELSE runtime_minutes END AS runtime_minutes,
       genres, primary_genre, average_rating, num_votes
FROM otitles"""),
    "lake_moved_rows": _with([ORDERS_TITLES_CTE, ("changed", f"""
SELECT tconst, CASE WHEN CAST(tconst AS BIGINT) % 3 = 0 THEN 'moved' ELSE title_type END AS title_type,
       primary_title, original_title,
       CASE WHEN CAST(tconst AS BIGINT) % 3 = 0 THEN start_year - {UPDATE_YEARS_BACK} ELSE start_year END AS start_year,
       end_year, runtime_minutes + 1 AS runtime_minutes, genres, primary_genre, average_rating, num_votes
FROM otitles WHERE title_type = '{MOVIE_TYPE}' AND start_year >= {OVERWRITE_FROM_YEAR}"""),
        ("updated", "SELECT * FROM changed WHERE start_year <> 2001")], """
SELECT * FROM updated
UNION ALL
SELECT * FROM otitles o WHERE NOT EXISTS (SELECT 1 FROM updated u WHERE u.tconst = o.tconst)
  AND NOT EXISTS (SELECT 1 FROM updated u WHERE u.start_year = o.start_year AND u.title_type = o.title_type)"""),
    "guarded_write_count": """
SELECT 'titles' AS dataset, CAST(count(*) AS BIGINT) AS rows FROM orders
UNION ALL SELECT 'empty' AS dataset, CAST(0 AS BIGINT) AS rows""",
    "etl_counts": _with(PRINCIPALS_CTES + [RAW_EPISODE_CTE, EPISODES_CTE, RAW_AKAS_CTE, AKAS_CTE],
                        _count_union([
                            ("titles", "SELECT * FROM titles"),
                            ("episodes", "SELECT * FROM episodes"),
                            ("names", "SELECT * FROM names"),
                            ("akas", "SELECT * FROM akas"),
                            ("principals", "SELECT * FROM principals"),
                        ])),
    "conform_schema": _with([RAW_AKAS_CTE, AKAS_CTE], SERVING_AKAS_SQL),
    "conform_out_of_range": f"""
SELECT region, count(*) AS rows, sum(coalesce(ordering, 0)) AS ordering_sum,
       sum(CASE WHEN ordering < 0 OR ordering > 65535 THEN 1 ELSE 0 END) AS ordering_out_of_range,
       sum(CASE WHEN flag < 0 OR flag > 255 THEN 1 ELSE 0 END) AS flag_out_of_range
FROM (SELECT coalesce(nullif({OUT_OF_RANGE_REGION}, ''), 'Unknown') AS region,
             CAST({OUT_OF_RANGE_ORDERING} AS BIGINT) AS ordering, {OUT_OF_RANGE_FLAG} AS flag FROM customer)
GROUP BY region""",
    "lake_episodes": _with(EPISODES_CTES, "SELECT * REPLACE (nullif(primary_genre, '') AS primary_genre) FROM episodes"),
    "lake_names": _with([RAW_NAMES_CTE, NAMES_CTE], "SELECT * REPLACE (nullif(primary_role, '') AS primary_role) FROM names"),
    "lake_principals": _with(PRINCIPALS_CTES, "SELECT * REPLACE (nullif(category, '') AS category) FROM principals"),
    "lake_principals_dynamic": _with(PRINCIPALS_CTES, "SELECT * REPLACE (nullif(category, '') AS category) FROM principals"),
    "serving_episodes": _with(EPISODES_CTES, SERVING_EPISODES_SQL),
    "serving_names": _with([RAW_NAMES_CTE, NAMES_CTE], SERVING_NAMES_SQL),
    "serving_akas": _with([RAW_AKAS_CTE, AKAS_CTE], SERVING_AKAS_SQL),
    "serving_principals": _with(PRINCIPALS_CTES + [SERVING_PRINCIPALS_CTE], "SELECT * FROM sprincipals"),
    "sorted_layout": _with([ORDERS_TITLES_CTE], SERVING_TITLES_SQL.format(src="otitles")),
    "serving_refresh": _with([RAW_BASICS_CTE, BASICS_CTE,
                              ("titles_nr", TITLES_NO_RATINGS_SQL)],
                             SERVING_TITLES_SQL.format(src="titles_nr")),
    "serving_top_parents_by_child_count": _with(EPISODES_CTES, J3_SQL),
    "serving_top_people_typed": _with(PRINCIPALS_CTES + [SERVING_PRINCIPALS_CTE],
                                      J8_SQL.format(src="sprincipals")),
    "serving_top_rated_by_decade": _with(SERVING_TITLES_CTES,
                                         J1_TEMPLATE.format(src="stitles", movie_type=SERVING_MOVIE_TYPE)),
    "serving_avg_by_type": _with(SERVING_TITLES_CTES, J2_TEMPLATE.format(src="stitles")),
    "serving_recent_popularity": _with(SERVING_TITLES_CTES,
                                       J4_TEMPLATE.format(src="stitles", lookback=SERVING_LOOKBACK_YEARS)),
    "serving_runtime_by_group": _with(SERVING_TITLES_CTES,
                                      J5_TEMPLATE.format(src="stitles", min_group=SERVING_MIN_GROUP)),
    "serving_top_people_in_categories": _with(PRINCIPALS_CTES + [SERVING_PRINCIPALS_CTE],
                                              J6_TEMPLATE.format(src="sprincipals")),
    "serving_top_regions": _with([RAW_AKAS_CTE, AKAS_CTE, SERVING_AKAS_CTE],
                                 J7_TEMPLATE.format(src="sakas")),
    "validate_counts": _with([RAW_BASICS_CTE, BASICS_CTE], f"""
SELECT 'titles' AS dataset, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS out_of_range FROM basics
UNION ALL SELECT 'episodes', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT) FROM basics
    WHERE title_type = '{EPISODE_TYPE}'
UNION ALL SELECT 'names', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
UNION ALL SELECT 'akas', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
UNION ALL SELECT 'principals', CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""),
}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLE, **_LLM_ORACLE}
