"""Analytics reports over the lake datasets or the serving tables.

Every report is a filter -> (partial aggregate -> exchange -> final
aggregate) -> top-k chain: filters reach the Parquet scan (partition
filters on the year/type directories, pushed filters otherwise), only the
referenced columns are read, aggregation is combined map-side before the
shuffle so a hot group (one genre holding a third of the rows) only ever
moves one partial row per task, and ``orderBy().limit(k)`` plans as a
``TakeOrderedAndProject`` that keeps k rows per task instead of sorting
the whole result.

Ties are broken by the grouping key (ascending, nulls last) so the top-k
set is deterministic; the reference sorts by the metric only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import decade
from marquee.operators.median import median_by_group


def _nonempty_text(name: str) -> Column:
    c = F.col(name)
    return c.isNotNull() & (c != F.lit(""))


def top_rated_by_decade(
    titles: DataFrame,
    title_type: str = "movie",
    min_votes: int = 10_000,
    limit: int = 20,
) -> DataFrame:
    """Highest-rated titles of one type, newest decade first.

    A global top-``limit`` ordered by decade then rating (not a top per
    decade). Needs a rating, at least ``min_votes`` votes and a known year.
    """
    return (
        titles.filter(
            (F.col("title_type") == F.lit(title_type))
            & (F.col("num_votes") >= F.lit(min_votes))
            & F.col("average_rating").isNotNull()
            & (F.col("start_year") > F.lit(0))
        )
        .select(
            decade("start_year").alias("decade"),
            "primary_title",
            "start_year",
            "average_rating",
            "num_votes",
            "tconst",
        )
        .orderBy(
            F.desc("decade"), F.desc("average_rating"), F.asc_nulls_last("tconst")
        )
        .limit(limit)
        .drop("tconst")
    )


def avg_rating_by_type(titles: DataFrame) -> DataFrame:
    """Average rating (2 decimals) and number of rated titles per type."""
    return (
        titles.filter(F.col("average_rating").isNotNull())
        .groupBy("title_type")
        .agg(
            F.round(F.avg("average_rating"), 2).alias("avg_rating"),
            F.count(F.lit(1)).alias("title_count"),
        )
        .orderBy(F.desc("title_count"), F.asc_nulls_last("title_type"))
    )


def top_series_by_episode_count(episodes: DataFrame, limit: int = 10) -> DataFrame:
    """Series with the most episodes and their average episode runtime.

    Groups by the series *title text*, so series sharing a name merge; rows
    without a series title (null or '') are left out.
    """
    return (
        episodes.filter(_nonempty_text("series_title"))
        .groupBy("series_title")
        .agg(
            F.count(F.lit(1)).alias("episode_count"),
            F.round(F.avg("runtime_minutes"), 1).alias("avg_runtime_minutes"),
        )
        .orderBy(F.desc("episode_count"), F.asc_nulls_last("series_title"))
        .limit(limit)
    )


def genre_popularity(
    titles: DataFrame,
    as_of_year: int | None = None,
    lookback_years: int = 20,
    limit: int = 20,
) -> DataFrame:
    """Rated titles per primary genre over the last ``lookback_years``.

    ``as_of_year`` defaults to the current year (folded to a constant at
    planning, so the year filter still prunes year partitions).
    """
    current = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    return (
        titles.filter(
            (F.col("start_year") >= current - F.lit(lookback_years))
            & (F.col("start_year") > F.lit(0))
            & F.col("average_rating").isNotNull()
        )
        .groupBy("primary_genre")
        .agg(
            F.count(F.lit(1)).alias("title_count"),
            F.round(F.avg("average_rating"), 2).alias("avg_rating"),
        )
        .orderBy(F.desc("title_count"), F.asc_nulls_last("primary_genre"))
        .limit(limit)
    )


MEDIAN_METHODS = ("frequency", "bounded", "percentile", "approx")


def runtime_by_genre(
    titles: DataFrame,
    title_type: str = "movie",
    min_count: int = 100,
    limit: int = 20,
    median: str = "frequency",
    accuracy: int = 10_000,
) -> DataFrame:
    """Average and median runtime per genre for one title type.

    The median is exact and interpolating ({1,2,3,10} gives 2.5) unless
    ``median="approx"``. ``median`` picks the strategy:

    * ``"frequency"`` (default): rows are counted per (genre, runtime), map
      side first, and the median is ``percentile(runtime, 0.5, count)`` over
      that histogram. Runtimes are minutes: a few hundred distinct values per
      genre, however many rows a hot genre has.
    * ``"bounded"``: ``median_by_group``, a radix select over the same
      histogram for wide value domains: no task holds more than 65,536 rows of
      one genre, however many distinct values it has. More, smaller shuffles.
    * ``"percentile"``: ``percentile(x, 0.5)``, one shuffle. Its state is one
      count per *distinct* value per group, and all of a group's maps are
      merged in one task, in object memory that Spark's memory manager does
      not track. Fine while a genre has a few thousand distinct runtimes; a
      hot genre with millions of distinct values becomes one long task
      (30M rows, 10M distinct values in one genre: 26.8 s for that one
      task against at most 2.7 s per task for ``"bounded"``; with 240
      distinct values both take about the same time).
    * ``"approx"``: ``percentile_approx``, a fixed-size sketch per group, like
      the sampled median of an OLAP engine; it returns an element of the
      data (no interpolation).

    Genres with fewer than ``min_count`` titles are dropped (HAVING).
    """
    if median not in MEDIAN_METHODS:
        raise ValueError(f"median must be one of {MEDIAN_METHODS}, got {median!r}")
    movies = titles.filter(
        (F.col("title_type") == F.lit(title_type))
        & F.col("runtime_minutes").isNotNull()
        & (F.col("runtime_minutes") > F.lit(0))
    )
    if median == "frequency":
        counts = movies.groupBy("primary_genre", "runtime_minutes").agg(F.count(F.lit(1)).alias("c"))
        value, c = F.col("runtime_minutes"), F.col("c")
        stats = counts.groupBy("primary_genre").agg(
            F.round(F.sum(value.cast("double") * c) / F.sum(c), 1).alias("avg_runtime"),
            F.percentile(value, 0.5, c).alias("median_runtime"),
            F.sum(c).alias("movie_count"),
        )
    elif median == "bounded":
        stats = median_by_group(movies, "primary_genre", "runtime_minutes").select(
            "primary_genre",
            F.round(F.col("total") / F.col("n"), 1).alias("avg_runtime"),
            F.col("median").alias("median_runtime"),
            F.col("n").alias("movie_count"),
        )
    else:
        median_col = (
            F.median("runtime_minutes")
            if median == "percentile"
            else F.percentile_approx("runtime_minutes", 0.5, accuracy).cast("double")
        )
        stats = movies.groupBy("primary_genre").agg(
            F.round(F.avg("runtime_minutes"), 1).alias("avg_runtime"),
            median_col.alias("median_runtime"),
            F.count(F.lit(1)).alias("movie_count"),
        )
    return (
        stats.filter(F.col("movie_count") >= F.lit(min_count))
        .orderBy(F.desc("avg_runtime"), F.asc_nulls_last("primary_genre"))
        .limit(limit)
    )


def top_people_in_categories(
    principals: DataFrame,
    categories: Sequence[str] = ("actor", "actress"),
    limit: int = 20,
) -> DataFrame:
    """People with the most credits in the given categories.

    Counts credit rows (not distinct titles) and groups by the name text.
    """
    return (
        principals.filter(F.col("category").isin(list(categories)))
        .groupBy("primary_name")
        .agg(F.count(F.lit(1)).alias("title_count"))
        .orderBy(F.desc("title_count"), F.asc_nulls_last("primary_name"))
        .limit(limit)
    )


def top_regions(akas: DataFrame, limit: int = 20) -> DataFrame:
    """Regions with the most alternate titles."""
    return (
        akas.groupBy("region")
        .agg(F.count(F.lit(1)).alias("aka_count"))
        .orderBy(F.desc("aka_count"), F.asc_nulls_last("region"))
        .limit(limit)
    )


def top_people_typed(
    principals: DataFrame,
    category: str = "director",
    title_type: str = "movie",
    limit: int = 20,
) -> DataFrame:
    """People with the most credits of one category on one title type."""
    return (
        principals.filter(
            (F.col("category") == F.lit(category))
            & (F.col("title_type") == F.lit(title_type))
        )
        .groupBy("primary_name")
        .agg(F.count(F.lit(1)).alias("movie_count"))
        .orderBy(F.desc("movie_count"), F.asc_nulls_last("primary_name"))
        .limit(limit)
    )
