"""Dataset builders: raw string frames -> the five typed lake datasets.

Each builder is a pure ``DataFrame -> DataFrame`` function made of
projections, filters and left lookup joins; nothing runs until a writer or
a report triggers an action. Output columns and order follow
``marquee.schemas.LAKE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas as S
from marquee.functions import (
    default_if_null,
    default_if_null_or,
    first_token,
    lenient_cast,
)
from marquee.operators.joins import Lookup, attach, left_lookup

INT = T.IntegerType()
LONG = T.LongType()
FLOAT = T.FloatType()
STRING = T.StringType()


def _typed_null(data_type: T.DataType, name: str):
    return F.lit(None).cast(data_type).alias(name)


def clean_basics(basics_raw: DataFrame) -> DataFrame:
    """title.basics -> cleaned title rows (before ratings).

    Keeps non-adult titles only: the flag is compared as text, so a null or
    any other value (``1``, a shifted text column) drops the row without
    failing a cast. Years and runtime are cast leniently (bad text -> null);
    a missing start year becomes 0; the primary genre is the first listed
    genre, ``Unknown`` when there is none.
    """
    start_year = lenient_cast("startYear", INT)
    return basics_raw.filter(F.col("isAdult") == F.lit(S.NON_ADULT_FLAG)).select(
        F.col("tconst"),
        F.col("titleType").alias("title_type"),
        F.col("primaryTitle").alias("primary_title"),
        F.col("originalTitle").alias("original_title"),
        default_if_null(start_year, 0).alias("start_year"),
        lenient_cast("endYear", INT).alias("end_year"),
        lenient_cast("runtimeMinutes", INT).alias("runtime_minutes"),
        F.col("genres"),
        first_token("genres").alias("primary_genre"),
    )


_TITLE_BASE = (
    "tconst", "title_type", "primary_title", "original_title", "start_year",
    "end_year", "runtime_minutes", "genres", "primary_genre",
)


def build_titles(basics: DataFrame, ratings_raw: DataFrame | None = None) -> DataFrame:
    """Cleaned basics with their rating and vote count.

    With ratings: ``basics LEFT JOIN ratings USING (tconst)``; titles without
    a rating keep null rating columns and duplicate rating keys fan out.
    Without ratings: the same schema with typed null rating columns.
    """
    if ratings_raw is None:
        return basics.select(
            *_TITLE_BASE,
            _typed_null(FLOAT, "average_rating"),
            _typed_null(LONG, "num_votes"),
        )
    ratings = ratings_raw.select(
        "tconst",
        lenient_cast("averageRating", FLOAT).alias("average_rating"),
        lenient_cast("numVotes", LONG).alias("num_votes"),
    )
    return left_lookup(basics, ratings, "tconst").select(
        *_TITLE_BASE, "average_rating", "num_votes"
    )


def read_episodes(episode_raw: DataFrame) -> DataFrame:
    """The hierarchy's own columns, typed."""
    return episode_raw.select(
        F.col("tconst").alias("episode_tconst"),
        F.col("parentTconst").alias("parent_tconst"),
        lenient_cast("seasonNumber", INT).alias("season_number"),
        lenient_cast("episodeNumber", INT).alias("episode_number"),
    )


def episode_lookups(titles: DataFrame, series_type: str = S.SERIES_TYPE) -> tuple[Lookup, Lookup]:
    """The episode's own attributes, and the title and genre of its series."""
    episode_attrs = titles.select(
        F.col("tconst").alias("episode_tconst"),
        F.col("primary_title").alias("episode_title"),
        "start_year",
        "runtime_minutes",
        "average_rating",
        "num_votes",
    )
    # Filter before the join: on the right side of a left join it must stay
    # below the join to keep unmatched parents (it is also pushed to the scan).
    series = titles.filter(F.col("title_type") == F.lit(series_type)).select(
        F.col("tconst").alias("parent_tconst"),
        F.col("primary_title").alias("series_title"),
        "primary_genre",
    )
    return Lookup(episode_attrs, "episode_tconst"), Lookup(series, "parent_tconst")


def episode_columns(joined: DataFrame) -> DataFrame:
    """Episodes with both lookups -> the dataset's columns."""
    return joined.select(
        "episode_tconst",
        "parent_tconst",
        "season_number",
        "episode_number",
        "episode_title",
        "series_title",
        default_if_null("start_year", 0).alias("start_year"),
        default_if_null("primary_genre", S.UNKNOWN).alias("primary_genre"),
        "average_rating",
        "num_votes",
        "runtime_minutes",
    )


def build_episodes(
    episode_raw: DataFrame,
    titles: DataFrame,
    series_type: str = S.SERIES_TYPE,
) -> DataFrame:
    """Episode hierarchy with the episode's own and its series' attributes.

    ``episode LEFT JOIN titles ON episode = tconst`` gives title, year,
    runtime and rating of the episode; ``LEFT JOIN (titles of type
    series_type) ON parent = tconst`` gives the series title and genre.
    Parents of any other type (a mini series) do not match. A missing year
    becomes 0 and a missing genre ``Unknown``.
    """
    return episode_columns(attach(read_episodes(episode_raw), episode_lookups(titles, series_type)))


def build_episodes_from_basics(
    titles: DataFrame, episode_type: str = S.EPISODE_TYPE
) -> DataFrame:
    """Fallback without title.episode: the episode-type titles, same schema,
    hierarchy columns (parent, season, episode number, series) null."""
    return titles.filter(F.col("title_type") == F.lit(episode_type)).select(
        F.col("tconst").alias("episode_tconst"),
        _typed_null(STRING, "parent_tconst"),
        _typed_null(INT, "season_number"),
        _typed_null(INT, "episode_number"),
        F.col("primary_title").alias("episode_title"),
        _typed_null(STRING, "series_title"),
        "start_year",
        "primary_genre",
        "average_rating",
        "num_votes",
        "runtime_minutes",
    )


def build_names(names_raw: DataFrame) -> DataFrame:
    """People dimension; the primary role is the first listed profession."""
    return names_raw.select(
        F.col("nconst"),
        F.col("primaryName").alias("primary_name"),
        lenient_cast("birthYear", INT).alias("birth_year"),
        lenient_cast("deathYear", INT).alias("death_year"),
        F.col("primaryProfession").alias("primary_profession"),
        first_token("primaryProfession").alias("primary_role"),
        F.col("knownForTitles").alias("known_for_titles"),
    )


def build_akas(akas_raw: DataFrame) -> DataFrame:
    """Alternate titles; region and language default to ``Unknown`` when
    null or when they hold the literal raw null token."""
    return akas_raw.select(
        F.col("titleId").alias("title_id"),
        lenient_cast("ordering", INT).alias("ordering"),
        F.col("title"),
        default_if_null_or("region", S.RAW_NULL_TOKEN, S.UNKNOWN).alias("region"),
        default_if_null_or("language", S.RAW_NULL_TOKEN, S.UNKNOWN).alias("language"),
        F.col("types"),
        lenient_cast("isOriginalTitle", INT).alias("is_original_title"),
    )


def read_credits(principals_raw: DataFrame) -> DataFrame:
    """The bridge's own columns, typed; a missing category becomes ``Unknown``."""
    return principals_raw.select(
        "tconst",
        lenient_cast("ordering", INT).alias("ordering"),
        "nconst",
        default_if_null("category", S.UNKNOWN).alias("category"),
        "job",
        "characters",
    )


def credit_lookups(names: DataFrame, titles: DataFrame) -> tuple[Lookup, Lookup]:
    """The person and the title attributes that the bridge carries."""
    people = names.select("nconst", "primary_name", "birth_year", "primary_role")
    title_attrs = titles.select("tconst", "title_type", "primary_title", "primary_genre")
    return Lookup(people, "nconst"), Lookup(title_attrs, "tconst")


def build_principals(
    principals_raw: DataFrame, names: DataFrame, titles: DataFrame
) -> DataFrame:
    """Cast and crew bridge, denormalised with person and title attributes.

    ``principals LEFT JOIN names USING (nconst) LEFT JOIN titles USING
    (tconst)``; only the attributes the bridge carries are projected from
    each dimension before its join. A missing category becomes ``Unknown``.
    """
    credits = read_credits(principals_raw)
    return attach(credits, credit_lookups(names, titles)).select(*S.PRINCIPALS.columns)
