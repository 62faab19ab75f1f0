"""The eight reports on the hand-written rows (as_of_year 2026)."""

from __future__ import annotations

import pytest

from marquee.operators import (
    avg_rating_by_type,
    genre_popularity,
    runtime_by_genre,
    top_people_in_categories,
    top_people_typed,
    top_rated_by_decade,
    top_regions,
    top_series_by_episode_count,
)


def test_j1_top_rated_by_decade(built):
    rows = top_rated_by_decade(built["titles"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.decade, r.primary_title, r.start_year, r.num_votes) == (1990, "Alpha", 1994, 2_700_000)
    assert r.average_rating == pytest.approx(9.3, rel=1e-6)
    assert top_rated_by_decade(built["titles"]).columns == [
        "decade", "primary_title", "start_year", "average_rating", "num_votes"]


def test_j2_avg_by_type(built):
    rows = {r.title_type: (r.avg_rating, r.title_count) for r in avg_rating_by_type(built["titles"]).collect()}
    assert rows == {"movie": (9.3, 1), "tvSeries": (9.5, 1)}


def test_j3_top_series(built):
    rows = [tuple(r) for r in top_series_by_episode_count(built["episodes"]).collect()]
    assert rows == [("Beta", 1, 58.0)]


def test_j4_genre_popularity(built):
    rows = [tuple(r) for r in genre_popularity(built["titles"], as_of_year=2026).collect()]
    assert rows == [("Crime", 1, 9.5)]


def test_j4_default_year_is_current(built):
    # Default as_of_year is the current year, folded to a literal.
    assert genre_popularity(built["titles"]).count() in (0, 1)


def test_j5_runtime_by_genre(built):
    assert runtime_by_genre(built["titles"]).count() == 0
    rows = [tuple(r) for r in runtime_by_genre(built["titles"], min_count=1).collect()]
    assert rows == [("Drama", 142.0, 142.0, 1)]


def test_j5_median_interpolates(spark):
    df = spark.createDataFrame(
        [("movie", "G", m) for m in (1, 2, 3, 10)],
        "title_type string, primary_genre string, runtime_minutes int",
    )
    for method in ("bounded", "percentile"):
        r = runtime_by_genre(df, min_count=1, median=method).first()
        assert r.median_runtime == 2.5 and r.avg_runtime == 4.0
    approx = runtime_by_genre(df, min_count=1, median="approx").first()
    assert approx.median_runtime == 2.0  # an element of the data, no interpolation


def test_j6_top_actors(built):
    rows = [tuple(r) for r in top_people_in_categories(built["principals"]).collect()]
    assert rows == [("Ann A", 2)]


def test_j7_top_regions(built):
    rows = {r.region: r.aka_count for r in top_regions(built["akas"]).collect()}
    assert rows == {"01": 1, "US": 1, "Unknown": 1}


def test_j8_top_directors(built):
    rows = [tuple(r) for r in top_people_typed(built["principals"]).collect()]
    assert rows == [(None, 1)]  # nm9 has no name: a null group in the lake


def test_top_k_ties_are_broken_by_key(spark):
    df = spark.createDataFrame(
        [(f"s{i:02d}", "x") for i in range(30)], "series_title string, runtime_minutes string"
    ).selectExpr("series_title", "CAST(NULL AS INT) AS runtime_minutes")
    rows = [r.series_title for r in top_series_by_episode_count(df).collect()]
    assert rows == [f"s{i:02d}" for i in range(10)]


def test_group_counts_add_up(built):
    # Property: the group counts of a report sum to its filtered row count.
    titles = built["titles"]
    total = sum(r.title_count for r in avg_rating_by_type(titles).collect())
    assert total == titles.filter("average_rating IS NOT NULL").count()
