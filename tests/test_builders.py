"""Builders on the hand-written rows; expected values worked out by hand."""

from __future__ import annotations

import pytest

from marquee import schemas as S
from marquee.operators import (
    build_episodes_from_basics,
    build_titles,
    clean_basics,
)


def shape(schema):
    """Column names and types (nullability is not part of the contract)."""
    return [(f.name, f.dataType) for f in schema.fields]


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_clean_basics(raw):
    df = clean_basics(raw[S.RAW_BASICS])
    rows = _by(df, "tconst")
    assert sorted(rows) == ["tt01", "tt02", "tt03", "tt05", "tt06", "tt07"]
    assert rows["tt01"].primary_genre == "Drama" and rows["tt01"].end_year is None
    assert rows["tt03"].start_year == 0 and rows["tt03"].primary_genre == "Unknown"
    t6 = rows["tt06"]
    assert (t6.start_year, t6.runtime_minutes, t6.genres, t6.primary_genre) == (0, None, None, "Unknown")
    assert t6.primary_title == '"Open title'


def test_titles_with_and_without_ratings(raw, built):
    titles = built["titles"]
    assert shape(titles.schema) == shape(S.TITLES.schema)
    rows = _by(titles, "tconst")
    assert len(rows) == 6 and "tt99" not in rows
    assert rows["tt01"].average_rating == pytest.approx(9.3, rel=1e-6)
    assert rows["tt01"].num_votes == 2_700_000
    assert rows["tt02"].average_rating == pytest.approx(9.5)
    assert all(rows[k].average_rating is None for k in ("tt03", "tt05", "tt06", "tt07"))
    bare = build_titles(clean_basics(raw[S.RAW_BASICS]), None)
    assert shape(bare.schema) == shape(titles.schema)
    assert bare.filter("average_rating IS NOT NULL OR num_votes IS NOT NULL").count() == 0
    assert bare.count() == 6


def test_episodes_two_level(built):
    eps = built["episodes"]
    assert shape(eps.schema) == shape(S.EPISODES.schema)
    rows = _by(eps, "episode_tconst")
    t3 = rows["tt03"]
    assert (t3.episode_title, t3.series_title, t3.start_year, t3.primary_genre,
            t3.runtime_minutes, t3.season_number) == ("Pilot", "Beta", 0, "Crime", 58, 1)
    t7 = rows["tt07"]  # parent is a mini series: does not match
    assert (t7.episode_title, t7.series_title, t7.start_year, t7.primary_genre,
            t7.runtime_minutes) == ("Part 1", None, 2019, "Unknown", 60)
    t98 = rows["tt98"]  # unknown episode and parent
    assert (t98.episode_title, t98.start_year, t98.primary_genre, t98.runtime_minutes,
            t98.season_number) == (None, 0, "Unknown", None, None)


def test_episodes_fallback(built):
    fb = build_episodes_from_basics(built["titles"])
    assert shape(fb.schema) == shape(S.EPISODES.schema)
    rows = _by(fb, "episode_tconst")
    assert sorted(rows) == ["tt03", "tt07"]
    assert rows["tt03"].primary_genre == "Unknown" and rows["tt07"].primary_genre == "Drama"
    assert all(r.parent_tconst is None and r.series_title is None and r.season_number is None
               for r in rows.values())


def test_names(built):
    rows = _by(built["names"], "nconst")
    assert rows["nm1"].primary_role == "actress" and rows["nm1"].birth_year == 1950
    assert rows["nm2"].primary_role == "Unknown" and rows["nm2"].birth_year is None


def test_akas(built):
    rows = {r.ordering: r for r in built["akas"].collect()}
    assert [rows[i].region for i in (1, 2, 3)] == ["US", "Unknown", "01"]
    assert rows[2].language == "Unknown" and rows[2].is_original_title == 1


def test_principals(built):
    df = built["principals"]
    assert shape(df.schema) == shape(S.PRINCIPALS.schema)
    rows = {(r.tconst, r.ordering): r for r in df.collect()}
    assert len(rows) == 4
    a = rows[("tt01", 1)]
    assert (a.primary_name, a.category, a.title_type, a.primary_title, a.primary_genre,
            a.birth_year, a.primary_role) == ("Ann A", "actress", "movie", "Alpha", "Drama",
                                              1950, "actress")
    assert rows[("tt01", 2)].category == "Unknown"
    assert rows[("tt01", 3)].primary_name is None  # nm9 is unknown
    t4 = rows[("tt04", 1)]  # adult title was removed: title columns null
    assert (t4.title_type, t4.primary_title, t4.primary_genre) == (None, None, None)


def test_left_joins_keep_left_rows(raw, built):
    # Property: with unique right keys a left join keeps the left row count.
    assert built["episodes"].count() == raw[S.RAW_EPISODE].count()
    assert built["principals"].count() == raw[S.RAW_PRINCIPALS].count()
    assert built["titles"].count() == clean_basics(raw[S.RAW_BASICS]).count()


def test_duplicate_right_keys_fan_out(spark, raw):
    dup = raw[S.RAW_RATINGS].unionByName(raw[S.RAW_RATINGS].filter("tconst = 'tt01'"))
    titles = build_titles(clean_basics(raw[S.RAW_BASICS]), dup)
    assert titles.filter("tconst = 'tt01'").count() == 2


def test_mixed_flag_values_never_raise(spark):
    # ANSI mode: a text flag must be dropped, not fail a numeric cast.
    df = spark.createDataFrame(
        [("a", "0"), ("b", "title"), ("c", None), ("d", "1")], "tconst string, isAdult string"
    )
    for c in S.RAW_COLUMNS[S.RAW_BASICS]:
        if c not in df.columns:
            df = df.withColumn(c, df.tconst)
    assert [r.tconst for r in clean_basics(df).collect()] == ["a"]
