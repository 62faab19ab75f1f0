"""Operators: dataset builders, lookup joins, lake sinks and reports."""

from marquee.operators.analytics import (
    avg_rating_by_type,
    genre_popularity,
    runtime_by_genre,
    top_people_in_categories,
    top_people_typed,
    top_rated_by_decade,
    top_regions,
    top_series_by_episode_count,
)
from marquee.operators.builders import (
    build_akas,
    build_episodes,
    build_episodes_from_basics,
    build_names,
    build_principals,
    build_titles,
    clean_basics,
)
from marquee.operators.joins import left_lookup
from marquee.operators.median import median_by_group
from marquee.operators.sinks import layout_for_write, write_counted, write_partitioned

__all__ = [
    "avg_rating_by_type",
    "build_akas",
    "build_episodes",
    "build_episodes_from_basics",
    "build_names",
    "build_principals",
    "build_titles",
    "clean_basics",
    "genre_popularity",
    "layout_for_write",
    "left_lookup",
    "median_by_group",
    "runtime_by_genre",
    "top_people_in_categories",
    "top_people_typed",
    "top_rated_by_decade",
    "top_regions",
    "top_series_by_episode_count",
    "write_counted",
    "write_partitioned",
]
