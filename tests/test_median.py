"""The bounded exact median (radix select over a histogram) against Python
and against Spark's ``percentile``."""

from __future__ import annotations

import contextlib
import io
import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.operators import median_by_group, runtime_by_genre

GROUPS = st.sampled_from([None, "a", "b", "c"])
# Values spread over several 16-bit buckets, negatives included.
VALUES = st.one_of(
    st.none(),
    st.integers(-70_000, 70_000),
    st.integers(0, 5),
    st.integers(2**31 - 3, 2**31 - 1),
)


def _python_medians(rows):
    by_group: dict = {}
    for g, v in rows:
        if v is not None:
            by_group.setdefault(g, []).append(v)
    return {g: (len(vs), float(sum(vs)), float(statistics.median(vs))) for g, vs in by_group.items()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(GROUPS, VALUES), min_size=1, max_size=300))
def test_median_by_group_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r.g: (r.n, r.total, r.median) for r in median_by_group(df, "g", "v").collect()}
    assert got == _python_medians(rows)


def test_bounded_report_equals_percentile_report(spark):
    # One genre holds a third of the rows with ~100k distinct runtimes.
    titles = spark.range(300_000).selectExpr(
        "CASE WHEN id % 11 = 0 THEN 'short' ELSE 'movie' END AS title_type",
        "CASE WHEN id % 3 = 0 THEN 'Drama' WHEN id % 13 = 0 THEN NULL "
        "ELSE CAST(id % 7 AS STRING) END AS primary_genre",
        "CAST(CASE WHEN id % 3 = 0 THEN id ELSE id % 240 END AS INT) AS runtime_minutes",
    )
    exact = runtime_by_genre(titles, min_count=1, limit=100, median="percentile").collect()
    assert runtime_by_genre(titles, min_count=1, limit=100).collect() == exact  # the default
    bounded = runtime_by_genre(titles, min_count=1, limit=100, median="bounded")
    assert bounded.collect() == exact
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        bounded.explain("formatted")  # final adaptive plan, after the collect
    plan = buf.getvalue()
    assert "percentile" not in plan
    assert "Window" in plan


def test_even_count_interpolates_across_buckets(spark):
    # The two middle values sit in different 16-bit buckets.
    df = spark.createDataFrame([("g", 1), ("g", 65_535), ("g", 65_537), ("g", 200_000)],
                               "g string, v int")
    r = median_by_group(df, "g", "v").first()
    assert (r.n, r.median) == (4, 65_536.0)


def test_wide_values(spark):
    # 64-bit values take four digits; no window holds more than 65,536 rows
    rng = random.Random(3)
    rows = [(g, rng.choice([rng.randrange(-2**62, 2**62), rng.randrange(-3, 4), 2**63 - 1, -2**63]))
            for g in (None, "a", "b") for _ in range(rng.randrange(1, 60))]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {r.g: (r.n, r.median) for r in median_by_group(df, "g", "v").collect()}
    want = _python_medians(rows)
    assert {g: n for g, (n, _) in got.items()} == {g: n for g, (n, _, _) in want.items()}
    for g, (_, m) in got.items():
        assert m == pytest.approx(want[g][2], rel=1e-12, abs=1)


def test_integral_values_only(spark):
    import pytest

    df = spark.createDataFrame([("g", 1.5)], "g string, v double")
    with pytest.raises(TypeError, match="integral"):
        median_by_group(df, "g", "v")
    empty = spark.createDataFrame([], "g string, v bigint")
    assert median_by_group(empty, "g", "v").count() == 0


def test_input_names_do_not_clash(spark):
    # Group and value named like the helper's internal columns.
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "bucket string, c int")
    got = {r.bucket: (r.n, r.median) for r in median_by_group(df, "bucket", "c").collect()}
    assert got == {"a": (2, 2.0), "b": (1, 5.0)}


def test_no_temporary_views_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    df = spark.createDataFrame([("g", 1), ("g", 2)], "g string, v int")
    assert median_by_group(df, "g", "v").first().median == 1.5
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == before
