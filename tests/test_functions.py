"""Column helpers against plain Python definitions (property tests)."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.functions import decade, default_if_null_or, first_token

TEXT = st.one_of(
    st.none(),
    st.text(alphabet=st.sampled_from(list("ab, \\N")), max_size=8),
)


def py_first_token(s):
    return "Unknown" if s is None or s == "" else s.split(",")[0]


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=200))
def test_first_token_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", first_token("s").alias("t")).collect()}
    assert got == {i: py_first_token(v) for i, v in enumerate(values)}


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=200))
def test_sentinel_default_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", default_if_null_or("s", "\\N", "U").alias("t")).collect()}
    assert got == {i: ("U" if v is None or v == "\\N" else v) for i, v in enumerate(values)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-100_000, 100_000)), min_size=1, max_size=200))
def test_decade_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, y int")
    rows = df.select("i", decade("y").alias("d")).collect()
    for r in rows:
        v = values[r.i]
        assert r.d == (None if v is None else (v // 10) * 10)
