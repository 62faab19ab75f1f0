"""The pipeline with every on/off combination of the optional inputs."""

from __future__ import annotations

import itertools

import pytest

from marquee import schemas as S
from marquee.plans import build_all, run_etl, run_etl_from_dir
from marquee.plans.etl import OPTIONAL_RAW, lake_path
from marquee.session import scratch_path
from marquee.sources import read_lake, read_state


def expected_datasets(present: set[str]) -> set[str]:
    out = {"titles", "episodes"}
    if S.RAW_NAMES in present:
        out.add("names")
    if S.RAW_AKAS in present:
        out.add("akas")
    if S.RAW_PRINCIPALS in present and S.RAW_NAMES in present:
        out.add("principals")
    return out


COMBOS = [
    frozenset(c)
    for n in range(len(OPTIONAL_RAW) + 1)
    for c in itertools.combinations(OPTIONAL_RAW, n)
]


def test_thirty_two_combinations():
    assert len(COMBOS) == 32


@pytest.mark.parametrize("present", COMBOS, ids=lambda c: "+".join(sorted(c)) or "basics")
def test_datasets_for_inputs(spark, raw, present):
    """Every combination through the production run, in both modes."""
    inputs = {S.RAW_BASICS: raw[S.RAW_BASICS], **{k: raw[k] for k in present}}
    expected = expected_datasets(set(present))
    contents = []
    for mode in ("static", "dynamic"):
        lake = scratch_path(spark, f"combo-{mode}")
        counts = run_etl(spark, inputs, lake, mode=mode)
        assert set(counts) == expected
        found = {}
        for name in expected:
            df = read_lake(spark, lake_path(lake, name), name)
            assert df.columns == S.LAKE[name].columns
            assert [f.dataType for f in df.schema.fields] == [f.dataType for f in S.LAKE[name].schema.fields]
            found[name] = sorted(map(str, df.collect()))
            assert len(found[name]) == counts[name]
        contents.append(found)
    assert contents[0] == contents[1]


def test_static_rebuild_drops_what_it_does_not_produce(spark, raw):
    lake = scratch_path(spark, "stale")
    run_etl(spark, dict(raw), lake)
    assert "akas" in read_state(spark, lake).datasets
    empty = raw[S.RAW_NAMES].limit(0)
    counts = run_etl(spark, {S.RAW_BASICS: raw[S.RAW_BASICS], S.RAW_NAMES: empty}, lake)
    assert counts["names"] == 0
    assert set(read_state(spark, lake).datasets) == {"titles", "episodes"}
    run_etl(spark, dict(raw), lake)
    run_etl(spark, {S.RAW_BASICS: raw[S.RAW_BASICS]}, lake, mode="dynamic")
    assert "akas" in read_state(spark, lake).datasets   # dynamic keeps the rest


def test_empty_first_token_is_the_same_in_both_modes(spark, raw):
    names = spark.createDataFrame([("nm1", "Ann", "1950", None, ",writer", None)], raw[S.RAW_NAMES].schema)
    got = {}
    for mode in ("static", "dynamic"):
        lake = scratch_path(spark, f"token-{mode}")
        run_etl(spark, {**raw, S.RAW_NAMES: names}, lake, mode=mode)
        got[mode] = {r.primary_role for r in read_lake(spark, lake_path(lake, "principals"), "principals").where("nconst = 'nm1'").collect()}
    assert got == {"static": {""}, "dynamic": {""}}


def test_without_episode_file_uses_fallback(spark, raw):
    built = build_all({S.RAW_BASICS: raw[S.RAW_BASICS]})
    assert sorted(r.episode_tconst for r in built["episodes"].collect()) == ["tt03", "tt07"]
    assert built["titles"].filter("average_rating IS NOT NULL").count() == 0


def test_principals_without_names_skipped(spark, raw, caplog):
    inputs = {S.RAW_BASICS: raw[S.RAW_BASICS], S.RAW_PRINCIPALS: raw[S.RAW_PRINCIPALS]}
    with caplog.at_level("WARNING"):
        built = build_all(inputs)
    assert "principals" not in built
    assert "name.basics" in caplog.text


def test_names_without_principals(spark, raw):
    built = build_all({S.RAW_BASICS: raw[S.RAW_BASICS], S.RAW_NAMES: raw[S.RAW_NAMES]})
    assert "names" in built and "principals" not in built


def test_missing_basics_fails_before_work(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_etl_from_dir(spark, str(tmp_path), scratch_path(spark, "nothing"))
    with pytest.raises(FileNotFoundError):
        run_etl(spark, {S.RAW_RATINGS: None}, scratch_path(spark, "nothing"))


def test_dynamic_run_counts(spark, raw):
    counts = run_etl(spark, dict(raw), scratch_path(spark, "dyn-etl"), mode="dynamic")
    assert counts == {"titles": 6, "episodes": 3, "names": 2, "akas": 3, "principals": 4}
