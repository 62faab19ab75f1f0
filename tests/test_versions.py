"""Lake versions: one commit point, partial updates, shared files, expiry."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import make_raw_dir
from marquee import schemas as S
from marquee.operators import write_partitioned
from marquee.plans import etl, expire_versions, refresh_serving, run_etl_from_dir, versions, write_lake
from marquee.plans.etl import lake_path
from marquee.session import scratch_path
from marquee.sources import file_report, read_lake, read_state, read_version
from test_lake import local, parquet_files, plan_text


def rows(df):
    return sorted(map(str, df.collect()))


def content(spark, lake):
    return {n: rows(read_lake(spark, lake_path(lake, n), n)) for n in read_state(spark, lake).datasets}


class Injected(Exception):
    pass


STEPS = [(versions, "write_routed", 7, "static"), (versions, "measure", 7, "dynamic"),
         (etl, "commit", 1, "static"), (etl, "commit", 1, "dynamic")]


@pytest.mark.parametrize("module,step,calls,mode", STEPS, ids=lambda v: v if isinstance(v, str) else "")
def test_run_failing_at_any_write_keeps_the_old_lake(spark, raw_dir, tmp_path, monkeypatch, module, step, calls, mode):
    lake = scratch_path(spark, "torn")
    run_etl_from_dir(spark, str(raw_dir), lake)
    before, state = content(spark, lake), read_state(spark, lake)
    other = str(make_raw_dir(tmp_path / "raw", {"title.basics", "name.basics", "title.akas"}))
    real, seen = getattr(module, step), []

    for position in range(1, calls + 1):
        seen.clear()

        def failing(*args, **kwargs):
            seen.append(step)
            if len(seen) == position:
                raise Injected(step)
            return real(*args, **kwargs)

        monkeypatch.setattr(module, step, failing)
        try:
            run_etl_from_dir(spark, other, lake, mode=mode, concurrent=False)
        except Injected:
            assert content(spark, lake) == before and read_state(spark, lake) == state
            # what the failed run wrote is gone
            assert os.listdir(os.path.join(local(lake), "versions")) == [state.version]
            continue
        break
    assert position > (0 if step == "commit" else 3)
    monkeypatch.setattr(module, step, real)
    run_etl_from_dir(spark, other, lake, mode=mode)
    assert read_state(spark, lake).sequence > state.sequence
    assert ("principals" in read_state(spark, lake).datasets) == (mode == "dynamic")


def titles_of(spark, built_rows):
    """Titles with the given (tconst, year, type, votes)."""
    df = spark.createDataFrame(built_rows, "tconst string, start_year int, title_type string, num_votes long")
    for f in S.TITLES.schema.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*S.TITLES.columns)


def found(spark, lake):
    return sorted(((r.tconst, r.start_year, r.title_type, r.num_votes)
                  for r in read_lake(spark, lake_path(lake, "titles"), "titles").collect()), key=str)


@pytest.mark.parametrize("pool_rows", [0, 2, 1000])
def test_moved_rows_leave_their_old_partition(spark, pool_rows):
    lake = scratch_path(spark, "moved")
    old = [("a", 1990, "movie", 1), ("b", 1990, "movie", 1), ("c", 1991, "movie", 1), ("d", None, "", 1),
           ("e", 1992, None, 1), ("e", 1992, None, 2), (None, 1992, "x", 1), ("f", 1993, "movie", 1), ("g", 1993, "movie", 1)]
    write_lake(spark, lake, {"titles": titles_of(spark, old)}, pool_rows=pool_rows)
    # a moves to 1991 (replacing that partition: c is not in the update and goes),
    # e leaves the null type, d stays where it is, null ids match nothing
    new = [("a", 1991, "movie", 2), ("e", 1995, "short", 2), (None, 1995, "short", 2)]
    assert write_lake(spark, lake, {"titles": titles_of(spark, new)}, mode="dynamic", pool_rows=pool_rows) == {"titles": 3}
    expected = [("b", 1990, "movie", 1), ("d", None, None, 1), (None, 1992, "x", 1), ("f", 1993, "movie", 1),
                ("g", 1993, "movie", 1), *new]
    assert found(spark, lake) == sorted(expected, key=str)
    state = read_state(spark, lake)
    assert state.row_count("titles") == len(expected)
    # the untouched partition was not written again
    assert any("1993" in k for k in state.datasets["titles"][-1].rows)
    assert sum("1993" in k for s in state.datasets["titles"] for k in s.rows) == 1


def test_many_updates_are_merged(spark):
    lake = scratch_path(spark, "merged")
    expected = {}
    for i in range(versions.MAX_SEGMENTS + 3):
        part = [(f"t{i}-{j}", 1990 + i, "movie", i) for j in range(3)]
        if i:
            part.append((f"t{i - 1}-0", 1990 + i, "movie", i))   # moves on from the year before
        expected.update({p[0]: p for p in part})
        write_lake(spark, lake, {"titles": titles_of(spark, part)}, mode="dynamic", pool_rows=2)
        assert found(spark, lake) == sorted(expected.values(), key=str)
        assert len(read_state(spark, lake).datasets["titles"]) <= versions.MAX_SEGMENTS
    # files only old versions use are gone, those of the last two are there
    folders = {s.path for s in read_state(spark, lake).datasets["titles"]}
    assert all(os.path.isdir(os.path.join(local(lake), f)) for f in folders)
    assert expire_versions(spark, lake) == []


def test_small_values_share_files_and_filters_reach_them(spark):
    lake = scratch_path(spark, "pooled")
    titles = spark.range(6000).selectExpr(
        "cast(id as string) AS tconst", "cast(1900 + id % 300 as int) AS start_year",
        "case when id % 3 = 0 then 'movie' else concat('t', id % 5) end AS title_type", "id AS num_votes")
    hot = spark.range(3000).selectExpr(
        "concat('h', id) AS tconst", "2300 AS start_year", "'movie' AS title_type", "id AS num_votes")
    df = titles.unionByName(hot)
    for f in S.TITLES.schema.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    write_lake(spark, lake, {"titles": df.select(*S.TITLES.columns)}, pool_rows=1000)
    [segment] = read_state(spark, lake).datasets["titles"]
    values = df.select("start_year", "title_type").distinct().count()
    assert len(segment.rows) == values > 300 and len(segment.pooled) == values - 1
    files = parquet_files(os.path.join(local(lake), segment.path))
    assert len(files) == segment.files < 20    # not one per value
    assert sum(os.path.getsize(f) for f in files) == segment.bytes
    report = file_report(spark, lake).first()
    assert (report.files, report.partition_values, report.rows) == (segment.files, values, 9000)
    back = read_lake(spark, lake_path(lake, "titles"), "titles")
    assert rows(back) == rows(df.select(*S.TITLES.columns))
    plan = plan_text(back.where("start_year = 2300 AND num_votes > 5"))
    assert "PartitionFilters: [isnotnull(start_year" in plan                   # the hot value's directory
    assert "EqualTo(key_start_year,2300)" in plan and "GreaterThan(num_votes,5)" in plan   # the shared files


def test_two_writers_do_not_overwrite_each_other(spark, monkeypatch):
    lake = scratch_path(spark, "race")
    first = titles_of(spark, [("a", 1990, "movie", 1)])
    write_lake(spark, lake, {"titles": first})
    real = versions.update_dataset

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(versions, "update_dataset", real)
        write_lake(spark, lake, {"titles": titles_of(spark, [("b", 1990, "movie", 1)])})
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, "update_dataset", meanwhile)
    with pytest.raises(RuntimeError, match="another run committed"):
        write_lake(spark, lake, {"titles": titles_of(spark, [("c", 1990, "movie", 1)])})
    assert [r[0] for r in found(spark, lake)] == ["b"]


def test_readers_of_the_version_before_keep_their_files(spark, raw_dir, tmp_path):
    lake = scratch_path(spark, "readers")
    run_etl_from_dir(spark, str(raw_dir), lake)
    state = read_state(spark, lake)
    before = {n: read_version(spark, lake, state, n) for n in S.DATASET_ORDER}
    expected = {n: rows(df) for n, df in before.items()}
    run_etl_from_dir(spark, str(make_raw_dir(tmp_path / "basics", {"title.basics"})), lake)
    assert {n: rows(df) for n, df in before.items()} == expected
    with pytest.raises(FileNotFoundError, match="akas not found in version"):
        read_lake(spark, lake_path(lake, "akas"), "akas")
    run_etl_from_dir(spark, str(raw_dir), lake)
    assert not os.path.exists(os.path.join(local(lake), "versions", state.version, "akas"))  # expired


def test_update_on_a_lake_of_plain_folders(spark):
    lake = scratch_path(spark, "plain")
    old = titles_of(spark, [("a", 1990, "movie", 1), ("b", 1990, "movie", 1), ("c", 1991, "movie", 1)])
    write_partitioned(old, lake_path(lake, "titles"), S.TITLES.partition_by)
    write_lake(spark, lake, {"titles": titles_of(spark, [("a", 1992, "movie", 2)])}, mode="dynamic")
    assert found(spark, lake) == [("a", 1992, "movie", 2), ("b", 1990, "movie", 1), ("c", 1991, "movie", 1)]


def test_refresh_reads_one_version(spark, raw_dir):
    lake = scratch_path(spark, "one")
    run_etl_from_dir(spark, str(raw_dir), lake)
    counts = refresh_serving(spark, lake, "one_version", scratch_path(spark, "one-db"))
    state = read_state(spark, lake)
    assert counts == {n: state.row_count(n) for n in S.DATASET_ORDER}


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        write_lake(spark, scratch_path(spark, "x"), {}, mode="append")
    with pytest.raises(ValueError):
        expire_versions(spark, scratch_path(spark, "x"), keep=0)
