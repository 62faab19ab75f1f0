"""Serving tables: conform, sorted load, full refresh, validation counts."""

from __future__ import annotations

import glob
import os
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import make_raw_dir
from marquee import schemas as S
from marquee.operators import top_people_typed, top_series_by_episode_count
from marquee.plans import (
    conform,
    create_serving_tables,
    current_version,
    load_table,
    read_table,
    refresh_serving,
    run_etl_from_dir,
    validate_counts,
)
from marquee.plans.serving import create_table_sql
from marquee.session import scratch_path
from test_lake import local, parquet_files


@pytest.fixture(scope="module")
def serving(spark, raw_dir):
    lake = scratch_path(spark, "serving-lake")
    run_etl_from_dir(spark, str(raw_dir), lake)
    db = f"serving_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, "serving-db")
    loaded = refresh_serving(spark, lake, db, location)
    return db, location, loaded


def test_ddl_text():
    sql = create_table_sql("db", "akas")
    assert sql.startswith("CREATE TABLE IF NOT EXISTS db.akas (`title_id` string, `ordering` int")
    assert sql.endswith("USING parquet PARTITIONED BY (`region`)")


def test_refresh_loads_every_table(spark, serving):
    db, _, loaded = serving
    assert loaded == {"titles": 6, "episodes": 3, "names": 2, "akas": 3, "principals": 4}
    counts = {r.dataset: r.rows for r in validate_counts(spark, db).collect()}
    assert counts == loaded


def test_serving_types_and_non_null_text(spark, serving):
    db, _, _ = serving
    titles = read_table(spark, db, "titles")
    assert [f.dataType for f in titles.schema.fields] == [
        f.dataType for f in S.SERVING_TITLES.schema.fields]
    t6 = titles.filter("tconst = 'tt06'").first()
    assert t6.genres == "" and t6.runtime_minutes is None
    eps = {r.episode_tconst: r for r in read_table(spark, db, "episodes").collect()}
    assert eps["tt07"].series_title == "" and eps["tt98"].episode_title == ""
    akas = read_table(spark, db, "akas")
    assert dict(akas.dtypes)["is_original_title"] == "smallint"


def test_reports_on_serving_tables(spark, serving):
    db, _, _ = serving
    principals = read_table(spark, db, "principals")
    # The unnamed director groups under '' here (null in the lake).
    assert [tuple(r) for r in top_people_typed(principals).collect()] == [("", 1)]
    episodes = read_table(spark, db, "episodes")
    assert [tuple(r) for r in top_series_by_episode_count(episodes).collect()] == [("Beta", 1, 58.0)]


def test_serving_files_sorted_by_key(spark, serving):
    _, location, _ = serving
    [version] = glob.glob(os.path.join(local(location), "principals__*"))
    files = parquet_files(version)
    assert files
    for f in files:
        t = pq.read_table(f, columns=["tconst", "ordering", "nconst"]).to_pylist()
        keys = [(r["tconst"], r["ordering"], r["nconst"]) for r in t]
        assert keys == sorted(keys)


def test_conform_ranges_and_defaults(spark):
    df = spark.createDataFrame(
        [("t1", -1, 5), ("t2", 3, 300), ("t3", None, None)],
        "title_id string, ordering int, is_original_title int",
    ).selectExpr("*", "CAST(NULL AS STRING) AS title", "CAST(NULL AS STRING) AS region",
                 "CAST(NULL AS STRING) AS language", "CAST(NULL AS STRING) AS types")
    akas = conform(df, "akas").collect()
    by = {r.title_id: r for r in akas}
    # out of range: kept, and flagged below
    assert (by["t1"].ordering, by["t1"].is_original_title) == (-1, 5)
    assert (by["t2"].ordering, by["t2"].is_original_title) == (3, 300)   # 300 > UInt8
    assert (by["t3"].ordering, by["t3"].region, by["t3"].title) == (0, "Unknown", "")
    flags = conform(df, "akas", with_flags=True).agg(
        F.sum(F.col("_out_of_range_ordering").cast("int")).alias("o"),
        F.sum(F.col("_out_of_range_is_original_title").cast("int")).alias("i")).first()
    assert (flags.o, flags.i) == (1, 1)


def test_load_reports_out_of_range(spark):
    db = f"oor_{uuid.uuid4().hex[:8]}"
    create_serving_tables(spark, db, scratch_path(spark, "oor-db"), [S.SERVING["names"]])
    names = spark.createDataFrame(
        [("nm1", "A", 1950, 99999, "actor", "actor", ""), ("nm2", "B", -5, None, "", "x", "")],
        "nconst string, primary_name string, birth_year int, death_year int, "
        "primary_profession string, primary_role string, known_for_titles string",
    )
    stats = load_table(spark, names, db, "names")
    assert stats == {"rows": 2, "birth_year_out_of_range": 1, "death_year_out_of_range": 1}
    rows = {r.nconst: r for r in read_table(spark, db, "names").collect()}
    assert rows["nm1"].death_year == 99999 and rows["nm2"].birth_year == -5
    report = {r.dataset: (r.rows, r.out_of_range) for r in validate_counts(spark, db).collect()}
    assert report["names"] == (2, 2) and report["titles"] == (None, None)


def test_refresh_from_smaller_lake_empties_tables(spark, tmp_path):
    db = f"refresh_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, "refresh-db")
    full = scratch_path(spark, "full-lake")
    run_etl_from_dir(spark, str(make_raw_dir(tmp_path / "all")), full)
    refresh_serving(spark, full, db, location)
    basics_only = scratch_path(spark, "basics-lake")
    run_etl_from_dir(spark, str(make_raw_dir(tmp_path / "basics", {"title.basics"})), basics_only)
    loaded = refresh_serving(spark, basics_only, db, location)
    assert loaded == {"titles": 6, "episodes": 2, "names": None, "akas": None, "principals": None}
    counts = {r.dataset: r.rows for r in validate_counts(spark, db).collect()}
    assert counts == {"titles": 6, "episodes": 2, "names": 0, "akas": 0, "principals": 0}
    # No rating survives from the first load.
    assert read_table(spark, db, "titles").filter("average_rating IS NOT NULL").count() == 0


def test_missing_required_lake_fails_before_truncation(spark, serving):
    db, location, _ = serving
    with pytest.raises(FileNotFoundError):
        refresh_serving(spark, scratch_path(spark, "no-lake"), db, location)
    assert read_table(spark, db, "titles").count() == 6


def test_validate_counts_missing_table_is_null(spark):
    db = f"partial_{uuid.uuid4().hex[:8]}"
    create_serving_tables(spark, db, scratch_path(spark, "partial-db"), [S.SERVING["titles"]])
    counts = {r.dataset: r.rows for r in validate_counts(spark, db).collect()}
    assert counts == {"titles": 0, "episodes": None, "names": None, "akas": None,
                      "principals": None}


def test_location_is_used(spark, serving):
    _, location, _ = serving
    assert len(glob.glob(os.path.join(local(location), "titles__*"))) == 1


def test_empty_lake_directory_keeps_the_old_rows(spark, tmp_path, raw_dir):
    db, location = f"safe_{uuid.uuid4().hex[:8]}", scratch_path(spark, "safe-db")
    lake = scratch_path(spark, "safe-lake")
    run_etl_from_dir(spark, str(raw_dir), lake)
    refresh_serving(spark, lake, db, location)
    before = {r.dataset: r.rows for r in validate_counts(spark, db).collect()}
    broken = tmp_path / "broken"
    (broken / "titles").mkdir(parents=True)          # interrupted write: no _SUCCESS, no file
    with pytest.raises(FileNotFoundError, match="titles"):
        refresh_serving(spark, str(broken), db, location)
    (broken / "titles" / "_SUCCESS").touch()         # committed, but without data
    with pytest.raises(FileNotFoundError, match="titles"):
        refresh_serving(spark, str(broken), db, location)
    assert {r.dataset: r.rows for r in validate_counts(spark, db).collect()} == before


class Injected(Exception):
    pass


def _content(spark, db):
    """All five tables, through the reader and through the views."""
    return {
        n: [sorted(map(str, df.collect())) for df in (read_table(spark, db, n), spark.table(f"{db}.{n}"))]
        for n in S.SERVING
    }


def test_failure_at_any_step_keeps_all_five_tables(spark, raw_dir, tmp_path, monkeypatch):
    """Every catalog statement and every load of a refresh fails in turn."""
    from marquee.plans import serving as module

    db, location = f"fail_{uuid.uuid4().hex[:8]}", scratch_path(spark, "fail-db")
    lake, other = scratch_path(spark, "fail-lake"), scratch_path(spark, "fail-other")
    run_etl_from_dir(spark, str(raw_dir), lake)
    run_etl_from_dir(spark, str(make_raw_dir(tmp_path / "basics", {"title.basics"})), other)
    refresh_serving(spark, lake, db, location)
    before, version = _content(spark, db), current_version(spark, db)
    run, load = module._run, module.load_table
    steps = {"loads": 0, "statements": 0}

    def fails(kind, position):
        def failing(*args, **kwargs):
            sql = args[1] if kind == "statements" else ""
            if not sql.startswith(("DESCRIBE", "DROP")):
                steps[kind] += 1
                if steps[kind] == position:
                    raise Injected(sql or "load")
            return (run if kind == "statements" else load)(*args, **kwargs)
        return failing

    names = {"statements": "_run", "loads": "load_table"}
    for kind in names:
        position = 0
        while True:
            position, steps[kind] = position + 1, 0
            monkeypatch.setattr(module, names[kind], fails(kind, position))
            try:
                refresh_serving(spark, other, db, location, concurrent=False)
            except Injected:
                monkeypatch.setattr(module, names[kind], run if kind == "statements" else load)
                assert _content(spark, db) == before and current_version(spark, db) == version, (kind, position)
                assert len(glob.glob(os.path.join(local(location), "akas__*"))) == 1   # nothing left behind
                continue
            break
        # one database, five views to repair, five tables, five views, the commit / two loads
        assert position - 1 == {"statements": 17, "loads": 2}[kind]
        monkeypatch.setattr(module, names[kind], run if kind == "statements" else load)
        refresh_serving(spark, lake, db, location)
        assert _content(spark, db) == before
        version = current_version(spark, db)
        # the version before stays for its readers, older ones are dropped
        assert len(glob.glob(os.path.join(local(location), "akas__*"))) == 2
        for v in glob.glob(os.path.join(local(location), "akas__*")):
            if not v.endswith(version):
                module._drop_version(spark, db, v.rpartition("__")[2])
        module._set_version(spark, db, version, None)


def test_views_left_between_versions_are_repaired(spark, raw_dir, tmp_path):
    """A process that died while it switched views: readers see the committed
    version, and repair_views brings the views back to it."""
    from marquee.plans import repair_views
    from marquee.plans import serving as module

    db = f"died_{uuid.uuid4().hex[:8]}"
    lake = scratch_path(spark, "died-lake")
    run_etl_from_dir(spark, str(raw_dir), lake)
    refresh_serving(spark, lake, db, scratch_path(spark, "died-db"))
    before = _content(spark, db)
    for spec in S.SERVING.values():
        spark.sql(create_table_sql(db, spec, "halfway"))
    for name in ("titles", "akas"):
        module._show(spark, db, name, "halfway")
    assert spark.table(f"{db}.akas").count() == 0
    assert {n: v[0] for n, v in _content(spark, db).items()} == {n: v[0] for n, v in before.items()}
    repair_views(spark, db)
    assert _content(spark, db) == before


def test_refresh_reports_values_out_of_range(spark):
    from marquee.operators import write_partitioned

    lake = scratch_path(spark, "range-lake")
    names = spark.createDataFrame(
        [("nm1", "A", 70_000, -1, "", "", ""), ("nm2", "B", 1950, None, "x", "x", "")],
        "nconst string, primary_name string, birth_year int, death_year int, "
        "primary_profession string, primary_role string, known_for_titles string")
    titles = spark.createDataFrame([("tt1", "", 99_999), ("tt2", "movie", None)], "tconst string, title_type string, start_year int")
    for f in S.TITLES.schema.fields:
        if f.name not in titles.columns:
            titles = titles.withColumn(f.name, F.lit(None).cast(f.dataType))
    write_partitioned(names, f"{lake}/names", S.NAMES.partition_by)
    write_partitioned(titles.select(*S.TITLES.columns), f"{lake}/titles", S.TITLES.partition_by)
    db = f"range_{uuid.uuid4().hex[:8]}"
    counts = refresh_serving(spark, lake, db, scratch_path(spark, "range-db"))
    assert counts["names"] == 2
    assert counts.out_of_range == {"titles": {"start_year": 1}, "names": {"birth_year": 1, "death_year": 1},}
    kept = {r.nconst: r for r in read_table(spark, db, "names").collect()}
    assert kept["nm1"].birth_year == 70_000 and kept["nm1"].primary_role == "Unknown"
    years = {r.tconst: r.start_year for r in read_table(spark, db, "titles").collect()}
    assert years == {"tt1": 99_999, "tt2": 0}   # a null year is partition 0


def test_validate_counts_survives_a_broken_table(spark, serving, tmp_path):
    db = f"torn_{uuid.uuid4().hex[:8]}"
    create_serving_tables(spark, db, scratch_path(spark, "torn-db"))
    bad = tmp_path / "bad"
    (bad / "region=x").mkdir(parents=True)
    (bad / "region=x" / "part-0.parquet").write_text("this is no parquet file")
    version = current_version(spark, db)
    spark.sql(f"DROP TABLE {db}.akas__{version}")
    spark.sql(f"{create_table_sql(db, 'akas', version)} LOCATION '{bad}'")
    spark.sql(f"MSCK REPAIR TABLE {db}.akas__{version}")
    rows = [(r.dataset, r.rows) for r in validate_counts(spark, db).collect()]
    assert rows == [("titles", 0), ("episodes", 0), ("names", 0), ("akas", None), ("principals", 0)]


def test_files_of_a_hot_value_hold_disjoint_ranges(spark):
    db = f"ranges_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, "ranges-db")
    create_serving_tables(spark, db, location, [S.SERVING["akas"]])
    akas = spark.range(40_000).selectExpr(
        "concat('tt', lpad(cast(id % 9000 as string), 6, '0')) as title_id", "cast(id % 7 as int) as ordering",
        "cast(id as string) as title", "case when id % 3 = 0 then 'US' else concat('r', id % 5) end as region",
        "'' as language", "'' as types", "0 as is_original_title").repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_table(spark, akas, db, "akas")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    [table] = glob.glob(os.path.join(local(location), "akas__*"))
    files = parquet_files(os.path.join(table, "region=US"))
    assert len(files) > 1
    spans = sorted((min(v), max(v)) for v in (pq.read_table(f, columns=["title_id"])["title_id"].to_pylist() for f in files))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    one = "tt000300"
    assert sum(low <= one <= high for low, high in spans) <= 2   # a point lookup skips the others
