"""Lake layout: round trip, partition types, overwrite modes, plans, sort order."""

from __future__ import annotations

import contextlib
import io
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.operators import (
    genre_popularity,
    top_rated_by_decade,
    write_counted,
    write_partitioned,
)
from marquee.plans import run_etl_from_dir
from marquee.plans.etl import lake_path
from marquee.session import scratch_path
from marquee.sources import lake_project, read_lake, read_state


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def parquet_files(path: str) -> list[str]:
    return [
        os.path.join(root, f)
        for root, _, files in os.walk(local(path))
        for f in files
        if f.endswith(".parquet")
    ]


@pytest.fixture(scope="module")
def lake(spark, raw_dir):
    path = scratch_path(spark, "test-lake")
    counts = run_etl_from_dir(spark, str(raw_dir), path, pool_rows=0)  # a directory per partition value
    return path, counts


def folder(spark, path: str, name: str) -> str:
    """The directories of a dataset's only segment."""
    [segment] = read_state(spark, path).datasets[name]
    return os.path.join(local(path), segment.path, "pooled=false")


def test_etl_counts(lake):
    _, counts = lake
    assert counts == {"titles": 6, "episodes": 3, "names": 2, "akas": 3, "principals": 4}


@pytest.mark.parametrize("name", S.DATASET_ORDER)
def test_roundtrip_equals_built(spark, lake, built, name):
    path, _ = lake
    back = read_lake(spark, lake_path(path, name), S.LAKE[name])
    assert back.columns == S.LAKE[name].columns
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in S.LAKE[name].schema.fields]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        map(tuple, built[name].collect()), key=repr)


def test_partition_text_survives(spark, lake):
    path, _ = lake
    regions = {r.region for r in read_lake(spark, lake_path(path, "akas"), "akas").collect()}
    assert regions == {"US", "Unknown", "01"}  # '01' is not re-read as the integer 1
    dirs = sorted(os.listdir(folder(spark, path, "akas")))
    assert "region=01" in dirs


def test_partition_directories(spark, lake):
    path, _ = lake
    titles = folder(spark, path, "titles")
    assert "start_year=1994" in os.listdir(titles)
    assert os.listdir(os.path.join(titles, "start_year=1994")) == ["title_type=movie"]
    # One file per partition directory for a small dataset (no small-file blow-up).
    files = parquet_files(titles)
    assert len(files) == len({os.path.dirname(f) for f in files})


def test_lake_project_prunes_columns(spark, lake):
    path, _ = lake
    df = lake_project(spark, lake_path(path, "titles"), "titles", ["tconst", "start_year"])
    plan = plan_text(df)
    assert "ReadSchema: struct<tconst:string>" in plan
    assert df.count() == 6


def test_partition_and_pushed_filters(spark, lake):
    path, _ = lake
    titles = read_lake(spark, lake_path(path, "titles"), "titles")
    plan = plan_text(genre_popularity(titles, as_of_year=2026))
    assert "PartitionFilters: [isnotnull(start_year" in plan
    assert "(start_year#" in plan and ">= 2006" in plan
    plan1 = plan_text(top_rated_by_decade(titles))
    pushed = next(l for l in plan1.splitlines() if l.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(num_votes,10000)" in pushed and "IsNotNull(average_rating)" in pushed
    parts = next(l for l in plan1.splitlines() if l.startswith("PartitionFilters"))
    assert "(title_type#" in parts and "= movie)" in parts and "> 0)" in parts
    assert "ReadSchema: struct<tconst:string,primary_title:string,average_rating:float," \
           "num_votes:bigint>" in plan1
    assert "TakeOrderedAndProject" in plan1 and "Exchange" not in plan1.split("TakeOrderedAndProject")[0]


def test_aggregate_is_two_phase(spark, lake):
    path, _ = lake
    titles = read_lake(spark, lake_path(path, "titles"), "titles")
    plan = plan_text(genre_popularity(titles, as_of_year=2026))
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan


def test_dynamic_overwrite_keeps_other_partitions(spark, built):
    path = scratch_path(spark, "dyn")
    titles = built["titles"]
    write_partitioned(titles, path, S.TITLES.partition_by)
    changed = titles.filter("title_type = 'movie'").withColumn("runtime_minutes", F.lit(1))
    write_partitioned(changed, path, S.TITLES.partition_by, mode="dynamic")
    back = {r.tconst: r.runtime_minutes for r in read_lake(spark, path, "titles").collect()}
    assert back == {"tt01": 1, "tt02": 45, "tt03": 58, "tt05": None, "tt06": 1, "tt07": 60}
    write_partitioned(changed, path, S.TITLES.partition_by, mode="static")
    assert sorted(r.tconst for r in read_lake(spark, path, "titles").collect()) == ["tt01", "tt06"]


def test_bad_mode_rejected(spark, built):
    with pytest.raises(ValueError):
        write_partitioned(built["titles"], scratch_path(spark, "x"), ("start_year",), mode="append")


def test_empty_write_writes_nothing(spark, built):
    path = scratch_path(spark, "empty")
    assert write_counted(built["titles"].filter("false"), path, S.TITLES.partition_by) == 0
    assert not os.path.exists(local(path))
    assert write_counted(built["titles"], path, S.TITLES.partition_by) == 6


def test_null_partition_value_reads_back_null(spark, built):
    path = scratch_path(spark, "nullpart")
    titles = built["titles"].withColumn(
        "title_type",
        F.when(F.col("tconst") == "tt01", None)
        .when(F.col("tconst") == "tt06", "")
        .otherwise(F.col("title_type")))
    write_partitioned(titles, path, S.TITLES.partition_by)
    back = {r.tconst: r.title_type for r in read_lake(spark, path, "titles").collect()}
    # null and '' both land in the default partition and read back null
    assert back["tt01"] is None and back["tt06"] is None and back["tt02"] == "tvSeries"


def test_sorted_files(spark):
    from marquee.operators import layout_for_write

    df = spark.range(0, 5000).selectExpr(
        "CAST(id % 3 AS INT) AS p", "CAST((id * 7919) % 5000 AS STRING) AS k", "id")
    path = scratch_path(spark, "sorted")
    layout_for_write(df, ["p"], ["k"]).write.partitionBy("p").parquet(path)
    files = parquet_files(path)
    assert files
    for f in files:
        keys = pq.read_table(f, columns=["k"]).column("k").to_pylist()
        assert keys == sorted(keys)


def test_series_lookup_prunes_type_partitions(spark, lake, raw):
    # Episodes built from the lake titles: the series lookup reads only the
    # tvSeries directories, the episode lookup only the columns it needs.
    from marquee.operators import build_episodes

    path, _ = lake
    titles = read_lake(spark, lake_path(path, "titles"), "titles")
    plan = plan_text(build_episodes(raw[S.RAW_EPISODE], titles))
    assert "= tvSeries)" in next(
        l for l in plan.splitlines() if l.startswith("PartitionFilters") and "title_type" in l)
    assert "ReadSchema: struct<tconst:string,primary_title:string,runtime_minutes:int," \
           "average_rating:float,num_votes:bigint>" in plan
