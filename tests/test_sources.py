from __future__ import annotations

import pytest

from conftest import BASICS, N, write_tsv
from marquee import schemas as S
from marquee.sources import read_tsv, read_tsv_path, resolve_raw_path


def test_resolve_prefers_plain_then_gzip(spark, raw_dir):
    assert resolve_raw_path(spark, str(raw_dir), "title.basics").endswith("title.basics.tsv")
    assert resolve_raw_path(spark, str(raw_dir), "title.episode").endswith("title.episode.tsv.gz")
    assert resolve_raw_path(spark, str(raw_dir), "no.such") is None


def test_required_missing_raises_optional_missing_is_none(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_tsv(spark, str(tmp_path), S.RAW_BASICS, required=True)
    assert read_tsv(spark, str(tmp_path), S.RAW_RATINGS, required=False) is None


def test_all_strings_nulls_and_gzip(spark, raw):
    basics = raw[S.RAW_BASICS]
    assert {f.dataType.simpleString() for f in basics.schema.fields} == {"string"}
    rows = {r.tconst: r for r in basics.collect()}
    assert rows["tt03"].startYear is None          # \N -> null
    assert rows["tt06"].genres is None             # empty field -> null too
    episode = {r.tconst: r for r in raw[S.RAW_EPISODE].collect()}  # from .tsv.gz
    assert episode["tt98"].seasonNumber is None and len(episode) == 3


def test_quote_off_keeps_unbalanced_quote_and_columns(spark, raw):
    row = raw[S.RAW_BASICS].filter("tconst = 'tt06'").first()
    assert row.primaryTitle == '"Open title'
    assert row.isAdult == "0" and row.startYear == "abc"


def test_columns_bind_by_header_name(spark, tmp_path):
    # Reordered columns plus an extra one: names come from the header line.
    header, *rows = BASICS
    order = list(reversed(range(len(header))))
    reordered = [tuple(r[i] for i in order) + ("extra",) for r in [header, *rows]]
    path = write_tsv(tmp_path / "title.basics.tsv", reordered)
    df = read_tsv_path(spark, str(path), S.RAW_COLUMNS[S.RAW_BASICS])
    row = df.filter("tconst = 'tt01'").first()
    assert row.titleType == "movie" and row.startYear == "1994" and row.genres == "Drama,Crime"


def test_missing_required_column_raises(spark, tmp_path):
    path = write_tsv(tmp_path / "title.ratings.tsv", [("tconst", "averageRating"), ("tt01", "9")])
    with pytest.raises(ValueError, match="numVotes"):
        read_tsv(spark, str(tmp_path), S.RAW_RATINGS)


def test_null_token_constant():
    assert N == S.RAW_NULL_TOKEN == "\\N"


def test_quote_on_shifts_unbalanced_row(spark, raw_dir):
    # With the reader's default quote handling the field opening with '"'
    # runs to the next quote and swallows the tab: the row shifts.
    df = read_tsv(spark, str(raw_dir), S.RAW_BASICS, quote='"')
    row = df.filter("tconst = 'tt06'").first()
    assert row.primaryTitle != '"Open title' or row.isAdult != "0"


def test_directory_of_parts_is_one_input(spark, tmp_path):
    # A large input arrives as many part files (plain or gzip, each with its
    # header) under the raw name; every part is its own scan split.
    header, *rows = BASICS
    part_dir = tmp_path / "title.basics.tsv"
    part_dir.mkdir()
    write_tsv(part_dir / "part-0.tsv", [header, *rows[:4]])
    write_tsv(part_dir / "part-1.tsv.gz", [header, *rows[4:]], gz=True)
    assert resolve_raw_path(spark, str(tmp_path), S.RAW_BASICS).endswith("title.basics.tsv")
    df = read_tsv(spark, str(tmp_path), S.RAW_BASICS)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(r.tconst for r in df.collect()) == sorted(r[0] for r in rows)


def test_parts_with_another_header_order_raise(spark, tmp_path):
    part_dir = tmp_path / "title.ratings.tsv"
    part_dir.mkdir()
    write_tsv(part_dir / "part-0.tsv", [("tconst", "averageRating", "numVotes"), ("tt0", "9.0", "10")])
    write_tsv(part_dir / "part-1.tsv", [("tconst", "numVotes", "averageRating"), ("tt1", "10", "9.0")])
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_tsv(spark, str(tmp_path), S.RAW_RATINGS).collect()


def test_rows_of_a_single_gzip_file_are_dealt_anew(spark, raw_dir):
    plan = read_tsv(spark, str(raw_dir), S.RAW_EPISODE)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and plan.index("Exchange") < plan.index("FileScan")
    plan = read_tsv(spark, str(raw_dir), S.RAW_BASICS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_lake_without_data_files_raises(spark, tmp_path):
    from marquee.sources import read_lake

    (tmp_path / "names").mkdir()
    with pytest.raises(FileNotFoundError, match="no committed Parquet"):
        read_lake(spark, str(tmp_path / "names"), "names")
    with pytest.raises(FileNotFoundError, match="not found"):
        read_lake(spark, str(tmp_path / "akas"), "akas")
