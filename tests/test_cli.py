from __future__ import annotations

import uuid

from marquee.cli import main
from marquee.session import scratch_path


def test_cli_etl_serve_report(spark, raw_dir, capsys, tmp_path):
    lake = scratch_path(spark, "cli-lake")
    assert main(["etl", "--raw", str(raw_dir), "--lake", lake]) == 0
    assert "principals" in capsys.readouterr().out
    db = f"cli_{uuid.uuid4().hex[:8]}"
    assert main(["serve", "--lake", lake, "--database", db,
                 "--location", scratch_path(spark, "cli-db")]) == 0
    assert main(["report", "--database", db, "--only", "top_regions"]) == 0
    out = capsys.readouterr().out
    assert "== top_regions" in out and "Unknown" in out
    assert main(["report", "--lake", lake, "--only", "top_rated_by_decade"]) == 0
    assert "Alpha" in capsys.readouterr().out
    for method in ("bounded", "percentile", "approx"):
        assert main(["report", "--lake", lake, "--only", "runtime_by_genre", "--median", method]) == 0
        assert "== runtime_by_genre" in capsys.readouterr().out
    assert main(["etl", "--raw", str(tmp_path), "--lake", lake]) == 1
