"""Run every registered query on Spark and its oracle SQL on DuckDB; compare.

Usage: ``python tests/oracle_compare.py [sf_dir] [key ...]``. Compares row
count, column names and an order-insensitive multiset of rows (floats are
compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records) -> Counter:
    return Counter(tuple(_norm(v) for v in r) for r in records)


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duckdb_connection(sf_dir)
    t0 = time.perf_counter()
    df = E.queries()[key](spark, sf_dir)
    spark_cols = df.columns
    order = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    spark_rows = [tuple(r[i] for i in order) for r in df.collect()]
    t1 = time.perf_counter()
    result = {"key": key, "spark_sec": round(t1 - t0, 3), "spark_rows": len(spark_rows)}
    sql = E.oracle_sql().get(key)
    if sql is None:
        result["oracle"] = "none"
        return result
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    dorder = sorted(range(len(duck_cols)), key=lambda i: duck_cols[i])
    duck_rows = [tuple(r[i] for i in dorder) for r in cur.fetchall()]
    result["oracle_rows"] = len(duck_rows)
    result["columns_match"] = sorted(spark_cols) == sorted(duck_cols)
    if not result["columns_match"]:
        result["spark_cols"] = sorted(spark_cols)
        result["oracle_cols"] = sorted(duck_cols)
    a, b = _rows(spark_rows), _rows(duck_rows)
    result["values_match"] = a == b
    if a != b:
        result["only_spark"] = list((a - b).elements())[:3]
        result["only_oracle"] = list((b - a).elements())[:3]
    result["ok"] = (
        result["columns_match"] and result["values_match"]
        and len(spark_rows) == len(duck_rows)
    )
    return result


def main(argv: list[str]) -> int:
    from marquee.session import build_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb_connection(sf_dir)
    bad = 0
    for key in keys:
        try:
            r = compare(spark, sf_dir, key, con)
        except Exception as exc:  # report and continue
            r = {"key": key, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += 0 if r.get("ok") else 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
