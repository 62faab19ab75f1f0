"""The registered text queries over the sf0.01 tables."""

import re
import zlib

import pytest

import __spark_entry__ as E
import corpus_pipeline
from marquee.llm.queries import ORACLE_SQL, QUERIES
from oracle_compare import compare, duckdb_connection

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert E.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(workers, con, key):
    result = compare(workers, SF, key, con)
    assert result["ok"], result


def rows_of(workers):
    return [(r.doc_id, r.text) for r in workers.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_op1_over_whole_tables(workers):
    from .test_lm_scoring import brute

    want = brute(rows_of(workers))
    got = {r.doc_id: r for r in QUERIES["op1_lm_scoring"](workers, SF).collect()}
    assert got.keys() == want.keys()
    for d, (n, known, total, base) in want.items():
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (n, known, total)
        assert got[d].base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op2_finds_all_exact_passages(workers):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontamination"](workers, SF).collect()}
    items = [(r.item_id, " ".join(r.text.split()).lower()) for r in workers.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for d, t in rows_of(workers):
        flat = " ".join((t or "").split()).lower()
        for i, item in items:
            if item in flat:
                assert (d, i) in got


def test_op5_matches_brute_force(workers):
    from .test_suffix_dedup import brute

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_dedup"](workers, SF).collect()}
    assert got == brute(sorted(rows_of(workers)))


def test_op6_contract(workers):
    got = QUERIES["op6_toxicity"](workers, SF).collect()
    assert len(got) == len(rows_of(workers))
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_op9_and_op10_contracts(workers):
    mixed = QUERIES["op9_mixing"](workers, SF).collect()
    assert all(0 <= r.taken <= 3 * r["size"] for r in mixed)
    total = sum(r["size"] for r in mixed)
    assert sum(r.taken for r in mixed) == pytest.approx(total, rel=0.001)
    shards = QUERIES["op10_kd_sharding"](workers, SF).toPandas()
    weight = shards.groupby("shard")["size"].sum()
    assert len(weight) == 16 and weight.max() < 1.2 * weight.mean()


@pytest.mark.parametrize("key", ["op7_exact_dedup", "op9_mixing"])
def test_native_queries_run_no_python(workers, key):
    plan = QUERIES[key](workers, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan)
