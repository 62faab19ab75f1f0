import hashlib
import re

import pytest
from pyspark.sql import functions as F

from marquee.llm import exact_dedup as X
from marquee.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((d, t or ""))
    out = {}
    for norm, members in groups.items():
        keep = max(members, key=lambda m: (len(m[1]), -m[0]))[0]
        for d, _ in members:
            out[d] = (keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


def answer(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_matches_brute_force(documents, rows):
    assert answer(exact_dedup(documents)) == brute(rows)


def colliding(c):
    """Four keys for all texts."""
    return F.pmod(F.xxhash64(c), F.lit(4)) * F.lit(1 << 61)


def indexed(documents, capacity, key=F.xxhash64):
    cells, deepest = X.directory(X.probes(documents, key), capacity)
    return X.chains(documents, cells, deepest, key)


@pytest.mark.parametrize("capacity", [1, 2, 4])
def test_splitting_and_colliding_keys(documents, rows, capacity):
    assert answer(exact_dedup(documents, capacity=capacity, key=colliding)) == brute(rows)
    assert answer(exact_dedup(documents, capacity=capacity)) == brute(rows)


def test_buckets_split_until_none_is_overfull(documents):
    index = indexed(documents, 4)
    held = index.groupBy("depth", "bucket").agg(F.countDistinct("key").alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 4
    assert held.count() > 4
    low = lambda c: F.pmod(F.xxhash64(c), F.lit(8))  # noqa: E731  keys that differ in their last bits only
    deep = indexed(documents, 2, low).groupBy("depth", "bucket").agg(F.countDistinct("key").alias("n")).collect()
    assert max(r.n for r in deep) <= 2 and max(r.depth for r in deep) >= 62


def test_texts_of_one_key_are_links_of_one_chain(documents, rows):
    index = indexed(documents, 4, colliding).collect()
    want = {h for _, _, _, h in brute(rows).values()}
    assert len(index) == len(want) and {r.text_sha256 for r in index} == want
    for k in {r.key for r in index}:
        chain = [r for r in index if r.key == k]
        assert sorted(r.chain_pos for r in chain) == list(range(1, len(chain) + 1)) and len(chain) > 1
        assert len({(r.depth, r.bucket) for r in chain}) == 1


def test_the_directory_decides(documents, rows, monkeypatch):
    """Rows meet only in the bucket that the directory names: one that sends
    part of a key's cells nowhere loses their documents."""
    real = X.directory

    def short(keyed, capacity):
        cells, deepest = real(keyed, capacity)
        return cells.where("bucket % 2 = 0"), deepest

    monkeypatch.setattr(X, "directory", short)
    got = answer(exact_dedup(documents, capacity=4))
    want = brute(rows)
    assert 0 < len(got) < len(want) and all(want[d] == r for d, r in got.items())


def test_shapes(empty, clashing, with_nulls, rows, documents):
    assert exact_dedup(empty).count() == 0
    assert answer(exact_dedup(clashing)) == brute(rows)
    got = exact_dedup(with_nulls).collect()
    assert len(got) == with_nulls.count()
    null_rows = [r for r in got if r.doc_id is None]
    assert len(null_rows) == 2
    blank = hashlib.sha256(b"").hexdigest()
    assert all(r.keep_id is not None for r in got if r.text_sha256 == blank)


def test_plan_has_no_python(documents):
    plan = exact_dedup(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
