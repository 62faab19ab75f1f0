"""Vector codes: the memo against all entries, whole runs by brute force, odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from marquee.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v string, error string"


def nearest(part, entries):
    d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in entries]
    return min(range(len(d)), key=lambda i: (d[i], i)), min(d)


@pytest.mark.parametrize("side", [1, 8, 64, 100_000])
def test_memo_equals_all_entries(side):
    rng = np.random.default_rng(side)
    entries = rng.integers(-300, 300, (40, 5))
    entries[7] = entries[3]                       # ties
    parts = np.concatenate((rng.integers(-400, 400, (500, 5)), entries, entries + 1, np.zeros((30, 5), dtype=np.int64)))
    memo = V.CellMemo(entries, side, capacity=64)
    for piece in (parts, parts[::-1]):
        index, distance = memo.nearest(np.ascontiguousarray(piece))
        want = [nearest(p, entries.tolist()) for p in piece.tolist()]
        assert list(zip(index.tolist(), distance.tolist())) == want
    if side == 8:
        assert memo.evaluated < 2 * len(parts) * len(entries) / 2   # most entries are never evaluated


def test_memo_at_the_limits():
    top = V._LIMIT
    entries = np.array([[-top, top], [top, -top], [0, 0]])
    parts = np.array([[top, top], [-top, -top], [1, -1], [top, -top]])
    index, distance = V.CellMemo(entries).nearest(parts)
    assert list(zip(index.tolist(), distance.tolist())) == [nearest(p, entries.tolist()) for p in parts.tolist()]


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in e], label) for i, e, label in rows
            if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == w * parts]
    cut = [[r[1][p * w:(p + 1) * w] for r in kept] for p in range(parts)]
    books = [[list(v) for v in c[:entries]] for c in cut]
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut[p]:
                groups.setdefault(nearest(v, books[p])[0], []).append(v)
            for e, vs in groups.items():
                books[p][e] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [[nearest(v, books[p]) for v in cut[p]] for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(found[p][i][1] for p in range(parts)) for i in range(len(kept))]
    per = {}
    for (_, _, label), e in zip(kept, errors):
        per[label] = per.get(label, 0) + e
    return [(r[0], "".join(f"{found[p][i][0]:02x}" for p in range(parts)), errors[i], per[r[2]], sha) for i, r in enumerate(kept)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def test_report_against_brute_force(workers):
    rng = random.Random(2)
    rows = [(i * 7 % 331, [rng.gauss(0, 0.2) for _ in range(8)], i % 3 or None) for i in range(331)]
    rows += [(500, rows[0][1], 1), (501, rows[0][1], 1), (501, rows[0][1], 1), (None, rows[4][1], None), (502, [0.0] * 8, 2)]
    rows += [(1, None, 1), (2, [], 1), (3, [None] + [0.1] * 7, 1), (4, [float("nan")] * 8, 1),
             (5, [float("inf")] + [0.0] * 7, 1), (6, [0.25] * 7, 1)]
    got = [tuple(r) for r in V.vector_code_report(frame(workers, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_fewer_vectors_than_entries_and_unused_entries(workers):
    rows = [(i, [0.1] * 8 if i else [1e9, -1e9] + [0.0] * 6, 0) for i in range(9)]
    got = [tuple(r) for r in V.vector_code_report(frame(workers, rows[1:])).collect()]
    assert sorted(got) == sorted(brute(rows[1:]))
    held = V.integer_vectors(frame(workers, rows)).where("vec_id = 0").first().v
    assert held[:2] == [V._LIMIT, -V._LIMIT]


def test_empty_and_unfit_tables(workers):
    assert V.vector_code_report(frame(workers, [])).collect() == []
    assert V.vector_code_report(frame(workers, [(1, None, 1)])).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        V.vector_code_report(frame(workers, [(1, [0.5] * 6, 1)]))
