import random
import re
from collections import Counter

import pytest

from marquee.llm.components import connected_components
from marquee.llm.jaccard_join import near_duplicates
from .conftest import sentence

LOWER = {i: i + 32 for i in range(65, 91)}


def sets(rows):
    out = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute(rows):
    shingles = sets(rows)
    parent = {d: d for d in shingles}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(shingles)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = shingles[a], shingles[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(shingles[d]), find(d)) for d in ids}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_brute_force(documents, rows):
    want = brute(rows)
    assert answer(near_duplicates(documents)) == want
    assert max(Counter(c for _, c in want.values()).values()) > 5


@pytest.mark.parametrize("seed", range(4))
def test_chains_and_borderline_similarity(workers, seed):
    """Copies of copies: links that no hub holds, and pairs around 0.8."""
    rng = random.Random(seed)
    texts = []
    for _ in range(6):
        words = sentence(rng, rng.randrange(8, 70)).split()
        for _ in range(15):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(0, 3)] = [f"y{rng.randrange(99)}"] * rng.randrange(0, 3)
    rows = list(enumerate(texts))
    frame = workers.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answer(near_duplicates(frame)) == brute(rows)


def test_shapes(empty, clashing, with_nulls, documents, rows):
    assert near_duplicates(empty).count() == 0
    assert answer(near_duplicates(clashing)) == brute(rows)
    got = near_duplicates(with_nulls).collect()
    assert len(got) == with_nulls.count()
    alone = [r for r in got if r.doc_id is None]
    assert len(alone) == 2 and all(r.component_id is None for r in alone)


def test_components(workers):
    rng = random.Random(1)
    links = [(rng.randrange(-50, 200), rng.randrange(-50, 200)) for _ in range(120)] + [(i, i + 1) for i in range(1_000, 1_060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.label for r in connected_components(workers.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert connected_components(workers.createDataFrame([], "a long, b long")).count() == 0


def test_texts_that_share_an_id_are_verified_with_their_own(workers):
    """Ids 0-19 name two different texts each; both have a near copy."""
    rng = random.Random(12)
    rows = []
    for i in range(20):
        a, b = sentence(rng, 60, 50_000), sentence(rng, 60, 50_000)
        rows += [(i, a), (i, b), (100 + i, a + " tail"), (200 + i, b + " tail")]
    frame = workers.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in near_duplicates(frame).collect()}
    assert got == {(k + i, i) for i in range(20) for k in (0, 100, 200)}


def test_verification_takes_token_lists_in_small_batches(spark, workers, monkeypatch):
    # 700 near copies of one text meet it: their sets come a few hundred at a time
    from marquee.llm import jaccard_join as J

    real, rng = J._verify_batches, random.Random(5)

    def strict(percent):
        inner = real(percent)

        def run(batches):
            def bounded():
                for batch in batches:
                    assert batch.num_rows <= 256, batch.num_rows
                    yield batch

            yield from inner(bounded())

        return run

    monkeypatch.setattr(J, "_verify_batches", strict)
    first = sentence(rng, 120).split()
    rows = [(0, " ".join(first))] + [(i, " ".join([*first, f"own{i}"])) for i in range(1, 701)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs.repartition(2)).collect()
    assert len(got) == 701 and {r["component_id"] for r in got} == {0}
