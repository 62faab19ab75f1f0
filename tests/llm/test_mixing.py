from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.llm.mixing import mix, mix_documents, mix_report, source_targets


def sizes(rows):
    return {d: len((t or "").split()) for d, t in rows}


def test_targets():
    got = source_targets([("a", 100), ("b", 10), (None, 90), ("c", 0)])
    assert [x[0] for x in got] == ["a", "b", "c", None]
    by = {s: t for s, _, t in got}
    assert by["b"] == 30 and by["c"] == 0
    # the excess is shared by weight among a (1) and null (1, the fourth)
    assert by["a"] == pytest.approx(85) and by[None] == pytest.approx(85)
    assert sum(by.values()) == pytest.approx(200)
    assert source_targets([]) == []


@pytest.mark.parametrize("block_words", [1, 7, 128])
def test_totals_and_limits(documents, block_words):
    got = mix_report(documents, block_words=block_words).collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert len(got) == documents.count()
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


def test_reruns_agree_and_segments_fill_slots_once(documents):
    assert sorted(map(str, mix_report(documents).collect())) == sorted(map(str, mix_report(documents).collect()))
    _, segments = mix(documents, block_words=8, shard_slots=16)
    rows = segments.collect()
    slot_words = Counter()
    for r in rows:
        slot_words[r.shard, r.position] += r.words
    assert max(slot_words.values()) <= 8
    per_shard = {}
    for shard, position in slot_words:
        per_shard.setdefault(shard, set()).add(position)
    assert all(p == set(range(len(p))) for p in per_shard.values())   # positions are gapless
    assert len({(r.key, r.turn, r.first_word) for r in rows}) == len(rows)


def test_documents(documents, rows):
    got = mix_documents(documents, block_words=16).collect()
    text = dict(rows)
    report = {r.doc_id: r.taken for r in mix_report(documents, block_words=16).collect()}
    taken = Counter()
    for r in got:
        words = (r.text or "").split()
        taken[r.doc_id] += len(words)
        assert r.n_chars == len(r.text)
        if len(words) == len(text[r.doc_id].split()):
            assert r.text == text[r.doc_id]
        else:
            assert set(words) <= set(text[r.doc_id].split())
    assert {d: n for d, n in report.items() if n} == dict(taken)


def test_shapes(empty, clashing, with_nulls, documents):
    assert mix_report(empty).count() == 0
    assert mix_documents(empty).count() == 0
    assert mix_report(with_nulls).count() == with_nulls.count()
    assert sorted(map(str, mix_report(clashing).collect())) == sorted(map(str, mix_report(documents).collect()))
    assert mix_documents(clashing).columns == clashing.columns


def test_plan_has_no_python(documents):
    plan = mix_report(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shards_are_draws_of_both_sources(workers):
    """Two equal sources over 131,072 slots: every shard has its share of both,
    and the spread of the counts is that of a draw."""
    from marquee.llm.mixing import mix_slots, plan_sources

    words = 131_072 * 64
    sizes = workers.createDataFrame([("a", words), ("b", words)], "source string, size long")
    sources = plan_sources(workers, sizes, weights=(1,))
    chosen = mix_slots(sources, 2 * words).cache()
    counts = {(r["shard"], r["rank"]): r["n"] for r in chosen.groupBy("shard", "rank").count().withColumnRenamed("count", "n").collect()}
    assert sum(counts.values()) == 131_072 and len(counts) == 2 * 128
    mean = 512
    deviation = (sum((n - mean) ** 2 for n in counts.values()) / len(counts)) ** 0.5
    assert all(380 < n < 640 for n in counts.values())
    assert 0.7 < deviation / mean ** 0.5 < 1.3
    # every block of both sources once, listed in several tasks
    assert chosen.select("rank", "block").distinct().count() == 131_072


def test_slots_are_listed_by_many_tasks(workers):
    from marquee.llm.mixing import plan_sources, slots

    sources = plan_sources(workers, workers.createDataFrame([("a", 10 ** 8)], "source string, size long"))
    listed = slots(sources, 32)
    sizes = [r["n"] for r in listed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) >= 10 ** 8 // 128 and len(sizes) > 20 and max(sizes) < sum(sizes) / 5


def test_rows_with_null_or_shared_ids_are_mixed_each_for_itself(workers):
    texts = [" ".join(f"{name}{i}" for i in range(n)) for name, n in (("x", 300), ("y", 500), ("z", 700))]
    for ids in ([None] * 3, [7] * 3, [1, 2, 3]):
        rows = [(d, t, "s") for d, t in zip(ids, texts)] + [(9, "w " * 8_000, "other")]
        docs = workers.createDataFrame(rows, "doc_id long, text string, source string")
        report = mix_report(docs, weights=(1, 11), share=0.8).collect()
        out = mix_documents(docs, weights=(1, 11), share=0.8).where("source = 's'").collect()
        mixed = Counter()
        for r in out:
            mixed[r.text[0]] += len(r.text.split())
        # the stage takes of each text what the report says it takes
        assert sorted(mixed.values()) == sorted(r.taken for r in report if r.doc_id != 9 and r.taken)
        assert set(w for r in out for w in r.text.split()) <= {w for t in texts for w in t.split()}
        target = next(r.target for r in report if r.doc_id != 9)
        assert abs(sum(mixed.values()) - target) <= 1


def test_a_hot_row_is_spread_over_chunks(workers):
    rows = workers.range(6_000).selectExpr("cast(null as long) as doc_id", "'one two three' as text", "'s' as source")
    placed, _ = mix(rows)
    assert placed.groupBy("chunk").count().agg(F.max("count")).first()[0] < 1_200
    assert placed.select("start").distinct().count() == 6_000


def test_clashing_names(clashing, documents):
    names = ("key", "_key", "_id", "_taken", "_size", "_spans", "turn", "rank", "mark")
    odd = clashing
    for n in names:
        odd = odd.withColumn(n, F.lit("clash"))
    got = mix_documents(odd, block_words=16).select(*documents.columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, mix_documents(documents, block_words=16).collect()))
