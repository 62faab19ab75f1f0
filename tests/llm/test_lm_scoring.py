import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marquee.llm import lm_scoring as L
from .conftest import sentence

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def brute(rows):
    """Base scores by the contract; the end is a token of its own."""
    counts = Counter()
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 10:
            counts.update(words(t))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        tokens = [*words(t), None]
        out[d] = (len(tokens), sum(counts[w] > 0 for w in tokens), n,
                  sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
    return out


def test_base_scores_match_brute_force(documents, rows):
    want = brute(rows)
    got = {r.doc_id: r for r in L.lm_report(documents).collect()}
    assert set(got) == set(want)
    for d, (n, known, total, base) in want.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert -20 * n < r.score < 0


def languages(n=400):
    """Texts of two languages: the words before tell which."""
    import random

    rng, out = random.Random(3), []
    for d in range(n):
        tag = "ab"[rng.randrange(2)]
        out.append((d, " ".join(f"{tag}{min(int(rng.expovariate(0.05)), 200)}{tag}" for _ in range(rng.randrange(5, 120)))))
    return out


def test_held_out_text_is_better_predicted_than_by_counts(workers):
    frame = workers.createDataFrame(languages(), "doc_id long, text string").repartition(4)
    got = [r for r in L.lm_report(frame).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / tokens > sum(r.base_score for r in got) / tokens + 0.1


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    vocab = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), rng.integers(1, 9, L.CLASSES), np.ones(L.CLASSES, np.int64), 9, 9)
    model = L._shaped(L.initial_model(vocab).flat() + rng.normal(0, 0.5, len(L.initial_model(vocab).flat())))
    for context in ([3, 4], [L.CLASSES, L.CLASSES], [L.END, 500]):
        c = np.repeat([context], L.CLASSES, axis=0)
        total = (10 ** L.class_log_probabilities(model, c, np.arange(L.CLASSES))).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_noise_contrastive_training_approaches_the_distribution():
    """On one context the model learns the relative frequencies of its words."""
    rng = np.random.default_rng(1)
    count = np.full(L.CLASSES, 5)
    vocab = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), count, np.ones(L.CLASSES, np.int64), int(count.sum()), L.CLASSES)
    model = L._shaped(L.initial_model(vocab).flat())
    squares = [np.full_like(x, 1e-4) for x in (model.context, model.place, model.output, model.bias[:, None])]
    target = rng.choice([1, 2, 3], 200_000, p=[0.6, 0.3, 0.1])
    L.train_slice(model, squares, np.zeros((len(target), L.CONTEXT), np.int64), target, L._noise(vocab), rng)
    p = 10 ** L.class_log_probabilities(model, np.zeros((3, L.CONTEXT), np.int64), np.array([1, 2, 3]))
    assert p[0] > p[1] > p[2] > 0.02 and p.sum() > 0.7


def test_contexts_stop_at_texts():
    data = np.frombuffer(b"a b cd", dtype=np.uint8)
    hashes, _, head = L.tokens(data, np.array([0, 3, 6]))
    assert head.tolist() == [0, 3, 5] and (hashes[[2, 4]] == L.END_WORD).all()
    got = L.contexts(np.arange(5), head)
    none = L.CLASSES
    assert got.tolist() == [[none, none], [0, none], [1, 0], [none, none], [3, none]]


def test_shapes(empty, clashing, with_nulls, documents):
    assert L.lm_report(empty).count() == 0
    got = L.lm_report(with_nulls).collect()
    assert len(got) == with_nulls.count()
    blank = [r for r in got if r.n_tokens == 1]
    assert len(blank) >= 3
    assert all(r.score == pytest.approx(blank[0].score, rel=1e-5) for r in blank)  # 32-bit products
    assert L.lm_report(clashing).count() == documents.count()


def test_long_text_and_blocks(workers):
    import random

    rng = random.Random(0)
    rows = [(d, sentence(rng, 30)) for d in range(60)] + [(60, sentence(rng, 300_000, 50_000))]
    frame = workers.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learn = frame.where(~L.held_out(frame.doc_id))
    counts = L.count_words(learn)
    vocab = L.vocabulary(counts)
    model = L.initial_model(vocab)
    want = {r.doc_id: r.base_score for r in L.score_documents(frame, model, vocab, counts).collect()}
    small = {r.doc_id: r.base_score for r in L.score_documents(frame, model, vocab, counts, block_bytes=1_000).collect()}
    assert want.keys() == small.keys() and all(small[d] == pytest.approx(want[d]) for d in want)
    true = brute(rows)
    assert all(want[d] == pytest.approx(true[d][3]) for d in want)


def test_a_text_is_trained_on_once_an_epoch_at_any_size(monkeypatch):
    """The size of the corpus changes neither the passes nor the model."""
    from types import SimpleNamespace

    import pyarrow as pa

    texts = pa.RecordBatch.from_arrays([pa.array(["a b c a", "b c"] * 50)], ["text"])
    calls, real = [], L.train_slice
    monkeypatch.setattr(L, "train_slice", lambda *a, **b: (calls.append(len(a[3])), real(*a, **b)))
    got = []
    for total in (9, 10**9):
        count = np.full(L.CLASSES, 5)
        vocab = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), count, np.ones(L.CLASSES, np.int64), total, L.CLASSES)
        model = L.initial_model(vocab)
        batch, = L._class_batches(SimpleNamespace(value=vocab))([texts])
        shared = SimpleNamespace(value=(L._flat_state(model, L.initial_squares(model)), L._noise(vocab)))
        out, = L._train_batches(shared, 0)([batch])
        got.append(np.concatenate([x.values.to_numpy() for x in out["numbers"]]))
    assert calls == [8 * 50, 8 * 50]
    assert (got[0] == got[1]).all()


def test_long_texts_do_not_gather_in_a_block(workers, monkeypatch):
    """A run of long texts in one file is cut by bytes."""
    from marquee.llm import lm_scoring as L

    seen = []

    def catching(self, other):
        seen.append((self, other))
        return original(self, other)

    from pyspark.sql.group import GroupedData

    original = GroupedData.cogroup
    rows = [(i, "w " * (20 if i % 50 else 3_000)) for i in range(1_000)] + [(2_000 + i, "v " * 30_000) for i in range(40)]
    docs = workers.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    counts = L.count_words(docs)
    vocab = L.vocabulary(counts)
    monkeypatch.setattr(GroupedData, "cogroup", catching)
    out = L.score_documents(docs, L.initial_model(vocab), vocab, counts, block_bytes=100_000)
    assert out.count() == len(rows)
    dealt = seen[0][0]._df
    sizes = [r["b"] for r in dealt.selectExpr("block", "length(text) as b").groupBy("block").sum("b").withColumnRenamed("sum(b)", "b").collect()]
    assert max(sizes) <= L.LONG * 100_000 and sum(sizes) == sum(len(t) for _, t in rows)


def test_words_of_blocks_are_dealt_once_for_distinct_and_join(spark, workers):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(3)
        docs = spark.createDataFrame([(i, sentence(rng, 20)) for i in range(50)], "doc_id long, text string")
        counts = L.count_words(docs)
        vocab = L.vocabulary(counts)
        scored = L.score_documents(docs, L.initial_model(vocab), vocab, counts)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(word#\d+L", plan)
        assert not re.search(r"hashpartitioning\(block#\d+L, word#\d+L", plan)
        assert scored.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plain_step(model, squares, c, w, drawn, noise):
    """A step of noise-contrastive estimation as its formulas stand."""
    m, k_noise = len(w), np.log(L.NOISE * noise)
    vectors = model.context[c]
    predicted = (vectors * model.place).sum(1)
    g_true = -1 / (1 + np.exp((predicted * model.output[w]).sum(1) + model.bias[w] - k_noise[w])) / m
    g_fake = 1 / (1 + np.exp(-(predicted @ model.output[drawn].T + model.bias[drawn] - k_noise[drawn]))) / m
    back = g_true[:, None] * model.output[w] + g_fake @ model.output[drawn]
    grads = [np.zeros(x.shape) for x in squares]
    np.add.at(grads[0], c, back[:, None, :] * model.place)
    grads[1] += (vectors * back[:, None, :]).sum(0)
    np.add.at(grads[2], w, g_true[:, None] * predicted)
    np.add.at(grads[2], drawn, g_fake.T @ predicted)
    np.add.at(grads[3], w, g_true[:, None])
    np.add.at(grads[3], drawn, g_fake.sum(0)[:, None])
    for x, square, g in zip((model.context, model.place, model.output, model.bias[:, None]), squares, grads):
        square += g * g
        x -= L.PACE * g / np.sqrt(square)


def test_steps_follow_the_formulas():
    """Also the last step, which is shorter, and logits of any size."""
    rng = np.random.default_rng(4)
    count = rng.integers(1, 99, L.CLASSES)
    vocab = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), count, np.ones(L.CLASSES, np.int64), int(count.sum()), L.CLASSES)
    noise, n = L._noise(vocab), 3 * L.BATCH + 77
    target, context = rng.integers(0, L.CLASSES, n), rng.integers(0, L.CLASSES + 1, (n, L.CONTEXT))
    start = L.initial_model(vocab).flat()
    start[L.CLASSES * L.DIMENSIONS] = 2000
    got, want = L._shaped(start), L._shaped(start)
    squares, plain = L.initial_squares(got), L.initial_squares(want)
    L.train_slice(got, squares, context, target, noise, np.random.default_rng(6))
    again = np.random.default_rng(6)
    order = again.permutation(n)
    for at in range(0, n, L.BATCH):
        drawn = np.minimum(np.searchsorted(np.cumsum(noise), again.random(L.NOISE)), L.CLASSES - 1)
        with np.errstate(over="ignore"):
            plain_step(want, plain, context[order[at : at + L.BATCH]], target[order[at : at + L.BATCH]], drawn, noise)
    assert np.abs(got.flat() - want.flat()).max() < 1e-4 < np.abs(got.flat() - start).max()
    assert all(a.shape == b.shape and np.allclose(a, b, rtol=1e-3, atol=1e-7) for a, b in zip(squares, plain))


def test_normalisers_are_taken_from_the_model_once():
    """Scoring looks logits and normalisers up; no text computes them again."""
    rng = np.random.default_rng(2)
    vocab = L.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), rng.integers(1, 9, L.CLASSES), np.ones(L.CLASSES, np.int64), 9, 9)
    model = L._shaped(L.initial_model(vocab).flat() + rng.normal(0, 0.5, len(L.initial_model(vocab).flat())))
    context, target = rng.integers(0, L.CLASSES + 1, (300, L.CONTEXT)), rng.integers(0, L.CLASSES, 300)
    tables = L.logit_tables(model)
    logits = (model.context[context].astype(float) * model.place).sum(1) @ model.output.T + model.bias
    want = (logits[np.arange(300), target] - np.log(np.exp(logits).sum(1))) / np.log(10)
    model.context[:] = model.output[:] = 0
    assert np.allclose(L.class_log_probabilities(model, context, target, tables), want, atol=1e-4)


def test_counts_of_words_in_any_order():
    known = np.array([3, 5, 2**63 + 1], dtype=np.uint64)
    words = np.array([2**63 + 1, 4, 3, 3, 2**64 - 1, 0], dtype=np.uint64)
    assert L._counts_of(words, known, np.array([7, 8, 9])).tolist() == [9, 0, 7, 7, 0, 0]
    assert L._counts_of(words, known[:0], np.zeros(0, np.int64)).tolist() == [0] * 6
