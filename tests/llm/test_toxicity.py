import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import toxicity as T
from .conftest import sentence

STEMS = ("zorgul", "mekkfa", "trubbix")


def corpus(n=600, seed=4):
    rng = random.Random(seed)
    docs = []
    for d in range(n):
        words = sentence(rng, rng.randrange(5, 400), 800).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(STEMS) + rng.choice(["", "a", "en", "ix", "s."]) + str(rng.randrange(3)))
        docs.append((d, " ".join(words), toxic))
    return docs


@pytest.fixture(scope="module")
def model():
    docs = corpus()
    return T.train(pa.array([t for _, t, _ in docs]), np.array([y for _, _, y in docs]))


def test_held_out_accuracy_and_unseen_spellings(model):
    fresh = corpus(300, seed=9)
    scores = T._scores(model, pa.array([t for _, t, _ in fresh]))
    truth = np.array([y for _, _, y in fresh])
    assert (scores[truth == 1] >= 0.3).mean() >= 0.95
    assert (scores[truth == 0] < 0.3).mean() >= 0.98
    rng = random.Random(1)
    odd = [sentence(rng, 40, 800) + f" {s}qq " + sentence(rng, 40, 800) for s in STEMS]
    assert (T._scores(model, pa.array(odd)) >= 0.3).all()


def test_long_repeated_and_empty_texts(model):
    rng = random.Random(2)
    long = sentence(rng, 60_000, 800)
    far = long[: len(long) // 2] + " zorgulen1 " + long[len(long) // 2 :]
    got = T._scores(model, pa.array([None, "", "  \n", long, far, "w1 " * 500]))
    assert got[0] == got[1] == got[2]
    assert got[3] < 0.3 <= got[4]
    assert got[5] < 0.3 and ((got >= 0) & (got <= 1)).all()


def test_training_is_repeatable_and_degenerate_labels():
    texts, y = pa.array(["a b c zorgul", "d e f", "g h i"] * 4), np.array([1, 0, 0] * 4)
    a, b = T.train(texts, y, epochs=1), T.train(texts, y, epochs=1)
    assert np.array_equal(a.gram_logit, b.gram_logit) and a.bias == b.bias
    assert T._scores(T.train(pa.array([], pa.string()), np.zeros(0, int)), pa.array(["x"]))[0] < 0.01
    assert T._scores(T.train(texts, np.ones(12, int)), pa.array(["x"]))[0] > 0.9


def test_report_contract(workers, with_nulls, empty, clashing):
    docs = corpus(200)
    frame = workers.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string").repartition(4)
    labels = workers.createDataFrame([(d, 1, y) for d, _, y in docs] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.toxicity_report(frame, labels).collect()}
    assert len(got) == 200
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3)
    # held-out labels change nothing
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    again = {r.doc_id: r.score for r in T.toxicity_report(frame, other).collect()}
    assert again == {d: r.score for d, r in got.items()}
    assert T.toxicity_report(empty, labels).count() == 0
    assert T.toxicity_report(with_nulls, labels.limit(0)).count() == with_nulls.count()
    out = T.score_documents(clashing, T.train_on_labels(clashing, labels))
    assert sorted(out.columns) == sorted(clashing.columns) and out.count() == clashing.count()


def test_sample_is_bounded(workers):
    docs = corpus(200)
    frame = workers.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string")
    labels = workers.createDataFrame([(d, y) for d, _, y in docs], "doc_id long, toxic int")
    texts, classes = T.training_sample(frame, labels, 5, 7)
    assert len(texts) == 12 and classes.sum() == 5
