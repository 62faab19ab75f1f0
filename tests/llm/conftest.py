"""Fixtures of the text operators: small corpora with every awkward shape."""

from __future__ import annotations

import random

import pytest

from marquee.llm._frames import importable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def workers(spark):
    importable(spark)
    return spark


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, periodic, empty and null texts."""
    rng = random.Random(5)
    base = sentence(rng, 90)
    passage = sentence(rng, 70)
    texts = [None, "", "   \n\t", "one", "One", "one two three", "a\x0bb", "ab", base, base, base.upper(), base + " tail"]
    for i in range(12):  # near copies of the base
        words = base.split()
        words[rng.randrange(len(words))] = f"x{i}"
        texts.append(" ".join(words))
    for i in range(10):  # a passage in different surroundings
        texts.append(sentence(rng, 30 + i) + "\n" + passage + " " + sentence(rng, 20))
    texts += ["is onhe. " * 60, "is onhe. " * 61, "x" * 150, "xyz" * 80, "é" * 120, "né " * 100]
    texts += [sentence(rng, rng.randrange(1, 300)) for _ in range(30)]
    texts.append(sentence(rng, 9_000))
    sources = ["b", "a", None, "c", "é"]
    return [(i * 3 % 101 + 100 * (i // 101), t, "en", sources[i % 5] if i % 3 else "a", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(workers):
    return workers.createDataFrame(corpus(), DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def rows(documents):
    return sorted(((r["doc_id"], r["text"]) for r in documents.collect()), key=lambda x: x[0])


@pytest.fixture(scope="session")
def empty(workers):
    return workers.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    out = documents
    for name in ("score", "predicted", "key", "size", "chunk", "block", "seed", "label", "shard", "slot", "norm", "n", "component_id", "start", "words"):
        out = out.withColumn(name, F.lit("clash"))
    return out


@pytest.fixture(scope="session")
def with_nulls(documents, workers):
    """Repeated rows and rows with null in every column."""
    repeated = documents.limit(5)
    nulls = workers.createDataFrame([(None, None, None, None, None), (None, "alone here", None, None, 3)], DOCUMENTS)
    return documents.unionByName(repeated).unionByName(nulls).cache()
