"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character 3- to 5-grams (with word-end marks) and
itself; every gram is a row of a hashed embedding table. A segment (a run of
words) is the average of its words' gram vectors (a word that recurs counts once), a linear softmax turns it
into two class probabilities, and embeddings and softmax are trained jointly
in numpy, so a misspelling never seen shares the vectors of its grams. A
document is as toxic as its worst segment: one insult in 5,000 words would
vanish in a document average. Training is multiple-instance: a toxic document teaches by its worst
segment, a clean one by its worst and some random segments, chosen anew each
epoch; the first choice is by the grams' log odds, which one dimension of the
embeddings starts from.

Learning uses a bounded sample of labelled rows (``positive`` and ``negative``
rows, one per id, of at most ``sample_bytes`` of text for each class, chosen by
a hash of the id) and the same passes over it at every size; scoring reads every row
and whole text, in bounded slices, as a narrow pass without any shuffle. The
average before the softmax is linear, so each gram's row is folded into one
number before scoring; the folded table has ``2**BITS`` entries at any size.

Shapes of input: null, empty and blank texts have no words and get the score
of the bias alone; texts of any length are scored in segments; repeated rows
score alike; no usable labels give the base rate; empty tables give an empty
result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm.textbytes import LOWER, mix64, range_hashes, row_slices, text_buffers, word_bounds

BITS = 17
DIMENSIONS = 8
SEGMENT_WORDS = 12
GRAMS = (3, 4, 5)
THRESHOLD = 0.3
SAMPLE_POSITIVE = 2_000
SAMPLE_NEGATIVE = 4_000
SAMPLE_BYTES = 12 << 20   # of text, for each class
EPOCHS = 8
PACE = 0.1
START = 6.0
MIN_TEXTS = 3
SAMPLE_SLICE = 1 << 18   # bytes of the sample spelled at once
CHUNK = 1 << 15          # segments or words of the sample worked on at once
HELD_OUT = 2


@dataclass
class Model:
    """Folded model: a logit per gram bucket and the bias."""

    gram_logit: np.ndarray
    bias: float
    threshold: float = THRESHOLD


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def _gram_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word index) of every gram of the words.

    Words are laid out with a mark on both ends; a gram never crosses words.
    """
    lengths = ends - starts + 2
    first = np.concatenate(([0], np.cumsum(lengths)))
    total = int(first[-1])
    word = np.repeat(np.arange(len(starts)), lengths)
    place = np.arange(total) - first[word]
    laid = np.zeros(total, dtype=np.uint64)
    inner = (place > 0) & (place < lengths[word] - 1)
    laid[inner] = data[(starts[word] + place - 1)[inner]]
    laid[place == 0] = 1
    laid[place == lengths[word] - 1] = 2
    left = lengths[word] - place  # bytes from here to the word's end
    out_id, out_word = [], []
    packed = laid.copy()
    for n in range(2, min(max(GRAMS), total) + 1):
        packed[: total - n + 1] |= laid[n - 1 :] << np.uint64(8 * (n - 1))
        if n in GRAMS:
            here = np.flatnonzero(left[: max(total - n + 1, 0)] >= n)
            value = packed[here] & np.uint64((1 << (8 * n)) - 1)
            out_id.append(mix64(value + np.uint64(n << 56)) >> np.uint64(64 - BITS))
            out_word.append(word[here])
    out_id.append(hashes >> np.uint64(64 - BITS))
    out_word.append(np.arange(len(starts)))
    return np.concatenate(out_id).astype(np.int64), np.concatenate(out_word)


def _word_logits(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(average gram logit, place of the previous same word) of every word.

    Each distinct word is worked out once.
    """
    if len(starts) == 0:
        return np.zeros(0), np.zeros(0, dtype=np.int64)
    hashes = range_hashes(data, starts, ends)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    ids, word = _gram_ids(data, starts[first], ends[first], hashes[first])
    n = np.bincount(word, minlength=len(first))
    total = np.bincount(word, weights=model.gram_logit[ids], minlength=len(first))
    return (total / np.maximum(n, 1))[inverse], _previous(inverse)


def _previous(word: np.ndarray) -> np.ndarray:
    """Place of the previous occurrence of each word, -1 where there is none."""
    order = np.argsort(word, kind="stable")
    out = np.full(len(word), -1, dtype=np.int64)
    same = word[order[1:]] == word[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def _flat(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, segment) of every word of the given word ranges."""
    n = end - start
    segment = np.repeat(np.arange(len(start)), n)
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n), segment


def _segment_values(logits: np.ndarray, previous: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Average logit of each segment; a word that recurs in it counts once.

    Segments below half the usual length are averaged as if they had it.
    """
    place, segment = _flat(start, end)
    once = np.where(previous[place] < start[segment], logits[place], 0.0)
    return np.bincount(segment, once, len(start)) / np.maximum(end - start, SEGMENT_WORDS // 2)


def _segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start word, end word, row) of the segments; they overlap by half.

    ``first`` has the index of each row's first word and the total.
    """
    words = np.diff(first)
    half = SEGMENT_WORDS // 2
    n = np.where(words > 0, np.maximum(1, -(-(words - half) // half)), 0)
    row = np.repeat(np.arange(len(words)), n)
    index = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = first[row] + index * half
    return start, np.minimum(start + SEGMENT_WORDS, first[row + 1]), row


def _score_slice(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts, ends, first = word_bounds(data, offsets)
    logits, previous = _word_logits(model, data, starts, ends)
    out = np.full(len(offsets) - 1, model.bias)
    start, end, row = _segments(first)
    if len(row):
        value = model.bias + _segment_values(logits, previous, start, end)
        heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        out[row[heads]] = np.maximum.reduceat(value, heads)
    return out


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    data, offsets = text_buffers(column)
    out = np.empty(len(offsets) - 1)
    for i, j in row_slices(offsets):
        piece = LOWER[data[offsets[i] : offsets[j]]]
        out[i:j] = _score_slice(model, piece, offsets[i : j + 1] - offsets[i])
    return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


def score_documents(documents: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (0 or 1).

    Columns of those names in the input are replaced.
    """
    score, predicted = f"{prefix}score", f"{prefix}predicted"
    kept = [c for c in documents.columns if c not in (score, predicted)]
    table = documents.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    @F.pandas_udf("double")
    def toxic(text):
        import pandas as pd

        return pd.Series(_scores(table.value, pa.array(text, pa.string(), from_pandas=True)))

    scored = documents.select(*kept, toxic(F.col("text").cast("string")).alias(score))
    return scored.withColumn(predicted, F.when(F.col(score) >= model.threshold, 1).otherwise(0))


# ------------------------------------------------------------------ training


def training_sample(documents: DataFrame, labels: DataFrame, positive: int, negative: int,
                    sample_bytes: int = SAMPLE_BYTES):
    """(texts, classes) of at most ``positive`` + ``negative`` labelled rows and
    about ``sample_bytes`` of text for each class.

    The ids are chosen first, from the labels alone (which fixes the size), and
    sent to the documents, whose texts are not shuffled. An id stands for one
    row, that of the smallest text hash, however many rows share it, and a class
    takes its rows in the order of a hash until its bytes are spent.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    marked = marked.where("_id is not null and _toxic in (0, 1)").where(~held_out(F.col("_id")))
    marked = marked.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).withColumn("_h", F.xxhash64("_id"))
    chosen = marked.where("_toxic = 1").orderBy("_h", "_id").limit(positive).union(
        marked.where("_toxic = 0").orderBy("_h", "_id").limit(negative))
    # bounded by positive + negative rows of three numbers
    found = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")).join(
        F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("_id"))
    sized = found.select("_id", "_toxic", "_h", F.octet_length("_text").alias("_bytes"), F.xxhash64("_text").alias("_mark"))
    # one small row per id: which of its texts, and how many bytes come before it
    one = sized.groupBy("_id", "_toxic", "_h").agg(F.min(F.struct("_mark", "_bytes")).alias("_one"))
    spent = F.sum("_one._bytes").over(W.partitionBy("_toxic").orderBy("_h", "_id").rowsBetween(W.unboundedPreceding, 0))
    taken = one.withColumn("_spent", spent).where(F.col("_spent") <= sample_bytes).select("_id", F.col("_one._mark").alias("_mark"))
    texts = found.withColumn("_mark", F.xxhash64("_text")).join(F.broadcast(taken), ["_id", "_mark"])
    got = texts.groupBy("_id").agg(F.first("_text").alias("_text"), F.first("_toxic").alias("_toxic")).toArrow()
    got = got.sort_by([("_id", "ascending")])
    return got["_text"].combine_chunks(), got["_toxic"].to_numpy().astype(np.int64)


class _Sample:
    """Distinct words of the sample as gram lists; texts as word ids."""

    def __init__(self, texts: pa.Array, classes: np.ndarray):
        data, offsets = text_buffers(texts)
        hashes, known_words, first, words = [], set(), [np.zeros(1, dtype=np.int64)], 0
        spelled: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, j in row_slices(offsets, SAMPLE_SLICE):
            piece = LOWER[data[offsets[i] : offsets[j]]]
            starts, ends, head = word_bounds(piece, offsets[i : j + 1] - offsets[i])
            h = range_hashes(piece, starts, ends)
            new, where = np.unique(h, return_index=True)
            fresh = np.fromiter((x not in known_words for x in new.tolist()), bool, len(new))
            known_words.update(new[fresh].tolist())
            ids, word = _gram_ids(piece, starts[where[fresh]], ends[where[fresh]], new[fresh])
            order = np.argsort(word, kind="stable")
            spelled.append((new[fresh], ids[order].astype(np.int32), np.bincount(word, minlength=int(fresh.sum())).astype(np.int32)))
            hashes.append(h)
            first.append(head[1:] + words)
            words += len(starts)
        del known_words
        self._count = np.concatenate([x[2] for x in spelled]) if spelled else np.zeros(0, np.int32)
        every = np.concatenate([x[0] for x in spelled]) if spelled else np.zeros(0, np.uint64)
        order = np.argsort(every)
        ranked = every[order]
        self.word = np.concatenate([order[np.searchsorted(ranked, h)].astype(np.int32) for h in hashes]) if len(every) else np.zeros(0, np.int32)
        del hashes, ranked, order
        self.first = np.concatenate(first)
        # in how many texts, and in how many toxic ones, a distinct word stands
        texts_of, toxic_of = np.zeros(len(every), dtype=np.int64), np.zeros(len(every), dtype=np.int64)
        for row in range(len(classes)):
            own = np.unique(self.word[self.first[row] : self.first[row + 1]])
            texts_of[own] += 1
            toxic_of[own] += classes[row]
        # grams of fewer than MIN_TEXTS texts teach nothing general: left out
        spread, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
        at = 0
        for _, ids, count in spelled:
            spread += np.bincount(ids, np.repeat(texts_of[at : at + len(count)], count), 1 << BITS)
            toxic += np.bincount(ids, np.repeat(toxic_of[at : at + len(count)], count), 1 << BITS)
            at += len(count)
        ratio = max(toxic_of.sum(), 1.0) / max((texts_of - toxic_of).sum(), 1.0)
        # log odds of each gram by the texts that hold it
        self.odds = np.log((toxic + 1.0) / (ratio * (spread - toxic) + 1.0))
        kept, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, ids, count in spelled:
            known = spread[ids] >= MIN_TEXTS
            kept.append(ids[known])
            counts.append(np.bincount(np.repeat(np.arange(len(count)), count)[known], minlength=len(count)))
        del spelled
        self.gram_ids = np.concatenate(kept)
        self.gram_count = np.concatenate(counts).astype(np.int32)
        self.gram_first = np.concatenate(([0], np.cumsum(self.gram_count, dtype=np.int64)))
        self.previous = _previous(self.word).astype(np.int32)

    def word_values(self, per_gram: np.ndarray) -> np.ndarray:
        """Average of a per-gram number over each distinct word's grams."""
        out = np.zeros(len(self._count))
        for i in range(0, len(out), CHUNK):
            low, high = self.gram_first[i], self.gram_first[min(i + CHUNK, len(out))]
            run = np.concatenate(([0.0], np.cumsum(per_gram[self.gram_ids[low:high]])))
            edge = self.gram_first[i : i + CHUNK + 1] - low
            out[i : i + CHUNK] = run[edge[1:]] - run[edge[:-1]]
        return out / np.maximum(self._count, 1)

    def bag(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment, gram, weight) of the grams of the given word ranges."""
        place, segment = _flat(start, end)
        once = self.previous[place] < start[segment]
        place, segment = place[once], segment[once]
        word = self.word[place]
        grams = self.gram_count[word]
        words = np.maximum(end - start, SEGMENT_WORDS // 2)
        weight = np.repeat(1.0 / (words[segment] * np.maximum(self._count[word], 1)), grams)
        at = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams) + np.repeat(self.gram_first[word], grams)
        return np.repeat(segment, grams), self.gram_ids[at], weight


def train(texts: pa.Array, classes: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Joint training of embeddings and softmax by AdaGrad; deterministic."""
    size = 1 << BITS
    if len(classes) == 0:
        return Model(np.zeros(size), -30.0)
    rate = float(np.clip(classes.mean(), 1e-3, 1 - 1e-3))
    prior = float(np.log(rate / (1 - rate)))
    if classes.min() == classes.max():
        return Model(np.zeros(size), prior)
    rng = np.random.default_rng(seed)
    sample = _Sample(texts, classes)
    start, end, row = _segments(sample.first)
    toxic = classes[row]
    embed = rng.normal(0, 0.1, (size, DIMENSIONS))
    soft = rng.normal(0, 0.5, (DIMENSIONS, 2))
    # the first dimension starts from the grams' log odds, so that the first
    # choice of worst segments is an informed one
    embed[:, 0], soft[0] = sample.odds, (-START, START)
    bias = np.array([0.0, prior])
    square = np.full((size, DIMENSIONS), 1e-6)
    square_soft, square_bias = np.full((DIMENSIONS, 2), 1e-6), np.full(2, 1e-6)
    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)

    def step(chosen: np.ndarray, pace: float) -> None:
        nonlocal embed, soft, bias
        segment, gram, weight = sample.bag(start[chosen], end[chosen])
        mean = np.stack([np.bincount(segment, weight * embed[gram, d], len(chosen)) for d in range(DIMENSIONS)], 1)
        logits = mean @ soft + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(chosen)), toxic[chosen]] -= 1
        p /= len(chosen)
        back = p @ soft.T
        used, inverse = np.unique(gram, return_inverse=True)
        g = np.stack([np.bincount(inverse, weight * back[segment, d], len(used)) for d in range(DIMENSIONS)], 1)
        square[used] += g * g
        embed[used] -= pace * g / np.sqrt(square[used])
        gs, gb = mean.T @ p, p.sum(0)
        square_soft[...] += gs * gs
        square_bias[...] += gb * gb
        soft -= pace * gs / np.sqrt(square_soft)
        bias -= pace * gb / np.sqrt(square_bias)

    def values() -> np.ndarray:
        per_word = sample.word_values(embed @ (soft[:, 1] - soft[:, 0]))
        logits = per_word[sample.word]
        out = np.empty(len(start))
        for i in range(0, len(out), CHUNK):
            out[i : i + CHUNK] = _segment_values(logits, sample.previous, start[i : i + CHUNK], end[i : i + CHUNK])
        return out + bias[1] - bias[0]

    for epoch in range(epochs + 1 if len(row) else 0):
        value = values()
        worst = np.repeat(np.maximum.reduceat(value, heads), np.diff(np.concatenate((heads, [len(row)]))))
        top = np.flatnonzero(value >= worst)
        some = rng.permutation(np.flatnonzero(toxic == 0))[: len(heads)]
        chosen = rng.permutation(np.concatenate((top, some)))
        for at in range(0, len(chosen), 256):
            step(chosen[at : at + 256], PACE if epoch < epochs else PACE / 3)
    seen = np.zeros(size, dtype=bool)
    seen[sample.gram_ids] = True
    return Model(np.where(seen, embed @ (soft[:, 1] - soft[:, 0]), 0.0), float(bias[1] - bias[0]))


def train_on_labels(documents: DataFrame, labels: DataFrame, positive: int = SAMPLE_POSITIVE,
                    negative: int = SAMPLE_NEGATIVE) -> Model:
    """Model learned from labelled rows that are not held out."""
    return train(*training_sample(documents, labels, positive, negative))


def toxicity_report(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train_on_labels(documents, labels, **options)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score_documents(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
