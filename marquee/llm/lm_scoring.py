"""LM scoring: a log-bilinear model trained by noise-contrastive estimation.

*Model.* The next word's class is predicted from the ``CONTEXT`` classes before
it: the context vectors, each weighted by a vector of its place, add up to a
prediction; its product with the output vectors, plus a bias, gives the logits
of all classes, normalised by their log-sum-exp. A class is one of the
``TOP_WORDS`` most frequent words, the end of a text, or one of
``TAIL_CLASSES`` classes of all other words by spelling (their last two bytes).
A word of a tail class has the class's probability times its smoothed share of
the class, (c + 0.1) / (N_class + 0.1 (V_class + 1)), where words never seen
take the last 0.1. Probabilities of a position add up to one.

*Training.* Noise-contrastive estimation against the unigram distribution of
classes, with the noise words of a minibatch shared, so every step is a few
matrix products in numpy. Training is ``EPOCHS`` epochs over all training
texts, in steps of ``BATCH`` tokens, at every size of corpus. The texts are
written once as class numbers; in an epoch every task trains a copy of
the model on its share of them, each text once, and the copies with their AdaGrad sums are
averaged in Spark, weighted by tokens, before the next epoch. Only the average,
of fixed size, reaches the driver.

*Counts.* Words are counted over all training texts: a row per task and
distinct word, added up by word. To score, documents are dealt into blocks of
about ``BLOCK_BYTES``: runs of rows for texts of up to ``LONG`` times the average
size, and shorter runs, by size, for longer ones, so that no run of long texts
makes a block of more than ``LONG`` times that (but for one text alone); a block's distinct words are joined with the counts and
meet the block's texts again, so no task and no broadcast holds the vocabulary.

*Scoring.* What a class at each place adds to every logit, and the normaliser of
every context, are tables of the model, of fixed size: they are computed once
and looked up by every token.

Words are identified by a 64-bit hash of their lower-cased bytes.

Shapes of input: null, empty and blank texts are one end token; texts of any
length are scored in pieces of ``PIECE_TOKENS`` with their true contexts;
repeated rows score alike; a null ``doc_id`` is a training row; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import staged
from marquee.llm.textbytes import LOWER, SLICE_BYTES, mix64, range_hashes, row_slices, text_buffers, word_bounds

TOP_WORDS = 447
TAIL_CLASSES = 64
CLASSES = TOP_WORDS + 1 + TAIL_CLASSES   # words, end, tail classes
END = TOP_WORDS
CONTEXT = 2
DIMENSIONS = 16
NOISE = 48
BATCH = 512             # tokens of a step, at every size of corpus
EPOCHS = 3
PACE = 0.1
PIECE_TOKENS = 1 << 20
SCORE_BYTES = 4 << 20
BLOCK_BYTES = 12 << 20
LONG = 4
HELD_OUT_OF = 10
END_WORD = np.uint64(0x9D8F3A6B1C2E4F57)  # the end token among the word hashes
# the tail class by a word's last two bytes
TAIL_CLASS = (mix64(np.arange(1 << 16, dtype=np.uint64)) >> np.uint64(58)).astype(np.int64) % TAIL_CLASSES


def held_out(doc_id: Column) -> Column:
    """True for rows the model and the counts never see."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT_OF)) == 0, F.lit(False))


@dataclass
class Vocabulary:
    """The classes: sorted hashes of the top words with their classes, counts
    of every class, tail totals, and the totals N and V."""

    hashes: np.ndarray
    classes: np.ndarray
    class_count: np.ndarray
    class_words: np.ndarray
    total: int
    distinct: int

    def classify(self, words: np.ndarray, tails: np.ndarray) -> np.ndarray:
        out = TOP_WORDS + 1 + tails
        if len(self.hashes):
            at = pc.fill_null(pc.index_in(pa.array(words.view(np.int64)), value_set=pa.array(self.hashes.view(np.int64))), -1).to_numpy()
            top = at >= 0
            out[top] = self.classes[at[top]]
        out[words == END_WORD] = END
        return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, tail class, first token of each row) with one end per row."""
    low = LOWER.take(data)
    starts, ends, first = word_bounds(low, offsets)
    rows = len(offsets) - 1
    hashes = np.empty(len(starts) + rows, dtype=np.uint64)
    tails = np.zeros(len(hashes), dtype=np.int64)
    head = first + np.arange(rows + 1)
    stop = head[1:] - 1
    inner = np.ones(len(hashes), dtype=bool)
    inner[stop] = False
    hashes[inner] = range_hashes(low, starts, ends)
    if len(starts):
        last = low.take(ends - 1).astype(np.int64)
        before = np.where(ends - starts > 1, low.take(np.maximum(ends - 2, 0)), 0)
        tails[inner] = TAIL_CLASS.take(last * 256 + before)
    hashes[stop] = END_WORD
    return hashes, tails, head


def _slices(column: pa.Array, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffers(column)
    for i, j in row_slices(offsets, budget):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


# ------------------------------------------------------------------- counting


def _numbered(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words, the number among them of every word), by hashing."""
    coded = pa.array(words.view(np.int64)).dictionary_encode()
    return coded.dictionary.to_numpy().view(np.uint64), coded.indices.to_numpy()


def _distinct(words: np.ndarray, tails: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, tail, count) of the distinct words; a word has one tail."""
    value, at = _numbered(words)
    tail = np.empty(len(value), dtype=np.int64)
    tail[at] = tails
    return value, tail, np.bincount(at, counts, len(value)).astype(np.int64)


def _merge(words: list, tails: list, counts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _distinct(np.concatenate(words), np.concatenate(tails), np.concatenate(counts))


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words with counts; a task holds at most a few MB of them."""
    words, tails, counts, held = [], [], [], 0

    def out() -> pa.RecordBatch:
        word, tail, count = _merge(words, tails, counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(tail.astype(np.int32)), pa.array(count)], ["word", "tail", "count"])

    for batch in batches:
        for _, _, piece, places in _slices(batch["text"]):
            word, tail, _ = tokens(piece, places)
            value, tail, count = _distinct(word, tail)
            words.append(value)
            tails.append(tail)
            counts.append(count)
            held += len(value)
            if held >= 1 << 20:
                word, tail, count = _merge(words, tails, counts)
                words, tails, counts, held = [word], [tail], [count], len(word)
                if held >= 3 << 18:
                    yield out()
                    words, tails, counts, held = [], [], [], 0
    if held:
        yield out()


def count_words(rows: DataFrame) -> DataFrame:
    """(word, tail, count) over all ``rows``, the end token included."""
    parts = rows.select("text").mapInArrow(_count_batches, "word long, tail int, count long")
    return staged(parts.groupBy("word", "tail").agg(F.sum("count").alias("count")), "lm-counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Classes from the counts; TOP_WORDS rows and class totals are collected."""
    end = int(END_WORD.view(np.int64))
    top = counts.where(F.col("word") != end).orderBy(F.col("count").desc(), "word").limit(TOP_WORDS).collect()
    hashes = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    count, distinct = np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64)
    total = words = 0
    for r in counts.withColumn("is_end", F.col("word") == end).groupBy("tail", "is_end").agg(
            F.sum("count").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        total, words = total + r["c"], words + r["v"]
        at = END if r["is_end"] else TOP_WORDS + 1 + r["tail"]
        count[at] += r["c"]
        distinct[at] += r["v"]
    for i, r in enumerate(top):  # top words leave their tail class
        count[i] = r["count"]
        distinct[i] = 1
        count[TOP_WORDS + 1 + r["tail"]] -= r["count"]
        distinct[TOP_WORDS + 1 + r["tail"]] -= 1
    return Vocabulary(hashes[order], order, count, distinct, int(total), int(words))


# -------------------------------------------------------------------- training


@dataclass
class Model:
    """Context vectors (with one row for 'before the text'), place weights,
    output vectors and biases."""

    context: np.ndarray
    place: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.place, self.output, self.bias)])


def initial_squares(model: Model) -> list[np.ndarray]:
    """AdaGrad sums before the first step, shaped like the parameters."""
    return [np.full_like(x, 1e-4) for x in (model.context, model.place, model.output, model.bias[:, None])]


def _shaped(flat: np.ndarray) -> Model:
    sizes = ((CLASSES + 1, DIMENSIONS), (CONTEXT, DIMENSIONS), (CLASSES, DIMENSIONS), (CLASSES,))
    out, at = [], 0
    for shape in sizes:
        n = int(np.prod(shape))
        out.append(flat[at : at + n].reshape(shape).astype(np.float32))
        at += n
    return Model(*out)


def initial_model(vocab: Vocabulary, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    p = _noise(vocab)
    return Model(
        rng.normal(0, 0.1, (CLASSES + 1, DIMENSIONS)).astype(np.float32),
        np.full((CONTEXT, DIMENSIONS), 1.0 / CONTEXT, dtype=np.float32),
        rng.normal(0, 0.1, (CLASSES, DIMENSIONS)).astype(np.float32),
        np.log(p).astype(np.float32))


def _noise(vocab: Vocabulary) -> np.ndarray:
    p = vocab.class_count + 0.1
    return p / p.sum()


def contexts(classes: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The CONTEXT classes before each token; CLASSES before a text begins."""
    n = len(classes)
    begin = np.repeat(head[:-1], np.diff(head))
    at = np.arange(n)
    out = np.full((n, CONTEXT), CLASSES, dtype=np.int64)
    for k in range(1, CONTEXT + 1):
        inside = at - k >= begin
        out[inside, k - 1] = classes[at[inside] - k]
    return out


# Rows of the flat tables of a step: the output vectors carry their bias, less
# the log of the noise, and fill up to an even width.
OUT_WIDTH = (DIMENSIONS + 2) // 2 * 2
FIRST_OUT = (CLASSES + 1) * DIMENSIONS
FIRST_PLACE = FIRST_OUT + CLASSES * OUT_WIDTH


def _packed(context: np.ndarray, place: np.ndarray, output: np.ndarray, bias: np.ndarray) -> np.ndarray:
    out = np.ones((CLASSES, OUT_WIDTH), dtype=np.float32)
    out[:, :DIMENSIONS], out[:, DIMENSIONS] = output, bias.ravel()
    return np.concatenate((context.ravel(), out.ravel(), place.ravel()))


def _unpacked(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Views: context vectors, output vectors with bias, place weights."""
    return (flat[:FIRST_OUT].reshape(-1, DIMENSIONS), flat[FIRST_OUT:FIRST_PLACE].reshape(-1, OUT_WIDTH),
            flat[FIRST_PLACE:].reshape(CONTEXT, DIMENSIONS, 1))


class _Step:
    """Arrays of a step over ``m`` tokens, used again by the next. Columns are
    tokens, so that every product by token or place runs along memory."""

    def __init__(self, m: int):
        self.vectors = np.empty((CONTEXT, DIMENSIONS, m), dtype=np.float32)
        self.product = np.empty_like(self.vectors)
        self.predicted = np.zeros((OUT_WIDTH, m), dtype=np.float32)
        self.predicted[DIMENSIONS] = 1  # meets the bias
        self.own, self.both = np.empty_like(self.predicted), np.empty_like(self.predicted)
        self.fake = np.empty((NOISE, m), dtype=np.float32)
        self.back = np.empty((DIMENSIONS, m), dtype=np.float32)
        # gradients by row, and the places of their pairs in the flat tables
        cut = np.cumsum((CONTEXT * m * DIMENSIONS, m * OUT_WIDTH))
        self.values = np.empty(cut[1] + NOISE * OUT_WIDTH)
        context, output, noise = np.split(self.values, cut)
        self.g_context, self.g_output = context.reshape(CONTEXT, m, DIMENSIONS), output.reshape(m, OUT_WIDTH)
        self.g_noise = noise.reshape(NOISE, OUT_WIDTH)
        self.index = np.empty(len(self.values) // 2, dtype=np.int64)
        context, output, noise = np.split(self.index, cut // 2)
        self.at_context, self.at_output = context.reshape(CONTEXT, m, -1), output.reshape(m, -1)
        self.at_noise = noise.reshape(NOISE, -1)


def train_slice(model: Model, squares: list[np.ndarray], context: np.ndarray, target: np.ndarray,
                noise: np.ndarray, rng: np.random.Generator, pace: float = PACE) -> None:
    """NCE over the given tokens, in shuffled minibatches; updates in place.

    Gradients of a row add up, in double precision; two neighbouring numbers
    are added as one complex number, which halves the additions.
    """
    log_k_noise = np.log(NOISE * noise).astype(np.float32)
    numbers = _packed(model.context, model.place, model.output, model.bias - log_k_noise)
    sums = _packed(*squares)
    vectors, output, place = _unpacked(numbers)
    pairs = np.arange(FIRST_PLACE // 2)
    context_pairs, output_pairs = pairs[: FIRST_OUT // 2].reshape(CLASSES + 1, -1), pairs[FIRST_OUT // 2 :].reshape(CLASSES, -1)
    order = rng.permutation(len(target))
    before = np.stack([context[:, k].take(order) for k in range(CONTEXT)])
    words = target.take(order)
    starts = range(0, len(order), BATCH)
    noises = np.minimum(np.searchsorted(np.cumsum(noise), rng.random((len(starts), NOISE))), CLASSES - 1)
    gradient, work = np.empty(len(numbers)), np.empty_like(numbers)
    m = 0
    with np.errstate(over="ignore"):  # exp of a large logit: a gradient of 0
        for at, drawn in zip(starts, noises):
            c, w = before[:, at : at + BATCH], words[at : at + BATCH]
            if len(w) != m:
                m = len(w)
                s, scale = _Step(m), np.float32(1.0 / m)
            s.vectors[:] = vectors.take(c, axis=0).transpose(0, 2, 1)
            predicted = np.multiply(s.vectors[0], place[0], out=s.predicted[:DIMENSIONS])
            for k in range(1, CONTEXT):
                predicted += np.multiply(s.vectors[k], place[k], out=s.product[k])
            s.own[:] = output.take(w, axis=0).T
            drawn_out = output.take(drawn, axis=0)
            g_true = np.add.reduce(np.multiply(s.predicted, s.own, out=s.both), axis=0)
            np.exp(g_true, out=g_true)
            g_true += 1
            np.divide(-scale, g_true, out=g_true)                    # d loss / d logit
            np.matmul(-drawn_out, s.predicted, out=s.fake)
            np.exp(s.fake, out=s.fake)
            s.fake += 1
            g_fake = np.divide(scale, s.fake, out=s.fake)
            np.matmul(drawn_out[:, :DIMENSIONS].T, g_fake, out=s.back)
            s.own *= g_true
            s.back += s.own[:DIMENSIONS]
            s.g_context[:] = np.multiply(s.back, place, out=s.product).transpose(0, 2, 1)
            s.g_output[:] = np.multiply(g_true, s.predicted, out=s.both).T
            s.g_noise[:] = g_fake @ s.predicted.T
            context_pairs.take(c, axis=0, out=s.at_context, mode="clip")
            output_pairs.take(w, axis=0, out=s.at_output, mode="clip")
            output_pairs.take(drawn, axis=0, out=s.at_noise, mode="clip")
            gradient[:FIRST_PLACE] = 0
            np.add.at(gradient[:FIRST_PLACE].view(np.complex128), s.index, s.values.view(np.complex128))
            gradient[FIRST_PLACE:] = np.vecdot(s.vectors, s.back).ravel()
            step = gradient.astype(np.float32)
            sums += np.multiply(step, step, out=work)                # AdaGrad
            step /= np.sqrt(sums, out=work)
            step *= pace
            numbers -= step
    model.context[:], model.place[:] = vectors, place[:, :, 0]
    model.output[:], model.bias[:] = output[:, :DIMENSIONS], output[:, DIMENSIONS] + log_k_noise
    vectors, output, place = _unpacked(sums)
    for square, now in zip(squares, (vectors, place[:, :, 0], output[:, :DIMENSIONS], output[:, DIMENSIONS, None])):
        square[:] = now


def _flat_state(model: Model, squares: list[np.ndarray]) -> np.ndarray:
    """Parameters and AdaGrad sums, one after the other."""
    return np.concatenate([model.flat(), *(x.ravel() for x in squares)])


def _state(flat: np.ndarray) -> tuple[Model, list[np.ndarray]]:
    half = len(flat) // 2
    model, sums = _shaped(flat[:half]), _shaped(flat[half:])
    return model, [sums.context, sums.place, sums.output, sums.bias[:, None]]


def _class_batches(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            classes, lengths = [], []
            for _, _, piece, places in _slices(batch["text"]):
                word, tail, head = tokens(piece, places)
                classes.append(vocab.classify(word, tail).astype(np.int16).tobytes())
                lengths.append(np.diff(head).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), pa.array(lengths, pa.binary())], ["classes", "lengths"])

    return run


def class_rows(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(classes, lengths): the texts as class numbers of two bytes a token and
    token counts of four a text, a row per slice of texts, staged. Words are
    split and looked up once, however many epochs follow."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)
    return staged(rows.select("text").mapInArrow(_class_batches(shared), "classes binary, lengths binary"), "lm-classes")


def _train_batches(shared, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, noise = shared.value
        model, squares = _state(state)
        rng, seen = np.random.default_rng(seed), 0
        for batch in batches:
            for classes, lengths in zip(batch["classes"], batch["lengths"]):
                target = np.frombuffer(classes.as_buffer(), dtype=np.int16).astype(np.int64)
                head = np.concatenate(([0], np.cumsum(np.frombuffer(lengths.as_buffer(), dtype=np.int32), dtype=np.int64)))
                train_slice(model, squares, contexts(target, head), target, noise, rng)
                seen += len(target)
        if seen:
            yield _parameters(_flat_state(model, squares).astype(np.float64) * seen, seen, seed)

    return run


PARAMETER_SCHEMA = "part int, salt int, weight double, numbers array<double>"
PARAMETER_PARTS = 16


def _parameters(total: np.ndarray, weight: float, salt: int) -> pa.RecordBatch:
    cut = np.array_split(total, PARAMETER_PARTS)
    ends = np.concatenate(([0], np.cumsum([len(x) for x in cut]))).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array(np.arange(PARAMETER_PARTS, dtype=np.int32)), pa.array(np.full(PARAMETER_PARTS, int(weight) % 16, np.int32)),
        pa.array(np.full(PARAMETER_PARTS, float(weight))), pa.ListArray.from_arrays(pa.array(ends), pa.array(total)),
    ], ["part", "salt", "weight", "numbers"])


def _add_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the parameter parts of a partition, row by row."""
    total: dict[int, list] = {}
    for batch in batches:
        for part, weight, numbers in zip(batch["part"].to_pylist(), batch["weight"].to_pylist(), batch["numbers"]):
            value = numbers.values.to_numpy()
            held = total.get(part)
            total[part] = [held[0] + weight, held[1] + value] if held else [weight, value]
    if total:
        parts = sorted(total)
        ends = np.concatenate(([0], np.cumsum([len(total[p][1]) for p in parts]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array(parts, np.int32)), pa.array(np.zeros(len(parts), np.int32)),
            pa.array([float(total[p][0]) for p in parts]),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([total[p][1] for p in parts]))),
        ], ["part", "salt", "weight", "numbers"])


def train(rows: DataFrame, vocab: Vocabulary, epochs: int = EPOCHS) -> Model:
    """Train on all ``rows`` in every epoch; copies are averaged after each."""
    sc = rows.sparkSession.sparkContext
    coded = class_rows(rows, vocab)
    model = initial_model(vocab)
    state = _flat_state(model, initial_squares(model))
    for epoch in range(epochs):
        shared = sc.broadcast((state, _noise(vocab)))        # fixed size
        copies = coded.mapInArrow(_train_batches(shared, epoch), PARAMETER_SCHEMA)
        for keys in (("part", "salt"), ("part",)):
            copies = copies.repartition(PARAMETER_PARTS, *keys).mapInArrow(_add_batches, PARAMETER_SCHEMA)
        got = sorted(copies.collect(), key=lambda x: x["part"])   # PARAMETER_PARTS rows
        if got:
            state = np.concatenate([np.array(x["numbers"]) / x["weight"] for x in got])
    return _state(state)[0]


# --------------------------------------------------------------------- scoring


def logit_tables(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(logits, normalisers): what the class at each place adds to the logits
    of all classes, the last place with the bias, and the log-sum-exp of the
    logits for every context. Their size depends on the classes alone."""
    logits = (model.context * model.place[:, None, :]) @ model.output.T    # CONTEXT x (CLASSES + 1) x CLASSES
    logits[-1] += model.bias
    norm = np.empty((CLASSES + 1,) * CONTEXT)
    for before in np.ndindex(norm.shape[:-1]):
        given = logits[-1] + sum(logits[k, c] for k, c in enumerate(before))
        top = given.max(axis=1)
        given -= top[:, None]
        np.exp(given, out=given)
        norm[before] = top + np.log(given.sum(axis=1, dtype=np.float64))
    return logits, norm


def class_log_probabilities(model: Model, context: np.ndarray, target: np.ndarray,
                            tables: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Normalised log10 probability of each target class; ``tables`` are the
    model's ``logit_tables``, where they are at hand."""
    logits, norm = tables or logit_tables(model)
    before = tuple(context[:, k] for k in range(CONTEXT))
    own = sum(logits[k][c, target] for k, c in enumerate(before))
    return (own - norm[before]) / np.log(10)


def _counts_of(words: np.ndarray, known: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The count of every word, 0 if not among the sorted ``known``; distinct
    words are looked up in ascending order."""
    if not len(known):
        return np.zeros(len(words), dtype=np.int64)
    value, number = _numbered(words)
    order = np.argsort(value)
    value = value[order]
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    found = np.empty(len(value), dtype=np.int64)
    found[order] = np.where(known[at] == value, count[at], 0)
    return found[number]


def _score_group(shared):
    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        flat, tables, vocab = shared.value
        model = _shaped(flat)
        known = counts["word"].to_numpy().view(np.uint64)
        order = np.argsort(known)
        known, count = known[order], counts["count"].to_numpy()[order]
        n_all, v_all = vocab.total, vocab.distinct
        out: list[tuple] = []
        for chunk in texts.combine_chunks().to_batches():
            ids = chunk["doc_id"].to_pylist()
            for i, j, piece, places in _slices(chunk["text"], SCORE_BYTES):
                word, tail, head = tokens(piece, places)
                c = _counts_of(word, known, count)
                base = np.log10((c + 0.1) / (n_all + 0.1 * (v_all + 1)))
                classes = vocab.classify(word, tail)
                score = np.empty(len(word))
                context = contexts(classes, head)
                for a in range(0, len(word), PIECE_TOKENS):
                    score[a : a + PIECE_TOKENS] = class_log_probabilities(
                        model, context[a : a + PIECE_TOKENS], classes[a : a + PIECE_TOKENS], tables)
                rare = classes > END
                k = classes[rare]
                score[rare] += np.log10((c[rare] + 0.1) / (vocab.class_count[k] + 0.1 * (vocab.class_words[k] + 1)))
                sums = [np.add.reduceat(x, head[:-1]) for x in (base, score, (c > 0).astype(np.int64))]
                for r in range(j - i):
                    out.append((ids[i + r], int(head[r + 1] - head[r]), int(sums[2][r]), float(sums[0][r]), float(sums[1][r])))
        columns = list(zip(*out)) if out else [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def _block_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word): the distinct words of each block's texts in a task."""
    held: dict[int, list] = {}
    size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(list(held), np.int64), [len(x) for x, in held.values()])),
            pa.array(np.concatenate([x for x, in held.values()]).view(np.int64))], ["block", "word"])

    def merged() -> dict[int, list]:
        return {b: x if len(x) == 1 else [_numbered(np.concatenate(x))[0]] for b, x in held.items()}

    for batch in batches:
        blocks = batch["block"].to_numpy()
        for i, j, piece, places in _slices(batch["text"]):
            word, _, head = tokens(piece, places)
            present = np.unique(blocks[i:j]).tolist()
            owner = np.repeat(blocks[i:j], np.diff(head)) if len(present) > 1 else None
            for b in present:
                value, _ = _numbered(word if owner is None else word[owner == b])
                held.setdefault(b, []).append(value)
                size += len(value)
            if size >= 1 << 20:
                held = merged()
                size = sum(len(x) for x, in held.values())
                if size >= 3 << 18:
                    yield out()
                    held, size = {}, 0
    if size:
        held = merged()
        yield out()


def score_documents(documents: DataFrame, model: Model, vocab: Vocabulary, counts: DataFrame,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chosen = (F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # A block is a run of rows of one file, so that a task meets few blocks
    # and every evaluation deals alike; other inputs are written first.
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        rows = documents.select(*chosen, *place)
    except AnalysisException:
        rows = staged(documents.select(*chosen), "lm-texts").select("doc_id", "text", *place)
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    average = max((total or 0) / max(n, 1), 1.0)
    size = F.octet_length("text")
    doubling = F.when(size <= LONG * average, 0).otherwise(F.ceil(F.log2(size))).cast("int")
    run = F.when(doubling == 0, max(1, int(block_bytes / average))).otherwise(
        F.greatest(F.lit(1), F.floor(block_bytes / F.pow(F.lit(2.0), doubling)))).cast("long")
    dealt = rows.select("doc_id", "text", F.xxhash64("file", doubling, F.floor(F.col("row") / run)).alias("block"))
    words = dealt.mapInArrow(_block_words, "block long, word long")
    # a pair that two tasks found is looked up twice and serves as well
    found = words.join(counts.select("word", "count"), "word").select("block", "word", "count")
    shared = spark.sparkContext.broadcast((model.flat(), logit_tables(model), vocab))  # fixed size
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_score_group(shared), schema)


def lm_report(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = rows.where(~held_out(F.col("doc_id")))
    counts = count_words(learn)
    vocab = vocabulary(counts)
    model = train(learn, vocab)
    return score_documents(rows, model, vocab, counts).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocab.total).cast("long").alias("train_tokens"), "base_score", "score")
