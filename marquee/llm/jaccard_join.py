"""N-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct ``WORDS``-word shingles (A-Z lower-cased); a
shorter text is one shingle. Two sets link when their Jaccard similarity is at
least ``PERCENT`` / 100.

1. *Order.* A frequency sketch of fixed size (2**SKETCH_BITS counters over all
   shingles of all texts) ranks shingles; a set is ordered rare first, ties by
   hash. Any total order is right for the filters; rare-first makes them cheap.
2. *Classes.* Equal sets are one class, represented by one row (a row key, not
   a doc_id, finds its text again), so exact copies are never paired.
3. *Prefixes.* Sets that link share a shingle among the first
   n - ceil(t n) + 1 of each. Prefix shingles of one class alone are dropped.
4. *Candidates without all pairs.* For each prefix shingle, every class is
   paired with one hub (the set in which the shingle comes earliest: the one
   with the fewest private shingles, such as the original of many near
   copies). After these links are merged into components, the remaining pairs
   of a shingle are formed only between different components.
5. *Filters.* Length, position (counting only prefix shingles that another
   class holds), and suffix: parity signatures (inside the join between
   components) and the sets' counts in fixed parts of hash space both bound
   the sets' difference from below.
6. *Verification.* Each pair left is verified once, on the whole sets.

Links inside a component that is already connected are not listed; components
are exact. Sets are identified by 64-bit sums of mixed shingle hashes.

Shapes of input: null, empty and blank texts have the empty set, link with
nothing and are their own component; texts of any length are whole; rows that
repeat a ``doc_id`` are rows like any other; a row with a null ``doc_id`` gets
the component of an equal text that has an id, else none (null); empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm._frames import ROW_KEY, staged, with_row_key
from marquee.llm.components import connected_components
from marquee.llm.textbytes import LOWER, gram_hashes, mix64, range_hashes, row_slices, text_buffers, word_bounds

WORDS = 5
PERCENT = 80
SKETCH_BITS = 20
SKETCH_BLOCKS = 64
PARTS = 32
SIGNATURE = [f"bits{i}" for i in range(8)]   # 64 bits each
SET_SCHEMA = f"row {ROW_KEY}, doc_id long, n long, set_id long, parts binary, prefix array<long>, " + ", ".join(f"{c} long" for c in SIGNATURE)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash) of all distinct shingles of a slice, sorted."""
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = range_hashes(low, starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    grams = gram_hashes(hashes, words)
    at = np.arange(len(grams))
    inside = at + words <= first[row[: len(grams)] + 1]
    rows, values = [row[: len(grams)][inside]], [grams[inside]]
    for n in range(1, words):  # whole sequences of texts with n words
        short = np.flatnonzero(count == n)
        if len(short):
            whole = gram_hashes(hashes, n)[first[short]]
            rows.append(short)
            values.append(mix64(whole + np.uint64(n)))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffers(column)
    for i, j in row_slices(offsets):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


# ----------------------------------------------------------------- the sketch


def _count_batches(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        salt = 0
        for batch in batches:
            for _, _, piece, places in _slices(batch["text"]):
                _, value = shingle_sets(piece, places, words)
                counts += np.bincount((value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                salt = (salt * 31 + len(value)) % 16
        yield _blocks(np.arange(SKETCH_BLOCKS), counts.reshape(SKETCH_BLOCKS, -1), salt)

    return run


def _blocks(index: np.ndarray, counts: np.ndarray, salt: int) -> pa.RecordBatch:
    width = counts.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(index) + 1, dtype=np.int32) * width), pa.array(counts.ravel()))
    return pa.RecordBatch.from_arrays(
        [pa.array(index.astype(np.int32)), pa.array(np.full(len(index), salt, np.int32)), lists], ["block", "salt", "counts"])


def _add_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the blocks of a partition, row by row."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch["block"].to_pylist(), batch["counts"]):
            value = counts.values.to_numpy()
            total[block] = total[block] + value if block in total else value
    if total:
        yield _blocks(np.array(list(total)), np.stack(list(total.values())), 0)


def frequency_ranks(rows: DataFrame, words: int = WORDS) -> np.ndarray:
    """Rank (8 log2 of the count) of every counter: 2**SKETCH_BITS bytes."""
    schema = "block int, salt int, counts array<long>"
    parts = rows.select("text").mapInArrow(_count_batches(words), schema)
    for keys in (("block", "salt"), ("block",)):
        parts = parts.repartition(SKETCH_BLOCKS, *keys).mapInArrow(_add_batches, schema)
    counts = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), dtype=np.int64)
    for r in parts.collect():  # SKETCH_BLOCKS rows of fixed size
        counts[r["block"]] = r["counts"]
    return np.floor(8 * np.log2(1.0 + counts.ravel())).astype(np.uint8)


# ------------------------------------------------------------- sets, prefixes


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def signatures(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Parity bits of each row's set: rows x len(SIGNATURE) signed words.

    Each shingle flips one bit, so two signatures differ in at most as many
    bits as the sets differ in shingles.
    """
    bits = 64 * len(SIGNATURE)
    bit = (mix64(value ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(bits)).astype(np.int64)
    out = np.zeros((rows, len(SIGNATURE)), dtype=np.int64)
    for a in range(0, rows, 1_024):
        z = min(a + 1_024, rows)
        i, j = np.searchsorted(row, [a, z])
        odd = np.bincount((row[i:j] - a) * bits + bit[i:j], minlength=(z - a) * bits) & 1
        out[a:z] = np.packbits(odd.astype(np.uint8).reshape(z - a, bits), axis=1).view(np.int64)
    return out


def _set_batches(ranks, words: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = ranks.value
        for batch in batches:
            for i, j, piece, places in _slices(batch["text"]):
                row, value = shingle_sets(piece, places, words)
                n = np.bincount(row, minlength=j - i)
                bucket = (value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                head = np.concatenate(([0], np.cumsum(n)))[:-1]
                sums = np.zeros(j - i, dtype=np.uint64)
                filled = np.flatnonzero(n)
                if len(filled):
                    sums[filled] = np.add.reduceat(mix64(value ^ np.uint64(0xA0761D6478BD642F)), head[filled])
                set_id = mix64(sums + n.astype(np.uint64)).view(np.int64)
                part = (mix64(value) >> np.uint64(59)).astype(np.int64)
                parts = np.minimum(np.bincount(row * PARTS + part, minlength=(j - i) * PARTS), 65535).astype(np.uint16)
                # rare first within each row
                order = np.lexsort((value, rank_of[bucket], row))
                size = np.where(n > 0, prefix_size(n, percent), 0)
                place = np.arange(len(order)) - head[row]          # rows stay in place under the sort
                chosen = order[place < size[row]]
                prefix = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(value[chosen].view(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    batch["row"].slice(i, j - i), batch["doc_id"].slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(set_id),
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * PARTS), j - i, [None, pa.py_buffer(parts.tobytes())]).cast(pa.binary()),
                    prefix, *(pa.array(np.ascontiguousarray(c)) for c in signatures(row, value, j - i).T),
                ], ["row", "doc_id", "n", "set_id", "parts", "prefix", *SIGNATURE])

    return run


def document_sets(rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, n, set_id, parts and rare-first prefix of every document."""
    ranks = rows.sparkSession.sparkContext.broadcast(frequency_ranks(rows, words))
    return staged(rows.mapInArrow(_set_batches(ranks, words, percent), SET_SCHEMA), "jaccard-sets")


# ------------------------------------------------------- candidates and filters


def _length_ok(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of two sets of the given sizes that link."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def _position_ok(na: Column, pa_: Column, sa: Column, nb: Column, pb: Column, sb: Column, percent: int) -> Column:
    """Overlap possible when a shingle at places pa, pb is shared and only
    sa, sb of those before it can be."""
    most = F.least(sa, sb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return most >= _needed(na, nb, percent)


def shared_prefixes(classes: DataFrame) -> DataFrame:
    """(gram, set_id, n, place, shared_before) of prefix shingles that two or
    more classes hold."""
    listed = classes.select("set_id", "n", F.posexplode("prefix").alias("place", "gram"))
    ends = listed.groupBy("gram").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b")).where("a < b").select("gram")
    shared = listed.join(ends, "gram")
    before = W.partitionBy("set_id").orderBy("place")
    return staged(shared.select("gram", "set_id", "n", F.col("place").cast("long").alias("place"),
                                (F.row_number().over(before) - 1).alias("shared_before")), "jaccard-prefixes")


def _pair(a: str, b: str, na: str, nb: str) -> list[Column]:
    first = F.col(a) < F.col(b)
    return [
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
        F.when(first, F.col(na)).otherwise(F.col(nb)).alias("na"), F.when(first, F.col(nb)).otherwise(F.col(na)).alias("nb"),
    ]


def hub_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Each class with the hub of each of its shared prefix shingles."""
    hubs = shared.groupBy("gram").agg(F.min(F.struct("place", "set_id", "n", "shared_before")).alias("hub"))
    joined = shared.join(hubs.select("gram", F.col("hub.set_id").alias("hs"), F.col("hub.n").alias("hn"),
                                     F.col("hub.place").alias("hp"), F.col("hub.shared_before").alias("hb")), "gram")
    kept = joined.where((F.col("set_id") != F.col("hs")) & _length_ok(F.col("n"), F.col("hn"), percent) & _position_ok(
        F.col("n"), F.col("place"), F.col("shared_before"), F.col("hn"), F.col("hp"), F.col("hb"), percent))
    return kept.select(*_pair("set_id", "hs", "n", "hn")).distinct()


def cross_pairs(shared: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a prefix shingle between classes of different components that
    pass the length, position and signature filters."""
    named = shared.join(labels.select(F.col("node").alias("set_id"), "label"), "set_id", "left").withColumn(
        "label", F.coalesce("label", "set_id"))
    named = staged(named, "jaccard-labelled")
    open_ = named.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("gram")
    rows = staged(named.join(open_, "gram").join(classes.select("set_id", *SIGNATURE), "set_id"), "jaccard-open")
    sides = ["gram", "set_id", "n", "place", "shared_before", "label", *SIGNATURE]
    left, right = (rows.select(*[F.col(c).alias(f"{s}_{c}") for c in sides]) for s in "xy")
    differing = sum((F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in SIGNATURE), F.lit(0))
    allowed = F.col("x_n") + F.col("y_n") - 2 * _needed(F.col("x_n"), F.col("y_n"), percent)
    met = left.join(right, (F.col("x_gram") == F.col("y_gram")) & (F.col("x_set_id") < F.col("y_set_id"))
                    & (F.col("x_label") != F.col("y_label")) & _length_ok(F.col("x_n"), F.col("y_n"), percent)
                    & _position_ok(F.col("x_n"), F.col("x_place"), F.col("x_shared_before"),
                                   F.col("y_n"), F.col("y_place"), F.col("y_shared_before"), percent)
                    & (differing <= allowed))
    return met.select(*_pair("x_set_id", "y_set_id", "x_n", "y_n")).distinct()


def _suffix_batches(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.stack([np.frombuffer(v, dtype=np.uint16) for v in batch[c].to_pylist()]).astype(np.int64) for c in ("pa", "pb"))
            na, nb = batch["na"].to_numpy(), batch["nb"].to_numpy()
            needed = -(-percent * (na + nb) // (100 + percent))
            keep = np.abs(x - y).sum(axis=1) <= na + nb - 2 * needed
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep))

    return run


def suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets do not differ too much in the parts of hash space."""
    parts = classes.select("set_id", "parts")
    with_a = pairs.join(parts.select(F.col("set_id").alias("a"), F.col("parts").alias("pa")), "a")
    both = with_a.join(parts.select(F.col("set_id").alias("b"), F.col("parts").alias("pb")), "b")
    return both.mapInArrow(_suffix_batches(percent), "a long, b long, na long, nb long")


# ------------------------------------------------------------------ verification


def _token_batches(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, piece, places in _slices(batch["text"]):
                row, value = shingle_sets(piece, places, words)
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=j - i)))).astype(np.int32)
                # ascending as signed numbers is not needed, only one fixed order
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch["set_id"].slice(i, j - i), lists], ["set_id", "tokens"])

    return run


def _verify_batches(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for k, (x, y) in enumerate(zip(batch["ta"], batch["tb"])):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int((y[at] == x).sum())
                keep[k] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The links among ``pairs``: whole sets are compared, each pair once."""
    pairs = staged(pairs, "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    owners = classes.join(wanted, "set_id").select("set_id", "row")
    texts = rows.join(owners, "row").select("set_id", "text")
    tokens = staged(texts.mapInArrow(_token_batches(words), "set_id long, tokens array<long>"), "jaccard-tokens")
    with_a = pairs.select("a", "b").join(tokens.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta")), "a")
    both = with_a.join(tokens.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb")), "b")
    return staged(both.mapInArrow(_verify_batches(percent), "a long, b long"), "jaccard-links", wide=True)


def placed_rows(keyed: DataFrame, key: str, words: int = WORDS, percent: int = PERCENT, nameless: bool = True) -> DataFrame:
    """row (the value of ``key``), doc_id, n, set_id and label of every row;
    rows of one component share a label. Sets that only rows without a doc_id
    hold link like any other if ``nameless``, else with nothing."""
    rows = keyed.select(F.col(key).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = document_sets(rows, words, percent)
    held = sets.where("n > 0") if nameless else sets.where("n > 0 and doc_id is not null")
    first = held.groupBy("set_id").agg(F.min("row").alias("row"))
    classes = staged(sets.join(first, ["row", "set_id"]).select(*sets.columns), "jaccard-classes")
    shared = shared_prefixes(classes)
    near = staged(hub_pairs(shared, percent), "jaccard-hub-pairs")
    links = verified(suffix_filter(near, classes, percent), classes, rows, words, percent)
    labels = staged(connected_components(links), "jaccard-hub-labels")
    far = cross_pairs(shared, labels, classes, percent).join(near.select("a", "b"), ["a", "b"], "left_anti")
    more = verified(suffix_filter(far, classes, percent), classes, rows, words, percent)
    # hub components are kept as links of their label
    merged = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)
    final = connected_components(merged)
    placed = sets.select("row", "doc_id", "n", "set_id").join(
        final.select(F.col("node").alias("set_id"), "label"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    return staged(placed, "jaccard-placed")


def near_duplicates(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, set_id, component_id."""
    keyed = with_row_key(documents, "_row", "jaccard-texts")
    placed = placed_rows(keyed, "_row", words, percent, nameless=False)
    smallest = placed.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    joined = placed.join(smallest, "label", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), "set_id",
                         F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
