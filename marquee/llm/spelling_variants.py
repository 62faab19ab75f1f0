"""Spelling variants: words one edit apart, by a trie-node pair dictionary.

Every word is a path in a forward trie (its prefixes) and in a reversed trie
(its suffixes). A word with one position skipped is the pair (node of the
prefix before it, node of the suffix after it); a word with a gap between two
characters is the pair of the nodes on both sides. Two words are one edit apart
exactly if they meet in such a pair:

- replaced: both skip the same position and are left with the same pair;
- inserted or deleted: the longer word's pair with a position skipped is the
  shorter word's pair with a gap.

So neighbours are found by grouping rows of integers, one row per position, and
no word is compared with all others. A pair's group holds at most one word with
a gap (the pair spells it) and one word per character of the alphabet, 90 here,
with a skipped position; no larger group can exist, and counts and best
neighbours of a group are taken from its totals, not from its pairs of words.
A word that can lose any of several equal neighbouring characters ("letter")
would meet the shorter word once per character; only the first of them counts.

*Node numbers.* A node's number is a 64-bit hash of its path, computed for all
positions of a word at once. Numbers are checked before they are used: every
node is reached from exactly one (depth, parent number, character), which by
induction means that no two nodes share a number. A clash raises.

Words are numbered in the order (count descending, word ascending), so that a
smaller number is a better form and ties need no texts.

Shapes of input: null and empty texts have no words; long texts are whole; a
null ``doc_id`` is written as empty text in the hashed key; repeated rows count
again; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import staged
from marquee.llm.textbytes import _tables, mix64, text_buffers

RUN_SPLIT = r"[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
DROP_EVERY = 31
FORM_RATIO = 10
SLICE_CHARS = 1 << 17  # characters whose positions are listed at once


def count_words(
    documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY
) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points that occur at
    least ``min_count`` times, after the deterministic loss of characters."""
    run = F.col("run")
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.split(F.translate("text", UPPER, LOWER), RUN_SPLIT)).alias("run"),
    ).where(F.length("run") >= min_length)
    h = F.crc32(F.concat(F.col("doc"), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length("run")))
    words = runs.select(F.when(F.pmod(h, F.lit(drop_every)) == 0, cut).otherwise(run).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def number_words(counted: DataFrame) -> DataFrame:
    """(id, word, n), staged: ids ascend with (n descending, word ascending)."""
    ranked = staged(counted, "variant-words").orderBy(F.desc("n"), "word")
    return staged(ranked.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "variant-vocabulary")


def _slices(offsets: np.ndarray, budget: int) -> Iterator[tuple[int, int]]:
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + budget, side="right")) - 1, i + 1)
        yield i, min(j, n)
        i = min(j, n)


def _paths(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of words: (first row, end row, owner row and position of every
    boundary, node before it, node after it, character after it, 0 at ends)."""
    data, offsets = text_buffers(column)
    for i, j in _slices(offsets, SLICE_CHARS):
        piece = data[offsets[i] : offsets[j]]
        # code points: of one byte, or of two (U+00C0 to U+00FF)
        lead = (piece & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        two = piece[at] >= 0xC0
        following = piece[np.minimum(at + 1, len(piece) - 1)].astype(np.int64)
        chars = np.where(two, ((piece[at].astype(np.int64) & 0x1F) << 6) | (following & 0x3F), piece[at].astype(np.int64))
        before = np.concatenate(([0], np.cumsum(lead)))
        first = before[offsets[i : j + 1] - offsets[i]]   # first character of every word
        lengths = np.diff(first)
        # one boundary more than characters per word
        owner = np.repeat(np.arange(j - i), lengths + 1)
        begin = np.cumsum(lengths + 1) - (lengths + 1)
        position = np.arange(len(owner)) - begin[owner]
        place = first[owner] + position                    # index into chars
        power, inverse = _tables(len(chars) + 1)
        value = (chars + 1).astype(np.uint64)
        forward = np.concatenate(([np.uint64(0)], np.cumsum(value * power[: len(chars)], dtype=np.uint64)))
        backward = np.concatenate(([np.uint64(0)], np.cumsum(value * inverse[: len(chars)], dtype=np.uint64)))
        start, end = first[owner], first[owner + 1]
        length = end - start
        # the prefix's characters from the left, the suffix's from the right, each weighed by depth
        prefix = mix64((forward[place] - forward[start]) * inverse[start] + position.astype(np.uint64))
        suffix = mix64((backward[end] - backward[place]) * power[np.maximum(end - 1, 0)] + (length - position).astype(np.uint64))
        char = np.where(position < length, np.append(chars, 0)[place], 0)
        yield i, j, owner, position, prefix.view(np.int64), suffix.view(np.int64), char


def _pair_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["id"].to_numpy()
        for i, j, owner, position, prefix, suffix, char in _paths(batch["word"]):
            own = ids[i + owner]
            inside = char != 0
            here = np.flatnonzero(inside)
            # skip position p: prefix before p, suffix after p + 1
            single = (position[here] == 0) | (char[here] != char[np.maximum(here - 1, 0)])
            yield pa.RecordBatch.from_pydict({
                "p": np.concatenate((prefix[here], prefix)),
                "s": np.concatenate((suffix[here + 1], suffix)),
                "gap": np.concatenate((np.zeros(len(here), dtype=bool), np.ones(len(owner), dtype=bool))),
                "single": np.concatenate((single, np.zeros(len(owner), dtype=bool))),
                "id": np.concatenate((own[here], own))})


def _node_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, owner, position, prefix, suffix, char in _paths(batch["word"]):
            here = np.flatnonzero(char != 0)
            length = np.bincount(owner)[owner] - 1
            depths = np.concatenate((position[here] + 1, length[here] - position[here]))
            nodes = np.concatenate((prefix[here + 1], suffix[here]))
            parents = np.concatenate((prefix[here], suffix[here + 1]))
            rows = np.stack((np.repeat([0, 1], len(here)), depths, nodes, parents, np.tile(char[here], 2)))
            rows = np.unique(rows, axis=1)   # shared paths once
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["side", "depth", "node", "parent", "char"])


def check_nodes(words: DataFrame) -> None:
    """Raise unless every node number of both tries stands for one node."""
    nodes = words.select("word").mapInArrow(_node_batches, "side long, depth long, node long, parent long, char long")
    origin = F.struct("depth", "parent", "char")
    clash = nodes.groupBy("side", "node").agg(F.min(origin).alias("a"), F.max(origin).alias("b")).where("a <> b")
    if not clash.isEmpty():
        raise ValueError("two trie nodes share a number")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): for every word with neighbours their number and the
    smallest id among them (the best form)."""
    # Dealt before they are grouped: a task that lists pairs would sort all of
    # its lists to merge hardly any, as most pairs of a task are different.
    pairs = words.select("id", "word").mapInArrow(
        _pair_batches, "p long, s long, gap boolean, single boolean, id long").repartition("p", "s")
    skipped, first = F.when(~F.col("gap"), F.col("id")), F.when(F.col("single"), F.col("id"))
    groups = pairs.groupBy("p", "s").agg(
        F.max(F.when(F.col("gap"), F.col("id"))).alias("short"),
        # at most one word per character of the alphabet
        F.array_sort(F.collect_list(skipped)).alias("long"),
        F.collect_list(first).alias("single"),
    ).where("size(long) > 1 or (size(single) > 0 and short is not null)")
    none = F.lit(None).cast("long")
    m, k = F.size("long"), F.size("single")
    best, second = F.get("long", F.lit(0)), F.get("long", F.lit(1))
    member = lambda w: F.struct(
        w.alias("id"),
        (m - 1 + F.when(F.col("short").isNotNull() & F.array_contains("single", w), 1).otherwise(0)).cast("long").alias("n"),
        F.least(F.when(w == best, second).otherwise(best),
                F.when(F.array_contains("single", w), F.col("short"))).alias("best"))
    whole = F.struct(F.col("short").alias("id"), F.when(F.col("short").isNotNull(), k).otherwise(0).cast("long").alias("n"),
                     F.coalesce(F.array_min("single"), none).alias("best"))
    found = groups.select(F.explode(F.concat(F.transform("long", member), F.array(whole))).alias("r")).where("r.n > 0")
    return found.groupBy("r.id").agg(F.sum("r.n").alias("n_near"), F.min("r.best").alias("best"))


def variant_report(
    documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    drop_every: int = DROP_EVERY, ratio: int = FORM_RATIO,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word."""
    words = number_words(count_words(documents, min_length, min_count, drop_every))
    check_nodes(words)
    near = near_words(words)
    joined = words.join(near, "id", "left")
    other = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    linked = joined.join(other, "best", "left")
    taken = F.col("form_n") >= ratio * F.col("n")
    linked = staged(linked.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best")).alias("form_id"), F.when(taken, F.col("form")).alias("form"),
        F.when(taken, F.col("form_n")).alias("form_n")), "variant-forms")
    # Counts grow at least by the ratio with every form: below 64 steps for any
    # 64-bit count; each round doubles the steps taken.
    reach = linked.where("form_id is not null").select("id", F.col("form_id").alias("to"))
    while True:
        ahead = reach.select(F.col("id").alias("to"), F.col("to").alias("next"))
        moved = staged(reach.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to"),
                                                              F.col("next").isNotNull().alias("moved")), "variant-roots")
        reach = moved.select("id", "to")
        if moved.where("moved").isEmpty():
            break
    roots = reach.join(words.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    return linked.join(roots, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
