"""Suffix-array deduplication of byte strings by longest previous factors.

A byte is removed when a ``length``-byte string that covers it also starts
earlier: in a document of a smaller id, or earlier in the same document.

- *Partition.* A string's seed is its smallest ``GRAM``-byte gram (leftmost on
  ties), so equal strings have equal seeds. Neighbouring strings with the same
  seed gram form one block of text. Documents list their seeds; only blocks
  whose seed occurs in two documents, or twice in one, are sent on, keyed by
  the seed. All strings that can match meet in one group.
- *Longest previous factor.* Groups are packed into bounded texts in document
  order. The suffixes that start a string are sorted (ranks by doubling), the
  previous and next smaller positions in suffix order give each suffix's
  longest earlier match, and a string whose longest previous factor reaches
  ``length`` is a later copy. The first copy stays.
- *Hot seeds.* Up to ``HOT_BLOCKS`` blocks, counted over all documents and every
  place in them, a seed's text is about 3 MB and stays together (a block is at
  most ``2 * length`` bytes). A seed of more blocks is split: its
  strings are dealt by their offset from the seed gram in steps of ``PIECE``,
  and keyed by the ``length - PIECE + 1`` bytes that all strings of a piece
  share. Equal pieces are combined in the map tasks; the first stays in the
  group, all others are later copies.

Texts shuffle once by document for the blocks and once for the removal; what
a stage has written is read back from the shared folder.

Shapes of input: null and short texts lose nothing; texts of any length are
worked on in overlapping pieces; rows that repeat a ``doc_id`` are read as one
document; a row with a null ``doc_id`` is kept whole and is no earlier copy;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import staged
from marquee.llm.textbytes import (
    _tables,
    merge_intervals,
    mix64,
    range_hashes,
    row_slices,
    sliding_minimum,
    text_buffers,
)

LENGTH = 100
GRAM = 24
HOT_BLOCKS = 16_384        # a seed's group is at most so many blocks, about 3 MB
PIECE = 8
EMIT_BLOCKS = 4_096
GROUP_BYTES = 1 << 20      # text of the groups worked on at once
PIECE_BYTES = 1 << 19      # text of documents worked on at once
_PLACE_BITS = 21
BLOCK_SCHEMA = "key long, doc_id long, at long, n int, block binary, is_hot boolean"
SPAN_SCHEMA = "doc_id long, span_start long, span_end long"


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive bytes (a slice of bounded size)."""
    n = len(data)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _tables(n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    return mix64((prefix[width:] - prefix[:-width]) * inverse[: n - width + 1])


def text_pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place in that row, bytes, offsets), about PIECE_BYTES each.

    A text longer than a slice comes in pieces that overlap by length - 1.
    """
    for i, j in row_slices(offsets, PIECE_BYTES):
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= PIECE_BYTES:
            yield i, 0, data[low:high], offsets[i : j + 1] - low
            continue
        for a in range(0, high - low - length + 1, PIECE_BYTES):
            z = min(a + PIECE_BYTES + length - 1, high - low)
            yield i, a, data[low + a : low + z], np.array([0, z - a])


def seed_blocks(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Blocks of neighbouring strings with one seed gram.

    Returns (row, first string, number of strings, place of the seed, seed).
    """
    strings = len(data) - length + 1
    if strings <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    grams = rolling_hashes(data, GRAM)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_minimum(packed, length - GRAM + 1) & mask).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:strings]
    valid = np.arange(strings) + length <= offsets[row + 1]
    fresh = np.ones(strings, dtype=bool)
    fresh[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (valid[1:] != valid[:-1])
    start = np.flatnonzero(fresh)
    count = np.diff(np.append(start, strings))
    use = valid[start]
    start, count = start[use], count[use]
    return row[start], start, count, place[start], grams[place[start]]


def _seed_batches(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for first, _, piece, places in text_pieces(data, offsets, length):
                row, _, _, _, seed = seed_blocks(piece, places, length)
                if not len(row):
                    continue
                order = np.lexsort((seed, row))
                row, seed = row[order], seed[order]
                head = np.concatenate(([True], (row[1:] != row[:-1]) | (seed[1:] != seed[:-1])))
                at = np.flatnonzero(head)
                blocks = np.diff(np.append(at, len(row)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed[at].view(np.int64)), pa.array(ids[first + row[at]]), pa.array(blocks)],
                    ["seed", "doc_id", "blocks"])

    return run


def shared_seeds(rows: DataFrame, length: int, hot_blocks: int) -> DataFrame:
    """(doc_id, seeds, hot): the seeds of a document that occur elsewhere too."""
    listed = staged(rows.mapInArrow(_seed_batches(length), "seed long, doc_id long, blocks long"), "byte-seeds")
    facts = listed.groupBy("seed").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("blocks").alias("n"))
    shared = facts.where("a < b or n > 1").select("seed", (F.col("n") > hot_blocks).alias("is_hot"))
    found = listed.select("seed", "doc_id").join(shared, "seed").groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("is_hot"), F.col("seed"))).alias("seeds"),
        F.collect_set(F.when(F.col("is_hot"), F.col("seed"))).alias("hot"))
    return staged(found, "byte-shared")


def _longs(value) -> np.ndarray:
    return value.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary array of the given byte ranges (ranges may overlap)."""
    ends = np.concatenate(([0], np.cumsum(size)))
    body = np.empty(int(ends[-1]), dtype=np.uint8)
    for a in range(0, len(start), 2_048):  # a bounded index at a time
        z = min(a + 2_048, len(start))
        n = size[a:z]
        index = np.arange(int(n.sum()), dtype=np.int32) + np.repeat((start[a:z] - (ends[a:z] - ends[a])).astype(np.int32), n)
        body[ends[a] : ends[z]] = data[index]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(body)])


def _block_batches(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            cold = [_longs(x) for x in batch["seeds"]]
            hot = [_longs(x) for x in batch["hot"]]
            for first, base, piece, places in text_pieces(data, offsets, length):
                row, start, count, place, seed = seed_blocks(piece, places, length)
                n_rows = len(places) - 1
                for kind, listed in (("cold", cold), ("hot", hot)):
                    wanted = [listed[first + r] for r in range(n_rows)]
                    sizes = [len(x) for x in wanted]
                    if not sum(sizes):
                        continue
                    # membership per (row, seed), as one sorted search
                    known = np.concatenate(wanted) ^ np.repeat(_row_salt(np.arange(n_rows)), sizes)
                    take = np.isin(seed ^ _row_salt(row), known)
                    chosen = np.flatnonzero(take)
                    for part in np.array_split(chosen, -(-len(chosen) // EMIT_BLOCKS) or 1):
                        out = _emit(piece, row[part], start[part], count[part], place[part], seed[part], length, kind == "hot")
                        if out is None:
                            continue
                        keys, rows_, at, n, size, blocks = out
                        yield pa.RecordBatch.from_arrays([
                            pa.array(keys.view(np.int64)), pa.array(ids[first + rows_]),
                            pa.array(at - places[rows_] + base), pa.array(n.astype(np.int32)), blocks,
                            pa.array(np.full(len(n), kind == "hot")),
                        ], ["key", "doc_id", "at", "n", "block", "is_hot"])

    return run


def _row_salt(row: np.ndarray) -> np.ndarray:
    return mix64(row.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def _emit(data, row, start, count, place, seed, length, hot):
    """Rows of one piece; later equal blocks of a row come without bytes."""
    if not len(row):
        return None
    key = seed
    if hot:
        # strings start - place = -offset; deal offsets in steps of PIECE
        far, near = (place - start) // PIECE, (place - (start + count - 1)) // PIECE
        parts = far - near + 1
        index = np.repeat(np.arange(len(row)), parts)
        step = np.repeat(near, parts) + np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        low = np.maximum(start[index], place[index] - (step * PIECE + PIECE - 1))
        high = np.minimum((start + count - 1)[index], place[index] - step * PIECE)
        core = place[index] - step * PIECE
        row, place, seed = row[index], place[index], seed[index]
        start, count = low, high - low + 1
        # bytes shared by all strings the piece can have; where the text ends
        # inside them the piece is keyed by what there is of its own strings
        end = np.minimum(core + length - PIECE + 1, start + length)
        power, inverse = _tables(len(data) + 1)
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])
        key = mix64((prefix[end] - prefix[core]) * inverse[core]) ^ mix64(seed + step.astype(np.uint64))
    size = count + length - 1
    power, inverse = _tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])
    same = mix64((prefix[start + size] - prefix[start]) * inverse[start]) ^ mix64(size.astype(np.uint64) ^ _row_salt(row))
    order = np.argsort(same, kind="stable")
    later = np.zeros(len(row), dtype=bool)
    later[order[1:]] = same[order[1:]] == same[order[:-1]]
    blocks = _gather(data, start, np.where(later, 0, size))
    return key, row, start, count, size, blocks


# ------------------------------------------------------- longest previous factor


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left, -1 where none is.

    All places jump at once along the links found so far.
    """
    n = len(values)
    link = np.arange(-1, n - 1)
    active = np.flatnonzero(link >= 0)
    while len(active):
        larger = active[values[link[active]] > values[active]]
        if not len(larger):
            break
        link[larger] = link[link[larger]]
        active = larger[link[larger] >= 0]
    return link


def _dense(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    rank = np.empty(len(keys), dtype=np.int64)
    step = np.empty(len(keys), dtype=np.int64)
    step[0] = 0
    np.cumsum(keys[order[1:]] != keys[order[:-1]], out=step[1:])
    rank[order] = step
    return rank


def later_copies(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For ascending ``starts``: is the longest previous factor >= length?

    Suffix ranks of 8, 16, ... bytes are found by doubling. Suffixes are then
    sorted by their first ``length`` bytes, ties by place; of a suffix, the
    previous and the next smaller place in that order hold its longest earlier
    match, compared to ``length`` by rank.
    """
    if len(starts) < 2:
        return np.zeros(len(starts), dtype=bool)
    n = len(text)
    padded = np.zeros(n + 2 * length, dtype=np.uint8)
    padded[:n] = text
    keys = np.zeros(n + length, dtype=np.uint64)
    for i in range(8):
        keys = (keys << np.uint64(8)) | padded[i : i + n + length].astype(np.uint64)
    width = 8
    rank = _dense(np.argsort(keys, kind="stable"), keys)
    while width * 2 <= length:
        tail = np.zeros(len(rank), dtype=np.int64)
        tail[: len(rank) - width] = rank[width:]
        pairs = rank * (len(rank) + 1) + tail
        rank = _dense(np.argsort(pairs, kind="stable"), pairs)
        width *= 2
    head, tail = rank[starts], rank[starts + length - width]
    order = np.lexsort((tail, head))          # stable: ties stay in text order
    place = order                              # text order of each sorted suffix
    before = previous_smaller(place)
    after = len(place) - 1 - previous_smaller(place[::-1])[::-1]
    matched = np.zeros(len(starts), dtype=bool)
    for other, there in ((before, before >= 0), (after, after < len(place))):
        own, mate = place[there], place[other[there]]
        matched[own] |= (head[own] == head[mate]) & (tail[own] == tail[mate])
    return matched


def group_spans(doc_id: np.ndarray, at: np.ndarray, count: np.ndarray, blocks: pa.Array, length: int):
    """(doc_id, start, end) of the later copies within whole groups."""
    data, offsets = text_buffers(blocks)
    order = np.lexsort((at, doc_id))
    same = np.zeros(len(order), dtype=bool)  # the same place again: a repeated row
    same[1:] = (doc_id[order[1:]] == doc_id[order[:-1]]) & (at[order[1:]] == at[order[:-1]])
    order = order[~same]
    size = np.diff(offsets)
    hashes = np.zeros(len(size), dtype=np.uint64)
    hashes[:] = range_hashes(data, offsets[:-1], offsets[1:])
    _, first = np.unique(hashes[order] ^ mix64(size[order].astype(np.uint64)), return_index=True)
    copy = np.ones(len(order), dtype=bool)
    copy[first] = False
    copies, firsts = order[copy], order[~copy]
    out = [(doc_id[copies], at[copies], at[copies] + count[copies] + length - 1)]
    # the distinct blocks, in document order; strings unique by hash have no
    # earlier match and are left out of the suffix sort
    body = data[np.arange(int(size[firsts].sum())) + np.repeat(offsets[firsts] - (np.cumsum(size[firsts]) - size[firsts]), size[firsts])]
    places = np.concatenate(([0], np.cumsum(size[firsts])))[:-1]
    n = count[firsts]
    owner = np.repeat(np.arange(len(firsts)), n)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    starts = places[owner] + nth
    if len(starts):
        value = rolling_hashes(body, length)[starts]
        _, inverse, times = np.unique(value, return_inverse=True, return_counts=True)
        again = times[inverse] > 1
        if again.any():
            # keep only the blocks that hold such a string
            used = np.unique(owner[again])
            keep = np.zeros(len(firsts), dtype=bool)
            keep[used] = True
            shift = np.cumsum(np.where(keep, 0, size[firsts]))
            text = body[np.repeat(keep, size[firsts])]
            matched = later_copies(text, starts[again] - shift[owner[again]], length)
            who, where = firsts[owner[again][matched]], nth[again][matched]
            begin = at[who] + where
            out.append((doc_id[who], begin, begin + length))
    return [np.concatenate(x) for x in zip(*out)]


def _factor_batches(length: int):
    """Blocks sorted by key -> spans; whole groups, about GROUP_BYTES at once."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        cols = [table[c].to_numpy() for c in ("doc_id", "at", "n")]
        blocks = table["block"].cast(pa.large_binary()).combine_chunks()
        doc_id, low, high = group_spans(*cols, blocks, length)
        # join neighbouring strings of a document
        order = np.lexsort((low, doc_id))
        doc_id, low, high = doc_id[order], low[order], high[order]
        if len(doc_id):
            fresh = np.concatenate(([True], (doc_id[1:] != doc_id[:-1]) | (low[1:] > high[:-1])))
            head = np.flatnonzero(fresh)
            tops = np.maximum.reduceat(high, head)
            yield pa.RecordBatch.from_arrays([pa.array(doc_id[head]), pa.array(low[head]), pa.array(tops)],
                                             ["doc_id", "span_start", "span_end"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            keys = batch["key"].to_numpy()
            if not len(keys):
                continue
            heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            ends = np.append(heads[1:], len(keys))
            lengths = batch["n"].to_numpy() + length
            for a, z in zip(heads.tolist(), ends.tolist()):
                if keys[a] != last and size >= GROUP_BYTES:
                    yield from flush(held)
                    held, size = [], 0
                held.append(batch.slice(a, z - a))
                size += int(lengths[a:z].sum())
                last = keys[a]
        if held:
            yield from flush(held)

    return run


def _factors(blocks: DataFrame, length: int) -> DataFrame:
    dealt = blocks.repartition(F.col("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(_factor_batches(length), SPAN_SCHEMA)


def _apply_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        out: list[tuple] = []
        held = 0
        for r, spans in enumerate(batch["spans"]):
            text = data[offsets[r] : offsets[r + 1]]
            keep, runs = np.ones(len(text), dtype=bool), 0
            if spans.is_valid and len(spans):
                low = spans.values.field("span_start").to_numpy()
                high = np.minimum(spans.values.field("span_end").to_numpy(), len(text))
                low, high = merge_intervals(low, high)
                for a, z in zip(low.tolist(), high.tolist()):
                    keep[a:z] = False
                runs = int((np.diff(np.concatenate(([1], keep.astype(np.int8)))) == -1).sum())
            kept = text[keep].tobytes()
            out.append((batch["doc_id"][r].as_py(), len(text), len(text) - len(kept), runs, kept, hashlib.sha256(kept).hexdigest()))
            held += len(kept)
            if held >= GROUP_BYTES:
                yield _results(out)
                out, held = [], 0
        if out:
            yield _results(out)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _results(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      [x.split()[0] for x in RESULT.split(", ")])


def later_spans(rows: DataFrame, length: int = LENGTH, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """(doc_id, spans) of every document that holds later copies."""
    known = rows.where("doc_id is not null")
    shared = shared_seeds(known, length, hot_blocks)
    joined = known.join(shared, "doc_id")
    blocks = staged(joined.mapInArrow(_block_batches(length), BLOCK_SCHEMA), "byte-blocks")
    full = F.struct(F.col("at").alias("span_start"), (F.col("at") + F.col("n") + length - 1).alias("span_end"))
    repeated = blocks.where("octet_length(block) = 0").select("doc_id", "at", "n")
    own = blocks.where("octet_length(block) > 0")
    cold, hot = own.where("not is_hot"), own.where("is_hot")
    first = hot.groupBy("key", "block").agg(F.min(F.struct("doc_id", "at", "n")).alias("first"))
    leaders = staged(first.select("key", "first.doc_id", "first.at", "first.n", "block"), "byte-leaders")
    told = leaders.select("key", "block", F.col("doc_id").alias("_d"), F.col("at").alias("_a"))
    followers = hot.join(told, ["key", "block"]).where("doc_id <> _d or at <> _a").select("doc_id", "at", "n")
    whole = repeated.unionByName(followers).select("doc_id", full.alias("span")).select("doc_id", "span.*")
    spans = whole.unionByName(_factors(cold.drop("is_hot"), length)).unionByName(_factors(leaders, length))
    found = spans.groupBy("doc_id").agg(F.collect_list(F.struct("span_start", "span_end")).alias("spans"))
    return staged(found, "byte-spans")


def suffix_dedup(documents: DataFrame, length: int = LENGTH, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans, kept, kept_sha256."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = later_spans(rows, length, hot_blocks)
    joined = rows.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_apply_batches, RESULT)


def suffix_report(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return suffix_dedup(documents, **options).drop("kept")
