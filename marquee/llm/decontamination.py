"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are lower-cased (A-Z and the accented Latin-1 letters) and runs of whitespace become
one space. An item of m bytes occurs in a text within k edits only if some
region shares at least m - q + 1 - q * k of its q-grams on diagonals (text
place minus item place) at most k apart. Shared grams are counted per
document, item and diagonal band; bands are 2k + 2 wide and overlap by half, so
every such group of diagonals lies whole in one band. Regions that meet the
bound are verified by a banded alignment whose text ends are free.

The benchmark is a stated query set, read by the driver in blocks of
``BLOCK_BYTES`` of item text. Every block is run over all texts in one narrow
pass, without a shuffle; its hits are written before the next block is read, so
that the driver and the tasks hold one block at a time. Inside a block, indexes
of ``INDEX_BYTES`` of item text are searched one after the other, so that a gram
which most items share meets few of them at once. The documents' texts never
leave their task.

Parameters: q-grams of ``Q`` bytes; edit budget ``EDIT_SHARE`` of the item's
bytes, lowered where the bound would not stay positive.

Shapes of input: null, empty and short texts and items below ``Q`` bytes match
nothing; items may repeat (each is reported); a null doc_id or item_id is
reported as null; texts of more than ``PIECE_BYTES`` are worked on in pieces that
overlap by the longest item and its budget; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import ROW_KEY, staged
from marquee.llm.textbytes import LOWER, SLICE_BYTES, _SEPARATOR, row_slices, text_buffers

Q = 8
EDIT_SHARE = 0.1
BLOCK_BYTES = 8 << 20
INDEX_BYTES = 1 << 19
PIECE_BYTES = SLICE_BYTES
VERIFY_BATCH = 256
_FILTER_BITS = 22
HIT_SCHEMA = "doc_id long, item_id long, distance int, start_byte long, end_byte long"


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, original place of each byte): lower case, one space."""
    low = LOWER[data]
    if len(low):  # À-Þ in UTF-8: second byte 80-9E after C3 (97 is the multiplication sign)
        capital = (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)
        low[1:][capital] += 32
    space = _SEPARATOR[low]
    low[space] = 32
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    keep = np.ones(len(low), dtype=bool)
    if len(low):
        keep[1:] = ~(space[1:] & space[:-1] & ~edge[1 : len(low)])
    place = np.flatnonzero(keep)
    return low[place], np.searchsorted(place, offsets), place


def packed_grams(data: np.ndarray) -> np.ndarray:
    """Every run of Q = 8 bytes as one integer (an exact value, no hash)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(Q):
        out |= data[i : i + n].astype(np.uint64) << np.uint64(8 * i)
    return out


def _filter_slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)


@dataclass
class Index:
    """Q-grams of a block of items: sorted values, then (item, place) lists."""

    ids: list
    items: list[bytes]
    length: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray


def edit_budget(length: int, share: float = EDIT_SHARE) -> int:
    """Edits allowed; lowered so that the lemma's bound is at least 1."""
    return max(0, min(int(length * share), (length - Q) // Q))


def build_index(rows: list[tuple], share: float = EDIT_SHARE) -> Index:
    ids, items = [], []
    for item_id, text in rows:
        data = np.frombuffer((text or "").strip(" \t\n\x0b\x0c\r").encode(), dtype=np.uint8)
        low, _, _ = normalise(data, np.array([0, len(data)]))
        if len(low) >= Q:
            ids.append(item_id)
            items.append(low.tobytes())
    lengths = np.array([len(x) for x in items], dtype=np.int64)
    budget = np.array([edit_budget(int(n), share) for n in lengths], dtype=np.int64)
    parts = [packed_grams(np.frombuffer(x, dtype=np.uint8)) for x in items]
    grams = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(items)), [len(p) for p in parts]) if parts else np.zeros(0, np.int64)
    place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.zeros(0, np.int64)
    order = np.argsort(grams, kind="stable")
    values, first = np.unique(grams[order], return_index=True)
    present = np.zeros(1 << _FILTER_BITS, dtype=bool)
    present[_filter_slot(values)] = True
    return Index(ids, items, lengths, budget, lengths - Q + 1 - Q * budget, values, np.append(first, len(grams)),
                 item[order].astype(np.int64), place[order], present)


def banded_distances(
    items: list[bytes], text: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray,
    width: np.ndarray, budget: np.ndarray,
) -> list[tuple[int, int, int] | None]:
    """Best (edits, start, end) of each item in its text, or None above budget.

    Candidate c aligns ``items[c]`` with ``text[start[c]:end[c]]`` on the
    diagonals ``low[c] .. low[c] + width[c] - 1`` (text place, from ``start``,
    minus item place) and ``budget[c]`` more on each side. Text before and
    after the occurrence is free. All candidates advance together, an item
    byte at a time; those above their budget leave.
    """
    out: list[tuple[int, int, int] | None] = [None] * len(items)
    if not items:
        return out
    far = np.int32(1 << 20)
    live = np.arange(len(items))
    length = np.array([len(x) for x in items])
    padded = np.zeros((len(items), int(length.max())), dtype=np.uint8)
    for c, x in enumerate(items):
        padded[c, : len(x)] = np.frombuffer(x, dtype=np.uint8)
    first, lanes_of, size = low - budget, width + 2 * budget, end - start
    lanes = np.arange(int(lanes_of.max()))
    place = first[:, None] + lanes                       # text place of each cell
    allowed = (lanes < lanes_of[:, None]) & (place >= 0) & (place <= size[:, None])
    cost = np.where(allowed, 0, far).astype(np.int32)
    begin = place.copy()
    lane32 = lanes.astype(np.int32)
    for i in range(int(length.max())):
        at = i + first[live][:, None] + lanes            # text byte of the diagonal step
        inside = (at >= 0) & (at < size[live][:, None])
        byte = text[np.clip(start[live][:, None] + at, 0, len(text) - 1)]
        straight = np.where(inside, cost + (byte != padded[live, i][:, None]), far)
        skip = np.full_like(cost, far)                   # item byte without a text byte
        skip[:, :-1] = cost[:, 1:] + 1
        from_skip = skip < straight
        carried = begin.copy()
        carried[:, :-1] = np.where(from_skip[:, :-1], begin[:, 1:], begin[:, :-1])
        # text bytes without an item byte: carried along the row
        reach = np.where(from_skip, skip, straight) - lane32
        best = np.minimum.accumulate(reach, axis=1)
        source = np.maximum.accumulate(np.where(reach == best, lanes, 0), axis=1)
        cost = (best + lane32).astype(np.int32)
        begin = np.take_along_axis(carried, source, axis=1)
        cost[(lanes >= lanes_of[live][:, None]) | (at + 1 > size[live][:, None]) | (at + 1 < 0)] = far
        least = cost.min(axis=1)
        done = length[live] == i + 1
        for k in np.flatnonzero(done & (least <= budget[live])):
            c, lane = int(live[k]), int(np.argmin(cost[k]))
            out[c] = (int(cost[k, lane]), int(begin[k, lane]), int(i + 1 + first[c] + lane))
        stay = ~done & (least <= budget[live])
        if not stay.all():
            live, cost, begin = live[stay], cost[stay], begin[stay]
            if not len(live):
                break
    return out


def search(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, start, end) of the best match of each row and item.

    ``data`` is normalised. Places are within the row.
    """
    grams = packed_grams(data)
    if not len(grams) or not len(index.items):
        return
    maybe = np.flatnonzero(index.present[_filter_slot(grams)])
    row = np.searchsorted(offsets, maybe, side="right") - 1
    inside = maybe + Q <= offsets[row + 1]
    maybe, row = maybe[inside], row[inside]
    slot = np.searchsorted(index.grams, grams[maybe])
    slot = np.minimum(slot, len(index.grams) - 1)
    real = index.grams[slot] == grams[maybe]
    maybe, row, slot = maybe[real], row[real], slot[real]
    if not len(maybe):
        return
    n = index.first[slot + 1] - index.first[slot]
    flat = np.repeat(index.first[slot], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    item, place = index.item[flat], index.place[flat]
    spot, row = np.repeat(maybe, n), np.repeat(row, n)
    diagonal = spot - place - offsets[row] + (1 << 31)
    half_of = index.budget + 1
    half = half_of[item]
    band = diagonal // half
    # bands of two halves: half b belongs to bands b and b - 1
    key = (row * len(index.items) + item) << np.int64(32)
    keys = key + band
    seen, counts = np.unique(keys, return_counts=True)
    follow = np.searchsorted(seen, seen + 1)
    follow = np.minimum(follow, len(seen) - 1)
    with_next = counts + np.where(seen[follow] == seen + 1, counts[follow], 0)
    pair = (seen >> np.int64(32)).astype(np.int64)
    item_of = pair % len(index.items)
    good = with_next >= index.bound[item_of]
    chosen = np.flatnonzero(good)
    rows, which = pair[chosen] // len(index.items), item_of[chosen]
    width = 2 * half_of[which]
    low = (seen[chosen] & 0xFFFFFFFF) * half_of[which] - (1 << 31)
    budget, length = index.budget[which], index.length[which]
    size = offsets[rows + 1] - offsets[rows]
    a = np.clip(low - budget, 0, size)
    z = np.clip(low + width + length + budget, 0, size)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    rest = []
    for c in range(len(chosen)):
        r, i = int(rows[c]), int(which[c])
        region = data[offsets[r] + a[c] : offsets[r] + z[c]]
        exact = region.tobytes().find(index.items[i])
        if exact >= 0:
            found = (0, int(a[c]) + exact, int(a[c]) + exact + int(length[c]))
            best[r, i] = min(found, best.get((r, i), found))
        else:
            rest.append(c)
    rest = np.array([c for c in rest if (int(rows[c]), int(which[c])) not in best], dtype=np.int64)
    for at in range(0, len(rest), VERIFY_BATCH):
        c = rest[at : at + VERIFY_BATCH]
        start = offsets[rows[c]] + a[c]
        verified = banded_distances([index.items[i] for i in which[c]], data, start, offsets[rows[c]] + z[c],
                                    low[c] - a[c], width[c], budget[c])
        for k, found in zip(c, verified):
            if found:
                pair_key = (int(rows[k]), int(which[k]))
                found = (found[0], found[1] + int(a[k]), found[2] + int(a[k]))
                best[pair_key] = min(found, best.get(pair_key, found))
    for (r, i), (distance, start, end) in sorted(best.items()):
        yield r, i, distance, start, end


def text_windows(text: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(normalised bytes, original place of each) of one long text, in pieces
    that begin with the last ``overlap`` normalised bytes before them."""
    low, original, at = np.zeros(0, np.uint8), np.zeros(0, np.int64), 0
    while at < len(text):
        end = min(at + max(PIECE_BYTES, overlap), len(text))
        while end < len(text) and end > at + 1 and (text[end] & 0xC0) == 0x80:
            end -= 1                                     # not inside a character
        fresh, _, place = normalise(text[at:end], np.array([0, end - at]))
        again = int(len(low) > 0 and len(fresh) > 0 and low[-1] == 32 and fresh[0] == 32)
        kept = max(len(low) - overlap, 0)
        low, original = np.concatenate((low[kept:], fresh[again:])), np.concatenate((original[kept:], place[again:] + at))
        yield low, original
        at = end


def _search_long(blocks: list[Index], text: np.ndarray) -> Iterator[tuple]:
    """(item_id, distance, start, end) of one long text, places in its bytes."""
    overlap = max((int((x.length + x.budget).max()) for x in blocks if len(x.length)), default=0) + Q
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for low, original in text_windows(text, overlap):
        for b, index in enumerate(blocks):
            for _, k, distance, start, end in search(index, low, np.array([0, len(low)])):
                found = (distance, int(original[start]), int(original[max(end - 1, start)]) + 1)
                best[b, k] = min(found, best.get((b, k), found))
    for (b, k), found in sorted(best.items()):
        yield blocks[b].ids[k], *found


def _search_batches(blocks: list[Index]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["doc_id"].to_pylist()
            hits = []
            for i, j in row_slices(offsets):
                piece = data[offsets[i] : offsets[j]]
                if j - i == 1 and len(piece) > PIECE_BYTES:
                    hits += [(ids[i], *found) for found in _search_long(blocks, piece)]
                    continue
                low, places, original = normalise(piece, offsets[i : j + 1] - offsets[i])
                for index in blocks:
                    for r, k, distance, start, end in search(index, low, places):
                        base = places[r]
                        from_, to = original[base + start], original[base + max(end - 1, start)] + 1
                        own = offsets[i + r] - offsets[i]
                        hits.append((ids[i + r], index.ids[k], distance, int(from_ - own), int(to - own)))
            if hits:
                columns = [pa.array(c, t) for c, t in zip(zip(*hits), (batch["doc_id"].type, pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in HIT_SCHEMA.split(", ")])

    return run


def _blocks(benchmark: DataFrame, share: float, block_bytes: int) -> Iterator[list[Index]]:
    """Indexes of the benchmark, one block at a time (rows are streamed)."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, size, held, small = [], 0, [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        held.append((r["item_id"], r["text"]))
        small += len(r["text"] or "")
        if small >= min(INDEX_BYTES, block_bytes):
            block.append(build_index(held, share))
            size, held, small = size + small, [], 0
            if size >= block_bytes:
                yield block
                block, size = [], 0
    if held:
        block.append(build_index(held, share))
    if block:
        yield block


def find_passages(documents: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and benchmark item that occurs in it.

    Columns: doc_id, item_id, distance (edits of the best occurrence),
    start_byte, end_byte (its place in the text's UTF-8 bytes).
    """
    return _passages(documents, F.col("doc_id").cast("long"), "long", benchmark, share, block_bytes)


def _passages(documents: DataFrame, key: Column, kind: str, benchmark: DataFrame, share: float = EDIT_SHARE,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``find_passages`` with ``key``, of type ``kind``, as the doc_id."""
    schema = HIT_SCHEMA.replace("doc_id long", f"doc_id {kind}")
    rows = documents.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))
    search_all = lambda block: rows.mapInArrow(_search_batches(block), schema)
    found, block = [], None
    for following in _blocks(benchmark, share, block_bytes):
        if block is not None:
            found.append(staged(search_all(block), "leak-hits"))
        block = following
    if block is None:
        return documents.sparkSession.createDataFrame([], schema)
    out = search_all(block)
    for part in found:
        out = out.unionByName(part)
    return out


def contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Ids of the documents that hold a benchmark passage, one row each."""
    return find_passages(documents, benchmark, **options).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("items"), F.min("distance").alias("distance"))


def contaminated_rows(keyed: DataFrame, key: str, benchmark: DataFrame, **options) -> DataFrame:
    """Row keys (column ``key``) of the rows that hold a benchmark passage."""
    return _passages(keyed, F.col(key), ROW_KEY, benchmark, **options).select(F.col("doc_id").alias(key)).distinct()
