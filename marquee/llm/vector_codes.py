"""Vector code compression: parts of vectors replaced by codebook entries.

Vectors of integers (``floor(1024 * x)``) are cut into equal parts; each part
position has a codebook of up to 256 entries, fitted by a few rounds of
assigning every part to its nearest entry and moving entries to the means of
their parts. All arithmetic is on whole numbers, so results do not depend on
the order of rows or on how they are partitioned.

*Memoised grid cells.* The nearest entry is looked for through a grid over a
part's space. The cell of a part (its components divided by the cell's side) is
looked up in a table kept per task, codebook and batch size bound. A cell met
for the first time gets the list of entries that can be nearest somewhere in
its box: an entry whose least distance to the box is more than another one's
greatest distance is dominated across the box and left out. Only listed entries
are evaluated exactly, so the result is that of comparing with all of them; ties
go to the lower index. Entries far from the cell are ruled out first by the
ball around it (one matrix product); only the others are compared with the box.

Spark does the rest: parts are assigned in the tasks that read the vectors,
sums per entry are added up within a task and then by a small shuffle, and only
codebooks (at most 256 entries a part) pass the driver.

Shapes of input: rows whose vector is null, empty, or holds a null or
non-finite component are dropped, and so is one whose length is not that of the
smallest ``vec_id``'s vector; rows with the same or a null ``vec_id`` are kept
and coded each for itself (nulls come last, equal ids in the order of their
vectors, when the first entries are picked); components beyond 2**17 in size are
held there; a length that the parts do not divide raises ``ValueError``; empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import staged

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
CELL_SIDE = 32           # in integer units
MEMO_CELLS = 1 << 14     # cells remembered per part and task before the table starts anew
WORK_ROWS = 1 << 10      # rows worked on at once
_LIMIT = 1 << 27         # integers are held within this; squared distances then fit 63 bits
_EXACT = 1 << 22         # below this a matrix product of doubles is exact


class CellMemo:
    """Nearest entries of one part position's codebook, through grid cells."""

    def __init__(self, entries: np.ndarray, side: int = CELL_SIDE, capacity: int = MEMO_CELLS):
        self.entries = entries.astype(np.int64)
        self.side, self.capacity = side, capacity
        self.known: dict[bytes, int] = {}
        self.lists: list[np.ndarray] = []
        self.evaluated = 0

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell the entries not dominated across its box, ascending."""
        low = cells * self.side
        high = low + (self.side - 1)
        entries = self.entries
        # the ball around the box: centre low + (side-1)/2, doubled to stay whole
        centre, doubled = low + high, 2 * entries
        radius = np.sqrt(cells.shape[1]) * (self.side - 1)
        far = np.sqrt(np.maximum(_squares(centre, doubled), 0).astype(np.float64))
        # one unit of slack covers the rounding of the roots
        near = far - radius <= (far.min(axis=1) + radius)[:, None] + 1.0
        row, entry = np.nonzero(near)
        below, above = low[row] - entries[entry], entries[entry] - high[row]
        outside = np.maximum(np.maximum(below, above), 0)
        least = (outside * outside).sum(axis=1)
        across = np.maximum(np.abs(below), np.abs(above))
        most = (across * across).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(cells)))
        bound = np.minimum.reduceat(most, first)
        keep = least <= bound[row]
        row, entry = row[keep], entry[keep]
        return np.split(entry, np.searchsorted(row, np.arange(1, len(cells))))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of every row."""
        cells = np.floor_divide(parts, self.side)
        packed = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        names, at, member = np.unique(packed, return_index=True, return_inverse=True)
        names = [n.tobytes() for n in names]
        if len(self.known) + len(names) > self.capacity:
            self.known, self.lists = {}, []
        fresh = [i for i, n in enumerate(names) if n not in self.known]
        if fresh:
            for i, found in zip(fresh, self._candidates(cells[at[fresh]])):
                self.known[names[i]] = len(self.lists)
                self.lists.append(found)
        lists = [self.lists[self.known[n]] for n in names]
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.concatenate(lists)
        # (row, candidate) pairs, rows in order and candidates ascending
        per_row = sizes[member]
        ends = np.cumsum(per_row)
        row = np.repeat(np.arange(len(parts)), per_row)
        entry = flat[np.arange(ends[-1]) - np.repeat(ends - per_row, per_row) + np.repeat(starts[member], per_row)]
        self.evaluated += len(entry)
        gap = parts[row] - self.entries[entry]
        distance = np.einsum("ij,ij->i", gap, gap)
        least = np.minimum.reduceat(distance, ends - per_row)
        hit = np.flatnonzero(distance == least[row])
        _, first = np.unique(row[hit], return_index=True)
        return entry[hit[first]], least


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``, exact."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < _EXACT:
        a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


@dataclass(frozen=True)
class Codebooks:
    """Entries per part position: an integer array (parts, entries, width)."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        """Of all components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def moved(self, means: Iterable) -> Codebooks:
        """Entries replaced by the floored means of their parts; unused stay."""
        out = self.entries.copy()
        for r in means:
            out[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
        return Codebooks(out)


def integer_vectors(embeddings: DataFrame, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, v): the rows that are kept, as integers, staged."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(_LIMIT)), F.lit(-_LIMIT)).cast("int"))
    rows = embeddings.where(x.isNotNull() & (F.size(x) > 0) & finite).select("vec_id", "label", whole.alias("v"))
    rows = staged(rows, "vector-integers")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    if first is None:
        return rows
    if first["n"] % parts:
        raise ValueError(f"vectors of length {first['n']} cannot be cut into {parts} equal parts")
    return rows.where(F.size("v") == first["n"])


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors of smallest ids, one entry each."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: between 1 and 256 entries")
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not rows:
        return None
    v = np.array([r["v"] for r in rows], dtype=np.int64)
    return Codebooks(np.stack(np.split(v, parts, axis=1)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _assigned(batches: Iterable[pa.RecordBatch], books: Codebooks, side: int):
    """(batch, rows, part arrays, indexes, distances) in slices of WORK_ROWS."""
    memos = [CellMemo(e, side) for e in books.entries]
    for batch in batches:
        for i in range(0, batch.num_rows, WORK_ROWS):
            piece = batch.slice(i, WORK_ROWS)
            cut = np.split(_matrix(piece["v"]), len(memos), axis=1)
            yield piece, cut, [m.nearest(np.ascontiguousarray(c)) for m, c in zip(memos, cut)]


def _sum_batches(books: Codebooks, side: int):
    parts, entries, width = books.entries.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for _, cut, found in _assigned(batches, books, side):
            for p, (values, (index, _)) in enumerate(zip(cut, found)):
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                sums[p, used] += np.add.reduceat(values[order], first, axis=0)
                counts[p, used] += np.diff(np.append(first, len(order)))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()),
            "n": pa.array(counts[part, entry]), "sums": pa.array(list(sums[part, entry]), pa.list_(pa.int64()))})

    return run


def fit_codebooks(
    vectors: DataFrame, books: Codebooks, rounds: int = ROUNDS, side: int = CELL_SIDE
) -> Codebooks:
    """``rounds`` rounds of assignment and means over all vectors."""
    width = books.entries.shape[2]
    for _ in range(rounds):
        partial = vectors.select("v").mapInArrow(
            _sum_batches(books, side), "part int, entry int, n long, sums array<long>")
        sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
        total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums)
        books = books.moved(total.select(
            "part", "entry", "n", F.array(*[f"s{i}" for i in range(width)]).alias("sums")).collect())
    return books


def _code_batches(books: Codebooks, side: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, found in _assigned(batches, books, side):
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [piece["vec_id"], piece["label"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"])

    return run


def encode_vectors(vectors: DataFrame, books: Codebooks, side: int = CELL_SIDE) -> DataFrame:
    """(vec_id, label, code, error): one byte per part, and the squared
    distance between the vector and its code."""
    kinds = dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long"
    return vectors.select("vec_id", "label", "v").mapInArrow(_code_batches(books, side), schema)


def vector_code_report(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, side: int = CELL_SIDE
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per kept vector."""
    vectors = integer_vectors(embeddings, parts)
    books = first_codebooks(vectors, parts, entries)
    if books is None:
        return vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                              F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = fit_codebooks(vectors, books, rounds, side)
    coded = staged(encode_vectors(vectors, books, side), "vector-codes")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(totals, coded["label"].eqNullSafe(totals["_label"]))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                         F.lit(books.sha256).alias("codebooks_sha256"))
