"""Substring deduplication of word windows by seed and extend.

A window is ``window`` consecutive words. A word is removed when some window
covers it whose words also start in a document of a smaller id.

- *Seeds.* Every window's seed is the smallest hash of its ``gram``-word
  grams: winnowing, so equal windows have equal seeds. A document lists its
  distinct seeds; documents are joined on them, and a seed of one document
  alone is dropped. No pairs are formed: a seed keeps its first and last
  document, found with map-side combining.
- *Extension.* Around its shared seeds a document's windows are followed both
  ways, and each is matched with the first document that holds the same window
  (two independent 64-bit hashes of its words, 128 bits together; words are
  known by one of 64 bits). This is the
  extension against all partners at once: one row per window, keyed by its
  hashes, whether two or a million documents share it.
- *Hot windows.* At most ``HOT_WINDOWS`` windows can each hold more than a
  ``HOT_WINDOWS``-th of all rows; their first documents are broadcast (so many
  rows at most), all other windows are joined by shuffle.
- *Maximal repeats.* Runs of matched windows become the maximal word ranges;
  a run is never shorter than ``window`` words.

Seeds and windows shuffle as numbers; texts are shuffled once, by document,
and that exchange serves both the extension and the removal.

Shapes of input: null, empty and short texts have no window and keep all their
words; long texts are whole; rows that repeat a ``doc_id`` are read as one
document, whose ranges apply to each; a row with a null ``doc_id`` keeps its
words and is no partner; empty tables give an empty result; other columns are
ignored.
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
    gram_hashes,
    mix64,
    range_hashes,
    row_slices,
    runs_covered,
    sliding_minimum,
    text_buffers,
    word_bounds,
)

WINDOW = 50
GRAM = 16
HOT_WINDOWS = 1_024     # rows of the broadcast, at most
HOT_ROWS = 4_096        # no window of fewer rows is hot


_SECOND = np.uint64(0xD6E8FEB86659FD93)  # words are mixed anew for the second hash


def _row_words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every row, hashed a slice at a time."""
    for i, j in row_slices(offsets):
        piece, places = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = word_bounds(piece, places)
        hashes = range_hashes(piece, starts, ends)
        for r in range(j - i):
            yield i + r, hashes[first[r] : first[r + 1]]


def window_seeds(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Seed of every window of a document: the smallest gram hash in it."""
    if len(words) < window:
        return np.zeros(0, dtype=np.uint64)
    return sliding_minimum(gram_hashes(words, gram), window - gram + 1)


def _seed_batches(window: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            seeds, owners, held = [], [], 0
            for row, words in _row_words(data, offsets):
                own = np.unique(window_seeds(words, window, gram))
                seeds.append(own)
                owners.append(np.full(len(own), ids[row], dtype=np.int64))
                held += len(own)
                if held >= 1 << 18:
                    yield _numbers(["seed", "doc_id"], seeds, owners)
                    seeds, owners, held = [], [], 0
            if held:
                yield _numbers(["seed", "doc_id"], seeds, owners)

    return run


def _numbers(names: list[str], *columns: list[np.ndarray]) -> pa.RecordBatch:
    arrays = [np.concatenate(c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64) if a.dtype == np.uint64 else a) for a in arrays], names)


def shared_seeds(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, seeds): the seeds a document shares with another one."""
    rows = documents.where("doc_id is not null")
    listed = staged(rows.mapInArrow(_seed_batches(window, gram), "seed long, doc_id long"), "window-seeds")
    ends = listed.groupBy("seed").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    found = listed.join(ends.select("seed"), "seed").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds"))
    return staged(found, "shared-seeds")


def _extend_batches(window: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            shared = batch["seeds"]
            windows, checks, owners, at, held = [], [], [], [], 0
            for row, words in _row_words(data, offsets):
                seeds = window_seeds(words, window, gram)
                known = shared[row].values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                hit = np.flatnonzero(np.isin(seeds, known))
                if not len(hit):
                    continue
                windows.append(gram_hashes(words, window)[hit])
                checks.append(gram_hashes(mix64(words + _SECOND), window)[hit])
                owners.append(np.full(len(hit), ids[row], dtype=np.int64))
                at.append(hit.astype(np.int32))
                held += len(hit)
                if held >= 1 << 18:
                    yield _numbers(["window", "check", "doc_id", "at"], windows, checks, owners, at)
                    windows, checks, owners, at, held = [], [], [], [], 0
            if held:
                yield _numbers(["window", "check", "doc_id", "at"], windows, checks, owners, at)

    return run


def later_windows(windows: DataFrame, hot_windows: int = HOT_WINDOWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, at) of the rows whose window a smaller doc_id holds too."""
    key = ["window", "check"]
    facts = windows.groupBy(*key).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = staged(facts.where("first < last").select(*key, "first", "n"), "window-firsts")
    bound = max(hot_rows, windows.count() // hot_windows)    # fewer than hot_windows windows have more rows
    hot = shared.where(F.col("n") > bound).select(*key, F.col("first").alias("hot_first"))
    told = windows.join(F.broadcast(hot), key, "left")
    # Every row meets one first document at most. Rows of hot windows have met
    # theirs: they pass the second join spread by their own place, without a match.
    cold = F.col("hot_first").isNull()
    spread = told.select(
        F.when(cold, F.col("window")).otherwise(F.xxhash64("doc_id", "at")).alias("window"),
        F.when(cold, F.col("check")).alias("check"), "doc_id", "at", "hot_first")
    met = spread.join(shared.where(F.col("n") <= bound).select(*key, "first"), key, "left")
    return met.where(F.col("doc_id") > F.coalesce("hot_first", "first")).select("doc_id", "at")


def _apply_batches(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            hits = batch["hits"]
            for i, j in row_slices(offsets):
                piece, places = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = word_bounds(piece, places)
                raw = piece.tobytes()
                out: list[tuple] = []
                for r in range(j - i):
                    s, e = starts[first[r] : first[r + 1]], ends[first[r] : first[r + 1]]
                    keep = np.ones(len(s), dtype=bool)
                    spans: list[list[int]] = []
                    found = hits[i + r]
                    if found.is_valid and len(found):
                        low, high = runs_covered(np.sort(found.values.to_numpy(zero_copy_only=False)), window)
                        for a, z in zip(low.tolist(), np.minimum(high, len(s)).tolist()):
                            keep[a:z] = False
                            spans.append([a, z])
                    text = b" ".join(raw[a:z] for a, z in zip(s[keep].tolist(), e[keep].tolist()))
                    out.append((len(s), int(len(s) - keep.sum()), spans, text.decode("utf-8", "replace"),
                                hashlib.sha256(text).hexdigest()))
                names = ["n_words", "n_removed", "spans", "kept_text", "kept_sha256"]
                types = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([rows["doc_id"], *columns], ["doc_id", *names])

    return run


RESULT = "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept_text string, kept_sha256 string"


def dedup_windows(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: n_words, n_removed, spans (removed word ranges),
    kept_text (kept words joined by one space) and its SHA-256."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = shared_seeds(rows, window, gram)
    parts = rows.join(shared, "doc_id").mapInArrow(_extend_batches(window, gram), "window long, check long, doc_id long, at int")
    later = later_windows(staged(parts, "windows"))
    hits = staged(later.groupBy("doc_id").agg(F.collect_set("at").alias("hits")), "window-hits")
    joined = rows.join(hits, "doc_id", "left").select("doc_id", "text", "hits")
    return joined.mapInArrow(_apply_batches(window), RESULT)


def window_report(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return dedup_windows(documents, **options).select("doc_id", "n_words", "n_removed", "kept_sha256")
