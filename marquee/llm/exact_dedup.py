"""Exact deduplication through an extendible-hash index on shared files.

Native: DataFrame functions only. The index maps a 64-bit key of the
normalised text (whitespace deleted) to the chain of texts with that key:

1. *Directory.* Distinct keys are counted by prefix. From an initial depth of
   a few bits, a bucket (a key prefix) that holds more than ``capacity`` keys
   is split by one more bit, which doubles the directory, until none is
   overfull; keys of 64 bits always come apart in the end. The capacity grows
   with the keys, so that the directory starts with at most ``MAX_BUCKETS``
   buckets; a bucket is then a part of an owner task's sorted range.
2. *Routing.* Every row finds its bucket through the directory. Rows of one
   bucket, key and text are combined in the map tasks first: a text held by a
   third of all rows leaves each task as one row.
3. *Owners.* An owner task holds whole buckets, sorted by key and text. Texts
   that collide on a key are compared byte by byte and become the links of one
   chain, numbered by ``chain_pos``. The chains, without texts, are the index
   files in the shared scratch folder.
4. *Lookup.* Every document is routed like the texts were and finds its link
   in its bucket's chain by key and digest.

Shapes of input: a null text counts as empty; empty and blank texts are equal
to each other; repeated rows are members like any other (rows repeating the
kept ``doc_id`` are all marked kept); a null ``doc_id`` loses every tie; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm._frames import staged

CAPACITY = 4_096      # keys per bucket, at least
MAX_BUCKETS = 1 << 16  # buckets at the initial depth, at most
KEY_BITS = 64
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null is empty."""
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SPACES, F.coalesce(text, F.lit("")))


def _prefix(key: Column, bits: int) -> Column:
    """The first ``bits`` (1 to 64) bits of a 64-bit key."""
    return F.shiftrightunsigned(key, KEY_BITS - bits)


def probes(documents: DataFrame, key=F.xxhash64) -> DataFrame:
    """(doc_id, key, text_sha256) of every row, staged.

    ``key`` may be replaced (tests use a colliding one).
    """
    norm = normalised(F.col("text"))
    return staged(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), key(norm).alias("key"), F.sha2(norm, 256).alias("text_sha256"),
    ), "exact-probes")


def directory(keyed: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Bucket of each key prefix at the deepest level, and that level.

    Returns (cell, depth, bucket): a cell is a prefix of ``deepest`` bits, its
    bucket is the shortest prefix, from the initial depth on, that holds at
    most ``capacity`` keys, as doubling the directory step by step finds it.
    """
    keys = staged(keyed.select("key").distinct(), "exact-keys")
    n = keys.count()
    capacity = max(capacity, -(-n // MAX_BUCKETS))
    initial, step = max(1, (max(n, 1) // capacity).bit_length() - 1), 2
    while True:
        deepest = min(initial + step, KEY_BITS)
        cells = keys.groupBy(_prefix(F.col("key"), deepest).alias("cell")).agg(F.count(F.lit(1)).alias("held"))
        if deepest == KEY_BITS or (cells.agg(F.max("held")).first()[0] or 0) <= capacity:
            break
        step *= 2  # some cell is still overfull: look deeper
    steps = cells.select(
        "cell", "held", F.explode(F.sequence(F.lit(initial), F.lit(deepest))).alias("depth")
    ).withColumn("bucket", F.expr(f"shiftrightunsigned(cell, {deepest} - depth)"))
    fit = (
        steps.groupBy("depth", "bucket").agg(F.sum("held").alias("total"))
        .where((F.col("total") <= capacity) | (F.col("depth") == deepest))
    )
    fits = steps.join(fit, ["depth", "bucket"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    found = fits.select("cell", "depth", F.expr(f"shiftrightunsigned(cell, {deepest} - depth)").alias("bucket"))
    return staged(found, "exact-directory"), deepest


def routed(rows: DataFrame, cells: DataFrame, deepest: int) -> DataFrame:
    """``rows`` with the (depth, bucket) that the directory gives their key.

    The directory is a written table: Spark broadcasts it while its size
    allows, and joins by cell beyond.
    """
    return rows.withColumn("cell", _prefix(F.col("key"), deepest)).join(cells, "cell").drop("cell")


def chains(documents: DataFrame, cells: DataFrame, deepest: int, key=F.xxhash64) -> DataFrame:
    """One row per distinct normalised text, in its owner's bucket and chain:
    depth, bucket, key, chain_pos, text_sha256, group_size, keep_id."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normalised(F.col("text")).alias("norm"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("chars"),
    ).withColumn("key", key("norm"))
    # bitwise_not turns "smallest id" into "largest", without overflow
    best = F.max(F.struct("chars", F.bitwise_not("doc_id").alias("not_id")))
    links = routed(rows, cells, deepest).groupBy("depth", "bucket", "key", "norm").agg(
        F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    owners = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = links.repartition(owners, "depth", "bucket")
    chain = W.partitionBy("depth", "bucket", "key").orderBy("norm")  # in the owner's own sort: no further exchange
    return owned.select(
        "depth", "bucket", "key", F.row_number().over(chain).alias("chain_pos"),
        F.sha2("norm", 256).alias("text_sha256"), "group_size", F.bitwise_not("best.not_id").alias("keep_id"))


def exact_dedup(documents: DataFrame, capacity: int = CAPACITY, key=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket."""
    asked = probes(documents, key)
    cells, deepest = directory(asked, capacity)
    index = staged(chains(documents, cells, deepest, key), "exact-index")
    found = routed(asked, cells, deepest).join(index, ["depth", "bucket", "key", "text_sha256"])
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull() & F.col("doc_id").isNull()).alias("kept"),
        "text_sha256", "bucket",
    )
