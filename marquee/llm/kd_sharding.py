"""Sharding by a k-d tree over document metadata.

A node that must hold k leaves is split at the weighted median (by bytes) of
its widest dimension, in proportion floor(k/2) : ceil(k/2), until every leaf
is one shard of the target bytes. The dimensions are the documents' metadata:
script, layout and word length of the text, and its language and source, where
the table has these columns, by their place in lexical order; each is scaled to
20 bits over the whole table. Equal texts count with the first language and
source of their group, so that they have the same place in the tree.

The median is exact and distributed: a radix select. Each pass adds up the
bytes per digit of the split key below the prefix already fixed, in Spark,
and only the digit histograms of the open nodes (at most 4,096 rows a node)
reach the driver. The split key is (scaled dimension, text CRC): the CRC only
breaks ties inside one value of the dimension, and equal texts stay on one side; a group of equal texts heavier than ``tolerance`` of
a shard is itself cut, by a hash of ``doc_id``, because the law of the
sharding is equal bytes.

Shapes of input: a null text weighs one byte and counts as empty for its CRC;
a null language or source comes first in its dimension;
a null ``doc_id`` is hashed as zero; repeated rows, whether or not they share an
id, are told apart by a row key and get a slot each (ties in the order of slots
are rows alike); an empty table gives an empty result; other columns are ignored
unless ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import chunk_count, staged, with_offset, with_row_key

N_SHARDS = 16
TOLERANCE = 0.02       # largest group of equal texts kept whole, in shards
DIGIT_BITS = 12
SCALE_BITS = 20
KEY_BITS = SCALE_BITS + 32           # scaled dimension, then the CRC


def text_dimensions() -> dict[str, Column]:
    """Dimensions of a text: bytes per character (the script), lines per
    character (the layout) and blanks per character (the length of words).

    Length is no dimension: it would gather the longest texts in one leaf,
    where a single row is a large part of a shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size, chars = F.octet_length(text), F.char_length(text)

    def per_char(mark: str, without: float) -> Column:
        marks = size - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))
        return F.when(chars > 0, marks / chars).otherwise(F.lit(without))

    return {
        "bytes_per_char": F.when(chars > 0, size / chars).otherwise(F.lit(1.0)),
        "lines_per_char": per_char("\n", 0.0),
        "blanks_per_char": per_char(" ", 0.0),
    }


def category_dimensions(documents: DataFrame, names: Sequence[str] = ("lang", "source")) -> dict[str, Column]:
    """Place of each category in lexical order: its first six bytes as a number."""
    def place(name: str) -> Column:
        head = F.hex(F.substring(F.col(name).cast("string").cast("binary"), 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")

    return {n: place(n) for n in names if n in documents.columns}


_KEY = "__kd_row"


def measured(documents: DataFrame, dimensions: dict[str, Column], categories: dict[str, Column]) -> DataFrame:
    """Row key, doc_id, size, text_crc32 and the raw dimensions of every row of
    a frame keyed by ``with_row_key``, staged."""
    text = F.coalesce(F.col("text"), F.lit(""))
    both = [*dimensions.values(), *categories.values()]
    rows = staged(documents.select(
        F.col(_KEY).alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        *[c.cast("double").alias(f"d{i}") for i, c in enumerate(both)],
    ), "kd-rows")
    own = [f"d{i}" for i in range(len(dimensions), len(both))]
    if not own:
        return rows
    # rows of one text may differ in these: the smallest value counts for all
    groups = rows.groupBy("text_crc32", "size").agg(*[F.min(d).alias(d) for d in own])
    return staged(rows.drop(*own).join(groups, ["text_crc32", "size"]), "kd-grouped")


def _scaled(rows: DataFrame, n: int) -> DataFrame:
    """Dimensions as integers of SCALE_BITS bits over the table's range."""
    low_high = rows.agg(*[f(f"d{i}") for i in range(n) for f in (F.min, F.max)]).first()
    top = (1 << SCALE_BITS) - 1
    out = rows
    for i in range(n):
        low, high = low_high[2 * i], low_high[2 * i + 1]
        width = (high - low) if low is not None and high > low else None
        scaled = F.floor((F.col(f"d{i}") - F.lit(low)) * F.lit(top / width)) if width else F.lit(0)
        out = out.withColumn(f"q{i}", F.coalesce(scaled, F.lit(0)).cast("long"))
    tie = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(1 << 36))
    return out.select("row_key", "doc_id", "size", "text_crc32", *[f"q{i}" for i in range(n)], tie.alias("tie"))


def _by_node(values: dict[int, int | None], node: Column) -> Column:
    """Lookup of a small per-node table (at most the number of shards)."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("long"))]
    return F.element_at(F.create_map(*pairs), node) if pairs else F.lit(None).cast("long")


def _select(rows: DataFrame, key: str, bits: int, aims: dict[int, float]) -> dict[int, tuple[int, float, float]]:
    """Weighted select per node: (key value, bytes before it, bytes at it).

    ``rows`` has node, ``key`` and size. ``aims`` are the bytes wanted before
    the cut. Each pass fixes DIGIT_BITS bits of the answer.
    """
    prefix = {n: 0 for n in aims}
    before = {n: 0.0 for n in aims}
    weight = {n: 0.0 for n in aims}
    fixed = 0
    while fixed < bits:
        step = min(DIGIT_BITS, bits - fixed)
        shift = bits - fixed - step
        head = _by_node(prefix, F.col("node"))
        digit = F.expr(f"shiftright({key}, {shift}) & {(1 << step) - 1}")
        open_rows = rows.where((F.expr(f"shiftright({key}, {shift + step})") if shift + step < 64 else F.lit(0)) == head)
        found: dict[int, list] = {}
        for r in open_rows.groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("w")).collect():
            found.setdefault(r["node"], []).append((r["digit"], r["w"]))
        for node, cells in found.items():
            run = before[node]
            for d, w in sorted(cells):
                if run + w > aims[node] or d == max(cells)[0]:
                    prefix[node] = (prefix[node] << step) | d
                    before[node], weight[node] = run, w
                    break
                run += w
        fixed += step
    return {n: (prefix[n], before[n], weight[n]) for n in aims}


def kd_assign(rows: DataFrame, n_dims: int, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``node``, the leaf 0..n_shards-1 of every row."""
    rows = _scaled(rows, n_dims)
    rows = rows.withColumn("node", F.lit(0))
    leaves = {0: n_shards}          # node -> shards below it; a node is its first shard
    while any(k > 1 for k in leaves.values()):
        facts = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("w"), *[(F.max(f"q{i}") - F.min(f"q{i}")).alias(f"r{i}") for i in range(n_dims)]).collect()}
        split = {n: k for n, k in leaves.items() if k > 1 and n in facts}
        if not split:
            break
        widest = {n: max(range(n_dims), key=lambda i: (facts[n][f"r{i}"], -i)) for n in split}
        aims = {n: facts[n]["w"] * (k // 2) / k for n, k in split.items()}
        which = _by_node(widest, F.col("node"))
        chosen = F.coalesce(*[F.when(which == i, F.col(f"q{i}")) for i in range(n_dims)])
        keyed = rows.withColumn("key", F.shiftleft(chosen, 32).bitwiseOR(F.col("text_crc32")))
        cut = _select(keyed.where(which.isNotNull()), "key", KEY_BITS, aims)
        # rows before the cut key go left; the group at the cut goes to the
        # nearer side, or is itself cut when it is too heavy for either
        side_at, heavy = {}, {}
        for n, (key, before, weight) in cut.items():
            over, under = before + weight - aims[n], aims[n] - before
            side_at[n] = 0 if over <= under else 1
            if min(over, under) > tolerance * facts[n]["w"] / split[n]:
                heavy[n] = under
        ties = {n: None for n in cut}
        if heavy:
            at = keyed.where(F.col("key") == _by_node({n: cut[n][0] for n in heavy}, F.col("node")))
            ties |= {n: t for n, (t, _, _) in _select(at, "tie", 36, heavy).items()}
        cut_key, at_side = _by_node({n: c[0] for n, c in cut.items()}, F.col("node")), _by_node(side_at, F.col("node"))
        tie = _by_node(ties, F.col("node"))
        right = F.when(F.col("key") != cut_key, F.col("key") > cut_key).otherwise(
            F.when(tie.isNotNull(), F.col("tie") >= tie).otherwise(at_side == 1))
        jump = _by_node({n: k // 2 for n, k in split.items()}, F.col("node"))
        rows = keyed.withColumn(
            "node", F.when(jump.isNotNull() & right, F.col("node") + jump).otherwise(F.col("node")).cast("int")).drop("key")
        rows = staged(rows, "kd-level")
        leaves = {m: c for n, k in leaves.items() for m, c in (((n, k // 2), (n + k // 2, k - k // 2)) if k > 1 else ((n, k),))}
    return rows


def kd_shards(documents: DataFrame, n_shards: int = N_SHARDS, dimensions: dict[str, Column] | None = None,
              target_bytes: int | None = None, tolerance: float = TOLERANCE, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row, and the ``carry``
    columns of its document (its text, so that shards can be written from it).

    ``target_bytes`` sets the number of shards from the data instead.
    ``dimensions`` replace all of the table's own.
    """
    dims = dimensions or text_dimensions()
    categories = {} if dimensions else category_dimensions(documents)
    keyed = with_row_key(documents, _KEY, "kd-input")
    rows = measured(keyed, dims, categories)
    if target_bytes:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, -(-total // target_bytes))
    leaf = kd_assign(rows, len(dims) + len(categories), n_shards, tolerance).withColumnRenamed("node", "shard")
    number = F.col("row_key.row")
    chunked = leaf.withColumn("one", F.lit(1)).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text_crc32", number), F.lit(chunk_count(rows.count()))))
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size"), number, F.col("row_key.file")]
    numbered = with_offset(chunked, ["shard"], "one", "chunk", order, "slot")
    placed = numbered.select("row_key", "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")
    if not carry:
        return placed.drop("row_key")
    # named apart, since the document's own columns may be called the same
    texts = keyed.select(F.col(_KEY).alias("row_key"), F.struct(*carry).alias(_KEY))
    return placed.join(texts, "row_key").select(
        "doc_id", "size", "text_crc32", "shard", "slot", *[F.col(f"{_KEY}.`{c}`").alias(c) for c in carry])


def shard_report(documents: DataFrame, **options) -> DataFrame:
    """``kd_shards`` with the law it keeps (equal bytes) and no grown shard."""
    return kd_shards(documents, **options).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
