"""Mixing sources to target weights, in fixed-length token blocks.

Native: DataFrame functions only.

- *Targets.* Sources, in code-point order with null last, weigh 1, 2, 3,
  repeating, and share the corpus size. A source's target stops at
  ``max_repeat`` times its size; the excess is reshared by weight among the
  others until none is above. The source table has one row per source; it is
  worked out in the driver, so sources are categories, not one per document.
- *Blocks.* The words of a source, in a hashed order of its documents, are
  packed into blocks of ``block_words``; the last block of a source is shorter.
  Block i of a source holds its words [i * block_words, (i + 1) * block_words).
- *Slots.* A source fills whole passes over its blocks and then part of one
  more pass, cut inside its last block, so that exactly round(target) words
  are taken and no word more than ``max_repeat`` times.
- *Shards.* Every slot draws its output shard by a seeded hash, each shard alike
  likely. The slots of a source are thereby a multinomial draw over the shards,
  and the sources of a shard one over the sources, while every source reaches
  its total exactly; a shard has ``shard_slots`` slots on average.
- *Permutations.* Slot r of a pass maps to block (a * r + b) mod n, with a
  prime that does not divide n, different for each source and pass. Slots
  join blocks by that index.

Documents are told apart by a row key, never by ``doc_id``. The order that packs
them is (doc_id, text hash, row number), in chunks by the hash of all three, so
that neither a repeated id nor a repeated row gathers in one task and reruns
over the same files agree.

Shapes of input: a null text has no words and is never taken; a null source
is a source of its own; rows that repeat an id or are wholly alike count, and
are taken, each for itself, as are rows without an id; ties in the order are
rows alike; an empty table gives an empty result; extra columns, whatever their
names, are ignored by the report and kept by ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from marquee.llm._frames import WORD_SPLIT, chunk_count, staged, with_offset, with_row_key, word_count

BLOCK_WORDS = 128
SHARD_SLOTS = 1_024
RUN_SLOTS = 4_096   # slots listed by one row
TASK_SLOTS = 1 << 18   # slots listed by one task
SEED = 20_011
# Helper columns beside those of the documents.
_KEY, _PASS = "__mix_row", "__mix_pass"
MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
# Primes used as steps of the index permutations.
STEPS = (786433, 786449, 786469, 786491, 786511, 786523, 786547, 786551,
         786553, 786587, 786589, 786611, 786613, 786629, 786631, 786659)


def source_targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
                   share: float = 1.0) -> list[tuple[str | None, int, float]]:
    """(source, size, target) of each source; ``sizes`` has one row per source."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    left, open_ = share * sum(n for _, n in ordered), list(ordered)
    target: dict[str | None, float] = {}
    while open_:
        total = sum(weight[s] for s, _ in open_)
        over = [(s, n) for s, n in open_ if left * weight[s] / total > max_repeat * n]
        if not over:
            target.update({s: left * weight[s] / total for s, _ in open_})
            break
        target.update({s: float(max_repeat * n) for s, n in over})
        left -= sum(max_repeat * n for _, n in over)
        open_ = [x for x in open_ if x[0] not in target]
    return [(s, n, float(target[s])) for s, n in ordered]


def _permuted(slot: Column, blocks: Column, rank: Column, turn: Column) -> Column:
    """Index permutation of 0..blocks-1 for one source and pass."""
    steps = F.array(*[F.lit(p).cast("long") for p in STEPS])
    pick = F.pmod(rank * 5 + turn * 3, F.lit(len(STEPS)))
    first = F.element_at(steps, (pick + 1).cast("int"))
    second = F.element_at(steps, (F.pmod(pick + 1, F.lit(len(STEPS))) + 1).cast("int"))
    step = F.when(F.pmod(blocks, first) == 0, second).otherwise(first)
    return F.pmod(slot * step + rank * 7919 + turn * 104729, blocks)


def sized(keyed: DataFrame, key: str) -> DataFrame:
    """Row key, doc_id, source, size (words) and text hash of every document."""
    return keyed.select(
        F.col(key).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("mark"),
    )


def plan_sources(spark, sizes: DataFrame, **options) -> DataFrame:
    """The source table: source, rank, source_size, target, words, blocks."""
    rows = [(r["source"], int(r["n"])) for r in sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    planned = source_targets(rows, **options)
    schema = T.StructType([
        T.StructField("source", T.StringType()), T.StructField("rank", T.LongType()),
        T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
        T.StructField("words", T.LongType()),
    ])
    return spark.createDataFrame([(s, i, n, t, int(t + 0.5)) for i, (s, n, t) in enumerate(planned)], schema)


def slots(sources: DataFrame, partitions: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per possible slot: rank, turn, slot, block and its length, in
    ``partitions`` tasks."""
    live = sources.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    live = live.withColumn("full_turns", F.expr("words div source_size"))
    live = live.withColumn("rest", F.col("words") - F.col("full_turns") * F.col("source_size"))
    # Slots are listed in runs so that no single row explodes without bound.
    turns = live.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full_turns"))))
    turns = turns.withColumn("budget", F.when(F.col("turn") < F.col("full_turns"), F.col("source_size")).otherwise(F.col("rest")))
    runs = turns.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(blocks - 1) div {RUN_SLOTS}"))))
    # a stated number of partitions: small rows that grow would be merged otherwise
    runs = runs.repartition(partitions, "rank", "turn", "run")
    each = runs.withColumn("slot", F.explode(F.expr(f"sequence(run * {RUN_SLOTS}, least(blocks, run * {RUN_SLOTS} + {RUN_SLOTS}) - 1)")))
    each = each.withColumn("block", _permuted(F.col("slot"), F.col("blocks"), F.col("rank"), F.col("turn")))
    # Words before a slot: full blocks, less what the short last block lacks
    # when the permutation has already passed it.
    last = F.col("source_size") - (F.col("blocks") - 1) * block_words
    origin = _permuted(F.lit(0).cast("long"), F.col("blocks"), F.col("rank"), F.col("turn"))
    each = each.withColumn("_last", last).withColumn("_origin", origin)
    each = each.withColumn("length", F.when(F.col("block") == F.col("blocks") - 1, F.col("_last")).otherwise(F.lit(block_words)))
    return each


def mix_slots(sources: DataFrame, words: int, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as slots: rank, turn, slot, block, words taken, shard, position.

    The slot lists are staged: Spark plans their joins by the size of the
    files, not by the size of the source table they were exploded from.
    """
    spark = sources.sparkSession
    expected = words // block_words + 1
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-expected // TASK_SLOTS))
    listed = staged(slots(sources, partitions, block_words), "mix-slots")
    # a row per source and pass: the slot that holds the short last block
    ends = listed.where("block = blocks - 1").select("rank", "turn", F.col("slot").alias("short_slot"))
    planned = listed.join(ends, ["rank", "turn"])
    lacking = F.when(F.col("slot") > F.col("short_slot"), block_words - F.col("_last")).otherwise(0)
    before = F.col("slot") * block_words - lacking
    taken = F.greatest(F.lit(0), F.least(F.col("length"), F.col("budget") - before))
    kept = planned.withColumn("words_taken", taken).where("words_taken > 0")
    # the draw: one of the shards, and a place in it by the hash's other bits
    draw = F.xxhash64(F.lit(SEED), "rank", "turn", "slot")
    shards = max(1, expected // shard_slots)
    drawn = kept.withColumn("draw", draw).withColumn("shard", F.pmod("draw", F.lit(shards).cast("long")))
    in_shard = W.partitionBy("shard").orderBy("draw", "rank", "turn", "slot")
    return staged(drawn.withColumn("position", F.row_number().over(in_shard) - 1).select(
        "rank", "turn", "slot", "block", "words_taken", "shard", "position"), "mix-places")


def pack(sizes: DataFrame, sources: DataFrame, rows: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each row's place in its source: key, doc_id, rank, size, start."""
    named = sources.select(F.col("source").alias("_source"), "rank", "source_size", "target")
    ranked = sizes.join(named, sizes["source"].eqNullSafe(named["_source"])).drop("_source")
    number = F.col("key.row")
    chunked = ranked.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "mark", number), F.lit(chunk_count(rows)).cast("long")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("mark"), number, F.col("key.file")]
    return with_offset(chunked, ["rank"], "size", "chunk", order, "start")


def _mix(keyed: DataFrame, key: str, block_words: int, shard_slots: int, **options):
    sizes = staged(sized(keyed, key), "mix-sizes")
    sources = plan_sources(keyed.sparkSession, sizes, **options)
    totals = sizes.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words")).first()
    placed = pack(sizes, sources, totals["rows"], block_words)
    chosen = mix_slots(sources, totals["words"] or 0, block_words, shard_slots)
    parts = placed.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})"))
    ).select("key", "doc_id", "rank", "block", "start", "size")
    joined = parts.join(chosen, ["rank", "block"])
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("words_taken"))
    segments = joined.withColumn("words", high - low).where("words > 0").select(
        "key", "doc_id", "shard", "position", "turn", (low - F.col("start")).alias("first_word"), "words", "size",
    )
    return placed, segments


def mix(documents: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, **options):
    """(placed documents, segments): the mix itself.

    A segment is the part of a document that one slot takes: key, doc_id,
    shard, position, turn, first_word (within the document), words.
    """
    return _mix(with_row_key(documents, _KEY, "mix-rows"), _KEY, block_words, shard_slots, **options)


def mix_report(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    placed, segments = mix(documents.select("doc_id", "source", "text"), **options)
    taken = segments.groupBy("key").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "key", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(documents: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, **options) -> DataFrame:
    """The mix as documents: a row per document and pass that takes it.

    Text is the words the pass takes, joined by one space when only a part is
    taken; a document taken whole keeps its text unchanged. ``n_chars`` is
    recounted. Blocks of a pass that touch are joined in document order. Spans
    go back to their own row by its key.
    """
    columns = documents.columns
    keyed = with_row_key(documents, _KEY, "mix-rows")
    _, segments = _mix(keyed, _KEY, block_words, shard_slots, **options)
    passes = segments.groupBy("key", "turn").agg(
        F.struct(F.sum("words").alias("taken"), F.max("size").alias("size"),
                 F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("spans")).alias(_PASS),
    ).select(F.col("key").alias(_KEY), _PASS)
    joined = keyed.join(passes, _KEY)
    words = F.filter(F.split("text", WORD_SPLIT), lambda w: w != "")
    cut = F.array_join(F.flatten(F.transform(
        f"{_PASS}.spans", lambda s: F.slice(words, (s["first_word"] + 1).cast("int"), s["words"].cast("int")))), " ")
    text = F.when(F.col(f"{_PASS}.taken") >= F.col(f"{_PASS}.size"), F.col("text")).otherwise(cut)
    out = joined.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*columns)
