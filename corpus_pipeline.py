"""The corpus pipeline: five stages over ``documents``, each one operator.

A stage is ``f(spark, docs, sf_dir) -> DataFrame``. Every stage works on all
rows its predecessor kept and all but the last return the columns of
``documents``; between stages the rows are written as Parquet and read back.

Stages decide and act on each row by a row key, never by ``doc_id``: ids may be
null, repeated, or shared by different texts. All stages take empty tables
(empty result), null and empty texts, texts of any length and extra columns,
whatever their names; columns that a stage adds for its own use have names of
its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm._frames import staged, table, with_row_key
from marquee.llm.kd_sharding import kd_shards
from marquee.llm.mixing import mix_documents
from marquee.llm.decontamination import contaminated_rows
from marquee.llm.jaccard_join import placed_rows
from marquee.llm.toxicity import score_documents, train_on_labels


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model rejects (score 0.3 or more) go.

    The model learns from the labels of this run's documents. Each row is scored
    by its text alone, so rows alike share their fate; null and empty texts have
    the score of a text without words and stay.
    """
    model = train_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs, model, prefix="__toxicity_")
    return scored.where("__toxicity_predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the smallest id, nulls
    last, then the smallest row key. Rows without words all stay."""
    keyed = with_row_key(docs, "__pipeline_row", "pipeline-rows")
    placed = placed_rows(keyed, "__pipeline_row").where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    first = placed.groupBy("label").agg(F.min(order).alias("first")).select("label", F.col("first.row").alias("kept"))
    gone = placed.join(first, "label").where("row <> kept").select(F.col("row").alias("__pipeline_row"))
    return keyed.join(gone, "__pipeline_row", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a passage of the benchmark go; null and empty texts hold none."""
    keyed = with_row_key(docs, "__pipeline_row", "pipeline-rows")
    hits = contaminated_rows(keyed, "__pipeline_row", table(spark, sf_dir, "benchmark"))
    return keyed.join(hits, "__pipeline_row", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; repeats are rows.

    A text is taken up to three times, and once in part; of a row taken in part
    the words taken stay, joined by one space. A null source is a source of its
    own; rows without words are never taken.
    """
    return mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are dealt to 16 shards of about equal bytes: doc_id, size, text_crc32,
    shard and slot, with the other columns of the documents, so that the shards
    can be written from the result. A null text weighs one byte; rows alike get
    a slot each."""
    carried = [c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "shard", "slot")]
    return kd_shards(docs, carry=carried)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The toxicity model is trained in numpy; SQL cannot restate the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
