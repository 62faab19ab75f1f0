"""Connected components of a link table, as alternating star operations.

Each round reads and writes staged tables; a node's neighbours are never
gathered into one row or task. Minima are taken with map-side combining and
joined back, so a hub that a third of all nodes link to is no hot task. The
driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm._frames import staged

MAX_ROUNDS = 64  # rounds are logarithmic in the longest path


def _smallest(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u links to the smallest of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u itself, link to the smallest of them."""
    least = _smallest(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b: bigint); label is the
    smallest node reachable. Nodes without links are not listed."""
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        edges = staged(_small_star(_large_star(edges)), "stars")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return labels.unionByName(roots)
