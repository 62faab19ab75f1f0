"""Exact grouped median whose per-task state does not grow with a group.

``percentile(x, 0.5)`` keeps one count per *distinct* value of a group and
merges a group's partial maps in one task. For minutes that is a few hundred
entries, but over a wide domain the state grows with the number of distinct
values, and a group holding a third of all rows puts its whole map in one task.

``median_by_group`` selects the two middle ranks of each group digit by digit
(a radix select with 16-bit digits), using only aggregates, joins and windows:

1. ``counts``: rows per (group, value). The input passes once, combined
   map-side, and is shuffled on (group, value), so a hot group is spread over
   all tasks by value. Count and sum of a group come from it as well.
2. One round per digit, two for 32-bit values and four for 64-bit values. The
   counts below the prefix already chosen for a rank are added up per next
   digit; a running sum over those digits (at most 65,536 rows per group and
   rank) finds the digit that holds the rank. Buckets are chosen before any
   window, so no window sees the values themselves.
3. After the last digit the prefix is the value; the values at the two middle
   ranks are averaged, as the interpolating ``percentile(x, 0.5)`` does.

The result is exact for any integral values, and the bound holds for all of
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

DIGIT_BITS = 16
_OUTPUT = ("n", "total", "median")


def median_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, n, total, median)`` per group over the non-null integral
    ``value``: row count, sum (double) and the interpolating median."""
    value_type = df.schema[value].dataType
    if not isinstance(value_type, T.IntegralType):
        raise TypeError(f"median_by_group needs an integral column; {value} is {value_type.simpleString()}")
    if group in _OUTPUT:
        raise ValueError(f"group column {group!r} clashes with an output column {_OUTPUT}")
    bits = 64 if isinstance(value_type, T.LongType) else 32
    source = df.select(F.col(group).alias("_g"), F.col(value).cast("long").alias("_v")).where("_v IS NOT NULL")
    counts = source.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    stats = counts.groupBy("_g").agg(
        F.sum("_c").alias("n"), F.sum(F.col("_v").cast("double") * F.col("_c")).alias("total"))
    # The ranks still looked for inside the prefix chosen so far, one row each.
    wanted = stats.select(
        F.col("_g").alias("_wg"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.expr("(n - 1) div 2").alias("rank")),
                          F.struct(F.lit(1).alias("which"), F.expr("n div 2").alias("rank")))).alias("_w"),
    ).select("_wg", "_w.which", "_w.rank", F.lit(None).cast("long").alias("prefix"))
    for shift in range(bits - DIGIT_BITS, -1, -DIGIT_BITS):
        # the prefix above this digit; an arithmetic shift keeps the order of signs
        above = F.expr(f"shiftright(_v, {shift + DIGIT_BITS})") if shift + DIGIT_BITS < bits else F.lit(None).cast("long")
        cells = counts.groupBy("_g", above.alias("_above"), F.expr(f"shiftright(_v, {shift})").alias("_cell")).agg(
            F.sum("_c").alias("_held"))
        met = cells.join(wanted, cells["_g"].eqNullSafe(wanted["_wg"]) & cells["_above"].eqNullSafe(wanted["prefix"]))
        ranks = W.partitionBy("_g", "which").orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
        ranked = met.withColumn("_stop", F.sum("_held").over(ranks))
        wanted = ranked.where("_stop - _held <= rank AND rank < _stop").select(
            F.col("_g").alias("_wg"), "which", (F.col("rank") - (F.col("_stop") - F.col("_held"))).alias("rank"),
            F.col("_cell").alias("prefix"))
    middle = wanted.groupBy("_wg").agg((F.sum(F.col("prefix").cast("double")) / 2.0).alias("median"))
    return stats.join(middle, stats["_g"].eqNullSafe(middle["_wg"])).select(
        F.col("_g").alias(group), "n", "total", "median")
