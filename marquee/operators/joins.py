"""Lookup joins of the builders.

Every join of the pipeline attaches attributes of a dimension (ratings,
titles, series, names) to a fact-like left side and must keep every left
row. The physical strategy is left to Spark on purpose:

* A right side is broadcast only after its size was checked — by the
  optimizer's estimate (``spark.sql.autoBroadcastJoinThreshold``) or, with
  AQE, by the measured shuffle output
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``). Beyond that size the
  join stays a shuffled sort-merge join; nothing here forces a broadcast of
  a side that grows with the data.
* Where the caller measured a dimension (``fits_broadcast``) it may be hinted:
  up to ``LOOKUP_BYTES``, a fixed bound at any size of input, the left side is
  not shuffled for it.
* A hot key on the left side (a series with a huge number of episodes, a
  prolific person, or rows with a null key) lands in one shuffle partition.
  With ``spark.sql.adaptive.skewJoin.enabled`` AQE splits such a partition
  of the *left* side of a left outer join into several tasks, each joined
  with the same right partition, so no single task holds a third of the
  data.
* Duplicate keys on the right fan out, as a plain left join does; callers
  that need one row per key must make the right side unique first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKUP_BYTES = 128 << 20


@dataclass(frozen=True, eq=False)
class Lookup:
    """A dimension's columns that a fact-like dataset takes by ``key``."""

    frame: DataFrame
    key: str


def left_lookup(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (key)``; unmatched right columns are null."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.join(right, on=keys, how="left")


def attach(facts: DataFrame, lookups: Sequence[Lookup], small: Sequence[Lookup] = ()) -> DataFrame:
    """Every lookup joined to ``facts``, by broadcast those in ``small``."""
    for lookup in lookups:
        right = F.broadcast(lookup.frame) if lookup in small else lookup.frame
        facts = left_lookup(facts, right, lookup.key)
    return facts


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether all rows of ``df`` take at most ``limit`` bytes (LOOKUP_BYTES) in a hash table."""
    row = F.lit(32 + 16 * len(df.columns))
    for c in df.columns:
        row = row + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    size = df.agg(F.sum(row.cast("long"))).first()[0] or 0
    return size <= (LOOKUP_BYTES if limit is None else limit)
