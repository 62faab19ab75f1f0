"""Column expressions shared by the builders, the serving layer and reports.

All helpers return built-in Spark expressions, so they stay inside
whole-stage code generation and can be pushed or folded by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import LIST_SEPARATOR, UNKNOWN

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(c: ColumnLike, data_type: T.DataType | str) -> Column:
    """Cast that yields null for text that does not parse.

    Spark 4 runs with ANSI semantics, where a plain ``cast('abc' as int)``
    fails the job; raw catalogue files hold such values, so every raw
    number goes through ``try_cast``.
    """
    return _col(c).try_cast(data_type)


def default_if_null(c: ColumnLike, default) -> Column:
    """``ifNull(c, default)``."""
    return F.coalesce(_col(c), F.lit(default))


def default_if_null_or(c: ColumnLike, sentinel: str, default) -> Column:
    """Replace null and one sentinel text value with ``default``."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit(sentinel)), F.lit(default)).otherwise(c)


def first_token(
    c: ColumnLike, sep: str = LIST_SEPARATOR, default: str = UNKNOWN
) -> Column:
    """First element of a separator-joined list; null or '' gives ``default``.

    ``substring_index`` cuts at the first separator without building an
    array. A list that starts with the separator yields '' (kept as is).
    """
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(default)).otherwise(
        F.substring_index(c, sep, 1)
    )


def decade(year: ColumnLike) -> Column:
    """``floor(year / 10) * 10`` as an int."""
    return (F.floor(_col(year) / F.lit(10)) * F.lit(10)).cast(T.IntegerType())
