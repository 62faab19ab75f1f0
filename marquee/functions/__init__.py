"""Reusable ``Column -> Column`` helpers (all JVM-side built-ins, no UDFs)."""

from marquee.functions.columns import (
    decade,
    default_if_null,
    default_if_null_or,
    first_token,
    lenient_cast,
)

__all__ = [
    "decade",
    "default_if_null",
    "default_if_null_or",
    "first_token",
    "lenient_cast",
]
