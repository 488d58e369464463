"""Small column builders shared by operators and plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def arr_text(c, sep: str = ">") -> Column:
    """Array rendered as text (stable value hashing across engines)."""
    return F.array_join(col(c), sep)


def r6(c) -> Column:
    """Double rounded to 6 decimals, half-up (same as DuckDB ``round``)."""
    return F.round(col(c).cast("double"), 6)


def round_even(c, scale: int) -> Column:
    """Python-style half-even rounding (``bround``)."""
    return F.bround(col(c).cast("double"), scale)


def md5_bucket(c, digits: int = 8) -> Column:
    """First ``digits`` hex digits of md5 as a non-negative integer.

    Equal to DuckDB ``('0x' || substr(md5(x), 1, digits))::BIGINT``.
    """
    return F.conv(F.substring(F.md5(col(c).cast("string")), 1, digits), 16, 10).cast("bigint")


def seeded_hash(key_cols, seed) -> Column:
    """md5 of the key text followed by the seed; the deterministic 'shuffle' key."""
    parts = [col(c).cast("string") for c in key_cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("", *parts))
