"""Integer-only chunk arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(x: Column, size: int | Column) -> Column:
    """``floor(x / size)`` for any sign, without going through a double."""
    x = x.cast("bigint")
    n = size if isinstance(size, Column) else F.lit(size)
    n = n.cast("bigint")
    return F.call_function("div", x - F.pmod(x, n), n)
