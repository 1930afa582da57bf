"""Per-value conversions between the two sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.tokens import quoted

ZERO_DATE_PREFIX = "0000-00-00"
REPLACEMENT_CHARACTER = "�"


def timestamptz_to_datetime(
    c: Column | str, target_zone: str = "UTC", pattern: str = "yyyy-MM-dd HH:mm:ss"
) -> Column:
    """ISO-8601 UTC text with any fraction -> wall-clock text in one zone."""
    c = quoted(c) if isinstance(c, str) else c
    instant = F.to_utc_timestamp(c.try_cast("timestamp"), F.current_timezone())
    return F.date_format(F.from_utc_timestamp(instant, target_zone), pattern)


# Longest mapping that is broadcast; its bytes are limited as well.
MAPPING_ROWS = 1_000_000


def enum_remap(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace mapped labels; labels without an entry pass through."""
    c = quoted(c) if isinstance(c, str) else c
    if not mapping:
        return c
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def enum_remap_join(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Same, for a mapping kept as a table of unique ``(label, mapped)`` rows.

    The mapping is stored first; if it is proven to be small it is broadcast, so a table with a few
    hot labels is not shuffled on them.
    """
    from twinledger.operators.balance import small_enough, written

    stored = written(mapping.select("label", "mapped"), "mapping")
    lookup = stored.select(F.col("label").alias(column), F.col("mapped").alias("_mapped"))
    if small_enough(stored, MAPPING_ROWS):
        lookup = F.broadcast(lookup)
    joined = df.join(lookup, column, "left")
    chosen = F.coalesce("_mapped", quoted(column)).alias(column)
    return joined.select(*[chosen if c == column else quoted(c) for c in df.columns])


def bool_to_tinyint(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Booleans become 1 and 0; NULL stays NULL."""
    return df.withColumns({c: quoted(c).cast("tinyint") for c in cols})


def is_zero_date(c: Column | str) -> Column:
    """True for text such as ``0000-00-00 00:00:00``; NULL counts as false."""
    c = quoted(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string").startswith(ZERO_DATE_PREFIX), F.lit(False))


def has_replacement_character(cols: Sequence[str]) -> Column:
    """True when any column holds U+FFFD."""
    found = F.lit(False)
    for c in cols:
        found = found | F.coalesce(
            F.instr(quoted(c).cast("string"), REPLACEMENT_CHARACTER) > 0, F.lit(False)
        )
    return found


def has_non_ascii(c: Column | str) -> Column:
    """True when the text needs more bytes than characters."""
    c = quoted(c) if isinstance(c, str) else c
    return F.coalesce(F.octet_length(c) != F.char_length(c), F.lit(False))
