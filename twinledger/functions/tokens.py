"""Comparison tokens, row hashes and row fingerprints.

Two digests of a row are offered:

* ``row_hash`` - md5 over the text tokens. Stable across engines, so it is the
  value to publish or to compare with another system.
* ``fingerprint`` - two independently seeded ``xxhash64`` words. It answers
  the same question (are these rows equal?) when both sides are read by Spark,
  costs a fraction of md5, and fits numeric aggregation buffers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.logical_types import (
    DEFAULT_FLOAT_SCALE,
    FLOAT_UDTS,
    OPAQUE_UDTS,
    TIMESTAMP_UDTS,
    LogicalType,
    Types,
    logical,
)

# Marker characters inside tokens and keys.
NULL_MARK = "\x01"
OPAQUE_MARK = "\x02"
KEY_SEPARATOR = "\x1c"
COLUMN_SEPARATOR = "\x1d"

# Text spellings that count as a true boolean.
_TRUE_WORDS = ("t", "true", "1", "yes", "on")

_SECONDS = "yyyy-MM-dd HH:mm:ss"
_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_bool(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.StringType):
        return F.lower(F.trim(c)).isin(*_TRUE_WORDS)
    return c.cast("bigint") != 0


_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)$"


def _timestamp_text(c: Column, dtype: T.DataType, precision: str, zoned: bool = False) -> Column:
    pattern = _SECONDS if precision == "second" else _MICROS
    if isinstance(dtype, T.TimestampType):
        return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), pattern)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.date_format(c, pattern)
    text = F.regexp_replace(c.cast("string"), "T", " ")
    plain = F.substring(text, 1, 19) if precision == "second" else F.regexp_replace(text, _OFFSET, "")
    if not zoned:
        return plain
    # An instant with an offset is shown in UTC, like a timestamp column.
    instant = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone())
    return F.when(text.rlike(_OFFSET), F.coalesce(F.date_format(instant, pattern), plain)).otherwise(plain)


def _float_text(c: Column, scale: int) -> Column:
    """Fixed-point text, since engines print the same double differently."""
    return F.coalesce(c.try_cast(T.DecimalType(38, scale)).cast("string"), c.cast("string"))


def column_token(
    c: Column | str,
    logical_type: LogicalType | str,
    dtype: T.DataType | None = None,
    ts_precision: str = "second",
    compare_opaque: str = "null",
) -> Column:
    """Never-null text that is equal on both sides exactly when the data is.

    ``dtype`` is the Spark type behind ``c``; strings are assumed if omitted.
    ``compare_opaque='md5'`` compares the content of opaque columns as well.
    """
    c = quoted(c) if isinstance(c, str) else c
    dtype = dtype or T.StringType()
    t = logical(logical_type)
    if t.udt in OPAQUE_UDTS:
        if isinstance(dtype, T.VariantType):
            content = F.md5(F.to_json(c))
        else:
            content = F.md5(c.cast("binary")) if compare_opaque == "md5" else None
        shown = content if compare_opaque == "md5" else F.lit(OPAQUE_MARK)
        return F.when(c.isNull(), F.lit(NULL_MARK)).otherwise(shown)
    if t.udt == "bool":
        text = F.when(_as_bool(c, dtype), F.lit("true")).otherwise(F.lit("false"))
        return F.when(c.isNull(), F.lit(NULL_MARK)).otherwise(text)
    if t.udt in TIMESTAMP_UDTS:
        text = _timestamp_text(c, dtype, ts_precision, t.udt == "timestamptz")
    elif t.udt in FLOAT_UDTS:
        text = _float_text(c, DEFAULT_FLOAT_SCALE if t.scale is None else t.scale)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def tokens(df: DataFrame, cols: Sequence[str], types: Types, **options) -> list[Column]:
    """One token column per name, in the given order."""
    return [
        column_token(c, types.get(c, "text"), df.schema[c].dataType, **options) for c in cols
    ]


def row_hash(
    df: DataFrame, cols: Sequence[str], types: Types, strict: bool = False, **options
) -> Column:
    """md5 over all tokens, key columns included.

    ``strict`` puts each token's length in front of it, so values that hold
    the separator or the NULL mark cannot collide.
    """
    parts = tokens(df, cols, types, **options)
    if strict:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat_ws(COLUMN_SEPARATOR, *parts))


def hash_slices(h: Column) -> list[Column]:
    """The four 8-hex-digit parts of an md5 as unsigned 32-bit integers."""
    return [
        F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)
    ]


def _native(c: Column, t: LogicalType, dtype: T.DataType) -> Column | None:
    """Typed stand-in for the token when both sides share ``dtype``."""
    if t.udt in OPAQUE_UDTS:
        return F.lit(True)
    if t.udt == "bool":
        return _as_bool(c, dtype)
    if t.udt in TIMESTAMP_UDTS:
        if isinstance(dtype, T.TimestampType):
            return F.unix_seconds(c)
        if isinstance(dtype, T.TimestampNTZType):
            day = F.unix_date(c.cast("date")).cast("bigint") * 86400
            return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        return None
    if t.udt in FLOAT_UDTS:
        if not isinstance(dtype, (T.DoubleType, T.FloatType)):
            return None
        scale = DEFAULT_FLOAT_SCALE if t.scale is None else t.scale
        fixed = c.try_cast(T.DecimalType(38, scale))
        # Values a decimal cannot hold (NaN, infinity) count as they are.
        return F.struct(fixed, F.when(fixed.isNull(), c))
    if isinstance(dtype, (T.IntegralType, T.StringType, T.DateType, T.DecimalType)):
        return c
    return None


def _scale(dtype: T.DataType) -> int | None:
    """Digits behind the point of an exact number, None for anything else."""
    if isinstance(dtype, T.IntegralType):
        return 0
    return dtype.scale if isinstance(dtype, T.DecimalType) else None


def _one_scale(c: Column, t: LogicalType, dtype: T.DataType, other: T.DataType) -> Column | None:
    """Exact numbers of two Spark types in the finer of their scales."""
    here, there = _scale(dtype), _scale(other)
    if here is None or there is None or t.udt == "bool" or t.udt in OPAQUE_UDTS | FLOAT_UDTS | TIMESTAMP_UDTS:
        return None
    wide = c.try_cast(T.DecimalType(38, max(here, there)))
    # Values too large for it count as they are.
    return F.struct(wide, F.when(wide.isNull(), c.cast("string")))


def fingerprint(
    df: DataFrame,
    cols: Sequence[str],
    types: Types,
    other_schema: T.StructType | None = None,
    strict_numbers: bool = False,
    **options,
) -> list[Column]:
    """Two 64-bit words that stand for the row's tokens.

    Exact numbers of two types are brought to one scale first, so ``1.00`` and
    ``1.0000`` are the same; ``strict_numbers`` compares them as they are written.

    A column whose Spark type is the same in ``other_schema`` is hashed as it
    is instead of as text; NULLs are told apart by flags that are hashed in front
    of the values.
    """
    default_rules = not options
    values, null_flags = [], []
    for name in cols:
        c, dtype, t = quoted(name), df.schema[name].dataType, logical(types.get(name, "text"))
        same = other_schema is not None and other_schema[name].dataType == dtype
        native = _native(c, t, dtype) if same and default_rules else None
        if native is None and other_schema is not None and not same and not strict_numbers:
            native = _one_scale(c, t, dtype, other_schema[name].dataType)
        values.append(column_token(c, t, dtype, **options) if native is None else native)
        null_flags.append(c.isNull())
    return digest_pair([*null_flags, *values])


def digest_pair(parts: Sequence[Column]) -> list[Column]:
    """Two independently seeded 64-bit hashes of the same values."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def key_text(cols: Sequence[Column | str]) -> Column:
    """Printable key; joins and grouping always use the typed columns instead."""
    parts = [quoted(c) if isinstance(c, str) else c for c in cols]
    texts = [p.cast("string") for p in parts]
    return texts[0] if len(texts) == 1 else _joined(texts)


def _joined(texts: Sequence[Column]) -> Column:
    """Parts of a composite key; a NULL part keeps its place."""
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(t, F.lit(NULL_MARK)) for t in texts])


def canonical_key(cols: Sequence[Column | str]) -> Column:
    """Key text under which ``'007'``, ``' 7'`` and ``7`` are the same."""
    parts = [quoted(c) if isinstance(c, str) else c for c in cols]
    texts = []
    for p in parts:
        text = F.trim(p.cast("string"))
        texts.append(
            F.coalesce(text.try_cast(T.DecimalType(38, 10)).cast("string"), F.lower(text))
        )
    return texts[0] if len(texts) == 1 else _joined(texts)
