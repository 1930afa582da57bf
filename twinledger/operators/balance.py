"""The shared shape of every two-sided comparison.

Both sides are tagged +1 / -1, unioned and grouped. Equal content cancels to
zero, so one shuffle answers "who has it, and is it the same" with numeric
aggregation buffers only. Rows that share a group are combined before the
shuffle, so a key or chunk that holds a large part of the table costs one row
per map task, and no group is ever paired row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.tokens import quoted
from twinledger.session import scratch_path

LEFT, RIGHT = 1, -1
MAX_BROADCAST_BYTES = 64 << 20
_LOW_24_BITS = 0xFFFFFF


def aligned_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> dict[str, T.DataType]:
    """Spark type each key is compared in, where the two sides may differ."""
    out = {}
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a == b:
            out[k] = a
        elif isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
            out[k] = T.LongType()
        elif isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
            out[k] = T.DecimalType(38, 10)
        else:
            out[k] = T.StringType()
    return out


def key_columns(keys: Sequence[str], key_types: dict[str, T.DataType]) -> list[Column]:
    return [quoted(k).cast(key_types[k]).alias(k) for k in keys]


def signed_rows(
    df: DataFrame, side: int, group: Sequence[Column], digest: Sequence[Column]
) -> DataFrame:
    """``group`` columns, the side, and the two digest words as ``_h0, _h1``."""
    words = [d.alias(f"_h{i}") for i, d in enumerate(digest)]
    return df.select(*group, F.lit(side).cast("bigint").alias("_side"), *words)


def balance(
    left: DataFrame, right: DataFrame, group: Sequence[str], with_digest: bool = True
) -> DataFrame:
    """``(group, n_left, n_right, same)``; ``same`` means both sides cancel out.

    Three things have to agree: the row counts, the XOR of both 64-bit digest
    words over both sides, and the signed sums of 24 bits of each word. XOR
    alone is blind to a row that occurs twice on one side; the sums see it.
    A sum stays inside a bigint up to 2^39 rows in one group, and Spark's ANSI
    mode raises rather than wraps beyond that.
    """
    side = F.col("_side")
    aggs = [F.count_if(side > 0).alias("n_left"), F.count_if(side < 0).alias("n_right")]
    same = F.col("n_left") == F.col("n_right")
    for word in ("_h0", "_h1") if with_digest else ():
        low = F.col(word).bitwiseAND(F.lit(_LOW_24_BITS))
        aggs += [F.bit_xor(word).alias(word), F.sum(side * low).alias(word + "s")]
        same = same & (F.col(word) == 0) & (F.col(word + "s") == 0)
    out = left.unionByName(right).groupBy(*[quoted(g) for g in group]).agg(*aggs)
    return out.select(*[quoted(g) for g in group], "n_left", "n_right", same.alias("same"))


def diff_kind(n_left: Column, n_right: Column, same: Column) -> Column:
    """``left_only`` / ``right_only`` / ``changed``, NULL when equal."""
    return (
        F.when(n_right == 0, F.lit("left_only"))
        .when(n_left == 0, F.lit("right_only"))
        .when(~same, F.lit("changed"))
    )


def written(df: DataFrame, label: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` stored in the shared scratch folder and read back.

    Used for intermediate lists that are needed more than once: their size is
    known exactly afterwards, the work behind them is not repeated when an
    executor is lost, and nothing stays cached in the session. The folder is added to ``paths``, for a
    caller that deletes it when nothing that is still to run reads it.
    """
    path = scratch_path(df.sparkSession, label)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(
    stored: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """True when a stored list is proven to stay below both limits.

    The rows come from file footers; the values are only measured if those
    already fit.
    """
    if stored.count() > max_rows:
        return False
    width = F.octet_length(F.concat_ws("", *[quoted(c).cast("string") for c in stored.columns]))
    total = stored.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return total["bytes"] <= max_bytes
