"""Chunk and table digests, key buckets, key bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.arithmetic import floor_div
from twinledger.functions.logical_types import Types
from twinledger.functions.tokens import digest_pair, fingerprint, hash_slices, quoted, row_hash
from twinledger.operators.balance import (
    LEFT,
    RIGHT,
    aligned_keys,
    balance,
    diff_kind,
    key_columns,
    signed_rows,
)

# Widths of chunks and buckets in keys.
DEFAULT_CHUNK_SIZE = 100_000
DEFAULT_BUCKET_SIZE = 50_000
# Widest span, in chunks, that one drill-down range may cover.
MAX_DRILL_SPAN = 5


def _slice_sums() -> list[Column]:
    """Sums of the slices ``_s0.._s3`` that cannot overflow a bigint."""
    out = []
    for i in range(4):
        s = F.col(f"_s{i}")
        out.append(F.sum(F.shiftright(s, 16)).alias(f"_hi{i}"))
        out.append(F.sum(s.bitwiseAND(F.lit(0xFFFF))).alias(f"_lo{i}"))
    return out


def _joined_sums() -> list[Column]:
    zero = F.lit(0).cast("bigint")
    return [
        (
            F.coalesce(F.col(f"_hi{i}"), zero).cast("decimal(28,0)") * F.lit(65536)
            + F.coalesce(F.col(f"_lo{i}"), zero)
        )
        .cast("decimal(38,0)")
        .alias(f"s{i}")
        for i in range(4)
    ]


def chunk_digest(
    df: DataFrame,
    pk: str,
    cols: Sequence[str],
    types: Types,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    bound: Column | int | None = None,
    **options,
) -> DataFrame:
    """``(chunk_id, n, s0..s3)``: order-independent digest per key range.

    Only one row per chunk and map task is shuffled.
    """
    df = df if bound is None else key_bound(df, pk, bound)
    hashed = df.select(
        floor_div(quoted(pk), chunk_size).alias("chunk_id"),
        row_hash(df, cols, types, **options).alias("_h"),
    )
    sliced = hashed.select(
        "chunk_id", *[s.alias(f"_s{i}") for i, s in enumerate(hash_slices(F.col("_h")))]
    )
    summed = sliced.groupBy("chunk_id").agg(F.count("*").alias("n"), *_slice_sums())
    return summed.select("chunk_id", "n", *_joined_sums())


DIGEST_SUMS = ("n", "s0", "s1", "s2", "s3")


def digest_change(
    before: DataFrame, after: DataFrame, pk: str, cols: Sequence[str], types: Types,
    chunk_size: int = DEFAULT_CHUNK_SIZE, **options,
) -> DataFrame:
    """``(chunk_id, n, s0..s3)`` to add to the digests of a table whose rows ``before`` become ``after``.

    ``before`` holds the old images of all changed rows, ``after`` the new ones; rows that were
    inserted or deleted are on one side only. The digests are sums, so a change is what the new rows add
    less what the old ones did. Only the changed rows are hashed.
    """
    old, new = (chunk_digest(df, pk, cols, types, chunk_size, **options) for df in (before, after))
    less = old.select("chunk_id", *[(-F.col(c)).cast(old.schema[c].dataType).alias(c) for c in DIGEST_SUMS])
    return _added(new.unionByName(less))


def _added(parts: DataFrame) -> DataFrame:
    summed = parts.groupBy("chunk_id").agg(*[F.sum(c).alias(c) for c in DIGEST_SUMS])
    kept = [F.col(c).cast(parts.schema[c].dataType).alias(c) for c in DIGEST_SUMS]
    return summed.select("chunk_id", *kept).where(~_empty())


def _empty() -> Column:
    none = F.lit(True)
    for c in DIGEST_SUMS:
        none = none & (F.col(c) == 0)
    return none


def updated_digests(digests: DataFrame, change: DataFrame) -> DataFrame:
    """Chunk digests after a change; a chunk that has lost all its rows is gone."""
    return _added(digests.unionByName(change))


def table_digest(df: DataFrame, cols: Sequence[str], types: Types, **options) -> DataFrame:
    """``(n, s0..s3)`` for the whole table; an empty table gives zeros."""
    hashed = df.select(row_hash(df, cols, types, **options).alias("_h"))
    sliced = hashed.select(*[s.alias(f"_s{i}") for i, s in enumerate(hash_slices(F.col("_h")))])
    return sliced.agg(F.count("*").alias("n"), *_slice_sums()).select("n", *_joined_sums())


def chunk_compare(
    left: DataFrame,
    right: DataFrame,
    pk: str,
    cols: Sequence[str],
    types: Types,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    **options,
) -> DataFrame:
    """``(chunk_id, n_left, n_right, same)`` from one pass over each side."""
    sides = []
    for df, other, side in ((left, right, LEFT), (right, left, RIGHT)):
        group = [floor_div(quoted(pk), chunk_size).alias("chunk_id")]
        digest = fingerprint(df, cols, types, other.schema, **options)
        sides.append(signed_rows(df, side, group, digest))
    return balance(sides[0], sides[1], ["chunk_id"])


def drill_ranges(chunk_ids: Sequence[int], max_span: int = MAX_DRILL_SPAN) -> list[tuple[int, int]]:
    """Merge neighbouring chunk ids into ``(first, last)`` ranges of bounded width."""
    ranges: list[tuple[int, int]] = []
    for cid in sorted(chunk_ids):
        if ranges and cid - ranges[-1][1] <= 1 and cid - ranges[-1][0] < max_span:
            ranges[-1] = (ranges[-1][0], cid)
        else:
            ranges.append((cid, cid))
    return ranges


def ranges_predicate(
    pk: str, ranges: Sequence[tuple[int, int]], chunk_size: int
) -> Column:
    """OR of key ranges, in the form a parquet or JDBC scan can prune on."""
    found = F.lit(False)
    for first, last in ranges:
        found = found | ((quoted(pk) >= first * chunk_size) & (quoted(pk) < (last + 1) * chunk_size))
    return found


def key_range(
    df: DataFrame, pk: str, lo: Column | int, hi: Column | int, half_open: bool = False
) -> DataFrame:
    """Rows with ``lo <= pk <= hi``, or ``lo <= pk < hi`` when half open.

    Bounds may be numbers or scalar subqueries; both reach the scan.
    """
    upper = quoted(pk) < hi if half_open else quoted(pk) <= hi
    return df.where((quoted(pk) >= lo) & upper)


def key_bound(df: DataFrame, pk: str, bound: Column | int) -> DataFrame:
    """Rows up to and including ``bound``, and those without a key."""
    upper = bound if isinstance(bound, Column) else F.lit(bound)
    return df.where((quoted(pk) <= upper) | quoted(pk).isNull())


def snapshot_bound(left: DataFrame, right: DataFrame, pk: str) -> tuple[DataFrame, DataFrame]:
    """Both sides cut at the left side's largest key; an empty left side cuts nothing.

    The bound is a scalar subquery: one max pass over one column, then a plain
    comparison the scan can prune row groups with. No row reaches the driver.
    """
    no_bound = F.lit((1 << 63) - 1)
    top = left.agg(F.coalesce(F.max(quoted(pk)).cast("bigint"), no_bound).alias("top")).scalar()
    return key_bound(left, pk, top), key_bound(right, pk, top)


def key_origin(left: DataFrame, right: DataFrame, pk: str) -> DataFrame:
    """One row ``k``: the smallest key of both sides."""
    keys = left.select(quoted(pk).cast("bigint").alias("k")).unionAll(
        right.select(quoted(pk).cast("bigint").alias("k"))
    )
    return keys.agg(F.min("k").alias("k"))


def _origin(left: DataFrame, right: DataFrame, pk: str) -> Column:
    return key_origin(left, right, pk).scalar()


def bucket_counts(
    df: DataFrame, pk: str, origin: Column | int, bucket_size: int = DEFAULT_BUCKET_SIZE
) -> DataFrame:
    """``(bucket, n)``: rows per equal-width key bucket counted from ``origin``."""
    start = origin if isinstance(origin, Column) else F.lit(origin)
    bucket = floor_div(quoted(pk).cast("bigint") - start, bucket_size)
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def bucket_compare(
    left: DataFrame,
    right: DataFrame,
    pk: str,
    bucket_size: int = DEFAULT_BUCKET_SIZE,
    exact: bool = True,
) -> DataFrame:
    """``(bucket, n_left, n_right, same)`` per equal-width key bucket.

    ``exact`` adds a digest of the keys, so a bucket with one missing and one
    extra key is not taken for clean. Without it only the counts are compared.
    """
    origin = _origin(left, right, pk)
    sides = []
    for df, side in ((left, LEFT), (right, RIGHT)):
        key = quoted(pk).cast("bigint")
        group = [floor_div(key - origin, bucket_size).alias("bucket")]
        sides.append(signed_rows(df, side, group, digest_pair([key]) if exact else []))
    return balance(sides[0], sides[1], ["bucket"], exact)


def with_bucket(
    df: DataFrame, left: DataFrame, right: DataFrame, pk: str, bucket_size: int
) -> DataFrame:
    """``df`` plus the ``bucket`` its key falls into."""
    key = quoted(pk).cast("bigint")
    return df.withColumn("bucket", floor_div(key - _origin(left, right, pk), bucket_size))


def key_fingerprint(df: DataFrame, pk: str) -> DataFrame:
    """``(n, fingerprint)`` with ``count,min,max`` as one string."""
    shown = F.concat_ws(
        ",",
        F.count("*").cast("string"),
        F.coalesce(F.min(quoted(pk)).cast("string"), F.lit("NULL")),
        F.coalesce(F.max(quoted(pk)).cast("string"), F.lit("NULL")),
    )
    return df.agg(F.count("*").alias("n"), shown.alias("fingerprint"))


def balanced_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, n_left, n_right, same)`` on keys alone, no other column read."""
    kinds = aligned_keys(left, right, keys)
    sides = [
        signed_rows(df, side, key_columns(keys, kinds), [])
        for df, side in ((left, LEFT), (right, RIGHT))
    ]
    return balance(sides[0], sides[1], list(keys), False)


def keyed_balance(
    left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str], types: Types,
    **options,
) -> DataFrame:
    """``(keys, n_left, n_right, same)`` by cancelling row fingerprints per key."""
    kinds = aligned_keys(left, right, keys)
    sides = []
    for df, other, side in ((left, right, LEFT), (right, left, RIGHT)):
        digest = fingerprint(df, cols, types, other.schema, **options)
        sides.append(signed_rows(df, side, key_columns(keys, kinds), digest))
    return balance(sides[0], sides[1], list(keys))


def keyed_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str], types: Types,
    **options,
) -> DataFrame:
    """``(keys, diff_type)`` of the keys that do not cancel out."""
    merged = keyed_balance(left, right, keys, cols, types, **options)
    kind = diff_kind(F.col("n_left"), F.col("n_right"), F.col("same"))
    return merged.select(*[quoted(k) for k in keys], kind.alias("diff_type")).where(
        F.col("diff_type").isNotNull()
    )
