"""Row, key and column differences between two copies of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.arithmetic import floor_div
from twinledger.functions.logical_types import (
    INTEGER_UDTS,
    OPAQUE_UDTS,
    Types,
    common_columns,
    infer_types,
    logical,
)
from twinledger.functions.tokens import (
    canonical_key,
    column_token,
    fingerprint,
    quoted,
)
from twinledger.operators.balance import (
    LEFT,
    RIGHT,
    aligned_keys,
    diff_kind,
    key_columns,
    small_enough,
    written,
)
from twinledger.operators.digest import (
    DEFAULT_BUCKET_SIZE,
    DEFAULT_CHUNK_SIZE,
    balanced_keys,
    bucket_compare,
    chunk_compare,
    drill_ranges,
    keyed_diff,
    ranges_predicate,
    key_origin,
    with_bucket,
)

# More dirty chunks than this and pushing ranges into the scan stops paying.
MAX_PUSHED_CHUNKS = 200
# Longest list that is broadcast; its bytes are limited as well.
BROADCAST_ROWS = 1_000_000
# Share of rows in dirty chunks above which one pass over everything is cheaper.
FULL_SHARE = 1 / 3


def rows_with_keys(
    df: DataFrame, picked: DataFrame, keys: Sequence[str], kinds: dict[str, T.DataType],
    few: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose key is among ``picked``: NULL meets NULL, and both are compared in the
    types of the two tables, whatever way the join is done. ``few`` says that ``picked`` is proven to be
    small enough to be broadcast."""
    named = picked.select(*[quoted(k).cast(kinds[k]).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [quoted(k).cast(kinds[k]).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    named = F.broadcast(named) if few else named
    return df.join(named, same, "left_semi").select(*[quoted(c) for c in df.columns])


def _plan(left: DataFrame, right: DataFrame, types: Types | None):
    cols = common_columns(left, right)
    known = infer_types(right, types)
    return cols, known


def diff_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    types: Types | None = None,
    **options,
) -> DataFrame:
    """``(keys, diff_type)`` for every key that is not equal on both sides.

    One shuffle of keys and digests; whole rows are never moved. Rows that
    share a key are compared as a multiset.
    """
    cols, known = _plan(left, right, types)
    return keyed_diff(left, right, keys, cols, known, **options)


def diff_merge(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    types: Types | None = None,
    **options,
) -> DataFrame:
    """Same answer as ``diff_rows`` by a sort-merge join of two keyed sides.

    Each side is reduced to one row per key first; the join then reuses that
    partitioning, so a repeated key can neither multiply nor skew it.
    """
    cols, known = _plan(left, right, types)
    kinds = aligned_keys(left, right, keys)
    # NULL keys become a placeholder plus a flag: plain equality on both lets
    # the join use the partitioning of the grouping.
    forms, match = [], F.lit(True)
    for i, k in enumerate(keys):
        empty = F.lit(_placeholder(kinds[k])).cast(kinds[k])
        forms += [
            F.coalesce(quoted(k).cast(kinds[k]), empty).alias(f"k{i}"),
            quoted(k).isNull().alias(f"z{i}"),
        ]
        match = match & (F.col(f"lk{i}") == F.col(f"rk{i}")) & (F.col(f"lz{i}") == F.col(f"rz{i}"))
    low = F.lit(0xFFFFFF)
    sides = []
    for df, other, mark in ((left, right, "l"), (right, left, "r")):
        digest = fingerprint(df, cols, known, other.schema, **options)
        rows = df.select(*forms, *[d.alias(f"h{i}") for i, d in enumerate(digest)])
        per_key = rows.groupBy(*[f"{c}{i}" for i in range(len(keys)) for c in "kz"]).agg(
            F.count("*").alias("n"),
            F.struct(
                F.bit_xor("h0"), F.bit_xor("h1"),
                F.sum(F.col("h0").bitwiseAND(low)), F.sum(F.col("h1").bitwiseAND(low)),
            ).alias("d"),
        )
        sides.append(per_key.withColumnsRenamed({c: mark + c for c in per_key.columns}))
    joined = sides[0].hint("merge").join(sides[1], match, "full_outer")
    same = (F.col("ln") == F.col("rn")) & (F.col("ld") == F.col("rd"))
    nothing = F.lit(0).cast("bigint")
    kind = diff_kind(F.coalesce("ln", nothing), F.coalesce("rn", nothing), same)
    shown = [
        F.when(~F.coalesce(f"lz{i}", f"rz{i}"), F.coalesce(f"lk{i}", f"rk{i}")).alias(k)
        for i, k in enumerate(keys)
    ]
    return joined.select(*shown, kind.alias("diff_type")).where(F.col("diff_type").isNotNull())


def diff_stored_copies(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    types: Types | None = None,
    null_keys: bool = True,
    **options,
) -> DataFrame:
    """Same answer as ``diff_rows`` for copies that are stored bucketed by their keys, without a shuffle.

    Each side is grouped on its plain key columns, and the groups are joined on them, so both steps use
    the buckets of ``write_bucketed_copy``; a bucket is read, compared and reported by one task. Rows with
    a NULL key go through ``diff_rows``; ``null_keys=False`` leaves that part out for keys that have none,
    and fails if one turns up. Copies that are not bucketed, or not alike, give the same rows with
    shuffles. Key columns need one type on both sides.
    """
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"key {k} has two types; copies are bucketed by equal values of one type")
    cols, known = _plan(left, right, types)
    low = F.lit(0xFFFFFF)

    def partial_of(columns):
        return reduce(lambda a, b: a | b, [c.isNull() for c in columns])

    partial = partial_of([quoted(k) for k in keys])
    whole = ~partial
    sides = []
    for df, other, mark in ((left, right, "l"), (right, left, "r")):
        digest = fingerprint(df, cols, known, other.schema, **options)
        rows = (df.where(whole) if null_keys else df).select(
            *[quoted(k).alias(f"{mark}k{i}") for i, k in enumerate(keys)],
            *[d.alias(f"h{i}") for i, d in enumerate(digest)])
        sides.append(rows.groupBy(*[f"{mark}k{i}" for i in range(len(keys))]).agg(
            F.count("*").alias(f"{mark}n"),
            F.struct(
                F.bit_xor("h0"), F.bit_xor("h1"),
                F.sum(F.col("h0").bitwiseAND(low)), F.sum(F.col("h1").bitwiseAND(low)),
            ).alias(f"{mark}d")))
    match = [F.col(f"lk{i}") == F.col(f"rk{i}") for i in range(len(keys))]
    joined = sides[0].hint("merge").join(sides[1], match, "full_outer")
    same = (F.col("ln") == F.col("rn")) & (F.col("ld") == F.col("rd"))
    nothing = F.lit(0).cast("bigint")
    kind = diff_kind(F.coalesce("ln", nothing), F.coalesce("rn", nothing), same)
    shown = [F.coalesce(f"lk{i}", f"rk{i}").alias(k) for i, k in enumerate(keys)]
    if not null_keys:
        kind = F.when(partial_of(shown), F.raise_error(F.lit("a key is NULL; use null_keys=True"))).otherwise(kind)
        return joined.select(*shown, kind.alias("diff_type")).where("diff_type IS NOT NULL")
    found = joined.select(*shown, kind.alias("diff_type")).where("diff_type IS NOT NULL")
    return found.unionByName(diff_rows(left.where(partial), right.where(partial), keys, types, **options))


def _placeholder(dtype: T.DataType) -> str:
    """Text that casts to some value of the type."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return ""
    if isinstance(dtype, T.NumericType):
        return "0"
    return "false" if isinstance(dtype, T.BooleanType) else "1970-01-01"


def chunkable(left: DataFrame, right: DataFrame, keys: Sequence[str], types: Types | None) -> bool:
    """Chunk ids need one native integer key on both sides."""
    if len(keys) != 1:
        return False
    k = keys[0]
    known = infer_types(right, types)
    here = infer_types(left)
    return logical(known[k]).udt in INTEGER_UDTS and here[k].udt in INTEGER_UDTS


def diff_chunked(
    left: DataFrame,
    right: DataFrame,
    pk: str,
    types: Types | None = None,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    drill: str = "auto",
    **options,
) -> DataFrame:
    """``diff_rows`` restricted to the key ranges whose digests differ.

    Phase 1 compares one digest per chunk. Phase 2 looks at rows of dirty
    chunks only, by the cheapest way that is safe for them; all ways give the
    same rows:

    * dirty chunks hold more than ``FULL_SHARE`` of all rows - the plain row
      diff, since most of the table has to be read anyway;
    * few chunks - the ids are fetched and pushed into both scans as key ranges;
    * up to ``BROADCAST_ROWS`` - a broadcast semi join on the chunk id;
    * more - the plain row diff.

    ``drill='lazy'`` runs no job while the plan is built and leaves the join
    strategy to the planner. The key must be an integer on both sides.
    """
    if not chunkable(left, right, [pk], types):
        raise ValueError(f"chunks need an integer key on both sides: {pk}")
    cols, known = _plan(left, right, types)
    chunks = chunk_compare(left, right, pk, cols, known, chunk_size, **options)
    dirty = chunks.where(~F.col("same")).select("chunk_id")
    chunk_of = floor_div(quoted(pk), chunk_size)
    # NULL keys form a chunk of their own, which a join would drop: file it
    # with chunk 0 on both sides.
    chunk_or_0, id_or_0 = F.coalesce(chunk_of, F.lit(0)), F.coalesce("chunk_id", F.lit(0))

    def in_chunks(df: DataFrame, ids: DataFrame) -> DataFrame:
        tagged = df.withColumn("chunk_id", chunk_or_0)
        return tagged.join(ids, "chunk_id", "left_semi").drop("chunk_id")

    if drill == "lazy":
        ids = dirty.select(id_or_0.alias("chunk_id"))
        return keyed_diff(
            in_chunks(left, ids), in_chunks(right, ids), [pk], cols, known, **options
        )

    sized = chunks.select("chunk_id", "same", (F.col("n_left") + F.col("n_right")).alias("n"))
    chunks = written(sized, "chunks")
    rows = chunks.agg(F.sum("n").alias("all"), F.sum(F.when(~F.col("same"), F.col("n"))).alias("dirty")).first()
    if (rows["dirty"] or 0) > FULL_SHARE * (rows["all"] or 0):
        return keyed_diff(left, right, [pk], cols, known, **options)
    dirty = chunks.where(~F.col("same")).select("chunk_id")
    found = dirty.limit(MAX_PUSHED_CHUNKS + 1).collect()
    if len(found) <= MAX_PUSHED_CHUNKS:
        ranges = drill_ranges([r.chunk_id for r in found if r.chunk_id is not None])
        wanted = ranges_predicate(pk, ranges, chunk_size)
        if any(r.chunk_id is None for r in found):
            wanted = wanted | quoted(pk).isNull()
        return keyed_diff(left.where(wanted), right.where(wanted), [pk], cols, known, **options)
    if not small_enough(dirty, BROADCAST_ROWS):
        return keyed_diff(left, right, [pk], cols, known, **options)
    ids = F.broadcast(dirty.select(id_or_0.alias("chunk_id")))
    return keyed_diff(in_chunks(left, ids), in_chunks(right, ids), [pk], cols, known, **options)


def key_set_diff(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, diff_type)`` with ``missing`` (left - right) and ``extra``.

    Keys are a set: how often one occurs does not matter.
    """
    merged = balanced_keys(left, right, keys)
    kind = F.when(F.col("n_right") == 0, F.lit("missing")).when(
        F.col("n_left") == 0, F.lit("extra")
    )
    return merged.select(*[quoted(k) for k in keys], kind.alias("diff_type")).where(
        F.col("diff_type").isNotNull()
    )


def key_minus(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return key_set_diff(left, right, keys).where(F.col("diff_type") == "missing").drop("diff_type")


def diff_bucketed(
    left: DataFrame,
    right: DataFrame,
    pk: str,
    bucket_size: int = DEFAULT_BUCKET_SIZE,
    exact: bool = True,
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> DataFrame:
    """Missing and extra keys, looked for only in buckets that disagree.

    Never reports changed rows. ``exact=False`` trusts the counts, which hides
    a bucket with as many missing as extra keys. NULL keys are a bucket of their
    own. Few dirty buckets of an integer key are pushed into both scans.
    """
    buckets = bucket_compare(left, right, pk, bucket_size, exact)
    dirty = buckets.where(~F.col("same")).select("bucket")
    if broadcast_rows is not None:
        dirty = written(dirty, "dirty-buckets")
        if not small_enough(dirty, broadcast_rows):
            if exact:
                return key_set_diff(left, right, [pk])
            broadcast_rows = None
    if broadcast_rows is not None and all(
        isinstance(df.schema[pk].dataType, T.IntegralType) for df in (left, right)
    ):
        found = dirty.limit(MAX_PUSHED_CHUNKS + 1).collect()
        if len(found) <= MAX_PUSHED_CHUNKS:
            wanted = F.lit(False)
            if any(r.bucket is None for r in found):
                wanted = quoted(pk).isNull()
            first = key_origin(left, right, pk).first().k or 0
            for lo, hi in drill_ranges([r.bucket for r in found if r.bucket is not None]):
                start, end = first + lo * bucket_size, first + (hi + 1) * bucket_size
                wanted = wanted | ((quoted(pk) >= start) & (quoted(pk) < end))
            return key_set_diff(left.where(wanted), right.where(wanted), [pk])
    parts = []
    picked = dirty.select(F.col("bucket").alias("_bucket"))
    picked = picked if broadcast_rows is None else F.broadcast(picked)
    for df in (left, right):
        tagged = with_bucket(df.select(quoted(pk)), left, right, pk, bucket_size)
        chosen = tagged.join(picked, F.col("bucket").eqNullSafe(F.col("_bucket")), "left_semi")
        parts.append(chosen.drop("bucket"))
    return key_set_diff(parts[0], parts[1], [pk])


def _column_digests(df, other, keys, kinds, cols, types, side, with_values, options):
    """Keys, side, and per column a token digest (and the value to show)."""
    out = [*key_columns(keys, kinds), F.lit(side).cast("bigint").alias("_side")]
    for i, name in enumerate(cols):
        token = column_token(name, types.get(name, "text"), df.schema[name].dataType, **options)
        out.append(F.xxhash64(token).alias(f"_h{i}"))
        if with_values:
            out.append(quoted(name).cast("string").alias(f"_v{i}"))
    return df.select(*out)


def _column_differs(i: int) -> Column:
    return (F.col(f"_x{i}") != 0) | (F.col(f"_s{i}") != 0)


def _column_balance(left, right, keys, types, with_values, options):
    kinds = aligned_keys(left, right, keys)
    cols, known = _plan(left, right, types)
    cols = [c for c in cols if c not in set(keys)]
    sides = [
        _column_digests(df, other, keys, kinds, cols, known, side, with_values, options)
        for df, other, side in ((left, right, LEFT), (right, left, RIGHT))
    ]
    side = F.col("_side")
    aggs = [F.count_if(side > 0).alias("n_left"), F.count_if(side < 0).alias("n_right")]
    for i in range(len(cols)):
        low = F.col(f"_h{i}").bitwiseAND(F.lit(0xFFFFFF))
        aggs.append(F.bit_xor(f"_h{i}").alias(f"_x{i}"))
        aggs.append(F.sum(side * low).alias(f"_s{i}"))
        if with_values:
            aggs.append(F.max(F.when(side > 0, F.col(f"_v{i}"))).alias(f"_l{i}"))
            aggs.append(F.max(F.when(side < 0, F.col(f"_v{i}"))).alias(f"_r{i}"))
    merged = (
        sides[0].unionByName(sides[1]).groupBy(*[quoted(k) for k in keys]).agg(*aggs)
        .where((F.col("n_left") > 0) & (F.col("n_right") > 0))
    )
    return merged, cols, known


def column_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    types: Types | None = None,
    changed: DataFrame | None = None,
    broadcast_rows: int | None = None,
    **options,
) -> DataFrame:
    """``(keys, column, left_value, right_value, opaque)`` for changed rows.

    Only columns whose tokens differ are listed. By default this is one pass
    that shuffles all values. ``changed`` may hand in keys already known to
    differ. With ``broadcast_rows`` the changed keys are found first, by their
    hashes, and if they are proven to be few they are broadcast, so that only
    changed rows are shuffled; if they are many the single pass is taken.
    """
    picked, few = None, False
    if broadcast_rows is not None:
        if changed is None:
            changed = diff_rows(left, right, keys, types, **options)
            changed = changed.where(F.col("diff_type") == "changed")
        found = written(changed.select(*[quoted(k) for k in keys]).distinct(), "changed-keys")
        if small_enough(found, broadcast_rows):
            picked, few = found, True
    elif changed is not None:
        picked = changed.select(*[quoted(k) for k in keys])
    if picked is not None:
        kinds = aligned_keys(left, right, keys)
        left, right = (rows_with_keys(df, picked, keys, kinds, few) for df in (left, right))
    merged, cols, known = _column_balance(left, right, keys, types, True, options)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_l{i}").alias("left_value"),
            F.col(f"_r{i}").alias("right_value"),
            F.lit(logical(known[c]).udt in OPAQUE_UDTS).alias("opaque"),
            _column_differs(i).alias("differs"),
        )
        for i, c in enumerate(cols)
    ])
    listed = merged.select(
        *[quoted(k) for k in keys], F.explode(F.filter(cells, lambda x: x["differs"])).alias("x")
    )
    return listed.select(
        *[quoted(k) for k in keys], "x.column", "x.left_value", "x.right_value", "x.opaque"
    )


def changed_column_counts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], types: Types | None = None, **options
) -> DataFrame:
    """``(column, changed_rows)`` over all keys both sides hold, in one pass."""
    merged, cols, _ = _column_balance(left, right, keys, types, False, options)
    counts = merged.agg(*[
        F.count_if(_column_differs(i)).alias(f"_c{i}")
        for i in range(len(cols))
    ])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("changed_rows"))
        for i, c in enumerate(cols)
    ])
    return counts.select(F.explode(pairs).alias("x")).select("x.column", "x.changed_rows")


def fetch_rows_by_key(
    df: DataFrame, keys_df: DataFrame, keys: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Full rows for the keys in ``keys_df``; a limit takes the smallest keys. NULL meets NULL."""
    found = rows_with_keys(df, keys_df, keys, aligned_keys(df, keys_df, keys))
    if limit is None:
        return found
    return found.orderBy(*[quoted(k) for k in keys]).limit(limit)


def missing_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Full left rows whose key the right side lacks; a NULL key is always missing.

    With ``broadcast_rows`` the missing keys are found first, on key columns
    alone, and if they are few the full rows are picked without a shuffle.
    """
    kinds = aligned_keys(left, right, keys)
    if broadcast_rows is not None:
        found = written(key_minus(left, right, keys), "missing-keys")
        if small_enough(found, broadcast_rows):
            keyless = F.lit(False)
            for k in keys:
                keyless = keyless | quoted(k).isNull()
            picked = rows_with_keys(left.where(~keyless), found, keys, kinds, few=True)
            return picked.unionByName(left.where(keyless))
    have = right.select(*[quoted(k).cast(kinds[k]).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [quoted(k).cast(kinds[k]) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    return left.join(have, same, "left_anti").select(*[quoted(c) for c in left.columns])


# Verdict texts.
SAME_KEY_OTHER_FORM = "YES (PK representation mismatch)"
KEY_ABSENT = "NO (row is genuinely absent)"


def one_sided_inspect(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    side: str = "left",
    limit: int | None = None,
) -> DataFrame:
    """Rows one side lacks, and whether it holds the key in another form.

    Two keys count as the same when their trimmed text is the same number, or
    the same text ignoring case.
    """
    here, there = (left, right) if side == "left" else (right, left)
    kinds = aligned_keys(left, right, keys)
    absent = here.join(
        there.select(*[quoted(k).cast(kinds[k]).alias(f"_k{i}") for i, k in enumerate(keys)])
        .distinct(),
        on=[quoted(k).cast(kinds[k]) == F.col(f"_k{i}") for i, k in enumerate(keys)],
        how="left_anti",
    )
    if limit is not None:
        absent = absent.orderBy(*[quoted(k) for k in keys]).limit(limit)
    other = there.select(canonical_key(keys).alias("_form")).distinct()
    other = other.withColumn("_hit", F.lit(True))
    tagged = absent.withColumn("_form", canonical_key(keys))
    joined = tagged.join(other, "_form", "left")
    verdict = F.when(F.col("_hit"), F.lit(SAME_KEY_OTHER_FORM)).otherwise(F.lit(KEY_ABSENT))
    return joined.select(
        *[quoted(c) for c in here.columns], verdict.alias("same_key_on_other_side")
    )


def sample_per_diff_type(
    diff: DataFrame, keys: Sequence[str], n: int = 20, by: Sequence[str] = ("diff_type",)
) -> DataFrame:
    """At most ``n`` smallest keys per group, numbered from 1.

    The rank limit is applied before the shuffle, so a group with most of the
    rows still sends ``n`` rows per task.
    """
    order = Window.partitionBy(*[quoted(b) for b in by]).orderBy(*[quoted(k) for k in keys])
    return diff.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def ordered_samples(keys_df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` smallest keys in typed order, so 9 comes before 10."""
    return keys_df.select(*[quoted(k) for k in keys]).orderBy(*[quoted(k) for k in keys]).limit(n)


def latest_rows_check(
    left: DataFrame,
    right: DataFrame,
    ts_col: str,
    keys: Sequence[str],
    n: int = 20,
    types: Types | None = None,
) -> DataFrame:
    """Row diff between the ``n`` most recently updated rows of both sides."""
    newest = [quoted(ts_col).desc(), *[quoted(k) for k in keys]]
    return diff_rows(
        left.orderBy(*newest).limit(n), right.orderBy(*newest).limit(n), keys, types
    )


def diff_counts(diff: DataFrame) -> DataFrame:
    """``(left_only, right_only, changed)`` as one row."""
    return diff.agg(*[
        F.count_if(F.col("diff_type") == kind).alias(kind)
        for kind in ("left_only", "right_only", "changed")
    ])
