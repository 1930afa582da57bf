"""Comparing many table pairs and summing the outcome up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.logical_types import EXCLUDED_TABLES, LogicalType, common_columns
from twinledger.functions.tokens import key_text
from twinledger.operators.catalog import union_tables
from twinledger.operators.diff import (
    changed_column_counts,
    chunkable,
    diff_chunked,
    diff_counts,
    diff_rows,
    sample_per_diff_type,
)
from twinledger.operators.digest import DEFAULT_CHUNK_SIZE, snapshot_bound
from twinledger.operators.reports import status_of

RESULT_SCHEMA = (
    "table_name string, status string, left_only bigint, right_only bigint, changed bigint"
)


@dataclass(frozen=True)
class TablePair:
    """Two copies of one table. ``right_keys`` defaults to the left side's keys."""

    name: str
    left: DataFrame
    right: DataFrame
    keys: Sequence[str]
    types: Mapping[str, LogicalType | str] = field(default_factory=dict)
    right_keys: Sequence[str] | None = None


def comparison_plan(cat_tables: DataFrame, cat_keys: DataFrame, cat_columns: DataFrame) -> DataFrame:
    """``(table_name, keys, right_keys, columns, skip_reason)`` of every table both sides have.

    From catalog rows with a ``side`` of ``left`` or ``right``. ``keys`` are the primary key columns in
    order, ``columns`` the common columns as ``(column_name, udt)`` with the right side's type. The
    reasons are those of ``skip_reason``; bookkeeping tables are left out.
    """
    both = (
        cat_tables.where(~F.col("table_name").isin(*EXCLUDED_TABLES)).groupBy("table_name")
        .agg(F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "right").alias("r"))
        .where("l > 0 AND r > 0").select("table_name")
    )

    def primary(side: str) -> Column:
        mine = F.when(F.col("side") == side, F.struct("ordinal_position", "column_name"))
        return F.array_sort(F.collect_list(mine))["column_name"]

    keys = cat_keys.where(F.col("constraint_type") == "PRIMARY KEY").groupBy("table_name").agg(
        primary("left").alias("keys"), primary("right").alias("right_keys"))
    common = (
        cat_columns.groupBy("table_name", "column_name").agg(
            F.count_if(F.col("side") == "left").alias("l"),
            F.max(F.when(F.col("side") == "right", F.col("udt_name"))).alias("udt"))
        .where("l > 0 AND udt IS NOT NULL").groupBy("table_name")
        .agg(F.array_sort(F.collect_list(F.struct("column_name", "udt"))).alias("columns"))
    )
    none = F.array().cast("array<string>")
    whole = both.join(keys, "table_name", "left").join(common, "table_name", "left").select(
        "table_name", F.coalesce("keys", none).alias("keys"), F.coalesce("right_keys", none).alias("right_keys"),
        F.coalesce("columns", F.array().cast("array<struct<column_name:string,udt:string>>")).alias("columns"))
    reason = (
        F.when((F.size("keys") == 0) | (F.col("keys") != F.col("right_keys")), F.lit("SKIP-PK"))
        .when(F.size("columns") == 0, F.lit("SKIP-COL"))
        .when(F.size(F.array_except("keys", F.col("columns.column_name"))) > 0, F.lit("SKIP-PK"))
    )
    return whole.withColumn("skip_reason", reason)


def pairs_from_catalog(
    cat_tables: DataFrame, cat_keys: DataFrame, cat_columns: DataFrame,
    reader: Callable[[str, str], DataFrame],
) -> list[TablePair]:
    """A ``TablePair`` for every table both catalogs list; ``reader(side, table)`` reads one.

    One row a table reaches the driver, as with any catalog.
    """
    plan = comparison_plan(cat_tables, cat_keys, cat_columns).orderBy("table_name").collect()
    return [
        TablePair(r.table_name, reader("left", r.table_name), reader("right", r.table_name), r["keys"],
                  {c.column_name: c.udt for c in r.columns}, r.right_keys)
        for r in plan
    ]


def skip_reason(pair: TablePair) -> str | None:
    """``SKIP-PK``, ``SKIP-COL`` or None, from metadata alone."""
    if not pair.keys or list(pair.right_keys or pair.keys) != list(pair.keys):
        return "SKIP-PK"
    cols = common_columns(pair.left, pair.right)
    if not cols:
        return "SKIP-COL"
    if not set(pair.keys) <= set(cols):
        return "SKIP-PK"
    return None


def pair_diff(
    pair: TablePair,
    strategy: str = "full",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    bounded: bool = True,
) -> DataFrame:
    """Differing keys of one pair.

    ``full`` is one row diff. ``chunked`` looks at chunk digests first, which runs jobs while the plan
    is built; a pair without a single integer key gets the row diff instead. Both give the same rows.
    """
    if strategy not in ("full", "chunked"):
        raise ValueError("strategy is 'full' or 'chunked'")
    left, right = pair.left, pair.right
    by_chunk = chunkable(left, right, pair.keys, pair.types)
    if bounded and by_chunk:
        left, right = snapshot_bound(left, right, pair.keys[0])
    if strategy == "chunked" and by_chunk:
        return diff_chunked(left, right, pair.keys[0], pair.types, chunk_size)
    return diff_rows(left, right, pair.keys, pair.types)


def _skipped(pair: TablePair, reason: str) -> DataFrame:
    return pair.left.sparkSession.createDataFrame(
        [(pair.name, reason, None, None, None)], RESULT_SCHEMA
    )


def pair_result(pair: TablePair, **how) -> DataFrame:
    """One row: table_name, status, left_only, right_only, changed."""
    reason = skip_reason(pair)
    if reason is not None:
        return _skipped(pair, reason)
    counts = diff_counts(pair_diff(pair, **how))
    status = status_of(F.col("left_only"), F.col("right_only"), F.col("changed"))
    return counts.select(
        F.lit(pair.name).alias("table_name"), status.alias("status"),
        "left_only", "right_only", "changed",
    )


def selected(pairs: Sequence[TablePair], allow: Sequence[str] | None = None) -> list[TablePair]:
    """Pairs to compare: no bookkeeping tables, and only those named if any are."""
    return [
        p for p in pairs
        if p.name not in EXCLUDED_TABLES and (allow is None or p.name in set(allow))
    ]


def _no_rows(pairs: Sequence[TablePair], schema: str) -> DataFrame:
    spark = pairs[0].left.sparkSession if pairs else SparkSession.active()
    return spark.createDataFrame([], schema)


def reconcile(
    pairs: Sequence[TablePair], allow: Sequence[str] | None = None, **how
) -> DataFrame:
    """All pairs as one lazy result, one row per table; no row if none is selected."""
    chosen = selected(pairs, allow)
    if not chosen:
        return _no_rows(pairs, RESULT_SCHEMA)
    return union_tables([pair_result(p, **how) for p in chosen])


def reconcile_each(
    pairs: Sequence[TablePair], jobs: int = 4, allow: Sequence[str] | None = None, **how
) -> DataFrame:
    """Same, as one Spark job per table, so that a failing table is an ``ERROR`` row with the
    reason in ``error``.

    Only the single result row of each table reaches the driver.
    """
    chosen = selected(pairs, allow)
    schema = f"{RESULT_SCHEMA}, error string"
    if not chosen:
        return _no_rows(pairs, schema)

    def outcome(pair: TablePair) -> tuple:
        try:
            return (*pair_result(pair, **how).first(), None)
        except Exception as e:  # the table's failure is the result to report
            return (pair.name, "ERROR", None, None, None, f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(max_workers=jobs) as pool:
        rows = list(pool.map(outcome, chosen))
    return chosen[0].left.sparkSession.createDataFrame(rows, schema)


def _compared(pairs: Sequence[TablePair], allow: Sequence[str] | None) -> list[TablePair]:
    return [p for p in selected(pairs, allow) if skip_reason(p) is None]


def samples(
    pairs: Sequence[TablePair], n: int = 20, allow: Sequence[str] | None = None, **how
) -> DataFrame:
    """``(table_name, diff_type, rank, key)``: the smallest differing keys of each kind, of every pair
    that can be compared."""
    out = []
    for pair in _compared(pairs, allow):
        picked = sample_per_diff_type(pair_diff(pair, **how), pair.keys, n)
        out.append(picked.select(
            F.lit(pair.name).alias("table_name"), "diff_type", "rank",
            key_text(pair.keys).alias("key"),
        ))
    if not out:
        return _no_rows(pairs, "table_name string, diff_type string, rank int, key string")
    return union_tables(out)


def changed_columns(
    pairs: Sequence[TablePair], allow: Sequence[str] | None = None, bounded: bool = True
) -> DataFrame:
    """``(table_name, column, changed_rows)`` of every pair that can be compared, in one pass each."""
    out = []
    for pair in _compared(pairs, allow):
        left, right = pair.left, pair.right
        if bounded and chunkable(left, right, pair.keys, pair.types):
            left, right = snapshot_bound(left, right, pair.keys[0])
        found = changed_column_counts(left, right, pair.keys, pair.types)
        out.append(found.select(F.lit(pair.name).alias("table_name"), "column", "changed_rows"))
    return union_tables(out) if out else _no_rows(pairs, "table_name string, column string, changed_rows bigint")
