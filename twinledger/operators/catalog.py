"""Checks over table inventories, column catalogues, counts and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.logical_types import EXCLUDED_TABLES, expected_targets
from twinledger.functions.tokens import quoted
from twinledger.operators.digest import key_fingerprint


def without_excluded(df: DataFrame, allow: Sequence[str] | None = None) -> DataFrame:
    """Drop bookkeeping tables; with ``allow`` keep only the tables named."""
    kept = df.where(~F.col("table_name").isin(*EXCLUDED_TABLES))
    return kept if allow is None else kept.where(F.col("table_name").isin(*allow))


def _presence(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per distinct ``on`` with the side(s) it occurs on."""
    names = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select(*on, F.lit(0), F.lit(1))
    )
    merged = names.groupBy(*on).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    side = (
        F.when(F.col("_r") == 0, F.lit("left_only"))
        .when(F.col("_l") == 0, F.lit("right_only"))
        .otherwise(F.lit("both"))
    )
    return merged.select(*on, side.alias("presence"))


def table_inventory_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(table_name, presence, severity)``; a table only the left has is a failure."""
    severity = (
        F.when(F.col("presence") == "left_only", F.lit("failure"))
        .when(F.col("presence") == "right_only", F.lit("information"))
        .otherwise(F.lit("ok"))
    )
    return _presence(left, right, ["table_name"]).withColumn("severity", severity)


def column_name_diff(cat_left: DataFrame, cat_right: DataFrame) -> DataFrame:
    """Columns of shared tables that only one side has."""
    shared = _presence(cat_left, cat_right, ["table_name"]).where(F.col("presence") == "both")
    names = _presence(cat_left, cat_right, ["table_name", "column_name"])
    return names.where(F.col("presence") != "both").join(
        shared.select("table_name"), "table_name", "left_semi"
    )


def column_type_check(cat_left: DataFrame, cat_right: DataFrame) -> DataFrame:
    """Expected against actual target type for every column of the left side.

    ``cat_left``: table_name, column_name, data_type, column_type.
    ``cat_right``: table_name, column_name, udt_name, char_max_len.
    """
    sized = F.col("udt_name").isin("varchar", "bpchar") & F.col("char_max_len").isNotNull()
    actual = F.when(
        sized, F.concat("udt_name", F.lit("("), F.col("char_max_len").cast("string"), F.lit(")"))
    ).otherwise(F.col("udt_name"))
    there = cat_right.select("table_name", "column_name", actual.alias("actual_type"))
    here = cat_left.select(
        "table_name", "column_name", "column_type",
        expected_targets(F.lower("data_type"), F.lower("column_type")).alias("_want"),
    )
    status = (
        F.when(F.col("actual_type").isNull(), F.lit("left_only"))
        .when(F.col("_want").isNull(), F.lit("skipped"))
        .when(F.array_contains("_want", F.col("actual_type")), F.lit("match"))
        .otherwise(F.lit("mismatch"))
    )
    return here.join(there, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "column_type",
        F.array_join("_want", " ").alias("expected_type"), "actual_type", status.alias("status"),
    )


def union_tables(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n)``: exact counts of all tables as one job."""
    return union_tables([
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ])


def count_verdict(left_n: Column, right_n: Column) -> list[Column]:
    """``diff``, ``pct`` and ``match`` for a pair of counts."""
    size = F.greatest(left_n, F.lit(1).cast("bigint")).cast("decimal(20,0)")
    share = F.abs(left_n - right_n).cast("decimal(20,0)") * 100 / size
    match = F.when(right_n.isNull(), F.lit("MISSING")).when(left_n == right_n, F.lit("YES"))
    return [
        (left_n - right_n).alias("diff"),
        F.round(share, 4).cast("decimal(24,4)").alias("pct"),
        match.otherwise(F.lit("NO")).alias("match"),
    ]


def compare_counts(left_counts: DataFrame, right_counts: DataFrame) -> DataFrame:
    """``(table_name, left_n, right_n, diff, pct, match)`` from two count tables."""
    unknown = F.lit(None).cast("bigint")
    both = left_counts.select("table_name", F.col("n").alias("l"), unknown.alias("r")).unionAll(
        right_counts.select("table_name", unknown, "n")
    )
    merged = both.groupBy("table_name").agg(
        F.max("l").alias("left_n"), F.max("r").alias("right_n")
    ).where(F.col("left_n").isNotNull())
    return merged.select(
        "table_name", "left_n", "right_n", *count_verdict(F.col("left_n"), F.col("right_n"))
    )


def row_count_compare(
    left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]
) -> DataFrame:
    """Exact row counts of every left table against its right counterpart."""
    both = {t: right[t] for t in left if t in right}
    if not both:
        nothing = next(iter(left.values())).sparkSession.createDataFrame(
            [], "table_name string, n bigint"
        )
        return compare_counts(row_counts(left), nothing)
    return compare_counts(row_counts(left), row_counts(both))


def estimate_triage(est_left: DataFrame, est_right: DataFrame) -> DataFrame:
    """``(table_name, left_est, right_est, status)`` for tables on both sides.

    ``VERIFY`` asks for an exact count; ``ERR`` marks an estimate that is not
    a plain non-negative number. Inputs: table_name, est_rows.
    """
    joined = est_left.select(
        "table_name", F.col("est_rows").cast("string").alias("left_est")
    ).join(
        est_right.select("table_name", F.col("est_rows").cast("string").alias("right_est")),
        "table_name",
    )
    plain = F.lit(True)
    for c in ("left_est", "right_est"):
        plain = plain & F.coalesce(F.col(c).rlike("^[0-9]+$"), F.lit(False))
    m = F.expr("try_cast(left_est AS decimal(38, 0))")
    p = F.expr("try_cast(right_est AS decimal(38, 0))")
    allowed = F.greatest(F.lit(50), F.floor(m / 200))
    unknown = ~plain | m.isNull() | p.isNull()  # more than 38 digits
    status = (
        F.when(unknown, F.lit("ERR"))
        .when(F.abs(m - p) > allowed, F.lit("VERIFY"))
        .otherwise(F.lit("~ok"))
    )
    return joined.select("table_name", "left_est", "right_est", status.alias("status"))


def pk_fingerprint(
    pairs: Mapping[str, tuple[DataFrame, DataFrame, str]]
) -> DataFrame:
    """``count,min,max`` of the key as one string per side, and whether they agree."""
    one_row_each = union_tables([
        key_fingerprint(df, pk).select(
            F.lit(name).alias("table_name"), F.lit(mark).alias("side"), "fingerprint"
        )
        for name, (left, right, pk) in pairs.items()
        for mark, df in (("left", left), ("right", right))
    ])
    found = one_row_each.groupBy("table_name").agg(
        *[
            F.max(F.when(F.col("side") == mark, F.col("fingerprint"))).alias(f"{mark}_fingerprint")
            for mark in ("left", "right")
        ],
    )
    verdict = F.when(
        F.col("left_fingerprint") == F.col("right_fingerprint"), F.lit("match")
    ).otherwise(F.lit("mismatch"))
    return found.select("table_name", "left_fingerprint", "right_fingerprint",
                        verdict.alias("status"))


def table_maxima(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """``(table_name, column_name, max_value)`` for self-numbering columns."""
    return union_tables([
        df.agg(F.max(quoted(col)).cast("bigint").alias("max_value")).select(
            F.lit(table).alias("table_name"), F.lit(col).alias("column_name"), "max_value"
        )
        for (table, col), df in tables.items()
    ])


def sequence_check(maxima: DataFrame, sequences: DataFrame) -> DataFrame:
    """State of the counter behind each self-numbering column.

    ``maxima``: table_name, column_name, left_max, right_max.
    ``sequences``: table_name, column_name, sequence_name, last_value.
    ``set_to`` is the value the counter has to be set to.
    """
    on = ["table_name", "column_name"]
    joined = maxima.join(sequences.select(*on, "sequence_name", "last_value"), on, "left")
    absent = F.col("sequence_name").isNull()
    status = (
        F.when(absent, F.lit("MISSING"))
        .when(F.col("last_value") < F.col("right_max"), F.lit("BEHIND"))
        .when(F.col("last_value") == F.col("right_max"), F.lit("AT_MAX"))
        .otherwise(F.lit("OK"))
    )
    set_to = F.when(absent, F.coalesce("right_max", F.lit(1).cast("bigint"))).when(
        F.col("right_max") > 0, F.col("right_max")
    )
    return joined.select(
        *on, "sequence_name", "last_value", "left_max", "right_max",
        status.alias("status"),
        (~F.col("left_max").eqNullSafe(F.col("right_max"))).alias("max_differs"),
        set_to.alias("set_to"),
    )


def key_lists(keys: DataFrame) -> DataFrame:
    """``(table_name, constraint_type, key_columns, n_columns)``: the columns of each key in their order, in one text.

    ``keys`` is a catalog of constraint columns: table_name, constraint_type, column_name, ordinal_position.
    """
    grouped = keys.groupBy("table_name", "constraint_type").agg(
        F.expr("listagg(column_name, ', ') WITHIN GROUP (ORDER BY ordinal_position)").alias("key_columns"),
        F.count("*").alias("n_columns"))
    return grouped.select("table_name", "constraint_type", "key_columns", "n_columns")
