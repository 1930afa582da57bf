"""Quick check after a load: estimates first, exact counts only where needed."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.operators.catalog import (
    compare_counts,
    estimate_triage,
    row_counts,
    without_excluded,
)

COUNT_SCHEMA = "table_name string, n bigint"


def fast_counts(
    est_left: DataFrame,
    est_right: DataFrame,
    left: Mapping[str, DataFrame],
    right: Mapping[str, DataFrame],
) -> DataFrame:
    """``(table_name, left_est, right_est, status, left_n, right_n, match)``.

    Tables whose estimates lie close together are not read. The flagged ones
    are counted exactly, all in one job; only their names reach the driver.
    """
    triage = without_excluded(estimate_triage(est_left, est_right))
    flagged = {
        r.table_name for r in triage.where(F.col("status") == "VERIFY").collect()
    } & set(left) & set(right)
    if flagged:
        counts = [row_counts({t: side[t] for t in sorted(flagged)}) for side in (left, right)]
    else:
        nothing = est_left.sparkSession.createDataFrame([], COUNT_SCHEMA)
        counts = [nothing, nothing]
    exact = compare_counts(*counts).select("table_name", "left_n", "right_n", "match")
    return triage.join(exact, "table_name", "left")


def table_statistics(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``(table_name, est_rows)`` of catalog tables from the statistics kept there; NULL if there are none.

    ``tables`` maps the name a table is compared under to its name in the catalog. ``ANALYZE TABLE ...
    COMPUTE STATISTICS`` refreshes them. No data is read.
    """
    rows = []
    for name, table in tables.items():
        shown = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").collect()
        found = re.search(r"(\d+) rows", shown[0]["data_type"]) if shown else None
        rows.append((name, found and int(found.group(1))))
    return spark.createDataFrame(rows, "table_name string, est_rows bigint")


def file_statistics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, est_rows)`` of tables in Parquet files: the row counts in the footers, no column is read."""
    return row_counts(tables).withColumnRenamed("n", "est_rows")


def fast_counts_from_statistics(
    spark: SparkSession, left: Mapping[str, str], right: Mapping[str, str]
) -> DataFrame:
    """``fast_counts`` of catalog tables: only tables whose statistics differ, or that have none, are counted.

    A table without statistics on a side takes part with the count of its footers there.
    """
    estimates = []
    for side in (left, right):
        known = table_statistics(spark, side)
        missing = {r["table_name"]: spark.table(side[r["table_name"]]) for r in known.where("est_rows IS NULL").collect()}
        known = known.where("est_rows IS NOT NULL")
        estimates.append(known.unionByName(file_statistics(missing)) if missing else known)
    frames = [{name: spark.table(t) for name, t in side.items()} for side in (left, right)]
    return fast_counts(*estimates, *frames)
