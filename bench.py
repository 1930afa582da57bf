"""Headline timings. Prints one JSON line.

All queries are run once to warm up; then each is run three times and the median
counts. The result is written to Spark's noop sink, so every row and column is computed and
nothing is sent to the driver. The change log is stored once before, so its making is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import partial

from pyspark.sql import functions as F

from twinledger.operators import diff as D
from twinledger.operators.balance import written
from twinledger.queries import load
from twinledger.queries.inputs import store_change_log
from twinledger.session import local_session

HEADLINE = (
    "diff_rows",
    "diff_merge",
    "diff_chunked",
    "diff_chunked_few_dirty",
    "diff_bucketed",
    "diff_rows_repeated_keys",
    "column_diff",
    "changed_column_counts",
    "chunk_digest",
    "table_digest",
    "null_audit",
    "key_audit_lineitem",
    "json_equal",
    "parent_total_reconcile",
    "op_counts",
    "offset_gaps",
    "unwrap_events",
    "apply_changes",
    "upsert_sink",
    "apply_changes_stream",
    "verify_replay",
    "parse_envelope_connect",
    "replay_all_tables",
    "upsert_sink_compacted",
    "verify_replay_incremental",
    "one_sided_inspect",
    "reconcile_summary",
)
RUNS = 3
LARGE_ROWS = 17_000_000


def large_pair(spark):
    """Two tables of 17 million integer keys with about 300 keys on one side only."""
    k = F.col("id")
    left = spark.range(LARGE_ROWS).select("id", (k * 7 % 1_000_003).alias("v"))
    right = left.where(k % 100_003 != 5).unionByName(
        left.where(k % 120_011 == 7).withColumn("id", k + LARGE_ROWS))
    return left, right


def large_cases(spark):
    left, right = (written(df, "bench-17m") for df in large_pair(spark))
    return {
        "17m_key_set_diff": lambda: D.key_set_diff(left, right, ["id"]),
        "17m_diff_bucketed": lambda: D.diff_bucketed(left, right, "id"),
        "17m_diff_rows": lambda: D.diff_rows(left, right, ["id"]),
        "17m_diff_chunked": lambda: D.diff_chunked(left, right, "id"),
    }


def timed(fn) -> float:
    start = time.perf_counter()  # plans that look at the data first are charged for it
    fn().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    store_change_log(spark, sf)
    wanted = os.environ.get("BENCH_QUERIES")
    chosen = {
        name: partial(queries[name], spark, sf)
        for name in (wanted.split(",") if wanted else HEADLINE)
    }
    if os.environ.get("BENCH_17M"):
        chosen |= large_cases(spark)
    for run in chosen.values():
        timed(run)
    seconds = {
        name: round(statistics.median(timed(run) for _ in range(RUNS)), 3)
        for name, run in chosen.items()
    }
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf).removeprefix("sf"),
        "cores": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
