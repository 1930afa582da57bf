"""Reports over the replication catalogue and over comparison results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_status(sources: DataFrame, received: DataFrame, replayed: DataFrame) -> DataFrame:
    """Every source with its last received and replayed time, NULL if never seen."""
    return sources.join(received, "i_id_source", "left").join(replayed, "i_id_source", "left")


def with_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Batches or errors enriched with the name of their source."""
    return df.join(sources.select("i_id_source", "t_source"), "i_id_source")


def newest_batches(batches: DataFrame, sources: DataFrame, n: int = 10) -> DataFrame:
    return with_source(batches, sources).orderBy(F.col("i_id_batch").desc()).limit(n)


def pending_batches(batches: DataFrame) -> DataFrame:
    """``pending``: batches neither processed nor replayed."""
    waiting = ~F.col("b_processed") & ~F.col("b_replayed")
    return batches.agg(F.count_if(waiting).alias("pending"))


def _seconds(later: Column, earlier: Column) -> Column:
    return F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))


def replication_lag(
    sources: DataFrame, received: DataFrame, replayed: DataFrame, now: Column
) -> DataFrame:
    """``(t_source, receive_lag, replay_lag)`` in seconds, NULL if never seen."""
    joined = source_status(sources, received, replayed)
    return joined.select(
        "i_id_source", "t_source",
        _seconds(now, F.col("ts_last_received")).alias("receive_lag"),
        _seconds(now, F.col("ts_last_replayed")).alias("replay_lag"),
    )


def discards_by_table(discards: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` tables with the most discarded rows."""
    counted = discards.groupBy("v_schema_name", "v_table_name").agg(
        F.count("*").alias("discarded")
    )
    order = [F.col("discarded").desc(), "v_schema_name", "v_table_name"]
    return counted.orderBy(*order).limit(n)


def _recent(errors: DataFrame, now: Column, hours: int) -> DataFrame:
    return errors.where(F.col("ts_error") > now - F.expr(f"INTERVAL {int(hours)} HOURS"))


def error_count(errors: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return _recent(errors, now, hours).agg(F.count("*").alias("errors"))


def errors_recent(
    errors: DataFrame,
    sources: DataFrame,
    now: Column | None = None,
    hours: int | None = 24,
    n: int = 5,
    width: int | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Newest errors first, with the whole message, or its first ``width`` characters."""
    found = errors if hours is None or now is None else _recent(errors, now, hours)
    order = [F.col("ts_error").desc()] + ([F.col(tie_break)] if tie_break else [])
    shown = with_source(found, sources).orderBy(*order).limit(n)
    message = F.col("t_error_message")
    return shown.withColumn("error", message if width is None else F.substring(message, 1, width)).drop(
        "t_error_message"
    )


def status_of(left_only: Column, right_only: Column, changed: Column) -> Column:
    return F.when(left_only + right_only + changed == 0, F.lit("OK")).otherwise(F.lit("DIFF"))


def reconcile_summary(results: DataFrame) -> DataFrame:
    """Per-table rows plus one ``TOTAL`` row.

    ``results``: table_name, status, left_only, right_only, changed. The total
    is ``PASS`` only if no table is ``DIFF`` or ``ERROR``. As many left-only as
    right-only rows and nothing changed usually means the same keys in two
    spellings, which is flagged.
    """
    failed = F.col("status").isin("DIFF", "ERROR")
    suspect = (
        (F.col("left_only") > 0)
        & (F.col("left_only") == F.col("right_only"))
        & (F.col("changed") == 0)
    )
    counts = ("left_only", "right_only", "changed")
    # A rollup over the one-row tables: the comparisons themselves run once.
    rolled = results.select("table_name", "status", *counts, suspect.alias("_suspect")).rollup(
        "table_name"
    ).agg(
        F.grouping("table_name").alias("_total"),
        F.max("status").alias("_status"),
        F.count_if(failed).alias("_failed"),
        *[F.sum(c).alias(c) for c in counts],
        F.coalesce(F.bool_or("_suspect"), F.lit(False)).alias("key_representation_suspect"),
    )
    total = F.col("_total") == 1
    outcome = F.when(F.col("_failed") > 0, F.lit("FAIL")).otherwise(F.lit("PASS"))
    nothing = F.lit(0).cast("bigint")
    return rolled.select(
        F.when(total, F.lit("TOTAL")).otherwise(F.col("table_name")).alias("table_name"),
        F.when(total, outcome).otherwise(F.col("_status")).alias("status"),
        *[F.when(total, F.coalesce(c, nothing)).otherwise(F.col(c)).alias(c) for c in counts],
        "key_representation_suspect",
    )
