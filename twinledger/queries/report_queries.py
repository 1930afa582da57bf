"""Reports over a replication catalogue derived from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.operators import reports as R
from twinledger.queries.inputs import table
from twinledger.queries.registry import query

# Customers stand for sources and users for their ids; even events are batches,
# error events are errors, purchases are discarded rows.


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _sources(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("i_id_source"), F.col("c_name").alias("t_source")
    )


def _received(spark, sf):
    seen = _events(spark, sf).where(F.col("user_id") % 5 != 0)
    return seen.groupBy(F.col("user_id").alias("i_id_source")).agg(
        F.max("ts").alias("ts_last_received")
    )


def _replayed(spark, sf):
    seen = _events(spark, sf).where((F.col("user_id") % 7 != 0) & (F.col("event_id") % 3 == 0))
    return seen.groupBy(F.col("user_id").alias("i_id_source")).agg(
        F.max("ts").alias("ts_last_replayed")
    )


def _batches(spark, sf):
    e = F.col("event_id")
    return _events(spark, sf).select(
        e.alias("i_id_batch"), F.col("user_id").alias("i_id_source"),
        F.concat(F.lit("t_log_replica_"), e % 2 + 1).alias("v_log_table"),
        (e % 1000).alias("i_replayed"), (e % 10).alias("i_skipped"), (e % 3).alias("i_ddl"),
        F.col("ts").alias("ts_created"), (e % 4 == 0).alias("b_processed"),
        (e % 6 == 0).alias("b_replayed"),
    )


def _errors(spark, sf):
    e = F.col("event_id")
    return _events(spark, sf).where(F.col("event_type") == "error").select(
        e.alias("error_id"), F.col("user_id").alias("i_id_source"), F.col("ts").alias("ts_error"),
        F.lit("public").alias("v_schema_name"),
        F.concat(F.lit("t_"), e % 17).alias("v_table_name"),
        F.repeat(F.concat(F.lit("could not apply row "), e, F.lit("; ")), 20)
        .alias("t_error_message"),
    )


def _now(spark, sf):
    return _events(spark, sf).agg(F.max("ts").alias("n")).scalar()


CATALOGUE = """
src AS (SELECT c_custkey AS i_id_source, c_name AS t_source FROM customer),
rec AS (SELECT user_id AS i_id_source, max(ts) AS ts_last_received FROM events
        WHERE user_id % 5 <> 0 GROUP BY 1),
rep AS (SELECT user_id AS i_id_source, max(ts) AS ts_last_replayed FROM events
        WHERE user_id % 7 <> 0 AND event_id % 3 = 0 GROUP BY 1),
now_ AS (SELECT max(ts) AS n FROM events),
err AS (SELECT event_id AS error_id, user_id AS i_id_source, ts AS ts_error,
               't_' || (event_id % 17) AS v_table_name,
               repeat('could not apply row ' || event_id || '; ', 20) AS t_error_message
        FROM events WHERE event_type = 'error')
"""


@query("replication_lag", CATALOGUE, sql="""
SELECT src.i_id_source, t_source,
       CAST(floor(epoch((SELECT n FROM now_))) - floor(epoch(ts_last_received)) AS BIGINT)
         AS receive_lag,
       CAST(floor(epoch((SELECT n FROM now_))) - floor(epoch(ts_last_replayed)) AS BIGINT)
         AS replay_lag
FROM src LEFT JOIN rec USING (i_id_source) LEFT JOIN rep USING (i_id_source)""")
def replication_lag_query(spark, sf):
    return R.replication_lag(
        _sources(spark, sf), _received(spark, sf), _replayed(spark, sf), _now(spark, sf)
    )


@query("source_status", CATALOGUE, sql="""
SELECT src.i_id_source, t_source, strftime(ts_last_received, '%Y-%m-%d %H:%M:%S') AS received,
       strftime(ts_last_replayed, '%Y-%m-%d %H:%M:%S') AS replayed
FROM src LEFT JOIN rec USING (i_id_source) LEFT JOIN rep USING (i_id_source)""")
def source_status_query(spark, sf):
    found = R.source_status(_sources(spark, sf), _received(spark, sf), _replayed(spark, sf))
    pattern = "yyyy-MM-dd HH:mm:ss"
    return found.select(
        "i_id_source", "t_source", F.date_format("ts_last_received", pattern).alias("received"),
        F.date_format("ts_last_replayed", pattern).alias("replayed"),
    )


@query("newest_batches", CATALOGUE, sql="""
SELECT event_id AS i_id_batch, t_source,
       't_log_replica_' || (event_id % 2 + 1) AS v_log_table, event_id % 1000 AS i_replayed,
       event_id % 10 AS i_skipped, event_id % 3 AS i_ddl
FROM events JOIN src ON user_id = i_id_source
ORDER BY event_id DESC LIMIT 10""")
def newest_batches_query(spark, sf):
    return R.newest_batches(_batches(spark, sf), _sources(spark, sf)).select(
        "i_id_batch", "t_source", "v_log_table", "i_replayed", "i_skipped", "i_ddl"
    )


@query("pending_batches", sql="""
SELECT count(*) FILTER (WHERE event_id % 4 <> 0 AND event_id % 6 <> 0) AS pending
FROM events""")
def pending_batches_query(spark, sf):
    return R.pending_batches(_batches(spark, sf))


@query("discards_by_table", sql="""
SELECT 'public' AS v_schema_name, 't_' || (event_id * event_id % 43) AS v_table_name,
       count(*) AS discarded
FROM events WHERE event_type = 'purchase'
GROUP BY 1, 2 ORDER BY discarded DESC, v_schema_name, v_table_name LIMIT 20""")
def discards_by_table_query(spark, sf):
    e = F.col("event_id")
    discards = _events(spark, sf).where(F.col("event_type") == "purchase").select(
        F.lit("public").alias("v_schema_name"),
        F.concat(F.lit("t_"), e * e % 43).alias("v_table_name"),
    )
    return R.discards_by_table(discards)


@query("errors_recent", CATALOGUE, sql="""
SELECT strftime(ts_error, '%Y-%m-%d %H:%M:%S') AS ts_error, t_source, v_table_name,
       substr(t_error_message, 1, 120) AS error
FROM err JOIN src USING (i_id_source)
WHERE ts_error > (SELECT n FROM now_) - INTERVAL 24 HOURS
ORDER BY err.ts_error DESC, error_id LIMIT 20""")
def errors_recent_query(spark, sf):
    found = R.errors_recent(
        _errors(spark, sf), _sources(spark, sf), _now(spark, sf), n=20, width=120, tie_break="error_id"
    )
    return found.select(
        F.date_format("ts_error", "yyyy-MM-dd HH:mm:ss").alias("ts_error"), "t_source",
        "v_table_name", "error",
    )


@query("errors_latest", CATALOGUE, sql="""
SELECT error_id, t_source, v_table_name, substr(t_error_message, 1, 150) AS error
FROM err JOIN src USING (i_id_source) ORDER BY err.ts_error DESC, error_id LIMIT 20""")
def errors_latest_query(spark, sf):
    found = R.errors_recent(
        _errors(spark, sf), _sources(spark, sf), hours=None, n=20, width=150,
        tie_break="error_id",
    )
    return found.select("error_id", "t_source", "v_table_name", "error")


@query("error_count", CATALOGUE, sql="""
SELECT count(*) AS errors FROM err WHERE ts_error > (SELECT n FROM now_) - INTERVAL 24 HOURS""")
def error_count_query(spark, sf):
    return R.error_count(_errors(spark, sf), _now(spark, sf))
