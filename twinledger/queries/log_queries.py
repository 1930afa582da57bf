"""The change log: reading, counting, checking, replaying, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions.arithmetic import floor_div
from twinledger.operators import changelog as L
from twinledger.operators import digest as G
from twinledger.operators.balance import written
from twinledger.operators.replay import apply_changes, changed_images, latest_per_key, verify_chunks
from twinledger.plans.rollback import copy_and_catch_up, events_of, readiness, replay_and_verify
from twinledger.queries.inputs import (
    CHANGES,
    FINAL_STATE,
    FULL_LOG,
    HEARTBEAT_TOPIC,
    INSTANCE,
    KEY_SCHEMA,
    LOG_COLUMNS,
    ROW_SCHEMA,
    SHOWN_STATE,
    base_copy,
    change_log,
    changes,
    files_per_batch,
    full_log,
    log_files,
    midpoint,
    shown_state,
    table,
)
from twinledger.queries.registry import query
from twinledger.session import scratch_path
from twinledger.sources.tables import read_change_log
from twinledger.streaming.jobs import (
    append_closed,
    dedupe_stream,
    fold,
    keep_updates,
    latest_updates,
    op_counts_by_window,
    op_counts_closed_windows,
    replay_progress,
    replayed_to,
    run_to_end,
    run_until,
    upsert_stream,
    upserted,
)

STATE_KEYS = ["schema", "table", "id"]
STATE_SCHEMA = "schema string, table string, id bigint, value decimal(18,2), ts string"


def _text(c: str):
    return F.col(c).cast("string").alias(c)


# -- reading and scoping -------------------------------------------------------


def _file_count(spark, sf) -> int:
    """Files of the stored log."""
    return log_files(table(spark, sf, "events").count())


def stored_log(spark, sf, files: int, where=None) -> str:
    """The log as files in the shared scratch folder, for file-based readers."""
    path = scratch_path(spark, "log")
    spread = change_log(spark, sf, where).repartition(files, "topic", "partition", "offset")
    spread.write.parquet(path)
    return path


@query("read_change_log", CHANGES, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, pos AS "offset", tombstone
FROM log WHERE topic <> 'cdc-demo.public.products'""")
def read_change_log_query(spark, sf):
    log = read_change_log(
        spark, stored_log(spark, sf, _file_count(spark, sf)), L.topic_regex(INSTANCE),
        ["cdc-demo.public.products"],
    )
    return log.select("topic", "partition", "offset", F.col("value").isNull().alias("tombstone"))


@query("instance_scope", FULL_LOG, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, pos AS "offset" FROM full_log
WHERE topic LIKE 'cdc-demo.%' AND topic <> 'cdc-demo.cdc.debezium_heartbeat'
  AND topic NOT LIKE '%__debezium%' AND topic NOT LIKE 'cdc-demo.replica_meta.%'""")
def instance_scope_query(spark, sf):
    scoped = L.instance_scope(full_log(spark, sf), INSTANCE, ["replica_meta"])
    return scoped.select("topic", "partition", "offset")


@query("route_topic", FULL_LOG, sql=r"""
SELECT topic, CASE WHEN regexp_matches(topic, '^cdc(-[^.]+)?\.[^.]+\..+$')
                   THEN regexp_extract(topic, '^cdc(-[^.]+)?\.[^.]+\.(.+)$', 2)
                   ELSE topic END AS tbl,
       nullif(regexp_extract(topic, '^cdc(-[^.]+)?\.([^.]+)\.(.+)$', 2), '') AS schema_name,
       count(*) AS n
FROM full_log GROUP BY ALL""")
def route_topic_query(spark, sf):
    return full_log(spark, sf).groupBy(
        "topic", L.route_topic("topic").alias("tbl"), L.topic_schema("topic").alias("schema_name")
    ).agg(F.count("*").alias("n"))


@query("parse_envelope", CHANGES, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, pos AS "offset", id, tombstone, op,
       CASE WHEN op = 'd' THEN CAST(value AS VARCHAR) END AS before_value,
       CASE WHEN op <> 'd' THEN CAST(value AS VARCHAR) END AS after_value,
       CASE WHEN op IS NOT NULL THEN event_id * 16 END AS lsn,
       CASE WHEN op IS NOT NULL THEN epoch_us(ts) // 1000 END AS ts_ms, FALSE AS corrupt
FROM log""")
def parse_envelope_query(spark, sf):
    events = L.parse_envelope(change_log(spark, sf), ROW_SCHEMA, KEY_SCHEMA)
    return events.select(
        "topic", "partition", "offset", F.col("key.id").alias("id"), "tombstone", "op",
        F.col("before.value").cast("string").alias("before_value"),
        F.col("after.value").cast("string").alias("after_value"), "lsn", "ts_ms", "corrupt",
    )


@query("unwrap_events", CHANGES, sql="""
SELECT tbl, id, CASE WHEN op <> 'd' THEN CAST(value AS VARCHAR) END AS value,
       CASE WHEN op <> 'd' THEN ts_text END AS ts_text, op = 'd' AS deleted,
       CAST(part AS INTEGER) AS partition, pos AS "offset"
FROM changes""")
def unwrap_events_query(spark, sf):
    events = events_of(change_log(spark, sf), INSTANCE, ROW_SCHEMA, KEY_SCHEMA)
    return events.select(
        F.col("table").alias("tbl"), "id", _text("value"), F.col("ts").alias("ts_text"),
        F.col("_deleted").alias("deleted"), "partition", "offset",
    )


# -- counting ------------------------------------------------------------------

PER_PARTITION = """
per_part AS (
  SELECT topic, part,
         count(*) FILTER (WHERE op = 'c') AS ins, count(*) FILTER (WHERE op = 'u') AS upd,
         count(*) FILTER (WHERE tombstone) AS del, count(*) FILTER (WHERE op = 'd') AS dev,
         max(pos) - min(pos) + 1 AS total
  FROM log GROUP BY topic, part)
"""


@query("op_counts", CHANGES.strip() + "," + PER_PARTITION, sql="""
SELECT COALESCE(replace(topic, 'cdc-demo.', ''), 'TOTAL') AS "table",
       CAST(sum(ins) AS BIGINT) AS inserts, CAST(sum(upd) AS BIGINT) AS updates,
       CAST(sum(del) AS BIGINT) AS deletes, CAST(sum(dev) AS BIGINT) AS delete_events,
       CAST(0 AS BIGINT) AS snapshot_reads, CAST(sum(total) AS BIGINT) AS total
FROM per_part GROUP BY ROLLUP (topic)""")
def op_counts_query(spark, sf):
    return L.op_counts(change_log(spark, sf))


@query("topic_totals", FULL_LOG.strip() + """,
per_part AS (
  SELECT topic, max(pos) - min(pos) + 1 AS total FROM full_log
  WHERE topic LIKE 'cdc-demo.public.%' GROUP BY topic, part)""", sql="""
SELECT COALESCE(replace(topic, 'cdc-demo.', ''), 'TOTAL') AS "table",
       CAST(sum(total) AS BIGINT) AS total
FROM per_part GROUP BY ROLLUP (topic)""")
def topic_totals_query(spark, sf):
    scoped = L.instance_scope(full_log(spark, sf), INSTANCE, ["replica_meta"])
    return L.topic_totals(scoped)


def _committed(log):
    """Three consumer groups: caught up, behind, and one that never committed."""
    end = L.log_end(log)
    rows = []
    for group, offset in (
        ("done", F.col("end_offset").cast("string")),
        ("slow", (F.col("end_offset") - F.col("partition") * 40).cast("string")),
        ("new", F.lit("-")),
    ):
        rows.append(end.select(
            F.lit(group).alias("group"), "topic", "partition", offset.alias("committed_offset")
        ))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


LAG_SQL = """
SELECT 'done' AS "group", CAST(0 AS BIGINT) AS total_lag, CAST(0 AS BIGINT) AS lagging_partitions,
       'caught_up' AS state{extra_done}
UNION ALL SELECT 'new', 0, 0, 'caught_up'{extra_done}
UNION ALL
SELECT 'slow', CAST(sum(part * 40) AS BIGINT), count(*) FILTER (WHERE part > 0), 'behind'{extra_slow}
FROM (SELECT DISTINCT topic, part FROM log)"""


@query("consumer_lag", CHANGES, sql=LAG_SQL.format(extra_done="", extra_slow=""))
def consumer_lag_query(spark, sf):
    log = change_log(spark, sf)
    return L.consumer_lag(L.log_end(log), _committed(log))


@query("replay_progress", CHANGES,
       sql=LAG_SQL.format(extra_done=", TRUE AS done", extra_slow=", FALSE"))
def replay_progress_query(spark, sf):
    log = change_log(spark, sf)
    return replay_progress(L.log_end(log), _committed(log))


@query("lagging_partitions", CHANGES, sql="""
SELECT DISTINCT 'slow' AS "group", topic, CAST(part AS INTEGER) AS partition,
       CAST(part * 40 AS BIGINT) AS lag
FROM log WHERE part > 0""")
def lagging_partitions_query(spark, sf):
    log = change_log(spark, sf)
    return L.lagging_partitions(L.log_end(log), _committed(log))


@query("heartbeat_age", FULL_LOG, sql="""
SELECT CAST(floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(max(ts))) AS BIGINT)
         AS age_seconds,
       CASE WHEN floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(max(ts))) > 60
            THEN 'WARN' ELSE 'OK' END AS status
FROM full_log WHERE topic = 'cdc-demo.cdc.debezium_heartbeat'""")
def heartbeat_age_query(spark, sf):
    now = table(spark, sf, "events").agg(F.max("ts").cast("timestamp").alias("n")).scalar()
    return L.heartbeat_age(full_log(spark, sf), now, instance=INSTANCE)


# -- completeness --------------------------------------------------------------


def _holed(log):
    """Some offsets lost, some delivered twice."""
    lost = (F.col("offset") % 400).between(100, 109) & F.col("topic").endswith(".orders")
    kept = log.where(~lost)
    return kept.unionByName(kept.where(F.col("offset") % 17 == 0))


HOLED = CHANGES.strip() + """,
holed AS (SELECT topic, part, pos, min(ts) AS ts FROM log
          WHERE NOT (pos % 400 BETWEEN 100 AND 109 AND topic LIKE '%.orders')
          GROUP BY topic, part, pos)
"""


@query("offset_gaps", HOLED, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, prev + 1 AS gap_start, pos - 1 AS gap_end,
       pos - prev - 1 AS missing
FROM (SELECT *, lag(pos) OVER (PARTITION BY topic, part ORDER BY pos) AS prev FROM holed)
WHERE pos - prev > 1""")
def offset_gaps_query(spark, sf):
    # Small blocks, so that gaps inside and across blocks both occur.
    return L.offset_gaps(_holed(change_log(spark, sf)), block=64)


@query("log_completeness", HOLED, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, min(pos) AS first_offset,
       max(pos) AS last_offset, count(*) AS records,
       max(pos) - min(pos) + 1 - count(*) AS missing,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_timestamp
FROM holed GROUP BY topic, part""")
def log_completeness_query(spark, sf):
    found = L.log_completeness(_holed(change_log(spark, sf)))
    stamp = F.date_format("first_timestamp", "yyyy-MM-dd HH:mm:ss").alias("first_timestamp")
    return found.withColumn("first_timestamp", stamp)


GUARD_SQL = """
, guard AS (
  SELECT topic, min(first_pos) AS first_offset, CAST(sum(missing) AS BIGINT) AS missing,
         epoch((SELECT max(ts) FROM events)) - epoch((SELECT min(ts) FROM events)) > 168 * 3600
           AS window_exceeded,
         max(first_ts) > (SELECT min(ts) FROM events) + INTERVAL 1 HOUR AS starts_late
  FROM (SELECT topic, part, min(pos) AS first_pos, min(ts) AS first_ts,
               max(pos) - min(pos) + 1 - count(*) AS missing
        FROM holed GROUP BY topic, part) GROUP BY topic)
"""


def _times(spark, sf):
    events = table(spark, sf, "events")
    first = events.agg((F.min("ts").cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("c"))
    cutover = first.scalar()
    now = events.agg(F.max("ts").cast("timestamp").alias("n")).scalar()
    return cutover, now


@query("retention_guard", HOLED, sql=GUARD_SQL + """
SELECT topic, first_offset, missing, window_exceeded, starts_late,
       NOT window_exceeded AND NOT starts_late AND missing = 0 AS safe
FROM guard""")
def retention_guard_query(spark, sf):
    cutover, now = _times(spark, sf)
    found = L.retention_guard(_holed(change_log(spark, sf)), cutover, now)
    return found.drop("first_timestamp")


@query("rollback_readiness", HOLED, sql=GUARD_SQL + """
SELECT count(*) AS topics, count(*) FILTER (WHERE starts_late OR missing > 0) AS unsafe_topics,
       CASE WHEN count(*) FILTER (WHERE starts_late OR missing > 0) = 0 THEN 'READY' ELSE 'UNSAFE' END AS verdict
FROM guard""")
def rollback_readiness_query(spark, sf):
    # Decided 100 hours after the cutover, so within the retention window.
    cutover, _ = _times(spark, sf)
    decided = cutover + F.expr("INTERVAL 100 HOURS")
    return readiness(_holed(change_log(spark, sf)), INSTANCE, cutover, decided)


@query("dedupe_events", HOLED, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, pos AS "offset" FROM holed""")
def dedupe_events_query(spark, sf):
    return L.dedupe_events(_holed(change_log(spark, sf))).select("topic", "partition", "offset")


# -- replay --------------------------------------------------------------------


@query("latest_per_key", CHANGES, sql="""
SELECT tbl, id, op = 'd' AS deleted, CASE WHEN op <> 'd' THEN CAST(value AS VARCHAR) END AS value,
       CAST(part AS INTEGER) AS partition, pos AS "offset"
FROM (SELECT *, row_number() OVER (PARTITION BY tbl, id ORDER BY event_id DESC) AS rn FROM changes)
WHERE rn = 1""")
def latest_per_key_query(spark, sf):
    events = events_of(change_log(spark, sf), INSTANCE, ROW_SCHEMA, KEY_SCHEMA)
    return latest_per_key(events, STATE_KEYS).select(
        F.col("table").alias("tbl"), "id", F.col("_deleted").alias("deleted"), _text("value"),
        "partition", "offset",
    )


def _tail(spark, sf):
    return F.col("event_id") > midpoint(spark, sf)


@query("apply_changes", FINAL_STATE, sql=SHOWN_STATE)
def apply_changes_query(spark, sf):
    log = change_log(spark, sf, _tail(spark, sf))
    events = events_of(log, INSTANCE, ROW_SCHEMA, KEY_SCHEMA)
    return shown_state(apply_changes(base_copy(spark, sf), events, STATE_KEYS))


@query("apply_changes_repeated_records", FINAL_STATE, sql=SHOWN_STATE)
def apply_changes_repeated_query(spark, sf):
    log = change_log(spark, sf, _tail(spark, sf))
    twice = log.unionByName(log.where(F.col("offset") % 3 == 0))
    # both replays read the events; stored, the log is parsed once
    events = written(events_of(twice, INSTANCE, ROW_SCHEMA, KEY_SCHEMA), "repeated-events")
    once = apply_changes(base_copy(spark, sf), events, STATE_KEYS)
    return shown_state(apply_changes(once, events, STATE_KEYS))


def snapshot_positions(spark, sf) -> dict[tuple[str, int], int]:
    """Last offset the base copy covers: one number per topic partition."""
    seen = changes(spark, sf).where(F.col("event_id") <= midpoint(spark, sf))
    behind = F.col("offset") + F.when(F.col("op") == "d", 1).otherwise(0)
    rows = seen.groupBy("table", "partition").agg(F.max(behind).alias("last")).collect()
    return {(f"cdc-demo.public.{r['table']}", r["partition"]): r["last"] for r in rows}


@query("copy_and_catch_up", FINAL_STATE, sql=SHOWN_STATE)
def copy_and_catch_up_query(spark, sf):
    state = copy_and_catch_up(
        base_copy(spark, sf), change_log(spark, sf), INSTANCE, STATE_KEYS, ROW_SCHEMA, KEY_SCHEMA,
        snapshot_positions(spark, sf),
    )
    return shown_state(state)


@query("copy_and_catch_up_positions", FINAL_STATE, sql=SHOWN_STATE)
def copy_and_catch_up_positions_query(spark, sf):
    """Snapshot positions as a table, joined to the log."""
    seen = changes(spark, sf).where(F.col("event_id") <= midpoint(spark, sf))
    behind = F.col("offset") + F.when(F.col("op") == "d", 1).otherwise(0)
    positions = seen.groupBy(F.concat(F.lit("cdc-demo.public."), "table").alias("topic"), "partition").agg(
        F.max(behind).alias("offset"))
    state = copy_and_catch_up(base_copy(spark, sf), change_log(spark, sf), INSTANCE, STATE_KEYS, ROW_SCHEMA, KEY_SCHEMA, positions)
    return shown_state(state)


INCREMENTAL = """
hashed AS (
  SELECT id // 50 AS chunk_id, md5(concat_ws(chr(29), CAST(id AS VARCHAR),
           COALESCE(CAST(value AS VARCHAR), chr(1)), COALESCE(ts_text, chr(1)))) AS h
  FROM final_state WHERE tbl = 'orders')
"""


@query("verify_replay_incremental", FINAL_STATE.strip() + "," + INCREMENTAL, sql="""
SELECT chunk_id, count(*) AS n,
       CAST(CAST(sum(CAST(('0x' || substr(h, 1, 8)) AS BIGINT)) AS HUGEINT) AS VARCHAR) AS s0,
       CAST(CAST(sum(CAST(('0x' || substr(h, 25, 8)) AS BIGINT)) AS HUGEINT) AS VARCHAR) AS s3,
       TRUE AS verified
FROM hashed GROUP BY chunk_id""")
def verify_replay_incremental_query(spark, sf):
    """Digests of one table kept up to date over three batches of its log, each batch checked on its own chunks."""
    columns, types = ["id", "value", "ts"], {"id": "int8", "value": "numeric", "ts": "text"}
    top = table(spark, sf, "events").agg(F.max("event_id").alias("m")).first().m or 0
    state = spark.createDataFrame([], ROW_SCHEMA)
    digests = G.chunk_digest(state, "id", columns, types, 50)
    e, verified = F.col("event_id"), True
    for i in range(3):
        part = (e > i * top // 3 - (i == 0)) & (e <= (i + 1) * top // 3) & (F.col("table") == "orders")
        events = events_of(change_log(spark, sf, part), INSTANCE, ROW_SCHEMA, KEY_SCHEMA).drop("schema", "table")
        before, after = changed_images(state, events, ["id"])
        change = written(G.digest_change(before, after, "id", columns, types, 50), "digest-change")
        digests = written(G.updated_digests(digests, change), "digests")
        state = written(apply_changes(state, events, ["id"]), "state")
        checked = verify_chunks(digests, state, change, "id", columns, types, 50)
        verified = verified and checked.where("NOT same").isEmpty()
    return digests.select("chunk_id", "n", F.col("s0").cast("string").alias("s0"), F.col("s3").cast("string").alias("s3"),
                          F.lit(verified).alias("verified"))


@query("verify_replay", FINAL_STATE, sql="""
SELECT count(*) AS state_rows, count(*) - count(*) FILTER (WHERE id % 50 = 7) AS source_rows,
       count(*) FILTER (WHERE id % 50 = 7) AS left_only, CAST(0 AS BIGINT) AS right_only,
       CAST(0 AS BIGINT) AS changed,
       CASE WHEN count(*) FILTER (WHERE id % 50 = 7) = 0 THEN 'VERIFIED' ELSE 'DIFF' END AS verdict
FROM final_state""")
def verify_replay_query(spark, sf):
    tail = F.coalesce(_tail(spark, sf), F.lit(False))
    log, head = change_log(spark, sf, tail), change_log(spark, sf, ~tail)
    # the replay and the source both need the tail; stored, each record is parsed once
    events = written(events_of(log, INSTANCE, ROW_SCHEMA, KEY_SCHEMA), "tail-events")
    last = latest_per_key(
        events_of(head, INSTANCE, ROW_SCHEMA, KEY_SCHEMA).unionByName(events), STATE_KEYS
    ).where(~F.col("_deleted"))
    source = last.select("schema", "table", "id", "value", "ts").where(F.col("id") % 50 != 7)
    return replay_and_verify(base_copy(spark, sf), events, source, STATE_KEYS)


# -- streams -------------------------------------------------------------------


def _stream(spark, sf, where=None):
    """The stored log as a stream of three batches, or more of a bounded size."""
    files = _file_count(spark, sf)
    return read_change_log(
        spark, stored_log(spark, sf, files, where), L.topic_regex(INSTANCE), streaming=True,
        max_files_per_trigger=files_per_batch(files),
    )


def _run_replay(spark, sf, where=None, base=None, repeat: bool = False):
    path = scratch_path(spark, "state")
    base = spark.createDataFrame([], STATE_SCHEMA) if base is None else base
    log = _stream(spark, sf, where)
    events = L.unwrap(L.parse_envelope(log, ROW_SCHEMA, KEY_SCHEMA))
    for turn in range(2 if repeat else 1):
        upsert_stream(
            events, STATE_KEYS, STATE_SCHEMA, path, f"{path}/checkpoint-{turn}", f"replay-{turn}"
        ).awaitTermination()
    return upserted(base, STATE_KEYS, path)


@query("upsert_sink", FINAL_STATE, sql=SHOWN_STATE)
def upsert_sink_query(spark, sf):
    return shown_state(_run_replay(spark, sf))


@query("upsert_sink_compacted", FINAL_STATE, sql=SHOWN_STATE)
def upsert_sink_compacted_query(spark, sf):
    """Half of the log, a fold, the rest with late and repeated batches, and a second fold."""
    path = scratch_path(spark, "state")
    empty = spark.createDataFrame([], STATE_SCHEMA)
    half = _midpoint_value(spark, sf)
    e = F.col("event_id")
    for turn, where in enumerate((e <= half, (e > half) | (e % 3 == 0))):
        events = L.unwrap(L.parse_envelope(_stream(spark, sf, where), ROW_SCHEMA, KEY_SCHEMA))
        upsert_stream(events, STATE_KEYS, STATE_SCHEMA, path, f"{path}/checkpoint-{turn}", f"replay-{turn}").awaitTermination()
        fold(empty, STATE_KEYS, path)
    return shown_state(upserted(empty, STATE_KEYS, path))


def _resumed(spark, sf, path) -> list[str | None]:
    """The whole log, stopped after one batch, gone on with, and failed once within a batch."""
    events = L.unwrap(L.parse_envelope(_stream(spark, sf), ROW_SCHEMA, KEY_SCHEMA))
    failed = []

    def fail_once(batch_id: int) -> None:
        if not failed and batch_id > 0:
            failed.append(batch_id)
            raise RuntimeError(f"lost after batch {batch_id}")

    def start(once: bool = True, after_batch=None):
        return upsert_stream(events, STATE_KEYS, STATE_SCHEMA, path, f"{path}/checkpoint", once=once, after_batch=after_batch)

    run_until(start(once=False), 1)
    return run_to_end(lambda: start(after_batch=fail_once))


@query("replay_resumed", FINAL_STATE, sql=SHOWN_STATE)
def replay_resumed_query(spark, sf):
    path = scratch_path(spark, "state")
    _resumed(spark, sf, path)
    return shown_state(upserted(spark.createDataFrame([], STATE_SCHEMA), STATE_KEYS, path))


@query("replay_progress_stored", CHANGES, sql="""
SELECT 'replay' AS "group", CAST(0 AS BIGINT) AS total_lag, CAST(0 AS BIGINT) AS lagging_partitions,
       'caught_up' AS state, TRUE AS done FROM (SELECT count(*) FROM log)""")
def replay_progress_stored_query(spark, sf):
    """Lag of the resumed replay, from what it has stored."""
    path = scratch_path(spark, "state")
    _resumed(spark, sf, path)
    return replay_progress(L.log_end(change_log(spark, sf)), replayed_to(spark, path, INSTANCE))


@query("apply_changes_stream", FINAL_STATE, sql=SHOWN_STATE)
def apply_changes_stream_query(spark, sf):
    tail = F.col("event_id") > _midpoint_value(spark, sf)
    return shown_state(_run_replay(spark, sf, tail, base_copy(spark, sf), repeat=True))


def _midpoint_value(spark, sf) -> int:
    top = table(spark, sf, "events").agg(floor_div(F.max("event_id"), 2).alias("m"))
    return top.first().m


@query("op_counts_stream", CHANGES, sql="""
SELECT replace(topic, 'cdc-demo.public.', '') AS "table",
       strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) FILTER (WHERE op = 'c') AS inserts, count(*) FILTER (WHERE op = 'u') AS updates,
       count(*) FILTER (WHERE tombstone) AS deletes, count(*) AS total
FROM log GROUP BY 1, 2""")
def op_counts_stream_query(spark, sf):
    path = scratch_path(spark, "window-counts")
    counts = op_counts_by_window(_stream(spark, sf), "1 day")
    keep_updates(counts, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    found = latest_updates(spark.read.parquet(f"{path}/rows"), ["table", "window_start"])
    shown = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return found.withColumn("window_start", shown)


@query("op_counts_window_batch", CHANGES, sql="""
SELECT replace(topic, 'cdc-demo.public.', '') AS "table",
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) FILTER (WHERE op = 'c') AS inserts, count(*) FILTER (WHERE op = 'u') AS updates,
       count(*) FILTER (WHERE tombstone) AS deletes, count(*) AS total
FROM log GROUP BY 1, 2""")
def op_counts_window_batch_query(spark, sf):
    found = op_counts_by_window(change_log(spark, sf), "1 hour")
    shown = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return found.withColumn("window_start", shown)


@query("op_counts_closed_windows", CHANGES, """
seen AS (SELECT * FROM log WHERE event_id <= (SELECT max(event_id) // 2 FROM events)),
beats AS (SELECT ts FROM events WHERE event_id % 500 = 0),
newest AS (SELECT max(ts) AS ts FROM (SELECT ts FROM seen UNION ALL SELECT ts FROM beats))""", sql="""
SELECT replace(topic, 'cdc-demo.public.', '') AS "table",
       strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) FILTER (WHERE op = 'c') AS inserts, count(*) FILTER (WHERE op = 'u') AS updates,
       count(*) FILTER (WHERE tombstone) AS deletes, count(*) AS total
FROM seen WHERE date_trunc('day', ts) + INTERVAL 2 DAY <= (SELECT ts FROM newest) GROUP BY 1, 2""")
def op_counts_closed_windows_query(spark, sf):
    """All tables fall idle at the midpoint of the log; the heartbeats behind it close their windows."""
    path = scratch_path(spark, "closed-windows")
    files = _file_count(spark, sf)
    seen = change_log(spark, sf, F.col("event_id") <= midpoint(spark, sf)).select(*LOG_COLUMNS)
    seen.repartition(files).write.parquet(f"{path}/log")
    beats = full_log(spark, sf).where(F.col("topic") == HEARTBEAT_TOPIC).select(*LOG_COLUMNS)
    beats.repartition(files).write.mode("append").parquet(f"{path}/log")
    log = read_change_log(spark, f"{path}/log", streaming=True, max_files_per_trigger=files)
    windows = op_counts_closed_windows(log, "1 day", "1 day", INSTANCE)
    append_closed(windows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    shown = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return spark.read.schema(windows.schema).parquet(f"{path}/rows").withColumn("window_start", shown)


@query("dedupe_events_stream", CHANGES, sql="""
SELECT topic, CAST(part AS INTEGER) AS partition, pos AS "offset" FROM log""")
def dedupe_events_stream_query(spark, sf):
    path = scratch_path(spark, "dedupe")
    log = change_log(spark, sf).select(*LOG_COLUMNS)
    source = f"{path}/log"
    log.unionByName(log.where(F.col("offset") % 17 == 0)).write.parquet(source)
    unique = dedupe_stream(read_change_log(spark, source, streaming=True), 40 * 24)
    writer = unique.writeStream.format("parquet").option("checkpointLocation", f"{path}/cp")
    writer.trigger(availableNow=True).start(f"{path}/unique").awaitTermination()
    return spark.read.parquet(f"{path}/unique").select("topic", "partition", "offset")
