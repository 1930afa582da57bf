import json

import pytest
from pyspark.sql import functions as F

from twinledger.operators import changelog as L
from twinledger.operators.replay import apply_changes, latest_per_key, replay_rejects, verify_replay
from twinledger.plans.rollback import copy_and_catch_up, events_of, readiness
from twinledger.sources.tables import read_change_log
from twinledger.streaming.jobs import (
    append_batch,
    compact,
    dedupe_stream,
    keep_updates,
    late_records,
    latest_updates,
    op_counts_by_window,
    progress_of,
    stored_changes,
    upsert_stream,
    upserted,
)

ROW, KEY = "id bigint, v string", "id bigint"
TOPIC = "cdc-a.public.t"


def envelope(op, before=None, after=None):
    return json.dumps({"schema": {}, "payload": {
        "before": before, "after": after, "op": op, "source": {"lsn": 1}, "ts_ms": 1,
    }})


def put(offset, key, v, op="u", topic=TOPIC, partition=0):
    return [(topic, partition, offset, key, envelope(op, after={"id": key, "v": v}))]


def drop(offset, key, topic=TOPIC, partition=0, tombstone=True):
    out = [(topic, partition, offset, key, envelope("d", before={"id": key, "v": "old"}))]
    return out + ([(topic, partition, offset + 1, key, None)] if tombstone else [])


def log_of(spark, *groups):
    rows = [
        (t, p, o, None if k is None else json.dumps({"schema": {}, "payload": {"id": k}}), v)
        for group in groups for t, p, o, k, v in group
    ]
    df = spark.createDataFrame(
        rows, "topic string, partition int, offset bigint, key string, value string"
    )
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset") * 60)
    return df.withColumn("timestamp", stamp).select(
        "topic", "partition", "offset", "timestamp", "key", "value"
    )


def as_set(df):
    return {tuple(r) for r in df.collect()}


def base_of(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def state_after(spark, base, *groups, **how):
    events = events_of(log_of(spark, *groups), "a", ROW, KEY)
    return as_set(apply_changes(base, events, ["id"], **how))


# -- scoping, routing ----------------------------------------------------------


def test_scope_and_routing(spark):
    names = ["cdc-a.public.t", "cdc-a.cdc.debezium_heartbeat", "cdc-a.cdc.debezium_heartbeat2",
             "cdc-ab.public.t", "cdc-a.x.__debezium_y", "cdc-a.meta.m"]
    log = spark.createDataFrame([(n,) for n in names], "topic string")
    assert as_set(L.instance_scope(log, "a", ["meta"])) == {
        ("cdc-a.public.t",), ("cdc-a.cdc.debezium_heartbeat2",)
    }
    topics = spark.createDataFrame(
        [("cdc.public.t",), ("cdc-a.sales.o.p",), ("other.public.t",)], "topic string"
    )
    routed = topics.select(L.route_topic("topic"), L.topic_schema("topic"))
    assert as_set(routed) == {("t", "public"), ("o.p", "sales"), ("other.public.t", None)}


def test_parse_and_unwrap(spark):
    log = log_of(spark, put(0, 1, "a", "c"), drop(1, 1), put(3, 2, "b", "r"))
    events = L.parse_envelope(log, ROW, KEY)
    assert [r.tombstone for r in events.orderBy("offset").collect()] == [False, False, True, False]
    flat = L.unwrap(events).select("table", "schema", "id", "v", "_deleted", "offset")
    assert as_set(flat) == {
        ("t", "public", 1, "a", False, 0), ("t", "public", 1, None, True, 1),
        ("t", "public", 2, "b", False, 3),
    }


def test_keys_without_wrapper(spark):
    log = log_of(spark, put(0, 1, "a")).withColumn("key", F.lit('{"id": 5}'))
    assert L.unwrap(L.parse_envelope(log, ROW, KEY)).first().id == 5


def test_unknown_fields_and_garbage_fail(spark):
    extra = [(TOPIC, 0, 0, 1, envelope("c", after={"id": 1, "v": "a", "new": 2}))]
    with pytest.raises(Exception, match="unknown to the target"):
        L.unwrap(L.parse_envelope(log_of(spark, extra), ROW, KEY)).collect()
    assert L.unwrap(L.parse_envelope(log_of(spark, extra), ROW, KEY), False).count() == 1
    garbage = [(TOPIC, 0, 0, 1, "not json")]
    with pytest.raises(Exception, match="not an envelope"):
        L.unwrap(L.parse_envelope(log_of(spark, garbage), ROW, KEY)).collect()
    wrong = [(TOPIC, 0, 0, 1, envelope("c", after={"id": "x", "v": "a"}))]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        L.parse_envelope(log_of(spark, wrong), ROW, KEY).select("after").collect()


def test_op_counts_follow_tombstones(spark):
    log = log_of(spark, put(0, 1, "a", "c"), put(1, 1, "b"), drop(2, 1), put(4, 2, "b", "r"),
                 put(0, 9, "z", "c", "cdc-a.public.u"), drop(5, 3, tombstone=False))
    rows = as_set(L.op_counts(log))
    assert ("public.t", 1, 1, 1, 2, 1, 6) in rows and ("public.u", 1, 0, 0, 0, 0, 1) in rows
    assert ("TOTAL", 2, 1, 1, 2, 1, 7) in rows
    assert as_set(L.topic_totals(log)) == {("public.t", 6), ("public.u", 1), ("TOTAL", 7)}


def test_gaps_inside_and_across_blocks(spark):
    offsets = [3, 4, 4, 7, 8, 31, 40, 63, 64, 200]
    log = log_of(spark, *[put(o, 1, "a") for o in offsets])
    want = {(5, 6), (9, 30), (32, 39), (41, 62), (65, 199)}
    for block in (2, 8, 64, 1 << 20):
        found = L.offset_gaps(log, block).select("gap_start", "gap_end")
        assert as_set(found) == want, block
    row = L.log_completeness(log).first()
    assert (row.first_offset, row.last_offset, row.records, row.missing) == (3, 200, 9, 189)


def test_retention_guard(spark):
    log = log_of(spark, put(0, 1, "a"), put(1, 1, "b"), put(5, 1, "c", topic="cdc-a.public.late"))
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000 + s))
    found = {r.topic: r for r in L.retention_guard(log, at(0), at(3600)).collect()}
    assert found[TOPIC].safe and not found["cdc-a.public.late"].safe
    assert found["cdc-a.public.late"].starts_late
    late = L.retention_guard(log, at(0), at(168 * 3600 + 1)).collect()
    assert all(r.window_exceeded and not r.safe for r in late)
    assert readiness(log, "a", at(0), at(1)).first().verdict == "UNSAFE"
    assert readiness(log, "a", at(300), at(400)).first().verdict == "READY"
    assert readiness(log, "nobody", at(300), at(400)).first().verdict == "UNSAFE"


def test_consumer_lag(spark):
    end = spark.createDataFrame([("t", 0, 10), ("t", 1, 5)],
                                "topic string, partition int, end_offset bigint")
    committed = spark.createDataFrame(
        [("g", "t", 0, "4"), ("g", "t", 1, "-"), ("h", "t", 0, "12"), ("h", "t", 1, "5")],
        "group string, topic string, partition int, committed_offset string",
    )
    assert as_set(L.consumer_lag(end, committed)) == {
        ("g", 6, 1, "behind"), ("h", 0, 0, "caught_up")
    }
    assert as_set(L.lagging_partitions(end, committed)) == {("g", "t", 0, 6)}


def test_heartbeat(spark):
    log = log_of(spark, put(0, 1, "x", topic="cdc-a.cdc.debezium_heartbeat"))
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000 + s))
    assert as_set(L.heartbeat_age(log, at(60))) == {(60, "OK")}
    assert as_set(L.heartbeat_age(log, at(61), instance="a")) == {(61, "WARN")}
    assert as_set(L.heartbeat_age(log, at(61), instance="b")) == {(None, "WARN")}


# -- replay --------------------------------------------------------------------


def test_replay_rules(spark):
    base = base_of(spark, (1, "one"), (2, "two"), (3, "three"))
    got = state_after(
        spark, base, put(0, 2, "TWO"), drop(1, 3), put(3, 4, "four", "c"), put(4, 4, "FOUR"),
        drop(5, 5), put(7, 5, "back", "c"), drop(8, 9),
    )
    assert got == {(1, "one"), (2, "TWO"), (4, "FOUR"), (5, "back")}


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_replay_by_stored_last_events(spark, broadcast_rows):
    got = state_after(spark, base_of(spark, (1, "a"), (2, "b"), (3, "c")), put(0, 1, "x"),
                      drop(1, 2), put(3, 9, "new", "c"), broadcast_rows=broadcast_rows)
    assert got == {(1, "x"), (3, "c"), (9, "new")}


def test_replay_order_is_the_offset_not_arrival(spark):
    assert state_after(spark, base_of(spark, (1, "a")), put(9, 1, "last"), put(2, 1, "first")) == {
        (1, "last")
    }


def test_replaying_twice_changes_nothing(spark):
    base = base_of(spark, (1, "a"), (2, "b"))
    events = events_of(log_of(spark, put(0, 1, "x"), drop(1, 2), put(3, 3, "c")), "a", ROW, KEY)
    once = apply_changes(base, events, ["id"])
    assert as_set(apply_changes(once, events, ["id"])) == as_set(once) == {(1, "x"), (3, "c")}
    assert as_set(apply_changes(base, events.where("false"), ["id"])) == as_set(base)
    check = verify_replay(once, once, ["id"]).first()
    assert (check.state_rows, check.source_rows, check.verdict) == (2, 2, "VERIFIED")
    assert verify_replay(once, base, ["id"]).first().verdict == "DIFF"


def test_lone_tombstone_is_not_a_delete(spark):
    lone = [(TOPIC, 0, 0, 1, None)]
    assert state_after(spark, base_of(spark, (1, "a")), lone) == {(1, "a")}


def test_record_without_key(spark):
    keyless = [(TOPIC, 0, 0, None, envelope("c", after={"id": 7, "v": "x"}))]
    with pytest.raises(Exception, match="without a usable key"):
        state_after(spark, base_of(spark, (1, "a")), keyless)
    assert state_after(spark, base_of(spark, (1, "a")), keyless, on_error="continue") == {(1, "a")}


def test_unknown_column_is_refused(spark):
    events = events_of(log_of(spark, put(0, 1, "x")), "a", ROW, KEY).withColumn("n", F.lit(1))
    with pytest.raises(ValueError, match="unknown to the target"):
        apply_changes(base_of(spark, (1, "a")), events, ["id"])


def test_one_key_changed_most_of_the_time(spark):
    hot = spark.range(90_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("id"),
        F.col("id").cast("string").alias("v"), F.lit(False).alias("_deleted"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
    )
    last = latest_per_key(hot, ["id"])
    assert last.count() == 30_001
    assert last.where("id = 1").first().v == "89999"


def test_catch_up_starts_behind_the_snapshot(spark):
    base = base_of(spark, (1, "at 5"))
    log = log_of(spark, put(3, 1, "old"), put(5, 1, "at 5"), put(6, 2, "new"),
                 put(0, 8, "u", topic="cdc-a.public.u"))
    got = copy_and_catch_up(base, log.where(F.col("topic") == TOPIC), "a", ["id"], ROW, KEY,
                            {(TOPIC, 0): 5})
    assert as_set(got) == {(1, "at 5"), (2, "new")}
    assert as_set(copy_and_catch_up(base, log, "a", [], ROW, KEY, {})) == as_set(base)
    kept = L.after_positions(log, {(TOPIC, 0): 5}).select("topic", "offset")
    assert as_set(kept) == {(TOPIC, 6), ("cdc-a.public.u", 0)}


# -- streams -------------------------------------------------------------------


def write_files(log, path, parts):
    for i, part in enumerate(parts):
        log.where(part).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, per_trigger=1):
    return read_change_log(spark, path, streaming=True, max_files_per_trigger=per_trigger)


def unwrapped(log):
    return L.unwrap(L.parse_envelope(log, ROW, KEY)).drop("table", "schema")


def replay_files(spark, source, tmp_path, name="cp", **how):
    events = unwrapped(stream(spark, source))
    query = upsert_stream(events, ["id"], ROW, str(tmp_path / "state"), str(tmp_path / name), name, **how)
    query.awaitTermination()
    return query


def batches(tmp_path):
    return sorted(p.parent.name + "/" + p.name for p in (tmp_path / "state/changes").glob("*/batch=*"))


def test_stream_equals_batch_in_any_file_order(spark, tmp_path):
    groups = [put(0, 1, "a", "c"), put(1, 2, "b", "c"), drop(2, 1), put(4, 3, "c", "c"),
              put(5, 2, "B"), put(6, 1, "again", "c"), drop(7, 3), put(9, 4, "d", "c")]
    log = log_of(spark, *groups)
    base = base_of(spark, (2, "base"), (8, "untouched"))
    want = as_set(apply_changes(base, events_of(log, "a", ROW, KEY), ["id"]))
    source, state = str(tmp_path / "log"), str(tmp_path / "state")
    # Newest offsets arrive first.
    write_files(log, source, ["offset >= 6", "offset BETWEEN 3 AND 5", "offset < 3"])
    assert progress_of(replay_files(spark, source, tmp_path))["error"] is None
    assert as_set(upserted(base, ["id"], state)) == want
    assert len(batches(tmp_path)) == 3
    # Nothing new: a restart adds nothing. A second pass under another name changes nothing.
    replay_files(spark, source, tmp_path)
    assert len(batches(tmp_path)) == 3
    replay_files(spark, source, tmp_path, "cp2")
    assert as_set(upserted(base, ["id"], state)) == want and len(batches(tmp_path)) == 6
    for limit in (None, 0):
        assert as_set(upserted(base, ["id"], state, broadcast_rows=limit)) == want
    assert as_set(compact(base, ["id"], state, str(tmp_path / "next"))) == want


def test_paused_stream_resumes(spark, tmp_path):
    source, log = str(tmp_path / "log"), log_of(spark, put(0, 1, "a"), put(1, 1, "b"), drop(2, 1))
    for part, want in (("offset = 0", {(1, "a")}), ("offset = 1", {(1, "b")}), ("offset > 1", set())):
        write_files(log, source, [part])
        replay_files(spark, source, tmp_path)
        assert as_set(upserted(spark.createDataFrame([], ROW), ["id"], str(tmp_path / "state"))) == want


def events_frame(spark, *rows):
    return spark.createDataFrame(
        list(rows), "id bigint, v string, _deleted boolean, partition int, offset bigint"
    )


def test_repeated_batch_replaces_itself(spark, tmp_path):
    base, path = base_of(spark, (1, "a")), str(tmp_path / "s")
    batch = events_frame(spark, (1, "b", False, 0, 1), (2, "c", False, 0, 2))
    append_batch(events_frame(spark, (7, "half", False, 0, 9)), ["id"], ROW, path, "w", 0)
    append_batch(batch, ["id"], ROW, path, "w", 0)
    append_batch(batch, ["id"], ROW, path, "w", 0)
    assert stored_changes(base, path).count() == 2
    assert as_set(upserted(base, ["id"], path)) == {(1, "b"), (2, "c")}


def test_deletes_stay_deleted_and_batches_keep_one_image_a_key(spark, tmp_path):
    base, path, want = base_of(spark, (99, "base")), str(tmp_path / "s"), {99: "base"}
    for i in range(6):
        rows = [(k, f"v{i}", False, 0, i * 10 + k) for k in range(6) if (k + i) % 3]
        rows.append((i % 6, None, True, 0, i * 10 + 9))
        for k, v, gone, _, _ in rows:
            want.pop(k, None) if gone else want.__setitem__(k, v)
        append_batch(events_frame(spark, *rows, *rows), ["id"], ROW, path, "w", i)
    append_batch(events_frame(spark, (5, "stale", False, 0, 0)), ["id"], ROW, path, "w", 99)
    assert as_set(upserted(base, ["id"], path)) == set(want.items())
    stored = stored_changes(base, path)
    assert stored.count() == sum(len({r for r in range(6) if (r + i) % 3} | {i % 6}) for i in range(6)) + 1


def test_stream_refuses_new_columns_and_lost_keys(spark, tmp_path):
    path = str(tmp_path / "s")
    good = events_frame(spark, (1, "a", False, 0, 0))
    with pytest.raises(ValueError, match="unknown to the target"):
        append_batch(good.withColumn("new", F.lit(1)), ["id"], ROW, path, "w", 0)
    keyless = events_frame(spark, (None, "a", False, 0, 0), (2, "b", False, 0, 1))
    with pytest.raises(Exception, match="without a usable key"):
        append_batch(keyless, ["id"], ROW, path, "w", 0)
    append_batch(keyless, ["id"], ROW, path, "w", 0, on_error="continue")
    base = base_of(spark, (1, "x"))
    assert as_set(upserted(base, ["id"], path)) == {(1, "x"), (2, "b")}
    assert as_set(spark.read.parquet(f"{path}/rejects/stream=w/batch=0")) == {(None, "a", False, 0, 0)}
    assert as_set(replay_rejects(keyless, ["id"])) == {(None, "a", False, 0, 0)}


def test_no_record_is_too_late_by_default(spark, tmp_path):
    log = log_of(spark, *[put(i, i, "x", "c") for i in range(180)])
    source = str(tmp_path / "log")
    write_files(log, source, ["offset >= 120", "offset BETWEEN 60 AND 119", "offset < 60"])
    counts = op_counts_by_window(stream(spark, source), "10 minutes")
    keep_updates(counts, str(tmp_path / "rows"), str(tmp_path / "c")).awaitTermination()
    got = latest_updates(spark.read.parquet(str(tmp_path / "rows")), ["table", "window_start"])
    assert as_set(got) == as_set(op_counts_by_window(log, "10 minutes"))
    assert late_records(log, 1).count() == 119 and late_records(log, 168).count() == 0


def test_stream_dedupe_and_window_counts(spark, tmp_path):
    log = log_of(spark, *[put(i, i, "x", "c" if i % 2 else "u") for i in range(90)], drop(90, 1))
    source = str(tmp_path / "log")
    write_files(log, source, ["offset < 40", "offset BETWEEN 30 AND 95"])
    unique = dedupe_stream(stream(spark, source))
    out = unique.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c1"))
    out.trigger(availableNow=True).start(str(tmp_path / "unique")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "unique"))
    assert found.count() == 92 == found.select("offset").distinct().count()

    plain = str(tmp_path / "plain")
    write_files(log, plain, ["offset < 40", "offset >= 40"])
    counts = op_counts_by_window(stream(spark, plain), "10 minutes", "1 day")
    keep_updates(counts, str(tmp_path / "rows"), str(tmp_path / "c2")).awaitTermination()
    got = latest_updates(spark.read.parquet(str(tmp_path / "rows")), ["table", "window_start"])
    assert as_set(got) == as_set(op_counts_by_window(log, "10 minutes"))
