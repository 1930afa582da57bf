"""Folding, resuming and many tables, on small logs."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from tests.test_changelog import KEY, ROW, as_set, base_of, drop, log_of, put
from twinledger.operators import changelog as L
from twinledger.operators.replay import apply_changes
from twinledger.plans.many_tables import TableSpec, replay_all_tables, state_of_table, upsert_all_tables
from twinledger.queries import capture_queries as C
from twinledger.queries import inputs as I
from twinledger.queries import log_queries as Q
from twinledger.sources.tables import read_change_log
from twinledger.streaming import jobs as J


def events(spark, *groups):
    return L.unwrap(L.parse_envelope(log_of(spark, *groups), ROW, KEY))


def files_of(df):
    return len(df.inputFiles())


def test_fold_keeps_the_state_and_drops_batches(spark, tmp_path):
    path, base = f"file://{tmp_path}/state", base_of(spark, (1, "a"), (2, "b"), (9, "i"))
    J.append_batch(events(spark, put(5, 1, "five"), drop(6, 2)), ["id"], ROW, path, "s", 0)
    J.append_batch(events(spark, put(9, 3, "c")), ["id"], ROW, path, "s", 1)
    want = {(1, "five"), (9, "i"), (3, "c")}
    assert as_set(J.upserted(base, ["id"], path)) == want
    assert J.fold(base, ["id"], path) == 0
    assert as_set(J.upserted(base, ["id"], path)) == want
    assert files_of(J.stored_changes(base, path)) == 0  # nothing is read again
    # late records from before the fold change nothing, not even deleted rows
    J.append_batch(events(spark, put(2, 2, "late"), put(3, 1, "late"), put(12, 9, "new")), ["id"], ROW, path, "late", 0)
    want = {(1, "five"), (9, "new"), (3, "c")}
    assert as_set(J.upserted(base, ["id"], path)) == want
    assert J.fold(base, ["id"], path) == 1 and J.fold(base, ["id"], path) == 1
    assert as_set(J.upserted(base, ["id"], path)) == want
    assert J.folded(spark, path) == (1, {"s": 1, "late": 0})
    for batch in range(2, 6):
        J.append_batch(events(spark, put(20 + batch, 1, f"v{batch}")), ["id"], ROW, path, "s", batch)
        J.fold(base, ["id"], path)
        assert len(J._batches(spark, path)) == 0
    assert (1, "v5") in as_set(J.upserted(base, ["id"], path))


def test_a_fold_that_did_not_end_does_not_count(spark, tmp_path):
    path, base = f"file://{tmp_path}/state", base_of(spark, (1, "a"))
    J.append_batch(events(spark, put(5, 1, "five")), ["id"], ROW, path, "s", 0)
    base.withColumn("_deleted", F.lit(False)).write.parquet(f"{path}/base/fold=0")  # written, but no positions
    assert as_set(J.upserted(base, ["id"], path)) == {(1, "five")}
    assert J.fold(base, ["id"], path) == 0
    assert as_set(J.upserted(base, ["id"], path)) == {(1, "five")}


def stored(spark, tmp_path, log, files=3):
    log.repartition(files, "offset").write.parquet(f"file://{tmp_path}/log")
    return read_change_log(spark, f"file://{tmp_path}/log", L.topic_regex("a"), streaming=True, max_files_per_trigger=1)


def test_a_failed_batch_is_repeated_in_its_place(spark, tmp_path):
    log = log_of(spark, *[put(i, i % 5, f"v{i}") for i in range(30)])
    stream = L.unwrap(L.parse_envelope(stored(spark, tmp_path, log), ROW, KEY))
    path, left = f"file://{tmp_path}/state", [1, 1]
    monitor = J.ReplayMonitor()
    spark.streams.addListener(monitor)

    def fail(batch_id):
        if left and batch_id == 1:
            left.pop()
            raise RuntimeError("lost")

    def start():
        return J.upsert_stream(stream, ["id"], ROW, path, f"{path}/cp", after_batch=fail)

    try:
        errors = J.run_to_end(start)
        assert len(errors) == 3 and errors[-1] is None and errors[0]
        left += [1, 1, 1]
        with pytest.raises(Exception):
            J.run_to_end(lambda: J.upsert_stream(stream, ["id"], ROW, f"{path}2", f"{path}2/cp", after_batch=fail), attempts=2)
    finally:
        spark.streams.removeListener(monitor)
    assert as_set(J.upserted(base_of(spark), ["id"], path)) == {(k, f"v{25 + k}") for k in range(5)}
    done = J.replay_progress(L.log_end(log), J.replayed_to(spark, path, "a")).first()
    assert done["done"] and done["total_lag"] == 0


def record(schema, name, offset, key, op="u", **after):
    value = None if op is None else json.dumps({"schema": {}, "payload": {
        "before": None, "after": None if op == "d" else {"id": key, **after}, "op": op, "source": {"lsn": 1}, "ts_ms": 1}})
    return (f"cdc-a.{schema}.{name}", 0, offset, json.dumps({"id": key}), value)


TABLES = {("x", "t"): TableSpec("id bigint, n int", "id bigint"), ("y", "t"): TableSpec("id bigint, v string", "id bigint")}


def many(spark, *rows):
    df = spark.createDataFrame(list(rows), "topic string, partition int, offset bigint, key string, value string")
    return df.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000))).select(
        "topic", "partition", "offset", "timestamp", "key", "value")


def test_tables_of_one_name_and_other_columns(spark, tmp_path):
    log = many(spark, record("x", "t", 0, 1, n=5), record("y", "t", 0, 1, v="a"), record("y", "t", 1, 2, v="b"),
               record("y", "t", 2, 1, "d"), record("y", "t", 3, 1, None), record("x", "t", 1, 7, n=8))
    base = spark.createDataFrame([(9, 1)], "id bigint, n int")
    states = replay_all_tables({("x", "t"): base}, log, "a", TABLES)
    assert as_set(states["x", "t"]) == {(9, 1), (1, 5), (7, 8)} and as_set(states["y", "t"]) == {(2, "b")}
    path = f"file://{tmp_path}/many"
    upsert_all_tables(stored(spark, tmp_path, log), "a", TABLES, path, f"{path}/cp").awaitTermination()
    for name, spec in TABLES.items():
        start = base if name == ("x", "t") else spark.createDataFrame([], spec.row)
        assert as_set(state_of_table(start, name, spec, path)) == as_set(states[name])


def test_records_of_other_tables(spark):
    log = many(spark, record("x", "t", 0, 1, n=5), record("z", "u", 0, 1, v="a"))
    with pytest.raises(ValueError, match="z.u"):
        replay_all_tables({}, log, "a", TABLES)
    assert as_set(replay_all_tables({}, log, "a", TABLES, unknown="skip")["x", "t"]) == {(1, 5)}
    assert as_set(replay_all_tables({}, log, "a", TABLES, exclude_schemas=["z"])["y", "t"]) == set()


def test_heartbeats_close_the_windows_of_idle_tables(spark, tmp_path):
    columns = "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
    body = '{"payload": {"op": "%s"}}'
    data, beat, other = "cdc-demo.public.t", "cdc-demo.cdc.debezium_heartbeat", "cdc-demo.public.u"

    def put_file(rows):
        made = [(t, 0, i, datetime.datetime.fromisoformat(f"2024-01-01 {at}"), "{}", v) for i, (t, at, v) in enumerate(rows)]
        spark.createDataFrame(made, columns).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/log")

    def closed(name):
        log = read_change_log(spark, f"file://{tmp_path}/log", streaming=True, max_files_per_trigger=1)
        windows = J.op_counts_closed_windows(log, "1 hour", "10 minutes", "demo")
        J.append_closed(windows, f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}-cp").awaitTermination()
        rows = spark.read.schema(windows.schema).parquet(f"file://{tmp_path}/{name}").collect()
        return sorted((r.table, r.window_start.hour, r.inserts, r.updates, r.deletes, r.total) for r in rows)

    put_file([(data, "01:05:00", body % "c"), (data, "01:06:00", body % "d"), (data, "01:06:00", None),
              (other, "02:01:00", body % "u")])
    first = closed("rows")
    assert [r[1] for r in first] == []
    put_file([(beat, "02:30:00", body % "u")])
    assert [r[1:] for r in closed("rows")] == [(1, 1, 0, 1, 3)]
    put_file([(beat, "03:09:00", body % "u")])
    assert len(closed("rows")) == 1  # 03:09 less ten minutes is before 03:00
    put_file([(beat, "03:10:00", body % "u"), (beat, "03:11:00", body % "u")])
    assert [r[1:] for r in closed("rows")] == [(1, 1, 0, 1, 3), (2, 0, 1, 0, 1)]
    assert [r[1:] for r in closed("rows")] == [(1, 1, 0, 1, 3), (2, 0, 1, 0, 1)]  # each window once
    with pytest.raises(ValueError, match="stream"):
        J.op_counts_closed_windows(spark.createDataFrame([], columns), "1 hour", "1 hour", "demo")


def test_a_batch_is_parsed_once(spark, tmp_path):
    rows = [(1, "a", "public", "t", False, 0, 0), (2, "b", "public", "t", False, 0, 1), (1, "c", "public", "t", False, 0, 2)]
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    columns = "id bigint, v string, schema string, table string, _deleted boolean, partition int, offset bigint"
    batch = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), columns)
    J.append_batch(batch, ["id"], ROW, f"file://{tmp_path}/state", "s", 0)
    assert seen.value == len(rows)  # images and progress are both written from one reading
    assert as_set(J.upserted(base_of(spark), ["id"], f"file://{tmp_path}/state")) == {(1, "c"), (2, "b")}
    done = spark.read.parquet(f"file://{tmp_path}/state/progress/*/*").first()
    assert (done["end"], done["events"]) == (3, 3)
    kept = events(spark, put(5, 1, "x")).cache()
    J.append_batch(kept, ["id"], ROW, f"file://{tmp_path}/state", "s", 1)
    assert kept.storageLevel.useMemory  # what the caller keeps stays kept
    kept.unpersist()


def test_a_batch_in_work_is_not_cut_off(spark, tmp_path):
    log = log_of(spark, *[put(i, i % 5, f"v{i}") for i in range(9)])
    stream = L.unwrap(L.parse_envelope(stored(spark, tmp_path, log), ROW, KEY))
    path = f"file://{tmp_path}/state"
    query = J.upsert_stream(stream, ["id"], ROW, path, f"{path}/cp", once=False, after_batch=lambda _: time.sleep(6))
    J.run_until(query, 1, seconds=4)  # the batch takes longer
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 1
    assert not query.isActive


def test_files_and_batches_of_a_log_grow_with_it():
    assert (I.log_files(0), I.log_files(100_000), I.files_per_batch(6)) == (6, 6, 2)
    for rows in (600_000, 6_000_000, 36_000_000):
        files = I.log_files(rows)
        assert files * I.ROWS_PER_FILE >= rows and I.files_per_batch(files) <= I.FILES_PER_BATCH


def test_changes_are_dealt_to_all_tasks_before_their_records_are_made(spark, sf):
    plan = I.change_log(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")


def test_verify_replay_reads_each_record_once(spark, sf, monkeypatch):
    logs = []

    def counted(*args):
        logs.append(I.change_log(*args))
        return logs[-1]

    monkeypatch.setattr(Q, "change_log", counted)
    assert Q.verify_replay_query(spark, sf).first()["verdict"] == "DIFF"
    assert sum(log.count() for log in logs) == I.change_log(spark, sf).count()


def test_repeated_records_are_parsed_once_for_both_replays(spark, sf, monkeypatch):
    replayed = []

    def noted(base, found, keys):
        replayed.append(found._jdf.queryExecution().optimizedPlan().toString())
        return apply_changes(base, found, keys)

    monkeypatch.setattr(Q, "apply_changes", noted)
    Q.apply_changes_repeated_query(spark, sf)
    assert len(replayed) == 2 and not any("from_json" in plan for plan in replayed)


def test_the_log_of_many_tables_grows_in_files(spark, sf, monkeypatch):
    monkeypatch.setattr(I, "ROWS_PER_FILE", 400)
    seen = []

    def noted(spark, path, *args, **options):
        seen.append((len(spark.read.parquet(path).inputFiles()), options["max_files_per_trigger"]))
        raise InterruptedError

    monkeypatch.setattr(C, "read_change_log", noted)
    with pytest.raises(InterruptedError):
        C.replay_all_tables_stream_query(spark, sf)
    rows = sum(I.table(spark, sf, t).count() for t in ("orders", "orders", "customer", "events"))
    (files, per_batch), = seen
    assert files >= rows // 400 > 6 and per_batch == -(-files // 2)


def test_the_compacted_sink_is_folded_after_both_halves(spark, sf, tmp_path, monkeypatch):
    path, folds, place = f"file://{tmp_path}/state", [], Q.scratch_path
    monkeypatch.setattr(Q, "scratch_path", lambda spark, label: path if label == "state" else place(spark, label))

    def noted(base, keys, path):
        late = J._batches(spark, path)
        folds.append((J.fold(base, keys, path), {stream for stream, _, _ in late}))
        return folds[-1][0]

    monkeypatch.setattr(Q, "fold", noted)
    state = Q.upsert_sink_compacted_query(spark, sf)
    assert folds == [(0, {"replay-0"}), (1, {"replay-1"})]
    number, last = J.folded(spark, path)
    assert number == 1 and set(last) == {"replay-0", "replay-1"} and J._batches(spark, path) == []
    assert J._folders(spark, f"{path}/base") == ["fold=1"]
    assert state.count() == I.shown_state(apply_changes(spark.createDataFrame([], Q.STATE_SCHEMA), Q.events_of(
        I.change_log(spark, sf), I.INSTANCE, I.ROW_SCHEMA, I.KEY_SCHEMA), Q.STATE_KEYS)).count()
