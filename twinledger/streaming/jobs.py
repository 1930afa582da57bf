"""Streaming jobs over a change log."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from twinledger.functions.tokens import quoted
from twinledger.operators.changelog import (
    RETENTION_HOURS,
    consumer_lag,
    is_tombstone,
    require_keys,
    route_topic,
    split_keyless,
    topic_regex,
)
from twinledger.operators.diff import BROADCAST_ROWS
from twinledger.operators.replay import apply_changes, latest_per_key, require_known_columns
from twinledger.session import delete


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


_CONTROL = "_deleted boolean, partition int, offset bigint"


def append_batch(
    events: DataFrame, keys: Sequence[str], schema: T.StructType | str, path: str, stream: str,
    batch_id: int, on_error: str = "fail",
) -> None:
    """Keep the last image of every key one batch touched, as ``path/changes/stream=/batch=``.

    The cost follows the batch: its events are kept while they are written, so each is read and parsed once.
    A batch that is repeated replaces its own folder. With ``on_error='continue'`` records without a key are
    kept below ``path/rejects``.
    """
    row = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    require_known_columns(events, row.names)
    if events.storageLevel != StorageLevel.NONE:
        _append_kept(events, keys, row, path, f"stream={stream}/batch={batch_id}", on_error)
        return
    kept = events.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _append_kept(kept, keys, row, path, f"stream={stream}/batch={batch_id}", on_error)
    finally:
        kept.unpersist()


def _append_kept(
    events: DataFrame, keys: Sequence[str], row: T.StructType, path: str, place: str, on_error: str
) -> None:
    if on_error == "continue":
        usable, rejects = split_keyless(events, keys)
        rejects.write.mode("overwrite").parquet(f"{path}/rejects/{place}")
    else:
        usable = require_keys(events, keys)
    images = usable.select(
        *[quoted(f.name).cast(f.dataType).alias(f.name) for f in row.fields],
        "_deleted", F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
    )
    latest_per_key(images, keys).write.mode("overwrite").parquet(f"{path}/changes/{place}")
    if {"schema", "table"} <= set(events.columns):
        # a delete is followed by its tombstone, which is not an event
        end = F.col("offset") + 1 + F.col("_deleted").cast("bigint")
        seen = events.groupBy("schema", "table", "partition").agg(F.max(end).alias("end"), F.count("*").alias("events"))
        seen.write.mode("overwrite").parquet(f"{path}/progress/{place}")


def replayed_to(spark: SparkSession, path: str, instance: str, group: str = "replay") -> DataFrame:
    """``(group, topic, partition, committed_offset)`` of what is stored below ``path``, as ``consumer_lag``
    takes it: the offset behind the last event of each log partition."""
    stored = "schema string, table string, partition int, end bigint, events bigint"
    topic = F.concat(F.lit(f"cdc-{instance}."), "schema", F.lit("."), "table")
    if not _folders(spark, f"{path}/progress"):
        found = spark.createDataFrame([], stored)
    else:
        found = spark.read.schema(stored).parquet(f"{path}/progress/*/*")
    return found.groupBy(F.lit(group).alias("group"), topic.alias("topic"), "partition").agg(
        F.max("end").cast("string").alias("committed_offset"))


def upsert_stream(
    events: DataFrame,
    keys: Sequence[str],
    schema: T.StructType | str,
    path: str,
    checkpoint: str,
    stream: str = "replay",
    once: bool = True,
    on_error: str = "fail",
    where: Column | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Append the changes of a stream of unwrapped events below ``path``, batch by batch.

    A restart on the same checkpoint repeats an unfinished batch in its place. Another checkpoint
    needs another ``stream`` name. Stopping the query and starting it again pauses and resumes. ``after_batch``
    is called with the number of each stored batch; if it fails, the batch is repeated on a restart.
    """
    chosen = events if where is None else events.where(where)

    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, keys, schema, path, stream, batch_id, on_error)
        if after_batch is not None:
            after_batch(batch_id)

    return _start(chosen.writeStream.foreachBatch(append), checkpoint, once)


def _stored(base: DataFrame) -> T.StructType:
    row = T.StructType([T.StructField(f.name, f.dataType) for f in base.schema.fields])
    return T.StructType(row.fields + T.StructType.fromDDL(_CONTROL).fields)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none if there is no such path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(place) if f.isDirectory()) if fs.exists(place) else []


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def folded(spark: SparkSession, path: str) -> tuple[int | None, dict[str, int]]:
    """Number of the newest complete fold below ``path`` and the last batch of each stream that is in it."""
    folds = [_number(f) for f in _folders(spark, f"{path}/positions") if _done(spark, f"{path}/positions/{f}")]
    if not folds:
        return None, {}
    rows = spark.read.schema("stream string, batch bigint, partition int, offset bigint").parquet(
        f"{path}/positions/fold={max(folds)}").where("stream IS NOT NULL").groupBy("stream").agg(F.max("batch").alias("batch")).collect()
    return max(folds), {r["stream"]: r["batch"] for r in rows}


def _done(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _batches(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """``(stream, batch, folder)`` of all complete batches."""
    found = []
    for stream in _folders(spark, f"{path}/changes"):
        for batch in _folders(spark, f"{path}/changes/{stream}"):
            folder = f"{path}/changes/{stream}/{batch}"
            if _done(spark, folder):
                found.append((stream.split("=", 1)[1], _number(batch), folder))
    return found


def stored_changes(base: DataFrame, path: str) -> DataFrame:
    """The appended changes that count on top of ``folded_base``, with the columns of ``base``."""
    spark = base.sparkSession
    _, last = folded(spark, path)
    behind = [folder for stream, batch, folder in _batches(spark, path) if batch > last.get(stream, -1)]
    if not behind:
        return spark.createDataFrame([], _stored(base))
    return spark.read.schema(_stored(base)).parquet(*behind)


def folded_base(base: DataFrame, path: str) -> DataFrame | None:
    """State of the newest fold with the position of each row's last change; deleted keys are kept
    as ``_deleted`` rows, so a change from before the fold that comes late does not bring them back."""
    spark = base.sparkSession
    fold, _ = folded(spark, path)
    return None if fold is None else spark.read.schema(_stored(base)).parquet(f"{path}/base/fold={fold}")


def upserted(
    base: DataFrame, keys: Sequence[str], path: str, broadcast_rows: int | None = BROADCAST_ROWS
) -> DataFrame:
    """``base`` with all changes appended below ``path``; of each key the last in log order counts,
    in whatever order the batches came. ``base`` may be an empty frame of the right schema.

    After ``fold`` the folded base is read instead of ``base``, and only the batches behind it.
    """
    state = folded_base(base, path)
    changes = stored_changes(base, path)
    if state is None:
        return apply_changes(base, changes, keys, broadcast_rows=broadcast_rows)
    return _merged(state, changes, keys).where(~F.col("_deleted")).select(*[quoted(c) for c in base.columns])


def _merged(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last image of every key; a row that was never changed is older than any change."""
    return latest_per_key(state.unionByName(changes), keys)


def fold(base: DataFrame, keys: Sequence[str], path: str) -> int:
    """Merge all complete batches into a new base below ``path`` and drop them; returns the fold's number.

    The new base holds, for each row, the position of its last change. Beside it a table of
    positions is written: per stream the last batch, and per log partition the last offset. That table
    makes the fold count; what fails before leaves the old state, what fails after only leaves folders
    that are no longer read and go with the next fold. One fold runs at a time; streams may go on.
    """
    spark = base.sparkSession
    before, last = folded(spark, path)
    new = [b for b in _batches(spark, path) if b[1] > last.get(b[0], -1)]
    number = 0 if before is None else before + 1
    if before is not None and not new:
        return before
    unchanged = base.select("*", F.lit(False).alias("_deleted"), F.lit(None).cast("int").alias("partition"),
                            F.lit(None).cast("bigint").alias("offset"))
    state = unchanged if before is None else folded_base(base, path)
    changes = stored_changes(base, path) if not new else spark.read.schema(_stored(base)).parquet(*[b[2] for b in new])
    target = f"{path}/base/fold={number}"
    _merged(state, changes, keys).write.mode("overwrite").parquet(target)
    ends = dict(last)
    for stream, batch, _ in new:
        ends[stream] = max(batch, ends.get(stream, -1))
    streams = spark.createDataFrame(list(ends.items()), "stream string, batch bigint").select(
        "stream", "batch", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"))
    offsets = spark.read.schema(_stored(base)).parquet(target).where(F.col("partition").isNotNull()).groupBy(
        "partition").agg(F.max("offset").alias("offset")).select(
        F.lit(None).cast("string").alias("stream"), F.lit(None).cast("bigint").alias("batch"), "partition", "offset")
    streams.unionByName(offsets).write.mode("overwrite").parquet(f"{path}/positions/fold={number}")
    for stream, batch, folder in _batches(spark, path):
        if batch <= ends.get(stream, -1):
            delete(spark, folder)
    for old in _folders(spark, f"{path}/base"):
        if _number(old) < number:
            delete(spark, f"{path}/base/{old}")
    return number


def compact(base: DataFrame, keys: Sequence[str], path: str, target: str) -> DataFrame:
    """Write ``base`` with all changes as a new base, a batch job of its own.

    Deletes are gone from it: a stream that goes on from here must start behind these changes.
    """
    upserted(base, keys, path).write.mode("error").parquet(target)
    return base.sparkSession.read.schema(base.schema).parquet(target)


def dedupe_stream(log: DataFrame, hours: int = RETENTION_HOURS) -> DataFrame:
    """One row per offset; state is dropped once the log itself has expired.

    ``hours`` must cover the retention of the log: records that are read later than that behind the
    newest one are dropped by the watermark. ``late_records`` lists them.
    """
    return log.withWatermark("timestamp", f"{hours} hours").dropDuplicatesWithinWatermark(
        ["topic", "partition", "offset"]
    )


def op_counts_by_window(
    log: DataFrame, window: str = "1 hour", late: str | None = None
) -> DataFrame:
    """``(table, window_start, inserts, updates, deletes, total)`` per tumbling window.

    Works on a stream and on a batch. Tombstones count as the deletes. Files of a log come in any
    order, so by default no record is ever too late and the state holds every window. ``late`` bounds
    the state by a watermark; records beyond it are not counted.
    """
    slim = _counted_fields(log)
    if log.isStreaming and late is not None:
        slim = slim.withWatermark("timestamp", late)
    return _window_counts(slim, window, F.lit(True))


def _counted_fields(log: DataFrame) -> DataFrame:
    return log.select(
        "timestamp", "topic", route_topic("topic").alias("table"), is_tombstone().alias("_t"),
        F.get_json_object("value", "$.payload.op").alias("_op"),
    )


def _window_counts(slim: DataFrame, window: str, counts: Column) -> DataFrame:
    counted = slim.groupBy(F.window("timestamp", window).alias("w"), "table").agg(
        F.count_if(counts & (F.col("_op") == "c")).alias("inserts"),
        F.count_if(counts & (F.col("_op") == "u")).alias("updates"),
        F.count_if(counts & F.col("_t")).alias("deletes"),
        F.count_if(counts).alias("total"),
    )
    return counted.select(
        "table", F.col("w.start").alias("window_start"), "inserts", "updates", "deletes", "total"
    )


def op_counts_closed_windows(
    log: DataFrame, window: str, late: str, instance: str
) -> DataFrame:
    """The counts of ``op_counts_by_window`` for windows that are over, each reported once; for append mode.

    ``log`` is the stream of an instance with its heartbeat topic. Heartbeats are not counted, but they
    move the watermark, so the windows of tables that have gone idle close too, and their state is
    dropped. Heartbeats leave after the counting: a filter before it would be pushed below the
    watermark, which then stood still. A record more than ``late`` behind the newest one of an earlier
    batch may be left out; ``late_records`` finds it.
    """
    if not log.isStreaming:
        raise ValueError("closed windows are those of a stream; use op_counts_by_window on a table")
    data = F.col("topic").rlike(topic_regex(instance))
    slim = _counted_fields(log.withWatermark("timestamp", late))
    return _window_counts(slim, window, data).where("total > 0")


def append_closed(windows: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append each closed window to ``path`` once; a repeated batch writes nothing twice."""
    writer = windows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, checkpoint, once)


def late_records(log: DataFrame, hours: int) -> DataFrame:
    """Records of a log read as a table that are ``hours`` behind the newest one: what a stream with
    that watermark may have dropped, to be counted or replayed in batch."""
    newest = log.agg(F.max("timestamp")).scalar()
    return log.where(F.col("timestamp") < newest - F.make_dt_interval(hours=F.lit(hours)))


def keep_updates(
    updates: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append every changed row of an aggregation with the batch that changed it."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = updates.writeStream.outputMode("update").foreachBatch(append)
    return _start(writer, checkpoint, once)


def latest_updates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final row per key out of what ``keep_updates`` wrote."""
    rest = [c for c in df.columns if c not in {*keys, "batch"}]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def replay_progress(end: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per consumer group and whether its replay is done."""
    lag = consumer_lag(end, committed)
    return lag.withColumn("done", F.col("total_lag") == 0)


def progress_of(query: StreamingQuery) -> dict:
    """State of a running or finished replay, from Spark's own progress report."""
    last = query.lastProgress
    return {
        "active": query.isActive,
        "batch_id": None if last is None else last["batchId"],
        "rows_in_last_batch": None if last is None else last["numInputRows"],
        "error": None if query.exception() is None else str(query.exception()),
    }


class ReplayMonitor(StreamingQueryListener):
    """What happened to the streams of a session: started, each batch with its rows, failed or ended.

    Register it with ``spark.streams.addListener``. ``table`` gives the events so far, one row each:
    ``run, event, batch, rows, detail``.
    """

    def __init__(self) -> None:
        self.events: list[tuple[str, str, int | None, int | None, str | None]] = []

    def onQueryStarted(self, event) -> None:
        self.events.append((str(event.runId), "started", None, None, event.name))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ends = json.dumps([source.endOffset for source in p.sources])
        self.events.append((str(p.runId), "batch", p.batchId, p.numInputRows, ends))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.events.append((str(event.runId), "ended" if event.exception is None else "failed", None, None, event.exception))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.events), "run string, event string, batch bigint, rows bigint, detail string")


def run_to_end(start: Callable[[], StreamingQuery], attempts: int = 3) -> list[str | None]:
    """Run a stream to its end and start it again on the same checkpoint when it fails.

    Returns the error of each run, None for the last one; after ``attempts`` failures the last is raised.
    """
    errors: list[str | None] = []
    while True:
        query = start()
        try:
            query.awaitTermination()
            return errors + [None]
        except StreamingQueryException as e:
            errors.append(str(e).splitlines()[0])
            if len(errors) >= attempts:
                raise


def run_until(query: StreamingQuery, batches: int, seconds: float = 120) -> None:
    """Let a running stream finish ``batches`` batches with rows, then stop it.

    A stream without data is stopped after ``seconds``; a batch in work is waited for, however long it takes.
    """
    end = time.monotonic() + seconds
    while query.isActive and time.monotonic() < end:
        if sum(p["numInputRows"] > 0 for p in query.recentProgress) >= batches:
            break
        if query.status["isDataAvailable"]:
            end = time.monotonic() + seconds
        time.sleep(0.05)
    query.stop()
