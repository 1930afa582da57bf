"""The row-change log: envelopes, routing, counts, completeness, lag.

A log row has the shape of Spark's Kafka source: topic, partition, offset,
timestamp, key (JSON text), value (JSON text, NULL for a tombstone). The value
is a change envelope below ``payload``: before, after, source, op, ts_ms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.connect_types import decoded
from twinledger.functions.tokens import quoted

LOG_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
)
# Topic name patterns.
# Names and patterns of the log, retention in hours, heartbeat age in seconds.
HEARTBEAT_TABLE = "cdc.debezium_heartbeat"
ROUTE_PATTERN = r"^cdc(?:-[^.]+)?\.[^.]+\.(.+)$"
SCHEMA_PATTERN = r"^cdc(?:-[^.]+)?\.([^.]+)\.(.+)$"
INTERNAL_MARK = "__debezium"

RETENTION_HOURS = 168
HEARTBEAT_MAX_AGE = 60
_OFFSETS_PER_BLOCK = 1 << 20


def topic_regex(instance: str) -> str:
    """Topics of one instance, without its heartbeat."""
    heartbeat = HEARTBEAT_TABLE.replace(".", r"\.")
    return rf"^cdc-{instance}\.(?!{heartbeat}$).*$"


def instance_scope(
    log: DataFrame, instance: str, exclude_schemas: Sequence[str] = ()
) -> DataFrame:
    """Data topics of one instance: no heartbeat, internal or excluded-schema topics."""
    kept = log.where(
        F.col("topic").rlike(topic_regex(instance)) & ~F.col("topic").contains(INTERNAL_MARK)
    )
    for schema in exclude_schemas:
        kept = kept.where(~F.col("topic").startswith(f"cdc-{instance}.{schema}."))
    return kept


def route_topic(topic: Column | str, pattern: str = ROUTE_PATTERN) -> Column:
    """Topic -> table name; a topic that does not match stays as it is."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    return F.when(topic.rlike(pattern), F.regexp_extract(topic, pattern, 1)).otherwise(topic)


def topic_schema(topic: Column | str) -> Column:
    """Schema part of a topic, which routing drops; NULL if there is none."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    return F.nullif(F.regexp_extract(topic, SCHEMA_PATTERN, 1), F.lit(""))


def is_tombstone(value: Column | str = "value") -> Column:
    """A NULL or blank value."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNull() | F.trim(value).isin("", "null")


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


# One level of a Connect schema: which logical type each field has.
_FIELDS = "array<struct<field: string, name: string, parameters: struct<scale: string>>>"
_ENVELOPE = f"""
    schema struct<fields: array<struct<field: string, fields: {_FIELDS}>>>,
    payload struct<before: map<string, string>, after: map<string, string>, source: struct<lsn: bigint>,
                   op: string, ts_ms: bigint>"""
_KEY = f"schema struct<fields: {_FIELDS}>, payload map<string, string>"


def _kinds(fields: Column) -> Column:
    """Field name -> logical type and scale, of the fields that have one."""
    named = F.filter(fields, lambda f: f["name"].isNotNull())
    kinds = F.arrays_zip(named["name"], named["parameters"]["scale"]).cast("array<struct<name: string, scale: string>>")
    return F.map_from_arrays(named["field"], kinds)


def _image_fields(fields: Column) -> Column:
    """Fields of the row image, of which the first of ``before`` and ``after`` tells."""
    places = [F.nullif(F.array_position(fields["field"], name), F.lit(0)) for name in ("before", "after")]
    return F.get(fields, F.least(*places).cast("int") - 1)["fields"]


def parse_log(log: DataFrame) -> DataFrame:
    """Records of any tables, each parsed once: ``topic, partition, offset, timestamp, schema, table, key,
    key_kinds, op, before, after, kinds, lsn, ts_ms, tombstone, corrupt``.

    Row images and keys are maps from field names to text; ``kinds`` holds the logical types that
    the record's own schema gives them. ``typed_events`` turns the records of one table into columns.
    Keys come with or without the schema wrapper.
    """
    parsed = log.select(
        "topic", "partition", "offset", "timestamp",
        F.from_json("key", _KEY).alias("_k"),
        F.from_json("key", "map<string, string>").alias("_plain"),
        is_tombstone().alias("tombstone"),
        F.from_json("value", _ENVELOPE).alias("_e"),
    )
    return parsed.select(
        "topic", "partition", "offset", "timestamp",
        topic_schema("topic").alias("schema"), route_topic("topic").alias("table"),
        F.coalesce(F.col("_k.payload"), F.col("_plain")).alias("key"),
        _kinds(F.col("_k.schema.fields")).alias("key_kinds"),
        F.col("_e.payload.op").alias("op"), F.col("_e.payload.before").alias("before"),
        F.col("_e.payload.after").alias("after"),
        _kinds(_image_fields(F.col("_e.schema.fields"))).alias("kinds"),
        F.col("_e.payload.source.lsn").alias("lsn"), F.col("_e.payload.ts_ms").alias("ts_ms"),
        "tombstone", (~F.col("tombstone") & F.col("_e.payload.op").isNull()).alias("corrupt"),
    )


def _field(image: str, kinds: str, name: str) -> tuple[str, str, str]:
    """SQL of a field's text, its logical type and its scale."""
    quoted_name = "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
    kind = f"try_element_at({kinds}, {quoted_name})"
    return f"try_element_at({image}, {quoted_name})", f"{kind}.name", f"{kind}.scale"


def _struct_of(fields: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{sql} AS `{name.replace('`', '``')}`" for name, sql in fields.items()) + ")"


def _typed(image: str, kinds: str, row: T.StructType) -> Column:
    """Row image as a struct; a value that does not fit its type fails."""
    fields = {f.name: decoded(*_field(image, kinds, f.name), f.dataType) for f in row.fields}
    return F.expr(f"if({image} IS NOT NULL, {_struct_of(fields)}, NULL)")


def _typed_key(key: T.StructType) -> Column:
    """Key as a struct; a value that does not fit is null, so the key is not usable."""
    text = {f.name: decoded(*_field("key", "key_kinds", f.name), T.StringType()) for f in key.fields}
    return F.expr(_struct_of({f.name: f"try_cast({text[f.name]} AS {f.dataType.simpleString()})" for f in key.fields}))


def typed_events(
    parsed: DataFrame, row_schema: T.StructType | str, key_schema: T.StructType | str
) -> DataFrame:
    """Records of ``parse_log`` in the columns of one table: ``topic, partition, offset, timestamp, key,
    tombstone, op, before, after, lsn, ts_ms, corrupt, unknown_fields``."""
    row, key = _struct(row_schema), _struct(key_schema)
    known = F.array(*[F.lit(f.name) for f in row.fields])
    sent = F.coalesce(F.map_keys("after"), F.array().cast("array<string>"))
    return parsed.select(
        "topic", "partition", "offset", "timestamp", _typed_key(key).alias("key"), "tombstone", "op",
        _typed("before", "kinds", row).alias("before"), _typed("after", "kinds", row).alias("after"),
        "lsn", "ts_ms", "corrupt", F.array_except(sent, known).alias("unknown_fields"),
    )


def parse_envelope(
    log: DataFrame, row_schema: T.StructType | str, key_schema: T.StructType | str
) -> DataFrame:
    """Typed events of a log of one table: op, before, after, lsn, ts_ms, and the key as a struct.

    ``corrupt`` marks values that are not an envelope; ``unknown_fields`` lists
    fields of the row image the given schema does not have. The value is parsed
    once: row images are read as field name -> text, which keeps the unknown
    names, and only the known fields are then converted, each by the logical
    type its record's schema names (base64 decimals, days, milliseconds).
    """
    return typed_events(parse_log(log), row_schema, key_schema)


def unwrap(events: DataFrame, forbid_unknown: bool = True) -> DataFrame:
    """Row image after each change, flat: table, key columns, row columns.

    A delete keeps its key, has NULL row columns and ``_deleted`` set; the
    extra tombstone behind it is dropped. A corrupt value, or a field the row
    schema does not have, fails the job: the target is never evolved.
    """
    kept = events.where(~F.col("tombstone"))
    broken = F.col("corrupt")
    if forbid_unknown:
        broken = broken | (F.size("unknown_fields") > 0)
    message = F.concat(
        F.lit("cannot apply record "), F.col("topic"), F.lit("/"), F.col("partition"),
        F.lit("@"), F.col("offset"), F.lit(": not an envelope, or fields unknown to the target"),
    )
    key_fields = kept.schema["key"].dataType.names
    row_fields = [f for f in kept.schema["after"].dataType.names if f not in key_fields]
    # Part of the projection on purpose: as a filter the check would be moved
    # below the parsing and repeat it.
    refuse = F.raise_error(message).cast("boolean")
    deleted = F.when(broken, refuse).otherwise(F.col("op") == "d")
    return kept.select(
        route_topic("topic").alias("table"),
        topic_schema("topic").alias("schema"),
        *[F.col("key")[f].alias(f) for f in key_fields],
        *[F.when(~deleted, F.col("after")[f]).alias(f) for f in row_fields],
        deleted.alias("_deleted"),
        "partition",
        "offset",
        "timestamp",
    )


def split_keyless(events: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(usable, rejects)``: a record without a complete key cannot be applied."""
    lost = F.lit(False)
    for k in keys:
        lost = lost | quoted(k).isNull()
    return events.where(~lost), events.where(lost)


def require_keys(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The events themselves; the job fails on one without a complete key."""
    refuse = F.raise_error(F.lit("record without a usable key"))
    kinds = {k: events.schema[k].dataType for k in keys}
    return events.withColumns(
        {k: F.coalesce(quoted(k), refuse.cast(kinds[k])) for k in keys}
    )


def op_counts(log: DataFrame) -> DataFrame:
    """``(table, inserts, updates, deletes, delete_events, snapshot_reads, total)``.

    Deletes are counted by their tombstone; the delete record itself is only
    part of ``total``, which comes from the offset range. The last row is the
    grand total. Rows are reduced to one per topic partition before anything
    is shuffled.
    """
    slim = log.select(
        "topic", "partition", "offset", is_tombstone().alias("_t"),
        F.get_json_object("value", "$.payload.op").alias("_op"),
    )
    per_partition = slim.groupBy("topic", "partition").agg(
        F.count_if(F.col("_op") == "c").alias("inserts"),
        F.count_if(F.col("_op") == "u").alias("updates"),
        F.count_if("_t").alias("deletes"),
        F.count_if(F.col("_op") == "d").alias("delete_events"),
        F.count_if(F.col("_op") == "r").alias("snapshot_reads"),
        (F.max("offset") - F.min("offset") + 1).alias("total"),
    )
    return _with_grand_total(per_partition, [
        "inserts", "updates", "deletes", "delete_events", "snapshot_reads", "total",
    ])


def _with_grand_total(per_partition: DataFrame, counts: Sequence[str]) -> DataFrame:
    named = per_partition.withColumn("table", _table_label("topic"))
    summed = named.rollup("table").agg(*[F.sum(c).alias(c) for c in counts])
    return summed.select(F.coalesce("table", F.lit("TOTAL")).alias("table"), *counts)


def _table_label(topic: str) -> Column:
    """``schema.table`` of a topic."""
    return F.regexp_replace(topic, r"^cdc(?:-[^.]+)?\.", "")


def topic_totals(log: DataFrame) -> DataFrame:
    """``(table, total)`` from offsets alone; values are never read."""
    per_partition = log.groupBy("topic", "partition").agg(
        (F.max("offset") - F.min("offset") + 1).alias("total")
    )
    return _with_grand_total(per_partition, ["total"])


def log_end(log: DataFrame) -> DataFrame:
    """``(topic, partition, end_offset)``: the offset the next record will get."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def _partition_lag(end: DataFrame, committed: DataFrame) -> DataFrame:
    on = ["topic", "partition"]
    joined = committed.join(end, on, "left")
    behind = F.col("end_offset") - F.expr("try_cast(committed_offset AS bigint)")
    return joined.select("group", *on, F.greatest(F.lit(0).cast("bigint"), behind).alias("lag"))


def lagging_partitions(end: DataFrame, committed: DataFrame) -> DataFrame:
    return _partition_lag(end, committed).where(F.col("lag") > 0)


def consumer_lag(end: DataFrame, committed: DataFrame) -> DataFrame:
    """``(group, total_lag, lagging_partitions, state)`` per consumer group.

    ``committed``: group, topic, partition, committed_offset. A partition
    without a numeric commit adds nothing, as does a negative difference.
    """
    lag = _partition_lag(end, committed)
    per_group = lag.groupBy("group").agg(
        F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("total_lag"),
        F.count_if(F.col("lag") > 0).alias("lagging_partitions"),
    )
    state = F.when(F.col("total_lag") == 0, F.lit("caught_up")).otherwise(F.lit("behind"))
    return per_group.withColumn("state", state)


def heartbeat_age(
    log: DataFrame, now: Column, max_age: int = HEARTBEAT_MAX_AGE, instance: str | None = None
) -> DataFrame:
    """``(age_seconds, status)`` since the last heartbeat; ``WARN`` if old or missing."""
    ending = f".{HEARTBEAT_TABLE}"
    beats = log.where(
        F.col("topic").endswith(ending) if instance is None
        else F.col("topic") == f"cdc-{instance}{ending}"
    )
    last = beats.agg(F.max("timestamp").alias("_last"))
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("_last").cast("timestamp"))
    status = F.when(F.coalesce(age > max_age, F.lit(True)), F.lit("WARN")).otherwise(F.lit("OK"))
    return last.select(age.alias("age_seconds"), status.alias("status"))


def log_completeness(log: DataFrame) -> DataFrame:
    """Per topic partition: offset range, distinct offsets, and how many are missing.

    Repeats of an offset are removed by a grouping on the offset itself, which
    spreads one large partition over all tasks.
    """
    distinct = log.groupBy("topic", "partition", "offset").agg(F.min("timestamp").alias("_ts"))
    ranges = distinct.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count("*").alias("records"),
        F.min("_ts").alias("first_timestamp"),
    )
    span = F.col("last_offset") - F.col("first_offset") + 1
    return ranges.withColumn("missing", span - F.col("records"))


def offset_gaps(log: DataFrame, block: int = _OFFSETS_PER_BLOCK) -> DataFrame:
    """``(topic, partition, gap_start, gap_end, missing)`` for every hole.

    Neighbours are compared inside blocks of at most ``block`` offsets, so no
    window holds a whole partition. Only the first and last row of each block
    go on to a second window, which compares them across blocks.
    """
    part = ["topic", "partition"]
    # One exchange by block serves both the grouping and the window behind it.
    blocks = F.shiftright("offset", block.bit_length() - 1).alias("_block")
    seen = log.select(*part, blocks, "offset").repartition(*part, "_block").distinct()
    inside = Window.partitionBy(*part, "_block").orderBy("offset")
    near = seen.withColumns({
        "_previous": F.lag("offset").over(inside), "_next": F.lead("offset").over(inside),
    })
    edge = F.col("_previous").isNull() | F.col("_next").isNull()
    kept = near.where(edge | (F.col("offset") - F.col("_previous") > 1))
    # Rows with a gap inside their block are done; edges share one window.
    across = Window.partitionBy(
        *part, F.when(edge, F.lit(-1)).otherwise(F.col("_block"))
    ).orderBy("offset")
    linked = kept.withColumn("_from", F.coalesce("_previous", F.lag("offset").over(across)))
    return linked.where(F.col("offset") - F.col("_from") > 1).select(
        *part,
        (F.col("_from") + 1).alias("gap_start"),
        (F.col("offset") - 1).alias("gap_end"),
        (F.col("offset") - F.col("_from") - 1).alias("missing"),
    )


def retention_guard(
    log: DataFrame, cutover: Column, now: Column, hours: int = RETENTION_HOURS
) -> DataFrame:
    """Per topic: is a replay from ``cutover`` still complete?

    Unsafe if more than ``hours`` have passed since the cutover, if the log no
    longer reaches back to it, or if offsets are missing in between.
    """
    per_topic = log_completeness(log).groupBy("topic").agg(
        F.min("first_offset").alias("first_offset"),
        F.max("first_timestamp").alias("_latest_start"),
        F.min("first_timestamp").alias("first_timestamp"),
        F.sum("missing").alias("missing"),
    )
    passed = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(cutover.cast("timestamp"))
    return per_topic.select(
        "topic", "first_offset", "first_timestamp", "missing",
        (passed > hours * 3600).alias("window_exceeded"),
        (F.col("_latest_start") > cutover).alias("starts_late"),
    ).withColumn(
        "safe",
        ~F.col("window_exceeded") & ~F.col("starts_late") & (F.col("missing") == 0),
    )


def dedupe_events(log: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset)."""
    return log.dropDuplicates(["topic", "partition", "offset"])


def after_positions(
    log: DataFrame, positions: Mapping[tuple[str, int], int] | DataFrame
) -> DataFrame:
    """Records behind a snapshot position; partitions without one are kept whole.

    Positions are one number per topic partition, as in a Kafka start offset: a mapping of a few, or a
    table ``topic, partition, offset`` of any number, which is joined.
    """
    if isinstance(positions, DataFrame):
        last = positions.groupBy("topic", "partition").agg(F.max("offset").alias("_from"))
        found = log.join(last, ["topic", "partition"], "left")
        return found.where(F.col("offset") > F.coalesce("_from", F.lit(-1))).select(*log.columns)
    if not positions:
        return log
    entries = []
    for (topic, partition), offset in positions.items():
        entries += [F.lit(f"{topic}/{partition}"), F.lit(int(offset)).cast("bigint")]
    here = F.concat(F.col("topic"), F.lit("/"), F.col("partition").cast("string"))
    start = F.try_element_at(F.create_map(*entries), here)
    return log.where(F.col("offset") > F.coalesce(start, F.lit(-1)))
