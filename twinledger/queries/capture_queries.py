"""Logs as the capture writes them: logical types, and many tables in one log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.connect_types import DECIMAL, encoded_decimal
from twinledger.operators import changelog as L
from twinledger.plans.many_tables import TableSpec, replay_all_tables, state_of_table, upsert_all_tables
from twinledger.queries.inputs import (
    INSTANCE,
    KEY_FORM,
    LOG_COLUMNS,
    connect_schema,
    log_files,
    table,
    wrapped,
)
from twinledger.queries.registry import query
from twinledger.session import scratch_path
from twinledger.sources.tables import read_change_log

CONNECT = "org.apache.kafka.connect.data."


def records(rows: DataFrame, topic: str, fields: dict, key: str, images: list[tuple[str, Column, dict[str, Column]]]) -> DataFrame:
    """A log of ``rows``: each image ``(op, condition, columns)`` that holds is a record, a delete also a tombstone.

    Offsets are four for each key, in two partitions.
    """
    schema = connect_schema(fields)
    steps = []
    for i, (op, holds, columns) in enumerate(images):
        row = F.struct(*[c.alias(n) for n, c in columns.items()])
        none = F.when(F.lit(False), row)
        payload = F.struct(
            (row if op == "d" else none).alias("before"), (none if op == "d" else row).alias("after"),
            F.struct((F.col(key) * 16 + i).alias("lsn")).alias("source"), F.lit(op).alias("op"),
            F.lit(1_700_000_000_000).alias("ts_ms"))
        value = wrapped(schema, payload)
        steps.append(F.when(holds, F.struct(F.lit(i).alias("step"), value.alias("value"))))
        if op == "d":
            steps.append(F.when(holds, F.struct(F.lit(i + 1).alias("step"), F.lit(None).cast("string").alias("value"))))
    found = rows.select(
        F.lit(topic).alias("topic"), (F.col(key) % 2).cast("int").alias("partition"), key,
        wrapped(KEY_FORM, F.struct(F.col(key).alias("id"))).alias("key"),
        F.explode(F.filter(F.array(*steps), lambda s: s.isNotNull())).alias("_s"))
    return found.select(
        "topic", "partition", (F.floor(F.col(key) / 2) * 4 + F.col("_s.step")).alias("offset"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("_s.step")).alias("timestamp"), "key",
        F.col("_s.value").alias("value")).select(*LOG_COLUMNS)


# -- logical types -------------------------------------------------------------

# huge is text: from the key 5421011 on it has more than the 38 digits of a decimal column
CAPTURED_ROW = "id bigint, price decimal(18,2), huge string, day date, at string, made timestamp_ntz"
CAPTURED_FIELDS = {
    "id": ("int64", None, None), "price": ("bytes", DECIMAL, 2), "huge": ("bytes", DECIMAL, 0),
    "day": ("int32", CONNECT + "Date", None), "at": ("int32", CONNECT + "Time", None),
    "made": ("int64", CONNECT + "Timestamp", None),
}


def captured_log(spark, sf) -> DataFrame:
    """A record for each order with a negative or positive price, a number of more digits than a bigint holds (with
    large keys also more than a decimal) and times on both sides of the epoch.

    An order is a hundred times smaller than its record, so the orders are dealt to all tasks first.
    """
    k = F.col("o_orderkey")
    sign = F.when(k % 3 == 0, -1).otherwise(1)
    price = (F.col("o_totalprice").cast("decimal(18,2)") * sign).cast("decimal(18,2)")
    # k * sign * 10^12 in the upper bits of the number, k in the lower 64; 10^12 is 5^12 and three zeros in hexadecimal
    upper = F.lpad(F.hex(k * sign * 5 ** 12), 16, "0")
    wide = F.concat(F.when(upper >= "8", "F").otherwise("0"), upper, F.lit("000"), F.lpad(F.hex(k), 16, "0"))
    huge = F.base64(F.unhex(F.regexp_replace(wide, "^(?:00){1,2}(?=[0-7].{31})|^(?:FF){1,2}(?=[89A-F].{31})", "")))
    columns = {
        "id": k, "price": encoded_decimal(price, 2), "huge": huge, "day": (k * sign).cast("int"),
        "at": (k * 977 % 86_400_000).cast("int"), "made": k * sign * 86_399_999,
    }
    return records(table(spark, sf, "orders").repartition("o_orderkey"), "cdc-demo.public.orders", CAPTURED_FIELDS, "o_orderkey",
                   [("c", F.lit(True), columns)])


def _shown_date(value: str) -> Column:
    """Date as the SQL shows it: years have four digits or more, years before 0 a sign and no zeros."""
    year = F.year(value)
    shown = F.when(year.between(0, 9999), F.lpad(year.cast("string"), 4, "0")).otherwise(year.cast("string"))
    return F.concat(shown, F.date_format(value, "-MM-dd"))


@query("parse_envelope_connect", sql="""
SELECT o_orderkey AS id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS VARCHAR) AS price,
       CAST(CAST(o_orderkey * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS HUGEINT) * 1000000000000
            * 18446744073709551616 + o_orderkey AS VARCHAR) AS huge,
       strftime(DATE '1970-01-01' + CAST(o_orderkey * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS INTEGER),
                '%Y-%m-%d') AS day,
       strftime(TIMESTAMP '1970-01-01' + to_milliseconds(o_orderkey * 977 % 86400000), '%H:%M:%S.%g') AS at,
       strftime(TIMESTAMP '1970-01-01' + to_milliseconds(
         o_orderkey * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * 86399999), '%Y-%m-%d %H:%M:%S.%g') AS made,
       'c' AS op
FROM orders""")
def parse_envelope_connect_query(spark, sf):
    events = L.parse_envelope(captured_log(spark, sf), CAPTURED_ROW, "id bigint")
    # the time is shown without decimals where there are none
    at = F.rpad(F.concat(F.col("after.at"), F.when(F.col("after.at").contains("."), "").otherwise(".")), 12, "0")
    return events.select(
        "after.id", F.col("after.price").cast("string").alias("price"), "after.huge",
        _shown_date("after.day").alias("day"), at.alias("at"),
        F.concat(_shown_date("after.made"), F.date_format("after.made", " HH:mm:ss.SSS")).alias("made"), "op")


# -- one log of many tables ----------------------------------------------------

TABLES = {
    ("shop", "orders"): TableSpec("id bigint, total decimal(18,2), status string, day date", "id bigint"),
    ("archive", "orders"): TableSpec("id bigint, priority string", "id bigint"),
    ("crm", "customers"): TableSpec("id bigint, balance decimal(18,2), name string", "id bigint"),
    ("stats", "events"): TableSpec("id bigint, made timestamp_ntz, kind string", "id bigint"),
}


def log_of_many_tables(spark, sf) -> DataFrame:
    """Each row is created; every fifth key is updated, every seventh deleted afterwards."""
    always = F.lit(True)

    def log(rows: DataFrame, key: str, name: tuple[str, str], fields: dict, created: dict, updated: dict) -> DataFrame:
        k = F.col(key)
        columns = {"id": k} | created
        return records(rows, f"cdc-demo.{name[0]}.{name[1]}", {"id": ("int64", None, None)} | fields, key, [
            ("c", always, columns), ("u", k % 5 == 0, columns | updated), ("d", k % 7 == 0, columns)])

    text = ("string", None, None)
    orders = table(spark, sf, "orders")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01"))
    logs = [
        log(orders, "o_orderkey", ("shop", "orders"),
            {"total": ("bytes", DECIMAL, 2), "status": text, "day": ("int32", CONNECT + "Date", None)},
            {"total": encoded_decimal(total, 2), "status": F.col("o_orderstatus"), "day": days},
            {"total": encoded_decimal((-total).cast("decimal(18,2)"), 2)}),
        log(orders, "o_orderkey", ("archive", "orders"), {"priority": text},
            {"priority": F.col("o_orderpriority")}, {"priority": F.concat("o_orderpriority", F.lit("!"))}),
        log(table(spark, sf, "customer"), "c_custkey", ("crm", "customers"),
            {"balance": ("bytes", DECIMAL, 2), "name": text},
            {"balance": encoded_decimal(F.col("c_acctbal").cast("decimal(18,2)"), 2), "name": F.col("c_name")},
            {"name": F.upper("c_name")}),
        log(table(spark, sf, "events"), "event_id", ("stats", "events"),
            {"made": ("int64", CONNECT + "Timestamp", None), "kind": text},
            {"made": F.col("event_id") * 60_001, "kind": F.col("event_type")}, {"kind": F.lit("seen")}),
    ]
    return reduce(DataFrame.unionByName, logs)


def shown_tables(states: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """The rows of all tables as text."""
    parts = []
    for (schema, name), state in states.items():
        rest = [F.col(c).cast("string") for c in state.columns if c != "id"]
        parts.append(state.select(F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), "id",
                                  F.concat_ws("|", *rest).alias("shown")))
    return reduce(DataFrame.unionByName, parts)


ALL_TABLES = """
SELECT 'shop' AS schema_name, 'orders' AS table_name, o_orderkey AS id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE 1 END AS VARCHAR)
         || '|' || o_orderstatus || '|' || strftime(o_orderdate, '%Y-%m-%d') AS shown
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT 'archive', 'orders', o_orderkey, o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN '!' ELSE '' END
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT 'crm', 'customers', c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '|'
       || CASE WHEN c_custkey % 5 = 0 THEN upper(c_name) ELSE c_name END
FROM customer WHERE c_custkey % 7 <> 0
UNION ALL
SELECT 'stats', 'events', event_id,
       strftime(TIMESTAMP '1970-01-01' + to_milliseconds(event_id * 60001), '%Y-%m-%d %H:%M:%S')
       || CASE WHEN event_id % 1000 = 0 THEN '' ELSE '.' || rtrim(lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0'), '0') END
       || '|' || CASE WHEN event_id % 5 = 0 THEN 'seen' ELSE event_type END
FROM events WHERE event_id % 7 <> 0"""


@query("replay_all_tables", sql=ALL_TABLES)
def replay_all_tables_query(spark, sf):
    return shown_tables(replay_all_tables({}, log_of_many_tables(spark, sf), INSTANCE, TABLES))


@query("replay_all_tables_stream", sql=ALL_TABLES)
def replay_all_tables_stream_query(spark, sf):
    path = scratch_path(spark, "many-tables")
    rows = sum(table(spark, sf, name).count() for name in ("orders", "orders", "customer", "events"))
    files, source = log_files(rows), scratch_path(spark, "many-tables-log")
    log_of_many_tables(spark, sf).repartition(files, "topic", "partition", "offset").write.parquet(source)
    log = read_change_log(spark, source, L.topic_regex(INSTANCE), streaming=True,
                          max_files_per_trigger=-(-files // 2))
    upsert_all_tables(log, INSTANCE, TABLES, path, f"{path}/checkpoint").awaitTermination()
    return shown_tables({
        name: state_of_table(spark.createDataFrame([], spec.row), name, spec, path) for name, spec in TABLES.items()})
