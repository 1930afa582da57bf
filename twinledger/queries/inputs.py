"""Second copies and change logs derived from the given tables.

Everything is a pure expression on a key, written once for Spark and once as
SQL, so both see the same rows at any scale.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.arithmetic import floor_div
from twinledger.functions.connect_types import DECIMAL, encoded_decimal
from twinledger.operators.balance import written


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- two copies of orders ------------------------------------------------------

ORDERS = """
orders_l AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders),
orders_r AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
              AS DECIMAL(18,2)) AS o_totalprice,
         CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 250 MILLISECONDS
              ELSE o_orderdate END AS o_orderdate,
         o_orderpriority
  FROM orders_l WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders_l WHERE o_orderkey % 101 = 0)
"""


def orders_left(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")
    )


def orders_right(spark: SparkSession, sf: str) -> DataFrame:
    """Missing keys, changed prices, extra keys, and harmless sub-second shifts."""
    left, k = orders_left(spark, sf), F.col("o_orderkey")
    price = F.when(k % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    shifted = F.col("o_orderdate") + F.expr("INTERVAL '0.25' SECOND")
    kept = left.where(k % 97 != 0).withColumns({
        "o_totalprice": price.cast("decimal(18,2)"),
        "o_orderdate": F.when(k % 7 == 0, shifted).otherwise(F.col("o_orderdate")),
    })
    return kept.unionByName(left.where(k % 101 == 0).withColumn("o_orderkey", -k - 1))


def orders_hash_sql(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return (
        "md5(concat_ws(chr(29), "
        f"COALESCE(CAST({p}o_orderkey AS VARCHAR), chr(1)), "
        f"COALESCE(CAST({p}o_custkey AS VARCHAR), chr(1)), "
        f"COALESCE({p}o_orderstatus, chr(1)), "
        f"COALESCE(CAST({p}o_totalprice AS VARCHAR), chr(1)), "
        f"COALESCE(strftime({p}o_orderdate, '%Y-%m-%d %H:%M:%S'), chr(1)), "
        f"COALESCE({p}o_orderpriority, chr(1))))"
    )


ORDERS_DIFF = f"""
{ORDERS.strip()},
hashed_l AS (SELECT o_orderkey AS k, {orders_hash_sql()} AS h FROM orders_l),
hashed_r AS (SELECT o_orderkey AS k, {orders_hash_sql()} AS h FROM orders_r),
diff AS (
  SELECT COALESCE(l.k, r.k) AS o_orderkey,
         CASE WHEN r.k IS NULL THEN 'left_only' WHEN l.k IS NULL THEN 'right_only'
              ELSE 'changed' END AS diff_type
  FROM hashed_l l FULL OUTER JOIN hashed_r r ON l.k = r.k
  WHERE l.h IS DISTINCT FROM r.h)
"""


# -- composite keys ------------------------------------------------------------

CONVERSATIONS = """
conv_l AS (SELECT conv_id, turn, role, text FROM conversations),
conv_r AS (
  SELECT conv_id, turn, role,
         CASE WHEN conv_id % 89 = 0 THEN text || 'x' ELSE text END AS text
  FROM conversations WHERE conv_id % 97 <> 0
  UNION ALL
  SELECT -conv_id - 1, turn, role, text FROM conversations WHERE conv_id % 101 = 0)
"""


def conversations_right(spark: SparkSession, sf: str) -> DataFrame:
    left, k = table(spark, sf, "conversations"), F.col("conv_id")
    text = F.when(k % 89 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return left.where(k % 97 != 0).withColumn("text", text).unionByName(
        left.where(k % 101 == 0).withColumn("conv_id", -k - 1)
    )


# -- a table with defects ------------------------------------------------------

DIRTY = """
dirty AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 53 <> 0 THEN o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 59 = 0 THEN NULL
              WHEN o_orderkey % 307 = 0 THEN o_orderpriority || chr(65533)
              ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 151 = 0 THEN repeat(o_orderstatus, 80)
              ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 211 = 0 THEN '0000-00-00 00:00:00'
              WHEN o_orderkey % 223 = 0 THEN NULL
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created,
         CASE WHEN o_orderkey % 227 = 0 THEN '0000-00-00'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS shipped,
         strftime(o_orderdate, '%Y-%m-%d') AS billed
  FROM orders)
"""


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    marked = F.concat("o_orderpriority", F.lit("�"))
    return table(spark, sf, "orders").select(
        k,
        F.when(k % 53 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(k % 59 == 0, None).when(k % 307 == 0, marked)
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 151 == 0, F.repeat("o_orderstatus", 80))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 211 == 0, F.lit("0000-00-00 00:00:00")).when(k % 223 == 0, None)
        .otherwise(stamp).alias("created"),
        F.when(k % 227 == 0, F.lit("0000-00-00")).otherwise(day).alias("shipped"),
        day.alias("billed"),
    )


# -- a change log derived from events ------------------------------------------
#
# Event e goes to lane e % 8: four tables with two log partitions each. Within a
# lane, event j = e div 8 is a delete when j % 10 = 0 and is then followed by a
# tombstone, so its offset is j plus the number of tombstones before it.

LOG_TABLES = ("customers", "products", "orders", "order_items")
INSTANCE = "demo"
HEARTBEAT_TOPIC = "cdc-demo.cdc.debezium_heartbeat"
ROW_SCHEMA = "id bigint, value decimal(18,2), ts string"
KEY_SCHEMA = "id bigint"

CHANGES = """
changes AS (
  SELECT event_id,
         ['customers', 'products', 'orders', 'order_items'][CAST((event_id % 8) // 2 AS INTEGER) + 1]
           AS tbl,
         CAST(event_id % 2 AS INTEGER) AS part,
         event_id // 8 + (event_id // 8 + 9) // 10 AS pos,
         user_id * 2 + event_id % 2 AS id,
         CAST(value AS DECIMAL(18,2)) AS value,
         ts,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text,
         CASE WHEN (event_id // 8) % 10 = 0 THEN 'd'
              WHEN (event_id // 8) % 10 <= 3 THEN 'c' ELSE 'u' END AS op
  FROM events),
log AS (
  SELECT 'cdc-demo.public.' || tbl AS topic, part, pos, ts, event_id, id, value, ts_text, op,
         FALSE AS tombstone FROM changes
  UNION ALL
  SELECT 'cdc-demo.public.' || tbl, part, pos + 1, ts, event_id, id, NULL, NULL, NULL, TRUE
  FROM changes WHERE op = 'd')
"""

FULL_LOG = CHANGES.strip() + """,
full_log AS (
  SELECT topic, part, pos, ts, tombstone FROM log
  UNION ALL
  SELECT 'cdc-demo.cdc.debezium_heartbeat', 0, event_id // 500, ts, FALSE
  FROM events WHERE event_id % 500 = 0
  UNION ALL
  SELECT 'cdc-other.public.orders', 0, event_id // 50, ts, FALSE FROM events WHERE event_id % 50 = 0
  UNION ALL
  SELECT 'cdc-demo.replica_meta.t_log', 0, event_id // 250, ts, FALSE
  FROM events WHERE event_id % 250 = 0
  UNION ALL
  SELECT 'cdc-demo.__debezium.signal', 0, event_id // 1000, ts, FALSE
  FROM events WHERE event_id % 1000 = 0)
"""

# Rows a replay of the whole log has to end with.
FINAL_STATE = CHANGES.strip() + """,
final_state AS (
  SELECT tbl, id, value, ts_text FROM (
    SELECT *, row_number() OVER (PARTITION BY tbl, id ORDER BY event_id DESC) AS rn FROM changes)
  WHERE rn = 1 AND op <> 'd')
"""


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per change with its position in the log."""
    e, lane = F.col("event_id"), F.col("event_id") % 8
    j = floor_div(e, 8)
    name = F.element_at(F.array(*[F.lit(t) for t in LOG_TABLES]),
                        (floor_div(lane, 2) + 1).cast("int"))
    return table(spark, sf, "events").select(
        e,
        name.alias("table"),
        (e % 2).cast("int").alias("partition"),
        (j + floor_div(j + 9, 10)).alias("offset"),
        (F.col("user_id") * 2 + e % 2).alias("id"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
        F.when(j % 10 == 0, F.lit("d")).when(j % 10 <= 3, F.lit("c"))
        .otherwise(F.lit("u")).alias("op"),
    )


def connect_schema(fields: dict[str, tuple[str, str | None, int | None]]) -> str:
    """Schema of a change envelope: field -> (type, logical type, scale)."""
    columns = []
    for name, (kind, logical, scale) in fields.items():
        column = {"type": kind, "optional": True, "field": name}
        if logical is not None:
            column |= {"name": logical, "version": 1}
        if scale is not None:
            column["parameters"] = {"scale": str(scale), "connect.decimal.precision": "18"}
        columns.append(column)
    image = {"type": "struct", "optional": True, "fields": columns}
    return json.dumps({"type": "struct", "optional": False, "fields": [
        {**image, "field": "before"}, {**image, "field": "after"},
        {"type": "struct", "optional": False, "field": "source", "fields": [{"type": "int64", "field": "lsn"}]},
        {"type": "string", "field": "op"}, {"type": "int64", "field": "ts_ms"},
    ]})


def wrapped(schema: str, payload: Column) -> Column:
    """A record's JSON with its schema in front, NULL fields included."""
    shown = F.to_json(payload, {"ignoreNullFields": "false"})
    return F.concat(F.lit(f'{{"schema": {schema}, "payload": '), shown, F.lit("}"))


# The log holds decimals as the capture writes them: base64 with the scale in the schema.
RECORD_SCHEMA = connect_schema({
    "id": ("int64", None, None), "value": ("bytes", DECIMAL, 2),
    "ts": ("string", "io.debezium.time.ZonedTimestamp", None),
})
KEY_FORM = json.dumps({"type": "struct", "fields": [{"type": "int64", "optional": False, "field": "id"}]})


def _record(topic: Column, changed: DataFrame) -> DataFrame:
    row = F.struct("id", encoded_decimal(F.col("value"), 2).alias("value"), "ts")
    delete = F.col("op") == "d"
    payload = F.struct(
        F.when(delete, row).alias("before"),
        F.when(~delete, row).alias("after"),
        F.struct((F.col("event_id") * 16).alias("lsn")).alias("source"),
        "op",
        F.unix_millis("timestamp").alias("ts_ms"),
    )
    key = wrapped(KEY_FORM, F.struct("id"))
    both = F.array(
        F.struct(F.lit(0).alias("after"), wrapped(RECORD_SCHEMA, payload).alias("value")),
        F.struct(F.lit(1).alias("after"), F.lit(None).cast("string").alias("value")),
    )
    records = F.when(delete, both).otherwise(F.slice(both, 1, 1))
    return changed.select(
        topic.alias("topic"), "partition", "offset", "timestamp", key.alias("key"),
        F.explode(records).alias("_r"), "event_id",
    ).select(
        "topic", "partition", (F.col("offset") + F.col("_r.after")).alias("offset"), "timestamp",
        "key", F.col("_r.value").alias("value"), "event_id",
    )


LOG_COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value")


_stored_logs: dict[str, DataFrame] = {}


def store_change_log(spark: SparkSession, sf: str) -> None:
    """Keep the log as a table for this process, so that what follows times the operators and not the fixture."""
    _stored_logs.pop(sf, None)
    topic = F.concat(F.lit("cdc-demo.public."), F.col("table"))
    log = _record(topic, changes(spark, sf)).withColumn("table", F.substring_index("topic", ".", -1))
    _stored_logs[sf] = written(log, "change-log")


def change_log(spark: SparkSession, sf: str, where: Column | None = None) -> DataFrame:
    """Log of the data tables; ``where`` picks the changes it covers, by ``event_id`` and ``table``.

    A change is a hundred times smaller than its record, so a few scan tasks would make and parse the
    whole log; the changes are dealt to all tasks first.
    """
    if sf in _stored_logs:
        log = _stored_logs[sf]
        return (log if where is None else log.where(where)).select(*LOG_COLUMNS)
    picked = changes(spark, sf)
    picked = picked if where is None else picked.where(where)
    topic = F.concat(F.lit("cdc-demo.public."), F.col("table"))
    return _record(topic, picked.repartition("event_id")).select(*LOG_COLUMNS)


# Sizes of a stored log: a file is the work of one task for seconds, a batch is bounded.
ROWS_PER_FILE = 20_000
FILES_PER_BATCH = 96
BATCHES = 3


def log_files(rows: int) -> int:
    """Files of a log that is made of so many rows: they grow with it, at least six."""
    return max(2 * BATCHES, -(-rows // ROWS_PER_FILE))


def files_per_batch(files: int) -> int:
    """Files a batch of a stream takes: a third of a small log, a fixed number of a larger one."""
    return min(FILES_PER_BATCH, -(-files // BATCHES))


def _side_topic(spark: SparkSession, sf: str, topic: str, every: int) -> DataFrame:
    e = F.col("event_id")
    body = F.to_json(F.struct(F.struct(F.lit("u").alias("op")).alias("payload")))
    return table(spark, sf, "events").where(e % every == 0).select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
        floor_div(e, every).alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit('{"id":1}').alias("key"), body.alias("value"),
    )


def full_log(spark: SparkSession, sf: str) -> DataFrame:
    """Data topics plus heartbeat, another instance, an internal and an excluded topic."""
    out = change_log(spark, sf)
    for topic, every in (
        (HEARTBEAT_TOPIC, 500),
        ("cdc-other.public.orders", 50),
        ("cdc-demo.replica_meta.t_log", 250),
        ("cdc-demo.__debezium.signal", 1000),
    ):
        out = out.unionByName(_side_topic(spark, sf, topic, every))
    return out


def midpoint(spark: SparkSession, sf: str) -> Column:
    """Last event the base copy of a replay has seen."""
    return table(spark, sf, "events").agg(floor_div(F.max("event_id"), 2).alias("mid")).scalar()


def base_copy(spark: SparkSession, sf: str) -> DataFrame:
    """State of all tables at the midpoint: schema, table, id, value, ts."""
    seen = changes(spark, sf).where(F.col("event_id") <= midpoint(spark, sf))
    last = seen.groupBy("table", "id").agg(
        F.max_by(F.struct("op", "value", "ts"), F.col("event_id")).alias("_l")
    )
    return last.where(F.col("_l.op") != "d").select(F.lit("public").alias("schema"), "table", "id", "_l.value", "_l.ts")


def shown_state(state: DataFrame) -> DataFrame:
    """Columns and types of ``final_state`` in the SQL."""
    return state.select(
        F.col("table").alias("tbl"), "id", F.col("value").cast("string").alias("value"),
        F.col("ts").alias("ts_text"),
    )


SHOWN_STATE = "SELECT tbl, id, CAST(value AS VARCHAR) AS value, ts_text FROM final_state"
