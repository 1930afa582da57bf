"""Tokens, digests, and row, key and column diffs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from twinledger.functions.arithmetic import floor_div
from twinledger.functions.logical_types import LogicalType, infer_types
from twinledger.functions.tokens import column_token, key_text, row_hash
from twinledger.functions.transforms import (
    bool_to_tinyint,
    enum_remap,
    enum_remap_join,
    timestamptz_to_datetime,
)
from twinledger.operators import diff as D
from twinledger.operators import digest as G
from twinledger.operators.balance import written
from twinledger.operators.reports import reconcile_summary
from twinledger.plans.reconcile import (
    TablePair,
    comparison_plan,
    reconcile,
    reconcile_each,
    samples,
)
from twinledger.queries.inputs import (
    CONVERSATIONS,
    ORDERS,
    ORDERS_DIFF,
    conversations_right,
    orders_hash_sql,
    orders_left,
    orders_right,
    table,
)
from twinledger.queries.registry import query
from twinledger.sources.sinks import write_bucketed_copy

CHUNK = 1000
BUCKET = 500
KEY = ["o_orderkey"]


def both(spark, sf):
    return orders_left(spark, sf), orders_right(spark, sf)


# -- projections ---------------------------------------------------------------


@query("column_token", sql=r"""
SELECT event_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_token,
       CAST(CAST(value AS DECIMAL(38,2)) AS VARCHAR) AS value_token,
       CASE WHEN event_id % 11 = 0 THEN chr(1) ELSE chr(2) END AS props_token,
       CASE WHEN event_id % 13 = 0 THEN chr(1)
            WHEN event_id % 3 = 0 THEN 'false' ELSE 'true' END AS flag_token,
       CASE WHEN event_id % 5 = 0 THEN chr(1) WHEN event_id % 5 = 1 THEN '' ELSE event_type END
         AS type_token
FROM events""")
def column_token_query(spark, sf):
    e = F.col("event_id")
    df = table(spark, sf, "events").select(
        e, "ts", "value",
        F.when(e % 11 != 0, F.col("props")).alias("props"),
        F.when(e % 13 != 0, (e % 3).cast("tinyint")).alias("flag"),
        F.when(e % 5 == 0, None).when(e % 5 == 1, F.lit("")).otherwise(F.col("event_type"))
        .alias("type"),
    )
    kinds = {
        "ts": "timestamp", "value": LogicalType("float8", 2), "props": "jsonb", "flag": "bool",
        "type": "text",
    }
    return df.select(e, *[
        column_token(c, t, df.schema[c].dataType).alias(f"{c}_token") for c, t in kinds.items()
    ])


@query("row_hash", ORDERS, sql=f"SELECT o_orderkey, {orders_hash_sql()} AS h FROM orders_l")
def row_hash_query(spark, sf):
    df = orders_left(spark, sf)
    return df.select("o_orderkey", row_hash(df, df.columns, infer_types(df)).alias("h"))


@query("key_text", sql="""
SELECT CAST(conv_id AS VARCHAR) || chr(28) || CAST(turn AS VARCHAR) AS key, role
FROM conversations""")
def key_text_query(spark, sf):
    return table(spark, sf, "conversations").select(
        key_text(["conv_id", "turn"]).alias("key"), "role"
    )


@query("timestamptz_to_datetime", sql="""
SELECT event_id,
       strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS utc
FROM events""")
def timestamptz_to_datetime_query(spark, sf):
    e = F.col("event_id")
    fraction = F.when(e % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    df = table(spark, sf, "events").select(e, fraction.alias("iso"))
    broken = F.when(e % 3 == 0, F.lit("not a time")).otherwise(F.col("iso"))
    return df.select(
        e,
        timestamptz_to_datetime("iso", "America/New_York").alias("local"),
        timestamptz_to_datetime(broken).alias("utc"),
    )


@query("enum_remap", sql="""
SELECT event_id,
       CASE event_type WHEN 'click' THEN 'CLICKED' WHEN 'error' THEN 'FAILED' ELSE event_type END
         AS event_type
FROM events""")
def enum_remap_query(spark, sf):
    mapping = {"click": "CLICKED", "error": "FAILED"}
    return table(spark, sf, "events").select(
        "event_id", enum_remap("event_type", mapping).alias("event_type")
    )


@query("enum_remap_table", sql="""
SELECT p_partkey, CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) % 2 = 0 THEN upper(p_brand)
                       ELSE p_brand END AS p_brand
FROM part""")
def enum_remap_table_query(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    mapping = parts.select(F.col("p_brand").alias("label")).distinct().where(
        F.substring("label", 7, 10).cast("int") % 2 == 0
    ).withColumn("mapped", F.upper("label"))
    return enum_remap_join(parts, "p_brand", mapping)


@query("bool_to_tinyint", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN NULL
                        WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS is_large
FROM orders""")
def bool_to_tinyint_query(spark, sf):
    k = F.col("o_orderkey")
    df = table(spark, sf, "orders").select(
        k, F.when(k % 19 != 0, F.col("o_totalprice") > 100000).alias("is_large")
    )
    return bool_to_tinyint(df, ["is_large"]).withColumn("is_large", F.col("is_large").cast("int"))


# -- row diffs -----------------------------------------------------------------

DIFF_SQL = "SELECT o_orderkey, diff_type FROM diff"


@query("diff_rows", ORDERS_DIFF, sql=DIFF_SQL)
def diff_rows_query(spark, sf):
    return D.diff_rows(*both(spark, sf), KEY)


@query("diff_merge", ORDERS_DIFF, sql=DIFF_SQL)
def diff_merge_query(spark, sf):
    return D.diff_merge(*both(spark, sf), KEY)


@query("diff_rows_bucketed_copies", ORDERS_DIFF, sql=DIFF_SQL)
def diff_rows_bucketed_copies_query(spark, sf):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"copy_{side}_{uuid.uuid4().hex}" for side in ("left", "right")]
    copies = [write_bucketed_copy(df, name, KEY, buckets) for df, name in zip(both(spark, sf), names)]
    found = written(D.diff_stored_copies(*copies, KEY, null_keys=False), "stored-copies")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return found


@query("diff_chunked", ORDERS_DIFF, sql=DIFF_SQL)
def diff_chunked_query(spark, sf):
    return D.diff_chunked(*both(spark, sf), "o_orderkey", chunk_size=CHUNK)


@query("diff_chunked_lazy", ORDERS_DIFF, sql=DIFF_SQL)
def diff_chunked_lazy_query(spark, sf):
    return D.diff_chunked(*both(spark, sf), "o_orderkey", chunk_size=CHUNK, drill="lazy")


@query("diff_chunked_few_dirty", ORDERS, sql="""
SELECT o_orderkey, 'changed' AS diff_type FROM orders_l
WHERE o_orderkey BETWEEN 1000 AND 1999 AND o_orderkey % 89 = 0""")
def diff_chunked_few_dirty_query(spark, sf):
    left, k = orders_left(spark, sf), F.col("o_orderkey")
    hit = k.between(1000, 1999) & (k % 89 == 0)
    status = F.when(hit, F.lit("?")).otherwise(F.col("o_orderstatus"))
    return D.diff_chunked(left, left.withColumn("o_orderstatus", status), "o_orderkey",
                          chunk_size=CHUNK)


@query("diff_rows_composite_key", CONVERSATIONS, sql="""
SELECT COALESCE(l.conv_id, r.conv_id) AS conv_id, COALESCE(l.turn, r.turn) AS turn,
       CASE WHEN r.conv_id IS NULL THEN 'left_only' WHEN l.conv_id IS NULL THEN 'right_only'
            ELSE 'changed' END AS diff_type
FROM conv_l l FULL OUTER JOIN conv_r r ON l.conv_id = r.conv_id AND l.turn = r.turn
WHERE l.conv_id IS NULL OR r.conv_id IS NULL OR l.role IS DISTINCT FROM r.role
   OR l.text IS DISTINCT FROM r.text""")
def diff_rows_composite_query(spark, sf):
    left, right = table(spark, sf, "conversations"), conversations_right(spark, sf)
    return D.diff_rows(left, right, ["conv_id", "turn"])


@query("diff_rows_repeated_keys", sql="""
WITH l AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_partkey % 50 <> 0
      GROUP BY ALL)
SELECT l.l_orderkey, l.l_linenumber,
       CASE WHEN r.n IS NULL THEN 'left_only' ELSE 'changed' END AS diff_type
FROM l LEFT JOIN r USING (l_orderkey, l_linenumber) WHERE l.n IS DISTINCT FROM r.n""")
def diff_rows_repeated_keys_query(spark, sf):
    left = table(spark, sf, "lineitem")
    return D.diff_rows(left, left.where(F.col("l_partkey") % 50 != 0),
                       ["l_orderkey", "l_linenumber"])


BUCKETED_SQL = """
SELECT o_orderkey, CASE diff_type WHEN 'left_only' THEN 'missing' ELSE 'extra' END AS diff_type
FROM diff WHERE diff_type <> 'changed'"""


@query("diff_bucketed", ORDERS_DIFF, sql=BUCKETED_SQL)
def diff_bucketed_query(spark, sf):
    return D.diff_bucketed(*both(spark, sf), "o_orderkey", BUCKET)


@query("diff_bucketed_counts_only", ORDERS, sql="""
, even_l AS (SELECT o_orderkey * 2 AS k FROM orders_l),
even_r AS (SELECT CASE WHEN k % 4000 = 10 THEN k + 1 ELSE k END AS k FROM even_l
           WHERE k % 5000 <> 20),
cnt AS (SELECT COALESCE(l.b, r.b) AS b FROM
          (SELECT k // 500 AS b, count(*) AS n FROM even_l GROUP BY 1) l FULL OUTER JOIN
          (SELECT k // 500 AS b, count(*) AS n FROM even_r GROUP BY 1) r ON l.b = r.b
        WHERE l.n IS DISTINCT FROM r.n)
SELECT k AS o_orderkey, 'missing' AS diff_type FROM even_l
WHERE k // 500 IN (SELECT b FROM cnt) AND k NOT IN (SELECT k FROM even_r)
UNION ALL
SELECT k, 'extra' FROM even_r
WHERE k // 500 IN (SELECT b FROM cnt) AND k NOT IN (SELECT k FROM even_l)""")
def diff_bucketed_counts_only_query(spark, sf):
    k = F.col("o_orderkey")
    left = orders_left(spark, sf).withColumn("o_orderkey", k * 2)  # room for a key between two
    right = left.where(k % 5000 != 20).withColumn(
        "o_orderkey", F.when(k % 4000 == 10, k + 1).otherwise(k)
    )
    return D.diff_bucketed(left, right, "o_orderkey", BUCKET, exact=False)


@query("key_set_diff", CONVERSATIONS, sql="""
SELECT conv_id, turn, 'missing' AS diff_type FROM
  (SELECT conv_id, turn FROM conv_l EXCEPT SELECT conv_id, turn FROM conv_r)
UNION ALL
SELECT conv_id, turn, 'extra' FROM
  (SELECT conv_id, turn FROM conv_r EXCEPT SELECT conv_id, turn FROM conv_l)""")
def key_set_diff_query(spark, sf):
    left, right = table(spark, sf, "conversations"), conversations_right(spark, sf)
    return D.key_set_diff(left, right, ["conv_id", "turn"])


@query("key_minus", sql="""
SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0""")
def key_minus_query(spark, sf):
    kept = table(spark, sf, "customer").where(F.col("c_custkey") % 10 != 0)
    return D.key_minus(
        table(spark, sf, "orders"), kept.withColumnRenamed("c_custkey", "o_custkey"),
        ["o_custkey"],
    )


@query("column_diff", ORDERS, sql="""
SELECT l.o_orderkey, 'o_totalprice' AS "column", CAST(l.o_totalprice AS VARCHAR) AS left_value,
       CAST(r.o_totalprice AS VARCHAR) AS right_value, FALSE AS opaque
FROM orders_l l JOIN orders_r r USING (o_orderkey) WHERE l.o_totalprice <> r.o_totalprice""")
def column_diff_query(spark, sf):
    return D.column_diff(*both(spark, sf), KEY, broadcast_rows=D.BROADCAST_ROWS)


@query("changed_column_counts", sql="""
WITH r AS (
  SELECT event_id, ts + INTERVAL 1 SECOND * (CASE WHEN event_id % 41 = 0 THEN 2 ELSE 0 END) AS ts,
         CASE WHEN event_id % 43 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 47 = 0 THEN value + 1 ELSE value END AS value,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE props END AS props
  FROM events)
SELECT 'ts' AS "column", count(*) FILTER (WHERE l.ts <> r.ts) AS changed_rows
FROM events l JOIN r USING (event_id)
UNION ALL SELECT 'user_id', 0
UNION ALL SELECT 'event_type', count(*) FILTER (WHERE l.event_type IS DISTINCT FROM r.event_type)
FROM events l JOIN r USING (event_id)
UNION ALL SELECT 'value', count(*) FILTER (WHERE l.value <> r.value) FROM events l JOIN r USING (event_id)
UNION ALL SELECT 'props', count(*) FILTER (WHERE (l.props IS NULL) <> (r.props IS NULL))
FROM events l JOIN r USING (event_id)""")
def changed_column_counts_query(spark, sf):
    left, e = table(spark, sf, "events"), F.col("event_id")
    right = left.withColumns({
        "ts": F.when(e % 41 == 0, F.col("ts") + F.expr("INTERVAL '2' SECOND"))
        .otherwise(F.col("ts")),
        "event_type": F.when(e % 43 != 0, F.col("event_type")),
        "value": F.when(e % 47 == 0, F.col("value") + 1).otherwise(F.col("value")),
        "props": F.when(e % 37 != 0, F.concat("props", F.lit(" "))),
    })
    kinds = {"value": LogicalType("float8", 2), "props": "jsonb"}
    return D.changed_column_counts(left, right, ["event_id"], kinds)


@query("one_sided_inspect", sql=f"""
SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus,
       CASE WHEN o_orderkey % 103 = 0 THEN '{D.KEY_ABSENT}' ELSE '{D.SAME_KEY_OTHER_FORM}' END
         AS same_key_on_other_side
FROM orders WHERE o_orderkey % 103 = 0 OR o_orderkey % 97 = 0""")
def one_sided_inspect_query(spark, sf):
    n = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    left = orders.select(n.cast("string").alias("k"), "o_orderstatus")
    padded = F.when(n % 97 == 0, F.lpad(n.cast("string"), 30, "0")).otherwise(n.cast("string"))
    right = orders.where(n % 103 != 0).select(padded.alias("k"), "o_orderstatus")
    return D.one_sided_inspect(left, right, ["k"])


@query("fetch_rows_by_key", ORDERS_DIFF, sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice
FROM orders_r WHERE o_orderkey IN (SELECT o_orderkey FROM diff WHERE diff_type = 'changed')""")
def fetch_rows_by_key_query(spark, sf):
    left, right = both(spark, sf)
    changed = D.diff_rows(left, right, KEY).where(F.col("diff_type") == "changed")
    return D.fetch_rows_by_key(right, changed, KEY).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("string")
        .alias("o_totalprice"),
    )


@query("sample_per_diff_type", ORDERS_DIFF, sql="""
SELECT o_orderkey, diff_type, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY diff_type ORDER BY o_orderkey) AS INTEGER) AS rank
  FROM diff) WHERE rank <= 20""")
def sample_per_diff_type_query(spark, sf):
    return D.sample_per_diff_type(D.diff_rows(*both(spark, sf), KEY), KEY)


@query("ordered_samples", ORDERS_DIFF, sql="""
SELECT o_orderkey FROM diff WHERE diff_type = 'left_only' ORDER BY o_orderkey LIMIT 20""")
def ordered_samples_query(spark, sf):
    found = D.diff_rows(*both(spark, sf), KEY).where(F.col("diff_type") == "left_only")
    return D.ordered_samples(found, KEY)


@query("latest_rows_check", sql="""
WITH l AS (SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id LIMIT 50),
r AS (SELECT event_id, ts, CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS value
      FROM events WHERE event_id % 7 <> 0 ORDER BY ts DESC, event_id LIMIT 50)
SELECT COALESCE(l.event_id, r.event_id) AS event_id,
       CASE WHEN r.event_id IS NULL THEN 'left_only' WHEN l.event_id IS NULL THEN 'right_only'
            ELSE 'changed' END AS diff_type
FROM l FULL OUTER JOIN r USING (event_id) WHERE l.value IS DISTINCT FROM r.value""")
def latest_rows_check_query(spark, sf):
    e = F.col("event_id")
    left = table(spark, sf, "events").select(e, "ts", "value")
    right = left.where(e % 7 != 0).withColumn(
        "value", F.when(e % 5 == 0, F.col("value") + 1).otherwise(F.col("value"))
    )
    return D.latest_rows_check(left, right, "ts", ["event_id"], 50,
                               {"value": LogicalType("float8", 2)})


# -- digests, bounds, buckets --------------------------------------------------

SLICE_SUMS = ", ".join(
    f"CAST(SUM(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)) AS VARCHAR) AS s{i}"
    for i in range(4)
)


def _text_sums():
    return [F.col(f"s{i}").cast("string").alias(f"s{i}") for i in range(4)]


@query("chunk_digest", ORDERS, sql=f"""
SELECT CAST(floor(o_orderkey / 1000.0) AS BIGINT) AS chunk_id, count(*) AS n, {SLICE_SUMS}
FROM (SELECT o_orderkey, {orders_hash_sql()} AS h FROM orders_r) GROUP BY 1""")
def chunk_digest_query(spark, sf):
    df = orders_right(spark, sf)
    return G.chunk_digest(df, "o_orderkey", df.columns, infer_types(df), CHUNK).select(
        "chunk_id", "n", *_text_sums()
    )


@query("table_digest", ORDERS, sql=f"""
SELECT count(*) AS n, {SLICE_SUMS} FROM (SELECT {orders_hash_sql()} AS h FROM orders_l)""")
def table_digest_query(spark, sf):
    df = orders_left(spark, sf)
    return G.table_digest(df, df.columns, infer_types(df)).select("n", *_text_sums())


@query("chunk_compare", ORDERS_DIFF, sql="""
, sizes AS (
  SELECT CAST(floor(k / 1000.0) AS BIGINT) AS chunk_id, sum(l) AS n_left, sum(r) AS n_right
  FROM (SELECT k, 1 AS l, 0 AS r FROM hashed_l UNION ALL SELECT k, 0, 1 FROM hashed_r)
  GROUP BY 1)
SELECT chunk_id, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right,
       chunk_id NOT IN (SELECT CAST(floor(o_orderkey / 1000.0) AS BIGINT) FROM diff) AS same
FROM sizes""")
def chunk_compare_query(spark, sf):
    left, right = both(spark, sf)
    return G.chunk_compare(left, right, "o_orderkey", left.columns, infer_types(left), CHUNK)


@query("bucket_counts", ORDERS, sql="""
SELECT CAST(floor((o_orderkey - (SELECT min(o_orderkey) FROM orders_r)) / 500.0) AS BIGINT)
         AS bucket, count(*) AS n
FROM orders_r GROUP BY 1""")
def bucket_counts_query(spark, sf):
    left, right = both(spark, sf)
    return G.bucket_counts(right, "o_orderkey", G._origin(left, right, "o_orderkey"), BUCKET)


@query("snapshot_bound", ORDERS, sql="""
, early AS (SELECT * FROM orders_l
            WHERE o_orderkey <= (SELECT max(o_orderkey) * 9 // 10 FROM orders_l))
SELECT COALESCE(l.o_orderkey, r.o_orderkey) AS o_orderkey,
       CASE WHEN r.o_orderkey IS NULL THEN 'left_only' WHEN l.o_orderkey IS NULL THEN 'right_only'
            ELSE 'changed' END AS diff_type
FROM early l FULL OUTER JOIN
     (SELECT * FROM orders_r WHERE o_orderkey <= (SELECT max(o_orderkey) FROM early)) r
  ON l.o_orderkey = r.o_orderkey
WHERE l.o_totalprice IS DISTINCT FROM r.o_totalprice""")
def snapshot_bound_query(spark, sf):
    left, right = both(spark, sf)
    top = left.agg(floor_div(F.max("o_orderkey") * 9, 10).alias("t")).scalar()
    early = left.where(F.col("o_orderkey") <= top)
    return D.diff_rows(*G.snapshot_bound(early, right, "o_orderkey"), KEY)


@query("key_range", sql="""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderkey >= (SELECT max(o_orderkey) // 4 FROM orders)
  AND o_orderkey < (SELECT max(o_orderkey) * 3 // 4 FROM orders)""")
def key_range_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    top = F.max("o_orderkey")
    lo = orders.agg(floor_div(top, 4).alias("lo")).scalar()
    hi = orders.agg(floor_div(top * 3, 4).alias("hi")).scalar()
    return G.key_range(orders, "o_orderkey", lo, hi, half_open=True)


# -- whole comparisons ---------------------------------------------------------


def _pairs(spark, sf):
    left, right = both(spark, sf)
    events = table(spark, sf, "events")
    customers = table(spark, sf, "customer")
    k = F.col("c_custkey")
    spelled = customers.withColumn("c_custkey", k.cast("string"))
    padded = spelled.withColumn(
        "c_custkey",
        F.when(k.cast("bigint") % 50 == 0, F.lpad("c_custkey", 20, "0"))
        .otherwise(F.col("c_custkey")),
    )
    money = {"c_acctbal": LogicalType("float8", 2)}
    return [
        TablePair("orders", left, right, KEY),
        TablePair("conversations", table(spark, sf, "conversations"),
                  conversations_right(spark, sf), ["conv_id", "turn"]),
        TablePair("events", events, events, ["event_id"]),
        TablePair("customer", spelled, padded, ["c_custkey"], money),
        TablePair("lineitem", table(spark, sf, "lineitem"), table(spark, sf, "lineitem"), []),
        TablePair("part", table(spark, sf, "part"),
                  table(spark, sf, "part").withColumnRenamed("p_partkey", "id"), ["p_partkey"]),
        TablePair("flyway_schema_history", events, events, ["event_id"]),
    ]


SUMMARY_CTES = ORDERS_DIFF.strip() + "," + CONVERSATIONS.strip() + """,
conv_diff AS (
  SELECT CASE WHEN r.conv_id IS NULL THEN 'left_only' WHEN l.conv_id IS NULL THEN 'right_only'
              ELSE 'changed' END AS diff_type
  FROM conv_l l FULL OUTER JOIN conv_r r ON l.conv_id = r.conv_id AND l.turn = r.turn
  WHERE l.text IS DISTINCT FROM r.text),
results AS (
  SELECT 'orders' AS table_name, 'DIFF' AS status, count(*) FILTER (WHERE diff_type = 'left_only') AS left_only,
         count(*) FILTER (WHERE diff_type = 'right_only') AS right_only,
         count(*) FILTER (WHERE diff_type = 'changed') AS changed FROM diff
  UNION ALL
  SELECT 'conversations', 'DIFF', count(*) FILTER (WHERE diff_type = 'left_only'),
         count(*) FILTER (WHERE diff_type = 'right_only'), count(*) FILTER (WHERE diff_type = 'changed') FROM conv_diff
  UNION ALL SELECT 'events', 'OK', 0, 0, 0
  UNION ALL
  SELECT 'customer', 'DIFF', count(*), count(*), 0 FROM customer WHERE c_custkey % 50 = 0
  UNION ALL SELECT 'lineitem', 'SKIP-PK', NULL, NULL, NULL
  UNION ALL SELECT 'part', 'SKIP-PK', NULL, NULL, NULL)
"""
RESULTS_SQL = """
SELECT table_name, status, CAST(left_only AS BIGINT) AS left_only,
       CAST(right_only AS BIGINT) AS right_only, CAST(changed AS BIGINT) AS changed FROM results"""


@query("reconcile_tables", SUMMARY_CTES, sql=RESULTS_SQL)
def reconcile_tables_query(spark, sf):
    return reconcile(_pairs(spark, sf), bounded=False)


@query("reconcile_each_table", SUMMARY_CTES, sql=RESULTS_SQL.replace(
    " FROM results", ", CAST(NULL AS VARCHAR) AS error FROM results"))
def reconcile_each_table_query(spark, sf):
    return reconcile_each(_pairs(spark, sf), bounded=False)


@query("reconcile_summary", SUMMARY_CTES, sql="""
SELECT table_name, status, CAST(left_only AS BIGINT) AS left_only,
       CAST(right_only AS BIGINT) AS right_only, CAST(changed AS BIGINT) AS changed,
       COALESCE(left_only > 0 AND left_only = right_only AND changed = 0, FALSE)
         AS key_representation_suspect
FROM results
UNION ALL
SELECT 'TOTAL', 'FAIL', CAST(sum(left_only) AS BIGINT), CAST(sum(right_only) AS BIGINT),
       CAST(sum(changed) AS BIGINT),
       COALESCE(bool_or(left_only > 0 AND left_only = right_only AND changed = 0), FALSE)
FROM results""")
def reconcile_summary_query(spark, sf):
    return reconcile_summary(reconcile(_pairs(spark, sf), bounded=False))


@query("reconcile_samples", ORDERS_DIFF, CONVERSATIONS, sql="""
, conv AS (
  SELECT COALESCE(l.conv_id, r.conv_id) AS conv_id, COALESCE(l.turn, r.turn) AS turn,
         CASE WHEN r.conv_id IS NULL THEN 'left_only' WHEN l.conv_id IS NULL THEN 'right_only'
              ELSE 'changed' END AS diff_type
  FROM conv_l l FULL OUTER JOIN conv_r r ON l.conv_id = r.conv_id AND l.turn = r.turn
  WHERE l.text IS DISTINCT FROM r.text),
spelled AS (
  SELECT diff_type, CASE diff_type WHEN 'left_only' THEN CAST(c_custkey AS VARCHAR)
         ELSE lpad(CAST(c_custkey AS VARCHAR), 20, '0') END AS key
  FROM customer, (VALUES ('left_only'), ('right_only')) t(diff_type) WHERE c_custkey % 50 = 0),
numbered AS (
  SELECT 'orders' AS table_name, diff_type, CAST(o_orderkey AS VARCHAR) AS key,
         row_number() OVER (PARTITION BY diff_type ORDER BY o_orderkey) AS rank FROM diff
  UNION ALL
  SELECT 'conversations', diff_type, CAST(conv_id AS VARCHAR) || chr(28) || CAST(turn AS VARCHAR),
         row_number() OVER (PARTITION BY diff_type ORDER BY conv_id, turn) FROM conv
  UNION ALL
  SELECT 'customer', diff_type, key, row_number() OVER (PARTITION BY diff_type ORDER BY key) FROM spelled)
SELECT table_name, diff_type, CAST(rank AS INTEGER) AS rank, key FROM numbered WHERE rank <= 10""")
def reconcile_samples_query(spark, sf):
    return samples(_pairs(spark, sf), n=10, bounded=False)


def _with_null_keys(spark, sf):
    """Both copies of orders, some keys of which are NULL, one of them changed."""
    left, right = both(spark, sf)
    k = F.col("o_orderkey")
    lost = F.when(k % 5000 != 7, k).alias("o_orderkey")
    rest = [c for c in left.columns if c != "o_orderkey"]
    changed = F.when(k % 5000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return left.select(lost, *rest), right.withColumn("o_totalprice", changed).select(lost, *rest)


# With the NULL keys as one more row of the diff: all of them belong to one key.
NULL_KEY_DIFF = """
, keyed AS (SELECT o_orderkey, diff_type FROM diff WHERE o_orderkey % 5000 <> 7
            UNION ALL SELECT NULL, 'changed' WHERE EXISTS (SELECT 1 FROM orders_l WHERE o_orderkey % 5000 = 7))
"""


@query("reconcile_bounded", ORDERS_DIFF, sql=NULL_KEY_DIFF + """
SELECT 'orders' AS table_name, 'DIFF' AS status,
       count(*) FILTER (WHERE diff_type = 'left_only') AS left_only,
       count(*) FILTER (WHERE diff_type = 'right_only' AND o_orderkey <= (SELECT max(o_orderkey) FROM orders_l)) AS right_only,
       count(*) FILTER (WHERE diff_type = 'changed') AS changed FROM keyed""")
def reconcile_bounded_query(spark, sf):
    left, right = _with_null_keys(spark, sf)
    return reconcile([TablePair("orders", left, right, KEY)])


@query("missing_rows_mixed_keys", sql="""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey % 50 = 0 OR c_custkey % 7 = 3""")
def missing_rows_mixed_keys_query(spark, sf):
    left = table(spark, sf, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey").cast("string")
    padded = F.when(F.col("c_custkey") % 50 == 0, F.concat(F.lit("00"), k)).otherwise(k)
    right = left.where(F.col("c_custkey") % 7 != 3).select(padded.alias("c_custkey"))
    return D.missing_rows(left, right, ["c_custkey"], broadcast_rows=D.BROADCAST_ROWS)


@query("diff_bucketed_null_keys", ORDERS_DIFF, sql="""
SELECT o_orderkey, CASE diff_type WHEN 'left_only' THEN 'missing' ELSE 'extra' END AS diff_type
FROM diff WHERE diff_type <> 'changed'
UNION ALL SELECT NULL, 'missing'""")
def diff_bucketed_null_keys_query(spark, sf):
    left, right = both(spark, sf)
    keyless = left.orderBy("o_orderkey").limit(1).withColumn("o_orderkey", F.lit(None).cast(left.schema["o_orderkey"].dataType))
    return D.diff_bucketed(left.unionByName(keyless), right, "o_orderkey", BUCKET)


@query("column_diff_null_keys", ORDERS_DIFF, sql="""
SELECT l.o_orderkey, 'o_totalprice' AS "column", CAST(l.o_totalprice AS VARCHAR) AS left_value,
       CAST(r.o_totalprice AS VARCHAR) AS right_value, FALSE AS opaque
FROM orders_l l JOIN orders_r r USING (o_orderkey) WHERE l.o_totalprice <> r.o_totalprice
UNION ALL
SELECT NULL, 'o_totalprice', CAST(o_totalprice AS VARCHAR), CAST(o_totalprice + 1 AS VARCHAR), FALSE
FROM orders_l WHERE o_orderkey % 1000000 = 7""")
def column_diff_null_keys_query(spark, sf):
    left, right = both(spark, sf)
    k = F.col("o_orderkey")
    one = left.where(k % 1_000_000 == 7).withColumn("o_orderkey", F.when(k % 1_000_000 != 7, k))
    more = one.withColumn("o_totalprice", (F.col("o_totalprice") + 1).cast(right.schema["o_totalprice"].dataType))
    return D.column_diff(left.unionByName(one), right.unionByName(more), KEY, broadcast_rows=D.BROADCAST_ROWS)


@query("diff_rows_mixed_types", sql="""
SELECT event_id, 'changed' AS diff_type FROM events WHERE event_id % 13 = 0
UNION ALL
SELECT event_id, 'left_only' FROM events WHERE event_id % 17 = 0 AND event_id % 13 <> 0""")
def diff_rows_mixed_types_query(spark, sf):
    """Decimals of two scales, a number and a decimal, timestamps and text with offsets."""
    e, instant = F.col("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id"))
    left = table(spark, sf, "events").select(
        e, (e / 4).cast("decimal(18,2)").alias("price"), F.col("user_id").cast("bigint").alias("user_id"),
        instant.alias("seen"))
    text = F.concat(F.date_format(instant + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    more = F.when(e % 13 == 0, F.lit(1)).otherwise(F.lit(0))
    right = left.where((e % 17 != 0) | (e % 13 == 0)).select(
        e, (F.col("price") + more).cast("decimal(20,4)").alias("price"),
        F.col("user_id").cast("decimal(12,3)").alias("user_id"), text.alias("seen"))
    types = {"event_id": "int8", "price": "numeric", "user_id": "numeric", "seen": "timestamptz"}
    return D.diff_rows(left, right, ["event_id"], types)


# Catalog rows made of parts: eight columns a table, some of them, and some keys, on one side only.
CATALOG = """
cols AS (SELECT 't_' || (p_partkey // 8) AS t, 'c_' || (p_partkey % 8) AS c, p_partkey % 8 AS i, p_partkey // 8 AS n,
                CASE p_partkey % 3 WHEN 0 THEN 'int8' WHEN 1 THEN 'text' ELSE 'numeric' END AS udt,
                p_partkey % 11 <> 0 AND (p_partkey // 8) % 19 <> 3 AS l, p_partkey % 13 <> 0 AS r FROM part),
tabs AS (SELECT DISTINCT t, n % 23 <> 5 AS l, n % 29 <> 7 AS r FROM cols),
pk AS (SELECT t, c, i, TRUE AS l, n % 7 <> 0 AS r FROM cols WHERE i = 0 OR (i = 1 AND n % 5 = 0))
"""


@query("pairs_from_catalog", CATALOG, sql="""
, k AS (SELECT t, coalesce(string_agg(c, ',' ORDER BY i) FILTER (WHERE l), '') AS lk,
               coalesce(string_agg(c, ',' ORDER BY i) FILTER (WHERE r), '') AS rk,
               count(*) FILTER (WHERE l) AS nk FROM pk GROUP BY t),
m AS (SELECT t, string_agg(c || ':' || udt, ',' ORDER BY c) AS columns FROM cols WHERE l AND r GROUP BY t),
inside AS (SELECT pk.t, count(*) AS n FROM pk JOIN cols ON pk.t = cols.t AND pk.c = cols.c
           WHERE pk.l AND cols.l AND cols.r GROUP BY 1)
SELECT tabs.t AS table_name, coalesce(lk, '') AS keys, coalesce(m.columns, '') AS columns,
       CASE WHEN coalesce(lk, '') = '' OR lk <> rk THEN 'SKIP-PK' WHEN m.columns IS NULL THEN 'SKIP-COL'
            WHEN coalesce(inside.n, 0) < nk THEN 'SKIP-PK' END AS skip_reason
FROM tabs LEFT JOIN k USING (t) LEFT JOIN m USING (t) LEFT JOIN inside USING (t) WHERE tabs.l AND tabs.r""")
def pairs_from_catalog_query(spark, sf):
    p = F.col("p_partkey").cast("bigint")
    n, i = floor_div(p, 8), p % 8
    cols = table(spark, sf, "part").select(
        F.concat(F.lit("t_"), n).alias("table_name"), F.concat(F.lit("c_"), i).alias("column_name"),
        (i + 1).alias("ordinal_position"), n.alias("n"),
        F.when(p % 3 == 0, "int8").when(p % 3 == 1, "text").otherwise("numeric").alias("udt_name"),
        ((p % 11 != 0) & (n % 19 != 3)).alias("l"), (p % 13 != 0).alias("r"))

    def sides(df, *names):
        left, right = (df.where(c).select(F.lit(side).alias("side"), *names) for c, side in (("l", "left"), ("r", "right")))
        return left.unionByName(right)

    tables = cols.select("table_name", (F.col("n") % 23 != 5).alias("l"), (F.col("n") % 29 != 7).alias("r")).distinct()
    first = F.col("ordinal_position")
    keys = cols.where((first == 1) | ((first == 2) & (F.col("n") % 5 == 0))).withColumns(
        {"l": F.lit(True), "r": F.col("n") % 7 != 0, "constraint_type": F.lit("PRIMARY KEY")})
    plan = comparison_plan(
        sides(tables, "table_name"), sides(keys, "table_name", "constraint_type", "column_name", "ordinal_position"),
        sides(cols, "table_name", "column_name", "udt_name"))
    shown = F.concat_ws(",", F.transform("columns", lambda c: F.concat(c["column_name"], F.lit(":"), c["udt"])))
    return plan.select("table_name", F.concat_ws(",", "keys").alias("keys"), shown.alias("columns"), "skip_reason")
