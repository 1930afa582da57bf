"""Audits, catalogue checks, conversions with rejects, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from twinledger.functions.transforms import is_zero_date
from twinledger.operators import audit as A
from twinledger.operators import catalog as C
from twinledger.operators.balance import written
from twinledger.operators.diff import BROADCAST_ROWS, diff_rows, key_set_diff, missing_rows
from twinledger.operators.loading import SourceColumn, cast_for_target, load_observed, load_with_rejects, loaded
from twinledger.plans.load_check import fast_counts, fast_counts_from_statistics
from twinledger.queries.diff_queries import KEY, both
from twinledger.queries.inputs import (
    DIRTY,
    ORDERS,
    ORDERS_DIFF,
    dirty_orders,
    orders_left,
    table,
)
from twinledger.queries.registry import query
from twinledger.session import scratch_path
from twinledger.sources.sinks import write_key_list, write_missing_rows, write_report
from twinledger.sources.tables import read_table

# -- audits --------------------------------------------------------------------

COUNTED = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "created", "shipped", "billed"]


@query("null_audit", DIRTY, sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'clean' ELSE 'dirty' END AS verdict FROM dirty"
    for c in COUNTED))
def null_audit_query(spark, sf):
    return A.null_audit(dirty_orders(spark, sf), COUNTED)


@query("zero_date_rows", DIRTY, sql="""
SELECT o_orderkey, created FROM dirty WHERE created LIKE '0000-00-00%'""")
def zero_date_rows_query(spark, sf):
    return dirty_orders(spark, sf).where(is_zero_date("created")).select("o_orderkey", "created")


@query("zero_date_check", DIRTY, sql="""
, r AS (
  SELECT CASE WHEN created LIKE '0000%' THEN NULL ELSE created END AS created,
         CASE WHEN shipped LIKE '0000%' AND o_orderkey % 2 = 0 THEN NULL ELSE shipped END AS shipped
  FROM dirty),
n AS (
  SELECT 'created' AS c, (SELECT count(*) FILTER (WHERE created LIKE '0000%') FROM dirty) AS zeros,
         (SELECT count(*) FILTER (WHERE created IS NULL) FROM dirty) AS left_nulls,
         (SELECT count(*) FILTER (WHERE created IS NULL) FROM r) AS right_nulls
  UNION ALL
  SELECT 'shipped', (SELECT count(*) FILTER (WHERE shipped LIKE '0000%') FROM dirty),
         (SELECT count(*) FILTER (WHERE shipped IS NULL) FROM dirty), (SELECT count(*) FILTER (WHERE shipped IS NULL) FROM r))
SELECT c AS "column", zeros, left_nulls, right_nulls,
       CASE WHEN right_nulls >= zeros + left_nulls THEN 'OK'
            WHEN right_nulls >= left_nulls THEN 'PARTIAL' ELSE 'MISMATCH' END AS status,
       CASE WHEN right_nulls < zeros + left_nulls AND right_nulls >= left_nulls
            THEN zeros + left_nulls - right_nulls ELSE 0 END AS shortfall
FROM n WHERE zeros > 0""")
def zero_date_check_query(spark, sf):
    left = dirty_orders(spark, sf)
    lost = is_zero_date("shipped") & (F.col("o_orderkey") % 2 == 0)
    right = left.withColumns({
        "created": F.when(~is_zero_date("created"), F.col("created")),
        "shipped": F.when(~lost, F.col("shipped")),
    })
    return A.zero_date_check(left, right, ["created", "shipped", "billed"])


@query("max_text_length", DIRTY, sql="""
SELECT 'o_orderstatus' AS "column", max(length(o_orderstatus)) AS max_length,
       CAST(64 AS BIGINT) AS "limit", count(*) FILTER (WHERE length(o_orderstatus) > 64) AS too_long,
       count(*) FILTER (WHERE length(o_orderstatus) > 64) > 0 AS would_truncate FROM dirty
UNION ALL
SELECT 'o_orderpriority', max(length(o_orderpriority)), CAST(20 AS BIGINT),
       count(*) FILTER (WHERE length(o_orderpriority) > 20), count(*) FILTER (WHERE length(o_orderpriority) > 20) > 0
FROM dirty""")
def max_text_length_query(spark, sf):
    return A.max_text_length(
        dirty_orders(spark, sf), {"o_orderstatus": 64, "o_orderpriority": 20}
    )


@query("max_text_length_documents", sql="""
SELECT 'text' AS "column", max(length(text)) AS max_length, CAST(5000 AS BIGINT) AS "limit",
       count(*) FILTER (WHERE length(text) > 5000) AS too_long, count(*) FILTER (WHERE length(text) > 5000) > 0
         AS would_truncate FROM documents""")
def max_text_length_documents_query(spark, sf):
    return A.max_text_length(table(spark, sf, "documents"), {"text": 5000})


@query("enum_label_diff", sql="""
WITH l AS (SELECT DISTINCT o_orderpriority AS label FROM orders),
r AS (SELECT DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN '5-MINOR' ELSE o_orderpriority END
        AS label FROM orders)
SELECT COALESCE(l.label, r.label) AS label,
       CASE WHEN r.label IS NULL THEN 'left_only' WHEN l.label IS NULL THEN 'right_only'
            ELSE 'both' END AS side
FROM l FULL OUTER JOIN r ON l.label = r.label""")
def enum_label_diff_query(spark, sf):
    left, p = table(spark, sf, "orders"), F.col("o_orderpriority")
    right = left.withColumn("o_orderpriority", F.when(p == "5-LOW", F.lit("5-MINOR")).otherwise(p))
    return A.enum_label_diff(left, right, "o_orderpriority")


@query("decimal_exactness", ORDERS, sql="""
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS left_value,
       CAST(CAST(o_totalprice AS DECIMAL(18,4)) + CAST(0.0001 AS DECIMAL(18,4)) AS VARCHAR)
         AS right_value
FROM orders_l WHERE o_orderkey % 61 = 0""")
def decimal_exactness_query(spark, sf):
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,4)")
    base = orders_left(spark, sf)
    left = base.select(k, price.alias("price"))
    off = (price + F.lit("0.0001").cast("decimal(18,4)")).cast("decimal(18,4)")
    right = base.select(k, F.when(k % 61 == 0, off).otherwise(price).alias("price"))
    found = A.decimal_exactness(left, right, KEY, "price")
    return found.select(
        k, F.col("left_value").cast("string").alias("left_value"),
        F.col("right_value").cast("string").alias("right_value"),
    )


@query("json_equal", sql="""
SELECT event_id,
       CASE WHEN event_id % 7 = 0 AND event_id % 11 = 0 THEN 'invalid_both'
            WHEN event_id % 11 = 0 THEN 'invalid_left'
            WHEN event_id % 7 = 0 THEN 'invalid_right'
            WHEN event_id % 13 = 0 THEN 'different'
            WHEN event_id % 17 = 0 THEN 'different'
            WHEN event_id % 19 = 0 THEN 'different'
            ELSE 'equal' END AS verdict
FROM events""")
def json_equal_query(spark, sf):
    e = F.col("event_id")
    number = F.get_json_object("props", "$.k")
    base = table(spark, sf, "events")
    plain = F.concat(F.lit('{"k": '), number, F.lit(', "z": [1, 2]}'))
    # other spellings of the same numbers: an exponent on every fifth row
    spelled = F.when(e % 5 == 0, F.concat(number, F.lit(".0E+0"))).otherwise(F.concat(number, F.lit(".0")))
    turned = F.concat(F.lit('{"z":[1,2.0],"k":'), spelled, F.lit("}"))
    near = F.concat(F.lit('{"z":[1,2.00000000000000000000000001],"k":'), spelled, F.lit("}"))
    left = base.select(e, F.when(e % 11 == 0, F.lit("{bad")).otherwise(plain).alias("doc"))
    right = base.select(
        e,
        F.when(e % 7 == 0, F.lit("not json"))
        .when(e % 13 == 0, F.lit('{"k": -1}'))
        .when(e % 17 == 0, None)
        .when(e % 19 == 0, near)
        .otherwise(turned).alias("doc"),
    )
    return A.json_equal(left, right, ["event_id"], "doc")


@query("replacement_char_scan", DIRTY, sql="""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM dirty
WHERE contains(o_orderpriority, chr(65533)) OR contains(o_orderstatus, chr(65533))""")
def replacement_char_scan_query(spark, sf):
    return A.replacement_char_scan(
        dirty_orders(spark, sf), ["o_orderpriority", "o_orderstatus"], KEY
    )


@query("replacement_char_count", sql="""
SELECT count(*) FILTER (WHERE contains(text, chr(65533))) AS corrupted FROM documents""")
def replacement_char_count_query(spark, sf):
    return A.replacement_char_count(table(spark, sf, "documents"), ["text"])


@query("non_ascii_scan", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE strlen({c}) <> length({c})) AS non_ascii_rows, "
    f"CASE WHEN count(*) FILTER (WHERE strlen({c}) <> length({c})) > 0 THEN 'RISK' ELSE 'OK' END AS verdict "
    "FROM documents" for c in ("text", "lang", "source")))
def non_ascii_scan_query(spark, sf):
    return A.non_ascii_scan(table(spark, sf, "documents"), ["text", "lang", "source"])


def _key_audit_sql(keys: str, source: str) -> str:
    any_null = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return f"""
WITH g AS (SELECT {keys}, count(*) AS n, bool_or({any_null}) AS has_null FROM {source}
           GROUP BY {keys})
SELECT CAST(sum(n) AS BIGINT) AS rows,
       CAST(COALESCE(sum(n) FILTER (WHERE has_null), 0) AS BIGINT) AS null_keys,
       count(*) FILTER (WHERE NOT has_null AND n > 1) AS duplicate_keys,
       CAST(COALESCE(sum(n - 1) FILTER (WHERE NOT has_null AND n > 1), 0) AS BIGINT) AS surplus_rows,
       CASE WHEN count(*) FILTER (WHERE has_null OR n > 1) > 0 THEN 'unusable' ELSE 'usable' END
         AS verdict
FROM g"""


@query("key_audit_lineitem", sql=_key_audit_sql("l_orderkey, l_linenumber", "lineitem"))
def key_audit_lineitem_query(spark, sf):
    return A.key_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("key_audit_conversations", sql=_key_audit_sql("conv_id, turn", "conversations"))
def key_audit_conversations_query(spark, sf):
    return A.key_audit(table(spark, sf, "conversations"), ["conv_id", "turn"])


def _orders_with_orphans(spark, sf):
    k = F.col("o_orderkey")
    fk = (
        F.when(k % 113 == 0, -F.col("o_custkey") - 1).when(k % 3 == 0, F.lit(-7))
        .when(k % 127 != 0, F.col("o_custkey"))
    )
    return table(spark, sf, "orders").select(k, fk.alias("o_custkey"))


ORPHANS = """
child AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 113 = 0 THEN -o_custkey - 1
                          WHEN o_orderkey % 3 = 0 THEN -7
                          WHEN o_orderkey % 127 <> 0 THEN o_custkey END AS o_custkey
  FROM orders),
orphans AS (SELECT * FROM child WHERE o_custkey IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey))
"""


@query("fk_orphans", ORPHANS, sql="SELECT o_orderkey, o_custkey FROM orphans")
def fk_orphans_query(spark, sf):
    return A.fk_orphans(_orders_with_orphans(spark, sf), ["o_custkey"],
                        table(spark, sf, "customer"), ["c_custkey"])


@query("fk_orphan_summary", ORPHANS, sql="""
SELECT o_custkey, count(*) AS orphan_rows FROM orphans GROUP BY 1""")
def fk_orphan_summary_query(spark, sf):
    return A.fk_orphan_summary(_orders_with_orphans(spark, sf), ["o_custkey"],
                               table(spark, sf, "customer"), ["c_custkey"])


@query("parent_total_reconcile", sql="""
WITH items AS (
  SELECT l_orderkey, CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS amount
  FROM lineitem),
sums AS (SELECT l_orderkey, sum(amount) AS s FROM items GROUP BY 1),
parents AS (
  SELECT o_orderkey,
         COALESCE(s, 0) + CASE WHEN o_orderkey % 71 = 0 THEN 5
                               WHEN o_orderkey % 73 = 0 THEN 0.005 ELSE 0 END AS total
  FROM orders LEFT JOIN sums ON l_orderkey = o_orderkey)
SELECT o_orderkey, CAST(CAST(total AS DECIMAL(28,4)) AS VARCHAR) AS stated_total,
       CAST(CAST(COALESCE(s, 0) AS DECIMAL(28,4)) AS VARCHAR) AS item_total
FROM parents LEFT JOIN sums ON l_orderkey = o_orderkey
WHERE abs(total - COALESCE(s, 0)) > 0.01""")
def parent_total_reconcile_query(spark, sf):
    k = F.col("o_orderkey")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    amount = F.col("l_quantity").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)")
    sums = items.groupBy("l_orderkey").agg(F.sum(amount).alias("_s"))
    drift = F.when(k % 71 == 0, F.lit("5.000")).when(k % 73 == 0, F.lit("0.005")).otherwise("0")
    parents = (
        table(spark, sf, "orders").select(k).join(sums, k == F.col("l_orderkey"), "left")
        .select(k, (F.coalesce("_s", F.lit(0)).cast("decimal(28,4)")
                    + drift.cast("decimal(28,4)")).alias("total"))
    )
    found = A.parent_total_reconcile(
        parents, items, "o_orderkey", "l_orderkey", "total", amount, "0.01"
    )
    return found.select(k, *[
        F.col(c).cast("decimal(28,4)").cast("string").alias(c)
        for c in ("stated_total", "item_total")
    ])


# -- conversion ----------------------------------------------------------------


@query("cast_for_target", sql="""
SELECT o_orderkey AS id, o_orderkey % 3 <> 0 AS flag, o_custkey AS uint,
       CAST(o_orderkey AS VARCHAR) AS ubig,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
       CASE WHEN o_orderkey % 211 = 0 THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created,
       CASE WHEN o_orderkey % 227 = 0 THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS shipped
FROM orders""")
def cast_for_target_query(spark, sf):
    k = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    source = table(spark, sf, "orders").select(
        k.alias("id"),
        (k % 3).cast("string").alias("flag"),
        F.col("o_custkey").cast("string").alias("uint"),
        k.cast("string").alias("ubig"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.when(k % 211 == 0, F.lit("0000-00-00 00:00:00")).otherwise(stamp).alias("created"),
        F.when(k % 227 == 0, F.lit("0000-00-00")).otherwise(day).alias("shipped"),
    )
    target = cast_for_target(source, [
        SourceColumn("flag", "tinyint", "tinyint(1)"),
        SourceColumn("uint", "int", "int unsigned"),
        SourceColumn("ubig", "bigint", "bigint unsigned"),
        SourceColumn("amount", "decimal", "decimal(18,2)", 18, 2),
        SourceColumn("created", "datetime", "datetime"),
        SourceColumn("shipped", "date", "date"),
    ])
    return target.select(
        "id", "flag", "uint", F.col("ubig").cast("string").alias("ubig"),
        F.col("amount").cast("string").alias("amount"),
        F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.date_format("shipped", "yyyy-MM-dd").alias("shipped"),
    )


def _raw_load(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k,
        F.when(k % 127 == 0, F.lit("abc")).otherwise(F.col("o_custkey").cast("string"))
        .alias("cust"),
        F.when(k % 131 == 0, F.lit("2020-13-45")).when(k % 7 == 0, None)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )


CASTS = {"cust": "bigint", "day": "date"}


@query("load_good_rows", sql="""
SELECT o_orderkey, o_custkey AS cust,
       CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders WHERE o_orderkey % 127 <> 0 AND o_orderkey % 131 <> 0""")
def load_good_rows_query(spark, sf):
    good, _ = load_with_rejects(_raw_load(spark, sf), CASTS)
    return good.withColumn("day", F.col("day").cast("string"))


@query("load_rejects", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 127 = 0 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END
         AS cust,
       CASE WHEN o_orderkey % 131 = 0 THEN '2020-13-45' WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
       'not convertible: ' ||
       CASE WHEN o_orderkey % 127 = 0 AND o_orderkey % 131 = 0 THEN 'cust, day'
            WHEN o_orderkey % 127 = 0 THEN 'cust' ELSE 'day' END AS reject_reason
FROM orders WHERE o_orderkey % 127 = 0 OR o_orderkey % 131 = 0""")
def load_rejects_query(spark, sf):
    return load_with_rejects(_raw_load(spark, sf), CASTS)[1]


@query("load_observed", sql="""
SELECT count(*) AS total, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS rejected,
       count(*) FILTER (WHERE good) AS good_rows, count(*) FILTER (WHERE NOT good) AS reject_rows,
       CAST(sum(CASE WHEN good THEN o_custkey END) AS BIGINT) AS custs
FROM (SELECT o_custkey, o_orderkey % 127 <> 0 AND o_orderkey % 131 <> 0 AS good FROM orders)""")
def load_observed_query(spark, sf):
    raw, target = _raw_load(spark, sf), scratch_path(spark, "loaded")
    counts = load_observed(raw, CASTS, target)
    good, rejects = loaded(raw, CASTS, target)
    shown = [F.lit(counts[c]).cast("bigint").alias(c) for c in ("total", "good", "rejected")]
    both = good.select(F.lit(1).alias("g"), "cust").unionByName(rejects.select(F.lit(0).alias("g"), F.lit(None).cast("bigint").alias("cust")))
    return both.agg(F.count_if(F.col("g") == 1).alias("good_rows"), F.count_if(F.col("g") == 0).alias("reject_rows"),
                    F.sum("cust").alias("custs")).select(*shown, "good_rows", "reject_rows", "custs")


# -- catalogue checks ----------------------------------------------------------
#
# The part table stands in for a catalogue: a part is a column, its brand is the
# table the column belongs to.

SOURCE_TYPES = [
    ("tinyint", "tinyint(1)", "bool", None), ("smallint", "smallint", "int2", None),
    ("int", "int", "int4", None), ("int", "int unsigned", "int8", None),
    ("bigint", "bigint", "int8", None), ("bigint", "bigint unsigned", "numeric", None),
    ("varchar", "varchar(64)", "varchar", 64), ("char", "char(3)", "bpchar", 3),
    ("datetime", "datetime", "timestamptz", None), ("json", "json", "jsonb", None),
    ("decimal", "decimal(10,2)", "numeric", None), ("geometry", "geometry", "point", None),
]


def _catalogues(spark, sf):
    p = F.col("p_partkey")
    position = (p % len(SOURCE_TYPES) + 1).cast("int")

    def pick(i):
        return F.element_at(F.array(*[F.lit(t[i]) for t in SOURCE_TYPES]), position)

    parts = table(spark, sf, "part").select(
        p, F.col("p_brand").alias("table_name"),
        F.concat(F.lit("c_"), p.cast("string")).alias("column_name"),
    )
    left = parts.where(p % 37 != 0).select(
        "table_name", "column_name", pick(0).alias("data_type"), pick(1).alias("column_type")
    )
    right = parts.where(p % 31 != 0).select(
        "table_name", "column_name",
        F.when(p % 29 == 0, F.lit("text")).otherwise(pick(2)).alias("udt_name"),
        F.when(p % 29 != 0, pick(3)).alias("char_max_len"),
    )
    return left, right


@query("column_name_diff", sql="""
SELECT p_brand AS table_name, 'c_' || p_partkey AS column_name,
       CASE WHEN p_partkey % 31 = 0 THEN 'left_only' ELSE 'right_only' END AS presence
FROM part WHERE (p_partkey % 37 = 0) <> (p_partkey % 31 = 0)""")
def column_name_diff_query(spark, sf):
    return C.column_name_diff(*_catalogues(spark, sf))


_SQL_TYPES = "[" + ", ".join(f"'{t[1]}'" for t in SOURCE_TYPES) + "]"


@query("column_type_check", sql=f"""
WITH c AS (
  SELECT p_partkey AS p, p_brand AS table_name, 'c_' || p_partkey AS column_name,
         {_SQL_TYPES}[CAST(p_partkey % 12 AS INTEGER) + 1] AS column_type,
         ['bool', 'int2', 'int4', 'int8', 'int8', 'numeric', 'varchar(64)', 'bpchar(3)',
          'timestamptz', 'json jsonb', 'numeric', NULL][CAST(p_partkey % 12 AS INTEGER) + 1]
           AS expected_type,
         CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN 'text' ELSE
         ['bool', 'int2', 'int4', 'int8', 'int8', 'numeric', 'varchar(64)', 'bpchar(3)',
          'timestamptz', 'jsonb', 'numeric', 'point'][CAST(p_partkey % 12 AS INTEGER) + 1] END
           AS actual_type
  FROM part WHERE p_partkey % 37 <> 0)
SELECT table_name, column_name, column_type, expected_type, actual_type,
       CASE WHEN actual_type IS NULL THEN 'left_only' WHEN expected_type IS NULL THEN 'skipped'
            WHEN list_contains(string_split(expected_type, ' '), actual_type) THEN 'match'
            ELSE 'mismatch' END AS status
FROM c""")
def column_type_check_query(spark, sf):
    return C.column_type_check(*_catalogues(spark, sf))


@query("not_null_candidates", sql="""
SELECT p_brand AS table_name, 'c_' || p_partkey AS column_name FROM part
WHERE p_partkey % 2 = 0 AND p_partkey % 9 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0""")
def not_null_candidates_query(spark, sf):
    p = F.col("p_partkey")
    cat = table(spark, sf, "part").select(
        F.col("p_brand").alias("table_name"),
        F.concat(F.lit("c_"), p.cast("string")).alias("column_name"),
        F.when(p % 2 == 0, F.lit("NO")).otherwise("YES").alias("is_nullable"),
        F.when(p % 9 == 0, F.lit("auto_increment")).otherwise("").alias("extra"),
        F.when(p % 11 == 0, F.lit("PRI")).otherwise("").alias("column_key"),
        F.when(p % 13 == 0, F.lit("longblob")).otherwise("int").alias("data_type"),
    )
    return A.not_null_candidates(cat, include_key=False, include_binary=False)


@query("table_inventory_diff", sql="""
SELECT 't_' || p_partkey AS table_name,
       CASE WHEN p_partkey % 10 = 7 THEN 'left_only' WHEN p_partkey % 10 = 3 THEN 'right_only'
            ELSE 'both' END AS presence,
       CASE WHEN p_partkey % 10 = 7 THEN 'failure' WHEN p_partkey % 10 = 3 THEN 'information'
            ELSE 'ok' END AS severity
FROM part""")
def table_inventory_diff_query(spark, sf):
    p = F.col("p_partkey")
    names = table(spark, sf, "part").select(
        p, F.concat(F.lit("t_"), p.cast("string")).alias("table_name")
    )
    return C.table_inventory_diff(names.where(p % 10 != 3), names.where(p % 10 != 7))


@query("row_count_compare", ORDERS, sql="""
, n AS (
  SELECT 'orders' AS table_name, (SELECT count(*) FROM orders_l) AS left_n,
         (SELECT count(*) FROM orders_r) AS right_n
  UNION ALL
  SELECT 'customer', (SELECT count(*) FROM customer),
         (SELECT count(*) FROM customer WHERE c_custkey % 97 <> 0)
  UNION ALL SELECT 'events', (SELECT count(*) FROM events), (SELECT count(*) FROM events)
  UNION ALL SELECT 'labels', (SELECT count(*) FROM labels), NULL)
SELECT table_name, left_n, right_n, left_n - right_n AS diff,
       CAST(CAST(round(CAST(abs(left_n - right_n) * 100 AS DECIMAL(28,10)) / greatest(left_n, 1), 4)
            AS DECIMAL(24,4)) AS VARCHAR) AS pct,
       CASE WHEN right_n IS NULL THEN 'MISSING' WHEN left_n = right_n THEN 'YES' ELSE 'NO' END
         AS match
FROM n""")
def row_count_compare_query(spark, sf):
    left, right = both(spark, sf)
    customer, events = table(spark, sf, "customer"), table(spark, sf, "events")
    found = C.row_count_compare(
        {"orders": left, "customer": customer, "events": events,
         "labels": table(spark, sf, "labels")},
        {"orders": right, "customer": customer.where(F.col("c_custkey") % 97 != 0),
         "events": events},
    )
    return found.withColumn("pct", F.col("pct").cast("string"))


@query("union_tables", sql="""
SELECT 'orders' AS table_name, count(*) AS n FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'pages', count(*) FROM pages""")
def union_tables_query(spark, sf):
    return C.row_counts({t: table(spark, sf, t) for t in ("orders", "lineitem", "pages")})


def _estimates(spark, sf):
    """One table per supplier, estimated by its number of line items."""
    s = F.col("l_suppkey")
    items = table(spark, sf, "lineitem")
    counted = items.groupBy(s).agg(
        F.count("*").alias("n"), F.count_if(F.col("l_partkey") % 7 != 0).alias("fewer")
    )
    name = F.concat(F.lit("t_"), s.cast("string")).alias("table_name")
    left = counted.select(name, F.when(s % 11 == 0, F.lit("n/a"))
                          .otherwise(F.col("n").cast("string")).alias("est_rows"))
    right = counted.select(
        name, F.when(s % 13 == 0, F.lit(-1)).when(s % 3 == 0, F.col("fewer"))
        .otherwise(F.col("n") - 3).alias("est_rows")
    )
    return left, right


ESTIMATES = """
est AS (
  SELECT 't_' || l_suppkey AS table_name,
         CASE WHEN l_suppkey % 11 = 0 THEN 'n/a' ELSE CAST(count(*) AS VARCHAR) END AS left_est,
         CAST(CASE WHEN l_suppkey % 13 = 0 THEN -1
              WHEN l_suppkey % 3 = 0 THEN count(*) FILTER (WHERE l_partkey % 7 <> 0)
              ELSE count(*) - 3 END AS VARCHAR) AS right_est
  FROM lineitem GROUP BY l_suppkey)
"""


@query("estimate_triage", ESTIMATES, sql="""
SELECT table_name, left_est, right_est,
       CASE WHEN NOT regexp_full_match(left_est, '[0-9]+')
              OR NOT regexp_full_match(right_est, '[0-9]+') THEN 'ERR'
            WHEN abs(TRY_CAST(left_est AS BIGINT) - TRY_CAST(right_est AS BIGINT))
                 > greatest(50, TRY_CAST(left_est AS BIGINT) // 200) THEN 'VERIFY'
            ELSE '~ok' END AS status
FROM est""")
def estimate_triage_query(spark, sf):
    return C.estimate_triage(*_estimates(spark, sf))


@query("pk_fingerprint", ORDERS, sql="""
SELECT 'orders' AS table_name,
       (SELECT concat_ws(',', count(*), min(o_orderkey), max(o_orderkey)) FROM orders_l)
         AS left_fingerprint,
       (SELECT concat_ws(',', count(*), min(o_orderkey), max(o_orderkey)) FROM orders_r)
         AS right_fingerprint, 'mismatch' AS status
UNION ALL
SELECT 'events',
       (SELECT concat_ws(',', count(*), min(event_id), max(event_id)) FROM events),
       (SELECT concat_ws(',', count(*), min(event_id), max(event_id)) FROM events), 'match'
UNION ALL
SELECT 'none', '0,NULL,NULL', '0,NULL,NULL', 'match'""")
def pk_fingerprint_query(spark, sf):
    left, right = both(spark, sf)
    events = table(spark, sf, "events")
    none = events.where(F.col("event_id") < 0)
    return C.pk_fingerprint({
        "orders": (left, right, "o_orderkey"),
        "events": (events, events, "event_id"),
        "none": (none, none, "event_id"),
    })


@query("sequence_check", sql="""
WITH m AS (
  SELECT l_suppkey AS s, 't_' || l_suppkey AS table_name, max(l_orderkey) AS left_max,
         CASE WHEN l_suppkey % 17 = 0 THEN NULL
              WHEN l_suppkey % 5 = 0 THEN max(l_orderkey) - 1 ELSE max(l_orderkey) END AS right_max
  FROM lineitem GROUP BY l_suppkey),
q AS (SELECT *, CASE WHEN s % 7 <> 0 THEN 't_' || s || '_id_seq' END AS sequence_name,
             CASE WHEN s % 7 <> 0 THEN COALESCE(right_max, 0) + (s % 3) - 1 END AS last_value
      FROM m)
SELECT table_name, 'id' AS column_name, sequence_name, last_value, left_max, right_max,
       CASE WHEN sequence_name IS NULL THEN 'MISSING' WHEN last_value < right_max THEN 'BEHIND'
            WHEN last_value = right_max THEN 'AT_MAX' ELSE 'OK' END AS status,
       left_max IS DISTINCT FROM right_max AS max_differs,
       CASE WHEN sequence_name IS NULL THEN COALESCE(right_max, 1)
            WHEN right_max > 0 THEN right_max END AS set_to
FROM q""")
def sequence_check_query(spark, sf):
    s = F.col("l_suppkey")
    top = table(spark, sf, "lineitem").groupBy(s).agg(F.max("l_orderkey").alias("left_max"))
    right = F.when(s % 17 == 0, None).when(s % 5 == 0, F.col("left_max") - 1).otherwise(
        F.col("left_max")
    )
    named = top.select(
        s, F.concat(F.lit("t_"), s.cast("string")).alias("table_name"),
        F.lit("id").alias("column_name"), "left_max", right.alias("right_max"),
    )
    sequences = named.where(s % 7 != 0).select(
        "table_name", "column_name",
        F.concat("table_name", F.lit("_id_seq")).alias("sequence_name"),
        (F.coalesce("right_max", F.lit(0)) + (s % 3) - 1).alias("last_value"),
    )
    return C.sequence_check(named.drop("l_suppkey"), sequences)


@query("table_maxima", sql="""
SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, max(o_orderkey) AS max_value FROM orders
UNION ALL SELECT 'customer', 'c_custkey', max(c_custkey) FROM customer
UNION ALL SELECT 'nation', 'n_nationkey', max(n_nationkey) FROM nation""")
def table_maxima_query(spark, sf):
    return C.table_maxima({
        (t, c): table(spark, sf, t)
        for t, c in (("orders", "o_orderkey"), ("customer", "c_custkey"),
                     ("nation", "n_nationkey"))
    })


# -- sources and sinks ---------------------------------------------------------


@query("read_table", sql="""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey >= 1000 AND o_orderstatus = 'F'""")
def read_table_query(spark, sf):
    wanted = (F.col("o_orderkey") >= 1000) & (F.col("o_orderstatus") == "F")
    return read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"], wanted)


@query("missing_rows", ORDERS, sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       o_orderpriority
FROM orders_l WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_r)""")
def missing_rows_query(spark, sf):
    found = missing_rows(*both(spark, sf), KEY)
    return found.select("o_orderkey", "o_custkey", "o_orderstatus",
                        F.col("o_totalprice").cast("string").alias("o_totalprice"),
                        "o_orderpriority")


@query("write_missing_rows", sql="""
SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id % 23 = 0""")
def write_missing_rows_query(spark, sf):
    left = table(spark, sf, "documents")
    right = left.where(F.col("doc_id") % 23 != 0)
    path = scratch_path(spark, "missing-rows")
    write_missing_rows(missing_rows(left, right, ["doc_id"], BROADCAST_ROWS), path)
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .schema(left.schema).csv(path)
    )


@query("write_key_list", sql="""
SELECT CAST(conv_id AS VARCHAR) || chr(9) || CAST(turn AS VARCHAR) AS value
FROM conversations WHERE conv_id % 97 = 0""")
def write_key_list_query(spark, sf):
    left = table(spark, sf, "conversations")
    missing = key_set_diff(left, left.where(F.col("conv_id") % 97 != 0), ["conv_id", "turn"])
    path = scratch_path(spark, "key-list")
    write_key_list(missing, ["conv_id", "turn"], path)
    return spark.read.text(path)


@query("write_report", ORDERS_DIFF, sql="""
SELECT diff_type, count(*) AS n FROM diff GROUP BY 1""")
def write_report_query(spark, sf):
    counted = diff_rows(*both(spark, sf), KEY).groupBy("diff_type").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "report")
    write_report(counted, path, "json")
    return spark.read.schema("diff_type string, n bigint").json(path)


@query("fast_counts", ORDERS, sql="""
, n AS (
  SELECT 'orders' AS table_name, (SELECT count(*) FROM orders_l) AS l,
         (SELECT count(*) FROM orders_r) AS r
  UNION ALL
  SELECT 'lineitem', (SELECT count(*) FROM lineitem),
         (SELECT count(*) FROM lineitem WHERE l_partkey % 10 <> 0)),
t AS (SELECT *, CASE WHEN abs(l - r) > greatest(50, l // 200) THEN 'VERIFY' ELSE '~ok' END
        AS status FROM n)
SELECT table_name, CAST(l AS VARCHAR) AS left_est, CAST(r AS VARCHAR) AS right_est, status,
       CASE WHEN status = 'VERIFY' THEN l END AS left_n,
       CASE WHEN status = 'VERIFY' THEN r END AS right_n,
       CASE WHEN status = 'VERIFY' THEN CASE WHEN l = r THEN 'YES' ELSE 'NO' END END AS match
FROM t""")
def fast_counts_query(spark, sf):
    # Exact counts stand in for the servers' estimates.
    orders_l, orders_r = both(spark, sf)
    items = table(spark, sf, "lineitem")
    left = {"orders": orders_l, "lineitem": items}
    right = {"orders": orders_r, "lineitem": items.where(F.col("l_partkey") % 10 != 0)}
    estimates = [C.row_counts(side).withColumnRenamed("n", "est_rows") for side in (left, right)]
    return fast_counts(*estimates, left, right)


@query("fast_counts_from_statistics", sql="""
WITH n AS (
  SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS l,
         (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 0) AS r, TRUE AS flagged
  UNION ALL
  SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer), FALSE)
SELECT table_name, CAST(l AS VARCHAR) AS left_est, CAST(r AS VARCHAR) AS right_est,
       CASE WHEN flagged THEN 'VERIFY' ELSE '~ok' END AS status,
       CASE WHEN flagged THEN l END AS left_n, CASE WHEN flagged THEN r END AS right_n,
       CASE WHEN flagged THEN 'NO' END AS match
FROM n""")
def fast_counts_from_statistics_query(spark, sf):
    """Two copies in the catalog, one side without statistics for one table."""
    run = f"counts_{uuid.uuid4().hex[:12]}"
    left, right = {}, {}
    for name, keep in (("orders", F.col("o_orderkey") % 10 != 0), ("customer", F.lit(True))):
        for side, rows in ((left, table(spark, sf, name)), (right, table(spark, sf, name).where(keep))):
            side[name] = f"{run}_{name}_{'l' if side is left else 'r'}"
            rows.write.option("path", scratch_path(spark, side[name])).saveAsTable(side[name])
            if side is left or name == "orders":
                spark.sql(f"ANALYZE TABLE {side[name]} COMPUTE STATISTICS")
    try:
        return written(fast_counts_from_statistics(spark, left, right), "fast-counts")
    finally:
        for name in (*left.values(), *right.values()):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("key_lists", sql="""
SELECT CAST(p_brand AS VARCHAR) AS table_name, 'PRIMARY KEY' AS constraint_type,
       string_agg(p_name, ', ' ORDER BY p_partkey) AS key_columns, count(*) AS n_columns
FROM part WHERE p_partkey % 9 = 0 GROUP BY p_brand""")
def key_lists_query(spark, sf):
    keys = table(spark, sf, "part").where("p_partkey % 9 = 0").select(
        F.col("p_brand").alias("table_name"), F.lit("PRIMARY KEY").alias("constraint_type"),
        F.col("p_name").alias("column_name"), F.col("p_partkey").alias("ordinal_position"))
    return C.key_lists(keys)
