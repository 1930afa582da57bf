"""What the physical plans may and may not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from twinledger import session
from twinledger.functions.logical_types import infer_types
from twinledger.operators import audit as A
from twinledger.operators import changelog as L
from twinledger.operators import diff as D
from twinledger.operators import digest as G
from twinledger.queries import load
from twinledger.sources.sinks import write_bucketed_copy


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


def test_row_diff_is_one_shuffle_of_keys_and_digests(orders):
    plan = plan_of(D.diff_rows(orders, orders.where("o_orderkey > 3"), ["o_orderkey"]))
    assert plan.count("Exchange") == 1
    assert "Join" not in plan


def test_md5_is_computed_once_per_row(orders):
    digest = G.chunk_digest(orders, "o_orderkey", orders.columns, infer_types(orders))
    assert optimized(digest).count("md5(") == 1


def test_merge_join_reuses_the_grouping(orders):
    plan = plan_of(D.diff_merge(orders, orders.where("o_orderkey > 3"), ["o_orderkey"]))
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2


def test_key_diff_reads_only_the_key(orders):
    plan = plan_of(D.key_set_diff(orders, orders.where("o_orderkey > 3"), ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "o_custkey" not in plan


def test_few_dirty_chunks_are_pushed_into_the_scan(orders):
    changed = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") == 250, 0).otherwise(F.col("o_custkey"))
    )
    plan = plan_of(D.diff_chunked(orders, changed, "o_orderkey", chunk_size=100))
    assert "GreaterThanOrEqual(o_orderkey,200)" in plan
    assert "LessThan(o_orderkey,300)" in plan


def test_snapshot_bound_is_a_plain_comparison(orders):
    _, right = G.snapshot_bound(orders, orders, "o_orderkey")
    assert "<= Subquery" in plan_of(right).replace("scalar-subquery", "Subquery")


def test_audits_are_one_scan(orders):
    for df in (
        A.null_audit(orders, orders.columns),
        A.non_ascii_scan(orders, ["o_orderstatus", "o_orderpriority"]),
        A.max_text_length(orders, {"o_orderstatus": 5, "o_orderpriority": 5}),
    ):
        assert plan_of(df).count("FileScan") == 1


def test_topic_totals_read_no_values(spark, tmp_path):
    log = spark.createDataFrame([("cdc-a.public.t", 0, 1, None, "k", "v")], L.LOG_SCHEMA)
    log.write.parquet(str(tmp_path / "log"))
    plan = plan_of(L.topic_totals(spark.read.schema(L.LOG_SCHEMA).parquet(str(tmp_path / "log"))))
    assert "value:string" not in plan and "key:string" not in plan


def test_samples_limit_groups_before_the_shuffle(spark):
    diff = spark.range(100).select(F.col("id").alias("k"), F.lit("changed").alias("diff_type"))
    diff = diff.unionByName(diff.withColumn("diff_type", F.lit("left_only")))
    assert plan_of(D.sample_per_diff_type(diff, ["k"], 5)).count("WindowGroupLimit") == 2


def test_a_shared_foreign_key_can_be_split(spark, sf):
    """The join has shuffles directly below both sorts, which AQE can split."""
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("fk"),
            F.md5(F.col("id").cast("string")).alias("payload"),
        )
        parent = spark.range(0, 200_000, 2, 4).toDF("pk")
        found = A.fk_orphans(child, ["fk"], parent, ["pk"])
        assert len(found.collect()) == sum(1 for i in range(200_000) if i % 3 == 0 or i % 2)
        assert "skew=true" in plan_of(found)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


BANNED = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
          "FlatMapGroupsInPandas")


def test_no_registered_query_uses_python_or_a_cross_product(spark, sf):
    queries, _ = load()
    skip = {"reconcile_each_table"}
    for name, fn in queries.items():
        if name in skip or "stream" in name or name in ("upsert_sink",):
            continue
        plan = plan_of(fn(spark, sf))
        assert not [b for b in BANNED if b in plan], name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_scratch_folder_is_the_shared_one(spark):
    root = session.scratch_root(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert root.startswith(shared.rstrip("/"))
    session.check_conf(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            session.check_conf(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stored_copies_are_compared_without_a_shuffle(spark):
    rows = [(i // 2, f"s{i % 3}", i * 1.5 if i % 7 else None) for i in range(400)]
    left = spark.createDataFrame(rows, "k int, s string, v double")
    right = left.withColumn("v", F.when(F.col("k") % 11 == 0, 1.0).otherwise(F.col("v"))).where("k <> 5 or s <> 's1'")
    right = right.unionByName(spark.createDataFrame([(900, "x", 1.0), (7, "s0", 3.0)], "k int, s string, v double"))
    names = ("stored_copy_left", "stored_copy_right")
    try:
        for keys in (["k"], ["k", "s"]):
            copies = [write_bucketed_copy(df, n, keys, 4) for df, n in zip((left, right), names)]
            found = D.diff_stored_copies(*copies, keys, null_keys=False)
            assert "Exchange" not in plan_of(found)
            want = {tuple(r) for r in D.diff_rows(left, right, keys).collect()}
            assert {tuple(r) for r in found.collect()} == want and want
            assert {tuple(r) for r in D.diff_stored_copies(left, right, keys).collect()} == want
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
    gaps = spark.createDataFrame([(None, "s", 1.0), (None, "s", 2.0), (1, None, 1.0)], "k int, s string, v double")
    for keys in (["k"], ["k", "s"]):
        want = sorted(map(str, D.diff_rows(left.union(gaps), right.union(gaps.limit(1)), keys).collect()))
        assert sorted(map(str, D.diff_stored_copies(left.union(gaps), right.union(gaps.limit(1)), keys).collect())) == want
    with pytest.raises(Exception, match="key is NULL"):
        D.diff_stored_copies(left.union(gaps), right, ["k"], null_keys=False).collect()
    with pytest.raises(TypeError, match="two types"):
        D.diff_stored_copies(left.withColumn("k", F.col("k").cast("bigint")), right, ["k"])
