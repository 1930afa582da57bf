"""Observed loads, statistics as estimates, digests under change, positions as a table."""

import pytest
from pyspark.sql import functions as F

from tests.test_changelog import KEY, ROW, as_set, log_of, put
from tests.test_plans import plan_of
from twinledger.operators import changelog as L
from twinledger.operators import digest as G
from twinledger.operators.catalog import key_lists
from twinledger.operators.loading import TooManyRejects, load_observed, loaded
from twinledger.operators.replay import changed_images, verify_chunks
from twinledger.plans.load_check import file_statistics, table_statistics

CASTS = {"n": "int", "d": "date"}


def raw(spark):
    return spark.createDataFrame([(1, "5", "2020-01-02"), (2, "x", None), (3, None, "2020-13-01"), (4, None, None)],
                                 "id int, n string, d string")


def test_observed_load(spark, tmp_path):
    target = f"file://{tmp_path}/loads/a"
    assert load_observed(raw(spark), CASTS, target, max_rejects=2) == {"total": 4, "good": 2, "rejected": 2}
    good, rejects = loaded(raw(spark), CASTS, target)
    assert good.schema["n"].dataType.simpleString() == "int" and {r.id for r in good.collect()} == {1, 4}
    assert as_set(rejects) == {(2, "x", None, "not convertible: n"), (3, None, "2020-13-01", "not convertible: d")}
    with pytest.raises(ValueError, match="already"):
        load_observed(raw(spark), CASTS, target)


def test_nothing_is_visible_of_a_refused_load(spark, tmp_path):
    target = f"file://{tmp_path}/b"
    with pytest.raises(TooManyRejects, match="2 rows"):
        load_observed(raw(spark), CASTS, target, max_rejects=1)
    assert not (tmp_path / "b").exists()
    none = load_observed(raw(spark).where("id > 9"), CASTS, target, max_rejects=0)
    assert none == {"total": 0, "good": 0, "rejected": 0}


def test_statistics_of_the_catalog_and_of_footers(spark, tmp_path, sf):
    spark.range(70).write.mode("overwrite").option("path", f"file://{tmp_path}/t").saveAsTable("stat_t")
    try:
        assert table_statistics(spark, {"t": "stat_t"}).first()["est_rows"] is None
        spark.sql("ANALYZE TABLE stat_t COMPUTE STATISTICS")
        spark.range(5).write.mode("append").parquet(f"file://{tmp_path}/t")
        assert table_statistics(spark, {"t": "stat_t"}).first()["est_rows"] == 70  # not counted again
    finally:
        spark.sql("DROP TABLE stat_t")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    plan = plan_of(file_statistics({"orders": orders}))
    assert "ReadSchema: struct<>" in plan and "o_orderkey" not in plan


def test_digests_follow_changes(spark):
    cols, types = ["id", "v"], {"id": "int8", "v": "text"}
    state = spark.createDataFrame([(i, f"v{i}") for i in range(40)], ROW)
    digests = G.chunk_digest(state, "id", cols, types, 10)
    events = L.unwrap(L.parse_envelope(log_of(
        spark, put(0, 3, "new"), put(1, 77, "far"), put(2, 3, "newer"),
        *[[("cdc-a.public.t", 0, 10 + i, i, '{"payload": {"op": "d", "before": {"id": 1}}}')] for i in range(10, 20)]), ROW, KEY))
    before, after = changed_images(state, events.drop("schema", "table"), ["id"])
    assert before.count() == 11 and after.count() == 2
    change = G.digest_change(before, after, "id", cols, types, 10)
    new = G.updated_digests(digests, change)
    now = state.where("id NOT BETWEEN 10 AND 19 AND id <> 3").union(spark.createDataFrame([(3, "newer"), (77, "far")], ROW))
    want = G.chunk_digest(now, "id", cols, types, 10)
    assert as_set(new) == as_set(want) and {r.chunk_id for r in new.collect()} == {0, 2, 3, 7}
    for ranges in (1_000, 0):  # pushed into the scan, or joined
        found = verify_chunks(new, now.where("id <> 77"), change, "id", cols, types, 10, max_ranges=ranges)
        assert {(r.chunk_id, r.same) for r in found.collect()} == {(0, True), (1, True), (7, False)}


def test_many_positions_are_joined(spark):
    log = log_of(spark, put(0, 1, "a"), put(1, 1, "b"), put(2, 2, "c"), put(0, 3, "d", partition=1))
    positions = spark.range(10_000).select(F.lit("cdc-a.public.t").alias("topic"), (F.col("id") * 5).cast("int").alias("partition"),
                                           F.lit(0).cast("bigint").alias("offset"))
    found = L.after_positions(log, positions)
    assert {(r.partition, r.offset) for r in found.collect()} == {(0, 1), (0, 2), (1, 0)}
    assert "map(" not in plan_of(found) and "Join" in plan_of(found)
    assert L.after_positions(log, positions.where("false")).count() == 4


def test_key_columns_stand_in_their_order(spark):
    keys = spark.createDataFrame([("t", "PRIMARY KEY", "b", 10), ("t", "PRIMARY KEY", "a", 2), ("u", "UNIQUE", "x", 1)],
                                 "table_name string, constraint_type string, column_name string, ordinal_position int")
    assert as_set(key_lists(keys)) == {("t", "PRIMARY KEY", "a, b", 2), ("u", "UNIQUE", "x", 1)}
