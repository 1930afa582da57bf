from pyspark.sql import functions as F

from twinledger.functions.logical_types import LogicalType
from twinledger.operators.reports import reconcile_summary
from twinledger.plans.reconcile import (
    TablePair,
    changed_columns,
    pair_diff,
    pairs_from_catalog,
    reconcile,
    reconcile_each,
    samples,
    selected,
    skip_reason,
)
from twinledger.session import scratch_path
from twinledger.sources.sinks import write_key_list, write_missing_rows, write_report
from twinledger.sources.tables import read_change_log, read_table


def pairs(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "id bigint, v string, d double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "z", 2.0)], "id bigint, v string, d double")
    no_common = spark.createDataFrame([(1,)], "other int")
    text_key = a.withColumn("id", F.col("id").cast("string"))
    return {
        "same": TablePair("same", a, a, ["id"], {"d": LogicalType("float8", 2)}),
        "diff": TablePair("diff", a, b, ["id"]),
        "nokey": TablePair("nokey", a, b, []),
        "otherkey": TablePair("otherkey", a, b, ["id"], right_keys=["v"]),
        "nocol": TablePair("nocol", a, no_common, ["id"]),
        "big": TablePair("big", text_key, text_key, ["id"]),
        "schema_migrations": TablePair("schema_migrations", a, b, ["id"]),
    }


def test_skip_reasons(spark):
    p = pairs(spark)
    got = {n: skip_reason(x) for n, x in p.items()}
    assert got == {"same": None, "diff": None, "nokey": "SKIP-PK", "otherkey": "SKIP-PK",
                   "nocol": "SKIP-COL", "big": None, "schema_migrations": None}
    assert [x.name for x in selected(list(p.values()), ["diff", "schema_migrations"])] == ["diff"]


def test_reconcile_and_summary(spark):
    found = reconcile(list(pairs(spark).values()))
    rows = {r.table_name: (r.status, r.changed) for r in found.collect()}
    assert rows == {"same": ("OK", 0), "diff": ("DIFF", 1), "nokey": ("SKIP-PK", None),
                    "otherkey": ("SKIP-PK", None), "nocol": ("SKIP-COL", None), "big": ("OK", 0)}
    total = reconcile_summary(found).where("table_name = 'TOTAL'").first()
    assert (total.status, total.changed) == ("FAIL", 1)


def test_a_failing_table_is_an_error_row(spark):
    p = pairs(spark)
    boom = p["same"].left.withColumn("v", F.raise_error(F.lit("unreadable")).cast("string"))
    broken = TablePair("broken", boom, p["same"].right, ["id"])
    rows = {r.table_name: r for r in reconcile_each([p["same"], broken]).collect()}
    assert {n: r.status for n, r in rows.items()} == {"same": "OK", "broken": "ERROR"}
    assert rows["same"].error is None and "unreadable" in rows["broken"].error


def test_strategies_agree(spark):
    p = pairs(spark)["diff"]
    want = {(2, "changed")}
    for how in ("full", "chunked"):
        assert {tuple(r) for r in pair_diff(p, how).collect()} == want
    assert [r.key for r in samples(list(pairs(spark).values())).collect()] == ["2"]
    assert {tuple(r) for r in changed_columns([p]).collect()} == {("diff", "v", 1), ("diff", "d", 0)}


def test_composite_keys_and_null_keys_count_with_every_strategy(spark):
    kind = "a bigint, b bigint, v string"
    left = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z"), (None, 1, "n")], kind)
    right = spark.createDataFrame([(1, 1, "X"), (1, 3, "y"), (2, 1, "z"), (None, 1, "m")], kind)
    for how in ("full", "chunked"):
        r = reconcile([TablePair("t", left, right, ["a", "b"])], strategy=how).first()
        assert (r.left_only, r.right_only, r.changed) == (1, 1, 2)
        r = reconcile([TablePair("t", left.where("b = 1"), right.where("b = 1"), ["a"])], strategy=how).first()
        assert (r.left_only, r.right_only, r.changed) == (0, 0, 2)


def test_pairs_from_catalog(spark):
    p = pairs(spark)["diff"]
    sides = ("left", "right")
    tables = spark.createDataFrame([(s, t) for s in sides for t in ("a", "b")] + [("left", "alone")], "side string, table_name string")
    keys = spark.createDataFrame([(s, "a", "PRIMARY KEY", "id", 1) for s in sides] + [("left", "b", "UNIQUE", "id", 1)],
                                 "side string, table_name string, constraint_type string, column_name string, ordinal_position int")
    columns = spark.createDataFrame([(s, t, c, u) for s in sides for t in ("a", "b") for c, u in (("id", "int8"), ("v", "text"), ("d", "float8"))],
                                    "side string, table_name string, column_name string, udt_name string")
    got = pairs_from_catalog(tables, keys, columns, lambda side, name: p.left if side == "left" else p.right)
    assert [(x.name, list(x.keys), dict(x.types), skip_reason(x)) for x in got] == [
        ("a", ["id"], {"id": "int8", "v": "text", "d": "float8"}, None),
        ("b", [], {"id": "int8", "v": "text", "d": "float8"}, "SKIP-PK")]
    assert {r.table_name: r.changed for r in reconcile(got).collect()} == {"a": 1, "b": None}


def test_nothing_selected(spark):
    p = list(pairs(spark).values())
    assert reconcile(p, allow=["none"]).count() == 0 and reconcile_each([], allow=["none"]).count() == 0
    assert samples(p, allow=["nokey"]).count() == 0 and changed_columns([]).count() == 0


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(2, 'a,"b"\nc', None), (10, "", "x"), (9, "z", "y")],
                                 "k int, s string, t string")
    write_missing_rows(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(
        rows.schema
    ).csv(str(tmp_path / "csv"))
    assert {tuple(r) for r in back.select("k", "t").collect()} == {(2, None), (10, "x"), (9, "y")}
    assert back.where("k = 2").first().s == 'a,"b"\nc'
    write_key_list(rows, ["k", "t"], str(tmp_path / "keys"))
    lines = [line for f in sorted((tmp_path / "keys").glob("part-*"))
             for line in f.read_text().splitlines()]
    assert lines == ["2", "9\ty", "10\tx"]
    write_report(rows, str(tmp_path / "report"), "json")
    assert spark.read.json(str(tmp_path / "report")).count() == 3


def test_sources(spark, sf, tmp_path):
    df = read_table(spark, sf, "orders", ["o_orderkey"], F.col("o_orderkey") < 5)
    assert df.columns == ["o_orderkey"] and df.count() == 5
    log = spark.sql("SELECT 'cdc-a.s.t' AS topic, 0 AS partition, 1L AS offset, "
                    "timestamp'2024-01-01' AS timestamp, 'k' AS key, 'v' AS value")
    for fmt in ("parquet", "json"):
        log.write.format(fmt).save(str(tmp_path / fmt))
        got = read_change_log(spark, str(tmp_path / fmt), "^cdc-a", fmt=fmt)
        assert got.first().value == "v"
        assert read_change_log(spark, str(tmp_path / fmt), "^cdc-b", fmt=fmt).count() == 0


def test_scratch_paths_are_new_each_time(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or a.startswith(shared)
