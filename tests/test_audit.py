import decimal

import pytest
from pyspark.sql import functions as F

from twinledger.operators import audit as A
from twinledger.operators import catalog as C
from twinledger.operators import reports as R
from twinledger.operators.loading import SourceColumn, cast_for_target, load_with_rejects


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "a int, b string")
    assert as_set(A.null_audit(df, ["a", "b"])) == {("a", 0, "clean"), ("b", 1, "dirty")}


def test_zero_date_statuses(spark):
    zero = "0000-00-00"
    left = spark.createDataFrame(
        [(zero, zero, zero, "2020-01-01"), (None, None, None, None), (zero, zero, "x", None)],
        "ok string, part string, bad string, none string",
    )
    right = spark.createDataFrame(
        [(None, None, "a", None), (None, None, "b", None), (None, "kept", "c", "d")],
        "ok string, part string, bad string, none string",
    )
    assert as_set(A.zero_date_check(left, right, ["ok", "part", "bad", "none"])) == {
        ("ok", 2, 1, 3, "OK", 0), ("part", 2, 1, 2, "PARTIAL", 1), ("bad", 1, 1, 0, "MISMATCH", 0),
    }


def test_text_length_and_labels(spark):
    df = spark.createDataFrame([("äbc",), (None,), ("abcd",)], "t string")
    assert as_set(A.max_text_length(df, {"t": 3})) == {("t", 4, 3, 1, True)}
    assert as_set(A.max_text_length(df, {"t": 4})) == {("t", 4, 4, 0, False)}
    other = spark.createDataFrame([("abcd",), ("new",)], "t string")
    assert as_set(A.enum_label_diff(df, other, "t")) == {
        ("äbc", "left_only"), ("abcd", "both"), ("new", "right_only")
    }


def test_decimal_exactness(spark):
    left = spark.sql("SELECT 1 AS k, 1.10BD AS v UNION ALL SELECT 2, 2.00BD UNION ALL SELECT 3, 1.00BD")
    right = spark.sql(
        "SELECT 1 AS k, 1.10BD AS v UNION ALL SELECT 2, 2.01BD UNION ALL SELECT 4, 1.00BD"
    )
    assert as_set(A.decimal_exactness(left, right, ["k"], "v")) == {
        (2, decimal.Decimal("2.00"), decimal.Decimal("2.01"))
    }
    with pytest.raises(TypeError):
        A.decimal_exactness(left, right.withColumn("v", F.col("v").cast("double")), ["k"], "v")


def test_json_equal(spark):
    pairs = {
        1: ('{"a": 1, "b": 2}', '{"b":2.0,"a":1}', "equal"),
        2: ('{"a": 1}', '{"a": 2}', "different"),
        3: (None, None, "equal"),
        4: (None, "null", "different"),
        5: ("{bad", "{}", "invalid_left"),
        6: ("[]", "oops", "invalid_right"),
        7: ("{", "{", "invalid_both"),
        8: ("[1,2]", "[2,1]", "different"),
        9: ('{"a": 100}', '{"a": 1.0E2}', "equal"),
        10: ('[[-0.0, 1e400], {"b": [0.001]}]', '[[0, 10E+399], {"b": [1e-3]}]', "equal"),
        11: ("[1e400]", "[1e401]", "different"),
        12: ("[12345678901234567890123456789012345678901]", "[12345678901234567890123456789012345678902]", "different"),
        13: ('["1e2"]', '["100"]', "different"),
        14: ('["100"]', "[100]", "different"),
        15: ('["a\\"1\\\\"]', '["a\\u00221\\u005c"]', "equal"),
        16: ("{1: 2}", "[1.]", "invalid_both"),
        17: ("[01]", "[-]", "invalid_both"),
        18: ('{"a": 1, "a": 1}', '{"a": 1}', "invalid_left"),
        19: ('{"x": {"b": 1, "a": [1, 2e0]}}', '{"x": {"a": [1.0, 2], "b": 10e-1}}', "equal"),
        20: ('["' + "ab\\n" * 20000 + '"]', '["' + "ab\\u000a" * 20000 + '"]', "equal"),
        21: ("", " ", "invalid_both"),
        22: ("-5", "-5.0e0", "equal"),
        23: ("-5", "5", "different"),
        24: ("1 2", "[1 2]", "invalid_both"),
        25: ("[1-2]", "[--1]", "invalid_both"),
        26: ("1],[2", '1},{"v":2', "invalid_both"),
        27: ("1,2", '{"a": 1} x', "invalid_both"),
        28: (" [1] ", "[1]\n", "equal"),
    }
    left = spark.createDataFrame([(k, v[0]) for k, v in pairs.items()], "k int, j string")
    right = spark.createDataFrame([(k, v[1]) for k, v in pairs.items()], "k int, j string")
    assert as_set(A.json_equal(left, right, ["k"], "j")) == {(k, v[2]) for k, v in pairs.items()}


def test_encoding_scans(spark):
    df = spark.createDataFrame([(1, "a�", "x"), (2, "jA", None), (3, "é", "y")],
                               "k int, a string, b string")
    assert as_set(A.replacement_char_scan(df, ["a", "b"], ["k"])) == {(1, "a�", "x")}
    assert A.replacement_char_count(df, ["a", "b"]).first()[0] == 1
    assert as_set(A.non_ascii_scan(df, ["a", "b"])) == {("a", 2, "RISK"), ("b", 0, "OK")}
    assert A.replacement_char_scan(df, ["a"], ["k"], samples=0).count() == 0


def test_key_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert as_set(A.key_audit(df, ["a", "b"])) == {(5, 2, 1, 1, "unusable")}
    assert as_set(A.key_audit(df.where("b = 2"), ["a"])) == {(1, 0, 0, 0, "usable")}
    assert as_set(A.key_audit(df.where("false"), ["a"])) == {(0, 0, 0, 0, "usable")}


def test_fk_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert as_set(A.fk_orphans(child, ["fk"], parent, ["pk"])) == {(3, 99), (4, 99)}
    assert as_set(A.fk_orphan_summary(child, ["fk"], parent, ["pk"])) == {(99, 2)}


def test_parent_totals(spark):
    parents = spark.sql("SELECT 1 AS id, 5.00BD AS t UNION ALL SELECT 2, 0.00BD UNION ALL "
                        "SELECT 3, 1.00BD UNION ALL SELECT 4, CAST(NULL AS DECIMAL(3,2))")
    items = spark.sql("SELECT 1 AS p, 2 AS q, 2.50BD AS u UNION ALL SELECT 4, 1, 1.00BD")
    found = A.parent_total_reconcile(parents, items, "id", "p", "t", F.col("q") * F.col("u"))
    assert {r[0] for r in found.collect()} == {3, 4}


# -- catalogue -----------------------------------------------------------------


def test_inventory_and_columns(spark):
    a = spark.createDataFrame([("t", "x"), ("t", "y"), ("gone", "z")],
                              "table_name string, column_name string")
    b = spark.createDataFrame([("t", "x"), ("t", "w"), ("new", "z")],
                              "table_name string, column_name string")
    assert as_set(C.table_inventory_diff(a, b)) == {
        ("t", "both", "ok"), ("gone", "left_only", "failure"), ("new", "right_only", "information")
    }
    assert as_set(C.column_name_diff(a, b)) == {("t", "y", "left_only"), ("t", "w", "right_only")}
    assert as_set(C.without_excluded(
        spark.createDataFrame([("schema_migrations",), ("t",), ("u",)], "table_name string"), ["t"]
    )) == {("t",)}


def test_column_types(spark):
    left = spark.createDataFrame(
        [("t", "a", "varchar", "varchar(10)"), ("t", "b", "json", "json"),
         ("t", "c", "int", "int"), ("t", "d", "geometry", "geometry"), ("t", "e", "int", "int")],
        "table_name string, column_name string, data_type string, column_type string",
    )
    right = spark.createDataFrame(
        [("t", "a", "varchar", 20), ("t", "b", "jsonb", None), ("t", "c", "int4", None),
         ("t", "d", "point", None)],
        "table_name string, column_name string, udt_name string, char_max_len int",
    )
    found = C.column_type_check(left, right).select("column_name", "status")
    assert as_set(found) == {("a", "mismatch"), ("b", "match"), ("c", "match"), ("d", "skipped"),
                             ("e", "left_only")}


@pytest.mark.parametrize("left,right,want", [
    ("100", "150", "~ok"), ("100", "151", "VERIFY"), ("20000", "20100", "~ok"),
    ("20000", "20101", "VERIFY"), ("100", "-1", "ERR"), ("n/a", "5", "ERR"), (None, "5", "ERR"),
])
def test_triage(spark, left, right, want):
    a = spark.createDataFrame([("t", left)], "table_name string, est_rows string")
    b = spark.createDataFrame([("t", right)], "table_name string, est_rows string")
    assert C.estimate_triage(a, b).first().status == want


def test_row_counts(spark):
    three, none = spark.range(3), spark.range(0)
    found = C.row_count_compare({"a": three, "b": none, "c": three}, {"a": spark.range(2), "b": none})
    assert {(r[0], r[3], str(r[4]), r[5]) for r in found.collect()} == {
        ("a", 1, "33.3333", "NO"), ("b", 0, "0.0000", "YES"), ("c", None, "None", "MISSING")
    }
    assert C.row_count_compare({"a": three}, {}).first().match == "MISSING"
    found = C.pk_fingerprint({"t": (three, none, "id")})
    assert as_set(found) == {("t", "3,0,2", "0,NULL,NULL", "mismatch")}


def test_sequences(spark):
    maxima = spark.createDataFrame(
        [("a", "id", 5, 5), ("b", "id", 5, 5), ("c", "id", 5, 4), ("d", "id", None, None),
         ("e", "id", 0, 0), ("f", "id", None, None)],
        "table_name string, column_name string, left_max bigint, right_max bigint",
    )
    sequences = spark.createDataFrame(
        [("a", "id", "s", 4), ("b", "id", "s", 5), ("c", "id", "s", 9), ("e", "id", "s", 1),
         ("f", "id", "s", 1)],
        "table_name string, column_name string, sequence_name string, last_value bigint",
    )
    found = C.sequence_check(maxima, sequences).select(
        "table_name", "status", "max_differs", "set_to"
    )
    assert as_set(found) == {
        ("a", "BEHIND", False, 5), ("b", "AT_MAX", False, 5), ("c", "OK", True, 4),
        ("d", "MISSING", False, 1), ("e", "OK", False, None), ("f", "OK", False, None),
    }


# -- loading -------------------------------------------------------------------


def test_cast_for_target(spark):
    df = spark.createDataFrame(
        [("1", "4294967295", "18446744073709551615", "0000-00-00 00:00:00", "x"),
         ("0", "oops", None, "2024-01-02 03:04:05", "y")],
        "flag string, u string, b string, d string, other string",
    )
    out = cast_for_target(df, [
        SourceColumn("flag", "tinyint", "tinyint(1)"), SourceColumn("u", "int", "int unsigned"),
        SourceColumn("b", "bigint", "bigint unsigned"), SourceColumn("d", "datetime", "datetime"),
        SourceColumn("other", "geometry", "geometry"),
    ])
    assert [f.dataType.simpleString() for f in out.schema] == [
        "boolean", "bigint", "decimal(20,0)", "timestamp", "string"
    ]
    rows = out.orderBy("other").collect()
    assert (rows[0].flag, rows[0].u, str(rows[0].b), rows[0].d) == (
        True, 4294967295, "18446744073709551615", None
    )
    assert rows[1].flag is False and rows[1].u is None and rows[1].d.year == 2024


def test_rejects_keep_the_row_and_the_reason(spark):
    df = spark.createDataFrame([("1", "2020-01-01"), ("x", "nope"), (None, None)],
                               "n string, d string")
    good, rejects = load_with_rejects(df, {"n": "int", "d": "date"})
    assert good.count() == 2 and good.schema["n"].dataType.simpleString() == "int"
    assert as_set(rejects) == {("x", "nope", "not convertible: n, d")}
    good, rejects = load_with_rejects(df, {"n": "int"}, policy="exit")
    with pytest.raises(Exception, match="not convertible: n"):
        good.collect()
    assert rejects.count() == 0
    clean, _ = load_with_rejects(df.where("n = '1'"), {"n": "int"}, policy="exit")
    assert clean.count() == 1


# -- reports -------------------------------------------------------------------


def test_summary(spark):
    results = spark.createDataFrame(
        [("a", "OK", 0, 0, 0), ("b", "SKIP-PK", None, None, None)],
        "table_name string, status string, left_only bigint, right_only bigint, changed bigint",
    )
    total = R.reconcile_summary(results).where("table_name = 'TOTAL'").first()
    assert (total.status, total.left_only, total.key_representation_suspect) == ("PASS", 0, False)
    failed = results.union(spark.createDataFrame([("c", "ERROR", None, None, None)], results.schema))
    assert R.reconcile_summary(failed).where("table_name = 'TOTAL'").first().status == "FAIL"


def test_lag_is_null_for_a_source_never_seen(spark):
    sources = spark.createDataFrame([(1, "a"), (2, "b")], "i_id_source int, t_source string")
    seen = spark.sql("SELECT 1 AS i_id_source, timestamp'2024-01-01 00:00:00' AS ts_last_received")
    none = spark.createDataFrame([], "i_id_source int, ts_last_replayed timestamp")
    now = F.lit("2024-01-01 00:01:30").cast("timestamp")
    assert as_set(R.replication_lag(sources, seen, none, now)) == {
        (1, "a", 90, None), (2, "b", None, None)
    }


def test_fast_counts_reads_only_flagged_tables(spark):
    from twinledger.plans.load_check import fast_counts

    kinds = "table_name string, est_rows bigint"
    a = spark.createDataFrame([("t", 100), ("u", 1000), ("schema_migrations", 1)], kinds)
    b = spark.createDataFrame([("t", 100), ("u", 10), ("schema_migrations", 900)], kinds)
    unread = spark.range(1).select(F.raise_error(F.lit("read")).alias("x"))
    left = {"t": unread, "u": spark.range(7)}
    found = fast_counts(a, b, left, {"t": unread, "u": spark.range(7)})
    assert as_set(found) == {("t", "100", "100", "~ok", None, None, None),
                             ("u", "1000", "10", "VERIFY", 7, 7, "YES")}
    quiet = fast_counts(a.where("table_name = 't'"), b, left, left)
    assert as_set(quiet) == {("t", "100", "100", "~ok", None, None, None)}
