import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from twinledger.functions.arithmetic import floor_div
from twinledger.functions.logical_types import LogicalType, expected_targets, infer_types
from twinledger.functions.tokens import (
    canonical_key,
    column_token,
    fingerprint,
    key_text,
    row_hash,
)
from twinledger.functions.transforms import (
    enum_remap,
    has_non_ascii,
    is_zero_date,
    timestamptz_to_datetime,
)


def one(df):
    return [r[0] for r in df.collect()]


def token(spark, value, ddl, kind, **options):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    return one(df.select(column_token("v", kind, df.schema["v"].dataType, **options)))[0]


def test_null_and_empty_text_differ(spark):
    assert token(spark, None, "string", "text") == "\x01"
    assert token(spark, "", "string", "text") == ""


@pytest.mark.parametrize("value,ddl,want", [
    (0, "int", "false"), (1, "int", "true"), (-1, "tinyint", "true"), (2, "bigint", "true"),
    (True, "boolean", "true"), (False, "boolean", "false"), ("t", "string", "true"),
    ("off", "string", "false"), (None, "int", "\x01"), (None, "boolean", "\x01"),
])
def test_bool_tokens(spark, value, ddl, want):
    assert token(spark, value, ddl, "bool") == want


def test_timestamp_tokens_drop_the_fraction(spark):
    stamp = dt.datetime(2024, 3, 1, 4, 5, 6, 789000)
    assert token(spark, stamp, "timestamp_ntz", "timestamp") == "2024-03-01 04:05:06"
    assert token(spark, "2024-03-01T04:05:06.7+00:00", "string", "timestamptz") == (
        "2024-03-01 04:05:06"
    )
    assert token(spark, stamp, "timestamp_ntz", "timestamp", ts_precision="micro") == (
        "2024-03-01 04:05:06.789000"
    )
    assert token(spark, None, "timestamp", "timestamptz") == "\x01"


def test_timestamptz_token_is_utc_in_any_session_zone(spark):
    df = spark.sql("SELECT timestamp'2024-07-01 12:00:00Z' AS v")
    expr = column_token("v", "timestamptz", df.schema["v"].dataType)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(df.select(expr)) == ["2024-07-01 12:00:00"]
        iso = spark.createDataFrame([("2024-07-01T12:00:00.5Z",)], "v string")
        assert one(iso.select(timestamptz_to_datetime("v", "UTC"))) == ["2024-07-01 12:00:00"]
        assert one(iso.select(timestamptz_to_datetime("v", "Asia/Tokyo"))) == [
            "2024-07-01 21:00:00"
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_opaque_tokens(spark):
    assert token(spark, '{"a":1}', "string", "jsonb") == "\x02"
    assert token(spark, None, "string", "json") == "\x01"
    assert token(spark, "a", "string", "json", compare_opaque="md5") != token(
        spark, "b", "string", "json", compare_opaque="md5"
    )


def test_float_token_is_fixed_point(spark):
    assert token(spark, 12345678.5, "double", LogicalType("float8", 2)) == "12345678.50"
    assert token(spark, float("nan"), "double", "float8") == "NaN"


def test_row_hash_is_md5_of_joined_tokens(spark):
    df = spark.createDataFrame([(7, None, "x")], "id bigint, a string, b string")
    want = hashlib.md5("7\x1d\x01\x1dx".encode()).hexdigest()
    assert one(df.select(row_hash(df, df.columns, infer_types(df)))) == [want]


def test_strict_hash_keeps_separators_apart(spark):
    df = spark.createDataFrame([("a\x1db", "c"), ("a", "b\x1dc")], "x string, y string")
    kinds = infer_types(df)
    assert len(set(one(df.select(row_hash(df, df.columns, kinds))))) == 1
    assert len(set(one(df.select(row_hash(df, df.columns, kinds, strict=True))))) == 2


def test_fingerprint_tells_nulls_apart(spark):
    df = spark.createDataFrame(
        [(None, "a"), ("a", None), ("", "a"), ("\x01", "a"), ("a\x1d", "a")], "x string, y string"
    )
    words = fingerprint(df, df.columns, infer_types(df), df.schema)
    assert df.select(*words).distinct().count() == 5


def test_same_fingerprint_across_spark_types(spark):
    a = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-01 00:00:01.5' AS t, 1 AS b, 2.5D AS d")
    b = spark.sql("SELECT 1L AS id, '2024-01-01 00:00:01' AS t, true AS b, 2.50BD AS d")
    kinds = {"id": "int8", "t": "timestamp", "b": "bool", "d": LogicalType("float8", 2)}
    left = a.select(*fingerprint(a, a.columns, kinds, b.schema)).first()
    right = b.select(*fingerprint(b, b.columns, kinds, a.schema)).first()
    assert tuple(left) == tuple(right)


def test_floor_div_rounds_down(spark):
    df = spark.createDataFrame([(k,) for k in (-100001, -100000, -1, 0, 99999, 100000)], "k bigint")
    assert one(df.select(floor_div(F.col("k"), 100000))) == [-2, -1, -1, 0, 0, 1]
    big = spark.createDataFrame([((1 << 62) + 1,)], "k bigint")
    assert one(big.select(floor_div(F.col("k"), 3))) == [((1 << 62) + 1) // 3]


def test_keys(spark):
    df = spark.createDataFrame([(1, "b")], "a int, b string")
    assert one(df.select(key_text(["a", "b"]))) == ["1\x1cb"]
    forms = spark.createDataFrame([("007",), (" 7",), ("7.0",)], "k string")
    assert len(set(one(forms.select(canonical_key(["k"]))))) == 1
    texts = spark.createDataFrame([("AbC",), ("abc ",)], "k string")
    assert set(one(texts.select(canonical_key(["k"])))) == {"abc"}


def test_zero_dates_and_text_checks(spark):
    df = spark.createDataFrame([("0000-00-00 00:00:00",), ("2020-01-01",), (None,)], "d string")
    assert one(df.select(is_zero_date("d"))) == [True, False, False]
    text = spark.createDataFrame([("jA",), ("é",), (None,)], "t string")
    assert one(text.select(has_non_ascii("t"))) == [False, True, False]


def test_enum_remap_passes_unknown_labels(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "e string")
    assert one(df.select(enum_remap("e", {"a": "A"}))) == ["A", "b", None]
    assert one(df.select(enum_remap("e", {}))) == ["a", "b", None]


@pytest.mark.parametrize("data_type,column_type,want", [
    ("tinyint", "tinyint(1)", ["bool"]), ("tinyint", "tinyint(4)", ["int2"]),
    ("year", "year", ["int2"]), ("int", "int unsigned", ["int8"]), ("int", "int", ["int4"]),
    ("bigint", "bigint unsigned", ["numeric"]), ("varchar", "varchar(255)", ["varchar(255)"]),
    ("char", "char", ["bpchar"]), ("json", "json", ["json", "jsonb"]), ("bit", "bit(1)", ["bool"]),
    ("bit", "bit(8)", ["bit"]), ("longblob", "longblob", ["bytea"]), ("set", "set('a')", ["text"]),
    ("geometry", "geometry", None),
])
def test_expected_targets(spark, data_type, column_type, want):
    df = spark.createDataFrame([(data_type, column_type)], "d string, c string")
    assert one(df.select(expected_targets(F.col("d"), F.col("c")))) == [want]


def test_doubles_are_fingerprinted_at_their_scale(spark):
    values = [1.001, 1.004, 1.02, float("nan"), float("inf"), float("-inf"), None, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    words = fingerprint(df, ["d"], {"d": LogicalType("float8", 2)}, df.schema)
    rows = [tuple(r) for r in df.select(*words).collect()]
    assert rows[0] == rows[1]
    assert len(set(rows)) == len(values) - 1


def test_numbers_of_two_scales_are_the_same_and_strict_tells_them_apart(spark):
    from twinledger.operators.diff import diff_rows

    left = spark.sql("SELECT 1 AS k, CAST(1.00 AS decimal(18,2)) AS a, 5L AS b UNION ALL SELECT 2, 2.50, 6L")
    right = spark.sql("SELECT 1 AS k, CAST(1.0000 AS decimal(20,4)) AS a, CAST(5.000 AS decimal(10,3)) AS b "
                      "UNION ALL SELECT 2, 2.5001, 6.000")
    types = {"k": "int4", "a": "numeric", "b": "numeric"}
    assert [tuple(r) for r in diff_rows(left, right, ["k"], types).collect()] == [(2, "changed")]
    assert diff_rows(left, right, ["k"], types, strict_numbers=True).count() == 2


def test_instants_as_text_are_brought_to_utc(spark):
    from twinledger.functions.tokens import canonical_key, column_token, key_text

    df = spark.createDataFrame([("2024-01-01T02:00:00+02:00", "2024-01-01 00:00:00Z", "2024-01-01 00:00:00")], "a string, b string, c string")
    row = df.select(*[column_token(c, "timestamptz") for c in "abc"], column_token("a", "timestamp")).first()
    assert row[0] == row[1] == row[2] == "2024-01-01 00:00:00" and row[3] == "2024-01-01 02:00:00"
    keys = spark.createDataFrame([("1", None), (None, "1")], "x string, y string")
    for form in (key_text(["x", "y"]), canonical_key(["x", "y"])):
        assert keys.select(form).distinct().count() == 2
