"""Logical types of a captured change log, against Python's own integers and dates."""

import base64
import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import connect_types as C
from twinledger.operators import changelog as L
from twinledger.queries import capture_queries

D = decimal.Decimal


def two_complement(n: int) -> str:
    size = max(1, (n + (n < 0)).bit_length() // 8 + 1)
    return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()


NUMBERS = [0, 1, -1, 127, 128, -128, -129, 255, 256, 1300, -1300, 2**31, -2**31, 2**63, -2**63 - 1, 2**64, 2**96, -2**96,
           10**37 + 7, 10**38 - 1, -(10**38 - 1), -(2**96) - 1, 2**96 - 1]


@pytest.mark.parametrize("scale", [0, 2, 18, 38, -3])
def test_decimals(spark, scale):
    with decimal.localcontext(prec=80):
        rows = [(two_complement(n), str(scale), n) for n in NUMBERS]
        df = spark.createDataFrame([(a, b) for a, b, _ in rows], "v string, s string")
        got = [r[0] for r in df.select(F.expr(C.decimal_text("v", "s"))).collect()]
        assert [D(x) for x in got] == [D(n).scaleb(-scale) for n in NUMBERS]
        assert all("E" not in x for x in got)


def test_decimals_that_do_not_fit(spark):
    too_long = spark.createDataFrame([(two_complement(10**39),)], "v string")
    with pytest.raises(Exception):
        too_long.select(F.expr(C.decimal_text("v", "'0'"))).collect()
    value = spark.createDataFrame([(two_complement(12345), C.DECIMAL, "3")], "v string, k string, s string")
    kind = value.select(F.expr(C.decoded("v", "k", "s", T.DecimalType(10, 2))))
    with pytest.raises(Exception, match="more than 2 decimals"):
        kind.collect()


def test_encoding_is_undone(spark):
    df = spark.createDataFrame([(D(n) / 100,) for n in (0, 5, -5, 12800, -12800, 123456789, -1)], "v decimal(18,2)")
    back = df.select("v", C.encoded_decimal(F.col("v"), 2).alias("e")).select("v", F.expr(C.decimal_text("e", "2")).cast("decimal(18,2)").alias("w"))
    assert back.where("v <> w or w is null").isEmpty()
    known = spark.createDataFrame([(D("13.00"),), (D("-0.01"),), (D("1.28"),)], "v decimal(18,2)")
    got = [r[0] for r in known.select(C.encoded_decimal(F.col("v"), 2)).collect()]
    assert got == [two_complement(1300), two_complement(-1), two_complement(128)]


def connect_record(values: dict, kinds: dict, op="u"):
    fields = []
    for name in values:
        kind, scale = kinds.get(name, (None, None))
        field = {"type": "string", "optional": True, "field": name}
        if kind:
            field |= {"name": kind, "version": 1}
        if scale is not None:
            field["parameters"] = {"scale": str(scale)}
        fields.append(field)
    image = {"type": "struct", "fields": fields, "optional": True, "name": "t.Value"}
    return json.dumps({
        "schema": {"type": "struct", "fields": [image | {"field": "before"}, image | {"field": "after"},
                                                 {"type": "string", "field": "op"}]},
        "payload": {"before": None, "after": values, "op": op, "source": {"lsn": 3}, "ts_ms": 5},
    })


ROW = ("id bigint, price decimal(20,4), free decimal(38,10), day date, at time_text, made timestamp, local timestamp_ntz, "
       "sent timestamp, doc string, ok boolean, raw binary, n double").replace("time_text", "string")
CT = "org.apache.kafka.connect.data."


def test_envelope_as_captured(spark):
    micros = dt.datetime(2023, 11, 14, 22, 13, 20, 123000, tzinfo=dt.timezone.utc)
    value = connect_record({
        "id": 7, "price": two_complement(-123456), "free": {"scale": 3, "value": two_complement(5)}, "day": 19675, "at": 3_723_045,
        "made": 1_700_000_000_123, "local": -1, "sent": "2023-11-14T22:13:20.123Z", "doc": '{"a": 1}', "ok": True,
        "raw": base64.b64encode(b"\x00\xff").decode(), "n": 1.5,
    }, {"price": (CT + "Decimal", 4), "free": ("io.debezium.data.VariableScaleDecimal", None), "day": (CT + "Date", None),
        "at": (CT + "Time", None), "made": (CT + "Timestamp", None), "local": (CT + "Timestamp", None),
        "sent": ("io.debezium.time.ZonedTimestamp", None), "doc": ("io.debezium.data.Json", None)})
    key = json.dumps({"schema": {"type": "struct", "fields": [{"type": "bytes", "field": "id", "name": CT + "Decimal",
                                                                "parameters": {"scale": "0"}}]},
                      "payload": {"id": two_complement(7)}})
    log = spark.createDataFrame([("cdc-a.public.t", 0, 1, dt.datetime(2024, 1, 1), key, value)], L.LOG_SCHEMA)
    event = L.parse_envelope(log, ROW, "id bigint").first()
    got = event.after.asDict()
    assert event.key.id == 7 and event.unknown_fields == [] and not event.corrupt and event.before is None
    assert got["price"] == D("-12.3456") and got["free"] == D("0.005") and got["day"] == dt.date(2023, 11, 14)
    assert got["at"] == "01:02:03.045" and got["doc"] == '{"a": 1}' and got["ok"] is True and got["n"] == 1.5
    assert got["raw"] == b"\x00\xff" and got["local"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    stamps = L.parse_envelope(log, ROW, "id bigint").select(F.unix_micros("after.made"), F.unix_micros("after.sent")).first()
    assert set(stamps) == {int(micros.timestamp() * 1000) * 1000}


def test_records_follow_their_own_schema(spark):
    """A column whose scale changed within the log."""
    rows = [("cdc-a.public.t", 0, i, dt.datetime(2024, 1, 1), '{"id":1}',
             connect_record({"id": 1, "price": two_complement(150)}, {"price": (CT + "Decimal", s)})) for i, s in enumerate((1, 2))]
    rows.append(("cdc-a.public.t", 0, 2, dt.datetime(2024, 1, 1), '{"id":1}', connect_record({"id": 1, "price": "9.5"}, {})))
    events = L.parse_envelope(spark.createDataFrame(rows, L.LOG_SCHEMA), "id bigint, price decimal(10,2)", "id bigint")
    assert [r[0] for r in events.orderBy("offset").select("after.price").collect()] == [D("15.00"), D("1.50"), D("9.50")]


def test_text_holds_numbers_of_any_length(spark):
    """Columns of text take what no decimal column holds; typed columns still refuse it."""
    numbers = NUMBERS + [s * n for s in (1, -1) for n in (10**38, 10**39, 2**127, (75 << 120) - 1, 75 << 120, 2**136, 2**143 - 1, 10**65 - 1, 2**400)]
    padded = [(base64.b64encode(b"\0" * 17).decode(), 0), (base64.b64encode(b"\xff" * 20 + b"\5").decode(), -251)]
    rows = [(two_complement(n), n) for n in numbers] + padded
    df = spark.createDataFrame([(v, C.DECIMAL, "0") for v, _ in rows], "v string, k string, s string")
    got = [r[0] for r in df.select(F.expr(C.decoded("v", "k", "s", T.StringType()))).collect()]
    assert got == [str(n) for _, n in rows]
    long = spark.createDataFrame([(two_complement(10**38), C.DECIMAL, "0")], "v string, k string, s string")
    with pytest.raises(Exception):
        long.select(F.expr(C.decoded("v", "k", "s", T.DecimalType(38, 0)))).collect()


def test_times_far_from_the_epoch(spark):
    days = [54_000_000, -54_000_000, 11_574_075]  # the last is above 10^12 seconds
    df = spark.createDataFrame([(str(d * 86_399_999), CT + "Timestamp", None) for d in days], "v string, k string, s string")
    got = df.select(F.expr(f"cast({C.decoded('v', 'k', 's', T.TimestampNTZType())} AS timestamp)").alias("t")).select(F.unix_millis("t")).collect()
    assert [r[0] for r in got] == [d * 86_399_999 for d in days]


def test_captured_orders_with_large_keys(spark, tmp_path):
    """Keys as in tables of 54 million orders: the number has up to 40 digits, the years up to six."""
    keys = [0, 1, 3, 5_421_010, 5_421_011, 5_421_012, 9_223_372, 9_223_373, 9_223_374, 53_999_998, 53_999_999, 54_000_000]
    spark.createDataFrame([(k, k + 0.25) for k in keys], "o_orderkey bigint, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    rows = {r.id: r for r in capture_queries.parse_envelope_connect_query(spark, str(tmp_path)).collect()}
    assert sorted(rows) == keys
    for k, r in rows.items():
        sign = -1 if k % 3 == 0 else 1
        assert r.huge == str(k * sign * 10**12 * 2**64 + k) and D(r.price) == (k + D("0.25")) * sign
        # a cycle of 400 years has 146097 days
        cycle, day = divmod(k * sign, 146_097)
        date = dt.date(1970, 1, 1) + dt.timedelta(days=day)
        year = date.year + 400 * cycle
        assert r.day == (f"{year:04}" if year >= 0 else str(year)) + date.strftime("-%m-%d")
        cycle, millis = divmod(k * sign * 86_399_999, 146_097 * 86_400_000)
        made = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=millis)
        year = made.year + 400 * cycle
        assert r.made == (f"{year:04}" if year >= 0 else str(year)) + made.strftime("-%m-%d %H:%M:%S.%f")[:-3]
