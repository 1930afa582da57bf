import random

import pytest
from pyspark.sql import functions as F

from twinledger.functions.logical_types import LogicalType
from twinledger.operators import diff as D
from twinledger.operators import digest as G


def as_set(df):
    return {tuple(r) for r in df.collect()}


def brute(left, right):
    """Row diff of two dicts key -> value."""
    out = {(k, "left_only") for k in left if k not in right}
    out |= {(k, "right_only") for k in right if k not in left}
    return out | {(k, "changed") for k in left if k in right and left[k] != right[k]}


EDGE_KEYS = [-100001, -100000, -1, 0, 1, 999, 1000, 1001, 2000, 10**12]


@pytest.fixture(scope="module")
def edges(spark):
    left = {k: f"v{k}" for k in EDGE_KEYS}
    right = dict(left)
    del right[-1], right[1000]
    right[999] = ""
    left[999] = None
    right[0] = "changed"
    right[-7] = "extra"
    frames = [
        spark.createDataFrame(list(d.items()), "k bigint, v string") for d in (left, right)
    ]
    return *frames, brute(left, right)


METHODS = {
    "rows": lambda l, r: D.diff_rows(l, r, ["k"]),
    "merge": lambda l, r: D.diff_merge(l, r, ["k"]),
    "chunked": lambda l, r: D.diff_chunked(l, r, "k", chunk_size=1000),
    "chunked_lazy": lambda l, r: D.diff_chunked(l, r, "k", chunk_size=1000, drill="lazy"),
}


@pytest.mark.parametrize("method", METHODS)
def test_all_methods_agree_with_brute_force(edges, method):
    left, right, want = edges
    assert as_set(METHODS[method](left, right)) == want


@pytest.mark.parametrize("method", METHODS)
def test_empty_sides(edges, method):
    left, right, _ = edges
    none = left.where("false")
    n = left.count()
    assert as_set(METHODS[method](none, none)) == set()
    assert as_set(METHODS[method](left, left)) == set()
    assert METHODS[method](left, none).where("diff_type = 'left_only'").count() == n
    assert METHODS[method](none, left).where("diff_type = 'right_only'").count() == n


@pytest.mark.parametrize("pushed,broadcast", [(200, 10**6), (2, 10**6), (2, 2)])
def test_chunked_takes_every_way(spark, monkeypatch, pushed, broadcast):
    monkeypatch.setattr(D, "MAX_PUSHED_CHUNKS", pushed)
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
    rng = random.Random(3)
    left = {k: str(rng.random()) for k in range(-500, 3000)}
    right = {k: v for k, v in left.items() if k % 97}
    right.update({k: "x" for k in right if k % 89 == 0})
    frames = [
        spark.createDataFrame(list(d.items()), "k bigint, v string") for d in (left, right)
    ]
    assert as_set(D.diff_chunked(*frames, "k", chunk_size=100)) == brute(left, right)


@pytest.mark.parametrize("method", METHODS)
def test_null_keys_are_compared_too(spark, method):
    left = spark.createDataFrame([(None, "a"), (1, "b")], "k bigint, v string")
    right = spark.createDataFrame([(None, "z"), (1, "b")], "k bigint, v string")
    assert as_set(METHODS[method](left, right)) == {(None, "changed")}


@pytest.mark.parametrize("method", METHODS)
def test_one_key_with_a_third_of_all_rows(spark, method):
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 1000).cast("string").alias("v"),
    )
    fewer = hot.where("NOT (k = 5 AND v = '3')")
    assert as_set(METHODS[method](hot, hot)) == set()
    assert as_set(METHODS[method](hot, fewer)) == {(5, "changed")}


@pytest.mark.parametrize("method", METHODS)
def test_repeated_rows_do_not_cancel(spark, method):
    left = spark.createDataFrame([(1, "a"), (1, "a")], "k bigint, v string")
    right = spark.createDataFrame([(1, "b"), (1, "b")], "k bigint, v string")
    assert as_set(METHODS[method](left, right)) == {(1, "changed")}


def test_key_types_may_differ(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (3, "b")], "k bigint, v string")
    want = {(2, "left_only"), (3, "right_only")}
    assert as_set(D.diff_rows(left, right, ["k"])) == want
    assert as_set(D.diff_merge(left, right, ["k"])) == want
    text = right.withColumn("k", F.col("k").cast("string"))
    assert as_set(D.diff_rows(left, text, ["k"])) == {("2", "left_only"), ("3", "right_only")}


def test_sub_second_and_opaque_differences_are_invisible_by_default(spark):
    left = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 00:00:00.1' AS t, '{}' AS j")
    right = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 00:00:00.9' AS t, '[]' AS j")
    kinds = {"j": "json"}
    assert as_set(D.diff_rows(left, right, ["k"], kinds)) == set()
    assert as_set(D.diff_rows(left, right, ["k"], kinds, ts_precision="micro")) == {(1, "changed")}
    same_time = right.withColumn("t", F.lit("2024-01-01 00:00:00.1").cast("timestamp_ntz"))
    assert as_set(D.diff_rows(left, same_time, ["k"], kinds, compare_opaque="md5")) == {
        (1, "changed")
    }


def test_only_common_columns_count(spark):
    left = spark.createDataFrame([(1, "a", "x")], "k int, v string, l string")
    right = spark.createDataFrame([("y", "a", 1)], "r string, v string, k int")
    assert as_set(D.diff_rows(left, right, ["k"])) == set()


def test_odd_column_names(spark):
    left = spark.createDataFrame([(1, "a")], ["a key", "v.1"])
    right = spark.createDataFrame([(1, "b")], ["a key", "v.1"])
    assert as_set(D.diff_rows(left, right, ["a key"])) == {(1, "changed")}
    assert as_set(D.column_diff(left, right, ["a key"])) == {(1, "v.1", "a", "b", False)}


def test_count_only_buckets_miss_a_swap_and_exact_ones_do_not(spark):
    left = spark.range(0, 1000, 2).toDF("k")
    right = left.where("k <> 10").union(spark.createDataFrame([(11,)], "k bigint"))
    want = {(10, "missing"), (11, "extra")}
    assert as_set(D.diff_bucketed(left, right, "k", 100)) == want
    assert as_set(D.diff_bucketed(left, right, "k", 100, exact=False)) == set()
    assert as_set(D.diff_bucketed(left, right, "k", 100, broadcast_rows=None)) == want
    assert as_set(D.diff_bucketed(left, right, "k", 100, broadcast_rows=0)) == want
    assert as_set(D.key_set_diff(left, right, ["k"])) == want
    none = left.where("false")
    assert as_set(D.diff_bucketed(none, none, "k", 100)) == set()
    assert D.diff_bucketed(left, none, "k", 100).count() == 500


def test_composite_keys_with_separator_text(spark):
    left = spark.createDataFrame([("a\t", "b"), ("a", "\tb")], "x string, y string")
    right = spark.createDataFrame([("a\t", "b")], "x string, y string")
    assert as_set(D.key_set_diff(left, right, ["x", "y"])) == {("a", "\tb", "missing")}
    assert as_set(D.key_minus(left, right, ["x", "y"])) == {("a", "\tb")}


def test_column_diff_and_counts(spark):
    left = spark.createDataFrame(
        [(1, "a", 1.0, "{}"), (2, None, 2.0, None), (3, "", 3.0, "{}"), (4, "d", 4.0, "{}")],
        "k int, s string, d double, j string",
    )
    right = spark.createDataFrame(
        [(1, "a", 1.5, "[]"), (2, "", 2.0, "{}"), (3, None, 3.0, "{}"), (5, "d", 4.0, "{}")],
        "k int, s string, d double, j string",
    )
    kinds = {"j": "jsonb", "d": LogicalType("float8", 2)}
    want = {
        (1, "d", "1.0", "1.5", False), (2, "s", None, "", False), (2, "j", None, "{}", True),
        (3, "s", "", None, False),
    }
    assert as_set(D.column_diff(left, right, ["k"], kinds)) == want
    assert as_set(D.column_diff(left, right, ["k"], kinds, broadcast_rows=100)) == want
    assert as_set(D.changed_column_counts(left, right, ["k"], kinds)) == {
        ("s", 2), ("d", 1), ("j", 1)
    }


def test_one_sided_inspect(spark):
    left = spark.createDataFrame([("7", "a"), ("8", "b"), ("ABC", "c")], "k string, v string")
    right = spark.createDataFrame([("007", "a"), ("abc", "c")], "k string, v string")
    want = {("7", "a", D.SAME_KEY_OTHER_FORM), ("8", "b", D.KEY_ABSENT),
            ("ABC", "c", D.SAME_KEY_OTHER_FORM)}
    assert as_set(D.one_sided_inspect(left, right, ["k"])) == want
    assert {r[0] for r in as_set(D.one_sided_inspect(left, right, ["k"], side="right"))} == {
        "007", "abc"
    }
    assert D.one_sided_inspect(left, right, ["k"], limit=1).count() == 1


def test_samples_are_in_typed_order(spark):
    df = spark.createDataFrame([(k, "changed") for k in (10, 9, 100, 1)], "k int, diff_type string")
    assert [r.k for r in D.ordered_samples(df, ["k"], 3).collect()] == [1, 9, 10]
    picked = D.sample_per_diff_type(df, ["k"], 2)
    assert as_set(picked.select("k", "rank")) == {(1, 1), (9, 2)}


def test_fetch_rows_by_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    keys = spark.createDataFrame([(3,), (1,), (9,)], "k int")
    assert as_set(D.fetch_rows_by_key(df, keys, ["k"])) == {(1, "a"), (3, "c")}
    assert [tuple(r) for r in D.fetch_rows_by_key(df, keys, ["k"], 1).collect()] == [(1, "a")]
    for limit in (None, 0, 100):
        assert as_set(D.missing_rows(df, keys, ["k"], limit)) == {(2, "b")}
    nulls = spark.createDataFrame([(None, "n"), (1, "a")], "k int, v string")
    for limit in (None, 0, 100):
        assert as_set(D.missing_rows(nulls, nulls, ["k"], limit)) == {(None, "n")}


# -- digests -------------------------------------------------------------------


def test_drill_ranges():
    assert G.drill_ranges([1, 2, 9, 3, 5, 6], 5) == [(1, 3), (5, 6), (9, 9)]
    assert G.drill_ranges([], 5) == []
    assert G.drill_ranges([-3, -1, 4], 5) == [(-3, -3), (-1, -1), (4, 4)]


def test_chunk_digest_is_order_independent_and_bounded(spark):
    rows = [(k, f"v{k}") for k in EDGE_KEYS]
    kinds = {"k": "int8", "v": "text"}
    a = spark.createDataFrame(rows, "k bigint, v string")
    b = spark.createDataFrame(rows[::-1], "k bigint, v string").repartition(7)
    args = ("k", ["k", "v"], kinds, 1000)
    assert as_set(G.chunk_digest(a, *args)) == as_set(G.chunk_digest(b, *args))
    counts = {r.chunk_id: r.n for r in G.chunk_digest(a, *args).collect()}
    assert counts == {-101: 1, -100: 1, -1: 1, 0: 3, 1: 2, 2: 1, 10**9: 1}
    assert G.chunk_digest(a, *args, bound=999).agg(F.sum("n")).first()[0] == 6


def test_table_digest_of_nothing(spark):
    none = spark.createDataFrame([], "k bigint")
    assert [int(x) for x in G.table_digest(none, ["k"], {"k": "int8"}).first()] == [0] * 5


def test_table_digest_is_the_sum_of_its_chunks(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    kinds = {"c_custkey": "int8", "c_name": "text"}
    whole = G.table_digest(df, df.columns, kinds).first()
    parts = G.chunk_digest(df, "c_custkey", df.columns, kinds, 10)
    summed = parts.agg(*[F.sum(c) for c in ("n", "s0", "s1", "s2", "s3")]).first()
    assert [int(x) for x in whole] == [int(x) for x in summed]


def test_snapshot_bound(spark):
    left = spark.createDataFrame([(1,), (5,)], "k bigint")
    right = spark.createDataFrame([(1,), (5,), (6,), (-2,)], "k bigint")
    a, b = G.snapshot_bound(left, right, "k")
    assert as_set(a) == {(1,), (5,)} and as_set(b) == {(1,), (5,), (-2,)}
    a, b = G.snapshot_bound(left.where("false"), right, "k")
    assert a.count() == 0 and b.count() == 4


def test_key_range(spark):
    df = spark.range(10).toDF("k")
    assert G.key_range(df, "k", 2, 5).count() == 4
    assert G.key_range(df, "k", 2, 5, half_open=True).count() == 3


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    from twinledger.operators.balance import small_enough, written

    stored = written(spark.range(10).select(F.repeat(F.lit("x"), 100).alias("k")), "test")
    assert small_enough(stored, 10) and not small_enough(stored, 9)
    assert small_enough(stored, 10, 1000) and not small_enough(stored, 10, 999)
    assert small_enough(written(spark.range(0), "test"), 0)


def _odd_sides(spark, kind):
    """Copies with NULL keys, repeated and changed rows; integer, composite or mixed key types."""
    rows_l = [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (None, 1, "n"), (7, 7, "s"), (9, 9, "same")]
    rows_r = [(1, 1, "A"), (2, 1, "b"), (4, 2, "d"), (None, 1, "m"), (7, 7, "s"), (9, 9, "same")]
    left, right = (spark.createDataFrame(r, "k bigint, j bigint, v string") for r in (rows_l, rows_r))
    if kind == "mixed":
        text = F.when(F.col("k") == 7, "007").otherwise(F.col("k").cast("string"))
        right = right.withColumn("k", text)
    return left, right, ["k", "j"] if kind == "composite" else ["k"]


@pytest.mark.parametrize("kind", ["integer", "composite", "mixed"])
def test_every_limit_gives_the_same_rows(spark, kind):
    left, right, keys = _odd_sides(spark, kind)
    limits = (None, 0, 10**6)

    def rows(df):
        return sorted(map(str, df.collect()))

    diffs = [rows(D.column_diff(left, right, keys, broadcast_rows=n)) for n in limits]
    assert diffs[0] == diffs[1] == diffs[2] and len(diffs[0]) == 2
    lost = [rows(D.missing_rows(left, right, keys, broadcast_rows=n)) for n in limits]
    assert lost[0] == lost[1] == lost[2] and len(lost[0]) == (3 if kind == "mixed" else 2)
    if kind == "integer":
        right = right.where("k IS NOT NULL")
        found = [rows(D.diff_bucketed(left, right, "k", 2, broadcast_rows=n)) for n in limits]
        assert found[0] == found[1] == found[2] == rows(D.key_set_diff(left, right, ["k"]))
        assert any("None" in r for r in found[0])


def test_rows_are_fetched_by_null_and_mixed_keys(spark):
    left, _, keys = _odd_sides(spark, "integer")
    wanted = spark.createDataFrame([("1",), (None,), ("8",)], "k string")
    assert sorted(r.v for r in D.fetch_rows_by_key(left, wanted, keys).collect()) == ["a", "n"]


def test_chunks_refuse_other_keys(spark):
    df = spark.createDataFrame([(99.5, "x")], "k double, v string").withColumn("k", F.col("k").cast("decimal(10,1)"))
    with pytest.raises(ValueError, match="integer key"):
        D.diff_chunked(df, df, "k")
