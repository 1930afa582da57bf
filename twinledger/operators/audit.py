"""Data-quality audits around a type-converting load. Each is one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.tokens import quoted
from twinledger.functions.transforms import (
    has_non_ascii,
    has_replacement_character,
    is_zero_date,
)
from twinledger.operators.balance import (
    LEFT,
    RIGHT,
    aligned_keys,
    key_columns,
)


def per_column(aggregated: DataFrame, cols: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """One row per column out of a one-row aggregate.

    ``fields`` maps an output name to a prefix; the aggregate holds
    ``<prefix><position>`` for each column.
    """
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{prefix}{i}").alias(out) for out, prefix in fields.items()],
        )
        for i, c in enumerate(cols)
    ])
    exploded = aggregated.select(F.explode(rows).alias("x"))
    return exploded.select("x.column", *[f"x.{out}" for out in fields])


def null_audit(
    df: DataFrame,
    cols: Sequence[str],
) -> DataFrame:
    """``(column, null_count, verdict)`` for all columns from one scan."""
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    verdict = F.when(F.col("null_count") == 0, F.lit("clean")).otherwise(F.lit("dirty"))
    return per_column(counts, cols, {"null_count": "_n"}).withColumn("verdict", verdict)


def not_null_candidates(
    cat_columns: DataFrame, include_key: bool = True, include_binary: bool = True
) -> DataFrame:
    """``(table_name, column_name)`` declared NOT NULL and not self-numbering."""
    found = cat_columns.where(
        (F.col("is_nullable") == "NO")
        & ~F.coalesce(F.lower("extra").contains("auto_increment"), F.lit(False))
    )
    if not include_key:
        found = found.where(F.coalesce(F.col("column_key"), F.lit("")) != "PRI")
    if not include_binary:
        binary = F.col("data_type").endswith("blob") | F.col("data_type").isin("binary", "varbinary")
        found = found.where(~binary)
    return found.select("table_name", "column_name")


def zero_date_check(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Are all zero-dates of the source accounted for as NULLs on the target?

    ``left`` holds the dates as text. Columns without zero-dates are left out.
    """
    here = left.agg(
        *[F.count_if(is_zero_date(c)).alias(f"_z{i}") for i, c in enumerate(cols)],
        *[F.count_if(quoted(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    there = right.agg(
        *[F.count_if(quoted(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    )
    source = per_column(here, cols, {"zeros": "_z", "left_nulls": "_n"})
    target = per_column(there, cols, {"right_nulls": "_n"})
    expected = F.col("zeros") + F.col("left_nulls")
    status = (
        F.when(F.col("right_nulls") >= expected, F.lit("OK"))
        .when(F.col("right_nulls") >= F.col("left_nulls"), F.lit("PARTIAL"))
        .otherwise(F.lit("MISMATCH"))
    )
    missing = F.when(F.col("status") == "PARTIAL", expected - F.col("right_nulls"))
    return (
        source.where(F.col("zeros") > 0)
        .join(target, "column")
        .withColumn("status", status)
        .withColumn("shortfall", F.coalesce(missing, F.lit(0).cast("bigint")))
    )


def max_text_length(df: DataFrame, limits: Mapping[str, int | None]) -> DataFrame:
    """``(column, max_length, limit, too_long, would_truncate)`` per text column."""
    cols = list(limits)
    aggs = []
    for i, c in enumerate(cols):
        size = F.char_length(quoted(c)).cast("bigint")
        limit = F.lit(limits[c]).cast("bigint")
        aggs += [
            F.max(size).alias(f"_m{i}"),
            F.max(limit).alias(f"_l{i}"),
            F.count_if(size > limit).alias(f"_t{i}"),
        ]
    found = per_column(
        df.agg(*aggs), cols, {"max_length": "_m", "limit": "_l", "too_long": "_t"}
    )
    return found.withColumn("would_truncate", F.col("too_long") > 0)


def enum_label_diff(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """``(label, side)`` with ``both`` / ``left_only`` / ``right_only``."""
    labels = (
        left.select(quoted(col).alias("label"), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionAll(right.select(quoted(col), F.lit(0), F.lit(1)))
        .where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    )
    side = (
        F.when(F.col("_r") == 0, F.lit("left_only"))
        .when(F.col("_l") == 0, F.lit("right_only"))
        .otherwise(F.lit("both"))
    )
    return labels.select("label", side.alias("side"))


def _paired(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """One row per key with ``<name>_left`` / ``<name>_right`` of each value.

    Meant for unique keys; if a key repeats, its largest value is shown.
    """
    kinds = aligned_keys(left, right, keys)
    parts = []
    for df, side in ((left, LEFT), (right, RIGHT)):
        mine = [(v[0] if side == LEFT else v[1]).alias(n) for n, v in values.items()]
        parts.append(df.select(
            *key_columns(keys, kinds), F.lit(side).cast("bigint").alias("_side"), *mine
        ))
    here, there = F.col("_side") > 0, F.col("_side") < 0
    aggs = [F.count_if(here).alias("n_left"), F.count_if(there).alias("n_right")]
    for name in values:
        aggs.append(F.max(F.when(here, F.col(name))).alias(f"{name}_left"))
        aggs.append(F.max(F.when(there, F.col(name))).alias(f"{name}_right"))
    both = parts[0].unionByName(parts[1])
    return both.groupBy(*[quoted(k) for k in keys]).agg(*aggs)


def decimal_exactness(
    left: DataFrame, right: DataFrame, keys: Sequence[str], col: str
) -> DataFrame:
    """Keys on both sides whose decimals differ in any digit.

    A double on either side is refused: it has already lost the digits this
    check is about.
    """
    for df in (left, right):
        if df.schema[col].dataType.typeName() in ("double", "float"):
            raise TypeError(f"{col} is a floating-point column; compare exact decimals")
    pairs = _paired(left, right, keys, {"value": (quoted(col), quoted(col))}).where(
        (F.col("n_left") > 0) & (F.col("n_right") > 0)
    )
    differs = ~F.col("value_left").eqNullSafe(F.col("value_right"))
    return pairs.where(differs).select(
        *[quoted(k) for k in keys],
        F.col("value_left").alias("left_value"),
        F.col("value_right").alias("right_value"),
    )


_JSON_NULL, _JSON_INVALID, _JSON_OK = 0, 1, 2


# JSON by its lexical parts: strings, numbers, everything between them.
_JSON_TOKEN = r'(?s)"[^"]*+"|-?(?:0|[1-9][0-9]*+)(?:[.][0-9]++)?(?:[eE][+-]?[0-9]++)?|[^"0-9-]++|.'
_JSON_NUMBER = "^(-?)([0-9]+)(?:[.]([0-9]+))?(?:[eE]([+-]?[0-9]+))?$"


def _decimal_form(number: Column) -> Column:
    """One text for all spellings of a number: its digits without zeros at either end, and an exponent.

    Exact for any number of digits and for exponents of up to 36 digits; longer ones stay as they are.
    """
    part = [F.regexp_extract(number, _JSON_NUMBER, i) for i in range(5)]
    digits = F.concat(part[2], part[3])
    left = F.regexp_replace(digits, "^0+", "")
    bare = F.regexp_replace(left, "0+$", "")
    exponent = (
        F.when(part[4] == "", F.lit(0).cast("decimal(38,0)")).otherwise(part[4].try_cast("decimal(38,0)"))
        - F.length(part[3]) + F.length(left) - F.length(bare)
    )
    form = F.concat(part[1], bare, F.lit("e"), exponent.cast("string"))
    return F.when(bare == "", F.lit("0")).otherwise(F.coalesce(form, number))


def _json_state(col: str) -> tuple[Column, Column, Column]:
    # Escaped quotes and backslashes are spelled by their code, so a string ends at the next quote.
    plain = F.replace(F.replace(quoted(col), F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    tokens = F.regexp_extract_all(plain, F.lit(_JSON_TOKEN), F.lit(0))
    starts = lambda t: F.substring(t, 1, 1)
    number = lambda t: t.rlike(_JSON_NUMBER)
    # Numbers as strings marked n, strings marked s: the parser orders fields and never rounds a number.
    marked = F.transform(tokens, lambda t: F.when(number(t), F.concat(F.lit('"n'), _decimal_form(t), F.lit('"')))
                         .when(starts(t) == '"', F.concat(F.lit('"s'), F.substring(t, F.lit(2), F.length(t)))).otherwise(t))
    # A string may stand where a number may not (as a field name), so the text must also parse with numbers in
    # it. The parser ignores what follows a value; nothing but white space can do so both in [] and in {}.
    zeros = F.array_join(F.transform(tokens, lambda t: F.when(number(t), F.lit("0")).otherwise(t)), "")
    valid = F.lit(True)
    for before, behind in (("[", "]"), ('{"":', "}")):
        valid = valid & F.try_parse_json(F.concat(F.lit(before), zeros, F.lit(behind))).isNotNull()
    parsed = F.to_json(F.try_parse_json(F.array_join(marked, "")))
    state = (
        F.when(quoted(col).isNull(), F.lit(_JSON_NULL))
        .when(~valid | parsed.isNull(), F.lit(_JSON_INVALID))
        .otherwise(F.lit(_JSON_OK))
    )
    return state, F.xxhash64(parsed), F.xxhash64(F.lit(1), parsed)


def json_equal(left: DataFrame, right: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``(keys, verdict)`` for keys both sides hold.

    Field order does not matter, nor how a number is spelled: ``100``, ``100.0``
    and ``1.0E2`` are equal, and numbers beyond a double's range or precision are
    told apart exactly. Text that does not parse, also for a field name that
    occurs twice, is its own verdict and never equal to NULL.
    """
    kinds = aligned_keys(left, right, keys)
    parts = []
    for df, side in ((left, LEFT), (right, RIGHT)):
        state, h0, h1 = _json_state(col)
        parts.append(df.select(
            *key_columns(keys, kinds), F.lit(side).alias("_side"),
            state.alias("_state"), h0.alias("_h0"), h1.alias("_h1"),
        ))
    here, there = F.col("_side") > 0, F.col("_side") < 0
    pairs = parts[0].unionByName(parts[1]).groupBy(*[quoted(k) for k in keys]).agg(
        F.max(F.when(here, F.col("_state"))).alias("_l"),
        F.max(F.when(there, F.col("_state"))).alias("_r"),
        F.bit_xor("_h0").alias("_h0"),
        F.bit_xor("_h1").alias("_h1"),
    ).where(F.col("_l").isNotNull() & F.col("_r").isNotNull())
    l_bad, r_bad = F.col("_l") == _JSON_INVALID, F.col("_r") == _JSON_INVALID
    equal = (F.col("_l") == F.col("_r")) & (F.col("_h0") == 0) & (F.col("_h1") == 0)
    verdict = (
        F.when(l_bad & r_bad, F.lit("invalid_both"))
        .when(l_bad, F.lit("invalid_left"))
        .when(r_bad, F.lit("invalid_right"))
        .when(equal, F.lit("equal"))
        .otherwise(F.lit("different"))
    )
    return pairs.select(*[quoted(k) for k in keys], verdict.alias("verdict"))


def replacement_char_scan(df: DataFrame, text_cols: Sequence[str], keys: Sequence[str],
                          samples: int | None = None) -> DataFrame:
    """Key and text columns of rows that hold U+FFFD; all of them by default."""
    found = df.where(has_replacement_character(text_cols)).select(
        *[quoted(c) for c in [*keys, *text_cols]]
    )
    if samples is None:
        return found
    return found.orderBy(*[quoted(k) for k in keys]).limit(samples)


def replacement_char_count(df: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    """``corrupted``: number of rows that hold U+FFFD in any of the columns."""
    return df.agg(F.count_if(has_replacement_character(text_cols)).alias("corrupted"))


def non_ascii_scan(df: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    """``(column, non_ascii_rows, verdict)``; any such row makes it a ``RISK``."""
    counts = df.agg(
        *[F.count_if(has_non_ascii(c)).alias(f"_n{i}") for i, c in enumerate(text_cols)]
    )
    verdict = F.when(F.col("non_ascii_rows") > 0, F.lit("RISK")).otherwise(F.lit("OK"))
    return per_column(counts, text_cols, {"non_ascii_rows": "_n"}).withColumn("verdict", verdict)


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(rows, null_keys, duplicate_keys, surplus_rows, verdict)`` as one row.

    A key has to be complete and unique before any diff or replay. The count
    per key is combined before the shuffle, so a repeated key stays cheap.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | quoted(k).isNull()
    flagged = df.select(*[quoted(k) for k in keys], any_null.alias("_null"))
    per_key = flagged.groupBy(*[quoted(k) for k in keys], "_null").agg(F.count("*").alias("_n"))
    repeated = ~F.col("_null") & (F.col("_n") > 1)
    nothing = F.lit(0).cast("bigint")
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), nothing).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), nothing).alias("null_keys"),
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n") - 1)), nothing).alias("surplus_rows"),
    )
    bad = (F.col("null_keys") > 0) | (F.col("duplicate_keys") > 0)
    return totals.withColumn("verdict", F.when(bad, F.lit("unusable")).otherwise(F.lit("usable")))


def fk_orphans(
    child: DataFrame, fk_cols: Sequence[str], parent: DataFrame, pk_cols: Sequence[str]
) -> DataFrame:
    """Child rows whose complete foreign key has no parent row.

    Parents are not made distinct first: their key is unique, and an aggregate
    between shuffle and join would keep AQE from splitting a foreign key that
    a large part of the children share.
    """
    complete = F.lit(True)
    for c in fk_cols:
        complete = complete & quoted(c).isNotNull()
    have = parent.select(*[quoted(p).alias(f"_p{i}") for i, p in enumerate(pk_cols)])
    match = [quoted(c) == F.col(f"_p{i}") for i, c in enumerate(fk_cols)]
    return child.where(complete).join(have, match, "left_anti")


def fk_orphan_summary(
    child: DataFrame, fk_cols: Sequence[str], parent: DataFrame, pk_cols: Sequence[str]
) -> DataFrame:
    """``(fk, orphan_rows)`` per missing parent.

    Children are counted per foreign key before the join, so a value that most
    rows share is a single row in it.
    """
    counted = child.groupBy(*[quoted(c) for c in fk_cols]).agg(F.count("*").alias("orphan_rows"))
    return fk_orphans(counted, fk_cols, parent, pk_cols)


def parent_total_reconcile(
    parents: DataFrame,
    items: DataFrame,
    parent_key: str,
    item_key: str,
    total: str,
    amount: Column,
    tolerance: float | str = 0,
) -> DataFrame:
    """Parents whose total differs from the sum over their items.

    A parent without items is expected to hold 0.
    """
    sums = items.groupBy(quoted(item_key).alias("_parent")).agg(F.sum(amount).alias("_sum"))
    joined = parents.join(sums, quoted(parent_key) == F.col("_parent"), "left")
    expected = F.coalesce("_sum", F.lit(0))
    stated = quoted(total)
    off = stated.isNull() | (F.abs(stated - expected) > F.lit(tolerance))
    return joined.where(off).select(
        quoted(parent_key), stated.alias("stated_total"), expected.alias("item_total")
    )
