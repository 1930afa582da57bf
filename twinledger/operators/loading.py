"""Conversion of source-typed rows to their target types, with rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.logical_types import SPARK_TYPE_OF_TARGET, target_of
from twinledger.functions.tokens import quoted
from twinledger.functions.transforms import is_zero_date
from twinledger.session import delete, move, path_exists, scratch_path


@dataclass(frozen=True)
class SourceColumn:
    """One catalogue row: ``data_type`` is ``int``, ``column_type`` ``int unsigned``."""

    name: str
    data_type: str
    column_type: str
    precision: int = 38
    scale: int = 0


def _target_type(column: SourceColumn) -> str | None:
    target = target_of(column.data_type, column.column_type)
    if target == "numeric":
        if column.data_type.lower() == "bigint":
            return "decimal(20,0)"
        return f"decimal({column.precision},{column.scale})"
    return SPARK_TYPE_OF_TARGET.get(target or "")


def _convert(df: DataFrame, column: SourceColumn) -> Column:
    c, wanted = quoted(column.name), _target_type(column)
    dtype = df.schema[column.name].dataType
    if wanted is None:
        return c
    if wanted == "boolean":
        if isinstance(dtype, T.BooleanType):
            return c
        return c.try_cast("bigint") != 0
    if wanted in ("date", "timestamp"):
        if isinstance(dtype, T.StringType):
            return F.when(~is_zero_date(c), c.try_cast(wanted))
        return c.cast(wanted)
    if wanted in ("string", "binary"):
        return c.cast(wanted)
    return c.try_cast(wanted)


def cast_for_target(df: DataFrame, columns: Sequence[SourceColumn]) -> DataFrame:
    """Every listed column in its target type; zero-dates become NULL.

    Values that do not convert become NULL here; use ``load_with_rejects``
    where they must not be lost.
    """
    known = {c.name: c for c in columns}
    return df.select(*[
        _convert(df, known[name]).alias(name) if name in known else quoted(name)
        for name in df.columns
    ])


def convert_or_flag(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Adds the converted columns as ``_c<i>`` and ``_failed``, the columns that did not convert."""
    out, failed = df, []
    for i, (name, wanted) in enumerate(casts.items()):
        out = out.withColumn(f"_c{i}", quoted(name).try_cast(wanted))
        failed.append(
            F.when(quoted(name).isNotNull() & F.col(f"_c{i}").isNull(), F.lit(name))
        )
    return out.withColumn("_failed", F.array_compact(F.array(*failed)))


def load_with_rejects(
    df: DataFrame, casts: Mapping[str, str], policy: str = "continue"
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: rejects keep the original row plus ``reject_reason``.

    ``policy='exit'`` fails the job at the first row that does not convert;
    ``'continue'`` puts such rows aside.
    """
    if policy not in ("exit", "continue"):
        raise ValueError("policy is 'exit' or 'continue'")
    flagged = convert_or_flag(df, casts)
    bad = F.size("_failed") > 0
    reason = F.concat(F.lit("not convertible: "), F.array_join("_failed", ", "))
    position = {name: i for i, name in enumerate(casts)}
    converted = [
        F.col(f"_c{position[c]}").alias(c) if c in position else quoted(c) for c in df.columns
    ]
    if policy == "exit":
        # raise_error only runs for failing rows and is never true.
        kept = flagged.where(F.when(bad, F.raise_error(reason).isNotNull()).otherwise(True))
        return kept.select(*converted), flagged.where(F.lit(False)).select(
            *[quoted(c) for c in df.columns], reason.alias("reject_reason")
        )
    good = flagged.where(~bad).select(*converted)
    rejects = flagged.where(bad).select(
        *[quoted(c) for c in df.columns], reason.alias("reject_reason")
    )
    return good, rejects


class TooManyRejects(ValueError):
    """A load was stopped before its result became visible."""


def load_observed(
    df: DataFrame, casts: Mapping[str, str], target: str, max_rejects: int | None = None
) -> dict[str, int]:
    """Load ``df`` into the folder ``target``, good rows below ``good``, rejects below ``rejects``.

    The rows are read, converted and written once; ``total``, ``good`` and ``rejected`` are observed on
    that write. With more than ``max_rejects`` rejects nothing becomes visible and the load fails. The
    new folder takes the place of nothing: an existing ``target`` is refused.
    """
    spark = df.sparkSession
    if path_exists(spark, target):
        raise ValueError(f"{target} is there already")
    flagged = convert_or_flag(df, casts)
    bad = F.size("_failed") > 0
    position = {name: i for i, name in enumerate(casts)}
    # both forms of a converted column, of which a row has one
    columns = [quoted(c).alias(c) if c not in position else F.when(bad, quoted(c)).alias(c) for c in df.columns]
    columns += [F.when(~bad, F.col(f"_c{i}")).alias(f"_c{i}") for i in position.values()]
    reason = F.when(bad, F.concat(F.lit("not convertible: "), F.array_join("_failed", ", ")))
    seen = Observation()
    rows = flagged.select(*columns, reason.alias("reject_reason"), bad.alias("_rejected"))
    counted = rows.observe(seen, F.count("*").alias("total"), F.count_if("_rejected").alias("rejected"))
    staged = scratch_path(spark, "load")
    counted.write.partitionBy("_rejected").parquet(staged)
    found = seen.get
    counts = {"total": found["total"], "good": found["total"] - found["rejected"], "rejected": found["rejected"]}
    if max_rejects is not None and counts["rejected"] > max_rejects:
        delete(spark, staged)
        raise TooManyRejects(f"{counts['rejected']} rows do not convert, {max_rejects} are allowed")
    move(spark, staged, target)
    return counts


def loaded(df: DataFrame, casts: Mapping[str, str], target: str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of a finished ``load_observed`` with the same arguments."""
    position = {name: i for i, name in enumerate(casts)}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    stored = T.StructType([T.StructField(c, kinds[c]) for c in df.columns])
    for name, i in position.items():
        stored = stored.add(f"_c{i}", T.StructType.fromDDL(f"c {casts[name]}")["c"].dataType)
    stored = stored.add("reject_reason", "string").add("_rejected", "boolean")
    rows = df.sparkSession.read.schema(stored).parquet(target)
    good = rows.where(~F.col("_rejected")).select(*[
        F.col(f"_c{position[c]}").alias(c) if c in position else quoted(c) for c in df.columns])
    return good, rows.where(F.col("_rejected")).select(*[quoted(c) for c in df.columns], "reject_reason")
