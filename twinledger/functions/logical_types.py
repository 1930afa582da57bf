"""Logical column types shared by both sides of a comparison.

A logical type is the target-side type name (``int8``, ``numeric``,
``timestamptz`` ...). It decides how a value becomes a comparison token, no
matter which Spark type either side happens to use.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class LogicalType:
    """``scale`` is the number of decimals a float is compared at."""

    udt: str
    scale: int | None = None


# Types whose text form differs between engines, so only
# NULL against not NULL is comparable.
OPAQUE_UDTS = frozenset({"json", "jsonb", "bytea", "bit"})
# Integer and timestamp type names.
INTEGER_UDTS = frozenset({"int2", "int4", "int8"})
TIMESTAMP_UDTS = frozenset({"timestamp", "timestamptz"})
FLOAT_UDTS = frozenset({"float4", "float8"})
# Table names that hold migration bookkeeping, never data.
EXCLUDED_TABLES = frozenset({"flyway_schema_history", "schema_migrations"})

DEFAULT_FLOAT_SCALE = 6

_UDT_OF_SPARK = {
    T.BooleanType: "bool",
    T.ByteType: "int2",
    T.ShortType: "int2",
    T.IntegerType: "int4",
    T.LongType: "int8",
    T.FloatType: "float4",
    T.DoubleType: "float8",
    T.DecimalType: "numeric",
    T.DateType: "date",
    T.TimestampType: "timestamptz",
    T.TimestampNTZType: "timestamp",
    T.BinaryType: "bytea",
    T.VariantType: "jsonb",
}

Types = Mapping[str, "LogicalType | str"]


def logical(t: LogicalType | str) -> LogicalType:
    return t if isinstance(t, LogicalType) else LogicalType(t)


def infer_types(df: DataFrame, overrides: Types | None = None) -> dict[str, LogicalType]:
    """Logical type per column from the Spark schema, with explicit overrides."""
    found = {
        f.name: LogicalType(_UDT_OF_SPARK.get(type(f.dataType), "text"))
        for f in df.schema.fields
    }
    for name, t in (overrides or {}).items():
        found[name] = logical(t)
    return found


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both sides have, in the left side's order."""
    there = set(right.columns)
    return [c for c in left.columns if c in there]


# Source data type -> target type names that are acceptable,
# apart from the types below that also depend on the full column type.
_PLAIN_TARGETS = {
    "smallint": "int2",
    "year": "int2",
    "mediumint": "int4",
    "float": "float4",
    "double": "float8",
    "decimal": "numeric",
    "numeric": "numeric",
    "tinytext": "text",
    "text": "text",
    "mediumtext": "text",
    "longtext": "text",
    "enum": "text",
    "set": "text",
    "date": "date",
    "time": "time",
    "datetime": "timestamptz",
    "timestamp": "timestamptz",
    "json": "json jsonb",
    "tinyblob": "bytea",
    "blob": "bytea",
    "mediumblob": "bytea",
    "longblob": "bytea",
    "binary": "bytea",
    "varbinary": "bytea",
}
# Source data type -> (exact column type, its target, target otherwise).
_DEPENDENT_TARGETS = {
    "tinyint": ("tinyint(1)", "bool", "int2"),
    "int": ("int unsigned", "int8", "int4"),
    "bigint": ("bigint unsigned", "numeric", "int8"),
    "bit": ("bit(1)", "bool", "bit"),
}
# Source types that keep their length, and the target name.
_SIZED_TARGETS = {"char": "bpchar", "varchar": "varchar"}


def expected_targets(data_type: Column, column_type: Column) -> Column:
    """Acceptable target types as an array; NULL when the source type is unknown."""
    out = F.lit(None).cast("string")
    for name, target in _PLAIN_TARGETS.items():
        out = F.when(data_type == name, F.lit(target)).otherwise(out)
    for name, (exact, special, usual) in _DEPENDENT_TARGETS.items():
        chosen = F.when(column_type == exact, F.lit(special)).otherwise(F.lit(usual))
        out = F.when(data_type == name, chosen).otherwise(out)
    length = F.regexp_extract(column_type, r"\(([0-9]+)", 1)
    for name, target in _SIZED_TARGETS.items():
        sized = F.when(length == "", F.lit(target)).otherwise(
            F.concat(F.lit(target + "("), length, F.lit(")"))
        )
        out = F.when(data_type == name, sized).otherwise(out)
    return F.split(out, " ")


def target_of(data_type: str, column_type: str) -> str | None:
    """Preferred target type name for one source column (metadata, not rows)."""
    data_type, column_type = data_type.lower(), column_type.lower()
    if data_type in _DEPENDENT_TARGETS:
        exact, special, usual = _DEPENDENT_TARGETS[data_type]
        return special if column_type == exact else usual
    if data_type in _SIZED_TARGETS:
        return _SIZED_TARGETS[data_type]
    plain = _PLAIN_TARGETS.get(data_type)
    return plain.split(" ")[0] if plain else None


# Target type name -> Spark type the converted column gets.
SPARK_TYPE_OF_TARGET = {
    "bool": "boolean",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "float4": "float",
    "float8": "double",
    "date": "date",
    "timestamp": "timestamp",
    "timestamptz": "timestamp",
    "bpchar": "string",
    "varchar": "string",
    "text": "string",
    "time": "string",
    "json": "string",
    "jsonb": "string",
    "bytea": "binary",
    "bit": "binary",
}
