"""Replaying one log that holds the changes of many tables.

All topics of an instance go into one sink, so records of tables with different columns are mixed. The log is
parsed once, into maps of fields, and stored by schema and table; each table then reads its own part
only and turns it into its own columns. Tables are told apart by schema and name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from twinledger.operators.changelog import instance_scope, parse_log, typed_events, unwrap
from twinledger.operators.diff import BROADCAST_ROWS
from twinledger.operators.replay import apply_changes
from twinledger.session import scratch_path
from twinledger.streaming.jobs import _start, append_batch, upserted

TableName = tuple[str, str]
_EVERYTHING_ELSE = "tables unknown to the target: "


@dataclass(frozen=True)
class TableSpec:
    """Columns and key of a target table, as DDL text or struct types."""

    row: T.StructType | str
    key: T.StructType | str

    @property
    def keys(self) -> list[str]:
        key = self.key if isinstance(self.key, T.StructType) else T.StructType.fromDDL(self.key)
        return key.names


def require_known_tables(parsed: DataFrame, tables: Mapping[TableName, TableSpec]) -> None:
    """Targets are never created: refuse a log with records of other tables."""
    names = parsed.sparkSession.createDataFrame(list(tables), "schema string, table string")
    other = parsed.select("schema", "table").distinct().join(names, ["schema", "table"], "left_anti")
    found = [f"{r['schema']}.{r['table']}" for r in other.orderBy("schema", "table").limit(20).collect()]
    if found:
        raise ValueError(_EVERYTHING_ELSE + ", ".join(found))


def store_parsed(log: DataFrame, path: str | None = None) -> DataFrame:
    """The records of ``log``, parsed once and stored with a folder for each schema and table."""
    path = path or scratch_path(log.sparkSession, "parsed-log")
    parsed = parse_log(log)
    parsed.write.mode("overwrite").partitionBy("schema", "table").parquet(path)
    names = {"schema", "table"}
    kept = T.StructType([f for f in parsed.schema.fields if f.name not in names]
                        + [T.StructField(c, T.StringType()) for c in ("schema", "table")])
    return log.sparkSession.read.schema(kept).parquet(path)


def events_of_table(parsed: DataFrame, name: TableName, spec: TableSpec) -> DataFrame:
    """Unwrapped events of one table out of ``store_parsed``; only its folder is read."""
    own = parsed.where((F.col("schema") == name[0]) & (F.col("table") == name[1]))
    return unwrap(typed_events(own, spec.row, spec.key))


def replay_all_tables(
    bases: Mapping[TableName, DataFrame],
    log: DataFrame,
    instance: str,
    tables: Mapping[TableName, TableSpec],
    exclude_schemas: Sequence[str] = (),
    unknown: str = "fail",
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> dict[TableName, DataFrame]:
    """The state of every table after the log of its instance.

    A table without a base starts empty. Records of tables that are not in ``tables`` fail the replay
    before anything is applied; with ``unknown='skip'`` they are left out.
    """
    if unknown not in ("fail", "skip"):
        raise ValueError("unknown is 'fail' or 'skip'")
    parsed = store_parsed(instance_scope(log, instance, exclude_schemas))
    if unknown == "fail":
        require_known_tables(parsed, tables)
    states = {}
    for name, spec in tables.items():
        base = bases.get(name)
        if base is None:
            base = log.sparkSession.createDataFrame([], spec.row)
        events = events_of_table(parsed, name, spec)
        states[name] = apply_changes(base, events, spec.keys, broadcast_rows=broadcast_rows)
    return states


def table_path(path: str, name: TableName) -> str:
    return f"{path}/tables/{name[0]}/{name[1]}"


def upsert_all_tables(
    log: DataFrame,
    instance: str,
    tables: Mapping[TableName, TableSpec],
    path: str,
    checkpoint: str,
    stream: str = "replay",
    once: bool = True,
    exclude_schemas: Sequence[str] = (),
    unknown: str = "fail",
) -> StreamingQuery:
    """One stream over the log of all tables: each batch is parsed and stored once below ``path/parsed``
    and then appended table by table. A repeated batch replaces what it wrote before, so a
    failure between two tables leaves nothing twice. ``state_of_table`` reads the result."""

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        parsed = store_parsed(batch, f"{path}/parsed/stream={stream}/batch={batch_id}")
        if unknown == "fail":
            require_known_tables(parsed, tables)
        present = {(r["schema"], r["table"]) for r in parsed.select("schema", "table").distinct().collect()
                   if (r["schema"], r["table"]) in tables}  # at most as many as tables
        for name in present:
            spec = tables[name]
            append_batch(events_of_table(parsed, name, spec), spec.keys, spec.row, table_path(path, name), stream, batch_id)

    scoped = instance_scope(log, instance, exclude_schemas)
    return _start(scoped.writeStream.foreachBatch(fan_out), checkpoint, once)


def state_of_table(base: DataFrame, name: TableName, spec: TableSpec, path: str) -> DataFrame:
    """``base`` with the changes a stream of ``upsert_all_tables`` has appended."""
    return upserted(base, spec.keys, table_path(path, name))
