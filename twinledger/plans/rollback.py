"""Deciding whether a replay is safe, running it, and proving the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.logical_types import Types
from twinledger.operators.changelog import (
    after_positions,
    dedupe_events,
    instance_scope,
    parse_envelope,
    retention_guard,
    unwrap,
)
from twinledger.operators.diff import BROADCAST_ROWS
from twinledger.operators.replay import apply_changes, verify_replay


def readiness(log: DataFrame, instance: str, cutover: Column, now: Column) -> DataFrame:
    """``(topics, unsafe_topics, verdict)`` over all data topics of an instance."""
    topics = retention_guard(instance_scope(log, instance), cutover, now)
    found = topics.agg(
        F.count("*").alias("topics"), F.count_if(~F.col("safe")).alias("unsafe_topics")
    )
    ready = (F.col("topics") > 0) & (F.col("unsafe_topics") == 0)
    return found.withColumn("verdict", F.when(ready, F.lit("READY")).otherwise(F.lit("UNSAFE")))


def events_of(
    log: DataFrame,
    instance: str,
    row_schema: T.StructType | str,
    key_schema: T.StructType | str,
    positions: Mapping[tuple[str, int], int] | DataFrame | None = None,
    deduped: bool = False,
) -> DataFrame:
    """Unwrapped events of one instance, from the snapshot positions on.

    Repeated records need no removal before a replay, since only the last
    event of a key counts; ``deduped`` removes them anyway.
    """
    scoped = after_positions(instance_scope(log, instance), {} if positions is None else positions)
    if deduped:
        scoped = dedupe_events(scoped)
    return unwrap(parse_envelope(scoped, row_schema, key_schema))


def copy_and_catch_up(
    base: DataFrame,
    log: DataFrame,
    instance: str,
    keys: Sequence[str],
    row_schema: T.StructType | str,
    key_schema: T.StructType | str,
    positions: Mapping[tuple[str, int], int] | DataFrame,
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> DataFrame:
    """Full copy plus every change behind its snapshot positions.

    A table without a key is copied and not updated.
    """
    if not keys:
        return base
    events = events_of(log, instance, row_schema, key_schema, positions)
    return apply_changes(base, events, keys, broadcast_rows=broadcast_rows)


def replay_and_verify(
    base: DataFrame,
    events: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    types: Types | None = None,
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> DataFrame:
    """Replay onto ``base`` and compare the outcome with ``source``."""
    state = apply_changes(base, events, keys, broadcast_rows=broadcast_rows)
    return verify_replay(state, source, keys, types)
