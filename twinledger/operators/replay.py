"""Applying an ordered change log to a base copy, in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions.arithmetic import floor_div
from twinledger.functions.logical_types import Types, common_columns, infer_types
from twinledger.functions.tokens import quoted
from twinledger.operators.balance import diff_kind, small_enough, written
from twinledger.operators.changelog import require_keys, split_keyless
from twinledger.operators.digest import (
    DEFAULT_CHUNK_SIZE,
    DIGEST_SUMS,
    chunk_digest,
    drill_ranges,
    keyed_balance,
    ranges_predicate,
)

LOG_ORDER = ("partition", "offset")


def latest_per_key(
    events: DataFrame, keys: Sequence[str], order: Sequence[str] = LOG_ORDER
) -> DataFrame:
    """The last event of every key in log order.

    An aggregate, not a window: each task sends one row per key, however often
    a hot key was changed.
    """
    rest = [c for c in events.columns if c not in set(keys)]
    last = F.max_by(
        F.struct(*[quoted(c) for c in rest]), F.struct(*[quoted(o) for o in order])
    )
    grouped = events.groupBy(*[quoted(k) for k in keys]).agg(last.alias("_last"))
    return grouped.select(
        *[quoted(k) for k in keys], *[F.col("_last")[c].alias(c) for c in rest]
    ).select(*[quoted(c) for c in events.columns])


def require_known_columns(events: DataFrame, allowed: Sequence[str]) -> None:
    """The target is never altered: refuse columns it does not have."""
    control = {"_deleted", "table", "schema", "partition", "offset", "timestamp"}
    extra = [c for c in events.columns if c not in set(allowed) | control]
    if extra:
        raise ValueError(f"columns unknown to the target table: {', '.join(extra)}")


def apply_changes(
    base: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = LOG_ORDER,
    on_error: str = "fail",
    broadcast_rows: int | None = None,
) -> DataFrame:
    """``base`` after all ``events``: upsert by key, delete on ``_deleted``.

    Changed keys are removed from the base by an anti join and the live images
    are appended, so untouched rows are never aggregated. Applying the same log
    again gives the same state. The last event of each key is stored first, so the
    log is read and parsed once. With ``broadcast_rows`` changed keys that are
    few are broadcast and the base is not shuffled at all.

    ``on_error='continue'`` sets records without a key aside; ``replay_rejects``
    returns them.
    """
    if on_error not in ("fail", "continue"):
        raise ValueError("on_error is 'fail' or 'continue'")
    require_known_columns(events, base.columns)
    usable = require_keys(events, keys) if on_error == "fail" else split_keyless(events, keys)[0]
    last = written(latest_per_key(usable, keys, order), "last-events")
    touched = last.select(*[quoted(k) for k in keys])
    if broadcast_rows is not None and small_enough(touched, broadcast_rows):
        touched = F.broadcast(touched)
    live = last.where(~F.col("_deleted"))
    untouched = base.join(touched, list(keys), "left_anti")
    return untouched.select(*[quoted(c) for c in base.columns]).unionByName(
        live.select(*[quoted(c) for c in base.columns])
    )


def replay_rejects(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The records ``apply_changes(on_error='continue')`` sets aside, whole."""
    return split_keyless(events, keys)[1]


def verify_replay(
    state: DataFrame, source: DataFrame, keys: Sequence[str], types: Types | None = None
) -> DataFrame:
    """``(state_rows, source_rows, left_only, right_only, changed, verdict)``.

    Row counts and content come from the same pass, so the replay runs once.
    """
    cols, known = common_columns(state, source), infer_types(source, types)
    merged = keyed_balance(state, source, keys, cols, known)
    kind = diff_kind(F.col("n_left"), F.col("n_right"), F.col("same"))
    nothing = F.lit(0).cast("bigint")
    counts = merged.select("n_left", "n_right", kind.alias("kind")).agg(
        F.coalesce(F.sum("n_left"), nothing).alias("state_rows"),
        F.coalesce(F.sum("n_right"), nothing).alias("source_rows"),
        *[
            F.count_if(F.col("kind") == k).alias(k)
            for k in ("left_only", "right_only", "changed")
        ],
    )
    clean = F.col("left_only") + F.col("right_only") + F.col("changed") == 0
    verdict = F.when(clean, F.lit("VERIFIED")).otherwise(F.lit("DIFF"))
    return counts.withColumn("verdict", verdict)


def verify_chunks(
    digests: DataFrame, source: DataFrame, change: DataFrame, pk: str, cols: Sequence[str], types: Types,
    chunk_size: int = DEFAULT_CHUNK_SIZE, max_ranges: int = 1_000, **options,
) -> DataFrame:
    """``(chunk_id, n_state, n_source, same)`` of the chunks that a change touched.

    ``digests`` are those of the replayed state after the change. Of the source only the key ranges of these
    chunks are read, pushed into the scan while they are few and joined by chunk otherwise.
    """
    touched = written(change.select("chunk_id").distinct(), "touched-chunks")
    near = touched.agg(F.count("*").alias("n")).first()["n"] <= max_ranges
    if near:
        ids = [r["chunk_id"] for r in touched.collect()]
        part = source.where(ranges_predicate(pk, drill_ranges(ids), chunk_size))
    else:
        part = source.join(touched, floor_div(quoted(pk), chunk_size) == F.col("chunk_id"), "left_semi")
    theirs = chunk_digest(part, pk, cols, types, chunk_size, **options)
    mine = digests.join(touched, "chunk_id", "left_semi")
    same = F.lit(True)
    for c in DIGEST_SUMS:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    none = F.lit(0).cast("bigint")
    found = touched.join(mine.alias("l"), "chunk_id", "left").join(theirs.alias("r"), "chunk_id", "left")
    return found.select("chunk_id", F.coalesce(F.col("l.n"), none).alias("n_state"),
                        F.coalesce(F.col("r.n"), none).alias("n_source"), same.alias("same"))


def changed_images(
    state: DataFrame, events: DataFrame, keys: Sequence[str], order: Sequence[str] = LOG_ORDER
) -> tuple[DataFrame, DataFrame]:
    """``(before, after)``: the rows of ``state`` that a batch of events replaces or deletes, and those it puts there.

    The old images come from the state, since a capture only writes whole ones where the source table is set
    up for it.
    """
    last = written(latest_per_key(events, keys, order), "changed-rows")
    before = state.join(last.select(*[quoted(k) for k in keys]), list(keys), "left_semi")
    return before, last.where(~F.col("_deleted")).select(*[quoted(c) for c in state.columns])
