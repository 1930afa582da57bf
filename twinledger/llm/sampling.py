"""Bounded, repeatable samples of rows for fitting models, and the split into learning and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % folds


def bounded_sample(df: DataFrame, key: str, bound: int, seed: int = 11) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of ``key``: all of a small input, the same rows on
    each run. A first cut by hash keeps the final ordering small, whatever the input."""
    rows = df.count()
    order = F.xxhash64(F.lit(seed), F.col(key))
    if rows > bound:
        share = min(1.0, 1.2 * bound / rows + 0.001)
        df = df.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
    return df.orderBy(order, F.col(key)).limit(bound)


def binary_labels(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """One row (id, label 0/1) per document; null labels and ids are left out, and a document with
    different labels counts as 0."""
    return (
        labels.select(F.col(id_col), F.col(label).cast("int").alias(label))
        .where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(id_col).agg(F.min(label).alias(label))
    )
