"""Writing results. Every writer is a distributed Spark write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions.tokens import quoted


def write_missing_rows(rows: DataFrame, path: str) -> None:
    """Full rows as CSV with a header line per file."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_key_list(rows: DataFrame, keys: Sequence[str], path: str) -> None:
    """Keys in typed order, parts joined by a tab; file order is key order."""
    line = F.concat_ws("\t", *[quoted(k).cast("string") for k in keys]).alias("value")
    rows.orderBy(*[quoted(k) for k in keys]).select(line).write.mode("overwrite").text(path)


def write_report(result: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Result rows (per-table status, totals, failures) as parquet or JSON."""
    result.write.mode("overwrite").format(fmt).save(path)


def write_bucketed_copy(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as the table ``name``, bucketed and sorted by its keys, and read back.

    For copies that are compared again and again: ``diff_stored_copies`` of two copies with the same keys
    and buckets needs no shuffle. Rows are dealt to their buckets before the write, so a bucket is one file.
    """
    dealt = df.repartition(buckets, *[quoted(k) for k in keys])
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)
