"""Reading tables and change logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.tokens import quoted
from twinledger.operators.changelog import INTERNAL_MARK, LOG_SCHEMA


def read_table(
    spark: SparkSession,
    location: str,
    name: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """One table below ``location``, a folder or a ``jdbc:`` URL; columns and filter reach the scan."""
    if location.startswith("jdbc:"):
        df = read_jdbc_table(spark, location, name)
    else:
        df = spark.read.format(fmt).load(f"{location.rstrip('/')}/{name}.{fmt}")
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*[quoted(c) for c in columns])


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    pk: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """One database table, read in parallel by ranges of its integer key.

    The driver jar has to be on the class path. Without ``pk`` and ``bounds``
    the table comes through a single connection.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if pk is not None and bounds is not None:
        reader = reader.options(
            partitionColumn=pk,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def read_change_log(
    spark: SparkSession,
    path: str,
    topic_regex: str | None = None,
    exclude: Sequence[str] = (),
    streaming: bool = False,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Change-log records in the columns of Spark's Kafka source.

    ``path`` holds parquet or JSON files. ``fmt='kafka'`` reads brokers given
    as ``path`` instead and lets them do the topic selection; ``options`` go to
    the reader (``startingOffsets``, ``maxOffsetsPerTrigger``).
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    if fmt == "kafka":
        raw = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", path)
            .option("subscribePattern", topic_regex or ".*")
            .option("startingOffsets", options.get("startingOffsets", "earliest"))
            .load()
        )
        log = raw.select(
            "topic", "partition", "offset", "timestamp",
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        )
    else:
        reader = reader.schema(LOG_SCHEMA)
        if streaming and max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        log = reader.format(fmt).load(path)
    log = log.where(~F.col("topic").contains(INTERNAL_MARK))
    if topic_regex is not None:
        log = log.where(F.col("topic").rlike(topic_regex))
    return log if not exclude else log.where(~F.col("topic").isin(*exclude))
