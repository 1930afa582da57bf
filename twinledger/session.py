"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on for right results, not for speed.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8,
                  **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("twinledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in {**REQUIRED_CONF, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else one below the warehouse.

    The warehouse is where the session keeps its tables, so it is shared too. On a cluster a folder
    taken from the warehouse must name a file system other than the machine's own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getCheckpointDir()
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        if not _is_local(spark) and (shared.startswith("file:") or "://" not in shared):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return shared.rstrip("/")


def check_conf(spark: SparkSession) -> None:
    """Refuse a session that lacks a setting results rely on."""
    wrong = {k: spark.conf.get(k, None) for k, v in REQUIRED_CONF.items() if spark.conf.get(k, None) != v}
    if wrong:
        raise ValueError(f"results rely on {REQUIRED_CONF}, the session has {wrong}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the scratch folder."""
    return f"{scratch_root(spark)}/twinledger/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within it drop their shuffle files when they end, for jobs whose results are stored.

    A Spark that does not know the setting keeps them until the driver collects its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if not spark.conf.isModifiable(name):
        yield
        return
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a stored folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a finished folder to ``target``, whose parent is made; both are in one file system."""
    old, new = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{path} could not be moved to {target}")
