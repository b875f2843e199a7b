"""Session settings, database selection and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DATABASE = "flight_lake"

# Parallelism and memory are left to the cluster: tying them to the driver's
# core count or RAM would cap every job at one machine's size.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Table sizes are judged by their compressed files; broadcasts by what they
    # take in memory.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # The JVM never compiles a method beyond 8000 bytes; past that, separately
    # generated expressions beat one fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "contrail", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """Build or reuse a session; ``settings`` override the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settings_table(spark: SparkSession, keys: tuple[str, ...] = tuple(SESSION_SETTINGS)):
    """The settings in force as a two-column DataFrame."""
    rows = [(key, spark.conf.get(key, None)) for key in keys]
    return spark.createDataFrame(rows, "setting string, value string")


def ensure_database(spark: SparkSession, name: str = DATABASE) -> str:
    """Create the database if it is missing; returns its name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name


def use_database(spark: SparkSession, name: str = DATABASE) -> None:
    """Create the database if it is missing and make it current."""
    spark.sql(f"USE {ensure_database(spark, name)}")


# Partitions of a table that a task writes side by side, unsorted.
OPEN_WRITERS = 100


@contextmanager
def writers_open(spark: SparkSession, most: int = OPEN_WRITERS) -> Iterator[None]:
    """Partitioned writes and streams started inside keep a file open for each partition.

    Otherwise each task sorts all its rows by their partition first, in memory and, where
    that is short, on disk.  A task that meets more than ``most`` partitions sorts the rest.
    """
    with setting_held(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)):
        yield


@contextmanager
def row_groups_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Parquet writes and streams started inside make row groups of ``size`` bytes."""
    with setting_held(spark, "parquet.block.size", str(size)):
        yield


@contextmanager
def setting_held(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    """``setting`` has ``value`` inside and is as it was afterwards."""
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, for tables a job writes midway.

    A cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    session, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # ``local-cluster`` has executors with folders of their own.
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(
                "set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="contrail-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
