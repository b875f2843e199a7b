"""Versions of stored tables: every replacement is a folder of its own, kept for a while."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .manifest import Registry
from .tables import delete_folder, folder_exists, register_table, write_table


class TableVersions:
    """The folders that each table name has pointed at, below ``root``.

    A new version is written to a folder of its own and the table is then pointed
    there, so a reader never meets a half-replaced table.  Older folders stay for
    queries that still read them until ``expire`` finds them old enough; the folder a
    table points at, and versions on hold, are spared whatever their age.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self._made = Registry(spark, f"{self.root}/versions/made",
                              "table_name string, version int, folder string, made timestamp")
        self._current = Registry(spark, f"{self.root}/versions/current",
                                 "table_name string, version int, since timestamp")
        self._held = Registry(spark, f"{self.root}/versions/held",
                              "table_name string, version int, since timestamp, until timestamp")
        self._expired = Registry(spark, f"{self.root}/versions/expired",
                                 "table_name string, version int, expired timestamp")

    def publish(self, name: str, frame: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Write a new version of the catalog table ``name`` and point it there."""
        version = (self._made.rows().where(F.col("table_name") == name)
                   .agg(F.max("version")).first()[0] or 0) + 1
        folder = f"{self.root}/{name.rsplit('.', 1)[-1]}-v{version}-{uuid.uuid4().hex[:8]}"
        write_table(frame, folder, partition_by, fmt=self.fmt)
        self._made.add(self._row(name, version).select(
            "*", F.lit(folder).alias("folder"), F.current_timestamp().alias("made")))
        self._point(name, version, folder)
        return version

    def versions(self, name: str) -> DataFrame:
        """(version, folder, made, current, held, expired) of a table, all versions."""
        mine = F.col("table_name") == name
        now = self._current.rows().where(mine).agg(F.max_by("version", "since")).first()[0]
        held = (self._held.rows().where(mine).groupBy("version")
                .agg(F.max_by("until", "since").alias("until"))
                .where(F.col("until") > F.current_timestamp())
                .select("version", F.lit(True).alias("held")))
        gone = self._expired.rows().where(mine).select(
            "version", F.lit(True).alias("expired")).distinct()
        return (self._made.rows().where(mine).drop("table_name")
                .withColumn("current", F.col("version") == F.lit(now))
                .join(held, "version", "left").join(gone, "version", "left")
                .na.fill(False, ["held", "expired"]))

    def read(self, name: str, version: int) -> DataFrame:
        """The rows of one version, current or not; an expired one is an error."""
        return self.spark.read.format(self.fmt).load(self._folder(name, version))

    def roll_back(self, name: str, version: int) -> None:
        """Point the table at an earlier (or later) version that is still there."""
        self._point(name, version, self._folder(name, version))

    def hold(self, name: str, version: int, seconds: float) -> None:
        """Spare a version for so long from now, for a reader that takes its time; the
        last call for a version counts, and 0 seconds release it."""
        now = F.current_timestamp()
        self._held.add(self._row(name, version).select(
            "*", now.alias("since"),
            F.timestamp_micros(F.unix_micros(now) + int(seconds * 1e6)).alias("until")))

    def expire(self, name: str, older_than: float) -> list[int]:
        """Delete the folders of versions made over ``older_than`` seconds ago; returns
        their numbers.  Few folders of one table, so they go through the driver."""
        age = (F.unix_micros(F.current_timestamp()) - F.unix_micros("made")) / 1e6
        due = self.versions(name).where(~F.col("current") & ~F.col("held") & ~F.col("expired")
                                        & (age >= older_than)).orderBy("version").collect()
        for row in due:
            # Noted first: a version that is half deleted is never read again.
            self._expired.add(self._row(name, row.version).withColumn(
                "expired", F.current_timestamp()))
            delete_folder(self.spark, row.folder)
        return [row.version for row in due]

    def stored(self, name: str) -> list[int]:
        """The versions whose folders are there."""
        return [row.version for row in self.versions(name).orderBy("version").collect()
                if folder_exists(self.spark, row.folder)]

    def _row(self, name: str, version: int) -> DataFrame:
        return self.spark.range(1).select(F.lit(name).alias("table_name"),
                                          F.lit(version).alias("version"))

    def _folder(self, name: str, version: int) -> str:
        found = self.versions(name).where((F.col("version") == version)
                                          & ~F.col("expired")).first()
        if found is None:
            raise ValueError(f"table {name} has no version {version}")
        return found.folder

    def _point(self, name: str, version: int, folder: str) -> None:
        register_table(self.spark, name, folder, self.fmt)
        self._current.add(self._row(name, version).withColumn("since", F.current_timestamp()))
