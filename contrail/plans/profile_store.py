"""Profiles that are kept file by file and merged: reuse that cannot be stale."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.csv_files import list_files
from ..sources.manifest import LOT_FILES, Registry
from ..sources.tables import folder_exists

_VERSION = ("source_file", "size", "modified")


class ProfileStore:
    """Row counts, null counts and value counts of a folder's files, one scan a file.

    What is known of a file holds for its path, size and modification time.  A report
    adds up the parts of the files that are there now: files that came are read, files
    that were replaced are read again, parts of files that went are left out.

    ``read`` maps (spark, files) to their rows.  ``columns`` are those whose values are
    counted; ``nested_csv`` takes every ``*.csv`` below the folder.  As with silver, a lot's parts are written first and its files are noted
    after, in one piece.
    """

    def __init__(self, spark: SparkSession, path: str, folder: str,
                 read: Callable[[SparkSession, list[str]], DataFrame],
                 columns: Sequence[str] = (), nested_csv: bool = False):
        self.spark, self.path, self.folder = spark, path, folder
        self.nested_csv = nested_csv
        self.read, self.columns = read, list(columns)
        self.known = Registry(spark, f"{path}/known", "lot string, source_file string, "
                                                      "size bigint, modified timestamp")

    def refresh(self) -> list[str]:
        """Profile the files that are not known as they are now; returns their names."""
        done: list[str] = []
        while True:
            fresh = self._there().join(self.known.rows(), list(_VERSION), "left_anti").limit(
                LOT_FILES).collect()
            if not fresh:
                return done
            names = [row.source_file for row in fresh]
            lot = f"lot{uuid.uuid4().hex}"
            self._profile(self.read(self.spark, names)).write.parquet(f"{self.path}/parts/{lot}")
            self.known.add(self.spark.createDataFrame(
                [(lot, *row) for row in fresh], self.known.schema))
            done += names

    def rows(self) -> int:
        """Rows of the table as it was at the last refresh, less files that went."""
        return self._parts().where("column_name = ''").agg(
            F.coalesce(F.sum("num_rows"), F.lit(0))).first()[0]

    def nulls(self, name: str = "nulls") -> DataFrame:
        """(column_name, nulls) for every column."""
        parts = self._parts().where("column_name = ''").select(
            "num_rows", F.explode("num_values").alias("column", "filled"))
        return parts.groupBy(F.col("column").alias("column_name")).agg(
            F.sum(F.col("num_rows") - F.col("filled")).alias(name)).orderBy(
            F.desc(name), "column_name")

    def frequent(self, column: str, n: int = 10, top: bool = True,
                 name: str = "count") -> DataFrame:
        """The ``n`` most (or least) frequent values, as text; ties go to the lower one."""
        if column not in self.columns:
            raise ValueError(f"values of {column} are not counted")
        counts = self._parts().where(F.col("column_name") == column).groupBy(
            F.col("value").alias(column)).agg(F.sum("num_rows").alias(name))
        return counts.orderBy(F.desc(name) if top else F.asc(name), column).limit(n)

    def _there(self) -> DataFrame:
        if not folder_exists(self.spark, self.folder):
            return self.known.rows().drop("lot").limit(0)
        return list_files(self.spark, self.folder, self.nested_csv).where("size > 0")

    def _profile(self, rows: DataFrame) -> DataFrame:
        """A row for each file, and one for each value of a counted column in it.

        All in one scan: each row is taken once as itself and once for each counted
        column, and both are combined before they are shuffled.
        """
        names = rows.columns
        inside = rows.select("*", F.col("_metadata.file_path").alias("source_file"))
        kinds = F.array(F.struct(F.lit("").alias("column_name"),
                                 F.lit(None).cast("string").alias("value")),
                        *(F.struct(F.lit(c).alias("column_name"),
                                   F.col(c).cast("string").alias("value")) for c in self.columns))
        taken = inside.select("*", F.inline(kinds))
        itself = F.col("column_name") == ""
        counted = taken.groupBy("source_file", "column_name", "value").agg(
            F.count(F.lit(1)).alias("num_rows"),
            *(F.count(F.when(itself, F.col(f"`{c}`"))).alias(f"n{i}")
              for i, c in enumerate(names)))
        values = F.map_from_arrays(F.array(*map(F.lit, names)),
                                   F.array(*(F.col(f"n{i}") for i in range(len(names)))))
        return counted.select("source_file", "column_name", "value", "num_rows",
                              F.when(itself, values).alias("num_values"))

    def _parts(self) -> DataFrame:
        """The parts of the files that are there as they were profiled."""
        known = self.known.rows().join(self._there(), list(_VERSION), "left_semi").select(
            "lot", "source_file")
        lots = [row[0] for row in self.known.rows().select("lot").distinct().collect()]
        if not lots:
            return self.spark.createDataFrame(
                [], "source_file string, column_name string, value string, num_rows bigint, "
                    "num_values map<string,bigint>")
        parts = self.spark.read.parquet(*(f"{self.path}/parts/{lot}" for lot in lots)).withColumn(
            "lot", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        return parts.join(known, ["lot", "source_file"], "left_semi")
