"""Registries of files: which source files a run has taken on, which files were counted.

A registry is a folder of small Parquet files, one for each addition.  An addition is
written as a single file, so it is there in whole or not at all.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv_files import list_files, literal_path
from .landing import contract_positions, count_rows, file_headers, split_header
from .tables import folder_exists

#: Files of a lot: what one landing stream is given, and what passes through the driver.
LOT_FILES = 5_000


class Registry:
    """Rows about files in a folder of their own."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def rows(self) -> DataFrame:
        """All rows added so far."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        """Add rows in one piece; columns are cast to the registry's."""
        empty = self.spark.createDataFrame([], self.schema)
        (rows.select(*(F.col(f.name).cast(f.dataType) for f in empty.schema))
         .coalesce(1).write.mode("append").parquet(self.path))


class SourceManifest:
    """The source files that have been taken on, lot by lot, with their headers and rows.

    A lot is pinned before it is landed: counts, headers and the landing stream all
    work on the same files, whatever arrives or goes meanwhile.  No file is opened
    for its header again once it is pinned.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.files = Registry(spark, f"{path}/files",
                              "lot int, source_file string, header string, num_rows bigint, "
                              "size bigint, modified timestamp, recorded timestamp")
        self.landed = Registry(spark, f"{path}/landed", "lot int, finished timestamp")

    def new_files(self, folders: list[str]) -> DataFrame:
        """(source_file, size, modified) of files with content that no lot holds.

        A folder that is empty or not there has none.
        """
        there = [list_files(self.spark, folder, nested_csv=True) for folder in folders
                 if folder_exists(self.spark, folder)]
        if not there:
            return self.spark.createDataFrame(
                [], "source_file string, size bigint, modified timestamp")
        listed = reduce(DataFrame.unionByName, there).where("size > 0").dropDuplicates(
            ["source_file"])
        return listed.join(self.files.rows().select("source_file"), "source_file", "left_anti")

    def pin(self, folders: list[str], at_most: int | None = None) -> int:
        """Make a lot of the oldest new files over all folders; returns how many.

        Only these are opened: once for the header, once to count their rows.  A file
        without the contract columns fails the run before anything is pinned.
        """
        room = LOT_FILES if at_most is None else min(at_most, LOT_FILES)
        chosen = self.new_files(folders).orderBy("modified", "source_file").limit(room).collect()
        if not chosen:
            return 0
        names = [row.source_file for row in chosen]
        headers = {row.path: row.header
                   for row in file_headers(self.spark, names).select("path", "header").collect()}
        for name in names:
            if name not in headers:
                raise FileNotFoundError(f"{name} went while it was being pinned")
            contract_positions(split_header(headers[name]))
        lot = (self.files.rows().agg(F.max("lot")).first()[0] or 0) + 1
        rows = self.spark.createDataFrame(
            [(lot, r.source_file, headers[r.source_file], r.size, r.modified) for r in chosen],
            "lot int, source_file string, header string, size bigint, modified timestamp")
        self.files.add(rows.join(count_rows(self.spark, names), "source_file", "left")
                       .na.fill(0, ["num_rows"]).withColumn("recorded", F.current_timestamp()))
        return len(names)

    def pending(self) -> list[tuple[str, str]]:
        """(file, header) of the lots that were not landed in whole: one lot at most."""
        return [(row.source_file, row.header) for row in self.files.rows().join(
            self.landed.rows(), "lot", "left_anti").orderBy("source_file").collect()]

    def finish(self) -> None:
        """Note that all lots are landed."""
        lots = self.files.rows().select("lot").distinct().join(
            self.landed.rows(), "lot", "left_anti")
        self.landed.add(lots.withColumn("finished", F.current_timestamp()))


class FileCounts:
    """Rows of every file of the layers, each file counted once.

    ``count`` maps (spark, files) to (source_file, num_rows).  Counts stay when files
    go: they are what a layer has taken in.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.known = Registry(spark, path, "layer string, source_file string, num_rows bigint")

    def update(self, layer: str, folder: str, count: Callable) -> int:
        """Count the files of ``folder`` that are not known yet; returns how many.

        Their names pass the driver lot by lot, as those of any files to be read do.
        """
        if not folder_exists(self.spark, folder):
            return 0
        total = 0
        while True:
            known = self.known.rows().where(F.col("layer") == layer).select("source_file")
            names = [row[0] for row in list_files(self.spark, folder).where("size > 0").select(
                "source_file").join(known, "source_file", "left_anti").limit(LOT_FILES).collect()]
            if not names:
                return total
            asked = self.spark.createDataFrame([(name,) for name in names], "source_file string")
            self.known.add(asked.join(count(self.spark, names), "source_file", "left")
                           .na.fill(0, ["num_rows"]).withColumn("layer", F.lit(layer)))
            total += len(names)

    def rows_of(self, layer: str) -> int:
        """Rows of all files that were counted for the layer."""
        return self.known.rows().where(F.col("layer") == layer).agg(
            F.coalesce(F.sum("num_rows"), F.lit(0))).first()[0]


def count_parquet(spark: SparkSession, files: list[str]) -> DataFrame:
    """(source_file, num_rows) of Parquet files; no column is read, only footers are."""
    scan = spark.read.parquet(*(literal_path(unquote(file)) for file in files))
    return scan.groupBy(F.col("_metadata.file_path").alias("source_file")).agg(
        F.count(F.lit(1)).alias("num_rows"))
