"""The daily summary by increments: new silver files alone are read.

Each lot of new files leaves its sums by day and carrier; days that a lot touches are
summed up anew from such sums, the others are taken over as they stand.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..operators.daily import daily_state, summary_of_state
from ..sources.csv_files import list_files, literal_path
from ..sources.manifest import LOT_FILES, Registry
from ..sources.tables import folder_exists


class GoldState:
    """What is known of the silver files taken in so far, in the folder ``path``.

    A lot's sums are written first and its files noted after, in one piece: sums of a lot
    that was not noted are never read, so a run that ended midway is repeated in whole.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.taken = Registry(spark, f"{path}/taken", "lot string, source_file string")
        self.applied = Registry(spark, f"{path}/applied", "lot string")

    def take_in(self, folder: str) -> int:
        """Sum up the files of the silver ``folder`` that are new; returns how many."""
        total = 0
        while folder_exists(self.spark, folder):
            names = [row[0] for row in list_files(self.spark, folder).where("size > 0").select(
                "source_file").join(self.taken.rows(), "source_file", "left_anti")
                .limit(LOT_FILES).collect()]
            if not names:
                break
            lot = f"lot{uuid.uuid4().hex}"
            silver = self.spark.read.schema(C.SILVER).parquet(
                *(literal_path(unquote(name)) for name in names))
            daily_state(silver).write.parquet(f"{self.path}/sums/{lot}")
            self.taken.add(self.spark.createDataFrame(
                [(lot, name) for name in names], "lot string, source_file string"))
            total += len(names)
        return total

    def fresh_lots(self) -> list[str]:
        """Lots taken in and not yet applied to the summary."""
        return [row[0] for row in self.taken.rows().select("lot").distinct().join(
            self.applied.rows(), "lot", "left_anti").orderBy("lot").collect()]

    def sums(self, lots: list[str] | None = None) -> DataFrame:
        """The sums of the given lots, or of all."""
        if lots is None:
            lots = [row[0] for row in self.taken.rows().select("lot").distinct().collect()]
        return self.spark.read.parquet(*(f"{self.path}/sums/{lot}" for lot in lots))

    def summary(self, before: DataFrame | None, lots: list[str]) -> DataFrame:
        """The summary ``before`` with the days that ``lots`` touch summed up anew."""
        if before is None:
            return summary_of_state(self.sums())
        days = self.sums(lots).select("date").distinct()
        same = F.col("old.date").eqNullSafe(F.col("day.date"))
        kept = before.alias("old").join(days.alias("day"), same, "left_anti")
        same = F.col("sums.date").eqNullSafe(F.col("day.date"))
        anew = self.sums().alias("sums").join(days.alias("day"), same, "left_semi")
        return kept.unionByName(summary_of_state(anew))

    def mark_applied(self, lots: list[str]) -> None:
        """Note that the stored summary holds these lots."""
        self.applied.add(self.spark.createDataFrame([(lot,) for lot in lots], "lot string"))
