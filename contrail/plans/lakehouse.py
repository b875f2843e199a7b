"""The whole lakehouse as one job: land, bronze, silver, gold, dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..operators.calendar import calendar_for
from ..operators.cleaning import drop_empty_planes, split_airports
from ..functions import to_whole
from ..operators.daily import daily_summary
from ..session import DATABASE, ensure_database
from ..sources.csv_files import scan_csv
from ..sources.landing import count_rows
from ..sources.manifest import FileCounts, SourceManifest, count_parquet
from ..sources.tables import (comment_columns, folder_exists, read_table, register_table,
                              write_table)
from ..streaming.control import ProgressLog, finish
from ..sources.versions import TableVersions
from ..streaming.hops import land_new_files, start_bronze, start_silver
from .gold import GoldState


@dataclass(frozen=True)
class Lake:
    """Where everything is kept: folders below ``root``, tables in ``database``.

    ``root`` must be reachable from every executor.
    """

    root: str
    database: str = DATABASE
    fmt: str = "parquet"

    def folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{table}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @property
    def landed(self) -> str:
        return f"{self.root.rstrip('/')}/landed"


def refresh_flights(spark: SparkSession, lake: Lake, sources: list[str],
                    label: str, files_per_batch: int | None = None,
                    timeout: float = 24 * 3600, max_files: int | None = None,
                    archive: str | None = None) -> DataFrame:
    """Bring new source files through to silver, each hop taking what is new.

    Folders of ``sources`` may mix headers: each file is read by its own.  Run
    again after more files have arrived: only those are opened.  Each lot of files is
    pinned before it is landed, so a file that arrives meanwhile waits for the next
    run, and empty folders are a run of no files.
    ``files_per_batch`` bounds what each step of a hop takes on.  ``max_files``
    bounds the run: at most so many new files of all folders together are landed, the
    oldest first; the rest is left for later runs.  ``archive`` names a folder below
    which landed source files are moved.

    The table ``landing_ledger`` holds every file taken on, with its header and rows;
    ``stream_progress`` every batch of every hop.  Then the layers are counted and must
    agree.  Returns that count, one row: source_rows, landed_rows, bronze_rows,
    silver_rows, files_landed, files_left.
    """
    manifest, log = SourceManifest(spark, lake.folder("landing")), ProgressLog(spark)
    landed = land_new_files(spark, manifest, sources, lake.landed, lake.checkpoint("landing"),
                            files_per_batch, max_files, archive, timeout, log)
    ensure_database(spark, lake.database)
    if folder_exists(spark, lake.landed):
        finish(start_bronze(spark, lake.landed, lake.folder("flight_bronze"),
                            lake.checkpoint("bronze"), label, files_per_batch,
                            fmt=lake.fmt), timeout, log)
        finish(start_silver(spark, lake.folder("flight_bronze"),
                            lake.folder("flight_silver"), lake.checkpoint("silver"),
                            files_per_batch, fmt=lake.fmt), timeout, log)
        for name in ("flight_bronze", "flight_silver"):
            register_table(spark, lake.table(name), lake.folder(name), lake.fmt)
        register_table(spark, lake.table("landing_ledger"), manifest.files.path)
        log.store(spark, lake.folder("stream_progress"))
    left = manifest.new_files(sources).count()
    return account(spark, lake).withColumns(
        {"files_landed": F.lit(landed).cast("bigint"), "files_left": F.lit(left).cast("bigint")})


def account(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows at the source, landed, in bronze and in silver; fails when they differ.

    Each file of a layer is counted once, when it is new: landed files by a scan,
    stored ones from their footers.
    """
    counts = FileCounts(spark, lake.folder("file_counts"))
    found = {"source_rows": SourceManifest(spark, lake.folder("landing")).files.rows().agg(
        F.coalesce(F.sum("num_rows"), F.lit(0))).first()[0]}
    counts.update("landed", lake.landed, count_rows)
    found["landed_rows"] = counts.rows_of("landed")
    for layer in ("bronze", "silver"):
        folder = lake.folder(f"flight_{layer}")
        if lake.fmt == "parquet":
            counts.update(layer, folder, count_parquet)
            found[f"{layer}_rows"] = counts.rows_of(layer)
        else:
            found[f"{layer}_rows"] = spark.read.format(lake.fmt).load(folder).count()
    if len(set(found.values())) > 1:
        raise ValueError(f"row counts differ: {found}")
    return spark.createDataFrame([tuple(found.values())],
                                 ", ".join(f"{name} bigint" for name in found))


def build_gold(spark: SparkSession, lake: Lake) -> int:
    """Create or update the daily summary and the calendar; returns the files read.

    Only silver files that no earlier build has read are read, and only their days are
    summed up anew.  The summary is stored in date order; it has one row per day, so the
    sort is over thousands of rows however many flights there are.
    """
    name = lake.table("daily_flights")
    if lake.fmt != "parquet":
        summary = daily_summary(read_table(spark, lake.table("flight_silver")))
        store(spark, lake, "daily_flights", summary.orderBy("date"), "overwrite")
        store(spark, lake, "calendar_days", calendar_for(read_table(spark, name)), "overwrite")
        return 0
    state = GoldState(spark, lake.folder("daily_state"))
    files = state.take_in(lake.folder("flight_silver"))
    lots = state.fresh_lots()
    if lots:
        before = read_table(spark, name) if spark.catalog.tableExists(name) else None
        store(spark, lake, "daily_flights", state.summary(before, lots).orderBy("date"),
              "overwrite")
        state.mark_applied(lots)
        store(spark, lake, "calendar_days", calendar_for(read_table(spark, name)), "overwrite")
    return files


def load_lookups(spark: SparkSession, lake: Lake, airport: str, plane: str,
                 cancellation: str, carrier: str, mode: str = "errorifexists") -> None:
    """Load the four lookup files; a lookup already stored is an error.

    The files are read by contract: codes stay text (``01`` is not 1), and a file
    with another header fails.
    """
    ensure_database(spark, lake.database)
    frames = {
        "airport_places": split_airports(read_codes(spark, airport)),
        "plane_register": drop_empty_planes(read_planes(spark, plane)),
        "cancellation_silver": read_codes(spark, cancellation),
        "carrier_names": read_codes(spark, carrier),
    }
    for name, frame in frames.items():
        store(spark, lake, name, frame, mode)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """A code list file: Code and Description as text."""
    return scan_csv(spark, path, C.CODE_LIST, check_header=True)


def read_planes(spark: SparkSession, path: str) -> DataFrame:
    """The plane file with its contract's types; an unreadable date or year is NULL."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in C.PLANE.names])
    rows = scan_csv(spark, path, text, check_header=True)
    american = F.try_to_timestamp("issue_date", F.lit("MM/dd/yyyy")).cast("date")
    return rows.withColumns({
        "issue_date": F.coalesce(F.col("issue_date").try_cast("date"), american),
        "year": to_whole(F.col("year"))}).select(
            *(F.col(f.name).cast(f.dataType) for f in C.PLANE.fields))


def store(spark: SparkSession, lake: Lake, name: str, frame: DataFrame,
          mode: str) -> None:
    """Write one table and register it.

    ``overwrite`` makes a new version: see ``versions_of``.
    """
    if mode == "overwrite":
        versions_of(spark, lake).publish(lake.table(name), frame)
        return
    path = lake.folder(name)
    if mode == "errorifexists" and spark.catalog.tableExists(lake.table(name)):
        raise ValueError(f"table {lake.table(name)} already exists")
    write_table(frame, path, mode=mode, fmt=lake.fmt)
    register_table(spark, lake.table(name), path, lake.fmt)


def versions_of(spark: SparkSession, lake: Lake) -> TableVersions:
    """The versions of the tables that are replaced, to read, hold or expire them."""
    return TableVersions(spark, f"{lake.root.rstrip('/')}/versioned", lake.fmt)


def document(spark: SparkSession, lake: Lake) -> None:
    """Put the data dictionary on the registered tables."""
    for name, comments in C.DICTIONARY.items():
        comment_columns(spark, lake.table(name), comments)
