"""The streaming hops: source files to landed, landed to bronze, bronze to silver.

All hops are stateless appends.  The checkpoint remembers what was read, the
sink's commit log what was published: a restarted query takes up where it
stopped and readers never see half a batch.

No shuffle is needed before the partitioned sinks: a landed file holds one month,
so each task writes to one year.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .. import contracts as C
from ..operators.cleaning import add_ingest_metadata, clean_flights, clean_with_rescue
from ..session import row_groups_of, writers_open
from ..sources.csv_files import PACKED, PLAIN_CSV
from ..sources.landing import LAND_KEYS, stream_landed, stream_pinned, with_land_keys
from ..sources.manifest import SourceManifest
from ..sources.tables import move_files, stream_table
from .control import ProgressLog, finish

BRONZE_QUERY = "flights_landed_to_bronze"
SILVER_QUERY = "flights_bronze_to_silver"
LANDING_QUERY = "flights_source_to_landed"

# Bytes of a row group in bronze.  A step to silver may take few files: several tasks
# share a file only by its row groups.
BRONZE_ROW_GROUP = 8 << 20


def stream_writer(frame: DataFrame, checkpoint: str, name: str,
                  partition_by: str | tuple[str, ...] | None = None,
                  mode: str = "append", fmt: str = "parquet",
                  until_caught_up: bool = True) -> DataStreamWriter:
    """A checkpointed writer, not yet started: call ``.start(path)``.

    ``until_caught_up`` takes everything there is and stops; otherwise the query
    runs on, batch after batch.
    """
    writer = (frame.writeStream.format(fmt).outputMode(mode).queryName(name)
              .option("checkpointLocation", checkpoint))
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    if partition_by:
        keys = (partition_by,) if isinstance(partition_by, str) else partition_by
        writer = writer.partitionBy(*keys)
    return writer


def start_landing(sources: list[DataFrame], target: str, checkpoint: str,
                  until_caught_up: bool = True) -> StreamingQuery:
    """Land streams of contract rows as monthly CSV folders, compressed.

    Readers tell by the names (``*.csv.gz``).  Such a file cannot be split, but holds
    what one task of a step read for one month, so it is never larger than a split.
    """
    rows = with_land_keys(reduce(DataFrame.unionByName, sources))
    with writers_open(rows.sparkSession):
        return (stream_writer(rows, checkpoint, LANDING_QUERY, LAND_KEYS, fmt="csv",
                              until_caught_up=until_caught_up)
                .options(**PLAIN_CSV, **PACKED).start(target))


def land_new_files(spark: SparkSession, manifest: SourceManifest, sources: list[str],
                   target: str, checkpoint: str, files_per_batch: int | None = None,
                   at_most: int | None = None, archive: str | None = None,
                   timeout: float = 3600, log: ProgressLog | None = None) -> int:
    """Land the source files that ``manifest`` does not have; returns how many.

    Files are pinned lot by lot, and each lot is landed by a stream over exactly its
    files: what arrives meanwhile waits for the next lot or the next run.  A lot that
    an earlier run pinned and did not finish comes first; what it had landed already
    the checkpoint knows.  ``at_most`` bounds the run over all folders together.
    Landed files are moved below ``archive`` if it is given.
    """
    landed = 0
    while True:
        pending = manifest.pending()
        if not pending:
            room = None if at_most is None else at_most - landed
            if room is not None and room <= 0:
                break
            manifest.pin(sources, room)
            pending = manifest.pending()
            if not pending:
                break
        finish(start_landing([stream_pinned(spark, pending, files_per_batch)], target,
                             checkpoint), timeout, log)
        manifest.finish()
        landed += len(pending)
        if archive:
            move_files(spark, [file for file, _ in pending], archive)
    return landed


def start_bronze(spark: SparkSession, landed: str, bronze: str, checkpoint: str,
                 source: str, files_per_batch: int | None = None,
                 until_caught_up: bool = True, name: str = BRONZE_QUERY,
                 fmt: str = "parquet") -> StreamingQuery:
    """Landed files to the bronze table, with metadata, partitioned by year."""
    rows = add_ingest_metadata(
        stream_landed(spark, landed, files_per_batch), source, "Year")
    with writers_open(spark), row_groups_of(spark, BRONZE_ROW_GROUP):
        return stream_writer(rows, checkpoint, name, C.YEAR_PARTITION, fmt=fmt,
                             until_caught_up=until_caught_up).start(bronze)


def start_silver(spark: SparkSession, bronze: str, silver: str, checkpoint: str,
                 files_per_batch: int | None = None, until_caught_up: bool = True,
                 name: str = SILVER_QUERY, fmt: str = "parquet") -> StreamingQuery:
    """Bronze table to the silver table, cleaned, partitioned by year."""
    rows = clean_flights(stream_table(spark, bronze, C.BRONZE, fmt, files_per_batch))
    with writers_open(spark):
        return stream_writer(rows, checkpoint, name, C.YEAR_PARTITION, fmt=fmt,
                             until_caught_up=until_caught_up).start(silver)


def start_silver_with_rescue(spark: SparkSession, bronze: str, target: str, checkpoint: str,
                             files_per_batch: int | None = None, until_caught_up: bool = True,
                             name: str = SILVER_QUERY) -> StreamingQuery:
    """As ``start_silver``, and what silver's types could not hold goes beside it.

    One pass writes both, as partitions of ``target``: read them with ``silver_part``
    and ``rescued_part``, which each touch their own folders alone.
    """
    rows = clean_with_rescue(stream_table(spark, bronze, C.BRONZE, "parquet", files_per_batch))
    with writers_open(spark):
        return stream_writer(rows, checkpoint, name, ("kind", C.YEAR_PARTITION),
                             until_caught_up=until_caught_up).start(target)


def silver_part(spark: SparkSession, target: str) -> DataFrame:
    """The silver rows of a target that holds rescued texts too."""
    return spark.read.schema(C.RESCUED).parquet(target).where("kind = 'clean'").select(
        *C.SILVER.names)


def rescued_part(spark: SparkSession, target: str) -> DataFrame:
    """(p_Year, column_name, text, source_file): what silver could not hold."""
    return spark.read.schema(C.RESCUED).parquet(target).where("kind = 'rescue'").select(
        C.YEAR_PARTITION, "column_name", "text", "source_file")
