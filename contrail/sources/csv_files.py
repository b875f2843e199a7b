"""CSV scans, batch and streaming."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes are doubled inside quoted fields, and spaces belong to the value: what is
# written is read back as it was.
PLAIN_CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
# For what is written: the same texts in about a third of the space.
PACKED = {"compression": "gzip"}
# Spark otherwise leaves out files that are a week older than the newest one seen.
ANY_AGE = {"maxFileAge": "36500d"}
_NESTED = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}


def literal_path(path: str) -> str:
    """A path whose characters all stand for themselves, where patterns are read."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.csv`` below ``folder``: path, length and modification time.

    Only the listing is read; the content column is pruned away.
    """
    return (spark.read.format("binaryFile").options(**_NESTED).load(literal_path(folder))
            .select("path", "length", F.col("modificationTime").alias("modified")))


def list_files(spark: SparkSession, folder: str, nested_csv: bool = False) -> DataFrame:
    """(source_file, size, modified) of the files of ``folder``, named as scans name them.

    A folder that a stream writes lists what its commit log holds.  ``nested_csv``
    takes every ``*.csv`` below instead.  Contents are not read.
    """
    reader = spark.read.format("binaryFile")
    if nested_csv:
        reader = reader.options(**_NESTED)
    return reader.load(literal_path(folder)).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"))


def scan_csv(spark: SparkSession, path: str | list[str],
             schema: T.StructType | None = None, nested: bool = False,
             check_header: bool = False, flat: bool = False) -> DataFrame:
    """Read CSV with a header row.

    Without ``schema`` the types are inferred, which reads the data twice; give
    one for anything large.  CSV columns bind by position: ``check_header``
    makes a file whose header differs from the schema an error instead of
    quietly swapped columns.  ``nested`` searches sub-folders; ``flat`` reads the
    ``*.csv`` files of the folders given and no others, and adds no columns from
    folder names.
    """
    reader = spark.read.options(**PLAIN_CSV)
    if nested:
        reader = reader.options(**_NESTED)
    if flat:
        paths = [path] if isinstance(path, str) else path
        path = [f"{one.rstrip('/')}/*.csv" for one in paths]
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", not check_header).schema(schema).csv(path)


def schema_of_sample(spark: SparkSession, file: str) -> T.StructType:
    """The inferred schema of one chosen file, for reuse as a fixed schema.

    Choose a file that has all columns filled: an empty column infers as text.
    """
    return scan_csv(spark, file).schema


def stream_csv(spark: SparkSession, path: str, schema: T.StructType,
               files_per_batch: int | None = None, nested: bool = False,
               check_header: bool = False, archive: str | None = None) -> DataFrame:
    """Files of a folder, or of a pattern, as a stream; ``files_per_batch`` bounds a step.

    Files count however old they are, so a backfill with its times kept is read.
    For that the stream remembers the name of every file it has read: a feed of
    many small files should give ``archive``, a folder outside ``path`` to which
    finished files are moved (one step after they were read).
    """
    reader = (spark.readStream.options(**PLAIN_CSV, **ANY_AGE)
              .option("enforceSchema", not check_header).schema(schema))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if nested:
        reader = reader.options(**_NESTED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)
