"""Stored tables: writing, registering, describing, reading, tailing.

``fmt`` is ``parquet`` throughout; ``delta`` works wherever its jar is on the
session's classpath.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import writers_open
from .csv_files import ANY_AGE, literal_path

_COMMENT_PROPERTY = "column_comment."


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes the folder: readers then follow its commit log alone."""
    return folder_exists(spark, f"{path}/_spark_metadata")


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    try:
        spark.read.format("binaryFile").load(literal_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it, as the driver's JVM sees them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def move_files(spark: SparkSession, files: Sequence[str], target: str) -> None:
    """Move files (as ``_metadata.file_path`` names them) below ``target``, each to the
    place that its own path names there.  A file that is gone already is left out."""
    for file in files:
        system, path = _file_system(spark, unquote(file))
        _, moved = _file_system(spark, target.rstrip("/") + path.toUri().getPath())
        if system.exists(path):
            system.mkdirs(moved.getParent())
            if not system.rename(path, moved):
                raise OSError(f"could not move {file} to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    system, path = _file_system(spark, path)
    system.delete(path, True)


def refuse_streamed(spark: SparkSession, path: str, mode: str) -> None:
    """Fail before rows are added where no reader would see them."""
    if mode != "errorifexists" and is_streamed(spark, path):
        raise ValueError(f"{path} is written by a stream: rows added by a batch write "
                         "are not in its commit log and would never be read")


def write_table(frame: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "errorifexists", fmt: str = "parquet",
                regroup: bool = True) -> None:
    """Write a table folder; by default an existing one is an error.

    A partitioned write is rebalanced on its keys first: few well-sized files
    per partition, with an oversized partition split over several tasks.
    ``regroup=False`` skips that shuffle for rows already laid out by the keys.
    A folder that a stream writes is refused.
    """
    if fmt != "delta":
        refuse_streamed(frame.sparkSession, path, mode)
    if partition_by and regroup:
        frame = frame.hint("rebalance", *(F.col(key) for key in partition_by))
    with writers_open(frame.sparkSession):
        frame.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)


def register_table(spark: SparkSession, name: str, path: str,
                   fmt: str = "parquet") -> None:
    """(Re)point catalog table ``name`` at the folder ``path``.

    An entry with the same columns stays and is pointed at the folder, so readers
    always find the table and its comments remain.  Otherwise the entry is made
    anew, with the comments of the columns that are still there.  The table is
    external: the old data are left alone.
    """
    comments: dict[str, str] = {}
    if spark.catalog.tableExists(name):
        columns = [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]
        found = spark.read.format(fmt).load(literal_path(path)).dtypes
        if sorted(columns) == sorted(found) and fmt != "delta":
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(path)}")
            if _partition_columns(spark, name):
                spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)
            return
        kept = {column for column, _ in found}
        comments = {row["col_name"]: row["comment"] for row in
                    describe_table(spark, name).collect()
                    if row["comment"] and row["col_name"] in kept}
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION {_literal(path)}")
    if fmt != "delta" and _partition_columns(spark, name):
        spark.catalog.recoverPartitions(name)
    comment_columns(spark, name, comments)


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name)
            if column.isPartition]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table with its current files, not a remembered listing."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Tail a table folder: rows already there, then rows as they arrive.

    A folder written by a stream is followed through its commit log, so every
    committed row is seen exactly once.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.options(**ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader if fmt == "delta" else reader.schema(schema)).load(path)


def comment_columns(spark: SparkSession, table: str, comments: dict[str, str]) -> None:
    """Store a comment on each named column of a registered table.

    The catalog cannot alter a partition column, so the comment of one is kept
    as a table property, where ``describe_table`` finds it.
    """
    partitions = set(_partition_columns(spark, table))
    for column, comment in comments.items():
        if column in partitions:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES "
                      f"({_literal(_COMMENT_PROPERTY + column)} = {_literal(comment)})")
        else:
            spark.sql(f"ALTER TABLE {table} CHANGE COLUMN `{column}` "
                      f"COMMENT {_literal(comment)}")


def describe_table(spark: SparkSession, table: str, extended: bool = False) -> DataFrame:
    """(col_name, data_type, comment) of a registered table."""
    described = spark.sql(f"DESCRIBE TABLE {'EXTENDED ' if extended else ''}{table}")
    if not _partition_columns(spark, table):
        return described
    kept = spark.sql(f"SHOW TBLPROPERTIES {table}").select(
        F.col("key"), F.col("value").alias("kept"))
    name = F.concat(F.lit(_COMMENT_PROPERTY), F.col("col_name"))
    return described.join(kept, F.col("key") == name, "left").select(
        "col_name", "data_type", F.coalesce("kept", "comment").alias("comment"))
