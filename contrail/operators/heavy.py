"""The most frequent values of a column with very many: bounded summaries, then exact counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder
from .profile import frequent_values

#: Values that a task's summary keeps.
CAPACITY = 4_096
#: Values left open that are counted by a broadcast join; beyond it all are counted.
OPEN_VALUES = 100_000


def summaries(frame: DataFrame, column: str, capacity: int = CAPACITY) -> DataFrame:
    """(value, lower, error): at most ``capacity`` values of each partition, and one row
    with its error.

    Space-Saving in the form whose counts are lower bounds: when a partition has more
    values than it may keep, the count of the first one beyond is taken off all of them
    and added to the error.  A value's count in the partition lies between its ``lower``
    (0 if it is not kept) and that plus the error.  Such summaries add up.
    """
    kind = frame.select(column).schema[0].dataType
    schema = T.StructType([T.StructField("value", kind), T.StructField("lower", T.LongType()),
                           T.StructField("error", T.LongType())])

    # A local function travels to the executors by value.
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, error = None, 0

        def cut(table: pa.Table) -> tuple[pa.Table, int]:
            table = table.group_by("value").aggregate([("lower", "sum")]).rename_columns(
                ["value", "lower"])
            if table.num_rows <= capacity:
                return table, 0
            table = table.sort_by([("lower", "descending")])
            beyond = table["lower"][capacity].as_py()
            counts = table["lower"].to_numpy() - beyond
            return table.set_column(1, "lower", pa.array(counts)).filter(
                pa.array(counts > 0)), beyond

        for batch in batches:
            counted = batch.column(0).value_counts()
            part = pa.table([counted.field("values"), counted.field("counts")],
                            names=["value", "lower"])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows > 4 * capacity:
                held, off = cut(held)
                error += off
        if held is not None:
            held, off = cut(held)
            for batch in held.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.nulls(batch.num_rows, pa.int64())],
                    ["value", "lower", "error"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, held.schema.field(0).type), pa.nulls(1, pa.int64()),
                 pa.array([error + off], pa.int64())], ["value", "lower", "error"])

    return frame.select(column).mapInArrow(summarise, schema)


def frequent_values_bounded(frame: DataFrame, column: str, n: int = 10, name: str = "count",
                            capacity: int = CAPACITY) -> DataFrame:
    """As ``profile.frequent_values``, exactly, for a column with very many values.

    What is shuffled is ``capacity`` values of each task, not all values of the column.
    Added up, the summaries leave few values that may be among the ``n`` most frequent;
    those are counted by a second scan.  Where they leave too many, as in a column whose
    values are all about as frequent, all values are counted after all.
    """
    path = scratch_folder(frame.sparkSession, "summaries")
    (summaries(frame, column, capacity)
     .groupBy("value", F.col("error").isNotNull().alias("is_error"))
     .agg(F.sum("lower").alias("lower"), F.sum("error").alias("error")).write.parquet(path))
    merged = frame.sparkSession.read.parquet(path)
    error = merged.where("is_error").agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    held = merged.where("not is_error")
    if not error:
        order = (F.desc(name), F.asc(column))
        return held.select(F.col("value").alias(column), F.col("lower").alias(name)).orderBy(
            *order).limit(n)
    leading = held.orderBy(F.desc("lower")).limit(n).select("lower").collect()
    bar = leading[-1].lower if len(leading) == n else 0
    left_open = held.where(F.col("lower") + error >= bar).select("value")
    if error >= bar or left_open.limit(OPEN_VALUES + 1).count() > OPEN_VALUES:
        return frequent_values(frame, column, n, True, name)
    # Names of their own: the column may be called as a summary's are.
    seen, wanted = frame.select(F.col(column).alias("seen")), left_open.toDF("wanted")
    same = F.col("seen").eqNullSafe(F.col("wanted"))
    counted = seen.join(F.broadcast(wanted), same, "left_semi").toDF(column)
    return frequent_values(counted, column, n, True, name)
