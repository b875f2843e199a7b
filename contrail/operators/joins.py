"""Joining the flight fact with its dimensions, and merging small reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str,
           columns: dict[str, str]) -> DataFrame:
    """Left join ``columns`` (dimension name -> output name) onto the fact.

    No broadcast is forced.  Spark broadcasts the dimension when its estimated
    size, or the size measured at run time, is under
    ``spark.sql.autoBroadcastJoinThreshold``, and sort-merges otherwise.  In the
    sort-merge case adaptive execution splits a partition that a hot or NULL key
    has filled, which it can do for the left side of a left join.

    Where only totals are wanted, aggregate the fact by the key first and attach
    to the result: see ``plans.questions``.
    """
    narrow = dimension.select(
        F.col(dimension_key).alias("_key"),
        *(F.col(name).alias(alias) for name, alias in columns.items()))
    return fact.join(narrow, F.col(fact_key) == F.col("_key"), "left").drop("_key")


def plain_text(column: Column, kind: str) -> Column:
    """A value as text, a number or numeric text without trailing zeros."""
    number = column.try_cast("decimal(30,6)")
    trimmed = F.regexp_replace(number.cast("string"), r"\.?0+$", "")
    # Only the zeros behind a point go.
    text = F.when(number == F.floor(number), number.cast("decimal(30,0)").cast("string")
                  ).otherwise(trimmed)
    if kind == "string":
        return F.coalesce(text, column)
    if kind in ("date", "timestamp", "timestamp_ntz", "boolean", "binary"):
        return column.cast("string")
    return F.coalesce(text, column.cast("string"))


def merge_on_key(frames: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Full outer merge of any number of (key, value) frames on ``key``.

    Gives ``key`` and one column per frame.  Keys are unique within a frame, so
    the merge is a union and one grouped aggregate: a single shuffle for any
    number of frames where chained outer joins need one per frame, and grouping
    puts NULL keys together the way ``<=>`` would.

    Keys of different types are compared as text, numbers in their plainest
    spelling: ``14.0`` and 14 are one key.  Spellings of one frame that then
    coincide are added up.
    """
    kinds = {dict(frame.dtypes)[key] for frame in frames.values()}
    if len(kinds) > 1:
        frames = {name: frame.select(
            plain_text(F.col(key), dict(frame.dtypes)[key]).alias(key), value)
            .groupBy(key).agg(F.sum(value).alias(value)) for name, frame in frames.items()}
    tagged = None
    for position, frame in enumerate(frames.values()):
        part = frame.select(F.col(key), F.lit(position).alias("_from"),
                            F.col(value).alias("_value"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(
        *(F.max(F.when(F.col("_from") == position, F.col("_value"))).alias(name)
          for position, name in enumerate(frames)))


def with_differences(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add ``var_<a>_<b>`` = a - b for every pair, in the order of ``names``."""
    pairs: list[tuple[str, str]] = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    differences: list[Column] = [
        (F.col(a) - F.col(b)).alias(f"var_{a}_{b}") for a, b in pairs]
    return frame.select("*", *differences)
