"""Profiles of tables and comparisons between layers.

Results are small DataFrames; nothing is collected.  Names in a ``TableSet``
become column names of its reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import merge_on_key, with_differences


def null_counts(frame: DataFrame, name: str = "nulls") -> DataFrame:
    """(column_name, nulls) for every column, in one pass over the table.

    A null count is rows minus non-null values.  Written that way it is built of
    plain COUNTs, which Parquet can answer from its footers alone when the
    session turns ``spark.sql.parquet.aggregatePushdown`` on.
    """
    rows = F.count(F.lit(1))
    counted = frame.agg(*(
        (rows - F.count(F.col(_quoted(column)))).alias(f"c{position}")
        for position, column in enumerate(frame.columns)))
    pairs = F.array(*(
        F.struct(F.lit(column).alias("column_name"), F.col(f"c{position}").alias(name))
        for position, column in enumerate(frame.columns)))
    return counted.select(F.inline(pairs)).orderBy(F.desc(name), "column_name")


def group_counts(frame: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value of ``column``."""
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def frequent_values(frame: DataFrame, column: str, n: int = 10, top: bool = True,
                    name: str = "count") -> DataFrame:
    """The ``n`` most (or least) frequent values; ties go to the lower value."""
    order = F.desc(name) if top else F.asc(name)
    return group_counts(frame, column, name).orderBy(order, F.asc(column)).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, num_rows) for each table."""
    counted = None
    for name, frame in tables.items():
        part = frame.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows")
        counted = part if counted is None else counted.unionByName(part)
    return counted


def reconcile(landed: DataFrame, stored: DataFrame) -> DataFrame:
    """Both row counts, their difference, and whether they agree: one row."""
    both = row_counts({"landed": landed, "stored": stored})
    counts = both.agg(*(
        F.max(F.when(F.col("table_name") == side, F.col("num_rows"))).alias(f"{side}_rows")
        for side in ("landed", "stored")))
    difference = F.col("landed_rows") - F.col("stored_rows")
    return counts.select("*", difference.alias("difference"),
                         (difference == 0).alias("matches"))


def require_reconciled(landed: DataFrame, stored: DataFrame) -> DataFrame:
    """As ``reconcile``, but the query fails when the counts differ."""
    checked = reconcile(landed, stored)
    guard = F.assert_true(
        F.col("matches"),
        F.concat_ws(" ", F.lit("row counts differ:"), "landed_rows", "stored_rows"))
    # The guard sits in a filter so that column pruning cannot remove it.
    return checked.where(guard.isNull())


def with_share(report: DataFrame, name: str, total_rows: Column) -> DataFrame:
    """Add ``<name>_share``, the count as a fraction of the table's rows."""
    share = F.col(name) / F.nullif(total_rows, F.lit(0))
    return report.withColumn(f"{name}_share", F.round(share, 4))


class TableSet:
    """Tables to be profiled side by side.

    >>> layers = TableSet(bronze=bronze).add("silver", silver)
    >>> layers.nulls()
    >>> layers.frequent("UniqueCarrier", n=10)

    Nothing is kept between reports: each scans its tables once, as they are.
    """

    def __init__(self, **tables: DataFrame):
        self._tables: dict[str, DataFrame] = {}
        for name, frame in tables.items():
            self.add(name, frame)

    def __len__(self) -> int:
        return len(self._tables)

    def add(self, name: str, frame: DataFrame) -> "TableSet":
        """Add a table, or replace the one of that name."""
        if not isinstance(frame, DataFrame):
            raise TypeError(f"{name} is {type(frame).__name__}, not a Spark DataFrame")
        self._tables[name] = frame
        return self

    def rows(self) -> DataFrame:
        """(table_name, num_rows)."""
        return row_counts(self._tables)

    def nulls(self, shares: bool = False) -> DataFrame:
        """Null count of every column in every table, widest gaps first.

        A column that a table lacks is NULL for that table.
        """
        reports = {name: null_counts(frame, name) for name, frame in self._tables.items()}
        return self._side_by_side(reports, "column_name", shares)

    def frequent(self, column: str, n: int = 10, top: bool = True,
                 shares: bool = False) -> DataFrame:
        """The most or least frequent values of ``column`` in every table.

        A table without the column shows NULL.
        """
        having = {name: frame for name, frame in self._tables.items()
                  if column in frame.columns}
        if not having:
            raise ValueError(f"no table has a column {column}")
        reports = {name: frequent_values(frame, column, n, top, name)
                   for name, frame in having.items()}
        return self._side_by_side(reports, column, shares, ascending=not top)

    def _side_by_side(self, reports: dict[str, DataFrame], key: str, shares: bool,
                      ascending: bool = False) -> DataFrame:
        names = list(self._tables)
        merged = merge_on_key(
            {name: report.withColumnRenamed(name, "_value")
             for name, report in reports.items()}, key, "_value")
        for name in names:
            if name not in reports:
                merged = merged.withColumn(name, F.lit(None).cast("bigint"))
        merged = with_differences(merged.select(key, *names), names)
        if shares:
            for name in names:
                total = row_counts({name: self._tables[name]})
                merged = with_share(merged, name, total.select("num_rows").scalar())
        order = F.asc_nulls_last if ascending else F.desc_nulls_last
        return merged.orderBy(*(order(name) for name in names), F.asc(key))


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"
