"""Row-wise transforms between the layers.

Everything here is a projection or a filter, so it runs unchanged on batch and
streaming frames, never shuffles, and leaves column pruning to the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import clock_text, day_from_parts, place_parts, to_flag, to_whole


def add_ingest_metadata(frame: DataFrame, source: str,
                        partition_column: str | None = None) -> DataFrame:
    """All columns plus where and when the row came in.

    ``partition_column`` is renamed with a ``p_`` prefix, which tells readers
    that filtering on it prunes folders.  A numeric year in text form is made an
    int, so that ``1987`` and ``1987.0`` land in one folder.
    """
    columns = [F.col(name) for name in frame.columns]
    if partition_column:
        columns = [
            _partition_value(frame, name).alias(f"p_{name}")
            if name == partition_column else F.col(name)
            for name in frame.columns
        ]
    return frame.select(
        *columns,
        F.lit(source).alias("data_source"),
        F.current_timestamp().alias("ingest_time"),
        F.current_date().alias("ingest_date"),
    )


def _partition_value(frame: DataFrame, name: str) -> Column:
    kind = dict(frame.dtypes)[name]
    return to_whole(F.col(name)) if (name, kind) == ("Year", "string") else F.col(name)


def clean_flights(bronze: DataFrame) -> DataFrame:
    """Bronze to silver: real dates, clock text, ints and booleans.

    All 27 columns share one generated method.  The JVM leaves methods beyond
    8000 bytes uncompiled, several times slower, hence one flat select (repeated
    parts are computed once in methods of their own), conversions only where the
    input type needs one, and the lookup form of ``clock_text``.
    """
    kinds = dict(bronze.dtypes)
    return bronze.select(*(_typed(name, kinds).alias(name) for name in C.SILVER.names))


def _typed(name: str, kinds: dict[str, str]) -> Column:
    """The silver column ``name`` from bronze columns of the given types."""
    if name == "date":
        return day_from_parts(*(to_whole(F.col(part), kinds[part])
                                for part in C.DATE_PARTS))
    if name in C.CLOCK_COLUMNS:
        return clock_text(F.col(name), kinds[name])
    if name in C.FLAG_COLUMNS:
        return to_flag(F.col(name), kinds[name])
    if name in C.WHOLE_COLUMNS or name == C.YEAR_PARTITION:
        return to_whole(F.col(name), kinds[name])
    return F.col(name)


#: Columns that the rescue adds: which column lost what text.
RESCUE = ("column_name", "text")


def lost_texts(bronze: DataFrame, typed: dict[str, Column] | None = None) -> Column:
    """What silver's types could not hold, as an array of (column_name, text).

    A value that is there in bronze and NULL in silver; of a date that its parts do not
    make, the parts.  ``typed`` has silver's columns where they are computed already.
    """
    kinds = dict(bronze.dtypes)
    texts = {name: F.col(name).cast("string")
             for name in (*C.CLOCK_COLUMNS, *C.FLAG_COLUMNS, *C.WHOLE_COLUMNS)}
    parts = [F.col(part).cast("string") for part in C.DATE_PARTS]
    texts["date"] = F.when(F.coalesce(*parts).isNotNull(), F.concat_ws(
        "-", *(F.coalesce(part, F.lit("?")) for part in parts)))
    held = typed or {name: _typed(name, kinds) for name in texts}
    return F.array_compact(F.array(*(
        F.when(text.isNotNull() & held[name].isNull(), F.struct(
            F.lit(name).alias(RESCUE[0]), text.alias(RESCUE[1])))
        for name, text in texts.items())))


def clean_with_rescue(bronze: DataFrame) -> DataFrame:
    """Silver rows and rescued texts in one pass: a row of kind ``clean`` for each flight,
    and one of kind ``rescue`` for each value that silver's types could not hold.

    Both have silver's columns, ``kind``, column_name, text and source_file; each kind
    fills its own, and both the year.  A projection, so it streams.

    Silver's columns come first, in a projection of their own: as a part of what is
    exploded they would be computed again, for each row and each row made of it.
    """
    silver = [name for name in C.SILVER.names if name != C.YEAR_PARTITION]
    kinds = dict(bronze.dtypes)
    nothing = F.array(F.struct(*(F.lit(None).cast("string").alias(name) for name in RESCUE)))
    typed = {name: F.col(f"silver_{name}") for name in C.SILVER.names}
    cleaned = bronze.select(
        "*", *(_typed(name, kinds).alias(f"silver_{name}") for name in C.SILVER.names),
        F.col("_metadata.file_path").alias("source_file"))
    found = cleaned.select(*typed.values(), "source_file", F.concat(
        nothing, lost_texts(bronze, typed)).alias("losses"))
    # None is empty; of ``explode`` Spark would make a filter that computes all once more.
    rows = found.select(*typed.values(), "source_file", F.explode_outer("losses").alias("lost"))
    clean = F.col("lost.column_name").isNull()
    return rows.select(
        typed[C.YEAR_PARTITION].alias(C.YEAR_PARTITION),
        *(F.when(clean, typed[name]).alias(name) for name in silver),
        *(F.col(f"lost.{name}") for name in RESCUE),
        F.when(~clean, F.col("source_file")).alias("source_file"),
        F.when(clean, "clean").otherwise("rescue").alias("kind"))


def normalise_clocks(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rewrite numeric hhmm columns as ``HH:mm`` text, the rest untouched."""
    kinds = dict(frame.dtypes)
    return frame.withColumns(
        {name: clock_text(F.col(name), kinds[name]) for name in columns})


def split_airports(lookup: DataFrame) -> DataFrame:
    """``Code, Description`` to code, airport name, city and country."""
    parts = place_parts(F.col("Description"))
    return lookup.select(
        F.col("Code").alias("airport_code"),
        *(part.alias(name) for name, part in parts.items()),
    )


def drop_empty_planes(lookup: DataFrame) -> DataFrame:
    """Drop planes about which nothing but the first column is known."""
    return lookup.dropna(how="all", subset=lookup.columns[1:])
