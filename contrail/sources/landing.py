"""Bringing flight files of differing headers into one landed layout.

Landed layout: ``<target>/land_year=1987/land_month=198710/*.csv``, every file
with the 29 contract columns in order (``*.csv.gz`` where a stream landed it).
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..functions import to_whole
from ..session import scratch_folder, writers_open
from .csv_files import PLAIN_CSV, list_csv, literal_path, scan_csv, stream_csv
from .tables import refuse_streamed

LAND_KEYS = ("land_year", "land_month")


# A file is one split when the headers are read, unless it is larger than this.
_PEEK_SPLIT = 64 << 30


def file_headers(spark: SparkSession, place: str | Sequence[str]) -> DataFrame:
    """(path, folder, header) of every ``*.csv`` below a folder, or of the files given.

    One task opens each file and hands on its first line alone: a session of its own
    arranges that a file is one split and shares it with no other, whatever the
    cluster's defaults say, without touching the caller's settings.  Where they may not
    be changed Spark may pack several files in a task, and each still gives its own line.
    """
    paths = ([literal_path(place)] if isinstance(place, str)
             else [literal_path(unquote(file)) for file in place])
    peek = spark.newSession()
    for name, value in (("maxPartitionBytes", _PEEK_SPLIT), ("openCostInBytes", _PEEK_SPLIT),
                        ("maxPartitionNum", 2 ** 31 - 1)):
        peek.conf.set(f"spark.sql.files.{name}", str(value))
    lines = (peek.read.option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").text(paths)
             .select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("start"),
                     F.col("value").alias("header")))
    alone = peek.conf.get("spark.sql.files.maxPartitionNum") == str(2 ** 31 - 1)

    # A local function travels to the executors by value: they need not have
    # this package installed.
    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for at, path in enumerate(batch.column("path").to_pylist()):
                if path not in seen:
                    seen.add(path)
                    yield batch.slice(at, 1)

    if alone:
        # The low 33 bits number a task's rows.  Python would be sent every line: Spark
        # writes on to a function that has returned.
        number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        first = lines.withColumn("number", number).where("number = 0")
    else:
        first = lines.mapInArrow(first_rows, lines.schema)
    return first.where(F.col("start") == 0).select(
        "path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "header")


def split_header(line: str) -> tuple[str, ...]:
    """A CSV header line to its column names."""
    names = next(csv.reader([line.lstrip("\ufeff")], skipinitialspace=True))
    return tuple(name.strip() for name in names)


@dataclass(frozen=True)
class Headers:
    """The headers found below a folder.

    ``found`` has a row (path, folder, header) per file and stays on the cluster;
    the driver holds one entry per pair of header and folder.
    """

    found: DataFrame
    folders: dict[str, list[str]]  # header line -> the folders with such files

    @property
    def lines(self) -> list[str]:
        return sorted(self.folders)

    def mixed(self) -> set[str]:
        """Folders whose files differ in their headers."""
        seen = Counter(folder for some in self.folders.values() for folder in some)
        return {folder for folder, n in seen.items() if n > 1}


def headers_below(spark: SparkSession, folder: str) -> Headers:
    """Read the header of each file below ``folder``, once.

    Fails when the files found are not those listed.
    """
    label = scratch_folder(spark, "headers")
    file_headers(spark, folder).write.parquet(label)
    found = spark.read.parquet(label)
    listed = list_csv(spark, folder).where("length > 0").count()
    if listed != found.count():
        raise RuntimeError(f"{listed} files with content below {folder}, headers of "
                           f"{found.count()}: files came or went meanwhile")
    folders: dict[str, list[str]] = {}
    for row in found.select("header", "folder").distinct().orderBy("header", "folder").collect():
        folders.setdefault(row["header"], []).append(row["folder"])
    if not folders:
        raise FileNotFoundError(f"no csv file below {folder}")
    return Headers(found, folders)


def contract_positions(header: Sequence[str]) -> dict[str, int]:
    """Where each contract column stands in ``header``, old or new spelling.

    Extra columns are ignored; a missing one is an error.
    """
    known = [C.MODERN_HEADER.get(name, name) for name in header]
    missing = [name for name in C.FLIGHT_COLUMNS if name not in known]
    if missing:
        raise ValueError(f"flight files lack the columns {missing}")
    return {name: known.index(name) for name in C.FLIGHT_COLUMNS}


def harmonise(frame: DataFrame) -> DataFrame:
    """Rename the newer header, order the contract columns, drop the rest."""
    positions = contract_positions(frame.columns)
    return frame.select(*(F.col(frame.columns[position]).alias(name)
                          for name, position in positions.items()))


def read_flight_files(spark: SparkSession, folder: str,
                      with_path: bool = False) -> DataFrame:
    """All flight files below ``folder``, whatever their headers, as one frame.

    A folder of one header is read by a scan of its own header's kind, which takes
    only the contract columns, as text.  Folders that mix headers are read once by
    position, and a join on the path tells each row which header its file has.
    ``with_path`` adds the file of each row as ``source_file``.
    """
    headers = headers_below(spark, folder)
    mixed = headers.mixed()
    extra = [F.col("_metadata.file_path").alias("source_file")] if with_path else []
    frames = []
    for line in headers.lines:
        paths = [literal_path(unquote(f)) for f in headers.folders[line] if f not in mixed]
        if paths:
            header = split_header(line)
            scan = scan_csv(spark, paths, _position_schema(len(header)), flat=True)
            frames.append(scan.select(*_contract_columns(header), *extra))
    if mixed:
        scan = scan_csv(spark, [literal_path(unquote(f)) for f in sorted(mixed)],
                        _position_schema(_widest(headers)), flat=True)
        rows = scan.select("*", F.col("_metadata.file_path").alias("source_file"))
        frames.append(_by_file(rows, headers.lines, headers.found).select(
            *C.FLIGHT_COLUMNS, *(["source_file"] if with_path else [])))
    return reduce(DataFrame.unionByName, frames)


def stream_flight_files(spark: SparkSession, folder: str, header: Sequence[str],
                        files_per_batch: int | None = None,
                        archive: str | None = None) -> DataFrame:
    """Flight files of one header below ``folder`` as a stream.

    A file with another header fails the stream instead of shifting columns.
    Union the streams of several headers to land them in one query.
    """
    return harmonise(stream_csv(spark, literal_path(folder), _text_schema(header),
                                files_per_batch, nested=True, check_header=True,
                                archive=archive))


def stream_pinned(spark: SparkSession, pinned: Sequence[tuple[str, str]],
                  files_per_batch: int | None = None) -> DataFrame:
    """Exactly the given flight files, (file, header) each, as a stream.

    Files that arrive elsewhere in their folders are not looked at.  All must be on one
    file system, so that a checkpoint always meets the same single source.
    """
    headers = sorted({header for _, header in pinned})
    width = max(len(split_header(line)) for line in headers)
    found = spark.createDataFrame(list(pinned), "path string, header string")
    rows = stream_csv(spark, any_of([unquote(file) for file, _ in pinned]),
                      _position_schema(width), files_per_batch, nested=True)
    return _by_file(rows.select("*", F.col("_metadata.file_path").alias("source_file")),
                    headers, found).select(*C.FLIGHT_COLUMNS)


def any_of(paths: Sequence[str]) -> str:
    """A pattern that the given absolute paths match and no others."""
    roots, rest = set(), []
    for path in paths:
        root, inner = re.fullmatch(r"((?:[A-Za-z][\w+.-]*:)?(?://[^/]*)?/)(.*)", path,
                                   re.DOTALL).groups()
        roots.add(root)
        # Alternatives lose one level of escapes when they are told apart.
        rest.append(re.sub(r"([\\{},])", r"\\\1", literal_path(inner)))
    if len(roots) > 1:
        raise ValueError(f"files of one landing lie on several file systems: {sorted(roots)}")
    return f"{roots.pop()}{{{','.join(rest)}}}"


def _widest(headers: Headers) -> int:
    return max(len(split_header(line)) for line in headers.lines)


def _contract_columns(header: Sequence[str]) -> list[Column]:
    # By position: a file may hold unnamed or repeated extra columns.
    return [F.col(f"c{position}").alias(name)
            for name, position in contract_positions(header).items()]


def _by_file(rows: DataFrame, lines: Sequence[str], found: DataFrame) -> DataFrame:
    """Positional rows with ``source_file`` to contract columns, by their file's header
    (``found`` has path and header, ``lines`` the distinct headers).

    The files go to the rows: a shuffle would bring all rows of a file to one task.
    """
    positions = [contract_positions(split_header(line)) for line in lines]
    kind = reduce(lambda made, item: made.when(F.col("header") == item[1], item[0]),
                  enumerate(lines), F.when(F.lit(False), -1))
    kinds = found.select(F.col("path").alias("source_file"), kind.alias("_kind"))
    unknown = F.raise_error(F.concat(F.lit("no header was read of "), F.col("source_file")))
    known = F.when(F.col("_kind").isNull(), unknown.cast("int")).otherwise(F.col("_kind"))
    joined = rows.join(F.broadcast(kinds), "source_file", "left").withColumn("_kind", known)

    def column(name: str) -> Column:
        at: dict[int, list[int]] = {}
        for number, places in enumerate(positions):
            at.setdefault(places[name], []).append(number)
        made = F.when(F.lit(False), F.lit(None))
        for place, numbers in at.items():
            made = made.when(F.col("_kind").isin(numbers), F.col(f"c{place}"))
        return made.alias(name)

    return joined.select(*map(column, C.FLIGHT_COLUMNS), "source_file")


def _position_schema(width: int) -> T.StructType:
    return _text_schema(f"c{i}" for i in range(width))


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def with_land_keys(flights: DataFrame) -> DataFrame:
    """Add the folder keys: the year, and year * 100 + month."""
    year, month = to_whole(F.col("Year")), to_whole(F.col("Month"))
    return flights.withColumns({LAND_KEYS[0]: year, LAND_KEYS[1]: year * 100 + month})


def land(flights: DataFrame, target: str, mode: str = "errorifexists",
         regroup: bool = True) -> None:
    """Write contract rows as monthly CSV folders below ``target``.

    Regrouping gathers a month's rows into few well-sized files and splits a
    month too big for one task, so neither tiny files nor a hot month result.
    Appending to a folder that a stream lands in is refused.
    It shuffles the rows: turn it off for sources whose files run month by
    month, where each task meets few months anyway.
    """
    refuse_streamed(flights.sparkSession, target, mode)
    keyed = with_land_keys(flights.select(*C.FLIGHT_COLUMNS))
    if regroup:
        keyed = _regrouped(keyed)
    with writers_open(flights.sparkSession):
        keyed.write.mode(mode).partitionBy(*LAND_KEYS).options(**PLAIN_CSV).csv(target)


def _regrouped(keyed: DataFrame) -> DataFrame:
    """Contract rows with their folder keys, a month's rows gathered in few tasks.

    They are moved as the lines of text they become, which take the least space.  A line
    does not tell empty texts from NULL: a bit for each column does.
    """
    kinds = dict(keyed.dtypes)
    bits = {name: 1 << at for at, name in enumerate(C.FLIGHT_COLUMNS) if kinds[name] == "string"}
    empty = reduce(Column.__add__, (F.when(F.col(name) == "", bit).otherwise(0)
                                    for name, bit in bits.items()), F.lit(0))
    moved = keyed.select(F.to_csv(F.struct(*C.FLIGHT_COLUMNS), PLAIN_CSV).alias("line"),
                         empty.alias("empty"), *LAND_KEYS).hint(
        "rebalance", *(F.col(key) for key in LAND_KEYS))
    schema = ", ".join(f"`{name}` string" for name in C.FLIGHT_COLUMNS)
    read = moved.select(F.from_csv("line", schema, PLAIN_CSV).alias("row"), "empty", *LAND_KEYS)
    return read.select(*(
        (F.when(F.col("empty").bitwiseAND(bits[name]) != 0, "").otherwise(F.col(f"row.{name}"))
         if name in bits else F.col(f"row.{name}")).alias(name) for name in C.FLIGHT_COLUMNS),
        *LAND_KEYS)


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """The landed files as one frame of text columns."""
    return scan_csv(spark, target, C.LANDED).select(*C.FLIGHT_COLUMNS)


def stream_landed(spark: SparkSession, target: str,
                  files_per_batch: int | None = None) -> DataFrame:
    """The landed files as a stream of text columns."""
    return stream_csv(spark, target, C.LANDED, files_per_batch).select(*C.FLIGHT_COLUMNS)


def count_rows(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(source_file, num_rows) of the given CSV files; a file without rows has none."""
    paths = [literal_path(unquote(file)) for file in files]
    return rows_per_file(scan_csv(spark, paths, _position_schema(1)).select(
        F.col("_metadata.file_path").alias("source_file")))


def rows_per_file(flights: DataFrame) -> DataFrame:
    """Rows of each source file of a frame read ``with_path``."""
    return flights.groupBy("source_file").agg(F.count(F.lit(1)).alias("num_rows"))


def landed_months(flights: DataFrame) -> DataFrame:
    """Distinct months present, with the rows of each."""
    return (with_land_keys(flights).groupBy(*LAND_KEYS)
            .agg(F.count(F.lit(1)).alias("num_rows")))
