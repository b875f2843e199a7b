"""Every operator as a named query over the test tables.

A query takes (spark, folder) and returns a DataFrame.  Queries about files,
tables or streams first write a table derived from the given ones to a fresh
scratch folder, then run the operator on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..functions import to_flag, to_whole
from ..operators.calendar import calendar_for, date_range
from ..operators.cleaning import (add_ingest_metadata, clean_flights,
                                  drop_empty_planes, normalise_clocks,
                                  split_airports)
from ..operators.daily import daily_summary
from ..operators.heavy import frequent_values_bounded
from ..operators.profile import (TableSet, frequent_values, group_counts,
                                 null_counts, require_reconciled, row_counts)
from ..session import ensure_database, scratch_folder
from ..sources.bucketed import join_bucketed, store_dimension, store_fact
from ..sources.csv_files import PLAIN_CSV, list_csv, scan_csv, schema_of_sample, stream_csv
from ..sources.landing import (LAND_KEYS, land, landed_months, read_flight_files,
                               read_landed, rows_per_file, stream_flight_files,
                               with_land_keys)
from ..sources.manifest import SourceManifest
from ..sources.tables import (comment_columns, delete_folder, describe_table, read_table,
                              register_table, write_table)
from ..sources.versions import TableVersions
from ..streaming.control import (ProgressLog, finish, stop_all_streams, stop_stream,
                                 stream_status, wait_ready)
from ..streaming.hops import (land_new_files, rescued_part, silver_part, start_bronze,
                              start_landing, start_silver, start_silver_with_rescue,
                              stream_writer)
from . import questions
from .lakehouse import Lake, build_gold, read_codes, refresh_flights
from .profile_store import ProfileStore
from .samples import (bronze_flights, flight_source, made_flights, raw_airports,
                      raw_cancellations, raw_carriers, raw_flights, raw_planes, table)

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")
SOURCE_LABEL = "flight_feed"
CLOCKLESS_BRONZE = [c for c in C.BRONZE.names if c not in ("ingest_time", "ingest_date")]


def silver_flights(spark: SparkSession, folder: str) -> DataFrame:
    return clean_flights(bronze_flights(spark, folder))


def airports(spark: SparkSession, folder: str) -> DataFrame:
    return split_airports(raw_airports(spark, folder))


def planes(spark: SparkSession, folder: str) -> DataFrame:
    return drop_empty_planes(raw_planes(spark, folder))


def orders_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the timestamp cut to its day."""
    return table(spark, folder, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date"))


ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_orderpriority", T.StringType())])


# -- cleaning ---------------------------------------------------------------

def bronze_metadata(spark, folder):
    rows = add_ingest_metadata(raw_flights(spark, folder), SOURCE_LABEL, "Year")
    return rows.select(*CLOCKLESS_BRONZE)


def hhmm_normalise(spark, folder):
    raw = raw_flights(spark, folder).select(
        *C.CLOCK_COLUMNS, *(F.col(c).alias(f"{c}_text") for c in C.CLOCK_COLUMNS))
    return normalise_clocks(raw, tuple(f"{c}_text" for c in C.CLOCK_COLUMNS))


# What a number column may hold instead of one, chosen by order key.
ODD_NUMBER = ("case l_orderkey % 8 when 0 then 'NaN' when 1 then 'true' "
              "when 2 then cast(l_linenumber as STR) || 'd' when 3 then ' ' when 4 then 'F' "
              "when 5 then '0.00' when 6 then cast(l_linenumber as STR) || '.9' else '' end")


def safe_casts(spark, folder):
    text = {name: F.col(name).cast("string") for name in (
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")}
    text["odd"] = F.expr(ODD_NUMBER.replace("STR", "string"))
    return table(spark, folder, "lineitem").select(
        *(to_whole(column, odd=True).alias(f"{name}_whole") for name, column in text.items()),
        *(to_flag(column, odd=True).alias(f"{name}_flag") for name, column in text.items()))


def lookup_passthrough(spark, folder):
    """A code list from CSV to a stored table, unchanged: ``007`` stays so."""
    root = scratch_folder(spark, "lookup")
    codes = table(spark, folder, "supplier").select(
        F.lpad((F.col("s_suppkey") % 20).cast("string"), 3, "0").alias("Code"),
        F.col("s_name").alias("Description"))
    codes.write.options(**PLAIN_CSV).csv(f"{root}/csv")
    write_table(read_codes(spark, f"{root}/csv"), f"{root}/table")
    return spark.read.parquet(f"{root}/table")


# -- profiles ---------------------------------------------------------------

def lookup_null_compare(spark, folder):
    """Null counts of each lookup before and after its transform."""
    pairs = {
        "plane": (raw_planes(spark, folder), planes(spark, folder)),
        "airport": (raw_airports(spark, folder), airports(spark, folder)),
        "carrier": (raw_carriers(spark, folder), raw_carriers(spark, folder)),
        "cancellation": (raw_cancellations(spark), raw_cancellations(spark)),
    }
    reports = [TableSet(raw=before, silver=after).nulls()
               .select(F.lit(name).alias("lookup"), "*")
               for name, (before, after) in pairs.items()]
    return reduce(DataFrame.unionByName, reports)


def _raw_and_silver(spark, folder) -> TableSet:
    return TableSet(raw=raw_flights(spark, folder), silver=silver_flights(spark, folder))


def reconcile_landing(spark, folder):
    root = scratch_folder(spark, "reconcile")
    land(raw_flights(spark, folder), root)
    landed = read_landed(spark, root)
    silver = clean_flights(add_ingest_metadata(landed, SOURCE_LABEL, "Year"))
    # A landed file holds one month.
    write_table(silver, f"{root}-silver", [C.YEAR_PARTITION], regroup=False)
    return require_reconciled(landed, spark.read.parquet(f"{root}-silver"))


def top_n_compare_typed(spark, folder):
    """Frequent values of a measure that is text in bronze and a number in silver."""
    raw = raw_flights(spark, folder).withColumn("ArrDelay", F.col("ArrDelay").cast("string"))
    return TableSet(bronze=raw, silver=silver_flights(spark, folder)).frequent("ArrDelay", 200)


def profile_after_arrival(spark, folder):
    """Null counts of landed files, before and after more of them arrived."""
    root = scratch_folder(spark, "arrival")
    flights = raw_flights(spark, folder)
    reports = []
    for step, lot in (("before", F.col("Month") <= 6), ("after", F.col("Month") > 6)):
        land(flights.where(lot), root, mode="append")
        report = TableSet(landed=read_landed(spark, root)).nulls()
        path = scratch_folder(spark, "report")
        write_table(report.select(F.lit(step).alias("step"), "*"), path)
        reports.append(spark.read.parquet(path))
    return reduce(DataFrame.unionByName, reports)


def type_guard(spark, folder):
    """A table set takes data frames and refuses what is not one, a table's name say."""
    tables = TableSet()
    taken = []
    for name in ("nation", "region", "customer"):
        for kind, value in (("frame", table(spark, folder, name)), ("name", name)):
            try:
                tables.add(f"{name}_{kind}", value)
                taken.append((f"{name}_{kind}", True))
            except TypeError:
                taken.append((f"{name}_{kind}", False))
    found = spark.createDataFrame(taken, "table_name string, accepted boolean")
    return found.join(tables.rows(), "table_name", "left")


def gold_order(spark, folder):
    """How many days of the stored summary stand after a later one."""
    root = scratch_folder(spark, "order")
    write_table(daily_summary(silver_flights(spark, folder)).orderBy("date"), root)
    place = F.monotonically_increasing_id()
    # One row per day.  Files of a sorted write are numbered in order.
    stored = spark.read.parquet(root).select(
        "date", F.struct(F.col("_metadata.file_name"), place).alias("place"))
    before = F.max("date").over(
        Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    return stored.select("date", before.alias("before")).agg(
        F.count(F.lit(1)).alias("num_days"),
        F.count_if(F.col("before") > F.col("date")).alias("out_of_order"))


# -- files and tables -------------------------------------------------------

def csv_scan(spark, folder):
    root = scratch_folder(spark, "csv")
    orders_by_day(spark, folder).write.options(**PLAIN_CSV).csv(root)
    return scan_csv(spark, root, ORDERS_SCHEMA, check_header=True)


def csv_inferred(spark, folder):
    root = scratch_folder(spark, "csv")
    orders_by_day(spark, folder).write.options(**PLAIN_CSV).csv(root)
    rows = scan_csv(spark, root)
    return rows.select("*", *(F.lit(kind).alias(f"{name}_type")
                              for name, kind in rows.dtypes))


def csv_recursive(spark, folder):
    """Nested folders, found and read recursively, with the rows of each file."""
    root = scratch_folder(spark, "nested")
    (orders_by_day(spark, folder)
     .withColumns({"status": F.col("o_orderstatus"), "year": F.year("o_orderdate")})
     .write.partitionBy("status", "year").options(**PLAIN_CSV).csv(root))
    listed = list_csv(spark, root).select(F.col("path").alias("listed_path"))
    rows = scan_csv(spark, root, ORDERS_SCHEMA, nested=True).select(
        "*", F.col("_metadata.file_path").alias("source_file"))
    counts = rows.groupBy("o_orderstatus", F.year("o_orderdate").alias("order_year"),
                          "source_file").agg(F.count(F.lit(1)).alias("num_rows"),
                                             F.sum("o_orderkey").alias("key_sum"))
    found = counts.join(
        listed, F.regexp_replace("source_file", "^file:/+", "/")
        == F.regexp_replace("listed_path", "^file:/+", "/"), "left")
    return found.groupBy("o_orderstatus", "order_year").agg(
        F.sum("num_rows").alias("num_rows"), F.sum("key_sum").alias("key_sum"),
        (F.count_if(F.col("listed_path").isNull()) == 0).alias("all_listed"))


def csv_sample_schema(spark, folder):
    """The schema of one landed file, inferred, then used for all of them."""
    root = scratch_folder(spark, "sample")
    land(raw_flights(spark, folder), root)
    first = list_csv(spark, root).agg(F.min("path")).first()[0]
    schema = schema_of_sample(spark, first)
    rows = scan_csv(spark, root, schema).select(*C.FLIGHT_COLUMNS)
    return clean_flights(rows.withColumnRenamed("Year", C.YEAR_PARTITION))


def table_roundtrip(spark, folder):
    """Partitioned write, register, overwrite, register again, read by name."""
    root = scratch_folder(spark, "table")
    name = f"{ensure_database(spark)}.orders_{uuid.uuid4().hex[:8]}"
    rows = orders_by_day(spark, folder)
    write_table(rows.where("o_orderstatus = 'F'"), root, ["o_orderstatus"])
    register_table(spark, name, root)
    write_table(rows, root, ["o_orderstatus"], mode="overwrite")
    register_table(spark, name, root)
    write_table(read_table(spark, name), f"{root}-read")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{root}-read")


def dictionary_after_refresh(spark, folder):
    """Comments of a table after its rows, then also its columns, were replaced."""
    root = scratch_folder(spark, "dictionary")
    name = f"{ensure_database(spark)}.gold_{uuid.uuid4().hex[:8]}"
    gold = daily_summary(silver_flights(spark, folder))
    described = []
    for step, frame in (("same", gold), ("replaced", gold), ("fewer", gold.drop("num_flights"))):
        write_table(frame, f"{root}/{step}")
        register_table(spark, name, f"{root}/{step}")
        if step == "same":
            comment_columns(spark, name, C.DICTIONARY["daily_flights"])
        rows = read_table(spark, name).agg(F.count(F.lit(1)).alias("num_rows"))
        described.append(describe_table(spark, name).select(
            F.lit(step).alias("step"), "col_name", "comment").crossJoin(rows))
    spark.sql(f"DROP TABLE {name}")
    return reduce(DataFrame.unionByName, described)


def table_dictionary(spark, folder):
    """The stored tables with their column comments, as rows."""
    suffix = uuid.uuid4().hex[:8]
    silver = silver_flights(spark, folder)
    frames = {
        "flight_silver": silver,
        "daily_flights": daily_summary(silver),
        "calendar_days": calendar_for(silver),
        "airport_places": airports(spark, folder),
        "cancellation_silver": raw_cancellations(spark),
        "carrier_names": raw_carriers(spark, folder),
        "plane_register": planes(spark, folder),
    }
    root = scratch_folder(spark, "dictionary")
    database = ensure_database(spark)
    described = None
    for name, frame in frames.items():
        stored = f"{database}.{name}_{suffix}"
        write_table(frame, f"{root}/{name}")
        register_table(spark, stored, f"{root}/{name}")
        comment_columns(spark, stored, C.DICTIONARY[name])
        rows = describe_table(spark, stored).select(
            F.lit(name).alias("table_name"), "col_name", "data_type", "comment")
        spark.sql(f"DROP TABLE {stored}")
        described = rows if described is None else described.unionByName(rows)
    return described


# -- landing ----------------------------------------------------------------

def write_source_files(spark: SparkSession, folder: str, root: str) -> None:
    """Source files in two headers, split by year as the real ones are.

    The later years get the newer header, another column order and an extra
    column.
    """
    flights = raw_flights(spark, folder)
    to_modern = {name: modern for modern, name in C.MODERN_HEADER.items()}
    recent = F.col("Year") >= 1996
    (flights.where(~recent).write.options(**PLAIN_CSV).csv(f"{root}/classic"))
    (flights.where(recent).select(
        *(F.col(name).alias(to_modern[name]) for name in reversed(C.FLIGHT_COLUMNS)),
        F.lit("").alias("EXTRA"))
     .write.options(**PLAIN_CSV).csv(f"{root}/modern"))


def modern_header() -> tuple[str, ...]:
    to_modern = {name: modern for modern, name in C.MODERN_HEADER.items()}
    return (*(to_modern[name] for name in reversed(C.FLIGHT_COLUMNS)), "EXTRA")


def land_harmonise(spark, folder):
    root = scratch_folder(spark, "source")
    write_source_files(spark, folder, root)
    return read_flight_files(spark, root)


def land_months(spark, folder):
    root = scratch_folder(spark, "source")
    write_source_files(spark, folder, root)
    land(read_flight_files(spark, root), f"{root}-landed")
    return landed_months(read_landed(spark, f"{root}-landed"))


def land_accounting(spark, folder):
    """Rows of each source file, added up per header family and overall."""
    root = scratch_folder(spark, "source")
    write_source_files(spark, folder, root)
    per_file = rows_per_file(read_flight_files(spark, root, with_path=True))
    family = F.regexp_extract("source_file", "/(classic|modern)/", 1)
    per_family = per_file.groupBy(family.alias("family")).agg(
        F.sum("num_rows").alias("num_rows"))
    total = per_file.agg(F.sum("num_rows").alias("num_rows")).select(
        F.lit("all").alias("family"), "num_rows")
    return per_family.unionByName(total)


def land_stream(spark, folder):
    """Both header families landed by one stream in bounded steps."""
    root = scratch_folder(spark, "source")
    write_source_files(spark, folder, root)
    streams = [
        stream_flight_files(spark, f"{root}/classic", C.FLIGHT_COLUMNS, 3),
        stream_flight_files(spark, f"{root}/modern", modern_header(), 3)]
    finish(start_landing(streams, f"{root}-landed", f"{root}-checkpoint"))
    return read_landed(spark, f"{root}-landed")


def _write_lot(flights: DataFrame, root: str) -> None:
    """Files of both headers into one folder."""
    to_modern = {name: modern for modern, name in C.MODERN_HEADER.items()}
    for rows in (flights.where("Year < 1996"), flights.where("Year >= 1996").select(
            *(F.col(name).alias(to_modern[name]) for name in reversed(C.FLIGHT_COLUMNS)),
            F.lit("").alias("EXTRA"))):
        rows.write.mode("append").options(**PLAIN_CSV).csv(root)


def _land_all(spark, root, sources, files_per_batch=None, at_most=None):
    manifest = SourceManifest(spark, f"{root}/manifest")
    return land_new_files(spark, manifest, sources, f"{root}/landed", f"{root}/checkpoint",
                          files_per_batch, at_most)


def land_stream_mixed(spark, folder):
    """One folder of both headers, filled in two lots; the second comes between the
    listing and the landing of the first.  A last run finds the folder emptied."""
    root = scratch_folder(spark, "mixed")
    flights = raw_flights(spark, folder)
    _write_lot(flights.where("Month <= 6"), f"{root}/source")
    SourceManifest(spark, f"{root}/manifest").pin([f"{root}/source"])
    _write_lot(flights.where("Month > 6"), f"{root}/source")
    _land_all(spark, root, [f"{root}/source"], 3)
    _land_all(spark, root, [f"{root}/source"], 3)
    _land_all(spark, root, [f"{root}/emptied"], 3)
    return read_landed(spark, f"{root}/landed")


def land_bounded(spark, folder):
    """A landing of at most eight of twelve files in two folders, then one of the rest."""
    root = scratch_folder(spark, "bounded")
    # Both folders are written from one shuffle, kept as compressed columns meanwhile.
    made_of = flight_source(spark, folder, parts=6).persist(StorageLevel.DISK_ONLY)
    flights = made_flights(made_of)
    sources = [f"{root}/classic", f"{root}/modern"]
    for source, rows in zip(sources, (flights, flights.select(
            *(F.col(c).alias(c) for c in reversed(C.FLIGHT_COLUMNS))))):
        rows.write.options(**PLAIN_CSV).csv(source)
    made_of.unpersist()
    landed = [_land_all(spark, root, sources, at_most=bound) for bound in (8, None)]
    ledger = SourceManifest(spark, f"{root}/manifest").files.rows()
    early = F.col("lot") == 1
    from_folder = F.element_at(F.split("source_file", "/"), -2)
    counted = ledger.agg(
        F.count_if(early).alias("first_run_files"), F.count_if(~early).alias("second_run_files"),
        F.count_distinct(F.when(early, from_folder)).alias("first_run_folders"),
        F.sum("num_rows").alias("source_rows"))
    rows = read_landed(spark, f"{root}/landed").agg(F.count(F.lit(1)).alias("num_rows"))
    return counted.withColumns({
        "num_rows": rows.scalar(),
        "as_reported": (F.col("first_run_files") == landed[0])
        & (F.col("second_run_files") == landed[1])})


def land_atomic(spark, folder):
    """Readers of a streamed folder see published files alone, not a stray one."""
    root = scratch_folder(spark, "atomic")
    flights = raw_flights(spark, folder)
    _write_lot(flights, f"{root}/source")
    _land_all(spark, root, [f"{root}/source"])
    # As a task that died halfway leaves it.
    (with_land_keys(flights.where("Month = 1")).write.mode("append").partitionBy(*LAND_KEYS)
     .options(**PLAIN_CSV).csv(f"{root}/landed"))
    return landed_months(read_landed(spark, f"{root}/landed"))


def land_ledger(spark, folder):
    """The whole refresh with its ledger: rows by header family, then of each layer.

    A second refresh meets its sources archived, and a third one nothing at all.
    """
    root = scratch_folder(spark, "ledger")
    lake = Lake(f"{root}/lake", f"ledger_{uuid.uuid4().hex[:8]}")
    write_source_files(spark, folder, f"{root}/source")
    for _ in range(3):
        counts = refresh_flights(spark, lake, [f"{root}/source"], SOURCE_LABEL,
                                 archive=f"{root}/archive")
    family = F.regexp_extract("source_file", "/(classic|modern)/", 1)
    ledger = read_table(spark, lake.table("landing_ledger")).groupBy(
        family.alias("place")).agg(F.sum("num_rows").alias("num_rows"))
    layers = counts.select(F.inline(F.array(*(
        F.struct(F.lit(name).alias("place"), F.col(f"{name}_rows").alias("num_rows"))
        for name in ("source", "landed", "bronze", "silver")))))
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")
    return ledger.unionByName(layers)


def csv_fidelity(spark, folder):
    """Texts with outer spaces, quotes and backslashes, written, landed and read back."""
    root = scratch_folder(spark, "fidelity")
    texts = table(spark, folder, "part").selectExpr("p_partkey", *ODD_TEXTS_AS)
    texts.write.options(**PLAIN_CSV).csv(f"{root}/plain")
    carried = texts.select(*(
        (F.col("spaced") if name == "TailNum" else F.col("quoted") if name == "Origin"
         else F.col("slashed") if name == "Dest" else F.lit(1999) if name == "Year"
         else F.col("p_partkey") if name == "FlightNum" else F.lit("1")).alias(name)
        for name in C.FLIGHT_COLUMNS))
    carried.write.options(**PLAIN_CSV).csv(f"{root}/source")
    land(read_flight_files(spark, f"{root}/source"), f"{root}/landed")
    landed = read_landed(spark, f"{root}/landed").select(
        F.col("FlightNum").cast("bigint").alias("p_partkey"), F.col("TailNum").alias("spaced"),
        F.col("Origin").alias("quoted"), F.col("Dest").alias("slashed"))
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), *(
        T.StructField(name, T.StringType()) for name in ("spaced", "quoted", "slashed"))])
    return (scan_csv(spark, f"{root}/plain", schema, check_header=True)
            .withColumn("way", F.lit("plain"))
            .unionByName(landed.withColumn("way", F.lit("landed"))))


# Backslashes by number, as engines differ in how they write them.
ODD_TEXTS_AS = ("concat('  ', p_name, ' ') as spaced",
                """concat('say "', p_brand, '"', case when p_size % 2 = 0 then ', "' else '' end)
                as quoted""",
                "concat(p_type, chr(92), '\"', chr(92)) as slashed")


# -- streams ----------------------------------------------------------------

def _stream_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:8]}"


def _bronze_stream(spark, folder, root):
    land(raw_flights(spark, folder), f"{root}/landed")
    return finish(start_bronze(
        spark, f"{root}/landed", f"{root}/bronze", f"{root}/checkpoints/bronze",
        SOURCE_LABEL, name=_stream_name("bronze")))


def stream_bronze(spark, folder):
    root = scratch_folder(spark, "bronze")
    _bronze_stream(spark, folder, root)
    return spark.read.schema(C.BRONZE).parquet(f"{root}/bronze").select(*CLOCKLESS_BRONZE)


def _silver_stream(spark, folder, root):
    bronze = _bronze_stream(spark, folder, root)
    silver = finish(start_silver(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints/silver",
        name=_stream_name("silver")))
    return [bronze, silver]


def stream_silver(spark, folder):
    root = scratch_folder(spark, "silver")
    _silver_stream(spark, folder, root)
    return spark.read.schema(C.SILVER).parquet(f"{root}/silver").select(*C.SILVER.names)


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("day", T.DateType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType())])


def _daily_events(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), "user_id", "event_type",
        "value")


def _event_stream(spark, root, name, files_per_batch):
    rows = stream_csv(spark, f"{root}/source", EVENTS_SCHEMA, files_per_batch,
                      nested=True)
    return finish(stream_writer(rows, f"{root}/checkpoint", name)
                  .start(f"{root}/table"))


def stream_incremental(spark, folder):
    """Files arriving in two lots; the second run reads the second lot only."""
    root = scratch_folder(spark, "incremental")
    events = _daily_events(spark, folder)
    early = F.dayofmonth("day") <= 15
    name = _stream_name("events")
    for lot in (early, ~early):
        (events.where(lot).withColumn("folder_day", F.col("day"))
         .write.mode("append").partitionBy("folder_day").options(**PLAIN_CSV)
         .csv(f"{root}/source"))
        _event_stream(spark, root, name, files_per_batch=7)
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{root}/table")


def stream_progress(spark, folder):
    """Rows in and rows through each hop, from the progress reports.

    Many small steps, while Spark keeps two reports at a time.
    """
    root = scratch_folder(spark, "progress")
    land(raw_flights(spark, folder), f"{root}/landed")
    retention = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(retention)
    spark.conf.set(retention, "3")
    try:
        log = ProgressLog(spark)
        finish(start_bronze(spark, f"{root}/landed", f"{root}/bronze", f"{root}/c/bronze",
                            SOURCE_LABEL, 12, name=_stream_name("bronze")), log=log)
        finish(start_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/c/silver",
                            2, name=_stream_name("silver")), log=log)
    finally:
        spark.conf.set(retention, before)
    log.store(spark, f"{root}/log")
    hop = F.split_part("query", F.lit("_"), F.lit(1)).alias("hop")
    return spark.read.parquet(f"{root}/log").groupBy(hop).agg(
        F.sum("rows_in").alias("rows_in"),
        (F.count_if(F.col("rows_in") > 0) >= 6).alias("many_steps"))


def stream_stop_all(spark, folder):
    """Two running queries, stopped together; a second stop finds none."""
    root = scratch_folder(spark, "stop")
    _daily_events(spark, folder).write.options(**PLAIN_CSV).csv(f"{root}/source")
    running = [stream_writer(stream_csv(spark, f"{root}/source", EVENTS_SCHEMA),
                             f"{root}/checkpoint-{n}", _stream_name(n), until_caught_up=False)
               .start(f"{root}/{n}") for n in ("one", "two")]
    for query in running:
        query.processAllAvailable()
    mine = {query.name for query in running}
    stopped, again = stop_all_streams(spark, mine), stop_all_streams(spark, mine)
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{root}/one").agg(
        F.count(F.lit(1)).alias("num_rows"), F.lit(stopped).alias("stopped"),
        F.lit(again).alias("stopped_again"),
        F.lit(any(query.isActive for query in running)).alias("any_active"))


def stream_control(spark, folder):
    """Start two running queries, see both ready, stop one by name, then all.

    Returns what each step said next to the rows that went through.
    """
    root = scratch_folder(spark, "control")
    _daily_events(spark, folder).write.options(**PLAIN_CSV).csv(f"{root}/source")
    names = [_stream_name("first"), _stream_name("second")]
    running = []
    for name in names:
        rows = stream_csv(spark, f"{root}/source", EVENTS_SCHEMA)
        running.append(stream_writer(rows, f"{root}/checkpoint-{name}", name,
                                     until_caught_up=False)
                       .start(f"{root}/{name}"))
    ready = [wait_ready(spark, name, progressions=1) for name in names]
    for query in running:
        query.processAllAvailable()
    listed = {row["query"] for row in stream_status(spark).collect()} >= set(names)
    stopped = stop_stream(spark, names[0])
    stopped_again = stop_stream(spark, names[0])
    stop_stream(spark, names[1])
    steps = [("both_ready", all(ready)), ("both_listed", listed),
             ("stopped_by_name", stopped), ("stopped_twice", stopped_again),
             ("any_active", any(query.isActive for query in running))]
    rows = sum((spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1))).scalar()
                for name in names), F.lit(0))
    return spark.createDataFrame(steps, "step string, outcome boolean").withColumn(
        "rows_stored", rows.cast("bigint"))


# -- increments, reuse, bounds ----------------------------------------------

def gold_incremental(spark, folder):
    """The summary built from a first lot of flights, then from a second one."""
    root = scratch_folder(spark, "gold")
    lake = Lake(root, f"gold_{uuid.uuid4().hex[:8]}")
    ensure_database(spark, lake.database)
    silver = silver_flights(spark, folder)
    for lot in (F.col("FlightNum") % 3 > 0, F.col("FlightNum") % 3 == 0):
        write_table(silver.where(lot), lake.folder("flight_silver"), [C.YEAR_PARTITION],
                    mode="append")
        build_gold(spark, lake)
    gold = read_table(spark, lake.table("daily_flights"))
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")
    return gold


def _read_landed_files(spark, files):
    return scan_csv(spark, [unquote(file) for file in files], C.LANDED).select(
        *C.FLIGHT_COLUMNS)


def profile_reuse(spark, folder):
    """A kept profile of landed halves as they come, are replaced and go.

    Each step reads one half, the one that is new or another; a half is a CSV folder, to
    which each task writes a file.
    """
    root = scratch_folder(spark, "reuse")
    flights = raw_flights(spark, folder)
    halves = {half: flights.where(F.col("Month") <= 6 if half == "early" else F.col("Month") > 6)
              for half in ("early", "late")}

    def put(half, rows):
        folder = f"{root}/landed/{half}.csv"
        rows.write.mode("overwrite").options(**PLAIN_CSV).csv(folder)

    store = ProfileStore(spark, f"{root}/profile", f"{root}/landed", _read_landed_files,
                         ["Origin"], nested_csv=True)
    reports = []
    for step, change in (
            ("arrival", lambda: put("early", halves["early"])),
            ("second", lambda: put("late", halves["late"])),
            ("replaced", lambda: put("early", halves["early"].where("Year < 1996"))),
            ("removed", lambda: delete_folder(spark, f"{root}/landed/late.csv"))):
        change()
        read = len({file.rsplit("/", 1)[0] for file in store.refresh()})
        report = store.nulls("amount").select(
            F.lit("nulls").alias("report"), F.col("column_name").alias("item"), "amount").unionByName(
            store.frequent("Origin", 10, name="amount").select(
                F.lit("frequent").alias("report"), F.col("Origin").alias("item"), "amount"))
        path = scratch_folder(spark, "report")
        write_table(report.select(F.lit(step).alias("step"), F.lit(read).alias("files_read"),
                                  "*"), path)
        reports.append(spark.read.parquet(path))
    return reduce(DataFrame.unionByName, reports)


def top_n_bounded(spark, folder):
    """The most frequent values of a skewed column, a flat one and a short one."""
    flights = silver_flights(spark, folder)
    skewed = flights.select(F.when(F.col("FlightNum") % 3 == 0, F.col("Origin")).otherwise(
        F.col("TailNum")).alias("value"))
    reports = {"skewed": skewed, "flat": flights.select(F.col("TailNum").alias("value")),
               "short": flights.select(F.col("UniqueCarrier").alias("value"))}
    return reduce(DataFrame.unionByName, (
        frequent_values_bounded(frame, "value", 10, "num_rows", capacity=256).select(
            F.lit(name).alias("report"), "*") for name, frame in reports.items()))


def star_join_bucketed(spark, folder):
    """Flights and planes stored in buckets of the aircraft, joined without a shuffle."""
    root = scratch_folder(spark, "buckets")
    database, suffix = ensure_database(spark), uuid.uuid4().hex[:8]
    fact, dimension = (f"{database}.{name}_{suffix}" for name in ("flown", "aircraft"))
    flights = silver_flights(spark, folder).withColumn(
        "TailNum", F.when(F.col("FlightNum") % 4 == 0, "N1").when(
            F.col("FlightNum") % 4 == 1, F.lit(None)).otherwise(F.col("TailNum")))
    hot = store_fact(flights, fact, f"{root}/flown", "TailNum", 8)
    store_dimension(planes(spark, folder), hot, dimension, f"{root}/aircraft", "tailnum", 8)
    joined = join_bucketed(spark, fact, dimension, "TailNum", "tailnum",
                           {"manufacturer": "manufacturer", "year": "plane_year"})
    result = joined.select("date", "FlightNum", "Origin", "TailNum", "manufacturer", "plane_year",
                           "ArrDelay")
    result.schema  # resolved before the entries go; the folders stay
    for name in (fact, dimension):
        spark.sql(f"DROP TABLE {name}")
    return result


def table_versions(spark, folder):
    """Three versions of a table, one of the older ones held, then expired and released."""
    root = scratch_folder(spark, "versions")
    name = f"{ensure_database(spark)}.orders_{uuid.uuid4().hex[:8]}"
    versions = TableVersions(spark, root)
    orders = orders_by_day(spark, folder)
    for status in ("o_orderstatus = 'F'", "o_orderstatus = 'O'", "true"):
        versions.publish(name, orders.where(status))
    counts = {v: versions.read(name, v).count() for v in (1, 2, 3)}
    versions.hold(name, 2, 3600)
    steps = [("held", versions.expire(name, 0), versions.stored(name))]
    versions.hold(name, 3, 3600)
    versions.roll_back(name, 2)
    rolled = read_table(spark, name).count()
    versions.roll_back(name, 3)
    for version in (2, 3):
        versions.hold(name, version, 0)
    steps.append(("released", versions.expire(name, 0), versions.stored(name)))
    current = read_table(spark, name).count()
    spark.sql(f"DROP TABLE {name}")
    rows = [(step, v, counts[v], v in gone, v in there, rolled, current)
            for step, gone, there in steps for v in (1, 2, 3)]
    return spark.createDataFrame(
        rows, "step string, version int, num_rows bigint, expired boolean, stored boolean, "
              "rolled_back_rows bigint, current_rows bigint")


ODD_TAXI = ("case when cast(FlightNum as int) % 10 = 0 then 'NA' when cast(FlightNum as int) % 10 "
            "= 1 then '14d' when cast(FlightNum as int) % 10 = 2 then 'n/a' else TaxiIn end")


def cast_rescue(spark, folder):
    """Bronze with odd texts streamed to silver and rescue in one pass: what was rescued,
    by column, text and year, and beside it the rows of silver."""
    root = scratch_folder(spark, "rescue")
    odd = raw_flights(spark, folder).withColumn("TaxiIn", F.expr(ODD_TAXI))
    land(odd, f"{root}/landed")
    finish(start_bronze(spark, f"{root}/landed", f"{root}/bronze", f"{root}/c/bronze",
                        SOURCE_LABEL, name=_stream_name("bronze")))
    finish(start_silver_with_rescue(spark, f"{root}/bronze", f"{root}/silver", f"{root}/c/silver",
                                    name=_stream_name("silver")))
    rescued = rescued_part(spark, f"{root}/silver").groupBy(
        C.YEAR_PARTITION, "column_name", "text").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.bool_and(F.col("source_file").contains("/bronze/")).alias("has_file"))
    silver = silver_part(spark, f"{root}/silver").groupBy(C.YEAR_PARTITION).agg(
        F.count(F.lit(1)).alias("num_rows"))
    return rescued.unionByName(silver.select(
        C.YEAR_PARTITION, F.lit("(all)").alias("column_name"),
        F.lit(None).cast("string").alias("text"), "num_rows", F.lit(True).alias("has_file")))


def queries() -> dict[str, Query]:
    """Query name -> callable, for every operator."""
    return {
        "silver_clean": silver_flights,
        "bronze_metadata": bronze_metadata,
        "hhmm_normalise": hhmm_normalise,
        "safe_casts": safe_casts,
        "lookup_split": airports,
        "lookup_dropna": planes,
        "lookup_passthrough": lookup_passthrough,
        "daily_gold": lambda s, d: daily_summary(silver_flights(s, d)),
        "date_range": lambda s, d: date_range(silver_flights(s, d)),
        "calendar": lambda s, d: calendar_for(silver_flights(s, d)),
        "group_count": lambda s, d: group_counts(
            silver_flights(s, d), "UniqueCarrier", "num_rows"),
        "top_n": lambda s, d: frequent_values(
            silver_flights(s, d), "TailNum", 10, True, "num_rows"),
        "bottom_n": lambda s, d: frequent_values(
            silver_flights(s, d), "TailNum", 10, False, "num_rows"),
        "row_counts": lambda s, d: row_counts({t: table(s, d, t) for t in TABLES}),
        "null_profile": lambda s, d: null_counts(raw_flights(s, d), "raw"),
        "null_compare": lambda s, d: _raw_and_silver(s, d).nulls(),
        "null_shares": lambda s, d: TableSet(
            silver=silver_flights(s, d)).nulls(shares=True),
        "lookup_null_compare": lookup_null_compare,
        "gold_nulls": lambda s, d: null_counts(
            daily_summary(silver_flights(s, d)), "gold"),
        "calendar_nulls": lambda s, d: null_counts(
            calendar_for(silver_flights(s, d)), "gold"),
        "top_n_compare": lambda s, d: _raw_and_silver(s, d).frequent(
            "CancellationCode", 10, shares=True),
        "top_carriers": lambda s, d: _raw_and_silver(s, d).frequent("UniqueCarrier", 10),
        "top_origins": lambda s, d: _raw_and_silver(s, d).frequent("Origin", 10),
        "top_destinations": lambda s, d: _raw_and_silver(s, d).frequent("Dest", 10),
        "bottom_n_compare": lambda s, d: _raw_and_silver(s, d).frequent(
            "Origin", 10, top=False),
        "reconcile": reconcile_landing,
        "delay_reasons": lambda s, d: questions.delay_reasons(silver_flights(s, d)),
        "cancellation_reasons": lambda s, d: questions.cancellation_reasons(
            silver_flights(s, d), raw_cancellations(s)),
        "carrier_delays": lambda s, d: questions.carrier_delays(
            silver_flights(s, d), raw_carriers(s, d)),
        "delay_trend": lambda s, d: questions.delay_trend(silver_flights(s, d)),
        "best_time": lambda s, d: questions.best_time(
            silver_flights(s, d), calendar_for(silver_flights(s, d))),
        "plane_age": lambda s, d: questions.plane_age(
            silver_flights(s, d), planes(s, d)),
        "route_traffic": lambda s, d: questions.route_traffic(
            silver_flights(s, d), airports(s, d)),
        "weather_link": lambda s, d: questions.weather_link(silver_flights(s, d)),
        "star_join": star_join,
        "weather_model": lambda s, d: questions.weather_model(silver_flights(s, d)),
        "gold_incremental": gold_incremental,
        "profile_reuse": profile_reuse,
        "top_n_bounded": top_n_bounded,
        "star_join_bucketed": star_join_bucketed,
        "table_versions": table_versions,
        "cast_rescue": cast_rescue,
        "top_n_compare_typed": top_n_compare_typed,
        "profile_after_arrival": profile_after_arrival,
        "type_guard": type_guard,
        "gold_order": gold_order,
        "dictionary_after_refresh": dictionary_after_refresh,
        "csv_fidelity": csv_fidelity,
        "land_stream_mixed": land_stream_mixed,
        "land_bounded": land_bounded,
        "land_atomic": land_atomic,
        "land_ledger": land_ledger,
        "stream_stop_all": stream_stop_all,
        "csv_scan": csv_scan,
        "csv_inferred": csv_inferred,
        "csv_recursive": csv_recursive,
        "csv_sample_schema": csv_sample_schema,
        "table_roundtrip": table_roundtrip,
        "table_dictionary": table_dictionary,
        "land_harmonise": land_harmonise,
        "land_months": land_months,
        "land_accounting": land_accounting,
        "land_stream": land_stream,
        "stream_bronze": stream_bronze,
        "stream_silver": stream_silver,
        "stream_incremental": stream_incremental,
        "stream_progress": stream_progress,
        "stream_control": stream_control,
    }


STAR_COLUMNS = (
    "date", "quarter_year", "month_year", "UniqueCarrier", "carrier", "FlightNum",
    "Origin", "origin_city", "Dest", "dest_city", "TailNum", "manufacturer",
    "plane_year", "CancellationCode", "cancellation_reason", "ArrDelay")


def star_join(spark, folder):
    silver = silver_flights(spark, folder)
    # A stored lookup has a known size, so the planner broadcasts it from the start
    # instead of shuffling the fact on its few airports.
    stored = scratch_folder(spark, "airports")
    write_table(airports(spark, folder), stored)
    joined = questions.star_join(
        silver, calendar_for(silver), spark.read.parquet(stored), planes(spark, folder),
        raw_carriers(spark, folder), raw_cancellations(spark))
    return joined.select(*STAR_COLUMNS)
