import pytest
from pyspark.sql import functions as F

from contrail import contracts as C
from contrail.plans.catalogue import modern_header, write_source_files
from contrail.plans.samples import raw_flights
from contrail.session import (ensure_database, scratch_folder, settings_table,
                              use_database, writers_open)
from contrail.sources.csv_files import list_csv, scan_csv, schema_of_sample
from contrail.sources.landing import (contract_positions, file_headers, harmonise,
                                      headers_below, land, landed_months,
                                      read_flight_files, read_landed, rows_per_file,
                                      split_header)
from contrail.sources.tables import (comment_columns, describe_table, read_table,
                                     register_table, write_table)


def text(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)


def flight_line(header, **values):
    known = [C.MODERN_HEADER.get(name, name) for name in header]
    return ",".join(str(values.get(name, "")) for name in known)


def flight_file(path, header, *rows):
    text(path, "\n".join([",".join(f'"{n}"' for n in header),
                          *(flight_line(header, **row) for row in rows)]) + "\n")


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# -- scans ------------------------------------------------------------------

def test_listing_finds_nested_csv_only(spark, tmp_path):
    text(tmp_path / "a.csv", "x\n1\n")
    text(tmp_path / "deep" / "er" / "b.csv", "x\n2\n")
    text(tmp_path / "deep" / "note.txt", "no")
    listed = list_csv(spark, str(tmp_path))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in listed.collect()) == [
        "a.csv", "b.csv"]
    assert sorted(r[0] for r in scan_csv(spark, str(tmp_path), nested=True).collect()) == [1, 2]


def test_inferred_and_sample_schema(spark, tmp_path):
    text(tmp_path / "one.csv", "a,b,c\n1,2.5,x\n")
    text(tmp_path / "two.csv", "a,b,c\n3,4.5,y\n")
    schema = schema_of_sample(spark, str(tmp_path / "one.csv"))
    assert [f.dataType.simpleString() for f in schema] == ["int", "double", "string"]
    assert scan_csv(spark, str(tmp_path / "*"), schema).count() == 2


def test_checked_header_refuses_swapped_columns(spark, tmp_path):
    text(tmp_path / "swapped.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path), "a int, b int", check_header=True).collect()


# -- landing ----------------------------------------------------------------

def test_header_line():
    assert split_header('﻿"YEAR", "MONTH",X') == ("YEAR", "MONTH", "X")


def test_missing_column_is_an_error():
    with pytest.raises(ValueError, match="TailNum"):
        contract_positions([c for c in C.FLIGHT_COLUMNS if c != "TailNum"])


def test_one_header_per_file_in_folders_with_spaces(spark, tmp_path):
    root = tmp_path / "in coming"
    for i in range(12):
        flight_file(root / f"{i}.csv", C.FLIGHT_COLUMNS, {"Year": 1987, "Month": 10})
    flight_file(root / "new" / "a b.csv", modern_header(), {"Year": 2020, "Month": 1})
    assert file_headers(spark, str(root)).count() == 13
    headers = headers_below(spark, str(root))
    assert {split_header(line): len(folders) for line, folders in headers.folders.items()} == {
        C.FLIGHT_COLUMNS: 1, modern_header(): 1}
    assert headers.found.count() == 13 and headers.mixed() == set()
    assert read_flight_files(spark, str(root)).groupBy("Year").count().count() == 2


def test_header_of_split_files_is_found_once(spark, tmp_path):
    flight_file(tmp_path / "big.csv", C.FLIGHT_COLUMNS,
                *({"Year": 1987, "Month": 10, "FlightNum": i} for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert len(file_headers(spark, str(tmp_path)).collect()) == 1
        assert read_flight_files(spark, str(tmp_path)).count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_unnamed_extra_columns_are_dropped(spark, tmp_path):
    header = (*modern_header(), "", "")
    flight_file(tmp_path / "x.csv", header, {"Year": 2020, "Month": 3, "Dest": "AUS"})
    row = read_flight_files(spark, str(tmp_path)).first()
    assert len(row) == 29 and (row["Year"], row["Dest"]) == ("2020", "AUS")


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_flight_files(spark, str(tmp_path))


def test_harmonise_frame(spark, folder):
    raw = raw_flights(spark, folder)
    modern = raw.select(*(F.col(name).alias(new) for new, name in C.MODERN_HEADER.items()),
                        F.lit(1).alias("EXTRA"))
    assert harmonise(modern).columns == list(C.FLIGHT_COLUMNS)
    assert same_rows(harmonise(modern), raw)


def test_landing_round_trip(spark, folder):
    root = scratch_folder(spark, "landing")
    write_source_files(spark, folder, root)
    flights = read_flight_files(spark, root, with_path=True)
    raw = raw_flights(spark, folder)
    assert rows_per_file(flights).agg(F.sum("num_rows")).first()[0] == raw.count()
    land(flights, f"{root}-landed")
    landed = read_landed(spark, f"{root}-landed")
    assert same_rows(landed, raw.select(*(F.col(c).cast("string") for c in raw.columns)))
    months = landed_months(landed)
    assert months.where("land_month not between land_year * 100 + 1 and "
                        "land_year * 100 + 12").count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        land(flights, f"{root}-landed")


def test_regrouped_files_hold_what_the_rows_held(spark, tmp_path):
    odd = [None, "", " ", "  a ", '"', '""', 'say "x"', "back\\slash\\", '\\"', "a,b", "a\nb", "a\r\nb",
           "\r", "\t", "#x", "null", "NaN", "ü", "\U0001f600", "\u0000", "'", ',"', '",', "x" * 70_000]
    names = C.FLIGHT_COLUMNS
    rows = spark.createDataFrame(
        [(("1999", "1") + tuple(odd[(n + at) % len(odd)] for at in range(len(names) - 2)))
         for n in range(len(odd))], ", ".join(f"`{name}` string" for name in names))
    typed = rows.withColumns({"Year": F.lit(2001), "Month": F.lit(2.0), "Distance": F.lit(1e-7),
                              "Diverted": F.lit(True), "TaxiIn": F.lit(float("nan"))})
    for n, frame in enumerate((rows, typed)):
        for regroup in (True, False):
            land(frame, str(tmp_path / f"{n}{regroup}"), regroup=regroup)
        moved, kept = (sorted(sum((file.read_bytes().split(b"\n")[1:] for file in
                                   (tmp_path / f"{n}{regroup}").rglob("*.csv")), []))
                       for regroup in (True, False))
        assert [line for line in moved if line] == [line for line in kept if line]


def test_year_file_gives_twelve_month_folders(spark, tmp_path):
    flight_file(tmp_path / "in" / "1988.csv", C.FLIGHT_COLUMNS,
                *({"Year": 1988, "Month": m} for m in range(1, 13)))
    land(read_flight_files(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    folders = sorted(p.name for p in (tmp_path / "out" / "land_year=1988").iterdir())
    assert folders == [f"land_month={198800 + m}" for m in range(1, 13)]
    file = next((tmp_path / "out").rglob("*.csv"))
    assert split_header(file.read_text().splitlines()[0]) == C.FLIGHT_COLUMNS


# -- tables -----------------------------------------------------------------

@pytest.fixture
def database(spark):
    before = spark.catalog.currentDatabase()
    use_database(spark, "contrail_test")
    yield "contrail_test"
    spark.catalog.setCurrentDatabase(before)


def test_partitioned_writes_do_not_sort(spark):
    setting, sorts = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(setting)
    with pytest.raises(KeyError), writers_open(spark):
        sorts.append(spark.conf.get(setting))
        raise KeyError
    assert sorts == ["100"] and spark.conf.get(setting) == before


@pytest.mark.parametrize("most", [1, 100])
def test_more_partitions_than_open_writers_lose_no_row(spark, tmp_path, monkeypatch, most):
    rows = spark.range(5000, numPartitions=1).select("id", (F.col("id") % 150).alias("part"))
    monkeypatch.setattr("contrail.sources.tables.writers_open",
                        lambda session: writers_open(session, most))
    write_table(rows, str(tmp_path / "t"), ["part"], regroup=False)
    assert same_rows(spark.read.parquet(str(tmp_path / "t")).select(
        "id", F.col("part").cast("bigint")), rows)


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="(?i)exists"):
        write_table(spark.range(5), path)
    write_table(spark.range(3), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_partitioned_table_by_name(spark, tmp_path, database):
    path = str(tmp_path / "it's")
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("p_k"))
    write_table(rows, path, ["p_k"])
    register_table(spark, "by_k", path)
    assert spark.catalog.currentDatabase() == database
    assert read_table(spark, "by_k").where("p_k = 1").count() == 33
    register_table(spark, "by_k", path)
    assert read_table(spark, "by_k").count() == 100
    write_table(rows.where("p_k = 0"), path, ["p_k"], mode="append")
    register_table(spark, "by_k", path)
    assert read_table(spark, "by_k").count() == 134


def test_comments(spark, tmp_path, database):
    path = str(tmp_path / "t")
    write_table(spark.range(1).withColumn("b", F.lit("x")), path)
    register_table(spark, "noted", path)
    comment_columns(spark, "noted", {"id": "the row's \\ number", "b": "text"})
    found = {r["col_name"]: r["comment"] for r in describe_table(spark, "noted").collect()}
    assert found == {"id": "the row's \\ number", "b": "text"}
    extended = describe_table(spark, "noted", extended=True)
    assert extended.where("col_name = 'Location'").count() == 1


def test_database_and_settings(spark):
    assert ensure_database(spark, "contrail_other") == "contrail_other"
    assert spark.catalog.databaseExists("contrail_other")
    settings = {r["setting"]: r["value"] for r in settings_table(spark).collect()}
    assert settings["spark.sql.adaptive.enabled"] == "true"


def test_scratch_folders_are_fresh_and_shared(spark):
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


class _Settings:
    """Stands in for a session of which only the settings are asked."""

    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


def test_scratch_folder_without_a_shared_folder(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    assert scratch_folder(_Settings(spark_master="local[2]"), "x").startswith(str(tmp_path))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(_Settings(spark_master="yarn"), "x")


def test_headers_survive_packed_files_and_odd_names(spark, tmp_path):
    """Files that the cluster's defaults would pack, and names that look like patterns."""
    for i in range(6):
        flight_file(tmp_path / f"f[{i}].csv", C.FLIGHT_COLUMNS if i % 2 else modern_header(),
                    {"Year": 1987 + i, "Month": 10})
    flight_file(tmp_path / "f1.csv", C.FLIGHT_COLUMNS, {"Year": 2010, "Month": 1})
    flight_file(tmp_path / "a{b}*?" / "x.csv", C.FLIGHT_COLUMNS, {"Year": 2011, "Month": 1})
    spark.conf.set("spark.sql.files.maxPartitionNum", "2")
    try:
        years = [r.Year for r in read_flight_files(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionNum")
    assert sorted(years) == [*map(str, range(1987, 1993)), "2010", "2011"]
    lone = tmp_path / "lone"
    flight_file(lone / "f[1].csv", C.FLIGHT_COLUMNS, {"Year": 1990, "Month": 1})
    assert read_flight_files(spark, str(lone)).count() == 1


def test_one_task_opens_a_file(spark, tmp_path):
    for i in range(3):
        flight_file(tmp_path / f"{i}.csv", C.FLIGHT_COLUMNS,
                    *({"Year": 1987, "Month": 10, "FlightNum": n} for n in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert file_headers(spark, str(tmp_path)).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_are_read_without_python(spark, tmp_path):
    """Python would be sent all lines of a file for the sake of its first."""
    for i in range(3):
        flight_file(tmp_path / f"{i}.csv", C.FLIGHT_COLUMNS if i else modern_header(),
                    *({"Year": 1987, "Month": 10, "FlightNum": n} for n in range(500)))
    found = file_headers(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "PythonMapInArrow" not in plan
    assert sorted(split_header(row.header) for row in found.collect()) == sorted(
        [modern_header(), C.FLIGHT_COLUMNS, C.FLIGHT_COLUMNS])


def test_old_files_are_landed(spark, tmp_path):
    import os
    import time

    from contrail.sources.manifest import SourceManifest
    from contrail.streaming.hops import land_new_files

    def run():
        land_new_files(spark, SourceManifest(spark, str(tmp_path / "manifest")),
                       [str(tmp_path / "in")], str(tmp_path / "landed"),
                       str(tmp_path / "checkpoint"))
        return read_landed(spark, str(tmp_path / "landed")).count()

    flight_file(tmp_path / "in" / "new.csv", C.FLIGHT_COLUMNS, {"Year": 1987, "Month": 10})
    assert run() == 1
    old = tmp_path / "in" / "old.csv"
    flight_file(old, modern_header(), {"Year": 1987, "Month": 11})
    os.utime(old, (time.time() - 30 * 86400,) * 2)
    assert run() == 2
    with pytest.raises(ValueError, match="stream"):
        land(read_flight_files(spark, str(tmp_path / "in")), str(tmp_path / "landed"), "append")


def test_comments_outlive_a_new_folder(spark, tmp_path):
    from contrail.sources.tables import comment_columns, describe_table, register_table
    name = "default.kept_comments"
    for step in ("a", "b"):
        spark.range(3).selectExpr("id", "id as other").write.parquet(str(tmp_path / step))
        register_table(spark, name, str(tmp_path / step))
        if step == "a":
            comment_columns(spark, name, {"id": "the number"})
    assert {r.col_name: r.comment for r in describe_table(spark, name).collect()} == {
        "id": "the number", "other": None}
    spark.sql(f"DROP TABLE {name}")


def test_full_reports_are_an_error(spark, tmp_path):
    from contrail.streaming.control import finish, progress_table
    from contrail.streaming.hops import stream_writer
    for i in range(4):
        spark.range(5).write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        rows = (spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 3)
                .parquet(str(tmp_path / "in")))
        query = finish(stream_writer(rows, str(tmp_path / "c"), "many").start(
            str(tmp_path / "out")))
        with pytest.raises(ValueError, match="reports"):
            progress_table(spark, [query])
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
