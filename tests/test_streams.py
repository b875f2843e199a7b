import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from contrail import contracts as C
from contrail.operators.cleaning import add_ingest_metadata, clean_flights
from contrail.plans.catalogue import modern_header
from contrail.plans.samples import raw_flights
from contrail.session import scratch_folder
from contrail.sources.csv_files import stream_csv
from contrail.sources.landing import (land, read_flight_files, read_landed,
                                     stream_flight_files, stream_landed)
from contrail.sources.tables import read_table, register_table
from contrail.streaming import hops
from contrail.streaming.control import (find_stream, finish, progress_table,
                                        stop_all_streams, stop_stream, stream_status,
                                        wait_ready)
from contrail.streaming.hops import (start_bronze, start_landing, start_silver,
                                     stream_writer)
from tests.test_sources import flight_file, flight_line, same_rows, text


def name(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


def run_hops(spark, root, **options):
    bronze = finish(start_bronze(spark, f"{root}/landed", f"{root}/bronze", f"{root}/cb",
                                 "feed", name=name("bronze"), **options), 120)
    silver = finish(start_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/cs",
                                 name=name("silver")), 120)
    return bronze, silver


def test_bronze_files_can_be_shared_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hops, "BRONZE_ROW_GROUP", 1 << 20)
    texts = {c: F.concat(F.lit(c), F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 512))
             for c in ("TailNum", "Origin", "Dest")}
    rows = spark.range(60000).coalesce(1).select(*(
        (texts[c] if c in texts else F.lit("1990" if c == "Year" else "1")).alias(c)
        for c in C.FLIGHT_COLUMNS))
    root = str(tmp_path)
    land(rows, f"{root}/landed", regroup=False)
    finish(start_bronze(spark, f"{root}/landed", f"{root}/bronze", f"{root}/c", "feed",
                        name=name("bronze")), 120)
    files = [pq.ParquetFile(f) for f in Path(root, "bronze").rglob("*.parquet")]
    assert sum(f.metadata.num_rows for f in files) == 60000
    assert max(f.metadata.num_row_groups for f in files) > 1


def rows_in(*queries):
    return [sum(p["numInputRows"] for p in q.recentProgress) for q in queries]


def test_hops_take_only_what_is_new(spark, folder):
    root = scratch_folder(spark, "hops")
    raw = raw_flights(spark, folder)
    early = F.col("Year") < 1995
    land(raw.where(early), f"{root}/landed")
    first = raw.where(early).count()
    assert rows_in(*run_hops(spark, root)) == [first, first]
    assert rows_in(*run_hops(spark, root)) == [0, 0]
    land(raw.where(~early), f"{root}/landed", mode="append")
    rest = raw.count() - first
    assert rows_in(*run_hops(spark, root)) == [rest, rest]

    batch = clean_flights(add_ingest_metadata(read_landed(spark, f"{root}/landed"),
                                              "feed", "Year"))
    stored = spark.read.schema(C.SILVER).parquet(f"{root}/silver").select(*C.SILVER.names)
    assert same_rows(stored, batch)

    spark.sql("CREATE DATABASE IF NOT EXISTS contrail_streams")
    for table in ("bronze", "silver"):
        register_table(spark, f"contrail_streams.{table}", f"{root}/{table}")
        assert read_table(spark, f"contrail_streams.{table}").count() == raw.count()
    pruned = read_table(spark, "contrail_streams.silver").where("p_Year = 1994")
    assert pruned.count() == raw.where("Year = 1994").count()
    assert len(pruned.inputFiles()) > 0


def test_files_of_lost_tasks_stay_hidden(spark, folder):
    """A file the commit log does not name is not part of the table."""
    root = scratch_folder(spark, "orphan")
    raw = raw_flights(spark, folder)
    land(raw, f"{root}/landed")
    run_hops(spark, root)
    year = next(p for p in Path(f"{root}/silver").iterdir() if p.name.startswith("p_Year"))
    whole = next(year.glob("*.parquet"))
    (year / "part-99999-left-behind.parquet").write_bytes(whole.read_bytes())
    spark.sql("CREATE DATABASE IF NOT EXISTS contrail_streams")
    register_table(spark, "contrail_streams.hidden", f"{root}/silver")
    assert read_table(spark, "contrail_streams.hidden").count() == raw.count()


def test_steps_are_bounded(spark, tmp_path):
    for i in range(5):
        flight_file(tmp_path / "in" / f"{i}.csv", C.FLIGHT_COLUMNS,
                    {"Year": 1987, "Month": 10 + i % 3, "FlightNum": i})
    source = stream_flight_files(spark, str(tmp_path / "in"), C.FLIGHT_COLUMNS, 2)
    query = finish(start_landing([source], str(tmp_path / "landed"), str(tmp_path / "c")), 120)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 1]
    again = finish(start_landing([source], str(tmp_path / "landed"), str(tmp_path / "c")), 120)
    assert rows_in(again) == [0]
    assert read_landed(spark, str(tmp_path / "landed")).count() == 5


def test_landed_files_are_compressed_and_whole(spark, tmp_path):
    lines = [flight_line(C.FLIGHT_COLUMNS, Year=1987, Month=10, FlightNum=i, TailNum=f"N{i}")
             for i in range(2_000)]
    text(tmp_path / "in" / "a.csv", "\n".join([",".join(C.FLIGHT_COLUMNS), *lines]) + "\n")
    odd = {"Year": 1988, "Month": 1, "TailNum": " N1 ", "Origin": "a\\b", "Dest": ""}
    flight_file(tmp_path / "in" / "b.csv", C.FLIGHT_COLUMNS, odd)
    source = stream_flight_files(spark, str(tmp_path / "in"), C.FLIGHT_COLUMNS)
    finish(start_landing([source], str(tmp_path / "landed"), str(tmp_path / "c")), 120)
    files = list((tmp_path / "landed").rglob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert 3 * sum(f.stat().st_size for f in files) < (tmp_path / "in" / "a.csv").stat().st_size
    asked = read_flight_files(spark, str(tmp_path / "in"))
    assert same_rows(read_landed(spark, str(tmp_path / "landed")), asked)
    steps = stream_landed(spark, str(tmp_path / "landed"))
    finish(stream_writer(steps, str(tmp_path / "c2"), "onward").start(str(tmp_path / "onward")), 120)
    assert same_rows(spark.read.schema(C.LANDED).parquet(str(tmp_path / "onward"))
                     .select(*C.FLIGHT_COLUMNS), asked)


def test_wrong_header_fails_the_stream(spark, tmp_path):
    flight_file(tmp_path / "in" / "a.csv", modern_header(), {"Year": 2020, "Month": 1})
    source = stream_flight_files(
        spark, str(tmp_path / "in"), (*C.FLIGHT_COLUMNS, "EXTRA"))
    with pytest.raises(Exception, match="(?i)header"):
        finish(start_landing([source], str(tmp_path / "out"), str(tmp_path / "c")), 120)


def start_running(spark, root, label):
    (spark.range(10).select(F.col("id").cast("string").alias("x"))
     .write.mode("overwrite").option("header", True).csv(f"{root}/in"))
    from contrail.sources.landing import _text_schema
    rows = stream_csv(spark, f"{root}/in", _text_schema(["x"]))
    return stream_writer(rows, f"{root}/c-{label}", label, until_caught_up=False).start(
        f"{root}/{label}")


def test_control(spark):
    root = scratch_folder(spark, "control")
    one, two = name("one"), name("two")
    first, second = start_running(spark, root, one), start_running(spark, root, two)
    assert wait_ready(spark, one, progressions=1, wait_for=60)
    assert wait_ready(spark, two, progressions=1, wait_for=60)
    assert not wait_ready(spark, "nobody", wait_for=0.2)
    assert not wait_ready(spark, one, progressions=10_000, wait_for=0.2)
    first.processAllAvailable()
    status = {r["query"]: r["active"] for r in stream_status(spark).collect()}
    assert status[one] and status[two]
    progress = progress_table(spark, [first]).agg(F.sum("rows_in")).first()[0]
    assert progress == 10
    assert find_stream(spark, one).id == first.id
    assert stop_stream(spark, one) and not stop_stream(spark, one)
    assert second.isActive
    assert stop_all_streams(spark) and not stop_all_streams(spark)
    assert not second.isActive


def test_overdue_query_is_stopped(spark):
    root = scratch_folder(spark, "overdue")
    query = start_running(spark, root, name("slow"))
    with pytest.raises(TimeoutError):
        finish(query, timeout=1)
    assert not query.isActive
