"""What runs again works on what is new: manifests, counts, summary, profiles, versions."""

import os
import re
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from contrail import contracts as C
from contrail.operators import heavy
from contrail.operators.cleaning import clean_with_rescue
from contrail.operators.daily import daily_state, daily_summary, summary_of_state
from contrail.operators.profile import frequent_values, null_counts
from contrail.plans import catalogue, questions
from contrail.plans.gold import GoldState
from contrail.plans.lakehouse import Lake, account, refresh_flights
from contrail.plans.profile_store import ProfileStore
from contrail.plans.samples import FLIGHT_SOURCE, raw_flights
from contrail.sources import manifest as M
from contrail.sources.bucketed import SALT, join_bucketed, store_dimension, store_fact
from contrail.sources.csv_files import scan_csv
from contrail.sources.landing import (_by_file, _position_schema, any_of, count_rows,
                                      file_headers, read_landed)
from contrail.sources.versions import TableVersions
from contrail.streaming.control import ProgressLog, finish, progress_table
from contrail.streaming.hops import land_new_files, stream_writer
from tests.test_plans import explain
from tests.test_sources import flight_file, modern_header, same_rows


@pytest.fixture
def few_reports(spark):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)


# -- progress ---------------------------------------------------------------

def test_progress_is_complete_when_few_reports_are_kept(spark, tmp_path, few_reports):
    for _ in range(6):
        spark.range(5).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def start():
        rows = (spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1)
                .parquet(str(tmp_path / "in")))
        return stream_writer(rows, str(tmp_path / "c"), "small_steps").start(str(tmp_path / "out"))

    log = ProgressLog(spark)
    query = finish(start(), log=log)
    rows = log.table(spark).where("rows_in > 0").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2, 3, 4, 5]
    assert {r.rows_in for r in rows} == {5} and {r.run_id for r in rows} == {str(query.runId)}
    with pytest.raises(ValueError, match="reports"):
        progress_table(spark, [query])
    path = str(tmp_path / "log")
    log.store(spark, path)
    log.store(spark, path)
    assert spark.read.parquet(path).agg(F.sum("rows_in")).first()[0] == 30
    # A run that is taken up again starts at a later batch.
    spark.range(5).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    finish(start(), log=log)
    log.store(spark, path)
    assert spark.read.parquet(path).agg(F.sum("rows_in")).first()[0] == 35


def _report(batch, rows):
    return {"batchId": batch, "numInputRows": rows, "timestamp": f"t{batch}",
            "durationMs": {"triggerExecution": 1}}


def test_a_gap_in_the_batches_is_an_error(spark, few_reports):
    log = ProgressLog(spark)
    query = SimpleNamespace(runId="r", name="q", recentProgress=[], lastProgress=None)
    log.poll(query)
    assert log.table(spark).count() == 0
    for seen in ([0], [0, 1], [3, 4]):
        query.recentProgress = [_report(b, 10) for b in seen]
        query.lastProgress = query.recentProgress[-1]
        log.poll(query)
    assert log.gaps() == {"q": [2]}
    with pytest.raises(ValueError, match="reports were dropped"):
        log.table(spark)


# -- source files -----------------------------------------------------------

@pytest.fixture
def opened(monkeypatch):
    """The files that were opened for their headers, in order."""
    names = []
    real = M.file_headers

    def spy(spark, files):
        names.extend(files)
        return real(spark, files)

    monkeypatch.setattr(M, "file_headers", spy)
    return names


def _landing(spark, tmp_path):
    manifest = M.SourceManifest(spark, str(tmp_path / "manifest"))

    def land(at_most=None, **more):
        return land_new_files(spark, manifest, [str(tmp_path / "one"), str(tmp_path / "two")],
                              str(tmp_path / "landed"), str(tmp_path / "checkpoint"),
                              at_most=at_most, **more)

    return manifest, land


def _years(spark, tmp_path):
    return sorted(r.Year for r in read_landed(spark, str(tmp_path / "landed")).collect())


def test_files_are_opened_once_and_a_late_one_waits(spark, tmp_path, opened):
    manifest, land = _landing(spark, tmp_path)
    sources = [str(tmp_path / "one"), str(tmp_path / "two")]
    assert land() == 0  # neither folder is there
    flight_file(tmp_path / "one" / "a.csv", C.FLIGHT_COLUMNS, {"Year": 1987, "Month": 1})
    flight_file(tmp_path / "two" / "deep" / "b.csv", modern_header(), {"Year": 1999, "Month": 2})
    (tmp_path / "two" / "empty.csv").write_text("")
    flight_file(tmp_path / "two" / "header_only.csv", C.FLIGHT_COLUMNS)
    assert manifest.pin(sources) == 3
    flight_file(tmp_path / "one" / "late.csv", C.FLIGHT_COLUMNS, {"Year": 2001, "Month": 3})
    assert land(at_most=3) == 3  # the lot that an earlier run pinned
    assert _years(spark, tmp_path) == ["1987", "1999"] and len(opened) == 3
    assert land() == 1 and land() == 0
    assert _years(spark, tmp_path) == ["1987", "1999", "2001"]
    assert len(opened) == len(set(opened)) == 4
    rows = {os.path.basename(r.source_file): r.num_rows for r in manifest.files.rows().collect()}
    assert rows == {"a.csv": 1, "b.csv": 1, "header_only.csv": 0, "late.csv": 1}
    for file in (tmp_path / "one").glob("*.csv"):
        file.unlink()
    assert land() == 0


def test_a_lot_that_was_landed_and_not_noted_is_not_landed_twice(spark, tmp_path, monkeypatch):
    manifest, land = _landing(spark, tmp_path)
    flight_file(tmp_path / "one" / "a.csv", C.FLIGHT_COLUMNS, {"Year": 1987, "Month": 1})
    with monkeypatch.context() as broken:
        broken.setattr(M.SourceManifest, "finish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land()
    flight_file(tmp_path / "one" / "b.csv", C.FLIGHT_COLUMNS, {"Year": 1988, "Month": 1})
    land()
    assert _years(spark, tmp_path) == ["1987", "1988"]


def test_bound_holds_over_all_folders_and_oldest_come_first(spark, tmp_path):
    manifest, land = _landing(spark, tmp_path)
    for year, (folder, age) in enumerate([("one", 10), ("two", 400), ("two", 30), ("one", 20)]):
        file = tmp_path / folder / f"{year}.csv"
        flight_file(file, C.FLIGHT_COLUMNS, {"Year": 1990 + year, "Month": 1})
        os.utime(file, (time.time() - age * 86400,) * 2)
    assert land(at_most=2) == 2 and _years(spark, tmp_path) == ["1991", "1992"]
    assert land(at_most=1) == 1 and _years(spark, tmp_path) == ["1991", "1992", "1993"]
    assert land(archive=str(tmp_path / "done")) == 1
    assert not (tmp_path / "one" / "0.csv").exists()
    assert len(list((tmp_path / "done").rglob("0.csv"))) == 1


def test_files_are_matched_to_rows_without_moving_them(spark, tmp_path):
    flight_file(tmp_path / "a.csv", C.FLIGHT_COLUMNS, {"Year": 1987})
    (header,) = {row.header for row in file_headers(spark, str(tmp_path)).collect()}
    found = spark.createDataFrame([(f"file://{tmp_path}/a.csv", header)],
                                  "path string, header string")
    rows = scan_csv(spark, str(tmp_path), _position_schema(29)).select(
        "*", F.col("_metadata.file_path").alias("source_file"))
    plan = explain(_by_file(rows, [header], found), "simple")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_even_partitions_move_source_columns_only(spark, folder):
    flights = raw_flights(spark, folder, parts=6)
    assert flights.rdd.getNumPartitions() == 6
    moved = re.search(r"Exchange RoundRobinPartitioning.*?Output \[(\d+)\]|"
                      r"Exchange\s*\nInput \[(\d+)\]", explain(flights, "formatted"), re.DOTALL)
    assert int(moved[1] or moved[2]) == len(FLIGHT_SOURCE)
    assert same_rows(flights, raw_flights(spark, folder))


def test_odd_names_are_landed(spark, tmp_path):
    _, land = _landing(spark, tmp_path)
    names = ["a,b.csv", "c{d}.csv", "[e]*.csv", "f g.csv", "h\\i.csv", "100%25.csv"]
    for i, name in enumerate(names):
        flight_file(tmp_path / "one" / name, C.FLIGHT_COLUMNS, {"Year": 1990 + i, "Month": 1})
    assert land() == len(names)
    assert _years(spark, tmp_path) == [str(1990 + i) for i in range(len(names))]
    with pytest.raises(ValueError, match="file systems"):
        any_of(["file:///a/b", "hdfs://x/a/b"])


def test_a_file_without_the_columns_is_not_pinned(spark, tmp_path):
    manifest, land = _landing(spark, tmp_path)
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "bad.csv").write_text("Year,Month\n1987,1\n")
    with pytest.raises(ValueError, match="lack the columns"):
        land()
    assert manifest.files.rows().count() == 0


def test_lots_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "LOT_FILES", 2)
    manifest, land = _landing(spark, tmp_path)
    for i in range(5):
        flight_file(tmp_path / "one" / f"{i}.csv", C.FLIGHT_COLUMNS, {"Year": 1990 + i, "Month": 1})
    assert land() == 5
    assert [r["count"] for r in manifest.files.rows().groupBy("lot").count().orderBy(
        "lot").collect()] == [2, 2, 1]


# -- counts of the layers ---------------------------------------------------

def test_account_counts_no_file_twice(spark, tmp_path, monkeypatch):
    from contrail.plans import lakehouse
    counted = []

    def spy(name):
        real = getattr(lakehouse, name)

        def count(spark, files):
            counted.extend(files)
            return real(spark, files)

        monkeypatch.setattr(lakehouse, name, count)

    spy("count_rows")
    spy("count_parquet")
    lake = Lake(str(tmp_path / "lake"), "contrail_counts")
    nothing = refresh_flights(spark, lake, [str(tmp_path / "in")], "feed").first()
    assert nothing.source_rows == nothing.silver_rows == nothing.files_landed == 0
    for i in range(3):
        flight_file(tmp_path / "in" / f"{i}.csv", C.FLIGHT_COLUMNS, {"Year": 1990, "Month": 1 + i},
                    {"Year": 1990, "Month": 1 + i})
        row = refresh_flights(spark, lake, [str(tmp_path / "in")], "feed", max_files=1).first()
        assert row.source_rows == row.landed_rows == row.silver_rows == 2 * (i + 1)
        assert (row.files_landed, row.files_left) == (1, 0)
    assert counted and len(counted) == len(set(counted))
    seen = len(counted)
    account(spark, lake)
    assert len(counted) == seen
    progress = spark.read.parquet(lake.folder("stream_progress"))
    assert progress.agg(F.sum("rows_in")).first()[0] >= 2 * 6
    # Rows that came into a layer past the hops are found.
    (spark.read.parquet(lake.folder("flight_silver")).limit(1).coalesce(1).write.mode("append")
     .parquet(str(tmp_path / "stray")))
    counts = M.FileCounts(spark, lake.folder("file_counts"))
    counts.update("silver", str(tmp_path / "stray"), M.count_parquet)
    with pytest.raises(ValueError, match="row counts differ"):
        account(spark, lake)
    spark.sql("DROP DATABASE contrail_counts CASCADE")


def test_parquet_rows_come_from_footers(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) as text").repartition(3).write.parquet(
        str(tmp_path / "t"))
    files = spark.read.parquet(str(tmp_path / "t")).inputFiles()
    frame = M.count_parquet(spark, files)
    assert "ReadSchema: struct<>" in explain(frame, "simple")
    assert frame.agg(F.sum("num_rows")).first()[0] == 100 and frame.count() == 3
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3,4\n")
    assert [r.num_rows for r in count_rows(spark, [str(tmp_path / "x.csv")]).collect()] == [2]


# -- summary ----------------------------------------------------------------

def _silver(silver_of):
    import datetime
    day = datetime.date(2000, 1, 1)
    return silver_of(
        {"date": day, "UniqueCarrier": "A", "ArrDelay": 5, "Cancelled": False, "Distance": 3},
        {"date": day, "UniqueCarrier": "A", "ArrDelay": -5, "WeatherDelay": -2},
        {"date": day, "UniqueCarrier": None, "AirTime": 7, "Diverted": True},
        {"date": None, "UniqueCarrier": "B", "ArrDelay": 9},
        {"date": day + datetime.timedelta(1), "UniqueCarrier": "B", "CarrierDelay": 4})


def _bag(frame):
    return sorted(map(str, frame.collect()))


def test_states_of_lots_add_up_to_the_summary(silver_of):
    silver = _silver(silver_of)
    lots = [silver.where("UniqueCarrier = 'A'"), silver.where("not UniqueCarrier <=> 'A'")]
    assert _bag(summary_of_state(daily_state(silver))) == _bag(daily_summary(silver))
    both = daily_state(lots[0]).unionByName(daily_state(lots[1]))
    assert _bag(summary_of_state(both)) == _bag(daily_summary(silver))


def test_a_second_build_reads_the_second_lot_only(spark, silver_of, tmp_path):
    silver, folder = _silver(silver_of), str(tmp_path / "silver")
    state = GoldState(spark, str(tmp_path / "state"))
    assert state.take_in(folder) == 0 and state.fresh_lots() == []
    silver.where("date is not null").coalesce(1).write.parquet(folder)
    assert state.take_in(folder) == 1
    gold = state.summary(None, state.fresh_lots())
    gold.write.parquet(str(tmp_path / "gold"))
    state.mark_applied(state.fresh_lots())
    gold = spark.read.parquet(str(tmp_path / "gold"))
    late = silver.where("date is null").unionByName(silver.where("UniqueCarrier is null"))
    late.coalesce(1).write.mode("append").parquet(folder)
    # Sums that a run left behind before it ended are not counted.
    daily_state(silver).write.parquet(str(tmp_path / "state" / "sums" / "lotleft"))
    assert state.take_in(folder) == 1 and len(state.fresh_lots()) == 1
    again = state.summary(gold, state.fresh_lots())
    whole = silver.where("date is not null").unionByName(late)
    assert _bag(again) == _bag(daily_summary(whole))
    assert state.take_in(folder) == 0


# -- profiles ---------------------------------------------------------------

def test_profiles_follow_arrivals_replacements_and_removals(spark, tmp_path):
    folder, read = str(tmp_path / "t"), []

    def reader(spark, files):
        read.extend(files)
        return spark.read.schema("a int, b string").parquet(*files)

    def put(name, rows):
        path = tmp_path / "t" / f"{name}.parquet"
        spark.createDataFrame(rows, "a int, b string").coalesce(1).write.parquet(
            str(tmp_path / f"{name}-{time.time()}"))
        made = max(tmp_path.glob(f"{name}-*"), key=lambda p: p.stat().st_mtime)
        path.parent.mkdir(exist_ok=True)
        os.replace(next(made.glob("*.parquet")), path)

    store = ProfileStore(spark, str(tmp_path / "profile"), folder, reader, ["b"])

    def agrees():
        now = spark.read.schema("a int, b string").parquet(folder)
        assert _bag(store.nulls()) == _bag(null_counts(now)) and store.rows() == now.count()
        assert _bag(store.frequent("b", 2)) == _bag(frequent_values(now, "b", 2))
        assert _bag(store.frequent("b", 2, False)) == _bag(frequent_values(now, "b", 2, False))

    assert store.refresh() == [] and store.rows() == 0 and store.nulls().count() == 0
    put("x", [(1, "p"), (None, "q"), (2, None)])
    assert len(store.refresh()) == 1
    agrees()
    put("y", [(None, "p")] * 4)
    assert len(store.refresh()) == 1
    agrees()
    put("x", [(5, "r")])
    assert [os.path.basename(f) for f in store.refresh()] == ["x.parquet"]
    agrees()
    (tmp_path / "t" / "y.parquet").unlink()
    assert store.refresh() == []
    agrees()
    assert [os.path.basename(f) for f in read] == ["x.parquet", "y.parquet", "x.parquet"]
    with pytest.raises(ValueError, match="not counted"):
        store.frequent("a")


def test_halves_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    read, real = [], ProfileStore.refresh
    monkeypatch.setattr(ProfileStore, "refresh",
                        lambda store: read.append(real(store)) or read[-1])
    lines = spark.range(0, 40, 1, 4).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id % 5 as l_suppkey",
        "cast(id % 7 as int) as l_linenumber", "cast(id as double) as l_quantity",
        "'R' as l_returnflag", "'F' as l_linestatus",
        "make_timestamp(1995 + id div 2 % 2, 1 + id % 2 * 10, 1, 0, 0, 0) as l_shipdate")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    report = catalogue.profile_reuse(spark, str(tmp_path))
    assert [len(files) for files in read] == [4, 4, 4, 0]
    found = {(r.step, r.files_read): r.amount for r in
             report.where("report = 'frequent'").groupBy("step", "files_read").agg(
                 F.sum("amount").alias("amount")).collect()}
    assert found == {("arrival", 1): 20, ("second", 1): 40, ("replaced", 1): 30,
                     ("removed", 0): 10}


# -- frequent values --------------------------------------------------------

@pytest.mark.parametrize("capacity", [16, 100_000])
def test_bounded_top_n_is_exact(spark, capacity, monkeypatch):
    full = []
    real = heavy.frequent_values
    monkeypatch.setattr(heavy, "frequent_values",
                        lambda *a: full.append(a[0].columns) or real(*a))
    skewed = spark.range(0, 40_000, 1, 4).select(F.when(
        F.col("id") % 3 > 0, F.pmod(F.xxhash64("id"), F.lit(5)).cast("string")).when(
        F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("v"))
    for frame, n in ((skewed, 5), (spark.range(1000).select((F.col("id") % 500).alias("v")), 5),
                     (spark.range(7).select((F.col("id") % 3).alias("v")), 10),
                     (spark.createDataFrame([], "v double"), 3),
                     (spark.createDataFrame([(float("nan"),), (0.0,), (-0.0,), (None,)],
                                            "v double"), 3)):
        assert list(map(str, heavy.frequent_values_bounded(frame, "v", n, capacity=capacity)
                        .collect())) == list(map(str, real(frame, "v", n).collect()))


@pytest.mark.parametrize("column", ["value", "lower", "error", "seen", "wanted"])
def test_bounded_top_n_of_a_column_named_as_its_own(spark, column, monkeypatch):
    rows = []
    real = heavy.frequent_values
    monkeypatch.setattr(heavy, "frequent_values", lambda *a: rows.append(a[0].count()) or real(*a))
    frame = spark.range(0, 40_000, 1, 4).select(F.when(
        F.col("id") % 3 > 0, F.col("id") % 5).otherwise(F.col("id")).alias(column))
    found = heavy.frequent_values_bounded(frame, column, 5, capacity=16).collect()
    assert found == real(frame, column, 5).collect()
    assert rows and rows[0] < 40_000  # by the second scan, not by counting everything


def test_bounded_top_n_shuffles_no_more_than_its_summaries(spark):
    frame = spark.range(0, 60_000, 1, 4).select(F.when(
        F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    kept = heavy.summaries(frame, "v", 64)
    assert kept.where("error is null").count() <= 4 * 64
    assert kept.where("error is not null").count() == 4
    # Lower bounds, and true within the error.
    error = kept.agg(F.sum("error")).first()[0]
    lower = kept.where("v = -1" if "v" in kept.columns else "value = -1").agg(
        F.sum("lower")).first()[0]
    assert lower <= 30_000 <= lower + error


# -- buckets ----------------------------------------------------------------

def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS default.bucket_parts")
    rows = spark.range(5000).select((F.col("id") % 700).alias("k"), "id")
    try:
        store_fact(rows, "default.bucket_parts", str(tmp_path / "f"), "k", 4)
        files = [re.search(r"_(\d+)\.c000", f.name)[1] for f in (tmp_path / "f").glob("part-*")]
        assert len(files) == 4 * 8 and len(set(files)) == 4  # each file in one bucket
        assert _bag(spark.table("default.bucket_parts").select("k", "id")) == _bag(rows)
    finally:
        spark.sql("DROP TABLE IF EXISTS default.bucket_parts")


def test_bucketed_join_moves_no_row(spark, tmp_path):
    flights = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("TailNum"),
        F.col("id").alias("n"))
    known = spark.createDataFrame([("hot", 1), ("k7", 2), ("none", 3)], "tailnum string, year int")
    for name in ("bucket_fact", "bucket_dim"):
        spark.sql(f"DROP TABLE IF EXISTS default.{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = store_fact(flights, "default.bucket_fact", str(tmp_path / "f"), "TailNum", 4)
        assert [r[0] for r in hot.collect()] == ["hot"]
        store_dimension(known, hot, "default.bucket_dim", str(tmp_path / "d"), "tailnum", 4)
        joined = join_bucketed(spark, "default.bucket_fact", "default.bucket_dim", "TailNum",
                               "tailnum", {"year": "built"})
        plan = explain(joined, "simple")
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        expected = flights.join(known.toDF("k", "built"), F.col("TailNum") == F.col("k"),
                                "left").drop("k")
        assert _bag(joined) == _bag(expected)
        # Neither the hot key nor the rows without one stand in one bucket.
        salts = spark.table("default.bucket_fact").groupBy("TailNum").agg(
            F.count_distinct(SALT).alias("salts"))
        assert {r.TailNum: r.salts for r in salts.collect()} | {"k7": 1} == {
            r.TailNum: 4 if r.TailNum in (None, "hot") else 1 for r in salts.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("bucket_fact", "bucket_dim"):
            spark.sql(f"DROP TABLE IF EXISTS default.{name}")


# -- versions ---------------------------------------------------------------

def test_versions_are_kept_until_they_expire(spark, tmp_path):
    name, versions = "default.kept_versions", TableVersions(spark, str(tmp_path / "v"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for n in (1, 2, 3):
        assert versions.publish(name, spark.range(n)) == n
        assert spark.table(name).count() == n
    assert versions.expire(name, 3600) == [] and versions.stored(name) == [1, 2, 3]
    versions.roll_back(name, 1)
    assert spark.table(name).count() == 1
    versions.hold(name, 2, 3600)
    assert versions.expire(name, 0) == [3] and versions.stored(name) == [1, 2]
    assert versions.read(name, 2).count() == 2
    for gone in (3, 9):
        with pytest.raises(ValueError, match="no version"):
            versions.read(name, gone)
    versions.hold(name, 2, 0)
    assert versions.expire(name, 0) == [2] and versions.stored(name) == [1]
    assert versions.publish(name, spark.range(8)) == 4
    assert versions.expire(name, 0) == [1] and versions.stored(name) == [4]
    spark.sql(f"DROP TABLE {name}")


# -- rescue -----------------------------------------------------------------

def test_rescue_keeps_what_types_cannot_hold(spark, tmp_path):
    columns = {name: None for name in (C.YEAR_PARTITION, *C.FLIGHT_COLUMNS[1:])}
    rows = [columns | {"p_Year": "1990", "Month": "2", "DayofMonth": "30", "DepTime": "2575",
                       "ArrDelay": "x", "Cancelled": "maybe", "Distance": "12.9"},
            columns | {"p_Year": "1990", "Month": "2", "DayofMonth": "3", "ArrDelay": "4"},
            columns, columns | {"p_Year": "1991"}]
    spark.createDataFrame([tuple(r.values()) for r in rows],
                          ", ".join(f"`{c}` string" for c in columns)).write.parquet(
        str(tmp_path / "b"))
    found = clean_with_rescue(spark.read.parquet(str(tmp_path / "b")))
    assert found.where("kind = 'clean'").count() == 4
    assert found.where("kind = 'clean' and column_name is not null").count() == 0
    lost = found.where("kind = 'rescue'")
    assert sorted((r.p_Year, r.column_name, r.text) for r in lost.collect()) == [
        (1990, "ArrDelay", "x"), (1990, "Cancelled", "maybe"), (1990, "DepTime", "2575"),
        (1990, "date", "1990-2-30"), (1991, "date", "1991-?-?")]
    assert lost.where("source_file is null or date is not null").count() == 0


def test_rescue_casts_each_row_once(spark, tmp_path):
    columns = ", ".join(f"`{c}` string" for c in (C.YEAR_PARTITION, *C.FLIGHT_COLUMNS[1:]))
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "b"))
    found = clean_with_rescue(spark.read.schema(columns).parquet(str(tmp_path / "b")))
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, "1000")
    try:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(fields, before)
    assert plan.count("cast(TaxiIn#") == 1
    assert "Filter" not in plan


# -- weather ----------------------------------------------------------------

def test_weather_model_finds_a_line_and_knows_when_there_is_none(silver_of):
    rows = [{"p_Year": 1988 + i % 4, "WeatherDelay": i % 7, "Distance": i % 11,
             "ArrDelay": 2 + 3 * (i % 7) - (i % 11)} for i in range(80)]
    found = {r.term: r for r in questions.weather_model(silver_of(*rows)).collect()}
    assert {t: r.coefficient for t, r in found.items()} == {
        "constant": 2.0, "weather_minutes": 3.0, "distance": -1.0}
    assert found["constant"].held_error == 0.0 and found["constant"].mean_error > 1
    assert (found["constant"].num_rows, found["constant"].held_rows) == (60, 20)
    flat = [{"p_Year": 1988, "WeatherDelay": 1, "Distance": 2, "ArrDelay": 3}] * 5
    for rows in (flat, [{"p_Year": 1988}]):
        assert {r.coefficient for r in questions.weather_model(silver_of(*rows)).collect()} == {None}
