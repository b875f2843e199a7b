import pytest
from pyspark.sql import functions as F

from contrail import contracts as C
from contrail.operators.profile import TableSet, require_reconciled
from contrail.plans import questions
from contrail.plans.catalogue import write_source_files
from contrail.plans.lakehouse import (Lake, build_gold, document, load_lookups,
                                      refresh_flights)
from contrail.plans.samples import (raw_airports, raw_cancellations, raw_carriers,
                                    raw_flights, raw_planes)
from contrail.session import scratch_folder
from contrail.sources.landing import read_landed
from contrail.sources.tables import describe_table, read_table


@pytest.fixture(scope="module")
def lake(spark, folder):
    root = scratch_folder(spark, "lake")
    lake = Lake(f"{root}/lake", "contrail_lake")
    write_source_files(spark, folder, f"{root}/source")
    for name, frame in (("airport", raw_airports(spark, folder)),
                        ("plane", raw_planes(spark, folder)),
                        ("cancellation", raw_cancellations(spark)),
                        ("carrier", raw_carriers(spark, folder))):
        frame.write.option("header", True).csv(f"{root}/lookups/{name}")
    sources = [f"{root}/source/classic", f"{root}/source/modern"]
    refresh_flights(spark, lake, sources, "feed", timeout=300)
    lookups = {name: f"{root}/lookups/{name}"
               for name in ("airport", "plane", "cancellation", "carrier")}
    load_lookups(spark, lake, **lookups)
    build_gold(spark, lake)
    document(spark, lake)
    return lake, sources, lookups


def test_all_rows_arrive(spark, folder, lake):
    tables = lake[0]
    silver = read_table(spark, tables.table("flight_silver"))
    assert require_reconciled(read_landed(spark, tables.landed), silver).count() == 1
    gold = read_table(spark, tables.table("daily_flights"))
    assert gold.agg(F.sum("num_flights")).first()[0] == raw_flights(spark, folder).count()


def test_rerun_adds_nothing_and_gold_is_replaced(spark, lake):
    tables, sources, lookups = lake
    before = read_table(spark, tables.table("daily_flights")).collect()
    refresh_flights(spark, tables, sources, "feed", timeout=300)
    build_gold(spark, tables)
    after = read_table(spark, tables.table("daily_flights")).collect()
    assert sorted(map(str, before)) == sorted(map(str, after))
    with pytest.raises(Exception, match="(?i)exists"):
        load_lookups(spark, tables, **lookups)


def test_every_column_is_documented(spark, lake):
    document(spark, lake[0])
    for name, comments in C.DICTIONARY.items():
        rows = describe_table(spark, lake[0].table(name)).where("comment is not null")
        assert {r["col_name"]: r["comment"] for r in rows.collect()
                if not r["col_name"].startswith("#")} == comments


def test_quality_reports(spark, lake):
    table = lake[0].table
    layers = TableSet(bronze=read_table(spark, table("flight_bronze")),
                      silver=read_table(spark, table("flight_silver")))
    gaps = {r["column_name"]: (r["bronze"], r["silver"]) for r in layers.nulls().collect()}
    assert gaps["UniqueCarrier"] == (0, 0)
    assert gaps["Month"][1] is None and gaps["date"] == (None, 0)
    assert gaps["DepTime"][0] < gaps["DepTime"][1]
    for column in ("UniqueCarrier", "Origin", "Dest"):
        assert all(r["var_bronze_silver"] == 0 for r in layers.frequent(column).collect())


def test_questions_on_stored_tables(spark, lake):
    table = lambda name: read_table(spark, lake[0].table(name))
    silver = table("flight_silver")
    rows = silver.count()
    star = questions.star_join(
        silver, table("calendar_days"), table("airport_places"), table("plane_register"),
        table("carrier_names"), table("cancellation_silver"))
    assert star.count() == rows
    assert star.where("carrier is null or origin_city is null").count() == 0
    by_age = questions.plane_age(silver, table("plane_register"))
    assert by_age.agg(F.sum("num_flights")).first()[0] == rows
    times = questions.best_time(silver, table("calendar_days")).groupBy("period").agg(
        F.sum("num_flights").alias("n"))
    assert {r["period"]: r["n"] for r in times.collect()} == {
        "hour": rows, "weekday": rows, "month": rows}
