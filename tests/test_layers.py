import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail import contracts as C
from contrail.operators.calendar import calendar_for
from contrail.operators.cleaning import (add_ingest_metadata, clean_flights,
                                         drop_empty_planes)
from contrail.operators.daily import daily_summary
from contrail.plans.samples import bronze_flights, raw_flights

DAY = dt.date(1987, 10, 1)


def shape(schema):
    return [(f.name, f.dataType) for f in schema]


def test_contract_sizes():
    assert [len(s) for s in (C.LANDED, C.BRONZE, C.SILVER, C.GOLD, C.CALENDAR)] == [
        29, 32, 27, 30, 14]
    assert sum(len(comments) for comments in C.DICTIONARY.values()) == 88


def test_layer_schemas(spark, folder):
    silver = clean_flights(bronze_flights(spark, folder))
    assert shape(silver.schema) == shape(C.SILVER)
    assert shape(daily_summary(silver).schema) == shape(C.GOLD)
    assert shape(calendar_for(silver).schema) == shape(C.CALENDAR)


def test_text_and_typed_bronze_clean_alike(spark, folder):
    typed = bronze_flights(spark, folder)
    text = typed.select(*(F.col(c).cast("string").alias(c) for c in typed.columns))
    a, b = clean_flights(typed), clean_flights(text)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bronze_metadata(spark, folder):
    raw = raw_flights(spark, folder)
    bronze = add_ingest_metadata(raw, "feed", "Year")
    assert bronze.columns == C.BRONZE.names
    stamp = bronze.select("data_source", "ingest_time", "ingest_date").distinct().collect()
    assert len(stamp) == 1 and stamp[0]["data_source"] == "feed"
    assert stamp[0]["ingest_time"].date() == stamp[0]["ingest_date"]
    assert add_ingest_metadata(raw, "feed").columns[0] == "Year"


def test_year_spellings_share_a_partition(spark):
    text = spark.createDataFrame([("1987", "a"), ("1987.0", "b")], "Year string, x string")
    years = add_ingest_metadata(text, "feed", "Year").select("p_Year").distinct()
    assert [r[0] for r in years.collect()] == [1987]


def test_unreadable_flight_becomes_nulls(flights_of):
    row = clean_flights(flights_of({
        "p_Year": "1987", "Month": "2", "DayofMonth": "30", "DepTime": "2575",
        "ArrDelay": "NA", "Cancelled": "?", "UniqueCarrier": "AA"})).first()
    assert row["p_Year"] == 1987 and row["UniqueCarrier"] == "AA"
    assert [row[c] for c in ("date", "DepTime", "ArrDelay", "Cancelled")] == [None] * 4


def test_gold_delay_rules(silver_of):
    delays = [-3, 0, 5, None]
    weather = [-2, 0, 4, None]
    row = daily_summary(silver_of(*(
        {"date": DAY, "DepDelay": d, "WeatherDelay": w, "UniqueCarrier": c}
        for d, w, c in zip(delays, weather, ["AA", "AA", "UA", None])))).first()
    assert (row["count_dep_delay"], row["total_dep_delay"], row["average_dep_delay"]) == (
        1, 5, 5.0)
    assert (row["count_weather_delay"], row["total_weather_delay"],
            row["average_weather_delay"]) == (1, 2, 4.0)
    assert (row["count_arr_delay"], row["total_arr_delay"], row["average_arr_delay"]) == (
        0, 0, None)
    assert (row["num_carriers"], row["num_flights"]) == (2, 4)
    assert row["total_cancelled"] is None and row["avg_air_time"] is None


def test_gold_null_day_is_a_group(silver_of):
    rows = daily_summary(silver_of({"date": None}, {"date": None}, {"date": DAY})).collect()
    assert {r["date"]: r["num_flights"] for r in rows} == {None: 2, DAY: 1}


def test_gold_rounds_half_up(silver_of):
    # 201 / 200 = 1.005
    rows = [{"date": DAY, "Distance": 2 if i == 0 else 1} for i in range(200)]
    assert daily_summary(silver_of(*rows)).first()["average_distance"] == 1.01


def test_gold_adds_up_to_silver(spark, folder):
    silver = clean_flights(bronze_flights(spark, folder))
    total = daily_summary(silver).agg(F.sum("num_flights")).first()[0]
    assert total == silver.count()


def test_calendar_spans_whole_years(silver_of):
    rows = calendar_for(silver_of({"date": dt.date(1999, 6, 1)}, {"date": None},
                                  {"date": dt.date(2001, 2, 3)}))
    found = [r[0] for r in rows.select("dte").orderBy("dte").collect()]
    assert (found[0], found[-1]) == (dt.date(1999, 1, 1), dt.date(2001, 12, 31))
    assert len(found) == len(set(found)) == 1096


def test_calendar_attributes(silver_of):
    day = dt.date(2021, 1, 3)
    row = calendar_for(silver_of({"date": day})).where(F.col("dte") == day).first()
    assert tuple(row) == (day, 2021, "Q1", 1, 3, 1, 3, 53, "Jan", "January", "2021-Jan",
                          202101, "2021-Q1", 202101)


def test_calendar_of_no_dates_is_empty(silver_of):
    assert calendar_for(silver_of({"date": None})).count() == 0


def test_calendar_covers_silver(spark, folder):
    silver = clean_flights(bronze_flights(spark, folder))
    dates = silver.select("date").where("date is not null").distinct()
    assert dates.join(calendar_for(silver), F.col("date") == F.col("dte")).count() == (
        dates.count())


@pytest.mark.parametrize("rest, kept", [
    ((None, None), False), (("Boeing", None), True), ((None, 1999), True)])
def test_plane_rows(spark, rest, kept):
    frame = spark.createDataFrame([("N1", *rest)],
                                  "tailnum string, manufacturer string, year int")
    assert drop_empty_planes(frame).count() == int(kept)
