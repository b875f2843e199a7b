import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.functions import (clock_text, day_from_parts, place_parts, to_flag,
                                to_whole)


def one(spark, values, kind, build):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in frame.select(build(F.col("v"))).collect()]


def clock_by_rule(number):
    """The clock rule in plain steps: midnight, pad to four, cut, check, print."""
    if number is None:
        return None
    text = str(0 if number == 2400 else int(number)).rjust(4, "0")[:4]
    if not text.isdigit() or int(text[:2]) > 23 or int(text[2:]) > 59:
        return None
    return f"{text[:2]}:{text[2:]}"


EDGES = {0: "00:00", 5: "00:05", 930: "09:30", 2400: "00:00", 2359: "23:59",
         2575: None, 975: None, -5: None, None: None, 12345: "12:34", 24005: None}


@pytest.mark.parametrize("kind, form", [
    ("int", int), ("double", float), ("string", str), ("string", lambda v: f"{v}.0")])
def test_clock_edges(spark, kind, form):
    values = [None if v is None else form(v) for v in EDGES]
    found = one(spark, values, kind, lambda c: clock_text(c, kind))
    assert found == list(EDGES.values())


@pytest.mark.parametrize("kind", ["int", "double", "string"])
def test_clock_matches_rule_everywhere(spark, kind):
    numbers = spark.range(-3000, 30000)
    rows = numbers.select("id", clock_text(F.col("id").cast("int").cast(kind), kind)
                          .alias("t")).collect()
    assert {r["id"]: r["t"] for r in rows} == {
        n: clock_by_rule(n) for n in range(-3000, 30000)}


def test_whole(spark):
    values = ["14.0", "14.9", "-3.7", "NA", "", None, "99999999999", "1e3", "14d", "NaN", " "]
    assert one(spark, values, "string", to_whole) == [
        14, 14, -3, None, None, None, None, 1000, None, None, None]
    assert one(spark, [14.9, -0.5, None, float("nan")], "double",
               lambda c: to_whole(c, "double"))[:3] == [14, 0, None]


def test_flag(spark):
    values = ["0", "1", "0.00", "1.00", "NA", None, "NaN", "true", "False", "1d", ""]
    assert one(spark, values, "string", to_flag) == [
        False, True, False, True, None, None, None, True, False, None, None]
    assert one(spark, [1.0, float("nan"), 0.0, None], "double",
               lambda c: to_flag(c, "double")) == [True, None, False, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, ["2575", "x", "930"], "string", clock_text) == [
            None, None, "09:30"]
        assert one(spark, ["x", "7.5"], "string", to_whole) == [None, 7]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


ODD_NUMBERS = ["14.0", "14.9", "-3.7", "+5", "5.", ".5", ".", "-", "+.", "1e3", "1E-2", "e3",
               "14.9999999", "99999999999", "9" * 40, "NaN", "inf", "14d", "0x1", " 7 ", "\t1\n",
               "7\x7f", "1 2", "\u0663", "\u00a01", "1\u2028", "NA", "", " ", None]
ODD_WORDS = ["0", "1", "0.00", "true", " TRUE ", "\x7fy\x00", "No", "t", "f", "n", "yes", "yess",
             "F\n", "tr ue", "maybe", "\u00a0true", *ODD_NUMBERS]


@pytest.mark.parametrize("build, values", [(to_whole, ODD_NUMBERS), (to_flag, ODD_WORDS)])
def test_odd_texts_cast_alike_with_and_without_pattern(spark, build, values):
    assert one(spark, values, "string", lambda c: build(c, odd=True)) == one(
        spark, values, "string", build)


def test_odd_texts_do_not_reach_the_cast(spark):
    plan = spark.createDataFrame([("NA",)], "v string").select(
        to_whole(F.col("v"), odd=True), to_flag(F.col("v"), odd=True))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "RLIKE(v#" in text and "cast(v#" not in text


def test_day(spark):
    rows = [(1987, 1, 5), (1987, 2, 30), (1987, None, 5), (2000, 2, 29), (None, 1, 1),
            (1987, 13, 1), (1987, 12, 31)]
    frame = spark.createDataFrame(rows, "y int, m int, d int")
    found = [r[0] for r in frame.select(
        day_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert found == [dt.date(1987, 1, 5), None, None, dt.date(2000, 2, 29), None, None,
                     dt.date(1987, 12, 31)]


def test_place(spark):
    values = ["Austin, TX: Bergstrom", "St. Louis, MO: Foo, Bar", "X, Y", "Plain", None]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    parts = place_parts(F.col("v"))
    rows = frame.select(*(parts[n].alias(n) for n in ("city", "country", "airport_name")))
    assert [tuple(r) for r in rows.collect()] == [
        ("Austin", "TX", "Bergstrom"), ("St. Louis", "MO", "Foo"), ("X", "Y", None),
        ("Plain", None, None), (None, None, None)]
