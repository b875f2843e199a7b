"""The plans are the ones meant: pruned, pushed down, few shuffles, JVM only."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from contrail import contracts as C
from contrail.operators.cleaning import clean_flights
from contrail.operators.daily import daily_summary
from contrail.operators.profile import frequent_values, null_counts
from contrail.plans import questions
from contrail.plans.catalogue import queries, silver_flights
from contrail.plans.samples import bronze_flights
from contrail.session import scratch_folder
from contrail.sources.tables import write_table

# A method the JVM will compile is no longer than this.
COMPILED_METHOD_LIMIT = 8000


def explain(frame, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark, folder):
    """Bronze in text form and silver, stored as the streams store them."""
    root = scratch_folder(spark, "plans")
    typed = bronze_flights(spark, folder)
    text = typed.select(C.YEAR_PARTITION, *(F.col(c).cast("string").alias(c)
                                            for c in typed.columns[1:]))
    write_table(text, f"{root}/bronze", [C.YEAR_PARTITION])
    write_table(clean_flights(text), f"{root}/silver", [C.YEAR_PARTITION])
    return spark.read.parquet(f"{root}/bronze"), spark.read.parquet(f"{root}/silver")


IN_SESSION = [name for name in queries() if not name.startswith(
    ("stream_", "land", "csv_", "table_", "reconcile", "lookup_passthrough", "type_guard",
     "profile_after", "dictionary_"))]


@pytest.mark.parametrize("name", IN_SESSION)
def test_no_python_and_no_products(spark, folder, name):
    plan = explain(queries()[name](spark, folder))
    spark.catalog.clearCache()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_cleaning_compiles(stored):
    bronze, _ = stored
    plan = explain(clean_flights(bronze), "codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < COMPILED_METHOD_LIMIT
    assert "Exchange" not in plan


def test_daily_summary_shuffles_partial_sums_only(stored):
    _, silver = stored
    plan = explain(daily_summary(silver), "simple")
    assert re.findall(r"hashpartitioning\((.*?), \d+\)", plan)[-1].startswith("date")
    assert plan.count("Exchange hashpartitioning") == 2
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "TailNum" not in scan and "DepTime" not in scan
    under_last_exchange = plan.rsplit("Exchange", 1)[1]
    assert "partial_sum" in under_last_exchange


def test_year_filter_prunes_folders(stored):
    _, silver = stored
    one_year = silver.where("p_Year = 1995")
    plan = explain(questions.route_traffic(one_year, _airports(silver)), "simple")
    assert re.search(r"PartitionFilters: \[isnotnull\(p_Year#\d+\), \(p_Year#\d+ = 1995\)", plan)


def _airports(silver):
    return silver.select(F.col("Origin").alias("airport_code"), F.lit("x").alias("city"),
                         F.lit("y").alias("country")).distinct()


def test_null_profile_is_one_scan(stored):
    _, silver = stored
    assert explain(null_counts(silver), "simple").count("FileScan") == 1


def test_null_profile_can_come_from_footers(spark, stored, tmp_path):
    path = str(tmp_path / "flat")
    stored[1].drop(C.YEAR_PARTITION).write.parquet(path)
    settings = {"spark.sql.sources.useV1SourceList": "",
                "spark.sql.parquet.aggregatePushdown": "true"}
    before = {key: spark.conf.get(key) for key in settings}
    expected = sorted(map(tuple, null_counts(spark.read.parquet(path)).collect()))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        report = null_counts(spark.read.parquet(path))
        assert "PushedAggregation: [COUNT(*)" in explain(report, "simple")
        assert sorted(map(tuple, report.collect())) == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_top_n_never_sorts_the_table(stored):
    plan = explain(frequent_values(stored[1], "TailNum"), "simple")
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["plane_age", "route_traffic", "best_time"])
def test_questions_reduce_before_they_join(spark, folder, name):
    """Below every join side that reads flights there is an aggregate."""
    plan = explain(queries()[name](spark, folder), "simple")
    join = plan.index("Join")
    fact_side = plan[join:]
    assert fact_side.index("HashAggregate") < fact_side.index("FileScan")


def test_planes_too_big_to_broadcast_are_merged(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = sorted(map(tuple, queries()["plane_age"](spark, folder).collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = queries()["plane_age"](spark, folder)
        assert "SortMergeJoin" in explain(frame, "simple")
        assert sorted(map(tuple, frame.collect()), key=str) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_star_join_forces_no_broadcast(spark, folder):
    frame = queries()["star_join"](spark, folder)
    assert "ResolvedHint" not in explain(frame, "extended")
    assert frame.count() == silver_flights(spark, folder).count()


def test_star_join_does_not_shuffle_the_fact_on_its_airports(spark, folder):
    plan = explain(queries()["star_join"](spark, folder))
    for key in ("Origin", "Dest"):
        assert not re.search(rf"hashpartitioning\({key}#", plan)
