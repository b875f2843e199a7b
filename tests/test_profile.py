import pytest
from pyspark.sql import functions as F

from contrail.operators.joins import attach, merge_on_key
from contrail.operators.profile import (TableSet, frequent_values, null_counts,
                                        reconcile, require_reconciled, row_counts)


@pytest.fixture
def left(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", None), ("b", None), (None, 4)], "k string, v int")


@pytest.fixture
def right(spark):
    return spark.createDataFrame([("a",), ("c",), (None,), (None,)], "k string")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_null_counts_sorted(left):
    assert rows(null_counts(left, "t")) == [("v", 2), ("k", 1)]


def test_null_counts_of_empty_table_and_odd_names(spark):
    frame = spark.createDataFrame([], "`a.b` string, `c``d` int")
    assert sorted(rows(null_counts(frame))) == [("a.b", 0), ("c`d", 0)]


def test_ties_go_to_the_lower_key(spark):
    frame = spark.createDataFrame([(v,) for v in "ccbbaad"], "k string")
    assert rows(frequent_values(frame, "k", 2)) == [("a", 2), ("b", 2)]
    assert rows(frequent_values(frame, "k", 2, top=False)) == [("d", 1), ("a", 2)]


def test_null_compare_with_missing_column(left, right):
    report = TableSet(l=left, r=right).nulls()
    assert report.columns == ["column_name", "l", "r", "var_l_r"]
    assert sorted(rows(report)) == [("k", 1, 2, -1), ("v", 2, None, None)]


def test_frequent_compare_matches_null_keys(left, right):
    found = {r[0]: tuple(r)[1:] for r in
             TableSet(l=left, r=right).frequent("k").collect()}
    assert found == {"a": (2, 1, 1), "b": (1, None, None), "c": (None, 1, None),
                     None: (1, 2, -1)}


def test_three_tables_give_all_pairs(left, right):
    names = TableSet(l=left, m=left, r=right).frequent("k").columns
    assert names == ["k", "l", "m", "r", "var_l_m", "var_l_r", "var_m_r"]


def test_table_without_the_column(left, right):
    found = {r["v"]: (r["l"], r["r"]) for r in
             TableSet(l=left, r=right).frequent("v").collect()}
    assert found == {1: (1, None), 4: (1, None), None: (2, None)}
    with pytest.raises(ValueError):
        TableSet(r=right).frequent("v")


def test_shares(left):
    shares = {r["column_name"]: r["t_share"] for r in
              TableSet(t=left).nulls(shares=True).collect()}
    assert shares == {"k": 0.25, "v": 0.5}


def test_single_table_is_not_compared(left):
    tables = TableSet(t=left)
    assert len(tables) == 1
    assert tables.nulls().columns == ["column_name", "t"]
    assert rows(tables.rows()) == [("t", 4)]


def test_replacing_a_table_forgets_its_reports(left, right):
    tables = TableSet(t=left)
    assert ("v", 2) in rows(tables.nulls())
    assert len(tables.add("t", right)) == 1
    assert rows(tables.nulls()) == [("k", 2)]


def test_only_frames_are_accepted():
    with pytest.raises(TypeError):
        TableSet(t=[1, 2])


def test_reconcile(left, right):
    assert rows(reconcile(left, right)) == [(4, 4, 0, True)]
    assert rows(reconcile(left, right.limit(3))) == [(4, 3, 1, False)]
    assert rows(require_reconciled(left, right)) == [(4, 4, 0, True)]
    with pytest.raises(Exception, match="row counts differ: 4 3"):
        require_reconciled(left, right.limit(3)).collect()


def test_row_counts(left, right):
    assert sorted(rows(row_counts({"l": left, "r": right}))) == [("l", 4), ("r", 4)]


def test_merge_equals_full_outer_join(spark):
    a = spark.range(0, 40).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"))
    b = spark.range(20, 60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
    merged = merge_on_key({"a": a, "b": b}, "k", "n")
    joined = a.withColumnRenamed("n", "a").join(
        b.withColumnRenamed("n", "b"), "k", "full_outer")
    assert sorted(rows(merged)) == sorted(rows(joined))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_attach_keeps_every_fact_row(spark, threshold):
    """One key with a third of the rows and a third NULL, broadcast or not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        fact = spark.range(3000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("key"))
        dimension = spark.createDataFrame([("hot", "H"), ("1", "one")],
                                          "code string, name string")
        found = attach(fact, dimension, "key", "code", {"name": "label"})
        assert found.columns == ["id", "key", "label"]
        counts = dict(rows(found.groupBy("label").count()))
        assert counts == {"H": 1000, "one": 1, None: 1999}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
