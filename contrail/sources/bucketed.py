"""Tables stored in buckets of a join key, so that joining them needs no shuffle.

A hot key would make one bucket as large as itself.  Rows of hot keys, and rows without
a key, are therefore spread over salts, and the other side holds its few hot rows once
for each salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.heavy import frequent_values_bounded
from .manifest import Registry

SALT = "bucket_salt"
#: Tasks that share the writing of a bucket, by the hash of its keys.
TASKS_A_BUCKET = 8


def hot_keys(fact: DataFrame, key: str, buckets: int) -> DataFrame:
    """The values of ``key`` that alone hold more than an even share of the rows.

    There are fewer than ``buckets`` of them.
    """
    rows = fact.count()
    return frequent_values_bounded(fact.where(F.col(key).isNotNull()), key, buckets,
                                   "num_rows").where(F.col("num_rows") * buckets > rows).select(key)


def store_fact(fact: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store the fact in buckets of ``key`` as the table ``name`` at ``path``.

    The one shuffle is here.  Returns the hot keys, which ``store_dimension`` needs.
    """
    spark = fact.sparkSession
    kind = fact.select(key).schema[0].dataType.simpleString()
    hot = Registry(spark, f"{path}-hot", f"`{key}` {kind}")
    hot.add(hot_keys(fact, key, buckets))
    known = F.broadcast(hot.rows().withColumn("is_hot", F.lit(True)))  # fewer than buckets
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
    salted = fact.withColumn("_spread", spread).join(known, key, "left").withColumn(
        SALT, F.when(F.col("is_hot") | F.col(key).isNull(), F.col("_spread")).otherwise(0))
    _store(salted.drop("is_hot", "_spread"), name, path, key, buckets)
    return hot.rows()


def store_dimension(dimension: DataFrame, hot: DataFrame, name: str, path: str, key: str,
                    buckets: int) -> None:
    """Store a dimension in as many buckets of its ``key``, hot rows once for each salt."""
    known = F.broadcast(hot.toDF(key).withColumn("is_hot", F.lit(True)))
    salts = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(
        F.array(F.lit(0)))
    salted = dimension.join(known, key, "left").withColumn(SALT, F.explode(salts))
    _store(salted.drop("is_hot"), name, path, key, buckets)


def _store(frame: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    # A multiple of the buckets: the rows of a task belong to one bucket.
    (frame.repartition(buckets * TASKS_A_BUCKET, key, SALT).write.bucketBy(buckets, key, SALT)
     .sortBy(key, SALT).option("path", path).saveAsTable(name))


def join_bucketed(spark: SparkSession, fact: str, dimension: str, key: str, other_key: str,
                  columns: dict[str, str]) -> DataFrame:
    """The fact's rows with ``columns`` (name in the dimension: name in the result) of
    the stored dimension; a row without a match keeps NULLs.  Merges bucket by bucket."""
    rows = spark.table(fact)
    chosen = spark.table(dimension).select(
        F.col(other_key).alias("_key"), F.col(SALT).alias("_salt"),
        *(F.col(old).alias(new) for old, new in columns.items())).hint("merge")
    same = (F.col(key) == F.col("_key")) & (F.col(SALT) == F.col("_salt"))
    return rows.join(chosen, same, "left").drop("_key", "_salt", SALT)
