"""WARC Merkle fixity audit: hash trees over ordered offset ranges, compared top down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Children of a tree node.
FAN_OUT = 16
#: Records of an archive file.
FILE_RECORDS = 256


def warc_record(uri: Column, body: Column) -> Column:
    """A WARC/1.1 resource record as binary; NULL parts count as empty."""
    body = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
                    F.coalesce(uri, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def archive(pages: DataFrame) -> DataFrame:
    """(position, record): WARC records of ``pages`` at their places in the archive.

    page_id is the position, so a record that a replica lacks leaves a gap and
    shifts nothing; rows without page_id share the position NULL.
    """
    return pages.select(
        F.col("page_id").cast("long").alias("position"),
        warc_record(F.col("url"), F.col("html")).alias("record"))


def leaves(records: DataFrame) -> DataFrame:
    """(position, n_bytes, digest): a leaf for each position, of all its records.

    Records that share a position (those without one share NULL) count each: the digest
    covers their number and the sums of the four parts of their hashes, which do not
    depend on their order and add up before they are shuffled.
    """
    digest = F.sha2("record", 256)
    parts = [F.conv(F.substring(digest, 1 + 16 * k, 16), 16, 10).cast("decimal(20,0)")
             for k in range(4)]
    sums = [F.sum(f"part{k}").cast("string") for k in range(4)]
    return (records.select("position", F.octet_length("record").cast("long").alias("n_bytes"),
                           *(part.alias(f"part{k}") for k, part in enumerate(parts)))
            .groupBy("position").agg(
        F.sum("n_bytes").alias("n_bytes"),
        F.sha2(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), *sums), 256).alias("digest")))


def _parents(nodes: DataFrame, fan_out: int) -> DataFrame:
    """The level above ``nodes`` (index, n_bytes, digest): digests in order of index,
    each with its index and the bytes before it, so order and offsets are covered."""
    child = F.struct(F.pmod("index", F.lit(fan_out)).alias("slot"), "n_bytes", "digest")
    ordered = F.array_sort(F.collect_list(child))
    text = F.concat_ws("\n", F.transform(ordered, lambda x: F.concat_ws(
        " ", x["slot"].cast("string"), x["n_bytes"].cast("string"), x["digest"])))
    return (nodes.groupBy(F.floor(F.col("index") / fan_out).cast("long").alias("index"))
            .agg(F.sum("n_bytes").alias("n_bytes"), F.sha2(text, 256).alias("digest")))


def height_for(*leaf_rows: DataFrame, fan_out: int = FAN_OUT) -> int:
    """The least height at which one node covers the positions of all replicas."""
    bounds = [rows.agg(F.min("position"), F.max("position")).first() for rows in leaf_rows]
    low = min((b[0] for b in bounds if b[0] is not None), default=0)
    high = max((b[1] for b in bounds if b[1] is not None), default=0)
    height = 0
    while low != high:
        # A range across zero never meets below it: take the node of each sign as the top.
        if (low, high) == (-1, 0):
            break
        low, high, height = low // fan_out, high // fan_out, height + 1
    return height


def tree(leaf_rows: DataFrame, height: int, label: str, fan_out: int = FAN_OUT) -> DataFrame:
    """(level, index, n_bytes, digest) of the whole tree; level 0 holds the leaves.

    A node of level l covers the positions from index * fan_out**l on, so two
    replicas have nodes at the same places whatever they lack.  A node gathers at
    most ``fan_out`` children.
    """
    level = saved(leaf_rows.select(F.col("position").alias("index"), "n_bytes", "digest"),
                  f"{label}-0")
    out = level.withColumn("level", F.lit(0))
    for number in range(1, height + 1):
        level = saved(_parents(level, fan_out), f"{label}-{number}")
        out = out.union(level.withColumn("level", F.lit(number)))
    return out.select("level", "index", "n_bytes", "digest")


def audit(one: DataFrame, other: DataFrame, height: int, fan_out: int = FAN_OUT) -> DataFrame:
    """(position, n_bytes, other_bytes, damage): where two replicas' trees differ.

    Compares the roots and descends level by level into mismatching nodes alone,
    down to the records.  ``damage`` is ``missing`` or ``extra`` when only one
    replica holds the record, ``length`` or ``content`` when both do.  Both trees
    must have been built of ``height``; equal trees and two empty ones give no rows.
    Records without a position have a branch of their own, and a NULL in the result.
    """
    def at(nodes: DataFrame, level: int, names: tuple[str, str]) -> DataFrame:
        return nodes.where(F.col("level") == level).select(
            "index", F.col("n_bytes").alias(names[0]), F.col("digest").alias(names[1]))

    suspects = None
    for level in range(height, -1, -1):
        left, right = at(one, level, ("n_bytes", "da")), at(other, level, ("other_bytes", "db"))
        if suspects is not None:
            # The children of the mismatching nodes; equal branches are not read on.
            inside = suspects.select(F.explode(F.expr(
                f"coalesce(sequence(index * {fan_out}, index * {fan_out} + {fan_out - 1}), "
                "array(cast(null as bigint)))")).alias("at"))
            inside = saved(inside, f"audit-{level}")
            same = F.col("index").eqNullSafe(F.col("at"))
            left, right = (side.join(inside, same, "left_semi") for side in (left, right))
        suspects = left.join(
            right.withColumnRenamed("index", "other"),
            F.col("index").eqNullSafe(F.col("other")), "full_outer").withColumn("index", F.coalesce("index", "other")).drop("other").where(
            ~F.col("da").eqNullSafe(F.col("db")))
        if level:
            suspects = saved(suspects.select("index"), f"audit-suspects-{level}")
    damage = (F.when(F.col("db").isNull(), "missing").when(F.col("da").isNull(), "extra")
              .when(F.col("n_bytes") != F.col("other_bytes"), "length").otherwise("content"))
    return suspects.select(F.col("index").alias("position"), "n_bytes", "other_bytes",
                           damage.alias("damage"))


def located(damage: DataFrame, leaf_rows: DataFrame, file_records: int = FILE_RECORDS
            ) -> DataFrame:
    """``damage`` with the file of each record and its byte offset there.

    A file holds the records of ``file_records`` positions in order, so the
    running sum is over a bounded run.  An extra record's offset is that of the
    place where it would stand.
    """
    def file() -> Column:
        return F.floor(F.col("position") / file_records).cast("long")

    damage = damage.withColumn("file", file())
    # Bytes of the audited replica only; places that it lacks have none.
    places = leaf_rows.select("position", "n_bytes").withColumn("file", file())
    places = places.join(damage.select(F.col("file").alias("of")).distinct(),
                         F.col("file").eqNullSafe(F.col("of")), "left_semi")
    places = places.unionByName(damage.where("damage = 'extra'").select(
        "position", F.lit(0).cast("long").alias("n_bytes"), "file"))
    before = (Window.partitionBy("file").orderBy("position")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = places.select(F.col("position").alias("at"), F.coalesce(
        F.sum("n_bytes").over(before), F.lit(0)).alias("offset"))
    return damage.join(offsets, F.col("position").eqNullSafe(F.col("at"))).select(
        "position", "file", "offset", "n_bytes", "other_bytes", "damage")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """``pages`` as a failing disk would return them, for tests and the audit query.

    By page_id modulo 1009: 17 lost, 18 cut off by its last character, 19 with its
    first character replaced; the rest is whole.
    """
    spot = F.pmod(F.col("page_id"), F.lit(1009))
    html = (F.when(spot == 18, F.expr("left(html, length(html) - 1)"))
            .when(spot == 19, F.concat(F.lit("~"), F.expr("substring(html, 2)")))
            .otherwise(F.col("html")))
    return pages.where(~F.coalesce(spot == 17, F.lit(False))).withColumn("html", html)
