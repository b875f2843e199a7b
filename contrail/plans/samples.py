"""Flight tables derived from the general test tables.

The expressions mean the same in Spark SQL and in ANSI SQL engines, so that one
text serves the query and its check; ``STR`` stands for the string type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C

# What the flight expressions share, computed once per row.
FLIGHT_PARTS = {
    "scrubbed": "l_returnflag = 'R' and l_linenumber = 7",
    "rerouted": "l_returnflag = 'A' and l_linenumber = 6",
    "caused": "l_linestatus = 'F'",
    "amount": "cast(l_quantity as int)",
    "part24": "l_partkey % 24",
    "part300": "l_partkey % 300",
    "supp24": "l_suppkey % 24",
    "order60": "l_orderkey % 60",
}


def _unless_scrubbed(expression: str, kind: str = "double") -> str:
    return f"cast(case when scrubbed then null else {expression} end as {kind})"


def _cause(expression: str) -> str:
    return f"case when caused then cast({expression} as STR) end"


FLIGHT_EXPRESSIONS = {
    "Year": "cast(year(l_shipdate) as int)",
    "Month": "cast(month(l_shipdate) as int)",
    "DayofMonth": "cast(day(l_shipdate) as int)",
    "DayOfWeek": "cast(l_orderkey % 7 + 1 as int)",
    "DepTime": _unless_scrubbed(
        "case when l_partkey % 97 = 0 then 2400 when l_partkey % 89 = 0 then 2575 "
        "else part24 * 100 + order60 end"),
    "CRSDepTime": "cast(part24 * 100 + l_suppkey % 60 as int)",
    "ArrTime": _unless_scrubbed(
        "case when l_suppkey % 83 = 0 then 2400 "
        "else supp24 * 100 + order60 end"),
    "CRSArrTime": "cast(supp24 * 100 + l_partkey % 60 as int)",
    "UniqueCarrier": "concat('C', cast(l_suppkey % 20 as STR))",
    "FlightNum": "cast(l_orderkey % 9000 as int)",
    "TailNum": "concat('N', cast(l_partkey as STR))",
    "ActualElapsedTime": _unless_scrubbed("part300 + 40"),
    "CRSElapsedTime": "cast(part300 + 45 as int)",
    "AirTime": _unless_scrubbed("part300 + 30", "STR"),
    "ArrDelay": _unless_scrubbed("amount + l_partkey % 11 - 25"),
    "DepDelay": _unless_scrubbed("amount - 20"),
    "Origin": "concat('A', cast(l_suppkey % 25 as STR))",
    "Dest": "concat('A', cast(l_partkey % 25 as STR))",
    "Distance": "cast(l_suppkey * 13 % 2500 as double)",
    "TaxiIn": "cast(l_orderkey % 17 as STR)",
    "TaxiOut": "cast(l_orderkey % 29 as STR)",
    "Cancelled": "cast(scrubbed as int)",
    "CancellationCode": (
        "case when scrubbed then substr('ABCD', cast(l_orderkey % 4 as int) + 1, 1) end"),
    "Diverted": "cast(rerouted as int)",
    "CarrierDelay": _cause("l_orderkey % 7"),
    "WeatherDelay": _cause("l_partkey % 5"),
    "NASDelay": _cause("l_suppkey % 6"),
    "SecurityDelay": _cause("l_orderkey % 3"),
    "LateAircraftDelay": _cause("l_partkey % 9 - 2"),
}

_EMPTY_PLANE = "p_partkey % 7 = 0"


def _plane_field(expression: str) -> str:
    return f"case when {_EMPTY_PLANE} then null else {expression} end"


PLANE_EXPRESSIONS = {
    "tailnum": "concat('N', cast(p_partkey as STR))",
    "type": _plane_field("p_type"),
    "manufacturer": _plane_field("p_brand"),
    "issue_date": _plane_field(
        "make_date(1960 + p_size, cast(p_partkey % 12 + 1 as int), 1)"),
    "model": "case when p_partkey % 7 = 0 or p_partkey % 5 = 1 then null else p_name end",
    "status": _plane_field("case when p_partkey % 10 = 3 then 'Expired' else 'Valid' end"),
    "aircraft_type": _plane_field("'Fixed Wing'"),
    "engine_type": _plane_field("case when p_size < 25 then 'Piston' else 'Turbo-Jet' end"),
    "year": _plane_field("1960 + p_size"),
}

AIRPORT_EXPRESSIONS = {
    "Code": "concat('A', cast(n_nationkey as STR))",
    "Description": "concat(n_name, ', ', r_name, ': ', n_name, ' Field')",
}

# The four cancellation reasons.
CANCELLATION_REASONS = {
    "A": "Carrier", "B": "Weather", "C": "National Air System", "D": "Security"}


def as_select(expressions: dict[str, str], string_type: str) -> list[str]:
    """Expressions as a select list for an engine whose string type is given."""
    return [f'{text.replace("STR", string_type)} as {name}'
            for name, text in expressions.items()]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


FLIGHT_SOURCE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_returnflag", "l_linestatus", "l_shipdate")


def flight_source(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """What the flight columns are made of; in ``parts`` even partitions, by a shuffle,
    if that is given."""
    rows = table(spark, folder, "lineitem").select(*FLIGHT_SOURCE)
    return rows.repartition(parts) if parts else rows


def made_flights(source: DataFrame) -> DataFrame:
    """The 29 flight columns with their documented types, of ``flight_source``."""
    lines = source.selectExpr("*", *as_select(FLIGHT_PARTS, "string"))
    return lines.selectExpr(*as_select(FLIGHT_EXPRESSIONS, "string"))


def raw_flights(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """The 29 flight columns with their documented types; in ``parts`` even partitions
    if that is given, for which the few columns they are made of are shuffled."""
    return made_flights(flight_source(spark, folder, parts))


def bronze_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Raw flights under the bronze column names."""
    return raw_flights(spark, folder).withColumnRenamed("Year", C.YEAR_PARTITION)


def raw_planes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        *as_select(PLANE_EXPRESSIONS, "string"))


def raw_airports(spark: SparkSession, folder: str) -> DataFrame:
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    located = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    return located.selectExpr(*as_select(AIRPORT_EXPRESSIONS, "string"))


def raw_carriers(spark: SparkSession, folder: str) -> DataFrame:
    code = F.concat(F.lit("C"), (F.col("s_suppkey") % 20).cast("string"))
    return (table(spark, folder, "supplier").groupBy(code.alias("Code"))
            .agg(F.min("s_name").alias("Description")))


def raw_cancellations(spark: SparkSession) -> DataFrame:
    """The reasons as an inline table.

    Its size is known to the planner; that of a frame made from Python rows is
    not, and joining one would shuffle the fact.
    """
    rows = ", ".join(f"('{code}', '{reason}')"
                     for code, reason in CANCELLATION_REASONS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS reasons(Code, Description)")
