"""The analyst questions over the star schema.

Each question reduces the fact to its grouping keys before it meets a dimension.
The reduction combines on the map side, so a carrier, aircraft or route holding a
third of all flights is shuffled as a handful of rows, and no join ever sees the
fact row by row.  ``star_join`` is the one row-level join.
"""

from __future__ import annotations

from fractions import Fraction
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..operators.joins import attach


def _ratio(part: Column | str, whole: Column | str, places: int) -> Column:
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.round(part / F.nullif(whole, F.lit(0)), places)


def _arrival_sums() -> list[Column]:
    """Flights, flights arriving late, and their late minutes."""
    late = F.when(F.col("ArrDelay") > 0, F.col("ArrDelay"))
    return [F.count(F.lit(1)).alias("num_flights"),
            F.count(late).alias("delayed_flights"),
            F.sum(late).alias("delay_minutes")]


def _add_up() -> list[Column]:
    """The same three measures over rows that already hold them."""
    return [F.sum(name).alias(name)
            for name in ("num_flights", "delayed_flights", "delay_minutes")]


def _rates() -> list[Column]:
    return [F.col("num_flights"), F.col("delayed_flights"),
            _ratio("delayed_flights", "num_flights", 4).alias("delay_rate"),
            _ratio("delay_minutes", "delayed_flights", 2).alias("average_delay")]


def delay_reasons(silver: DataFrame) -> DataFrame:
    """What delays flights most: the causes ranked by the minutes they cost."""
    minutes = {cause: F.when(F.col(column) > 0, F.col(column))
               for cause, column in C.DELAY_CAUSES.items()}
    sums = silver.agg(
        *(F.count(late).alias(f"{cause}_flights") for cause, late in minutes.items()),
        *(F.coalesce(F.sum(late), F.lit(0)).cast("bigint").alias(f"{cause}_minutes")
          for cause, late in minutes.items()))
    every_minute = sum((F.col(f"{cause}_minutes") for cause in minutes), F.lit(0))
    # Five rows: ordering them inside one array needs no window.
    ranked = F.sort_array(F.array(*(
        F.struct((-F.col(f"{cause}_minutes")).alias("order_by"),
                 F.lit(cause).alias("reason"),
                 F.col(f"{cause}_flights").alias("delayed_flights"),
                 F.col(f"{cause}_minutes").alias("delay_minutes"))
        for cause in minutes)))
    rows = sums.select(every_minute.alias("all_minutes"),
                       F.posexplode(ranked).alias("position", "cause"))
    return rows.select(
        (F.col("position") + 1).alias("rank"), "cause.reason", "cause.delayed_flights",
        "cause.delay_minutes",
        _ratio("cause.delay_minutes", "cause.delayed_flights", 2).alias("average_delay"),
        _ratio("cause.delay_minutes", "all_minutes", 4).alias("share"))


def cancellation_reasons(silver: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Cancelled flights per reason, with the reason spelled out."""
    counts = (silver.where("Cancelled").groupBy("CancellationCode")
              .agg(F.count(F.lit(1)).alias("cancelled_flights")))
    return attach(counts, cancellations, "CancellationCode", "Code",
                  {"Description": "reason"})


def carrier_delays(silver: DataFrame, carriers: DataFrame) -> DataFrame:
    """Late arrivals per carrier, with the carrier's name."""
    sums = silver.groupBy("UniqueCarrier").agg(*_arrival_sums())
    named = attach(sums, carriers, "UniqueCarrier", "Code", {"Description": "carrier"})
    return named.select("UniqueCarrier", "carrier", *_rates())


def delay_trend(silver: DataFrame) -> DataFrame:
    """Delayed flights by year."""
    return silver.groupBy(C.YEAR_PARTITION).agg(*_arrival_sums()).select(
        C.YEAR_PARTITION, *_rates())


def best_time(silver: DataFrame, calendar: DataFrame) -> DataFrame:
    """Late arrivals by scheduled hour, by weekday and by month.

    The fact is reduced once, to (day, hour); the calendar and the three
    breakdowns work on that.
    """
    hourly = silver.groupBy(
        "date", F.substring("CRSDepTime", 1, 2).alias("hour")).agg(*_arrival_sums())
    dated = attach(hourly, calendar, "date", "dte",
                   {"dayofweek": "weekday", "month_short": "month"})
    periods = F.array(
        F.struct(F.lit("hour").alias("period"), F.col("hour").alias("value")),
        F.struct(F.lit("weekday").alias("period"),
                 F.col("weekday").cast("string").alias("value")),
        F.struct(F.lit("month").alias("period"), F.col("month").alias("value")))
    measures = ("num_flights", "delayed_flights", "delay_minutes")
    return (dated.select(F.inline(periods), *measures)
            .groupBy("period", "value").agg(*_add_up())
            .select("period", "value", *_rates()))


def plane_age(silver: DataFrame, planes: DataFrame) -> DataFrame:
    """Late arrivals by the age of the aircraft; NULL age is an unknown plane."""
    flown = silver.groupBy(C.YEAR_PARTITION, "TailNum").agg(*_arrival_sums())
    built = attach(flown, planes, "TailNum", "tailnum", {"year": "built"})
    return (built.groupBy((F.col(C.YEAR_PARTITION) - F.col("built")).alias("age"))
            .agg(*_add_up()).select("age", *_rates()))


def route_traffic(silver: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights between places, by year."""
    flown = silver.groupBy(C.YEAR_PARTITION, "Origin", "Dest").agg(
        F.count(F.lit(1)).alias("num_flights"))
    located = attach(flown, airports, "Origin", "airport_code",
                     {"city": "origin_city", "country": "origin_country"})
    located = attach(located, airports, "Dest", "airport_code",
                     {"city": "dest_city", "country": "dest_country"})
    return located.select(
        C.YEAR_PARTITION, "Origin", "origin_city", "origin_country",
        "Dest", "dest_city", "dest_country", "num_flights")


def weather_link(silver: DataFrame) -> DataFrame:
    """How far weather goes with late arrivals, by year.

    The correlation of weather minutes and arrival delay, the share of all cause
    minutes that are weather's, and how many weather-hit flights arrived late.
    """
    weather, arrival = F.col("WeatherDelay"), F.col("ArrDelay")
    hit = (weather > 0) & arrival.isNotNull()
    causes = sum((F.coalesce(F.when(F.col(c) > 0, F.col(c)), F.lit(0))
                  for c in C.DELAY_CAUSES.values()), F.lit(0))
    sums = silver.groupBy(C.YEAR_PARTITION).agg(
        F.corr(weather.cast("double"), arrival.cast("double")).alias("correlation"),
        F.coalesce(F.sum(F.when(weather > 0, weather)), F.lit(0)).cast("bigint")
        .alias("weather_minutes"),
        F.sum(causes).alias("cause_minutes"),
        F.count_if(hit).alias("weather_flights"),
        F.count_if(hit & (arrival > 0)).alias("weather_late"))
    return sums.select(
        C.YEAR_PARTITION, F.round("correlation", 6).alias("correlation"),
        "weather_minutes",
        _ratio("weather_minutes", "cause_minutes", 4).alias("weather_share"),
        "weather_flights",
        _ratio("weather_late", "weather_flights", 4).alias("late_rate"))


#: Years left out of the fit: every fourth.
HELD_OUT_YEAR = f"{C.YEAR_PARTITION} % 4 = 3"
#: What arrival delay is explained by, besides a constant.
WEATHER_TERMS = {"weather_minutes": "WeatherDelay", "distance": "Distance"}


def moments(frame: DataFrame, columns: dict[str, str], group: Column) -> DataFrame:
    """Sums of all products of two of the columns and a constant, by group: one pass, a
    row of fixed size for each group, combined before it is shuffled.

    Rows that lack one of the columns are left out.  Sums are exact.
    """
    names = ["one", *columns]
    value = {"one": F.lit(1).cast("bigint")} | {
        name: F.col(column).cast("bigint") for name, column in columns.items()}
    known = frame.dropna(subset=list(columns.values()))
    return known.groupBy(group.alias("held_out")).agg(*(
        F.sum((value[a] * value[b]).cast("decimal(38,0)")).alias(f"{a}_{b}")
        for i, a in enumerate(names) for b in names[i:]))


def weather_model(silver: DataFrame) -> DataFrame:
    """Whether weather predicts arrival delay: least squares, judged on held-out years.

    A row for each term with its coefficient (NULL where the terms depend on each
    other), the rows fitted on and held out, and the root mean square error on the
    held-out years beside that of the fitted years' mean alone.  Two rows of moments
    come to the driver, whatever the input; they are solved exactly.
    """
    terms = ["one", *WEATHER_TERMS]
    columns = WEATHER_TERMS | {"delay": "ArrDelay"}
    found = {row.held_out: row for row in moments(silver, columns, F.expr(HELD_OUT_YEAR)).collect()}
    names = ["one", *columns]

    def moment(side: bool, a: str, b: str) -> int:
        a, b = sorted((a, b), key=names.index)
        return int(found[side][f"{a}_{b}"]) if side in found else 0

    fitted = _solve([[moment(False, a, b) for b in terms] for a in terms],
                    [moment(False, a, "delay") for a in terms])
    rows, held = moment(False, "one", "one"), moment(True, "one", "one")

    def error(of: dict[str, Fraction] | None) -> float | None:
        if of is None or not held:
            return None
        squares = (moment(True, "delay", "delay")
                   - 2 * sum(c * moment(True, a, "delay") for a, c in of.items())
                   + sum(c * d * moment(True, a, b) for a, c in of.items()
                         for b, d in of.items()))
        return round(sqrt(squares / held), 4)

    mean = {"one": Fraction(moment(False, "one", "delay"), rows)} if rows else None
    model = dict(zip(terms, fitted)) if fitted else None
    report = [{"term": ("string", "constant" if a == "one" else a),
               "coefficient": ("double", round(float(model[a]), 6) if model else None),
               "num_rows": ("bigint", rows), "held_rows": ("bigint", held),
               "held_error": ("double", error(model)), "mean_error": ("double", error(mean))}
              for a in terms]
    return silver.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(*(F.lit(value).cast(kind).alias(name) for name, (kind, value) in row.items()))
        for row in report))))


def _solve(matrix: list[list[int]], right: list[int]) -> list[Fraction] | None:
    """The exact solution of a small linear system; None when there is no single one."""
    rows = [[Fraction(v) for v in (*row, r)] for row, r in zip(matrix, right)]
    size = len(rows)
    for i in range(size):
        pivot = next((k for k in range(i, size) if rows[k][i]), None)
        if pivot is None:
            return None
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for k in range(size):
            if k != i:
                rows[k] = [v - rows[k][i] * w for v, w in zip(rows[k], rows[i])]
    return [row[-1] for row in rows]


def star_join(silver: DataFrame, calendar: DataFrame, airports: DataFrame,
              planes: DataFrame, carriers: DataFrame,
              cancellations: DataFrame) -> DataFrame:
    """Every flight with the attributes of all its dimensions."""
    rows = attach(silver, calendar, "date", "dte",
                  {"quarter_year": "quarter_year", "month_year": "month_year"})
    rows = attach(rows, carriers, "UniqueCarrier", "Code", {"Description": "carrier"})
    rows = attach(rows, cancellations, "CancellationCode", "Code",
                  {"Description": "cancellation_reason"})
    rows = attach(rows, airports, "Origin", "airport_code", {"city": "origin_city"})
    rows = attach(rows, airports, "Dest", "airport_code", {"city": "dest_city"})
    return attach(rows, planes, "TailNum", "tailnum",
                  {"manufacturer": "manufacturer", "year": "plane_year"})
