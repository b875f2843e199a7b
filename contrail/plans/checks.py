"""The catalogue's queries again, in ANSI SQL over the same tables.

Written from the rules, not from the Spark code: clock text goes through a
pattern match, means through exact integer arithmetic, merges through outer
joins.
"""

from __future__ import annotations

from .. import contracts as C
from .catalogue import ODD_NUMBER, ODD_TEXTS_AS
from .samples import (AIRPORT_EXPRESSIONS, CANCELLATION_REASONS, FLIGHT_PARTS,
                      FLIGHT_EXPRESSIONS, PLANE_EXPRESSIONS, as_select)

_STRING = "varchar"


def _mean(total: str, count: str, places: int) -> str:
    """total / count rounded half up, for totals that are not negative."""
    scale = 10 ** places
    return (f"cast((2 * {scale} * cast({total} as bigint) + {count}) "
            f"// (2 * nullif({count}, 0)) as double) / {scale}")


def _whole(column: str) -> str:
    return f"cast(trunc(try_cast({column} as double)) as integer)"


def _clock(column: str) -> str:
    number = f"case when {column} = 2400 then 0 else {column} end"
    text = f"lpad(cast(cast(trunc({number}) as bigint) as varchar), 4, '0')"
    return (f"case when regexp_matches({text}, '^([01][0-9]|2[0-3])[0-5][0-9]$') "
            f"then substr({text}, 1, 2) || ':' || substr({text}, 3, 2) end")


def _silver_column(name: str) -> str:
    if name == "date":
        return "make_date(Year, Month, DayofMonth) as date"
    if name == C.YEAR_PARTITION:
        return f"Year as {name}"
    if name in C.CLOCK_COLUMNS:
        return f"{_clock(name)} as {name}"
    if name in C.FLAG_COLUMNS:
        return f"{name} <> 0 as {name}"
    if name in C.WHOLE_COLUMNS:
        return f"{_whole(name)} as {name}"
    return name


def _comma(items) -> str:
    return ",\n  ".join(items)


RAW = (f"select {_comma(as_select(FLIGHT_EXPRESSIONS, _STRING))} from (select *, "
       f"{_comma(as_select(FLIGHT_PARTS, _STRING))} from lineitem)")
SILVER = f"select {_comma(map(_silver_column, C.SILVER.names))} from raw"
RAW_PLANE = f"select {_comma(as_select(PLANE_EXPRESSIONS, _STRING))} from part"
PLANE = ("select * from raw_plane where coalesce("
         + ", ".join(f"cast({c} as varchar)" for c in list(PLANE_EXPRESSIONS)[1:])
         + ") is not null")
RAW_AIRPORT = (f"select {_comma(as_select(AIRPORT_EXPRESSIONS, _STRING))} "
               "from nation join region on n_regionkey = r_regionkey")
AIRPORT = """select Code as airport_code,
  split_part(split_part(Description, ', ', 2), ': ', 2) as airport_name,
  split_part(Description, ', ', 1) as city,
  split_part(split_part(Description, ', ', 2), ': ', 1) as country
from raw_airport"""
CARRIER = """select concat('C', cast(s_suppkey % 20 as varchar)) as Code,
  min(s_name) as Description from supplier group by 1"""
CANCELLATION = "select * from (values {}) as v(Code, Description)".format(
    ", ".join(f"('{k}', '{v}')" for k, v in CANCELLATION_REASONS.items()))


def _gold() -> str:
    measures = []
    for family, (column, clipped) in C.DELAY_FAMILIES.items():
        late = f"sum(case when {column} > 0 then {column} end)"
        count = f"sum(case when {column} > 0 then 1 else 0 end)"
        floor = f"{column} < 0 or " if clipped else ""
        measures += [
            f"cast({count} as bigint) as count_{family}_delay",
            f"cast(sum(case when {floor}{column} is null then 0 else {column} end) "
            f"as bigint) as total_{family}_delay",
            f"{_mean(late, count, 2)} as average_{family}_delay"]
    return f"""select date, count(distinct UniqueCarrier) as num_carriers,
  cast(sum(cast(Cancelled as integer)) as bigint) as total_cancelled,
  cast(sum(cast(Diverted as integer)) as bigint) as total_diverted,
  {_mean('sum(AirTime)', 'count(AirTime)', 2)} as avg_air_time,
  cast(sum(AirTime) as bigint) as total_air_time,
  {_comma(measures)},
  cast(sum(Distance) as bigint) as total_distance,
  {_mean('sum(Distance)', 'count(Distance)', 2)} as average_distance,
  count(*) as num_flights
from silver group by date"""


CALENDAR = """select dte,
  cast(year(dte) as integer) as year,
  'Q' || cast(quarter(dte) as varchar) as quarter,
  cast(month(dte) as integer) as month,
  cast(day(dte) as integer) as day,
  cast(dayofweek(dte) + 1 as integer) as dayofweek,
  cast(dayofyear(dte) as integer) as dayofyear,
  cast(weekofyear(dte) as integer) as weekofyear,
  strftime(dte, '%b') as month_short,
  strftime(dte, '%B') as month_name,
  cast(year(dte) as varchar) || '-' || strftime(dte, '%b') as month_year,
  cast(year(dte) * 100 + month(dte) as integer) as sort_month_year,
  cast(year(dte) as varchar) || '-Q' || cast(quarter(dte) as varchar) as quarter_year,
  cast(year(dte) * 100 + quarter(dte) as integer) as sort_quarter_year
from (select cast(d as date) as dte from (
  select unnest(generate_series(
    make_date(cast(year(min(date)) as int), 1, 1)::timestamp,
    make_date(cast(year(max(date)) as int), 12, 31)::timestamp,
    interval 1 day)) as d from silver))"""

# Each name with the text it stands for, in the order they build on each other.
_PARTS = {
    "raw": RAW, "silver": SILVER, "raw_plane": RAW_PLANE, "plane": PLANE,
    "raw_airport": RAW_AIRPORT, "airport": AIRPORT, "carrier": CARRIER,
    "cancellation": CANCELLATION, "gold": _gold(), "calendar": CALENDAR,
}


def _over(names: str, body: str) -> str:
    wanted = names.split()
    return "with " + ",\n".join(
        f"{name} as ({_PARTS[name]})" for name in _PARTS if name in wanted
    ) + "\n" + body


def _nulls(table: str, columns, name: str) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as {name} "
        f"from {table}" for c in columns)


def _null_compare(before: str, before_columns, after: str, after_columns) -> str:
    return f"""select coalesce(a.column_name, b.column_name) as column_name,
  a.raw, b.silver, a.raw - b.silver as var_raw_silver
from ({_nulls(before, before_columns, 'raw')}) a full join
  ({_nulls(after, after_columns, 'silver')}) b on a.column_name = b.column_name"""


def _frequent(table: str, column: str, n: int, order: str, name: str) -> str:
    return (f"select {column}, count(*) as {name} from {table} group by {column} "
            f"order by {name} {order}, {column} asc nulls first limit {n}")


def _frequent_compare(column: str, n: int, order: str, shares: bool) -> str:
    share = "".join(
        f", {_mean(name, f'(select count(*) from {name})', 4)} as {name}_share"
        for name in ("raw", "silver")) if shares else ""
    return f"""select coalesce(a.{column}, b.{column}) as {column},
  raw, silver, raw - silver as var_raw_silver{share}
from ({_frequent('raw', column, n, order, 'raw')}) a full join
  ({_frequent('silver', column, n, order, 'silver')}) b
  on a.{column} is not distinct from b.{column}"""


_LATE = "sum(case when ArrDelay > 0 then ArrDelay end)"
_LATE_COUNT = "count(case when ArrDelay > 0 then 1 end)"
_RATES = f"""count(*) as num_flights, {_LATE_COUNT} as delayed_flights,
  {_mean(_LATE_COUNT, 'count(*)', 4)} as delay_rate,
  {_mean(_LATE, _LATE_COUNT, 2)} as average_delay"""


def _delay_reasons() -> str:
    causes = " union all ".join(
        f"select '{cause}' as reason, count(case when {c} > 0 then 1 end) as delayed_flights, "
        f"cast(coalesce(sum(case when {c} > 0 then {c} end), 0) as bigint) as delay_minutes "
        "from silver" for cause, c in C.DELAY_CAUSES.items())
    return f""", causes as ({causes})
select cast(row_number() over (order by delay_minutes desc, reason) as integer)
  as rank, reason, delayed_flights, delay_minutes,
  {_mean('delay_minutes', 'delayed_flights', 2)} as average_delay,
  {_mean('delay_minutes', '(select cast(sum(delay_minutes) as bigint) from causes)', 4)} as share
from causes"""


_WEATHER_LINK = """select p_Year,
  round(corr(cast(WeatherDelay as double), cast(ArrDelay as double)), 6) as correlation,
  cast(coalesce(sum(case when WeatherDelay > 0 then WeatherDelay end), 0) as bigint)
    as weather_minutes,
  {share} as weather_share,
  count(case when WeatherDelay > 0 and ArrDelay is not null then 1 end) as weather_flights,
  {late} as late_rate
from silver group by p_Year""".format(
    share=_mean("coalesce(sum(case when WeatherDelay > 0 then WeatherDelay end), 0)",
                "cast(sum(" + " + ".join(f"greatest(coalesce({c}, 0), 0)"
                                         for c in C.DELAY_CAUSES.values())
                + ") as bigint)", 4),
    late=_mean("count(case when WeatherDelay > 0 and ArrDelay > 0 then 1 end)",
               "count(case when WeatherDelay > 0 and ArrDelay is not null then 1 end)", 4))

_BEST_TIME = f"""select period, value, {_RATES} from (
  select 'hour' as period, substr(CRSDepTime, 1, 2) as value, ArrDelay from silver
  union all select 'weekday', cast(dayofweek(date) + 1 as varchar), ArrDelay from silver
  union all select 'month', strftime(date, '%b'), ArrDelay from silver)
group by period, value"""

_ORDERS = ("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
           "cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders")
# What schema inference finds in the order file's columns.
_ORDER_TYPES = {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string",
                "o_totalprice": "double", "o_orderdate": "date",
                "o_orderpriority": "string"}

_TABLES = ("region nation customer supplier part orders lineitem events documents "
           "embeddings pages benchmark labels conversations").split()

_LANDED_TEXT = _comma(f"cast({c} as varchar) as {c}" for c in C.FLIGHT_COLUMNS)
_BRONZE_TEXT = _comma(
    ["Year as p_Year", *(f"cast({c} as varchar) as {c}" for c in C.FLIGHT_COLUMNS[1:]),
     "'flight_feed' as data_source"])


def _dictionary() -> str:
    schemas = {
        "flight_silver": C.SILVER, "daily_flights": C.GOLD, "calendar_days": C.CALENDAR,
        "airport_places": C.AIRPORT, "cancellation_silver": C.CODE_LIST,
        "carrier_names": C.CODE_LIST, "plane_register": C.PLANE}
    rows = ", ".join(
        "('{}', '{}', '{}', '{}')".format(
            table, f.name, f.dataType.simpleString(),
            C.DICTIONARY[table][f.name].replace("'", "''"))
        for table, schema in schemas.items() for f in schema)
    return (f"select * from (values {rows}) "
            "as v(table_name, col_name, data_type, comment)")


def _over_odd(body: str) -> str:
    """The cast query with its odd column: numbers by a pattern, words by a list."""
    number = "regexp_matches(odd, '^-?[0-9]+([.][0-9]+)?$')"
    whole = f"case when {number} then cast(trunc(cast(odd as double)) as integer) end"
    flag = (f"case when {number} then cast(odd as double) <> 0 when lower(odd) in "
            "('t', 'true', 'y', 'yes') then true when lower(odd) in ('f', 'false', 'n', 'no') "
            "then false end")
    return (f"with odd as (select *, {ODD_NUMBER.replace('STR', 'varchar')} as odd "
            f"from lineitem) " + body.replace("{whole}", whole).replace("{flag}", flag))


def _typed_compare() -> str:
    """Each side's 200 most frequent delays, matched as numbers."""
    def side(name: str) -> str:
        order = ("cast(cast(ArrDelay as double) as varchar)" if name == "bronze" else "ArrDelay")
        return (f"select cast(ArrDelay as integer) as d, {order} as shown, count(*) as {name} "
                f"from {'raw' if name == 'bronze' else 'silver'} group by all "
                f"order by {name} desc, shown asc nulls first limit 200")
    return f"""select cast(coalesce(a.d, b.d) as varchar) as ArrDelay, bronze, silver,
  bronze - silver as var_bronze_silver
from ({side('bronze')}) a full join ({side('silver')}) b on a.d is not distinct from b.d"""


def _arrival() -> str:
    return " union all ".join(
        f"select '{step}' as step, * from ({_nulls(rows, C.FLIGHT_COLUMNS, 'landed')})"
        for step, rows in (("before", "(select * from raw where Month <= 6)"),
                           ("after", "raw")))


def _after_refresh() -> str:
    comments = [(name, text.replace("'", "''"))
                for name, text in C.DICTIONARY["daily_flights"].items()]
    rows = ", ".join(f"('{step}', '{name}', '{text}')" for step in ("same", "replaced", "fewer")
                     for name, text in comments
                     if not (step == "fewer" and name == "num_flights"))
    return (f"select v.*, (select count(*) from gold) as num_rows "
            f"from (values {rows}) as v(step, col_name, comment)")


def _weather_model() -> str:
    """Normal equations of three terms by Cramer's rule on exact sums."""
    sums = ", ".join(
        f"sum(cast({a} as hugeint) * {b}) as {a}{b}" for a, b in (
            ("o", "o"), ("o", "w"), ("o", "d"), ("o", "y"), ("w", "w"), ("w", "d"), ("w", "y"),
            ("d", "d"), ("d", "y"), ("y", "y")))
    matrix = [["oo", "ow", "od"], ["ow", "ww", "wd"], ["od", "wd", "dd"]]
    right = ["oy", "wy", "dy"]

    def det(m):
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a}*({e}*{i}-{f}*{h}) - {b}*({d}*{i}-{f}*{g}) + {c}*({d}*{h}-{e}*{g}))"

    solved = ", ".join(
        f"{det([[right[r] if c == k else matrix[r][c] for c in range(3)] for r in range(3)])}"
        f"::double / nullif({det(matrix)}, 0)::double as b{k}" for k in range(3))
    held_error = ("(h.yy - 2 * (b0 * h.oy + b1 * h.wy + b2 * h.dy) + b0 * b0 * h.oo "
                  "+ b1 * b1 * h.ww + b2 * b2 * h.dd "
                  "+ 2 * (b0 * b1 * h.ow + b0 * b2 * h.od + b1 * b2 * h.wd))")
    mean_error = "(h.yy - 2 * m * h.oy + m * m * h.oo)"
    return f""", xy as (
  select p_Year % 4 = 3 as held, 1 as o, WeatherDelay as w, Distance as d, ArrDelay as y
  from silver where WeatherDelay is not null and Distance is not null and ArrDelay is not null
    and p_Year is not null),
s as (select held, {sums} from xy group by held),
b as (select {solved}, oy::double / oo as m, oo from s where not held)
select v.term, round(case v.place when 0 then b0 when 1 then b1 else b2 end, 6) as coefficient,
  b.oo::bigint as num_rows, h.oo::bigint as held_rows,
  round(sqrt({held_error} / h.oo), 4) as held_error,
  round(sqrt({mean_error} / h.oo), 4) as mean_error
from b, (select * from s where held) h,
  (values ('constant', 0), ('weather_minutes', 1), ('distance', 2)) as v(term, place)"""


def _reuse() -> str:
    steps = {"arrival": (1, "Month <= 6"), "second": (1, "true"),
             "replaced": (1, "Month > 6 or Year < 1996"),
             "removed": (0, "Month <= 6 and Year < 1996")}
    parts = []
    for step, (read, kept) in steps.items():
        rows = f"(select * from raw where {kept})"
        parts.append(f"select '{step}' as step, {read} as files_read, 'nulls' as report, "
                     f"column_name as item, amount from ({_nulls(rows, C.FLIGHT_COLUMNS, 'amount')})")
        parts.append(f"select '{step}', {read}, 'frequent', Origin, amount from "
                     f"({_frequent(rows, 'Origin', 10, 'desc', 'amount')})")
    return " union all ".join(parts)


def _bounded() -> str:
    columns = {"skewed": "case when FlightNum % 3 = 0 then Origin else TailNum end",
               "flat": "TailNum", "short": "UniqueCarrier"}
    return " union all ".join(
        f"select '{name}' as report, * from ("
        + _frequent(f"(select {column} as value from silver)", "value", 10, "desc", "num_rows")
        + ")" for name, column in columns.items())


def _versions() -> str:
    return """select step, version, case version when 1 then f when 2 then o else n end as num_rows,
  expired, stored, o as rolled_back_rows, n as current_rows
from (select count(*) as n, count(*) filter (where o_orderstatus = 'F') as f,
        count(*) filter (where o_orderstatus = 'O') as o from orders),
  (values ('held', 1, true, false), ('held', 2, false, true), ('held', 3, false, true),
          ('released', 1, false, false), ('released', 2, true, false),
          ('released', 3, false, true)) as v(step, version, expired, stored)"""


def _rescue() -> str:
    clocks = " union all ".join(
        f"select Year as p_Year, '{c}' as column_name, cast({c} as varchar) as text from raw "
        f"where {c} is not null and ({_clock(c)}) is null" for c in C.CLOCK_COLUMNS)
    return f"""select p_Year, column_name, text, count(*) as num_rows, true as has_file from (
  {clocks} union all
  select Year, 'TaxiIn', case FlightNum % 10 when 0 then 'NA' when 1 then '14d' else 'n/a' end
  from raw where FlightNum % 10 < 3) group by all
union all select Year, '(all)', null, count(*), true from raw group by Year"""


_FIDELITY = "select p_partkey, " + ", ".join(ODD_TEXTS_AS) + " from part"


def oracle_sql() -> dict[str, str]:
    """Query name -> SQL."""
    return {
        "silver_clean": _over("raw silver", "select * from silver"),
        "bronze_metadata": _over(
            "raw", "select Year as p_Year, * exclude (Year), "
                   "'flight_feed' as data_source from raw"),
        "hhmm_normalise": _over(
            "raw", "select " + ", ".join(C.CLOCK_COLUMNS) + ", " + ", ".join(
                f"{_clock(c)} as {c}_text" for c in C.CLOCK_COLUMNS) + " from raw"),
        "safe_casts": _over_odd("select " + ", ".join(
            f"{_whole(f'cast({c} as varchar)')} as {c}_whole, "
            f"try_cast(cast({c} as varchar) as double) <> 0 as {c}_flag"
            for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount"))
            + f", {_whole('l_returnflag')} as l_returnflag_whole, case when l_returnflag = 'N' "
            "then false end as l_returnflag_flag, {whole} as odd_whole, {flag} as odd_flag from odd"),
        "lookup_split": _over("raw_airport airport", "select * from airport"),
        "lookup_dropna": _over("raw_plane plane", "select * from plane"),
        "lookup_passthrough": "select lpad(cast(s_suppkey % 20 as varchar), 3, '0') as Code, "
                              "s_name as Description from supplier",
        "daily_gold": _over("raw silver gold", "select * from gold"),
        "date_range": _over(
            "raw silver", "select min(date) as min_date, max(date) as max_date from silver"),
        "calendar": _over("raw silver calendar", "select * from calendar"),
        "group_count": _over(
            "raw silver", "select UniqueCarrier, count(*) as num_rows from silver "
                          "group by UniqueCarrier"),
        "top_n": _over("raw silver", _frequent("silver", "TailNum", 10, "desc", "num_rows")),
        "bottom_n": _over("raw silver", _frequent("silver", "TailNum", 10, "asc", "num_rows")),
        "row_counts": " union all ".join(
            f"select '{t}' as table_name, count(*) as num_rows from {t}" for t in _TABLES),
        "null_profile": _over("raw", _nulls("raw", C.FLIGHT_COLUMNS, "raw")),
        "null_compare": _over("raw silver", _null_compare(
            "raw", C.FLIGHT_COLUMNS, "silver", C.SILVER.names)),
        "null_shares": _over("raw silver", "select *, {} as silver_share from ({})".format(
            _mean("silver", "(select count(*) from silver)", 4),
            _nulls("silver", C.SILVER.names, "silver"))),
        "lookup_null_compare": _over(
            "raw_plane plane raw_airport airport carrier cancellation", " union all ".join(
                f"select '{name}' as lookup, * from ({sql})" for name, sql in {
                    "plane": _null_compare("raw_plane", C.PLANE.names,
                                           "plane", C.PLANE.names),
                    "airport": _null_compare("raw_airport", C.CODE_LIST.names,
                                             "airport", C.AIRPORT.names),
                    "carrier": _null_compare("carrier", C.CODE_LIST.names,
                                             "carrier", C.CODE_LIST.names),
                    "cancellation": _null_compare(
                        "cancellation", C.CODE_LIST.names,
                        "cancellation", C.CODE_LIST.names)}.items())),
        "gold_nulls": _over("raw silver gold", _nulls("gold", C.GOLD.names, "gold")),
        "calendar_nulls": _over(
            "raw silver calendar", _nulls("calendar", C.CALENDAR.names, "gold")),
        "top_n_compare": _over(
            "raw silver", _frequent_compare("CancellationCode", 10, "desc", True)),
        "top_carriers": _over(
            "raw silver", _frequent_compare("UniqueCarrier", 10, "desc", False)),
        "top_origins": _over("raw silver", _frequent_compare("Origin", 10, "desc", False)),
        "top_destinations": _over(
            "raw silver", _frequent_compare("Dest", 10, "desc", False)),
        "bottom_n_compare": _over(
            "raw silver", _frequent_compare("Origin", 10, "asc", False)),
        "reconcile": "select n as landed_rows, n as stored_rows, cast(0 as bigint) as "
                     "difference, true as matches from (select count(*) as n from lineitem)",
        "delay_reasons": _over("raw silver", _delay_reasons()),
        "cancellation_reasons": _over(
            "raw silver cancellation", "select CancellationCode, count(*) as "
            "cancelled_flights, any_value(Description) as reason from silver left join "
            "cancellation on CancellationCode = Code where Cancelled "
            "group by CancellationCode"),
        "carrier_delays": _over(
            "raw silver carrier", f"select UniqueCarrier, Description as carrier, {_RATES} "
            "from silver left join carrier on UniqueCarrier = Code "
            "group by UniqueCarrier, Description"),
        "delay_trend": _over("raw silver", f"select p_Year, {_RATES} from silver group by p_Year"),
        "best_time": _over("raw silver", _BEST_TIME),
        "plane_age": _over(
            "raw silver raw_plane plane", f"select p_Year - year as age, {_RATES} "
            "from silver left join plane on silver.TailNum = plane.tailnum group by 1"),
        "route_traffic": _over(
            "raw silver raw_airport airport",
            "select p_Year, Origin, o.city as origin_city, o.country as origin_country, "
            "Dest, d.city as dest_city, d.country as dest_country, count(*) as num_flights "
            "from silver left join airport o on Origin = o.airport_code "
            "left join airport d on Dest = d.airport_code group by all"),
        "weather_link": _over("raw silver", _WEATHER_LINK),
        "star_join": _over(
            "raw silver raw_plane plane raw_airport airport carrier cancellation calendar",
            "select date, quarter_year, month_year, UniqueCarrier, c.Description as carrier, "
            "FlightNum, Origin, o.city as origin_city, Dest, d.city as dest_city, "
            "s.TailNum as TailNum, manufacturer, p.year as plane_year, CancellationCode, "
            "x.Description as cancellation_reason, ArrDelay "
            "from silver s left join calendar k on date = dte "
            "left join carrier c on UniqueCarrier = c.Code "
            "left join cancellation x on CancellationCode = x.Code "
            "left join airport o on Origin = o.airport_code "
            "left join airport d on Dest = d.airport_code "
            "left join plane p on s.TailNum = p.tailnum"),
        "top_n_compare_typed": _over("raw silver", _typed_compare()),
        "profile_after_arrival": _over("raw", _arrival()),
        "type_guard": " union all ".join(
            f"select '{t}_frame' as table_name, true as accepted, count(*) as num_rows from {t} "
            f"union all select '{t}_name', false, null" for t in ("nation", "region", "customer")),
        "gold_order": _over("raw silver gold", "select count(*) as num_days, "
                            "cast(0 as bigint) as out_of_order from gold"),
        "dictionary_after_refresh": _over("raw silver gold", _after_refresh()),
        "csv_fidelity": f"select *, 'plain' as way from ({_FIDELITY}) union all "
                        f"select *, 'landed' as way from ({_FIDELITY})",
        "land_stream_mixed": _over("raw", f"select {_LANDED_TEXT} from raw"),
        "land_bounded": "select 8::bigint as first_run_files, 4::bigint as second_run_files, "
                        "2::bigint as first_run_folders, (2 * count(*))::bigint as source_rows, "
                        "2 * count(*) as num_rows, true as as_reported from lineitem",
        "land_atomic": _over(
            "raw", "select Year as land_year, Year * 100 + Month as land_month, "
                   "count(*) as num_rows from raw group by all"),
        "land_ledger": _over(
            "raw", "select case when Year >= 1996 then 'modern' else 'classic' end as place, "
                   "count(*) as num_rows from raw group by 1 union all "
                   "select place, n from (select count(*) as n from raw), (values ('source'), "
                   "('landed'), ('bronze'), ('silver')) as v(place)"),
        "stream_stop_all": "select count(*) as num_rows, true as stopped, "
                           "false as stopped_again, false as any_active from events",
        "csv_scan": _ORDERS,
        "csv_inferred": "select cast(o_orderkey as integer) as o_orderkey, "
                        "cast(o_custkey as integer) as o_custkey, "
                        "* exclude (o_orderkey, o_custkey), " + ", ".join(
                            f"'{kind}' as {name}_type" for name, kind in _ORDER_TYPES.items())
                        + f" from ({_ORDERS})",
        "csv_recursive": f"select o_orderstatus, cast(year(o_orderdate) as integer) as "
                         "order_year, count(*) as num_rows, cast(sum(o_orderkey) as bigint) "
                         f"as key_sum, true as all_listed from ({_ORDERS}) group by 1, 2",
        "csv_sample_schema": _over("raw silver", "select * from silver"),
        "table_roundtrip": _ORDERS,
        "table_dictionary": _dictionary(),
        "land_harmonise": _over("raw", f"select {_LANDED_TEXT} from raw"),
        "land_months": _over(
            "raw", "select Year as land_year, Year * 100 + Month as land_month, "
                   "count(*) as num_rows from raw group by all"),
        "land_accounting": _over(
            "raw", "select case when Year >= 1996 then 'modern' else 'classic' end as family, "
                   "count(*) as num_rows from raw group by 1 "
                   "union all select 'all', count(*) from raw"),
        "land_stream": _over("raw", f"select {_LANDED_TEXT} from raw"),
        "stream_bronze": _over("raw", f"select {_BRONZE_TEXT} from raw"),
        "stream_silver": _over("raw silver", "select * from silver"),
        "stream_incremental": "select event_id, cast(ts as date) as day, user_id, "
                              "event_type, value from events",
        "stream_progress": "select hop, n as rows_in, true as many_steps from "
                           "(select count(*) as n from lineitem), "
                           "(values ('bronze'), ('silver')) as v(hop)",
        "weather_model": _over("raw silver", _weather_model()),
        "gold_incremental": _over("raw silver gold", "select * from gold"),
        "profile_reuse": _over("raw", _reuse()),
        "top_n_bounded": _over("raw silver", _bounded()),
        "star_join_bucketed": _over(
            "raw silver raw_plane plane",
            "select date, FlightNum, Origin, s.TailNum, manufacturer, p.year as plane_year, "
            "ArrDelay from (select * exclude (TailNum), case FlightNum % 4 when 0 then 'N1' "
            "when 1 then null else TailNum end as TailNum from silver) s "
            "left join plane p on s.TailNum = p.tailnum"),
        "table_versions": _versions(),
        "cast_rescue": _over("raw", _rescue()),
        "stream_control": "select step, outcome, 2 * n as rows_stored from "
                          "(select count(*) as n from events), (values ('both_ready', true), "
                          "('both_listed', true), ('stopped_by_name', true), "
                          "('stopped_twice', false), ('any_active', false)) as v(step, outcome)",
    }
