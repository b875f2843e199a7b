"""Column contracts of every layer, plus the data dictionary.

Landed and bronze measures are kept as text: the files of one year may print a
minute count as ``14``, the next as ``14.00``, and a typed CSV schema would turn
the second form into NULL without a word.  Typing happens once, on the way to
silver.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names of the flight files, in file order.
# --------------------------------------------------------------------------
FLIGHT_COLUMNS = (
    "Year", "Month", "DayofMonth", "DayOfWeek",
    "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "TailNum",
    "ActualElapsedTime", "CRSElapsedTime", "AirTime",
    "ArrDelay", "DepDelay", "Origin", "Dest", "Distance",
    "TaxiIn", "TaxiOut", "Cancelled", "CancellationCode", "Diverted",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay",
)

# The newer upper-case header and the name each column has here.
MODERN_HEADER = {
    "YEAR": "Year",
    "MONTH": "Month",
    "DAY_OF_MONTH": "DayofMonth",
    "DAY_OF_WEEK": "DayOfWeek",
    "DEP_TIME": "DepTime",
    "CRS_DEP_TIME": "CRSDepTime",
    "ARR_TIME": "ArrTime",
    "CRS_ARR_TIME": "CRSArrTime",
    "OP_UNIQUE_CARRIER": "UniqueCarrier",
    "OP_CARRIER_FL_NUM": "FlightNum",
    "TAIL_NUM": "TailNum",
    "ACTUAL_ELAPSED_TIME": "ActualElapsedTime",
    "CRS_ELAPSED_TIME": "CRSElapsedTime",
    "AIR_TIME": "AirTime",
    "ARR_DELAY": "ArrDelay",
    "DEP_DELAY": "DepDelay",
    "ORIGIN": "Origin",
    "DEST": "Dest",
    "DISTANCE": "Distance",
    "TAXI_IN": "TaxiIn",
    "TAXI_OUT": "TaxiOut",
    "CANCELLED": "Cancelled",
    "CANCELLATION_CODE": "CancellationCode",
    "DIVERTED": "Diverted",
    "CARRIER_DELAY": "CarrierDelay",
    "WEATHER_DELAY": "WeatherDelay",
    "NAS_DELAY": "NASDelay",
    "SECURITY_DELAY": "SecurityDelay",
    "LATE_AIRCRAFT_DELAY": "LateAircraftDelay",
}

# How silver types each column; anything not listed stays text.
CLOCK_COLUMNS = ("DepTime", "CRSDepTime", "ArrTime", "CRSArrTime")
FLAG_COLUMNS = ("Cancelled", "Diverted")
WHOLE_COLUMNS = (
    "FlightNum", "ActualElapsedTime", "CRSElapsedTime", "AirTime", "ArrDelay",
    "DepDelay", "Distance", "TaxiIn", "TaxiOut", "CarrierDelay",
    "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)
# Parts folded into the silver ``date`` column and then dropped.
DATE_PARTS = ("p_Year", "Month", "DayofMonth")

YEAR_PARTITION = "p_Year"

# The delay families of the daily summary: measure prefix -> silver column.
# ``clipped`` families count an early flight as zero minutes; the cause
# columns are summed as they stand.
DELAY_FAMILIES = {
    "dep": ("DepDelay", True),
    "arr": ("ArrDelay", True),
    "carrier": ("CarrierDelay", False),
    "weather": ("WeatherDelay", False),
    "nas": ("NASDelay", False),
    "security": ("SecurityDelay", False),
    "aircraft": ("LateAircraftDelay", False),
}
DELAY_CAUSES = {k: c for k, (c, clipped) in DELAY_FAMILIES.items() if not clipped}


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DOUBLE, _DATE, _BOOL = T.DoubleType(), T.DateType(), T.BooleanType()

LANDED = _struct(**{name: _TEXT for name in FLIGHT_COLUMNS})

BRONZE = _struct(
    **{YEAR_PARTITION if name == "Year" else name: _INT if name == "Year" else _TEXT
       for name in FLIGHT_COLUMNS},
    data_source=_TEXT,
    ingest_time=T.TimestampType(),
    ingest_date=_DATE,
)


def _silver_type(name: str) -> T.DataType:
    if name in FLAG_COLUMNS:
        return _BOOL
    return _INT if name in WHOLE_COLUMNS else _TEXT


SILVER = _struct(
    **{YEAR_PARTITION: _INT, "date": _DATE},
    **{name: _silver_type(name) for name in FLIGHT_COLUMNS[4:]},
)


# Silver rows and rescued texts in one folder, by kind.
RESCUED = _struct(**{f.name: f.dataType for f in SILVER.fields},
                  column_name=_TEXT, text=_TEXT, source_file=_TEXT, kind=_TEXT)


def _delay_fields() -> dict[str, T.DataType]:
    fields: dict[str, T.DataType] = {}
    for family in DELAY_FAMILIES:
        fields[f"count_{family}_delay"] = _LONG
        fields[f"total_{family}_delay"] = _LONG
        fields[f"average_{family}_delay"] = _DOUBLE
    return fields


GOLD = _struct(
    date=_DATE, num_carriers=_LONG, total_cancelled=_LONG, total_diverted=_LONG,
    avg_air_time=_DOUBLE, total_air_time=_LONG, **_delay_fields(),
    total_distance=_LONG, average_distance=_DOUBLE, num_flights=_LONG,
)

CALENDAR = _struct(
    dte=_DATE, year=_INT, quarter=_TEXT, month=_INT, day=_INT, dayofweek=_INT,
    dayofyear=_INT, weekofyear=_INT, month_short=_TEXT, month_name=_TEXT,
    month_year=_TEXT, sort_month_year=_INT, quarter_year=_TEXT,
    sort_quarter_year=_INT,
)

AIRPORT = _struct(airport_code=_TEXT, airport_name=_TEXT, city=_TEXT, country=_TEXT)
CODE_LIST = _struct(Code=_TEXT, Description=_TEXT)
PLANE = _struct(
    tailnum=_TEXT, type=_TEXT, manufacturer=_TEXT, issue_date=_DATE, model=_TEXT,
    status=_TEXT, aircraft_type=_TEXT, engine_type=_TEXT, year=_INT,
)

# --------------------------------------------------------------------------
# Data dictionary: one comment per stored column.
# --------------------------------------------------------------------------
_DELAY_LABEL = {
    "dep": "departure", "arr": "arrival", "carrier": "carrier-caused",
    "weather": "weather-caused", "nas": "air-system-caused",
    "security": "security-caused", "aircraft": "late-aircraft",
}

SILVER_COMMENTS = {
    "p_Year": "Year of the flight; the table is partitioned by it",
    "date": "Day of the flight",
    "DepTime": "Departure clock time as flown, local, HH:mm",
    "CRSDepTime": "Departure clock time as scheduled, local, HH:mm",
    "ArrTime": "Arrival clock time as flown, local, HH:mm",
    "CRSArrTime": "Arrival clock time as scheduled, local, HH:mm",
    "UniqueCarrier": "Carrier code, unique over all years; joins the carrier table",
    "FlightNum": "Flight number",
    "TailNum": "Aircraft tail number; joins the plane table",
    "ActualElapsedTime": "Gate-to-gate minutes as flown",
    "CRSElapsedTime": "Gate-to-gate minutes as scheduled",
    "AirTime": "Minutes in the air",
    "ArrDelay": "Arrival minus schedule in minutes; early is negative",
    "DepDelay": "Departure minus schedule in minutes; early is negative",
    "Origin": "Code of the airport of departure",
    "Dest": "Code of the airport of arrival",
    "Distance": "Miles between the two airports",
    "TaxiIn": "Taxi minutes after landing",
    "TaxiOut": "Taxi minutes before take-off",
    "Cancelled": "True when the flight was cancelled",
    "CancellationCode": "Reason code of a cancellation; joins the cancellation table",
    "Diverted": "True when the flight was diverted",
    "CarrierDelay": "Delay minutes put down to the carrier",
    "WeatherDelay": "Delay minutes put down to weather",
    "NASDelay": "Delay minutes put down to the national air system",
    "SecurityDelay": "Delay minutes put down to security",
    "LateAircraftDelay": "Delay minutes put down to the aircraft arriving late",
}

GOLD_COMMENTS = {
    "date": "Day summarised; joins the calendar",
    "num_carriers": "Distinct carriers that day",
    "total_cancelled": "Cancelled flights",
    "total_diverted": "Diverted flights",
    "avg_air_time": "Mean minutes in the air",
    "total_air_time": "Sum of minutes in the air",
    **{
        f"{kind}_{family}_delay": text.format(label)
        for family, label in _DELAY_LABEL.items()
        for kind, text in (
            ("count", "Flights with a {} delay"),
            ("total", "Sum of {} delay minutes"),
            ("average", "Mean {} delay of delayed flights, in minutes"),
        )
    },
    "total_distance": "Sum of miles flown",
    "average_distance": "Mean miles per flight",
    "num_flights": "Flights that day",
}

CALENDAR_COMMENTS = {
    "dte": "Calendar day",
    "year": "Year number",
    "quarter": "Quarter as text, Q1 to Q4",
    "month": "Month number",
    "day": "Day of the month",
    "dayofweek": "Day of the week, Sunday is 1",
    "dayofyear": "Day of the year",
    "weekofyear": "ISO week number",
    "month_short": "Month name, three letters",
    "month_name": "Month name in full",
    "month_year": "Year and short month name, such as 1987-Oct",
    "sort_month_year": "Sort key of month_year: year * 100 + month",
    "quarter_year": "Year and quarter, such as 1987-Q4",
    "sort_quarter_year": "Sort key of quarter_year: year * 100 + quarter",
}

AIRPORT_COMMENTS = {
    "airport_code": "Airport code",
    "airport_name": "Airport name",
    "city": "City the airport serves",
    "country": "State or country of the city",
}

CANCELLATION_COMMENTS = {
    "Code": "Cancellation reason code, A to D",
    "Description": "What the reason code stands for",
}

CARRIER_COMMENTS = {
    "Code": "Unique carrier code",
    "Description": "Carrier name",
}

PLANE_COMMENTS = {
    "tailnum": "Aircraft tail number",
    "type": "Kind of owner or registration",
    "manufacturer": "Who built the aircraft",
    "issue_date": "Day the registration was issued",
    "model": "Model name",
    "status": "Registration status",
    "aircraft_type": "Kind of aircraft",
    "engine_type": "Kind of engine",
    "year": "Year built",
}

DICTIONARY = {
    "flight_silver": SILVER_COMMENTS,
    "daily_flights": GOLD_COMMENTS,
    "calendar_days": CALENDAR_COMMENTS,
    "airport_places": AIRPORT_COMMENTS,
    "cancellation_silver": CANCELLATION_COMMENTS,
    "carrier_names": CARRIER_COMMENTS,
    "plane_register": PLANE_COMMENTS,
}
