"""Declared feeds and tables: types, keys, references, allowed values, layers.

Spark's catalog does not enforce keys or checks on parquet, so the rules are
kept here as data and ``operators.checks`` / ``operators.contract`` apply them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The sentinel dates of a Type 2 version.
FIRST_EFFECTIVE = "1900-01-01"
OPEN_ENDED = "9999-12-31"

# What the bookings feed may carry, exact case, no padding.
FARE_CLASSES = ("Economy", "Premium Economy", "Business", "First")
BOOKING_STATUSES = ("Confirmed", "Cancelled", "NoShow")

# The two passenger attributes whose change opens a new version.
TRACKED = ("frequent_flyer_tier", "home_airport_code")

# Distinct codes that three letters or digits can make (see LENGTHS).
MOST_AIRPORTS = 36**3

# Revenue counts these bookings only, unless a report says otherwise.
REVENUE_STATUS = "Confirmed"


class LoadError(Exception):
    """A gate refused the load."""

    def __init__(self, message: str, code: int | None = None):
        super().__init__(message if code is None else f"[{code}] {message}")
        self.code = code


# The column types in use; reading them here keeps the declarations free of a session.
_TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "STRING": T.StringType(),
    "DATE": T.DateType(), "BOOLEAN": T.BooleanType(), "DECIMAL(12,2)": T.DecimalType(12, 2),
    "DECIMAL(38,2)": T.DecimalType(38, 2),
}
_COLUMN = re.compile(r"(\w+) (\w+(?:\(\d+,\d+\))?)( NOT NULL)?")


# Shortest and longest text a column may hold, wherever it occurs.
LENGTHS = {
    "airport_code": (3, 3), "home_airport_code": (3, 3),
    "origin_airport_code": (3, 3), "dest_airport_code": (3, 3),
    "passenger_name": (0, 100), "airport_name": (0, 100),
    "city": (0, 60), "country": (0, 60), "city_name": (0, 60), "country_name": (0, 60),
    "model": (0, 50), "manufacturer": (0, 50), "region": (0, 40),
    "frequent_flyer_tier": (0, 20), "fare_class": (0, 20), "booking_status": (0, 20),
    "month_name": (0, 12), "day_name": (0, 12), "aircraft_code": (0, 10),
    "flight_number": (0, 10),
}


@dataclass(frozen=True)
class Reference:
    """``column`` must exist as ``key`` in ``table``."""

    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Table:
    """One warehouse table and the rules it must meet."""

    name: str
    sql_name: str
    layer: str
    placed_because: str
    ddl: str
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = ()
    allowed: dict[str, tuple] = field(default_factory=dict)
    partitioned_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(name, _TYPES[kind], nullable=not required)
            for name, kind, required in _COLUMN.findall(self.ddl)
        ])

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


# The column names and types below are the interface of feeds and tables.

BOOKINGS = Table(
    "bronze_bookings", "bronze_bookings", "bronze", "booking feed as received",
    """booking_id BIGINT NOT NULL, passenger_id INT NOT NULL, flight_id INT NOT NULL,
       booking_date DATE NOT NULL, travel_date DATE NOT NULL, fare_class STRING NOT NULL,
       fare_amount DECIMAL(12,2) NOT NULL, tax_amount DECIMAL(12,2) NOT NULL,
       booking_status STRING NOT NULL, miles_earned INT NOT NULL""",
    key=("booking_id",),
    references=(
        Reference("passenger_id", "bronze_passengers", "passenger_id"),
        Reference("flight_id", "bronze_flights", "flight_id"),
    ),
    allowed={"fare_class": FARE_CLASSES, "booking_status": BOOKING_STATUSES},
)
FLIGHTS = Table(
    "bronze_flights", "bronze_flights", "bronze", "flight schedule as received",
    """flight_id INT NOT NULL, flight_number STRING NOT NULL, flight_date DATE NOT NULL,
       origin_airport_code STRING NOT NULL, dest_airport_code STRING NOT NULL,
       aircraft_code STRING NOT NULL""",
    key=("flight_id",),
)
PASSENGERS = Table(
    "bronze_passengers", "bronze_passengers", "bronze", "passenger master as received",
    """passenger_id INT NOT NULL, passenger_name STRING NOT NULL, home_airport_code STRING,
       frequent_flyer_tier STRING, signup_date DATE""",
    key=("passenger_id",),
)
AIRPORTS = Table(
    "bronze_airports", "bronze_airports", "bronze", "airport reference, still flat",
    """airport_code STRING NOT NULL, airport_name STRING NOT NULL, city STRING,
       country STRING, region STRING""",
    key=("airport_code",),
)
AIRCRAFT = Table(
    "bronze_aircraft", "bronze_aircraft", "bronze", "aircraft reference as received",
    """aircraft_code STRING NOT NULL, model STRING NOT NULL, manufacturer STRING,
       seat_capacity INT""",
    key=("aircraft_code",),
)
PASSENGER_UPDATES = Table(
    "stg_passenger_updates", "stg_passenger_updates", "bronze", "change feed not yet applied",
    """passenger_id INT NOT NULL, passenger_name STRING NOT NULL, home_airport_code STRING,
       frequent_flyer_tier STRING""",
    key=("passenger_id",),
)

DIM_DATE = Table(
    "dim_date", "DimDate", "silver", "generated calendar every fact shares",
    """date_key INT NOT NULL, full_date DATE NOT NULL, year INT NOT NULL, quarter INT NOT NULL,
       month INT NOT NULL, month_name STRING NOT NULL, day_of_month INT NOT NULL,
       day_of_week INT NOT NULL, day_name STRING NOT NULL, is_weekend BOOLEAN NOT NULL,
       month_key INT NOT NULL""",
    key=("date_key",), unique=(("full_date",),),
)
DIM_PASSENGER = Table(
    "dim_passenger", "DimPassenger", "silver", "cleaned, keyed, history kept",
    """passenger_key INT NOT NULL, passenger_id INT NOT NULL, passenger_name STRING NOT NULL,
       home_airport_code STRING, frequent_flyer_tier STRING, signup_date DATE,
       effective_from DATE NOT NULL, effective_to DATE NOT NULL, is_current BOOLEAN NOT NULL""",
    key=("passenger_key",), unique=(("passenger_id", "effective_from"),),
)
DIM_COUNTRY = Table(
    "dim_country", "DimCountry", "silver", "conformed geography, top level",
    "country_key INT NOT NULL, country_name STRING NOT NULL, region STRING",
    key=("country_key",), unique=(("country_name",),),
)
DIM_CITY = Table(
    "dim_city", "DimCity", "silver", "conformed geography, middle level",
    "city_key INT NOT NULL, city_name STRING NOT NULL, country_key INT NOT NULL",
    key=("city_key",), unique=(("city_name", "country_key"),),
    references=(Reference("country_key", "dim_country", "country_key"),),
)
DIM_AIRPORT = Table(
    "dim_airport", "DimAirport", "silver", "conformed geography, airport level",
    """airport_key INT NOT NULL, airport_code STRING NOT NULL, airport_name STRING NOT NULL,
       city_key INT NOT NULL""",
    key=("airport_key",), unique=(("airport_code",),),
    references=(Reference("city_key", "dim_city", "city_key"),),
)
DIM_AIRCRAFT = Table(
    "dim_aircraft", "DimAircraft", "silver", "conformed reference entity with a key",
    """aircraft_key INT NOT NULL, aircraft_code STRING NOT NULL, model STRING NOT NULL,
       manufacturer STRING, seat_capacity INT""",
    key=("aircraft_key",), unique=(("aircraft_code",),),
)
DIM_FLIGHT = Table(
    "dim_flight", "DimFlight", "silver", "conformed flight entity with a key",
    """flight_key INT NOT NULL, flight_id INT NOT NULL, flight_number STRING NOT NULL,
       flight_date DATE NOT NULL""",
    key=("flight_key",), unique=(("flight_id",),),
)
FACT_TICKET_SALES = Table(
    "fact_ticket_sales", "FactTicketSales", "gold", "one row per booking, ready to report on",
    """ticket_sales_key BIGINT NOT NULL, booking_date_key INT NOT NULL,
       travel_date_key INT NOT NULL, passenger_key INT NOT NULL, flight_key INT NOT NULL,
       origin_airport_key INT NOT NULL, dest_airport_key INT NOT NULL,
       aircraft_key INT NOT NULL, booking_id BIGINT NOT NULL, fare_class STRING NOT NULL,
       booking_status STRING NOT NULL, fare_amount DECIMAL(12,2) NOT NULL,
       tax_amount DECIMAL(12,2) NOT NULL, miles_earned INT NOT NULL,
       booking_count INT NOT NULL, travel_month INT NOT NULL""",
    key=("ticket_sales_key",), unique=(("booking_id",),),
    references=(
        Reference("booking_date_key", "dim_date", "date_key"),
        Reference("travel_date_key", "dim_date", "date_key"),
        Reference("passenger_key", "dim_passenger", "passenger_key"),
        Reference("flight_key", "dim_flight", "flight_key"),
        Reference("origin_airport_key", "dim_airport", "airport_key"),
        Reference("dest_airport_key", "dim_airport", "airport_key"),
        Reference("aircraft_key", "dim_aircraft", "aircraft_key"),
    ),
    allowed={"fare_class": FARE_CLASSES, "booking_status": BOOKING_STATUSES,
             "booking_count": (1,)},
    partitioned_by=("travel_month",),
)
AIRPORT_GEO = Table(
    "airport_geo", "vDimAirportGeo", "gold", "flat airport-to-region view for reports",
    """airport_key INT NOT NULL, airport_code STRING NOT NULL, airport_name STRING NOT NULL,
       city_name STRING NOT NULL, country_name STRING NOT NULL, region STRING""",
    key=("airport_key",),
)
SALES_SUMMARY = Table(
    "sales_summary", "SalesSummary", "gold", "additive totals kept per month",
    """origin_airport_key INT NOT NULL, dest_airport_key INT NOT NULL, passenger_key INT NOT NULL,
       booking_status STRING NOT NULL, fare_amount DECIMAL(38,2) NOT NULL,
       tax_amount DECIMAL(38,2) NOT NULL, miles_earned BIGINT NOT NULL,
       booking_count BIGINT NOT NULL, travel_month INT NOT NULL""",
    key=("travel_month", "origin_airport_key", "dest_airport_key", "passenger_key", "booking_status"),
    allowed={"booking_status": BOOKING_STATUSES}, partitioned_by=("travel_month",),
)

FEEDS = {t.name: t for t in (BOOKINGS, FLIGHTS, PASSENGERS, AIRPORTS, AIRCRAFT, PASSENGER_UPDATES)}
TABLES = {
    t.name: t
    for t in (*FEEDS.values(), DIM_DATE, DIM_PASSENGER, DIM_COUNTRY, DIM_CITY, DIM_AIRPORT,
              DIM_AIRCRAFT, DIM_FLIGHT, FACT_TICKET_SALES, AIRPORT_GEO, SALES_SUMMARY)
}
