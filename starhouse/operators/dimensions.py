"""Dimension loads: declared columns, casts, and a key in business-key order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.operators.keys import assign_keys
from starhouse.schemas import FIRST_EFFECTIVE, MOST_AIRPORTS, OPEN_ENDED


def airport_dimension(airports: DataFrame) -> DataFrame:
    """Flat airports with their city, country and region."""
    flat = airports.select("airport_code", "airport_name", "city", "country", "region")
    return assign_keys(flat, ["airport_code"], "airport_key", at_most=MOST_AIRPORTS)


def aircraft_dimension(aircraft: DataFrame) -> DataFrame:
    rows = aircraft.select("aircraft_code", "model", "manufacturer", "seat_capacity")
    return assign_keys(rows, ["aircraft_code"], "aircraft_key")


def flight_dimension(flights: DataFrame) -> DataFrame:
    rows = flights.select("flight_id", "flight_number", F.col("flight_date").cast("date"))
    return assign_keys(rows, ["flight_id"], "flight_key")


def passenger_dimension(
    passengers: DataFrame, first_effective: str | None = FIRST_EFFECTIVE
) -> DataFrame:
    """The first version of every passenger, open-ended and current.

    Versions start at ``first_effective``, early enough for bookings made before
    signup; ``None`` starts them at the signup date instead.
    """
    signup = F.col("signup_date").cast("date")
    start = signup if first_effective is None else F.lit(first_effective).cast("date")
    rows = passengers.select(
        "passenger_id", "passenger_name", "home_airport_code", "frequent_flyer_tier",
        signup.alias("signup_date"),
        start.alias("effective_from"),
        F.lit(OPEN_ENDED).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return assign_keys(rows, ["passenger_id"], "passenger_key")
