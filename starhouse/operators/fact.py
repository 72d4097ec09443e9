"""The booking-grain fact: business keys in, surrogate keys out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starhouse.operators.keys import number_cells, number_rows
from starhouse.session import stored


def booking_flights(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """Every booking with its flight's columns; NULLs where the flight is unknown."""
    return bookings.join(
        flights.select("flight_id", "flight_number", F.col("flight_date").cast("date"),
                       "origin_airport_code", "dest_airport_code", "aircraft_code"),
        "flight_id", "left",
    )


def flight_keys(
    flights: DataFrame, dim_flight: DataFrame, dim_airport: DataFrame, dim_aircraft: DataFrame
) -> DataFrame:
    """flight_id with the four surrogate keys a booking takes from its flight.

    Resolving airports and aircraft here, on the flight table, leaves the far
    larger bookings with a single flight join.
    """

    def airport(role: str) -> DataFrame:
        return dim_airport.select(
            F.col("airport_code").alias(f"{role}_airport_code"),
            F.col("airport_key").alias(f"{role}_airport_key"),
        )

    return (
        flights.select("flight_id", "origin_airport_code", "dest_airport_code", "aircraft_code")
        .join(airport("origin"), "origin_airport_code")
        .join(airport("dest"), "dest_airport_code")
        .join(dim_aircraft.select("aircraft_code", "aircraft_key"), "aircraft_code")
        .join(dim_flight.select("flight_id", "flight_key"), "flight_id")
        .select("flight_id", "flight_key", "origin_airport_key", "dest_airport_key",
                "aircraft_key")
    )


def current_versions(bookings: DataFrame, dim_passenger: DataFrame) -> DataFrame:
    """Bookings with the key of the passenger's current version."""
    current = dim_passenger.filter("is_current").select("passenger_id", "passenger_key")
    return bookings.join(current, "passenger_id")


def versions_as_of(bookings: DataFrame, dim_passenger: DataFrame) -> DataFrame:
    """Bookings with the key of the version valid on the booking date.

    Versions and bookings are laid on one timeline of distinct (passenger, day)
    marks: a passenger has at most one booking mark and one version mark per
    calendar day, however many bookings or versions there are. Needs a sound
    history (``history.require_sound_history``): versions of a passenger do not
    overlap; a booking in a gap between versions finds none.
    """
    versions = dim_passenger.select("passenger_id", "passenger_key", "effective_from",
                                    "effective_to")
    marks = (
        bookings.select("passenger_id", F.col("booking_date").alias("day"))
        .distinct()
        .withColumn("booked", F.lit(True))
        .unionByName(
            versions.withColumnRenamed("effective_from", "day").withColumn("booked", F.lit(False)),
            allowMissingColumns=True,
        )
    )
    so_far = (
        Window.partitionBy("passenger_id").orderBy("day", "booked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hits = (
        marks.select(
            "passenger_id", "day", "booked",
            F.last("passenger_key", ignorenulls=True).over(so_far).alias("passenger_key"),
            F.last("effective_to", ignorenulls=True).over(so_far).alias("effective_to"),
        )
        .filter(F.col("booked") & (F.col("day") <= F.col("effective_to")))
        .select("passenger_id", F.col("day").alias("booking_date"), "passenger_key")
    )
    return bookings.join(hits, ["passenger_id", "booking_date"])


def ticket_sales(
    bookings: DataFrame,
    flight_lookup: DataFrame,
    dim_passenger: DataFrame,
    dim_date: DataFrame,
    as_of: bool = False,
) -> DataFrame:
    """Fact rows without their own key.

    ``flight_lookup`` comes from :func:`flight_keys`. ``as_of`` takes the
    passenger version valid at booking instead of the current one: use it to
    reload a fact once history exists. Bookings that miss a dimension drop out;
    the load gates in ``operators.checks`` prove that none did.
    """
    typed = bookings.withColumns({
        "booking_date": F.col("booking_date").cast("date"),
        "travel_date": F.col("travel_date").cast("date"),
    })
    lookup = versions_as_of if as_of else current_versions
    booked = dim_date.select(F.col("full_date").alias("booking_date"),
                             F.col("date_key").alias("booking_date_key"))
    travelled = dim_date.select(F.col("full_date").alias("travel_date"),
                                F.col("date_key").alias("travel_date_key"),
                                F.col("month_key").alias("travel_month"))
    return (
        lookup(typed, dim_passenger)
        .join(flight_lookup, "flight_id")
        .join(booked, "booking_date")
        .join(travelled, "travel_date")
        .select(
            "booking_date_key", "travel_date_key", "passenger_key", "flight_key",
            "origin_airport_key", "dest_airport_key", "aircraft_key",
            "booking_id", "fare_class", "booking_status",
            "fare_amount", "tax_amount", "miles_earned",
            F.lit(1).alias("booking_count"),
            "travel_month",
        )
    )


def key_ticket_sales(sales: DataFrame) -> DataFrame:
    """Add dense ``ticket_sales_key`` values in the order of travel date and booking.

    The keys depend on the rows only. Rows are range-partitioned on the travel date
    and a slice of the bookings, so a month or day that holds a third of the data is
    keyed, and in the same tasks written, by many. The joined rows are stored first:
    they are counted before they are shuffled, and the joins are not run twice.
    """
    return laid_out(number_cells(stored(sales, "ticket-sales"), "travel_date_key", "booking_id",
                                 "ticket_sales_key"))


def number_sales(rows: DataFrame, first: int = 1) -> DataFrame:
    return number_rows(rows, ["travel_date_key", "booking_id"], "ticket_sales_key", first)


def laid_out(keyed: DataFrame) -> DataFrame:
    """Rows in the order they are filed in: by month, then by key."""
    return keyed.sortWithinPartitions("travel_month", "ticket_sales_key")
