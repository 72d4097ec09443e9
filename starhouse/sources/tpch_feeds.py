"""The airline feeds as a mapping of TPC-H-like tables.

lineitem joined to orders gives bookings, part gives flights and aircraft,
customer gives passengers, nation and region give airports. Used by the tests,
the benchmark and the registered queries.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.operators.keys import number_rows
from starhouse.session import stored
from starhouse.sources.feeds import Feeds

# Day the change feed takes effect, and the id offset of brand-new passengers (beyond any
# customer key at any scale, so that no staged id repeats).
LOAD_DATE = "1998-07-01"
NEW_MEMBER_OFFSET = 900_000_000_000

_EPOCH = "1995-01-01"
_LINE_ORDER = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _airport(number: Column) -> Column:
    """A code of three characters for each of the 25 nations."""
    return F.concat(F.lit("A"), F.lpad((number % 25).cast("string"), 2, "0"))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _booking_rows(lines: DataFrame, orders: DataFrame, *extra: str) -> DataFrame:
    fare = F.col("l_extendedprice").cast("decimal(12,2)")
    line, status = F.col("l_linenumber"), F.col("o_orderstatus")
    return lines.join(
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    ).select(
        F.col("o_custkey").alias("passenger_id"),
        F.col("l_partkey").alias("flight_id"),
        F.col("o_orderdate").cast("date").alias("booking_date"),
        F.col("l_shipdate").cast("date").alias("travel_date"),
        F.when(line <= 4, "Economy").when(line == 5, "Premium Economy")
        .when(line == 6, "Business").otherwise("First").alias("fare_class"),
        fare.alias("fare_amount"),
        (fare * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)").alias("tax_amount"),
        F.when(status == "F", "Confirmed").when(status == "O", "Cancelled")
        .otherwise("NoShow").alias("booking_status"),
        F.col("l_quantity").cast("int").alias("miles_earned"),
        *extra,
    )


def numbered_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings with ``booking_id``: the rank of the line over all its columns.

    lineitem has no key and holds identical rows; the row's place in its file
    comes last in the order, so even a huge group of copies is spread over many
    range partitions. Which copy gets which id does not matter. Lines are numbered
    before their orders are joined, so that the largest join runs once.
    """
    lines = _table(spark, folder, "lineitem").select(
        *_LINE_ORDER, F.col("_metadata.row_index").alias("_row")
    )
    numbered = number_rows(lines, [*_LINE_ORDER, "_row"], "booking_id", columns=_LINE_ORDER)
    rows = _booking_rows(numbered, _table(spark, folder, "orders"), "booking_id")
    return stored(rows.select("booking_id", *(c for c in rows.columns if c != "booking_id")),
                  "bookings")


def flights(spark: SparkSession, folder: str) -> DataFrame:
    part = _table(spark, folder, "part")
    return part.select(
        F.col("p_partkey").alias("flight_id"),
        F.concat(F.lit("F"), F.col("p_partkey") % 100_000_000).alias("flight_number"),
        F.date_add(F.lit(_EPOCH).cast("date"), F.col("p_size")).alias("flight_date"),
        _airport(F.col("p_partkey")).alias("origin_airport_code"),
        _airport(F.col("p_partkey") + F.col("p_size")).alias("dest_airport_code"),
        F.col("p_brand").alias("aircraft_code"),
    )


def aircraft(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "part").groupBy(F.col("p_brand").alias("aircraft_code"))
        .agg(F.min("p_type").alias("manufacturer"), F.max("p_size").alias("seat_capacity"))
        .select("aircraft_code", F.col("aircraft_code").alias("model"), "manufacturer",
                "seat_capacity")
    )


def passengers(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").select(
        F.col("c_custkey").alias("passenger_id"),
        F.col("c_name").alias("passenger_name"),
        _airport(F.col("c_nationkey")).alias("home_airport_code"),
        F.col("c_mktsegment").alias("frequent_flyer_tier"),
        F.date_add(F.lit(_EPOCH).cast("date"), (F.col("c_custkey") % 1000).cast("int"))
        .alias("signup_date"),
    )


def airports(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _table(spark, folder, "nation"), _table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _airport(F.col("n_nationkey")).alias("airport_code"),
        F.col("n_name").alias("airport_name"),
        F.concat(F.lit("CITY_"), F.col("r_regionkey"), F.lit("_"), F.col("n_nationkey") % 10)
        .alias("city"),
        F.col("r_name").alias("country"),
        F.when(F.col("r_regionkey") < 2, "WEST").otherwise("EAST").alias("region"),
    )


def passenger_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Changed, unchanged and brand-new passengers, one staged row each."""
    known = passengers(spark, folder)
    pid = F.col("passenger_id")
    changed = known.filter((pid % 7 == 0) | (pid % 11 == 0) | (pid % 13 == 0)).select(
        "passenger_id", "passenger_name",
        F.when(pid % 11 == 0, _airport(F.substring("home_airport_code", 2, 2).cast("int") + 1))
        .otherwise(F.col("home_airport_code")).alias("home_airport_code"),
        F.when(pid % 7 == 0, F.concat("frequent_flyer_tier", F.lit("_PLUS")))
        .otherwise(F.col("frequent_flyer_tier")).alias("frequent_flyer_tier"),
    )
    new = known.filter(pid % 30 == 0).select(
        (pid + NEW_MEMBER_OFFSET).alias("passenger_id"), "passenger_name", "home_airport_code",
        "frequent_flyer_tier",
    )
    return changed.unionByName(new)


def sound_feeds(spark: SparkSession, folder: str, bookings: DataFrame) -> Feeds:
    """The same bookings under a schedule that keeps the contract.

    A part flies once on each day it is shipped, and an order placed after its shipment counts as
    booked on the day of travel.
    """
    number = F.datediff("travel_date", F.lit("1990-01-01").cast("date"))
    flight_id = (F.col("flight_id") * 100_000 + number).cast("bigint")
    flown = bookings.select("flight_id", "travel_date").distinct()
    schedule = flown.join(flights(spark, folder), "flight_id").select(
        flight_id.alias("flight_id"), "flight_number", F.col("travel_date").alias("flight_date"),
        "origin_airport_code", "dest_airport_code", "aircraft_code")
    moved = bookings.withColumns({
        "flight_id": flight_id, "booking_date": F.least("booking_date", "travel_date")})
    return replace(feeds(spark, folder, moved), flights=stored(schedule, "sound-flights"))


def feeds(spark: SparkSession, folder: str, bookings: DataFrame) -> Feeds:
    return Feeds(
        bookings=bookings,
        flights=flights(spark, folder),
        passengers=passengers(spark, folder),
        airports=airports(spark, folder),
        aircraft=aircraft(spark, folder),
    )
