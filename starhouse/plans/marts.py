"""Revenue reports on the published star.

Fact rows are aggregated on surrogate keys first wherever the grouping allows,
so geography is joined to the short result instead of to the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.schemas import REVENUE_STATUS


def confirmed(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("booking_status") == REVENUE_STATUS)


def _fare() -> Column:
    return F.sum("fare_amount").cast("decimal(38,2)")


def _end(geo: DataFrame, role: str, *columns: str) -> DataFrame:
    """One end of a route, its columns prefixed by the role."""
    return geo.select(
        F.col("airport_key").alias(f"{role}_airport_key"),
        *[F.col(c).alias(f"{role}_{c}") for c in columns],
    )


def revenue_by_route_month_tier(
    fact: DataFrame, dim_passenger: DataFrame, geo: DataFrame
) -> DataFrame:
    """Confirmed revenue by country pair, travel month and the tier held when booked.

    The only fact-sized join is the passenger version; countries are attached to
    (airport pair, month, tier) totals.
    """
    by_airports = (
        confirmed(fact)
        .select("passenger_key", "origin_airport_key", "dest_airport_key", "travel_month",
                "fare_amount", "booking_count")
        .join(dim_passenger.select("passenger_key", "frequent_flyer_tier"), "passenger_key")
        .groupBy("origin_airport_key", "dest_airport_key", "travel_month", "frequent_flyer_tier")
        .agg(F.sum("fare_amount").alias("fare"), F.sum("booking_count").alias("n"))
    )
    return (
        by_airports
        .join(_end(geo, "origin", "country_name"), "origin_airport_key")
        .join(_end(geo, "dest", "country_name"), "dest_airport_key")
        .groupBy(F.col("origin_country_name").alias("origin_country"),
                 F.col("dest_country_name").alias("dest_country"),
                 "travel_month", "frequent_flyer_tier")
        .agg(F.sum("fare").cast("decimal(38,2)").alias("revenue"),
             F.sum("n").alias("bookings"))
    )


def sales_summary(fact: DataFrame) -> DataFrame:
    """Additive totals per travel month, route, passenger version and booking status.

    Month totals do not depend on other months, so a month that is reloaded is added up anew alone.
    The reports above read it in place of the fact: it has the columns they add up. Hardly two
    bookings share a group, so rows travel once, as they are, to the range in which their total is
    filed; a task that added them up first would hold nearly all it reads.
    """
    return (
        fact.select("origin_airport_key", "dest_airport_key", "passenger_key", "booking_status",
                    "travel_month", "fare_amount", "tax_amount", "miles_earned", "booking_count")
        .repartitionByRange("travel_month", "passenger_key", "origin_airport_key", "dest_airport_key",
                            "booking_status")
        .groupBy("origin_airport_key", "dest_airport_key", "passenger_key", "booking_status",
                 "travel_month")
        .agg(F.sum("fare_amount").cast("decimal(38,2)").alias("fare_amount"),
             F.sum("tax_amount").cast("decimal(38,2)").alias("tax_amount"),
             F.sum(F.col("miles_earned").cast("bigint")).alias("miles_earned"),
             F.sum("booking_count").cast("bigint").alias("booking_count"))
    )


def revenue_by_airport_route(fact: DataFrame, geo: DataFrame) -> DataFrame:
    """Confirmed revenue by origin and destination airport and travel month."""
    return (
        confirmed(fact)
        .groupBy("origin_airport_key", "dest_airport_key", "travel_month")
        .agg(_fare().alias("revenue"), F.sum("booking_count").alias("bookings"))
        .join(_end(geo, "origin", "airport_code"), "origin_airport_key")
        .join(_end(geo, "dest", "airport_code"), "dest_airport_key")
        .select("origin_airport_code", "dest_airport_code", "travel_month", "revenue", "bookings")
    )


def tax_share_by_class(fact: DataFrame) -> DataFrame:
    """Tax as a share of fare, from the sums: ratios do not add up."""
    return (
        confirmed(fact).groupBy("fare_class")
        .agg(_fare().alias("fare"), F.sum("tax_amount").cast("decimal(38,2)").alias("tax"))
        .withColumn("tax_share", F.col("tax").cast("double") / F.col("fare").cast("double"))
    )


def average_fare_by_class(fact: DataFrame) -> DataFrame:
    return (
        confirmed(fact).groupBy("fare_class")
        .agg(_fare().alias("fare"), F.sum("booking_count").alias("bookings"))
        .withColumn("average_fare", F.col("fare").cast("double") / F.col("bookings"))
    )


def revenue_as_was_as_is(fact: DataFrame, dim_passenger: DataFrame) -> DataFrame:
    """Confirmed revenue by the tier of the booked version and the tier held today.

    Both tiers are paired on the dimension, so the fact is joined once.
    """
    today = dim_passenger.filter("is_current").select(
        "passenger_id", F.col("frequent_flyer_tier").alias("tier_as_is")
    )
    tiers = dim_passenger.join(today, "passenger_id").select(
        "passenger_key", F.col("frequent_flyer_tier").alias("tier_as_was"), "tier_as_is"
    )
    return (
        confirmed(fact).select("passenger_key", "fare_amount", "booking_count")
        .join(tiers, "passenger_key")
        .groupBy("tier_as_was", "tier_as_is")
        .agg(_fare().alias("revenue"), F.sum("booking_count").alias("bookings"))
    )
