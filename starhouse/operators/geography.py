"""Geography as linked tables: airport to city to country and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.operators.keys import assign_keys
from starhouse.schemas import MOST_AIRPORTS


def country_dimension(airports: DataFrame) -> DataFrame:
    rows = airports.select(F.col("country").alias("country_name"), "region").distinct()
    return assign_keys(rows, ["country_name"], "country_key", at_most=MOST_AIRPORTS)


def city_dimension(airports: DataFrame, countries: DataFrame) -> DataFrame:
    """Cities keyed by (country, name): equal names in two countries stay apart."""
    rows = (
        airports.select(F.col("city").alias("city_name"), F.col("country").alias("country_name"))
        .distinct()
        .join(countries.select("country_name", "country_key"), "country_name")
        .select("city_name", "country_key")
    )
    return assign_keys(rows, ["country_key", "city_name"], "city_key", at_most=MOST_AIRPORTS)


def link_airports(
    flat_airports: DataFrame, cities: DataFrame, countries: DataFrame
) -> DataFrame:
    """Replace the flat geography columns by ``city_key``; airport keys stay.

    An airport without a city or country keeps a NULL ``city_key`` for the
    not-null gate to find.
    """
    places = cities.join(countries.select("country_key", "country_name"), "country_key").select(
        F.col("city_name").alias("city"), F.col("country_name").alias("country"), "city_key"
    )
    return flat_airports.join(places, ["city", "country"], "left").select(
        "airport_key", "airport_code", "airport_name", "city_key"
    )


def airport_geo(airports: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Flat reporting view: one row per airport up to its region."""
    return (
        airports.join(cities, "city_key")
        .join(countries, "country_key")
        .select("airport_key", "airport_code", "airport_name", "city_name", "country_name",
                "region")
    )
