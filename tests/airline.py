"""A small airline in the declared feed schemas."""

from __future__ import annotations

import hashlib
import os
from datetime import date
from decimal import Decimal

from starhouse.schemas import FEEDS
from starhouse.sources.feeds import Feeds

CALENDAR = ("2025-01-01", "2026-12-31")
AIRPORTS = [
    ("BOM", "Bombay", "Mumbai", "India", "Asia"),
    ("DEL", "Delhi Intl", "Delhi", "India", "Asia"),
    ("LHR", "Heathrow", "London", "United Kingdom", "Europe"),
    ("YXU", "London Ont", "London", "Canada", "Americas"),
]
AIRCRAFT = [("A320", "A320-200", "Airbus", 180), ("B789", "787-9", "Boeing", None)]
FLIGHTS = [
    (10, "SH10", date(2025, 1, 31), "BOM", "DEL", "A320"),
    (11, "SH11", date(2025, 2, 1), "DEL", "LHR", "B789"),
    (12, "SH12", date(2026, 12, 1), "LHR", "YXU", "B789"),
]
PASSENGERS = [
    (1, "Ana", "BOM", "Gold", date(2024, 5, 1)),
    (2, "Ben", "DEL", "Silver", date(2025, 1, 15)),
    (3, "Caz", None, None, None),
]
BOOKINGS = [
    (100, 1, 10, date(2025, 1, 2), date(2025, 1, 31), "Economy", "100.00", "10.00", "Confirmed", 5),
    (101, 1, 10, date(2025, 1, 3), date(2025, 1, 31), "Business", "300.50", "30.00", "Cancelled", 9),
    (102, 2, 11, date(2025, 1, 4), date(2025, 2, 1), "First", "900.00", "0.00", "Confirmed", 0),
    (103, 3, 12, date(2026, 11, 30), date(2026, 12, 1), "Premium Economy", "250.25", "25.03",
     "NoShow", 7),
]


def frame(spark, name, rows):
    """The rows as a parquet feed, written once per content."""
    digest = hashlib.sha1(repr(rows).encode()).hexdigest()
    path = f"{spark.conf.get('spark.checkpoint.dir')}/frames/{name}-{digest}"
    if not os.path.exists(path):
        spark.createDataFrame(rows, FEEDS[name].schema).coalesce(1).write.parquet(path)
    return spark.read.schema(FEEDS[name].schema).parquet(path)


def bookings(spark, rows=BOOKINGS):
    return frame(spark, "bronze_bookings",
                 [(*r[:6], Decimal(r[6]), Decimal(r[7]), *r[8:]) for r in rows])


def feeds(spark, booking_rows=BOOKINGS, **other):
    rows = {"flights": FLIGHTS, "passengers": PASSENGERS, "airports": AIRPORTS,
            "aircraft": AIRCRAFT, **other}
    return Feeds(bookings(spark, booking_rows),
                 **{n: frame(spark, f"bronze_{n}", r) for n, r in rows.items()})


def updates(spark, rows):
    return frame(spark, "stg_passenger_updates", rows)


def rows(df, *columns):
    """Sorted plain tuples of the given columns (all by default)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
