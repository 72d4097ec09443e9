"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.functions.dates import calendar_columns


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    return _days(spark.range(1).select(F.lit(first).cast("date").alias("first"),
                                       F.lit(last).cast("date").alias("last")))


def calendar_covering(df: DataFrame, *columns: str) -> DataFrame:
    """Whole years that cover every date in the given columns, found in one pass."""
    days = [F.col(c).cast("date") for c in columns]
    span = df.agg(
        F.min(F.array_min(F.array(*days))).alias("lo"),
        F.max(F.array_max(F.array(*days))).alias("hi"),
    )
    return _days(
        span.select(
            F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("first"),
            F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("last"),
        )
    )


def _days(span: DataFrame) -> DataFrame:
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(*calendar_columns(F.col("day")))
