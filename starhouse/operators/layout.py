"""Reading the month-partitioned fact so that filters prune directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.functions.ranges import range_right


def travel_between(first: int, last: int) -> Column:
    """Date-key range together with the month range the directories are named by."""
    return F.col("travel_month").between(first // 100, last // 100) & F.col(
        "travel_date_key"
    ).between(first, last)


def travelled_on(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Fact rows on the given calendar rows.

    The join carries the month as well as the date, so Spark's dynamic pruning
    can drop whole month directories at run time.
    """
    keys = days.select(F.col("date_key").alias("travel_date_key"),
                       F.col("month_key").alias("travel_month"))
    return fact.join(keys, ["travel_date_key", "travel_month"])


def booking_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("bookings"), F.sum("fare_amount").cast("decimal(38,2)").alias("fare")
    )


def rows_per_partition(
    fact: DataFrame, boundaries: Sequence[int], include_empty: bool = False
) -> DataFrame:
    """Rows by range partition number.

    Rows are counted per date key first, so the boundary search runs once per
    day rather than once per row.
    """
    counts = (
        fact.groupBy("travel_date_key").agg(F.count("*").alias("n"))
        .groupBy(range_right(F.col("travel_date_key"), boundaries).alias("partition_number"))
        .agg(F.sum("n").alias("row_count"))
    )
    if not include_empty:
        return counts
    numbers = fact.sparkSession.range(1, len(boundaries) + 2).select(
        F.col("id").cast("int").alias("partition_number")
    )
    return numbers.join(counts, "partition_number", "left").fillna(0, ["row_count"])


def scan_metrics(df: DataFrame) -> list[dict[str, int]]:
    """Run the query and return files and partitions read by each file scan.

    The rows are counted where they are; one number reaches the driver.
    """
    execution = df.groupBy().count()._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    found: list[dict[str, int]] = []

    def walk(node) -> None:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            found.append({
                "files": metrics.apply("numFiles").value(),
                "partitions": metrics.apply("numPartitions").value()
                if metrics.contains("numPartitions") else 0,
            })
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(execution.executedPlan())
    return found
