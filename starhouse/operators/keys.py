"""Surrogate keys: dense integers in business-key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.session import COMPRESSION, scratch_path, stored

# A caller's bound up to which one sort is cheaper than a distributed one; the keys are the same.
SINGLE_TASK_ROWS = 100_000

# Slices of the last key column in :func:`number_cells`: a hot day is keyed by as many tasks at most.
SLICES = 64
# Rows of a range of cells, which one task ranks and files, and the number of ranges of a short table.
ROWS_PER_RANGE, LEAST_RANGES = 250_000, 8

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low bits


def assign_keys(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    first: int | Column = 1,
    key_type: str = "int",
    at_most: int | None = None,
) -> DataFrame:
    """Prepend ``key``: first, first + 1, ... in the order of a unique business key.

    Rows are numbered by :func:`number_rows`, which never brings them together,
    unless the caller knows an upper bound on their number (``at_most``) that is
    small enough for one window.
    """
    if at_most is None or at_most > SINGLE_TASK_ROWS:
        return number_rows(df, order_by, key, first, key_type)
    rank = F.row_number().over(Window.orderBy(*order_by))
    return df.select((rank + (first - 1)).cast(key_type).alias(key), *df.columns)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    first: int | Column = 1,
    key_type: str = "bigint",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Distributed dense row numbers over a total order.

    The rows are range-partitioned on the whole order (so a hot leading value
    is spread over many partitions), sorted, and written once with their
    position in the partition. The row count of each written partition then
    gives its offset. Writing pins the sampled range bounds: a lost executor
    cannot change a key that was handed out. Only the counts, one number per
    write task, reach the driver.
    """
    spark = df.sparkSession
    columns = list(columns or df.columns)
    path = scratch_path(spark, f"numbered-{key}")
    (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .select(*columns, F.monotonically_increasing_id().alias("_slot"))
        .write.parquet(path, compression=COMPRESSION)
    )
    rows = spark.read.parquet(path)
    part = F.shiftright("_slot", _POSITION_BITS).cast("int")
    position = F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1)
    sizes = {
        r["part"]: r["n"]
        for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    }
    offsets, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        offsets.append(total)
        total += sizes.get(p, 0)
    # A foldable text literal becomes one constant array with O(1) lookup.
    start = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    return rows.select((start[part] + position + first).cast(key_type).alias(key), *columns)


def number_cells(df: DataFrame, day: str, number: str, key: str, first: int = 1) -> DataFrame:
    """Dense row numbers in the order of ``day`` and the numeric ``number``, in one shuffle.

    For rows that can be read again (``session.stored``) and have few values of ``day``. Rows are
    counted per cell, a day and a slice of ``number``; the cells in order give where each begins, and
    rows are ranked inside their cell only. Where a cell begins also gives the range it travels to, so
    no rows are sampled. A cell is never split by the ranges, so neither they nor the slices' approximate
    bounds can change a key. The cells, days times ``SLICES`` at most, meet in one task.
    """
    shares = [i / SLICES for i in range(1, SLICES)]
    bounds = df.agg(F.percentile_approx(number, shares).alias("b")).first()["b"] or []
    cut = F.when(F.col(number).isNull(), 0).otherwise(_slice(F.col(number), sorted(set(bounds)), 0))
    cells = df.groupBy(F.col(day).alias("_day"), cut.alias("_cut")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_day", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(cells.select("_day", "_cut", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")),
                    f"cells-{key}")
    total = starts.agg(F.sum("_n").alias("n")).first()["n"] or 1
    ranges = max(-(-total // ROWS_PER_RANGE), LEAST_RANGES)
    size = -(-total // ranges)
    starts = starts.select("_day", "_cut", "_start", F.floor(F.col("_start") / size).cast("int").alias("_range"))
    rows = df.withColumn("_cut", cut).join(
        starts.withColumnRenamed("_cut", "_slice"),
        F.col(day).eqNullSafe(F.col("_day")) & (F.col("_cut") == F.col("_slice"))).select("_range", "_start", *df.columns)
    place = F.row_number().over(Window.partitionBy("_range", "_start").orderBy(day, number))
    return rows.repartitionById(ranges, F.col("_range")).select(
        (F.col("_start") + place + (first - 1)).cast("bigint").alias(key), *df.columns)


def _slice(value: Column, bounds: Sequence[int], first: int) -> Column:
    """Number of the slice between sorted bounds, by halving; a bound belongs to the slice on its right."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(value < bounds[middle], _slice(value, bounds[:middle], first)).otherwise(
        _slice(value, bounds[middle + 1:], first + middle + 1))
