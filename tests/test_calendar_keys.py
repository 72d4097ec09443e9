import glob

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airline import rows
from conftest import DATA
from starhouse.functions.ranges import month_starts, range_right
from starhouse.operators import fact, keys
from starhouse.operators.calendar import calendar, calendar_covering
from starhouse.plans import catalog
from starhouse.session import scratch_path, stored

# The monthly boundaries of 2025 and 2026.
BOUNDARIES = month_starts(202502, 202612)


def test_calendar_six_years(spark):
    days = calendar(spark, "2021-01-01", "2026-12-31")
    assert days.count() == 2191
    first = days.filter("date_key = 20210101").first()
    assert (first["month_name"], first["day_name"], first["quarter"]) == ("January", "Friday", 1)


def test_week_starts_on_monday(spark):
    days = calendar(spark, "2026-01-10", "2026-01-12")
    assert rows(days, "date_key", "day_of_week", "is_weekend") == [
        (20260110, 6, True), (20260111, 7, True), (20260112, 1, False)]


def test_calendar_covers_whole_years(spark):
    dates = spark.sql("""SELECT DATE'2024-06-01' a, DATE'2025-02-03' b
                         UNION ALL SELECT DATE'2023-12-31', NULL""")
    span = calendar_covering(dates, "a", "b")
    assert span.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()[:] == (
        20230101, 20251231, 365 + 366 + 365)


def test_dim_date_reads_the_published_calendar(spark):
    days = catalog.dim_date(spark, f"{DATA}/sf0.001")
    assert days.inputFiles()
    assert days.exceptAll(calendar(spark, *catalog.CALENDAR)).isEmpty()
    assert days.count() == calendar(spark, *catalog.CALENDAR).count()


def test_boundaries_belong_to_the_right(spark):
    assert len(BOUNDARIES) == 23
    cases = {20250131: 1, 20250201: 2, 20241231: 1, 20261130: 23, 20261201: 24, 20300101: 24}
    df = spark.createDataFrame([(k,) for k in cases], "k int")
    assert {k: p for k, p in df.select("k", range_right(F.col("k"), BOUNDARIES)).collect()} == cases


@pytest.mark.parametrize("first", [1, 11])
def test_short_and_long_keys_agree(spark, first):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5000).cast("string").alias("code"), F.col("id").alias("payload"))
    short = keys.assign_keys(df, ["code"], "k", first=first, at_most=5000)
    long = keys.number_rows(df, ["code"], "k", first=first, key_type="int")
    assert short.schema["k"].dataType == long.schema["k"].dataType
    assert rows(short) == rows(long)


def test_hot_leading_value_is_spread(spark, fixed_partitions):
    df = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("hot"), F.col("id").alias("tie"))
    numbered = keys.number_rows(df, ["hot", "tie"], "k")
    assert numbered.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first()[:] == (1, 30000, 30000)
    biggest = (numbered.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0])
    assert biggest < 15000


def test_number_rows_of_nothing(spark):
    empty = spark.range(0).select(F.col("id").alias("x"))
    assert keys.number_rows(empty, ["x"], "k").count() == 0


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(-10**9, 10**9), min_size=1, max_size=60))
def test_keys_follow_the_business_key(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    numbered = keys.number_rows(df, ["v"], "k")
    assert [r["v"] for r in numbered.orderBy("k").collect()] == sorted(values)


def test_scratch_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith(shared) for p in paths)


def test_cells_give_the_keys_of_the_sort(spark, fixed_partitions):
    df = stored(spark.range(0, 20000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise((F.col("id") % 50).cast("int")).alias("day"),
        F.when(F.col("id") != 4, F.col("id") * 7919 % 20011 - 10**4).alias("n")), "days")
    cells = keys.number_cells(df, "day", "n", "k", first=5)
    assert cells.dtypes[0] == ("k", "bigint")
    assert rows(cells) == rows(keys.number_rows(df, ["day", "n"], "k", first=5))
    hot = cells.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert hot < 10000
    one = stored(spark.range(0, 3).select(F.lit(1).alias("day"), F.col("id").alias("n")), "one-day")
    assert rows(keys.number_cells(one, "day", "n", "k"), "k", "n") == [(1, 0), (2, 1), (3, 2)]
    assert keys.number_cells(one.filter("n < 0"), "day", "n", "k").count() == 0


def test_the_fact_is_keyed_without_another_copy(spark, small):
    def copies():
        return glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/starhouse/*/numbered-ticket_sales_key-*")

    before = copies()
    sales = small["fact_ticket_sales"]
    again = fact.key_ticket_sales(sales.drop("ticket_sales_key"))
    assert rows(again, *sales.columns) == rows(sales)
    assert copies() == before
    assert all(f.endswith(".zstd.parquet") for f in sales.inputFiles())


def test_cells_say_where_their_rows_travel(spark, fixed_partitions, monkeypatch):
    """No rows are sampled for the ranges, and one range after the other is filled."""
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 100)
    df = spark.range(2_000).select((F.col("id") % 40).alias("day"), F.col("id").alias("n"))
    found = keys.number_cells(df, "day", "n", "k")
    assert "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    ranges = found.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k"), F.max("k"), F.count("*"))
    held = sorted(tuple(r)[1:] for r in ranges.collect())
    assert len(held) > 10 and max(n for *_, n in held) <= 200
    assert all(a[1] + 1 == b[0] for a, b in zip(held, held[1:]))
