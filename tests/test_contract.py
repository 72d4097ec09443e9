import os
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import airline
from airline import rows
from starhouse.operators import checks, contract
from starhouse.schemas import BOOKING_STATUSES, BOOKINGS, FARE_CLASSES, FEEDS, TABLES, LoadError
from starhouse.sources import feeds as sources
from starhouse.sources.feeds import read_raw_csv

COLUMNS = BOOKINGS.schema.names


def _violations(spark, row):
    feeds = airline.feeds(spark)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in BOOKINGS.schema])
    both = feeds.bookings.unionByName(spark.createDataFrame([row], nullable))
    found = contract.violations(both, feeds.flights, feeds.passengers)
    return {r["rule"]: r["violations"] for r in found.collect() if r["violations"]}


def _row(**changes):
    base = {**dict(zip(COLUMNS, airline.BOOKINGS[0])), "booking_id": 999, **changes}
    for money in ("fare_amount", "tax_amount"):
        if base[money] is not None:
            base[money] = Decimal(base[money])
    return tuple(base[c] for c in COLUMNS)


def test_clean_feed_has_no_violations(spark):
    feeds = airline.feeds(spark)
    found = contract.violations(feeds.bookings, feeds.flights, feeds.passengers)
    assert found.filter("violations > 0").isEmpty()


@pytest.mark.parametrize("column", COLUMNS)
def test_null_in_each_column(spark, column):
    assert _violations(spark, _row(**{column: None}))[f"null_{column}"] == 1


@pytest.mark.parametrize("changes, rule", [
    ({"fare_class": "economy"}, "fare_class_not_allowed"),
    ({"fare_class": " Economy"}, "fare_class_not_allowed"),
    ({"fare_class": "Basic"}, "fare_class_not_allowed"),
    ({"booking_status": "No Show"}, "booking_status_not_allowed"),
    ({"fare_amount": "0"}, "fare_not_positive"),
    ({"tax_amount": "-0.01"}, "tax_negative"),
    ({"miles_earned": -1}, "miles_negative"),
    ({"booking_date": date(2025, 3, 1)}, "booked_after_travel"),
    ({"travel_date": date(2025, 2, 2)}, "travel_not_flight_date"),
    ({"flight_id": 77}, "unknown_flight"),
    ({"passenger_id": 77}, "unknown_passenger"),
])
def test_each_rule(spark, changes, rule):
    assert _violations(spark, _row(**changes)) == {rule: 1}


def test_repeated_id(spark):
    feeds = airline.feeds(spark, [*airline.BOOKINGS, airline.BOOKINGS[0], airline.BOOKINGS[0]])
    found = dict(rows(contract.violations(feeds.bookings, feeds.flights, feeds.passengers)))
    assert found["repeated_booking_id"] == 2


def test_amounts_finer_than_cents(spark):
    raw = spark.createDataFrame([("10.005",), ("10.10",), ("10",), ("10.100",)], "v string")
    assert raw.filter(contract.more_than_two_decimals(F.col("v"))).count() == 1
    texts = {"1.00000000001": True, "1." + "0" * 60: False, "0.001": True, ".5": False, "1e-3": True,
             "-1.2e1": False, "1.2345e2": False, "1.23456e2": True, "12e-3": True, "x": None, "": None}
    raw = spark.createDataFrame(list(texts.items()), "v string, finer boolean")
    found = {r["v"]: r["f"] for r in raw.select("v", contract.more_than_two_decimals(F.col("v")).alias("f")).collect()}
    assert found == {v: bool(f) for v, f in texts.items()}
    exact = spark.range(1).select(F.lit("1.00000000001").cast("decimal(38,20)").alias("v"))
    assert exact.filter(contract.more_than_two_decimals(F.col("v"))).count() == 1


@pytest.mark.parametrize("column, kind, value, stops", [
    ("fare_amount", "decimal(12,3)", 10.005, True), ("fare_amount", "double", 1.999, True),
    ("fare_amount", "double", 1.5, False), ("miles_earned", "double", 5.9, True),
    ("miles_earned", "double", 6.0, False), ("fare_amount", "string", "7.10", False)])
def test_conform_never_rounds(spark, column, kind, value, stops):
    given = airline.bookings(spark).withColumn(column, F.lit(value).cast(kind))
    if stops:
        with pytest.raises((PySparkException, Py4JJavaError), match="decimals"):
            sources.conform(given, BOOKINGS).collect()
    else:
        assert {float(r[column]) for r in sources.conform(given, BOOKINGS).collect()} == {float(value)}


def test_unexpected_values_say_how_they_differ(spark):
    df = spark.createDataFrame(
        [("Economy",), ("economy",), (" First",), ("Basic",), ("Basic",), (None,)], "fare_class string")
    assert rows(contract.unexpected_values(df, "fare_class", FARE_CLASSES), "value", "kind", "row_count") == [
        (" First", "padded", 1), ("Basic", "new", 2), ("economy", "case", 1)]


def test_schema_drift():
    declared = BOOKINGS.schema
    fields = list(declared)
    assert contract.schema_drift(declared, declared) == []
    renamed = T.StructType([T.StructField("base_fare", f.dataType) if f.name == "fare_amount" else f
                            for f in fields])
    assert contract.schema_drift(declared, renamed) == [
        ("fare_amount", "missing", True), ("base_fare", "added", True)]
    retyped = T.StructType([T.StructField(f.name, T.StringType(), False) if f.name == "travel_date" else f
                            for f in fields])
    assert contract.schema_drift(declared, retyped) == [("travel_date", "retyped", True)]
    extra = T.StructType([*fields, T.StructField("booking_channel", T.StringType())])
    assert contract.schema_drift(declared, extra) == [("booking_channel", "added", False)]
    needed = T.StructType([*fields, T.StructField("currency", T.StringType(), False)])
    assert contract.schema_drift(declared, needed) == [("currency", "added", True)]


def test_delivery_times(spark):
    log = spark.createDataFrame(
        [("bookings", datetime(2025, 1, d, h, m)) for d, h, m in
         [(1, 5, 59), (2, 6, 30), (3, 8, 0), (4, 8, 1), (4, 9, 0), (7, 6, 0)]],
        "feed string, at timestamp_ntz")
    got = contract.delivery_status(log, "feed", "at")
    assert rows(got, "delivery_date", "deliveries", "status") == [
        (date(2025, 1, 1), 1, "on_time"), (date(2025, 1, 2), 1, "past_due"),
        (date(2025, 1, 3), 1, "past_due"), (date(2025, 1, 4), 2, "late"),
        (date(2025, 1, 7), 1, "on_time")]
    assert rows(contract.missed_days(log, "feed", "at"), "days_missed") == [(2,)]
    assert rows(contract.delivery_summary(log, "feed", "at")) == [
        ("late", 1, 1), ("on_time", 2, 0), ("past_due", 2, 0)]


def test_csv_feeds(spark, tmp_path):
    feeds = airline.feeds(spark)
    for name, df in feeds.by_table().items():
        df.coalesce(1).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    read = sources.read_feeds(spark, str(tmp_path))
    for name, df in read.by_table().items():
        assert rows(df) == rows(feeds.by_table()[name])
    raw = sources.read_raw_csv(spark, str(tmp_path / "bronze_bookings.csv"))
    assert rows(contract.type_violations(raw, BOOKINGS.schema).filter("bad_rows > 0")) == []
    assert rows(sources.conform(raw, BOOKINGS)) == rows(feeds.bookings)


def test_added_column_is_ignored_and_a_missing_one_refused(spark, tmp_path):
    wide, narrow = str(tmp_path / "wide.csv"), str(tmp_path / "narrow.csv")
    booked = airline.bookings(spark)
    booked.withColumn("booking_channel", F.lit("web")).write.option("header", True).csv(wide)
    booked.withColumnRenamed("fare_amount", "base_fare").write.option("header", True).csv(narrow)
    assert rows(sources.read_csv_feed(spark, wide, BOOKINGS)) == rows(booked)
    drift = contract.schema_drift(BOOKINGS.schema, sources.delivered_schema(spark, wide, BOOKINGS))
    assert drift == [("booking_channel", "added", False)]
    with pytest.raises(LoadError, match="fare_amount"):
        sources.read_csv_feed(spark, narrow, BOOKINGS)
    drift = contract.schema_drift(BOOKINGS.schema, sources.delivered_schema(spark, narrow, BOOKINGS))
    assert ("fare_amount", "missing", True) in drift


def test_parquet_feed_is_conformed(spark, tmp_path):
    path = str(tmp_path / "b.parquet")
    booked = airline.bookings(spark)
    booked.withColumn("miles_earned", F.col("miles_earned").cast("bigint")).write.parquet(path)
    read = sources.read_parquet_feed(spark, path, BOOKINGS)
    assert read.dtypes == booked.dtypes and rows(read) == rows(booked)


def test_bad_csv_value_stops_the_typed_read(spark, tmp_path):
    path = str(tmp_path / "b.csv")
    airline.bookings(spark).withColumn("travel_date", F.lit("soon")).write.option("header", True).csv(path)
    finer = str(tmp_path / "finer.csv")
    airline.bookings(spark).withColumn("tax_amount", F.lit("10.005")).write.option("header", True).csv(finer)
    with pytest.raises((PySparkException, Py4JJavaError), match="more than 2 decimals"):
        sources.read_csv_feed(spark, finer, BOOKINGS).collect()
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED|soon"):
        sources.read_csv_feed(spark, path, BOOKINGS).collect()
    raw = sources.read_raw_csv(spark, path)
    assert rows(contract.type_violations(raw, BOOKINGS.schema).filter("bad_rows > 0")) == [
        ("travel_date", 4)]


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(checks.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(checks.null_counts(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert rows(checks.dependency_violations(df, ["k"], "v")) == [(1, 2)]


def test_layers():
    layers = {}
    for t in TABLES.values():
        layers.setdefault(t.layer, []).append(t.name)
        assert t.placed_because
    assert {k: len(v) for k, v in layers.items()} == {"bronze": 6, "silver": 7, "gold": 3}
    assert len(BOOKING_STATUSES) == 3


# Drift of delivered files ---------------------------------------------------------------------


def _csv(spark, df, tmp_path, name="feed"):
    path = str(tmp_path / name)
    df.write.option("header", True).csv(path)
    return read_raw_csv(spark, path)


def test_narrowest_types(spark, tmp_path):
    text = [("1", "3000000000", "1.50", "1e3", "2025-01-31", "2025-01-31 10:00:00", "true", "x", None, "2025-02-30"),
            ("-7", "5", "2", ".5", "2025-02-01", "2025-01-31T11:00:00.5", "FALSE", "1", None, "2025-01-01"),
            (None, "6", "3", "1", "1999-12-31", "2025-01-31 12:00", "false", "2", None, "2025-01-01")]
    raw = spark.createDataFrame(text, ", ".join(f"c{i} string" for i in range(10)))
    assert [r[1] for r in rows(contract.column_types(raw), "column_name", "narrowest")] == [
        "int", "bigint", "decimal(38,10)", "double", "date", "timestamp_ntz", "boolean", "string", None, "string"]
    assert rows(contract.column_types(raw).filter("column_name IN ('c0', 'c8')"), "column_name", "n_values") == [
        ("c0", 2), ("c8", 0)]
    assert {r[1] for r in rows(contract.column_types(raw.limit(0)), "column_name", "narrowest")} == {None}


def test_retyped_columns_are_found(spark, tmp_path):
    flights = airline.feeds(spark).flights.withColumns(
        {"flight_id": F.concat(F.lit("x"), "flight_id"), "flight_date": F.lit("nodate")})
    raw = _csv(spark, flights, tmp_path)
    found = contract.retyped_columns(raw, FEEDS["bronze_flights"].schema)
    assert rows(found) == [("flight_date", "date", "string", 3, 0), ("flight_id", "int", "string", 3, 0)]
    drift = contract.delivery_drift(raw, FEEDS["bronze_flights"].schema)
    assert rows(drift) == [("retyped", "flight_date", 3, True), ("retyped", "flight_id", 3, True)]


def test_few_bad_values_are_no_other_type(spark):
    raw = spark.range(10).select(F.when(F.col("id") < 4, "bad").otherwise(F.col("id").cast("string")).alias("miles_earned"))
    assert rows(contract.delivery_drift(raw, BOOKINGS.schema).filter("finding <> 'missing'")) == [
        ("not parsed", "miles_earned", 4, True)]
    half = raw.withColumn("miles_earned", F.when(F.col("miles_earned") < "7", "2.5").otherwise(F.col("miles_earned")))
    assert [r[0] for r in rows(contract.delivery_drift(half, BOOKINGS.schema).filter("finding <> 'missing'"))] == ["retyped"]


def test_a_renamed_column_is_one_finding(spark, tmp_path):
    known = spark.range(5000).select(
        F.col("id").alias("booking_id"), (F.col("id") % 90).alias("passenger_id"),
        F.concat(F.lit("F"), F.col("id") % 300).alias("flight_number"), F.lit("web").alias("channel"))
    # the next delivery: other bookings, much the same flights; the numbers look like nothing known
    fresh = known.withColumns({"booking_id": F.col("booking_id") + 5000}).withColumnsRenamed(
        {"flight_number": "flight_no", "channel": "via"}).withColumn("note", F.concat(F.lit("n"), "booking_id"))
    raw = _csv(spark, fresh, tmp_path)
    found = {r["column_name"]: r["renamed_to"] for r in contract.renamed_columns(known, raw).collect()}
    assert found == {"flight_number": "flight_no", "channel": "via"}
    assert contract.renamed_columns(known, known).count() == 0
    assert contract.renamed_columns(known, raw.limit(0)).count() == 0
    declared = known.schema
    drift = contract.delivery_drift(raw, declared, known)
    assert rows(drift, "finding", "column_name", "breaking") == [
        ("added", "note", False), ("renamed", "channel -> via", True),
        ("renamed", "flight_number -> flight_no", True)]
    without = contract.delivery_drift(raw, declared)
    assert {r[0] for r in rows(without, "finding")} == {"missing", "added"}


def test_a_column_is_renamed_once(spark):
    known = spark.range(100).select(F.col("id").alias("a"), F.col("id").alias("b"))
    delivered = spark.range(100).select(F.col("id").alias("c"))
    assert rows(contract.renamed_columns(known, delivered), "column_name", "renamed_to") == [("a", "c")]


def test_rules_measured_while_landing(spark, root):
    broken = airline.bookings(spark, [*airline.BOOKINGS, (104, 1, 10, date(2025, 2, 2), date(2025, 1, 31),
                                                          "Basic", "-1.00", "1.00", "Confirmed", -5)])
    watched, found = contract.measured(broken)
    watched.write.parquet(root)
    feeds = airline.feeds(spark)
    landed = spark.read.parquet(root)
    one = rows(contract.violations(landed, feeds.flights, feeds.passengers, found.get))
    assert one == rows(contract.violations(landed, feeds.flights, feeds.passengers))
    assert dict(one)["fare_not_positive"] == 1 and dict(one)["booked_after_travel"] == 1
    plain, measured = (
        contract.violations(landed, feeds.flights, feeds.passengers, f)._jdf.queryExecution().toString().count("FileScan parquet")
        for f in (None, found.get))
    assert measured < plain


def test_arrivals_of_landed_files(spark, tmp_path):
    for feed, hour in (("bookings", 5), ("flights", 7), ("airports", 9)):
        folder = tmp_path / "landing" / feed
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text("a\n1\n")
        at = datetime(2026, 1, 10, hour, tzinfo=timezone.utc).timestamp()
        os.utime(folder / "part.csv", (at, at))
    log = contract.file_arrivals(spark, str(tmp_path / "landing"))
    assert rows(log, "feed", "arrived") == [
        (f, datetime(2026, 1, 10, h)) for f, h in (("airports", 9), ("bookings", 5), ("flights", 7))]
    assert rows(contract.delivery_status(log, "feed", "arrived"), "feed", "status") == [
        ("airports", "late"), ("bookings", "on_time"), ("flights", "past_due")]


ODD = ["7", "+123456789", "1234567890", "9" * 19, "9" * 28, "9" * 29, "1.5", "0.12345678901", "9" * 26 + ".5", "-.5", ".5",
       "5.", "1e3", "1e999", "12\n", "12 ", "1.5\n", " 7", "2024-02-30", "2024-02-29", "2024-02-29\n", "0000-00-00",
       "2024-02-29 10:00", "2024-02-29T25:00", "2024-02-29T10:00:01.5", "2024-02-29 10:00:01.1234567890", "TRUE", "false",
       "tru", "text", "", "-", "+", "٣", "x7", "Infinity", "NaN"]


def test_kinds_of_odd_values_are_those_of_every_pattern(spark):
    df = spark.createDataFrame([(v,) for v in [*ODD, None]], "v string")
    value = F.col("v")
    each = F.array(*[contract._is_written_as(value, k) for k in contract._WRITTEN_AS])
    bits = F.transform(F.sequence(F.lit(0), F.lit(len(contract._WRITTEN_AS) - 1)),
                       lambda i: F.getbit(contract._kinds_written(value).cast("bigint"), i) == 1)
    for text, wanted, found in df.select("v", each, bits).collect():
        assert wanted == (found if text is not None else [False] * len(wanted)), text


def test_a_delivered_file_is_judged_in_one_pass(spark):
    raw = spark.createDataFrame([("1", "2024-01-01", "x"), ("a", "b", "y"), (None, "c", None)],
                                "miles_earned string, travel_date string, fare_class string")
    found = contract.delivery_drift(raw, T.StructType([
        T.StructField("miles_earned", T.IntegerType()), T.StructField("travel_date", T.DateType()),
        T.StructField("fare_class", T.StringType())]))
    assert sorted(map(tuple, found.collect())) == [
        ("retyped", "miles_earned", 1, True), ("retyped", "travel_date", 2, True)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("miles_earned#") and "Join" not in plan


def test_amounts_are_judged_by_their_digits(spark):
    cases = {"1.23": False, "1.230": False, "1.231": True, "123e-2": False, "123e-3": True, "1.2345e2": False,
             "-0.001": True, "12": False, "": False, "x": False, "1.23\n": False, None: None}
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert {v: f for v, f in df.select("v", contract.more_than_two_decimals(F.col("v"))).collect()} == cases


def test_a_plain_amount_is_not_taken_apart(spark):
    plan = spark.sql("SELECT '1' AS v").select(contract.more_than_two_decimals(F.col("v")))._jdf.queryExecution()
    assert "{0,2}" in plan.analyzed().toString()


def test_words_are_told_before_a_cast(spark):
    df = spark.createDataFrame([(v,) for v in ODD], "v string")
    for kind in (T.IntegerType(), T.LongType(), T.DecimalType(12, 2), T.DateType(), T.DoubleType(), T.BooleanType()):
        value = F.col("v")
        wrong = df.filter(contract._readable(value, kind) != value.try_cast(kind).isNotNull())
        assert rows(wrong) == [], kind
