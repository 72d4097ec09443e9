from datetime import date

import pytest
from pyspark.sql import functions as F

import airline
from airline import rows
from starhouse.operators import checks, fact, layout
from conftest import DATA
from starhouse.plans import catalog, marts, warehouse
from starhouse.plans.warehouse import Gates, Warehouse
from starhouse.schemas import TABLES, LoadError


def test_load_publishes_every_table(small):
    w = small
    assert w.version == 1
    assert {n: w[n].count() for n in w.names()} == {
        "dim_date": 730, "dim_airport": 4, "dim_city": 4, "dim_country": 3, "dim_aircraft": 2,
        "dim_flight": 3, "dim_passenger": 3, "fact_ticket_sales": 4, "airport_geo": 4,
        "bronze_bookings": 4, "bronze_flights": 3, "bronze_passengers": 3, "bronze_airports": 4,
        "bronze_aircraft": 2}
    for name in w.names():
        declared = TABLES[name].schema
        assert sorted(w[name].dtypes) == sorted((f.name, f.dataType.simpleString()) for f in declared)


def test_keys_restart_on_full_refresh(spark, small, small_root):
    again = warehouse.load(spark, airline.feeds(spark), small_root, airline.CALENDAR)
    assert again.version == 2
    for name in small.names():
        assert rows(small[name]) == rows(again[name]), name
    assert rows(again["fact_ticket_sales"], "ticket_sales_key") == [(1,), (2,), (3,), (4,)]
    old = Warehouse(spark, small_root, version=1)
    assert old["dim_date"].count() == 730


def test_same_city_name_in_two_countries(small):
    w = small
    london = w["airport_geo"].filter("city_name = 'London'")
    assert rows(london, "airport_code", "country_name", "region") == [
        ("LHR", "United Kingdom", "Europe"), ("YXU", "Canada", "Americas")]
    assert w["dim_city"].filter("city_name = 'London'").select("city_key").distinct().count() == 2


@pytest.mark.parametrize("airports, message", [
    ([*airline.AIRPORTS, ("GOI", "Goa", "Goa", "India", "Elsewhere")], "two regions"),
    ([*airline.AIRPORTS, ("GOI", "Goa", None, "India", "Asia")], "without a city"),
])
def test_geography_gates(spark, root, airports, message):
    with pytest.raises(LoadError, match=message):
        warehouse.load(spark, airline.feeds(spark, airports=airports), root, airline.CALENDAR)
    assert Warehouse(spark, root).version == 0


def _booking(**changes):
    base = dict(zip(
        ["booking_id", "passenger_id", "flight_id", "booking_date", "travel_date", "fare_class",
         "fare_amount", "tax_amount", "booking_status", "miles_earned"], airline.BOOKINGS[0]))
    return tuple({**base, "booking_id": 999, **changes}.values())


@pytest.mark.parametrize("defect", [
    {"passenger_id": 77}, {"flight_id": 77},
])
def test_orphans_are_refused(spark, root, defect):
    feeds = airline.feeds(spark, [*airline.BOOKINGS, _booking(**defect)])
    with pytest.raises(LoadError, match="contract"):
        warehouse.load(spark, feeds, root, airline.CALENDAR)
    with pytest.raises(LoadError) as refused:
        warehouse.load(spark, feeds, root, airline.CALENDAR, Gates(contract=False))
    assert refused.value.code == checks.COUNT_MISMATCH
    assert Warehouse(spark, root).version == 0


def test_unknown_airport_and_aircraft_are_refused(spark, root):
    flights = [(13, "SH13", date(2025, 1, 31), "BOM", "XXX", "A320"),
               (14, "SH14", date(2025, 1, 31), "BOM", "DEL", "Z999")]
    feeds = airline.feeds(
        spark, [*airline.BOOKINGS, _booking(flight_id=13), _booking(booking_id=998, flight_id=14)],
        flights=[*airline.FLIGHTS, *flights])
    with pytest.raises(LoadError) as refused:
        warehouse.load(spark, feeds, root, airline.CALENDAR)
    assert refused.value.code == checks.COUNT_MISMATCH
    ungated = warehouse.load(spark, feeds, root, airline.CALENDAR, Gates(load=False))
    lost = checks.not_loaded(feeds.bookings, ungated["fact_ticket_sales"])
    assert rows(lost) == [(998,), (999,)]


def test_repeated_flight_fans_out(spark, root):
    flights = [*airline.FLIGHTS, airline.FLIGHTS[0]]
    feeds = airline.feeds(spark, flights=flights)
    assert checks.fan_out(feeds.bookings, feeds.flights).first()[:] == (4, 6, 0)
    with pytest.raises(LoadError):
        warehouse.load(spark, feeds, root, airline.CALENDAR, Gates(contract=False))


def test_resolution_gate_and_rule_gates(small):
    tables = {n: small[n] for n in small.names()}
    checks.require_resolved(tables["fact_ticket_sales"], tables)
    tables["dim_aircraft"] = tables["dim_aircraft"].filter("aircraft_code <> 'A320'")
    with pytest.raises(LoadError) as refused:
        checks.require_resolved(tables["fact_ticket_sales"], tables)
    assert refused.value.code == checks.UNRESOLVED_ROWS
    with pytest.raises(LoadError, match="aircraft_key in dim_aircraft"):
        checks.require_table_rules(TABLES["fact_ticket_sales"], tables["fact_ticket_sales"], tables)
    bad = tables["dim_city"].withColumn("city_key", F.lit(1))
    with pytest.raises(LoadError, match="unique city_key"):
        checks.require_table_rules(TABLES["dim_city"], bad)
    bad = tables["fact_ticket_sales"].withColumn("booking_count", F.lit(2))
    with pytest.raises(LoadError, match="allowed values"):
        checks.require_table_rules(TABLES["fact_ticket_sales"], bad)
    bad = tables["dim_airport"].withColumn("city_key", F.lit(None).cast("int"))
    with pytest.raises(LoadError, match="not null"):
        checks.require_table_rules(TABLES["dim_airport"], bad)
    for code in ("LO", "LOND"):
        bad = tables["dim_airport"].withColumn("airport_code", F.lit(code))
        with pytest.raises(LoadError, match="length"):
            checks.require_table_rules(TABLES["dim_airport"], bad)


def test_hot_month_is_split_and_keys_do_not_depend_on_it(spark, root, fixed_partitions):
    booked = airline.bookings(spark)
    many = (
        spark.range(1, 3001).crossJoin(booked.filter("booking_id = 100").drop("booking_id"))
        .withColumn("booking_id", F.col("id").cast("int")).drop("id")
        .withColumn("travel_date", F.when(F.col("booking_id") % 3 == 0, F.lit(date(2025, 2, 1)))
                    .otherwise(F.col("travel_date")))
    )
    feeds = airline.feeds(spark)
    feeds = type(feeds)(**{**vars(feeds), "bookings": many})
    w = warehouse.load(spark, feeds, root, airline.CALENDAR, Gates(contract=False))
    sales = w["fact_ticket_sales"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    again = fact.key_ticket_sales(sales.drop("ticket_sales_key").repartition(3))
    assert rows(again, "ticket_sales_key", "booking_id") == rows(sales, "ticket_sales_key", "booking_id")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sales.agg(F.count("*"), F.min("ticket_sales_key"), F.max("ticket_sales_key"),
                     F.count_distinct("ticket_sales_key")).first()[:] == (3000, 1, 3000, 3000)
    january = sales.filter("travel_month = 202501")
    assert january.select(F.input_file_name()).distinct().count() > 1


def test_files_are_clustered_by_date_then_key(spark):
    w = catalog.loaded(spark, f"{DATA}/sf0.001")
    files = w["fact_ticket_sales"].inputFiles()
    assert len(files) >= 80
    for path in files[:6]:
        got = [tuple(r) for r in spark.read.parquet(path)
               .select("travel_date_key", "ticket_sales_key").collect()]
        assert got == sorted(got)


def test_rule_report_reads_the_fact_three_times(small):
    plan = warehouse.rule_report(small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gold/fact_ticket_sales") == 3


def test_sql_names(spark, small, small_root):
    small.register("dw")
    month = spark.sql("""SELECT count(*) n, sum(fare_amount) fare FROM dw.FactTicketSales
                         WHERE travel_month = 202501""").first()
    assert (month["n"], float(month["fare"])) == (2, 400.5)
    staged = airline.updates(spark, [(1, "Ana", "BOM", "Platinum")])
    warehouse.apply_changes(spark, small_root, staged, "2025-03-01").register("dw")
    assert spark.sql("SELECT * FROM dw.DimPassenger WHERE passenger_id = 1").count() == 2
    assert spark.sql("SELECT region FROM dw.vDimAirportGeo WHERE airport_code = 'LHR'").first()[0] == "Europe"


def test_filters_prune_month_folders(spark):
    w = catalog.loaded(spark, f"{DATA}/sf0.001")
    sales = w["fact_ticket_sales"]
    months = sales.select("travel_month").distinct().count()

    def partitions(df):
        scans = layout.scan_metrics(df)
        return max(s["partitions"] for s in scans)

    march = layout.travel_between(19970301, 19970331)
    assert partitions(layout.booking_totals(sales.filter(march))) == 1
    assert partitions(layout.booking_totals(sales.filter("fare_class = 'Business'"))) == months
    quarter = w["dim_date"].filter("year = 1997 AND quarter = 1")
    assert partitions(layout.booking_totals(layout.travelled_on(sales, quarter))) == 3
    counts = layout.rows_per_partition(sales, catalog.BOUNDARIES, include_empty=True)
    assert counts.count() == 84
    assert counts.agg(F.sum("row_count")).first()[0] == sales.count()


def test_profile_joins(spark):
    feeds = airline.feeds(spark, [*airline.BOOKINGS, _booking(flight_id=77)])
    joined = fact.booking_flights(feeds.bookings, feeds.flights)
    assert rows(joined.filter("flight_number IS NULL"), "booking_id") == [(999,)]
    assert rows(checks.repeated_pairs(feeds.bookings)) == [(1, 10, 2)]
    assert checks.booked_before_signup(feeds.bookings, feeds.passengers).first()[:] == (5, 1)
    assert rows(checks.orphans(feeds.bookings, "flight_id", feeds.flights, "flight_id")) == [(77, 1)]


def test_keys_meet_a_bounded_number_to_a_task(spark, monkeypatch):
    monkeypatch.setattr(checks, "KEYS_PER_TASK", 100)
    spec = TABLES["dim_city"]
    cities = spark.range(1, 1001).select(
        F.when(F.col("id") > 3, F.col("id")).cast("int").alias("city_key"),
        F.when(F.col("id") > 10, F.concat(F.lit("c"), "id")).alias("city_name"),
        (F.col("id") % 2).cast("int").alias("country_key"))
    found = checks.key_violations(spec, cities)
    assert rows(found) == [("unique city_key", 3), ("unique city_name, country_key", 10)]
    plan = found._jdf.queryExecution().toString()
    assert ", 20), REPARTITION_BY_NUM" in plan
    lost = checks.reference_violations(spec, cities, {"dim_country": spark.sql("SELECT 1 AS country_key")})
    assert rows(lost) == [("country_key in dim_country", 500)]
    twice = spark.sql("SELECT * FROM VALUES (1), (1), (NULL) AS t(country_key)")
    assert rows(checks.resolved_by_reference(cities, {"dim_country": twice}, spec)) == [
        ("country_key in dim_country", 1000, 1000)]


def test_the_summary_travels_once(small):
    plan = marts.sales_summary(small["fact_ticket_sales"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning(travel_month" in plan
