"""The registered queries: every operator bound to the TPC-H-like tables.

Derived tables are built on first use in the cluster's shared folder and used by
all queries of a session: the landed bookings feed, the warehouse after the full
load, and the same warehouse after the change feed. Everything else is computed
on each call.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.functions.ranges import month_starts
from starhouse.operators import checks, contract, dimensions, fact, geography, history, layout
from starhouse.plans import marts, warehouse
from starhouse.plans.warehouse import Gates, Warehouse
from starhouse.schemas import BOOKING_STATUSES, BOOKINGS, FARE_CLASSES, OPEN_ENDED
from starhouse.session import scratch_path, stored
from starhouse.sources import tpch_feeds as bound
from starhouse.sources.feeds import read_csv_feed, read_raw_csv
from starhouse.sources.store import Store
from starhouse.streaming import change_feed

Query = Callable[[SparkSession, str], DataFrame]

# Monthly boundaries of the range partition function on the bound data's years.
BOUNDARIES = month_starts(199502, 200112)
# The declared calendar of the bound data.
CALENDAR = ("1995-01-01", "2001-12-31")
# Last calendar day and dropped parents used to plant defects the checks must find.
SHORT_CALENDAR_END = "2001-06-30"
# The month that is reloaded alone, and the day and buckets of a second change feed.
RELOADED_MONTH = 199703
SECOND_LOAD_DATE, FEW_BUCKETS = "1999-01-01", 16
DROPPED_PARENTS = 50

_built: dict[tuple[str, str, str], object] = {}
_building = threading.RLock()


def _once(kind: str, spark: SparkSession, folder: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, kind, folder)
    with _building:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def landed_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return _once("bookings", spark, folder, lambda: bound.numbered_bookings(spark, folder))


def loaded(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse after the full load, before any change feed.

    The feeds are landed and all load gates are on. Only the contract gate is
    off: the bound dates break the booking rules by design (see the contract
    queries and ``load_gates``); ``gated`` is a load with that gate on, too.
    """

    def build() -> Warehouse:
        feeds = bound.feeds(spark, folder, landed_bookings(spark, folder))
        return warehouse.load(spark, feeds, scratch_path(spark, "warehouse"),
                              CALENDAR, Gates(contract=False))

    return _once("loaded", spark, folder, build)


def gated(spark: SparkSession, folder: str) -> Warehouse:
    """A full load under every gate, the contract's included, of feeds that keep the contract."""

    def build() -> Warehouse:
        feeds = bound.sound_feeds(spark, folder, landed_bookings(spark, folder))
        return warehouse.load(spark, feeds, scratch_path(spark, "gated"), CALENDAR)

    return _once("gated", spark, folder, build)


def changed(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse after the change feed of ``bound.LOAD_DATE``."""

    def build() -> Warehouse:
        staged = bound.passenger_updates(spark, folder)
        return warehouse.apply_changes(spark, loaded(spark, folder).store.root, staged,
                                       bound.LOAD_DATE)

    return _once("changed", spark, folder, build)


def reloaded(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse after the change feed, its fact reloaded with the versions valid at booking."""

    def build() -> Warehouse:
        before = changed(spark, folder)
        root = scratch_path(spark, "reloaded")
        Store(spark, root).adopt(before.published)
        return warehouse.reload_fact(spark, root, landed_bookings(spark, folder),
                                     bound.flights(spark, folder))

    return _once("reloaded", spark, folder, build)


def month_reloaded(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse after the change feed, one month of its fact reloaded beside a kept summary."""

    def build() -> Warehouse:
        root = scratch_path(spark, "month-reloaded")
        Store(spark, root).adopt(changed(spark, folder).published)
        warehouse.keep_summary(spark, root)
        return warehouse.reload_months(spark, root, landed_bookings(spark, folder),
                                       bound.flights(spark, folder), [RELOADED_MONTH])

    return _once("month reloaded", spark, folder, build)


def flight_lookup(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        w = loaded(spark, folder)
        return warehouse.flight_lookup(bound.flights(spark, folder), {n: w[n] for n in w.names()})

    return _once("flight keys", spark, folder, build)


# Marts ------------------------------------------------------------------------------------


def revenue_by_route_month_tier(spark, folder):
    w = loaded(spark, folder)
    return marts.revenue_by_route_month_tier(
        w["fact_ticket_sales"], w["dim_passenger"], w["airport_geo"]
    )


def revenue_by_airport_route(spark, folder):
    w = loaded(spark, folder)
    return marts.revenue_by_airport_route(w["fact_ticket_sales"], w["airport_geo"])


def tax_share_by_class(spark, folder):
    return marts.tax_share_by_class(loaded(spark, folder)["fact_ticket_sales"])


def average_fare_by_class(spark, folder):
    return marts.average_fare_by_class(loaded(spark, folder)["fact_ticket_sales"])


def revenue_as_was_as_is(spark, folder):
    w = changed(spark, folder)
    return marts.revenue_as_was_as_is(w["fact_ticket_sales"], w["dim_passenger"])


# Bronze and dimensions --------------------------------------------------------------------


def bronze_bookings(spark, folder):
    return landed_bookings(spark, folder)


def booking_flight_join(spark, folder):
    return fact.booking_flights(landed_bookings(spark, folder), bound.flights(spark, folder))


def dim_date(spark, folder):
    return loaded(spark, folder)["dim_date"]


def dim_airport(spark, folder):
    return dimensions.airport_dimension(bound.airports(spark, folder))


def dim_aircraft(spark, folder):
    return dimensions.aircraft_dimension(bound.aircraft(spark, folder))


def dim_flight(spark, folder):
    return dimensions.flight_dimension(bound.flights(spark, folder))


def dim_passenger_initial(spark, folder):
    return dimensions.passenger_dimension(bound.passengers(spark, folder))


def dim_passenger_from_signup(spark, folder):
    return dimensions.passenger_dimension(bound.passengers(spark, folder), first_effective=None)


def dim_country(spark, folder):
    return geography.country_dimension(bound.airports(spark, folder))


def dim_city(spark, folder):
    airports = bound.airports(spark, folder)
    return geography.city_dimension(airports, geography.country_dimension(airports))


def dim_airport_snowflaked(spark, folder):
    airports = bound.airports(spark, folder)
    countries = geography.country_dimension(airports)
    return geography.link_airports(
        dimensions.airport_dimension(airports),
        geography.city_dimension(airports, countries), countries,
    )


def airport_geo_view(spark, folder):
    return loaded(spark, folder)["airport_geo"]


# Fact -------------------------------------------------------------------------------------


def fact_ticket_sales(spark, folder):
    return loaded(spark, folder)["fact_ticket_sales"]


def fact_gated_load(spark, folder):
    """The fact of a load that passed every gate."""
    return gated(spark, folder)["fact_ticket_sales"]


def fact_key_range(spark, folder):
    key = F.col("ticket_sales_key")
    return loaded(spark, folder)["fact_ticket_sales"].agg(
        F.count("*").alias("row_count"), F.min(key).alias("first_key"),
        F.max(key).alias("last_key"), F.count_distinct(key).alias("distinct_keys"),
    )


def fact_loaded_as_of(spark, folder):
    """Reload of the fact with the passenger version valid at booking."""
    w = changed(spark, folder)
    return fact.ticket_sales(landed_bookings(spark, folder), flight_lookup(spark, folder),
                             w["dim_passenger"], w["dim_date"], as_of=True)


def fact_reloaded(spark, folder):
    """The whole reload of the fact: history checked, keyed, gated and published."""
    return reloaded(spark, folder)["fact_ticket_sales"]


def fact_month_reloaded(spark, folder):
    """The fact after one month was reloaded: its keys stay, the other months' files too."""
    return month_reloaded(spark, folder)["fact_ticket_sales"]


def revenue_kept_summary(spark, folder):
    """The flagship report read from the summary that the reload of a month has kept up to date."""
    w = month_reloaded(spark, folder)
    return marts.revenue_by_route_month_tier(w[warehouse.SUMMARY], w["dim_passenger"], w["airport_geo"])


def summary_rows(spark, folder):
    return month_reloaded(spark, folder)[warehouse.SUMMARY]


def asof_passenger_lookup(spark, folder):
    w = changed(spark, folder)
    hits = fact.versions_as_of(
        landed_bookings(spark, folder).select("booking_id", "passenger_id", "booking_date"),
        w["dim_passenger"],
    )
    return hits.select("booking_id", "passenger_id", "booking_date", "passenger_key")


def asof_many_versions(spark, folder):
    """Nations in the role of passengers: every day with an order opens a version."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("booking_id"), F.col("c_nationkey").alias("passenger_id"),
        F.col("o_orderdate").cast("date").alias("day"))
    following = F.lead("day").over(Window.partitionBy("passenger_id").orderBy("day"))
    number = F.datediff("day", F.lit("1990-01-01").cast("date"))
    versions = placed.select("passenger_id", "day").distinct().select(
        "passenger_id", (F.col("passenger_id") * 100_000 + number).cast("bigint").alias("passenger_key"),
        F.col("day").alias("effective_from"),
        F.coalesce(F.date_sub(following, 1), F.lit(OPEN_ENDED).cast("date")).alias("effective_to"))
    booked = placed.select("booking_id", "passenger_id", F.date_add("day", 2).alias("booking_date"))
    return fact.versions_as_of(booked, versions).select(
        "booking_id", "passenger_id", "booking_date", "passenger_key")


# Load validation --------------------------------------------------------------------------


def load_row_counts(spark, folder):
    w = loaded(spark, folder)
    tables = {name: w[name] for name in w.names()}
    feeds = bound.feeds(spark, folder, landed_bookings(spark, folder)).by_table()
    feeds["stg_passenger_updates"] = bound.passenger_updates(spark, folder)
    return checks.row_counts({**tables, **feeds})


def load_gates(spark, folder):
    """(gate, input, code, outcome): every gate on the sound load and on a planted defect."""
    w, bookings = loaded(spark, folder), landed_bookings(spark, folder)
    sales, dims = w["fact_ticket_sales"], {n: w[n] for n in w.names()}
    fewer = sales.filter(F.col("booking_id") % DROPPED_PARENTS != 0)
    early = dims["dim_date"].filter(F.col("full_date") <= F.lit(SHORT_CALENDAR_END).cast("date"))
    broken = contract.violations(bookings, bound.flights(spark, folder),
                                 bound.passengers(spark, folder)).filter("violations > 0")
    sound = bound.sound_feeds(spark, folder, bookings)
    kept = contract.violations(sound.bookings, sound.flights, sound.passengers).filter("violations > 0")
    staged = bound.passenger_updates(spark, folder)
    nameless = staged.withColumn("passenger_name", F.lit(None).cast("string"))
    steps = [
        ("row_counts", "sound", partial(checks.require_same_count, bookings, sales)),
        ("row_counts", "planted", partial(checks.require_same_count, bookings, fewer)),
        ("resolution", "sound", partial(checks.require_resolved, sales, dims)),
        ("resolution", "planted",
         partial(checks.require_resolved, sales, {**dims, "dim_date": early})),
        ("contract", "sound", partial(checks.require_empty, kept, "bookings")),
        ("contract", "planted", partial(checks.require_empty, broken, "bookings")),
        ("feed_rules", "sound", partial(_require_feed_rules, staged)),
        ("feed_rules", "planted", partial(_require_feed_rules, nameless)),
    ]
    rows = [(gate, given, *checks.outcome(step)) for gate, given, step in steps]
    return spark.createDataFrame(rows, "gate string, input string, code int, outcome string")


def _require_feed_rules(staged):
    checks.require_empty(history.feed_rules(staged).filter("violations > 0"), "feed")


def fact_resolution(spark, folder):
    w = loaded(spark, folder)
    return checks.resolved_rows(w["fact_ticket_sales"], {n: w[n] for n in w.names()})


def reference_resolution(spark, folder):
    """Planted defect: the calendar ends early; the other references resolve."""
    w = loaded(spark, folder)
    dims = {n: w[n] for n in w.names()}
    early = dims["dim_date"].filter(F.col("full_date") <= F.lit(SHORT_CALENDAR_END).cast("date"))
    return checks.resolved_by_reference(w["fact_ticket_sales"], {**dims, "dim_date": early})


def unloaded_bookings(spark, folder):
    """Planted defect: the calendar ends early, so later travel cannot load."""
    w = loaded(spark, folder)
    bookings = landed_bookings(spark, folder)
    short = w["dim_date"].filter(F.col("full_date") <= F.lit(SHORT_CALENDAR_END).cast("date"))
    sales = fact.ticket_sales(bookings, flight_lookup(spark, folder), w["dim_passenger"], short)
    return checks.not_loaded(bookings, sales)


def measure_reconciliation(spark, folder):
    return checks.measure_totals({
        "bronze": landed_bookings(spark, folder),
        "fact": loaded(spark, folder)["fact_ticket_sales"],
    })


def key_duplicates(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return checks.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def table_rule_violations(spark, folder):
    """Declared keys and references of every loaded table that do not hold."""
    return warehouse.rule_report(loaded(spark, folder))


def orphan_flights(spark, folder):
    """Planted defect: the flight feed lacks every 50th flight."""
    known = bound.flights(spark, folder).filter(F.col("flight_id") % DROPPED_PARENTS != 0)
    return checks.orphans(landed_bookings(spark, folder), "flight_id", known,
                          "flight_id")


def orphan_passengers(spark, folder):
    known = bound.passengers(spark, folder).filter(F.col("passenger_id") % DROPPED_PARENTS != 0)
    return checks.orphans(landed_bookings(spark, folder), "passenger_id", known,
                          "passenger_id")


def fd_violations(spark, folder):
    """Part names do not determine the brand; country does determine region."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    broken = checks.dependency_violations(parts, ["p_name"], "p_brand")
    return broken.select(F.col("p_name").alias("determinant"), "distinct_values").unionByName(
        checks.dependency_violations(bound.airports(spark, folder), ["country"], "region")
        .select(F.col("country").alias("determinant"), "distinct_values")
    )


def booking_flight_fan_out(spark, folder):
    return checks.fan_out(landed_bookings(spark, folder), bound.flights(spark, folder))


def repeat_passenger_flight(spark, folder):
    return checks.repeated_pairs(landed_bookings(spark, folder))


def bookings_before_signup(spark, folder):
    return checks.booked_before_signup(landed_bookings(spark, folder),
                                       bound.passengers(spark, folder))


# History ----------------------------------------------------------------------------------


def scd2_passenger(spark, folder):
    return changed(spark, folder)["dim_passenger"]


def scd2_adopted(spark, folder):
    """A dimension stored from signup under its first column names, renamed and made ready for feeds."""
    older = dim_passenger_from_signup(spark, folder).withColumnsRenamed(
        {"effective_from": "effective_date", "effective_to": "expiry_date"}
    )
    store = Store(spark, scratch_path(spark, "adopted"))
    store.publish({"dim_passenger": store.write(older, "dim_passenger")})
    store.rename_columns("dim_passenger", {"effective_date": "effective_from",
                                           "expiry_date": "effective_to"})
    return history.adopt(Warehouse(spark, store.root)["dim_passenger"])


def scd2_second_feed(spark, folder):
    """A second feed over few passengers of a dimension in buckets: the other buckets' files stay."""

    def build() -> Warehouse:
        root = scratch_path(spark, "second-feed")
        Store(spark, root).adopt(changed(spark, folder).published, ["dim_passenger"])
        warehouse.rebucket(spark, root, FEW_BUCKETS)
        staged = bound.passengers(spark, folder).filter("passenger_id % 50 = 0").select(
            "passenger_id", "passenger_name", "home_airport_code",
            F.concat("frequent_flyer_tier", F.lit("_2")).alias("frequent_flyer_tier"))
        return warehouse.apply_changes(spark, root, staged, SECOND_LOAD_DATE)

    return _once("second feed", spark, folder, build)["dim_passenger"]


def scd2_expire_step(spark, folder):
    return history.expire(loaded(spark, folder)["dim_passenger"],
                          bound.passenger_updates(spark, folder), bound.LOAD_DATE)


def scd2_insert_step(spark, folder):
    return history.new_versions(loaded(spark, folder)["dim_passenger"],
                                bound.passenger_updates(spark, folder), bound.LOAD_DATE)


def scd2_totals(spark, folder):
    return history.version_totals(changed(spark, folder)["dim_passenger"])


def scd2_changed_versions(spark, folder):
    return history.changed_versions(changed(spark, folder)["dim_passenger"])


def scd2_new_members(spark, folder):
    return history.members_from(changed(spark, folder)["dim_passenger"], bound.NEW_MEMBER_OFFSET)


def scd2_change_breakdown(spark, folder):
    return history.change_breakdown(loaded(spark, folder)["dim_passenger"],
                                    bound.passenger_updates(spark, folder))


def scd2_feed_problems(spark, folder):
    """Planted defect: a second feed on the same load date with other tiers."""
    edited = bound.passenger_updates(spark, folder).withColumn(
        "frequent_flyer_tier", F.concat("frequent_flyer_tier", F.lit("_2"))
    )
    return history.feed_problems(changed(spark, folder)["dim_passenger"], edited,
                                 bound.LOAD_DATE)


def scd2_feed_rules(spark, folder):
    """Planted defects: feed rows without id or name, with long tiers and four-letter homes."""
    pid = F.col("passenger_id")
    broken = bound.passenger_updates(spark, folder).select(
        F.when(pid % 5 != 0, pid).alias("passenger_id"),
        F.when(pid % 3 != 0, F.col("passenger_name")).alias("passenger_name"),
        F.when(pid % 4 == 0, "ABCD").otherwise(F.col("home_airport_code")).alias("home_airport_code"),
        F.when(pid % 2 == 0, F.repeat("frequent_flyer_tier", 9))
        .otherwise(F.col("frequent_flyer_tier")).alias("frequent_flyer_tier"))
    return history.feed_rules(broken)


def scd2_planted_invariants(spark, folder):
    """Planted defects: repeated, reversed, overlapping, unclosed and late versions."""
    versions, pid = changed(spark, folder)["dim_passenger"], F.col("passenger_id")
    days = F.col("effective_from")
    moved = (F.when(pid % 17 == 0, F.date_add(days, 5)).when(pid % 19 == 0, F.date_sub(days, 5))
             .otherwise(days))
    ended = F.when(pid % 23 == 0, F.lit("1850-01-01").cast("date")).otherwise(F.col("effective_to"))
    broken = versions.withColumns({
        "effective_from": F.when(F.col("is_current"), moved).otherwise(days),
        "effective_to": ended, "is_current": F.col("is_current") | (pid % 29 == 0)})
    return history.history_violations(broken.unionByName(broken.filter(pid % 31 == 0)))


def scd2_invariants(spark, folder):
    return history.history_violations(changed(spark, folder)["dim_passenger"])


def scd2_streamed(spark, folder):
    """The change feed consumed as a stream of files gives the same dimension."""

    def build() -> Warehouse:
        landing = scratch_path(spark, "feed")
        change_feed.land(bound.passenger_updates(spark, folder), landing, bound.LOAD_DATE)
        before = loaded(spark, folder)
        root = scratch_path(spark, "streamed")
        Store(spark, root).adopt(before.published, ["dim_passenger"])
        change_feed.run(spark, landing, root, scratch_path(spark, "feed-progress"))
        return Warehouse(spark, root)

    return _once("streamed", spark, folder, build)["dim_passenger"]


# Layout -----------------------------------------------------------------------------------


def partition_row_counts(spark, folder):
    return layout.rows_per_partition(loaded(spark, folder)["fact_ticket_sales"], BOUNDARIES)


def partition_row_counts_with_empty(spark, folder):
    return layout.rows_per_partition(loaded(spark, folder)["fact_ticket_sales"], BOUNDARIES,
                                     include_empty=True)


def partition_key_filter(spark, folder):
    sales = loaded(spark, folder)["fact_ticket_sales"]
    return layout.booking_totals(sales.filter(layout.travel_between(19970301, 19970331)))


def nonpartition_filter(spark, folder):
    sales = loaded(spark, folder)["fact_ticket_sales"]
    return layout.booking_totals(sales.filter(F.col("fare_class") == "Business"))


def quarter_by_calendar(spark, folder):
    w = loaded(spark, folder)
    days = w["dim_date"].filter("year = 1997 AND quarter = 1")
    return layout.booking_totals(layout.travelled_on(w["fact_ticket_sales"], days))


def months_read(spark, folder):
    """Pruning evidence: month folders that each query's scan of the fact has read."""
    runs = {f.__name__: f for f in (partition_key_filter, nonpartition_filter, quarter_by_calendar)}
    rows = [(name, max(s["partitions"] for s in layout.scan_metrics(query(spark, folder))))
            for name, query in runs.items()]
    return spark.createDataFrame(rows, "query string, months long")


def month_totals_by_sql(spark, folder):
    """SQL over the registered tables of schema dw."""
    loaded(spark, folder).register("dw")
    return spark.sql("""
        SELECT d.year, d.month, count(*) AS bookings, sum(s.fare_amount) AS fare
        FROM dw.FactTicketSales s JOIN dw.DimDate d ON d.date_key = s.travel_date_key
        GROUP BY d.year, d.month""").withColumn("fare", F.col("fare").cast("decimal(38,2)"))


# Contract ---------------------------------------------------------------------------------


def contract_violations(spark, folder):
    return contract.violations(landed_bookings(spark, folder), bound.flights(spark, folder),
                               bound.passengers(spark, folder))


def contract_measured_landing(spark, folder):
    """The contract's violations, those of single rows counted while the bookings are written."""
    bookings = landed_bookings(spark, folder)
    watched, found = contract.measured(bookings)
    landed = stored(watched, "measured-bookings")
    return contract.violations(landed, bound.flights(spark, folder), bound.passengers(spark, folder), found.get)


def amounts_finer_than_cents(spark, folder):
    """Prices as delivered (doubles), and the tax before it is rounded to cents."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tax = price * F.col("l_tax").cast("decimal(4,2)")
    return spark.read.parquet(f"{folder}/lineitem.parquet").agg(
        F.count_if(contract.more_than_two_decimals(F.col("l_extendedprice"))).alias("fare"),
        F.count_if(contract.more_than_two_decimals(tax)).alias("tax"),
    )


def unexpected_values(spark, folder):
    """Planted change: the allowed set does not know First."""
    return contract.unexpected_values(landed_bookings(spark, folder), "fare_class",
                                      [c for c in FARE_CLASSES if c != "First"])


def planted_values(spark, folder):
    """Planted values: padded, in another case, and new ones."""
    line = F.col("booking_id") % 100
    status = F.col("booking_status")
    planted = landed_bookings(spark, folder).withColumn(
        "booking_status", F.when(line == 1, F.concat(F.lit(" "), status))
        .when(line == 2, F.upper(status)).when(line == 3, "Waitlisted").otherwise(status))
    return contract.unexpected_values(planted, "booking_status", BOOKING_STATUSES)


def csv_feed_report(spark, folder):
    """(finding, column_name, n, breaking) of a bookings feed delivered as CSV with planted defects.

    The file lacks the tax, has a column more, calls the status by another name, writes flights as
    text, and holds amounts finer than a cent and miles that are no numbers.
    """
    bid = F.col("booking_id")
    fare, miles = F.col("fare_amount").cast("string"), F.col("miles_earned").cast("string")
    bookings = landed_bookings(spark, folder)
    delivered = bookings.drop("tax_amount").withColumns({
        "fare_amount": F.when(bid % 50 == 0, F.concat(fare, F.lit("000000000001"))).otherwise(fare),
        "miles_earned": F.when(bid % 40 == 0, "many").otherwise(miles),
        "flight_id": F.concat(F.lit("x"), "flight_id"),
        "source_system": F.lit("web"),
    }).withColumnRenamed("booking_status", "state")
    path = scratch_path(spark, "csv-feed")
    delivered.write.option("header", True).csv(path)
    raw = read_raw_csv(spark, path)
    finer = raw.agg(F.count_if(contract.more_than_two_decimals(F.col("fare_amount"))).alias("n"))
    return contract.delivery_drift(raw, BOOKINGS.schema, bookings).unionByName(
        finer.select(F.lit("finer than a cent").alias("finding"),
                     F.lit("fare_amount").alias("column_name"), "n", F.lit(True).alias("breaking")))


def column_types(spark, folder):
    """Narrowest types of the bookings feed and of the events, both as delivered text."""
    parts = []
    for name, df in (("bookings", landed_bookings(spark, folder)), ("events", _arrivals(spark, folder))):
        path = scratch_path(spark, "csv-types")
        df.write.option("header", True).csv(path)
        parts.append(contract.column_types(read_raw_csv(spark, path)).select(
            F.lit(name).alias("feed"), "column_name", "n_values", "narrowest"))
    return parts[0].unionByName(parts[1])


def csv_feed_read(spark, folder):
    """The bookings feed written as CSV and read back in its declared types."""
    path = scratch_path(spark, "csv-feed")
    landed_bookings(spark, folder).withColumn("source_system", F.lit("web")).write.option(
        "header", True).csv(path)
    return read_csv_feed(spark, path, BOOKINGS)


def _arrivals(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet")


def late_deliveries(spark, folder):
    daily = contract.delivery_status(_arrivals(spark, folder), "user_id", "ts")
    return daily.select("user_id", "delivery_date", "deliveries", "status")


def delivery_summary(spark, folder):
    return contract.delivery_summary(_arrivals(spark, folder), "user_id", "ts")


def missed_delivery_days(spark, folder):
    return contract.missed_days(_arrivals(spark, folder), "user_id", "ts")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        revenue_by_route_month_tier, revenue_by_airport_route, tax_share_by_class,
        average_fare_by_class, revenue_as_was_as_is,
        bronze_bookings, booking_flight_join, dim_date, dim_airport, dim_aircraft, dim_flight,
        dim_passenger_initial, dim_passenger_from_signup, dim_country, dim_city,
        dim_airport_snowflaked, airport_geo_view, asof_many_versions, fact_reloaded, load_gates,
        scd2_feed_rules, scd2_planted_invariants, months_read, month_totals_by_sql,
        planted_values, csv_feed_report, csv_feed_read,
        fact_ticket_sales, fact_key_range, fact_loaded_as_of, asof_passenger_lookup,
        fact_gated_load, fact_month_reloaded, revenue_kept_summary, summary_rows, reference_resolution, scd2_second_feed,
        load_row_counts, fact_resolution, unloaded_bookings, measure_reconciliation,
        key_duplicates, table_rule_violations, orphan_flights, orphan_passengers, fd_violations,
        booking_flight_fan_out, repeat_passenger_flight, bookings_before_signup,
        scd2_passenger, scd2_adopted, scd2_expire_step, scd2_insert_step, scd2_totals, scd2_changed_versions,
        scd2_new_members, scd2_change_breakdown, scd2_feed_problems, scd2_invariants,
        scd2_streamed,
        partition_row_counts, partition_row_counts_with_empty, partition_key_filter,
        nonpartition_filter, quarter_by_calendar,
        contract_violations, contract_measured_landing, column_types, amounts_finer_than_cents, unexpected_values, late_deliveries,
        delivery_summary, missed_delivery_days,
    )
}
