"""Parts, marks, renamed columns, applied feeds, and changes that write only what they touch."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

import airline
from airline import rows
from starhouse.operators import history
from starhouse.plans import marts, warehouse
from starhouse.plans.warehouse import CURRENT, HISTORY, Warehouse
from starhouse.schemas import LoadError
from starhouse.sources.store import Part, Store
from starhouse.streaming import change_feed

OPEN = date(9999, 12, 31)


def _files(root):
    return set(glob.glob(f"{root}/**/*.parquet", recursive=True))


def _parts(w, table):
    return {p.name: p.path for p in w.parts(table)}


@pytest.fixture(scope="module")
def many_root(spark, tmp_path_factory):
    """2,000 passengers in 40 buckets."""
    root = str(tmp_path_factory.mktemp("many"))
    versions = spark.range(1, 2001).select(
        F.col("id").cast("int").alias("passenger_key"), F.col("id").cast("int").alias("passenger_id"),
        F.concat(F.lit("p"), "id").alias("passenger_name"), F.lit("BOM").alias("home_airport_code"),
        F.lit("Gold").alias("frequent_flyer_tier"), F.lit(date(2024, 1, 1)).alias("signup_date"),
        F.lit(date(1900, 1, 1)).alias("effective_from"), F.lit(OPEN).alias("effective_to"),
        F.lit(True).alias("is_current"))
    store = Store(spark, root)
    store.publish({"dim_passenger": warehouse.write_passengers(store, versions, 40)},
                  {warehouse.BUCKETS: 40, warehouse.PASSENGER_KEY: 2000})
    return root


def test_a_feed_writes_only_the_buckets_it_touches(spark, many_root, root):
    Store(spark, root).adopt(Store(spark, many_root).version())
    before = Warehouse(spark, root)
    assert len(_parts(before, "dim_passenger")) == 40
    staged = airline.updates(spark, [(i, f"p{i}", "BOM", "Blue") for i in (7, 8, 9)]
                             + [(i, f"p{i}", "BOM", "Gold") for i in range(100, 340)]  # unchanged
                             + [(5001, "new", "DEL", None)])
    after = warehouse.apply_changes(spark, root, staged, "2025-03-01")
    old, new = _parts(before, "dim_passenger"), _parts(after, "dim_passenger")
    changed = {n for n in old if new[n] != old[n]}
    assert 1 <= len(changed) <= 4
    assert len([n for n in new if n.startswith(HISTORY)]) <= 3
    written = {f for f in _files(root) if "dim_passenger" in f}  # the adopted files are elsewhere
    assert len(written) == len(changed) + len([n for n in new if n.startswith(HISTORY)])
    assert rows(history.version_totals(after["dim_passenger"])) == [(2004, 2001, 3)]
    assert rows(after["dim_passenger"].filter("passenger_key > 2000"), "passenger_key", "passenger_id") == [
        (2001, 7), (2002, 8), (2003, 9), (2004, 5001)]
    assert after.published.marks[warehouse.PASSENGER_KEY] == 2004
    again = warehouse.apply_changes(spark, root, staged, "2025-03-01")
    assert _parts(again, "dim_passenger") == new and again.version == after.version + 1


def test_a_feed_reads_only_the_buckets_it_names(spark, many_root, root, monkeypatch):
    Store(spark, root).adopt(Store(spark, many_root).version())
    read = []
    kept = history.new_versions
    monkeypatch.setattr(history, "new_versions", lambda versions, *a, **o: (
        read.extend(versions.inputFiles()), kept(versions, *a, **o))[1])
    staged = airline.updates(spark, [(7, "p7", "BOM", "Blue"), (8, "p8", "BOM", "Blue")])
    warehouse.apply_changes(spark, root, staged, "2025-03-01")
    assert 1 <= len({os.path.dirname(f) for f in read}) <= 2


def test_buckets_can_be_dealt_anew(spark, many_root, root):
    Store(spark, root).adopt(Store(spark, many_root).version())
    before = Warehouse(spark, root)
    after = warehouse.rebucket(spark, root, 7)
    assert len(_parts(after, "dim_passenger")) == 7 and after.published.marks[warehouse.BUCKETS] == 7
    assert rows(after["dim_passenger"]) == rows(before["dim_passenger"])
    after = warehouse.apply_changes(spark, root, airline.updates(spark, [(3, "p3", "DEL", "Gold")]), "2025-03-01")
    assert rows(after["dim_passenger"].filter("passenger_id = 3"), "passenger_key", "effective_to") == [
        (2001, OPEN), (3, date(2025, 2, 28))]


def test_keys_of_expired_rows_are_not_handed_out_again(spark, small_root):
    store = Store(spark, small_root)
    marks = store.version().marks
    assert marks[warehouse.PASSENGER_KEY] == 3 and marks[warehouse.SALES_KEY] == 4
    store.publish({}, {warehouse.PASSENGER_KEY: 10})  # keys up to 10 were used and their rows removed
    w = warehouse.apply_changes(spark, small_root, airline.updates(spark, [(1, "Ana", "BOM", "Blue")]), "2025-03-01")
    assert rows(w.current_passengers().filter("passenger_id = 1"), "passenger_key") == [(11,)]


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 9])
def test_latest_version_is_found(spark, root, count):
    store = Store(spark, root)
    assert store.latest() == 0 and store.version().tables == {}
    for number in range(1, count + 1):
        assert store.publish({"dim_city": [Part(f"{root}/x{number}")]}, {"n": number}) == number
    assert store.latest() == count
    assert store.version().marks == {"n": count}
    assert store.version(1).tables["dim_city"] == [Part(f"{root}/x1")]
    assert store.version(count + 1).number == 0


def test_swapped_columns_are_another_feed(spark, small_root, tmp_path):
    kind = "passenger_id int, passenger_name string, home_airport_code string, frequent_flyer_tier string"
    first = spark.createDataFrame([(1, "Ana", None, "DEL")], kind)
    second = spark.createDataFrame([(1, "Ana", "DEL", None)], kind)
    assert change_feed.digest(first) != change_feed.digest(second)
    assert change_feed.digest(first) == change_feed.digest(first.select(*reversed(first.columns)))
    landing = str(tmp_path / "landing")
    change_feed.land(first.withColumn("frequent_flyer_tier", F.lit("Gold")), landing, "2025-03-01")
    change_feed.run(spark, landing, small_root, str(tmp_path / "p1"))
    change_feed.land(second, f"{landing}2", "2025-03-01")
    change_feed.run(spark, f"{landing}2", small_root, str(tmp_path / "p2"))
    current = Warehouse(spark, small_root).current_passengers()
    assert rows(current.filter("passenger_id = 1"), "home_airport_code", "frequent_flyer_tier") == [
        ("DEL", None)]


def test_an_entry_counts_only_with_its_version(spark, root):
    store = Store(spark, root)
    assert not store.applied("2025-03-01", "a")
    store.publish({}, feed=("2025-03-01", "a"))
    assert store.applied("2025-03-01", "a")
    assert not store.applied("2025-03-01", "b") and not store.applied("2025-03-02", "a")
    # a writer that died before its version was published leaves an entry without one
    spark.createDataFrame([("c", "lost", 2)], "digest string, publication string, version int").write.mode(
        "append").json(f"{root}/feeds/load_date=2025-03-01")
    assert not store.applied("2025-03-01", "c")
    store.publish({})  # version 2 is another publication
    assert not store.applied("2025-03-01", "c") and store.applied("2025-03-01", "a")


def test_renamed_columns_of_stored_files(spark, small, root):
    store = Store(spark, root)
    older = {"effective_from": "effective_date", "effective_to": "expiry_date"}
    versions = small["dim_passenger"].withColumnsRenamed(older).withColumns(
        {"slice": F.lit("current"), "bucket": F.lit(0), "fax": F.lit("none")})
    store.publish({"dim_passenger": store.write(versions, "dim_passenger", ["slice", "bucket"])},
                  {warehouse.BUCKETS: 1, warehouse.PASSENGER_KEY: 3})
    files = _files(root)
    assert "effective_date" in Warehouse(spark, root)["dim_passenger"].columns
    store.rename_columns("dim_passenger", {"effective_date": "starts", "fax": None})
    store.rename_columns("dim_passenger", {"starts": "effective_from", "expiry_date": "effective_to"})
    assert _files(root) == files
    assert rows(Warehouse(spark, root)["dim_passenger"].select(small["dim_passenger"].columns)) == rows(
        small["dim_passenger"])
    assert "fax" not in Warehouse(spark, root)["dim_passenger"].columns
    # a feed adds files under the new names; both generations are read, by SQL too
    w = warehouse.apply_changes(spark, root, airline.updates(spark, [(1, "Ana", "BOM", "Blue")]), "2025-03-01")
    w = warehouse.apply_changes(spark, root, airline.updates(spark, [(2, "Ben", "DEL", "Blue")]), "2025-04-01")
    assert rows(history.version_totals(w["dim_passenger"])) == [(5, 3, 2)]
    old = Warehouse(spark, root, version=3)
    assert rows(history.version_totals(old["dim_passenger"])) == [(3, 3, 0)]
    mixed = old.store.read(old.parts("dim_passenger") + w.parts("dim_passenger"))
    assert mixed.count() == 8 and mixed.filter("effective_from IS NULL").isEmpty()
    old.register("dw_renamed")
    assert "fax" not in spark.table("dw_renamed.DimPassenger").columns
    assert spark.sql("SELECT max(effective_to) FROM dw_renamed.DimPassenger").first()[0] == OPEN


# Months of the fact -----------------------------------------------------------------------------


def _changed_booking(number, **changes):
    names = ["booking_id", "passenger_id", "flight_id", "booking_date", "travel_date", "fare_class",
             "fare_amount", "tax_amount", "booking_status", "miles_earned"]
    base = dict(zip(names, airline.BOOKINGS[number], strict=True))
    return tuple({**base, **changes}.values())


def test_reload_of_a_month_writes_that_month(spark, small, small_root):
    feeds = airline.feeds(spark)
    warehouse.keep_summary(spark, small_root)
    before = Warehouse(spark, small_root)
    given = [_changed_booking(0, fare_amount="111.00"), _changed_booking(0, booking_id=50),
             *airline.BOOKINGS[2:]]  # 100 costs more, 50 is new, 101 is gone
    after = warehouse.reload_months(spark, small_root, airline.bookings(spark, given), feeds.flights, [202501])
    old, new = _parts(before, "fact_ticket_sales"), _parts(after, "fact_ticket_sales")
    assert {n for n in new if new[n] != old.get(n)} == {"travel_month=202501"} and set(new) == set(old)
    assert rows(after["fact_ticket_sales"], "booking_id", "ticket_sales_key", "fare_amount") == [
        (*r[:2], pytest.approx(r[2])) for r in [
            (100, 1, 111), (102, 3, 900), (103, 4, 250.25), (50, 5, 100)]]
    assert after.published.marks[warehouse.SALES_KEY] == 5
    old, new = _parts(before, "sales_summary"), _parts(after, "sales_summary")
    assert {n for n in new if new[n] != old.get(n)} == {"travel_month=202501"}
    for w in (before, after):
        args = (w["dim_passenger"], w["airport_geo"])
        assert rows(marts.revenue_by_route_month_tier(w["sales_summary"], *args)) == rows(
            marts.revenue_by_route_month_tier(w["fact_ticket_sales"], *args))
    files = _files(small_root)
    assert sum("fact_ticket_sales" in f for f in files) == 1  # the others are where the first load wrote them
    emptied = warehouse.reload_months(spark, small_root, airline.bookings(spark, airline.BOOKINGS[2:]),
                                      feeds.flights, [202501])
    assert set(_parts(emptied, "fact_ticket_sales")) == {"travel_month=202502", "travel_month=202612"}
    emptied.register("dw_months")
    assert spark.sql("SELECT count(*) FROM dw_months.FactTicketSales WHERE travel_month = 202501").first()[0] == 0
    assert spark.sql("SELECT count(*) FROM dw_months.FactTicketSales").first()[0] == 2


def test_a_booking_moved_between_months_is_refused(spark, small_root):
    feeds = airline.feeds(spark)
    moved = _changed_booking(2, flight_id=10, travel_date=date(2025, 1, 31))  # 102 was in February
    given = airline.bookings(spark, [*airline.BOOKINGS[:2], moved, airline.BOOKINGS[3]])
    with pytest.raises(LoadError, match="not reloaded"):
        warehouse.reload_months(spark, small_root, given, feeds.flights, [202501])
    after = warehouse.reload_months(spark, small_root, given, feeds.flights, [202501, 202502])
    assert rows(after["fact_ticket_sales"], "booking_id", "travel_month", "ticket_sales_key") == [
        (100, 202501, 1), (101, 202501, 2), (102, 202501, 3), (103, 202612, 4)]


def test_a_lost_or_repeated_parent_stops_the_month(spark, small_root):
    store = Store(spark, small_root)
    w = Warehouse(spark, small_root)
    store.publish({"dim_aircraft": store.write(w["dim_aircraft"].union(w["dim_aircraft"]), "dim_aircraft")})
    feeds = airline.feeds(spark)
    with pytest.raises(LoadError):
        warehouse.reload_months(spark, small_root, feeds.bookings, feeds.flights, [202501])
    assert Warehouse(spark, small_root).version == 2
