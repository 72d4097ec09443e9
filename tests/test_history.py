from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import airline
from airline import rows
from starhouse.operators import fact, history
from starhouse.operators.dimensions import passenger_dimension
from starhouse.plans import marts, warehouse
from starhouse.schemas import LoadError
from starhouse.streaming import change_feed

DAY = "2025-03-01"
OPEN = date(9999, 12, 31)


@pytest.fixture()
def versions(spark):
    return passenger_dimension(airline.frame(spark, "bronze_passengers", airline.PASSENGERS))


def _after(versions, staged, day=DAY, **options):
    return rows(history.apply_feed(versions, staged, day, **options),
                "passenger_id", "frequent_flyer_tier", "home_airport_code", "effective_from",
                "effective_to", "is_current", "passenger_key")


def test_first_versions(spark, versions):
    assert rows(versions, "passenger_key", "passenger_id", "effective_from", "effective_to") == [
        (i, i, date(1900, 1, 1), OPEN) for i in (1, 2, 3)]
    signup = passenger_dimension(airline.frame(spark, "bronze_passengers", airline.PASSENGERS), None)
    assert rows(signup.filter("passenger_id = 1"), "effective_from") == [(date(2024, 5, 1),)]


def test_changed_unchanged_and_new(spark, versions):
    staged = airline.updates(spark, [
        (1, "Ana", "BOM", "Platinum"), (2, "Benjamin", "DEL", "Silver"), (9, "Dev", "LHR", "Blue")])
    got = _after(versions, staged)
    assert [r for r in got if r[0] == 1] == [
        (1, "Gold", "BOM", date(1900, 1, 1), date(2025, 2, 28), False, 1),
        (1, "Platinum", "BOM", date(2025, 3, 1), OPEN, True, 4)]
    assert len([r for r in got if r[0] == 2]) == 1  # a new name alone opens no version
    assert [r for r in got if r[0] == 9] == [(9, "Blue", "LHR", date(2025, 3, 1), OPEN, True, 5)]
    fresh = history.new_versions(versions, staged, DAY)
    assert rows(fresh, "passenger_id", "signup_date") == [(1, date(2024, 5, 1)), (9, None)]


@pytest.mark.parametrize("staged_row, default, null_safe", [
    ((3, "Caz", None, "Gold"), 1, 2),      # NULL tier in the dimension
    ((1, "Ana", "BOM", None), 1, 2),       # NULL tier in the feed
    ((1, "Ana", "DEL", None), 2, 2),       # the other attribute differs
])
def test_null_is_no_change_unless_null_safe(spark, versions, staged_row, default, null_safe):
    staged = airline.updates(spark, [staged_row])
    for option, expected in ((False, default), (True, null_safe)):
        got = _after(versions, staged, null_safe=option)
        assert len([r for r in got if r[0] == staged_row[0]]) == expected


def test_fully_expired_passenger_returns(spark, versions):
    closed = versions.withColumns({
        "is_current": F.col("passenger_id") != 2,
        "effective_to": F.when(F.col("passenger_id") == 2, F.lit(date(2025, 1, 31)))
        .otherwise(F.col("effective_to"))})
    got = _after(closed, airline.updates(spark, [(2, "Ben", "DEL", "Silver")]))
    assert [r[5] for r in got if r[0] == 2] == [False, True]


def test_same_feed_twice_changes_nothing(spark, small_root):
    staged = airline.updates(spark, [(1, "Ana", "DEL", "Platinum"), (9, "Dev", "LHR", "Blue")])
    once = warehouse.apply_changes(spark, small_root, staged, DAY)
    twice = warehouse.apply_changes(spark, small_root, staged, DAY)
    assert twice.version == once.version + 1
    assert rows(once["dim_passenger"]) == rows(twice["dim_passenger"])


def test_bad_feeds_are_refused_before_writing(spark, small_root):
    double = airline.updates(spark, [(1, "Ana", "BOM", "Blue"), (1, "Ana", "BOM", "Red")])
    with pytest.raises(LoadError, match="staged_twice"):
        warehouse.apply_changes(spark, small_root, double, DAY)
    warehouse.apply_changes(spark, small_root, airline.updates(spark, [(1, "Ana", "BOM", "Blue")]), DAY)
    other = airline.updates(spark, [(1, "Ana", "BOM", "Red")])
    with pytest.raises(LoadError, match="already_loaded"):
        warehouse.apply_changes(spark, small_root, other, DAY)
    assert warehouse.Warehouse(spark, small_root).version == 2


def test_history_folders_are_kept(spark, small_root):
    paths = []
    for day, tier in (("2025-03-01", "A"), ("2025-04-01", "B"), ("2025-05-01", "C")):
        staged = airline.updates(spark, [(1, "Ana", "BOM", tier)])
        w = warehouse.apply_changes(spark, small_root, staged, day)
        history_paths = [p for p in w.parts("dim_passenger") if p.name.startswith(warehouse.HISTORY)]
        assert set(paths) <= set(history_paths)
        paths = history_paths
    assert len(paths) == 3
    assert rows(history.version_totals(w["dim_passenger"])) == [(6, 3, 3)]
    assert w.current_passengers().count() == 3
    assert all(r[1] == 0 for r in rows(history.history_violations(w["dim_passenger"])))


def test_violations_are_found(spark, versions):
    one = versions.filter("passenger_id = 1")
    overlap = one.unionByName(one.withColumn("effective_from", F.lit(date(2025, 1, 1))))
    found = dict(rows(history.history_violations(overlap)))
    assert (found["overlap"], found["not_one_current"], found["same_start"]) == (1, 1, 0)
    twice = dict(rows(history.history_violations(one.unionByName(one))))
    assert (twice["same_start"], twice["not_one_current"]) == (1, 1)
    late = one.withColumns({"effective_from": F.lit(date(2025, 2, 1)),
                            "effective_to": F.lit(date(2025, 1, 1))})
    found = dict(rows(history.history_violations(late)))
    assert (found["ends_before_start"], found["flag_and_end_disagree"]) == (1, 1)


def test_stream_applies_dates_in_order_and_once(spark, small_root, tmp_path):
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    change_feed.land(airline.updates(spark, [(1, "Ana", "BOM", "B")]), landing, "2025-04-01")
    change_feed.land(airline.updates(spark, [(1, "Ana", "BOM", "A")]), landing, "2025-03-01")
    change_feed.run(spark, landing, small_root, progress)
    w = warehouse.Warehouse(spark, small_root)
    assert w.version == 3
    assert rows(w["dim_passenger"].filter("passenger_id = 1"), "frequent_flyer_tier", "effective_to") == [
        ("A", date(2025, 3, 31)), ("B", OPEN), ("Gold", date(2025, 2, 28))]
    change_feed.run(spark, landing, small_root, progress)
    assert warehouse.Warehouse(spark, small_root).version == 3
    # A batch replayed in full after its versions were published is skipped.
    batch = spark.read.parquet(landing)
    change_feed.apply_batch(batch, 0, small_root)
    assert warehouse.Warehouse(spark, small_root).version == 3


def test_reports_keep_history(spark, small_root):
    w = warehouse.apply_changes(spark, small_root, airline.updates(spark, [(1, "Ana", "BOM", "Blue")]), DAY)
    report = marts.revenue_as_was_as_is(w["fact_ticket_sales"], w["dim_passenger"])
    assert [r[:2] + (float(r[2]),) for r in rows(report)] == [
        ("Gold", "Blue", 100.0), ("Silver", "Silver", 900.0)]
    revenue = marts.revenue_by_route_month_tier(
        w["fact_ticket_sales"], w["dim_passenger"], w["airport_geo"])
    assert [tuple(r[:4]) for r in rows(revenue)] == [
        ("India", "India", 202501, "Gold"), ("India", "United Kingdom", 202502, "Silver")]


def test_fact_reload_takes_the_version_valid_at_booking(spark, small_root):
    feeds = airline.feeds(spark)
    before = warehouse.apply_changes(
        spark, small_root, airline.updates(spark, [(1, "Ana", "BOM", "Blue")]), "2025-01-03")
    after = warehouse.reload_fact(spark, small_root, feeds.bookings, feeds.flights)
    keys = dict(rows(after["fact_ticket_sales"], "booking_id", "passenger_key"))
    assert keys == {100: 1, 101: 4, 102: 2, 103: 3}  # 101 was booked on the load date
    assert rows(after["dim_passenger"]) == rows(before["dim_passenger"])
    assert after.version == before.version + 1


@settings(max_examples=6, deadline=None)
@given(st.data())
def test_as_of_equals_brute_force(spark, data):
    """The timeline gives the version whose span holds the day, gaps included."""
    starts = {
        pid: sorted(data.draw(st.sets(st.integers(0, 40), min_size=1, max_size=6)))
        for pid in (1, 2, 3)
    }
    versions, key = [], 0
    for pid, days in starts.items():
        for i, d in enumerate(days):
            key += 1
            end = days[i + 1] - 1 if i + 1 < len(days) else 99
            end = max(d, end - data.draw(st.integers(0, 3)))
            versions.append((pid, key, d, end))
    booked = data.draw(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 45)), max_size=25))
    day = lambda c: F.date_add(F.lit("2025-01-01").cast("date"), F.col(c))
    dim = spark.createDataFrame(versions, "passenger_id int, passenger_key int, a int, b int").select(
        "passenger_id", "passenger_key", day("a").alias("effective_from"), day("b").alias("effective_to"))
    bookings = spark.createDataFrame(
        [(i, p, d) for i, (p, d) in enumerate(booked)], "booking_id int, passenger_id int, d int"
    ).select("booking_id", "passenger_id", day("d").alias("booking_date"))
    expected = sorted(
        (i, k) for i, (p, d) in enumerate(booked) for q, k, a, b in versions
        if p == q and a <= d <= b)
    got = fact.versions_as_of(bookings, dim)
    assert sorted(tuple(r) for r in got.select("booking_id", "passenger_key").collect()) == expected


def test_unsound_history_is_refused_before_a_reload(spark, small_root):
    feeds, w = airline.feeds(spark), warehouse.Warehouse(spark, small_root)
    twice = w["dim_passenger"].unionByName(
        w["dim_passenger"].withColumns({"passenger_key": F.col("passenger_key") + 10,
                                        "effective_from": F.lit("2025-01-01").cast("date")}))
    w.store.publish({"dim_passenger": warehouse.write_passengers(w.store, twice, 1)})
    with pytest.raises(LoadError, match="not sound"):
        warehouse.reload_fact(spark, small_root, feeds.bookings, feeds.flights)


@pytest.mark.parametrize("row", [
    (None, "Ana", "BOM", "Blue"), (1, None, "BOM", "Blue"), (1, "Ana", "BOMX", "Blue"),
    (1, "Ana", "BOM", "x" * 48)])
def test_feeds_that_break_a_column_rule_are_refused(spark, small_root, row):
    kind = "passenger_id int, passenger_name string, home_airport_code string, frequent_flyer_tier string"
    before = warehouse.Warehouse(spark, small_root).version
    with pytest.raises(LoadError, match="column rule"):
        warehouse.apply_changes(spark, small_root, spark.createDataFrame([row], kind), DAY)
    assert warehouse.Warehouse(spark, small_root).version == before


def test_two_streams_lose_no_feed(spark, small_root, tmp_path):
    for number, row in enumerate([(1, "Ana", "BOM", "Blue"), (2, "Ben", "DEL", "Blue")]):
        landing = str(tmp_path / f"landing{number}")
        change_feed.land(airline.updates(spark, [row]), landing, DAY)
        change_feed.run(spark, landing, small_root, str(tmp_path / f"progress{number}"))
        change_feed.run(spark, landing, small_root, str(tmp_path / f"lost{number}"))  # again
    current = warehouse.Warehouse(spark, small_root).current_passengers()
    assert rows(current, "passenger_id", "frequent_flyer_tier") == [
        (1, "Blue"), (2, "Blue"), (3, None)]


def test_history_parts_are_merged(spark, small_root, monkeypatch):
    monkeypatch.setattr(warehouse, "HISTORY_PARTS", 2)
    for number in range(5):
        staged = airline.updates(spark, [(1, "Ana", "BOM", f"tier {number}")])
        w = warehouse.apply_changes(spark, small_root, staged, f"2025-03-0{number + 1}")
        assert sum(p.name.startswith(warehouse.HISTORY) for p in w.parts("dim_passenger")) <= 2
    assert w["dim_passenger"].count() == 8
    assert rows(history.history_violations(w["dim_passenger"]).filter("violations > 0")) == []


def test_adopting_a_history_is_refused(spark, small_root):
    after = warehouse.apply_changes(
        spark, small_root, airline.updates(spark, [(1, "Ana", "BOM", "Blue")]), DAY)
    with pytest.raises(LoadError, match="holds history"):
        history.adopt(after["dim_passenger"])
