"""Full load, change feed and publication of the warehouse."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.operators import checks, contract, dimensions, fact, geography, history
from starhouse.operators.calendar import calendar
from starhouse.plans import marts
from starhouse.schemas import TABLES
from starhouse.session import stored
from starhouse.sources.feeds import Feeds
from starhouse.sources.store import Part, Store

# DimPassenger is stored in two slices of hash buckets. A feed replaces the current bucket of the
# passengers it changes and adds their expired versions to the bucket's history.
CURRENT, HISTORY = "slice=current/", "slice=history/"
# Current versions in a bucket, when a full load chooses the number of buckets.
ROWS_PER_BUCKET = 1_000_000
# Parts of a bucket's history before they are merged into one.
HISTORY_PARTS = 16
# The table that keep_summary publishes.
SUMMARY = "sales_summary"
# Marks of a version: number of buckets, and the highest keys that were ever handed out.
BUCKETS, PASSENGER_KEY, SALES_KEY = "dim_passenger.buckets", "dim_passenger.key", "fact_ticket_sales.key"


@dataclass(frozen=True)
class Gates:
    """Which refusals are active during a load."""

    contract: bool = True
    load: bool = True


class Warehouse:
    """Tables of one published version, read lazily."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.store = Store(spark, root)
        self.published = self.store.version(version)
        self._frames: dict[str, DataFrame] = {}

    @property
    def version(self) -> int:
        return self.published.number

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            parts = self.published.tables[table]
            self._frames[table] = self.store.read(parts, None if parts else TABLES[table].schema)
        return self._frames[table]

    def parts(self, table: str) -> list[Part]:
        return list(self.published.tables[table])

    def passengers(self, slice_: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Versions of a slice, of all or of the given buckets; nothing else is read."""
        parts = [p for p in self.parts("dim_passenger") if p.name.startswith(slice_)]
        if buckets is not None:
            wanted = {f"{slice_}bucket={b}" for b in buckets}
            parts = [p for p in parts if p.name in wanted]
        return self.store.read(parts, self["dim_passenger"].schema)

    def current_passengers(self) -> DataFrame:
        """Current versions only: reads none of the history files."""
        return self.passengers(CURRENT)

    def names(self) -> list[str]:
        return sorted(self.published.tables)

    def register(self, database: str = "dw") -> None:
        """Make the version queryable by SQL under the tables' SQL names.

        A whole table becomes an external table, one in months an external table whose partitions
        are the months' parts. Other parts are partitions of a table of their own, which a view
        shows without them.
        """
        spark = self.store.spark
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
        for table in self.names():
            spec, parts = TABLES[table], self.parts(table)
            name = f"{database}.{spec.sql_name}"
            for old in (name, f"{name}_parts"):
                if spark.catalog.tableExists(old):
                    kind = "VIEW" if spark.catalog.getTable(old).tableType == "VIEW" else "TABLE"
                    spark.sql(f"DROP {kind} {old}")
            if not parts:
                columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
                spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
            elif any(p.columns for p in parts):
                renamed = " UNION ALL ".join(_part_query(p, self[table].columns, spark) for p in parts)
                spark.sql(f"CREATE VIEW {name} AS {renamed}")
            elif len(parts) == 1 and not parts[0].name:
                spark.catalog.createTable(name, path=parts[0].path, source="parquet")
            elif spec.partitioned_by:
                _partitioned_table(spark, name, self[table].schema, list(spec.partitioned_by),
                                   [(p.name.replace("/", ", "), p.path) for p in parts])
            else:
                schema = T.StructType([*self[table].schema, T.StructField("part", T.IntegerType())])
                _partitioned_table(spark, f"{name}_parts", schema, ["part"],
                                   [(f"part={i}", p.path) for i, p in enumerate(parts)])
                columns = ", ".join(self[table].columns)
                spark.sql(f"CREATE VIEW {name} AS SELECT {columns} FROM {name}_parts")


def _part_query(part: Part, columns: Sequence[str], spark: SparkSession) -> str:
    """SQL that reads one part under its present column names; columns it lacks are NULL."""
    stored = {n: c for c in spark.read.parquet(part.path).columns
              if (n := dict(part.columns).get(c, c)) is not None}
    picked = ", ".join(f"{stored.get(c, 'NULL')} AS {c}" for c in columns)
    return f"SELECT {picked} FROM parquet.`{part.path}`"


def _partitioned_table(spark: SparkSession, name: str, schema: T.StructType, by: Sequence[str],
                       parts: Sequence[tuple[str, str]]) -> None:
    """An external table with each part as a partition; ``parts`` are (partition, folder)."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    base = parts[0][1].partition("/load=")[0]
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(by)}) "
              f"LOCATION '{base}'")
    added = " ".join(f"PARTITION ({spec}) LOCATION '{path}'" for spec, path in parts)
    spark.sql(f"ALTER TABLE {name} ADD {added}")


def load(
    spark: SparkSession,
    feeds: Feeds,
    root: str,
    calendar_days: tuple[str, str],
    gates: Gates = Gates(),
    land: bool = True,
) -> Warehouse:
    """Rebuild every table from bronze and publish them together.

    ``calendar_days`` are the first and last day of the declared calendar: a
    booking outside it resolves to no date, and the gates stop the load.
    ``land`` first copies the feeds unchanged into bronze parquet, so that text
    files are parsed once although checks and loads read them several times.
    Dimensions are written before the fact reads them back, so the fact joins
    tables whose sizes Spark knows, and short ones are broadcast without a hint.
    """
    store = Store(spark, root)
    parts: dict[str, list[Part]] = {}
    built: dict[str, DataFrame] = {}

    def keep(table: str, df: DataFrame) -> DataFrame:
        parts[table] = store.write(df, table, TABLES[table].partitioned_by)
        built[table] = store.read(parts[table], df.schema)
        return built[table]

    fields = None
    if land:
        raw = feeds.by_table()
        if gates.contract:  # the field rules are counted while the bookings are written
            raw["bronze_bookings"], fields = contract.measured(raw["bronze_bookings"])
        _together([partial(keep, name, df) for name, df in raw.items()])
        feeds = Feeds.of_tables({name: built.pop(name) for name in raw})
    if gates.contract:
        broken = contract.violations(feeds.bookings, feeds.flights, feeds.passengers,
                                     fields.get if fields else None)
        checks.require_empty(broken.filter("violations > 0"), "bookings break the contract")
    if gates.load:
        require_geography(feeds.airports)

    def load_geography() -> None:
        countries = keep("dim_country", geography.country_dimension(feeds.airports))
        cities = keep("dim_city", geography.city_dimension(feeds.airports, countries))
        flat = dimensions.airport_dimension(feeds.airports)
        airports = keep("dim_airport", geography.link_airports(flat, cities, countries))
        # Stored rather than left as joins: reports then see its true, short size.
        keep("airport_geo", geography.airport_geo(airports, cities, countries))

    def load_passengers() -> None:
        versions = dimensions.passenger_dimension(feeds.passengers)
        parts["dim_passenger"] = write_passengers(store, versions, buckets)
        built["dim_passenger"] = store.read(parts["dim_passenger"], versions.schema)

    passengers = feeds.passengers.count()
    buckets = -(-passengers // ROWS_PER_BUCKET) or 1
    # Independent short loads share the cluster instead of queueing behind each other.
    _together([
        lambda: keep("dim_date", calendar(spark, *calendar_days)),
        load_geography,
        load_passengers,
        lambda: keep("dim_aircraft", dimensions.aircraft_dimension(feeds.aircraft)),
        lambda: keep("dim_flight", dimensions.flight_dimension(feeds.flights)),
    ])
    lookup = flight_lookup(feeds.flights, built)
    sales = fact.ticket_sales(feeds.bookings, lookup, built["dim_passenger"], built["dim_date"])
    keep("fact_ticket_sales", fact.key_ticket_sales(sales))
    if gates.load:
        require_sound(feeds.bookings, built)
    # Keys are dense from 1 on, so the counts are the highest keys.
    store.publish(parts, {BUCKETS: buckets, PASSENGER_KEY: passengers,
                          SALES_KEY: built["fact_ticket_sales"].count()})
    return Warehouse(spark, root)


def reload_fact(
    spark: SparkSession,
    root: str,
    bookings: DataFrame,
    flights: DataFrame,
) -> Warehouse:
    """Rebuild only the fact, on the published dimensions and their history.

    Each booking takes the passenger version valid when it was made: looking up
    the current version here would rewrite past reports. A history that is not
    sound is refused first: it would lose or double bookings.
    """
    now = Warehouse(spark, root)
    history.require_sound_history(now["dim_passenger"])
    tables = {name: now[name] for name in now.names() if TABLES[name].layer != "bronze"}
    sales = fact.ticket_sales(bookings, flight_lookup(flights, tables), tables["dim_passenger"],
                              tables["dim_date"], as_of=True)
    sales = fact.key_ticket_sales(sales)
    spec = TABLES["fact_ticket_sales"]
    parts = now.store.write(sales, spec.name, spec.partitioned_by)
    tables[spec.name] = now.store.read(parts, sales.schema)
    require_sound(bookings, tables)
    now.store.publish({spec.name: parts}, {SALES_KEY: tables[spec.name].count()})
    return Warehouse(spark, root)


def reload_months(
    spark: SparkSession,
    root: str,
    bookings: DataFrame,
    flights: DataFrame,
    months: Sequence[int],
) -> Warehouse:
    """Rebuild the fact of some travel months and publish only their parts.

    ``bookings`` holds all bookings of these months; others in it are left alone. A booking keeps the
    key it has in the months' old parts, new ones are keyed after the highest key ever handed out.
    A booking that stands in a month that stays is refused: it would be counted twice.
    """
    now = Warehouse(spark, root)
    spec, store = TABLES["fact_ticket_sales"], now.store
    month = F.date_format(F.col("travel_date").cast("date"), "yyyyMM").cast("int")
    bookings = bookings.filter(month.isin(list(months)))
    touched = {f"travel_month={m}" for m in months}
    old = [p for p in now.parts(spec.name) if p.name in touched]
    left = [p for p in now.parts(spec.name) if p.name not in touched]
    tables = {name: now[name] for name in now.names() if TABLES[name].layer != "bronze"}
    history.require_sound_history(tables["dim_passenger"])
    sales = fact.ticket_sales(bookings, flight_lookup(flights, tables), tables["dim_passenger"],
                              tables["dim_date"], as_of=True)
    schema = now[spec.name].schema
    known = store.read(old, schema).select("booking_id", "ticket_sales_key")
    rows = stored(sales.join(known, "booking_id", "left"), "months-sales")
    elsewhere = store.read(left, schema).select("booking_id").join(
        rows.select("booking_id"), "booking_id", "left_semi")
    checks.require_empty(elsewhere, "a reloaded booking stands in a month that is not reloaded")
    highest = now.published.marks[SALES_KEY]
    fresh = rows.filter("ticket_sales_key IS NULL").drop("ticket_sales_key")
    fresh = fact.number_sales(fresh, first=highest + 1)
    keyed = rows.filter("ticket_sales_key IS NOT NULL").unionByName(fresh).select(schema.names)
    keyed = fact.laid_out(keyed.repartitionByRange("travel_month", "ticket_sales_key"))
    written = store.write(keyed, spec.name, spec.partitioned_by)
    tables[spec.name] = store.read(written, schema)
    require_sound(bookings, tables)
    highest = max(highest, tables[spec.name].agg(F.max("ticket_sales_key")).first()[0] or 0)
    published = {spec.name: left + written}
    if SUMMARY in now.names():
        published[SUMMARY] = _summary_parts(store, now.parts(SUMMARY), tables[spec.name], touched)
    store.publish(published, {SALES_KEY: highest})
    return Warehouse(spark, root)


def keep_summary(spark: SparkSession, root: str) -> Warehouse:
    """Publish the sales summary of all months; reloads of months then keep it up to date."""
    now = Warehouse(spark, root)
    parts = _summary_parts(now.store, [], now["fact_ticket_sales"], set())
    now.store.publish({SUMMARY: parts})
    return Warehouse(spark, root)


def _summary_parts(store: Store, parts: Sequence[Part], sales: DataFrame, months: set[str]) -> list[Part]:
    """The summary's parts with the months of ``sales`` in place of the named ones."""
    written = store.write(marts.sales_summary(sales), SUMMARY, TABLES[SUMMARY].partitioned_by)
    return [p for p in parts if p.name not in months] + written


def flight_lookup(flights: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Flight keys, stored so that the fact join is planned on their real size.

    Estimated through its own joins, even a short lookup looks too large to
    broadcast, and the bookings would be shuffled for it.
    """
    keys = fact.flight_keys(flights, dims["dim_flight"], dims["dim_airport"],
                            dims["dim_aircraft"])
    return stored(keys, "flight-keys")


def apply_changes(
    spark: SparkSession,
    root: str,
    staged: DataFrame,
    load_date: str,
    null_safe: bool = False,
    digest: str | None = None,
) -> Warehouse:
    """Apply one change feed to DimPassenger and publish the result.

    The feed is landed and checked first. Only buckets that hold passengers of the feed are read, only
    those with a changed or new passenger are written. ``digest`` registers the feed as applied.
    """
    checks.require_empty(history.feed_rules(staged).filter("violations > 0"),
                         "change feed breaks a column rule")
    before = Warehouse(spark, root)
    store, marks = before.store, before.published.marks
    landed = store.write(staged, "stg_passenger_updates")
    staged = store.read(landed, staged.schema)
    bucket = _bucket(marks[BUCKETS])
    feed = (load_date, digest) if digest else None

    near = _numbers(staged, bucket)
    current = before.passengers(CURRENT, near)
    problems = history.feed_problems(current, staged, load_date, null_safe)
    checks.require_empty(problems.filter("passengers > 0"), "change feed refused")
    versions = current.unionByName(before.passengers(HISTORY, near))
    fresh = stored(history.new_versions(versions, staged, load_date, null_safe,
                                        highest=marks[PASSENGER_KEY]), "new-versions")
    written = _numbers(fresh, bucket)  # a changed or new passenger has a new version
    if not written:
        store.publish({"stg_passenger_updates": landed}, feed=feed)
        return Warehouse(spark, root)

    updated = history.expire(before.passengers(CURRENT, written), staged, load_date, null_safe)
    updated = updated.unionByName(fresh)
    held = Counter(p.name for p in before.parts("dim_passenger") if p.name.startswith(HISTORY))
    full = [b for b in written if held[f"{HISTORY}bucket={b}"] >= HISTORY_PARTS]
    if full:  # every feed adds a part to a bucket's history: merge them now and then
        updated = updated.unionByName(before.passengers(HISTORY, full))
    replaced = ({f"{CURRENT}bucket={b}" for b in written} | {f"{HISTORY}bucket={b}" for b in full})
    parts = write_passengers(store, updated, marks[BUCKETS])
    # Only passengers in the feed can have become unsound.
    kept = [p for p in before.parts("dim_passenger") if p.name not in replaced]
    wanted = {f"{s}bucket={b}" for b in written for s in (CURRENT, HISTORY)}
    touched = store.read([p for p in kept if p.name in wanted] + parts, versions.schema)
    history.require_sound_history(touched.join(staged.select("passenger_id"), "passenger_id", "left_semi"))
    store.publish({"dim_passenger": kept + parts, "stg_passenger_updates": landed},
                  {PASSENGER_KEY: marks[PASSENGER_KEY] + fresh.count()}, feed)
    return Warehouse(spark, root)


def rebucket(spark: SparkSession, root: str, buckets: int) -> Warehouse:
    """Publish DimPassenger in another number of buckets, as it has grown."""
    now = Warehouse(spark, root)
    now.store.publish({"dim_passenger": write_passengers(now.store, now["dim_passenger"], buckets)},
                      {BUCKETS: buckets})
    return Warehouse(spark, root)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("passenger_id").cast("bigint")), F.lit(buckets)).cast("int")


def _numbers(rows: DataFrame, bucket: Column) -> list[int]:
    """The buckets of the rows: at most as many numbers as there are buckets."""
    return sorted(r["b"] for r in rows.select(bucket.alias("b")).distinct().collect())


def rule_report(tables: Warehouse) -> DataFrame:
    """(table_name, rule, violations) of all declared column rules, keys and references.

    Covers the silver and gold tables; each is read three times at most.
    """
    parts = []
    for name in (n for n in tables.names() if TABLES[n].layer != "bronze"):
        spec, df = TABLES[name], tables[name]
        columns = checks.column_violations(spec, df).groupBy("rule")
        found = [columns.agg(F.sum("violations").alias("violations"))]
        if spec.key:
            found.append(checks.key_violations(spec, df))
        if spec.references:
            found.append(checks.reference_violations(spec, df, tables))
        parts += [f.select(F.lit(name).alias("table_name"), "rule", "violations") for f in found]
    return reduce(DataFrame.unionByName, parts)


def write_passengers(store: Store, versions: DataFrame, buckets: int) -> list[Part]:
    """Write versions as one file per slice and bucket."""
    part = F.when(F.col("is_current"), "current").otherwise("history")
    rows = versions.withColumns({"slice": part, "bucket": _bucket(buckets)})
    return store.write(rows.repartition("bucket"), "dim_passenger", ["slice", "bucket"])


def require_geography(airports: DataFrame) -> None:
    """The snowflake needs one region per country and a city and country everywhere."""
    checks.require_empty(
        checks.null_counts(airports, ["city", "country"]).filter("null_rows > 0"),
        "airport without a city or country",
    )
    checks.require_empty(
        checks.dependency_violations(airports, ["country"], "region"), "country with two regions"
    )


def require_sound(bookings: DataFrame, tables: Mapping[str, DataFrame]) -> None:
    """All load gates over a candidate, before it is published."""
    sales = tables["fact_ticket_sales"]
    checks.require_same_count(bookings, sales)
    checks.require_resolved(sales, tables)
    # The resolution gate has already followed the fact's references.
    _together([
        partial(checks.require_table_rules, TABLES[name], df,
                None if name == "fact_ticket_sales" else tables)
        for name, df in tables.items()
    ])


def _together(steps: Sequence[Callable[[], object]]) -> None:
    """Run independent steps at once; the first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for step in [pool.submit(s) for s in steps]:
            step.result()
