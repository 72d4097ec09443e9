"""The bookings contract: field rules, references, delivery times, feed drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.functions.numbers import finer_than
from starhouse.schemas import BOOKING_STATUSES, BOOKINGS, FARE_CLASSES

# A delivery is due by 06:00 UTC and late after 08:00 UTC.
DUE_HOUR, LATE_HOUR = 6, 8


def more_than_two_decimals(amount: Column) -> Column:
    """True where an amount is finer than a cent; judges text and doubles by their digits."""
    return finer_than(amount, 2)


def field_rules(schema: T.StructType) -> dict[str, Column]:
    """Violation predicates that need one booking row only."""
    rules = {f"null_{c}": F.col(c).isNull() for c in BOOKINGS.schema.names}
    rules |= {
        "fare_class_not_allowed": ~F.col("fare_class").isin(*FARE_CLASSES),
        "booking_status_not_allowed": ~F.col("booking_status").isin(*BOOKING_STATUSES),
        "fare_not_positive": F.col("fare_amount") <= 0,
        "tax_negative": F.col("tax_amount") < 0,
        "miles_negative": F.col("miles_earned") < 0,
        "booked_after_travel": F.col("booking_date") > F.col("travel_date"),
    }
    for name in ("fare", "tax"):
        kind = schema[f"{name}_amount"].dataType
        in_cents = isinstance(kind, T.DecimalType) and kind.scale <= 2  # holds by type
        rules[f"{name}_finer_than_cents"] = (
            F.lit(False) if in_cents else more_than_two_decimals(F.col(f"{name}_amount"))
        )
    return rules


def measured(bookings: DataFrame) -> tuple[DataFrame, Observation]:
    """The bookings, and an observation that counts field violations while they are written.

    The counts are those of the tasks that succeed, so ``bookings`` should be written directly.
    """
    found = Observation("bookings contract")
    rules = field_rules(bookings.schema)
    return bookings.observe(found, *[F.count_if(p).alias(n) for n, p in rules.items()]), found


def violations(bookings: DataFrame, flights: DataFrame, passengers: DataFrame,
               fields_found: Mapping[str, int] | None = None) -> DataFrame:
    """(rule, violations) for every rule of the contract.

    All field rules share one pass, or none where a landing has measured them
    (``fields_found``, see :func:`measured`). Reference rules work on bookings already
    counted per (flight, travel date) and per passenger, so hot flights or
    passengers travel as single rows.
    """
    if fields_found is None:
        rules = field_rules(bookings.schema)
        fields = bookings.agg(*[F.count_if(p).alias(name) for name, p in rules.items()])
    else:
        fields = bookings.sparkSession.range(1).select(
            *[F.lit(n).cast("bigint").alias(name) for name, n in fields_found.items()])

    flown = (
        bookings.filter(F.col("flight_id").isNotNull())
        .groupBy("flight_id", "travel_date").agg(F.count("*").alias("n"))
    )
    known = flights.select("flight_id", F.col("flight_date").cast("date"),
                           F.lit(True).alias("known"))
    flight_rules = flown.join(known, "flight_id", "left").agg(
        _sum_where(F.col("known").isNull()).alias("unknown_flight"),
        _sum_where(F.col("travel_date") != F.col("flight_date")).alias("travel_not_flight_date"),
    )
    passenger_rules = (
        bookings.filter(F.col("passenger_id").isNotNull())
        .groupBy("passenger_id").agg(F.count("*").alias("n"))
        .join(passengers.select("passenger_id"), "passenger_id", "left_anti")
        .agg(_sum_where(F.lit(True)).alias("unknown_passenger"))
    )
    key_rule = (
        bookings.filter(F.col("booking_id").isNotNull())
        .groupBy("booking_id").agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_booking_id"))
    )
    parts = [
        df.unpivot([], df.columns, "rule", "violations")
        for df in (fields, flight_rules, passenger_rules, key_rule)
    ]
    return reduce(DataFrame.unionByName, parts)


def _sum_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def unexpected_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed set with their row count and how they differ.

    ``padded`` and ``case`` values would be allowed after trimming or in the
    right case; any other value is ``new`` and breaks the contract as well.
    """
    allowed = list(allowed)
    value = F.col(column)
    kind = (
        F.when(F.trim(value).isin(allowed), "padded")
        .when(F.lower(F.trim(value)).isin([a.lower() for a in allowed]), "case")
        .otherwise("new")
    )
    return (
        df.groupBy(column).agg(F.count("*").alias("row_count"))
        .filter(~value.isin(allowed))
        .select(F.lit(column).alias("column_name"), value.alias("value"), kind.alias("kind"),
                "row_count")
    )


# Drift of delivered text ------------------------------------------------------------------

# The types that a text column may turn out to have, narrow ones first, and how a
# value of the type is written. A column has the first type that all its values have.
_WRITTEN_AS = {
    "int": r"^[+-]?\d+$", "bigint": r"^[+-]?\d+$", "decimal(38,10)": r"^[+-]?\d+(\.\d+)?$",
    "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$", "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp_ntz": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$", "boolean": r"(?i)^(true|false)$",
}
# A column is retyped, and not just dirty, when at least this share of its values does not parse.
RETYPED_PCT = 50
# A renamed column shares at least this part of the smaller column's distinct values.
RENAMED_SHARE = 0.5


def _is_written_as(value: Column, kind: str) -> Column:
    return F.coalesce(value.rlike(_WRITTEN_AS[kind]) & value.try_cast(kind).isNotNull(), F.lit(False))


def _kinds_written(value: Column) -> Column:
    """The types of the lattice in which a value is written, as bits; NULL for NULL.

    Plain numbers, dates and words are told by one short pattern each, so only odd values are tried
    as every type.
    """
    bit = {kind: 1 << i for i, kind in enumerate(_WRITTEN_AS)}
    fraction = bit["decimal(38,10)"] | bit["double"]
    anything = reduce(Column.__add__, [F.when(_is_written_as(value, kind), b).otherwise(0)
                                       for kind, b in bit.items()])
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(value.rlike(r"^[+-]?\d{1,9}\z"), fraction | bit["int"] | bit["bigint"])
        .when(value.rlike(r"^[+-]?\d{1,25}\.\d{1,10}\z"), fraction)
        .when(value.rlike(r"^[^0-9+.tTfF-]"), 0)  # no type is written with such a first character
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}\z"),
              F.when(value.try_cast("date").isNotNull(), bit["date"]).otherwise(0))
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\z"),
              F.when(value.try_cast("timestamp_ntz").isNotNull(), bit["timestamp_ntz"]).otherwise(0))
        .otherwise(anything)
    )


def _readable(value: Column, kind: T.DataType) -> Column:
    """Whether a cast reads the text; a word is told before it, for a failed cast costs an exception."""
    read = value.try_cast(kind).isNotNull()
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType)):
        return F.when(value.rlike("^[A-Za-z]"), F.lit(False)).otherwise(read)
    return read


def _written_kind(declared: T.DataType) -> str | None:
    """The type in the lattice whose text form values of the declared type have."""
    if isinstance(declared, T.DecimalType):
        return "decimal(38,10)"
    name = declared.simpleString()
    return name if name in _WRITTEN_AS else None


def column_types(raw: DataFrame, declared: T.StructType | None = None) -> DataFrame:
    """(column_name, n_values, narrowest, parsed) of every text column, in one pass.

    ``narrowest`` is the first type of the lattice that all values have, else string; NULL for a
    column without values. ``parsed`` counts the values that have the declared type.
    """
    return _column_measures(raw, declared).drop("unreadable")


def _column_measures(raw: DataFrame, declared: T.StructType | None = None) -> DataFrame:
    """:func:`column_types`, and ``unreadable``: the values that no cast makes the declared type."""
    wanted = {f.name: f.dataType for f in declared} if declared else {}
    places = {kind: k for k, kind in enumerate(_WRITTEN_AS)}
    kinds = [_written_kind(wanted[c]) if c in wanted else None for c in raw.columns]
    # Values go one by one through one copy of the tests: a copy for each column makes a method that
    # the JVM never compiles.
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("value"))
                                for i, c in enumerate(raw.columns)]))
    i, value, written = F.col("i"), F.col("value"), F.col("written")
    readable = value.isNotNull()
    for kind in dict.fromkeys(wanted.values()):
        places_of = [n for n, c in enumerate(raw.columns) if wanted.get(c) == kind]
        if places_of:
            readable = F.when(i.isin(places_of), _readable(value, kind)).otherwise(readable)
    bit = F.element_at(F.array(*[F.lit(1 << places[k] if k else 0) for k in kinds]), i + 1)
    good = F.when(bit == 0, value.isNotNull()).otherwise(F.col("readable") & (written.bitwiseAND(bit) > 0))
    counted = (
        raw.select(cells.alias("cell")).select("cell.*")
        .select("i", "value", _kinds_written(value).alias("written"), readable.alias("readable"))
        .groupBy("i").agg(F.count("value").alias("n"), F.bit_and("written").alias("t"),
                          F.count_if(good).alias("p"),
                          F.count_if(value.isNotNull() & ~F.col("readable")).alias("u"))
    )
    by_column = counted.agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("n", "t", "p", "u")))).alias("m"))

    def of(i: int, metric: str) -> Column:
        return F.coalesce(F.col("m")[i][metric], F.lit(0))

    def narrowest(i: int) -> Column:
        found = F.coalesce(*[F.when(of(i, "t").bitwiseAND(1 << k) > 0, kind)
                             for kind, k in places.items()], F.lit("string"))
        return F.when(of(i, "n") > 0, found)

    return by_column.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), of(i, "n").alias("n_values"),
                 narrowest(i).alias("narrowest"), of(i, "p").alias("parsed"), of(i, "u").alias("unreadable"))
        for i, name in enumerate(raw.columns)])))


def retyped_columns(raw: DataFrame, declared: T.StructType) -> DataFrame:
    """(column_name, declared, narrowest, n_values, parsed) of delivered columns of another type.

    A column is retyped when at least ``RETYPED_PCT`` percent of its values are not written as the
    declared type; fewer bad values are a dirty column (see :func:`type_violations`). Text is
    never retyped, and neither is a column without values.
    """
    kinds = {f.name: f.dataType.simpleString() for f in declared if f.name in raw.columns}
    present = raw.select([F.col(f"`{c}`") for c in kinds])
    named = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return column_types(present, declared).filter(_retyped()).select(
        "column_name", named[F.col("column_name")].alias("declared"), "narrowest", "n_values", "parsed")


def _retyped() -> Column:
    bad = F.col("n_values") - F.col("parsed")
    return (bad > 0) & (bad * 100 >= F.col("n_values") * RETYPED_PCT)


def column_sketches(df: DataFrame, columns: Sequence[str]) -> list[dict]:
    """A sketch of each column's values, in one pass: HyperLogLog, counts, lengths, smallest and largest."""
    def texts(name: str) -> Column:
        return F.col(f"`{name}`").cast("string")

    metrics = [m for i, c in enumerate(columns) for m in (
        F.hll_sketch_agg(F.coalesce(texts(c), F.lit("")), F.lit(14)).alias(f"s{i}"),
        F.count(texts(c)).alias(f"n{i}"), F.min(F.length(texts(c))).alias(f"a{i}"),
        F.max(F.length(texts(c))).alias(f"b{i}"), F.min(texts(c)).alias(f"x{i}"), F.max(texts(c)).alias(f"y{i}"))]
    if not columns:
        return []
    row = df.agg(*metrics).first()  # a few kB per column
    names = {"sketch": "s", "values": "n", "shortest": "a", "longest": "b", "smallest": "x", "largest": "y"}
    return [{"column": c, **{n: row[f"{k}{i}"] for n, k in names.items()}} for i, c in enumerate(columns)]


def _alike(a: Mapping, b: Mapping) -> bool:
    """Lengths and values in overlapping ranges: what a column of new values keeps."""
    if not a["values"] or not b["values"]:
        return False
    return (a["shortest"] <= b["longest"] and b["shortest"] <= a["longest"]
            and a["smallest"] <= b["largest"] and b["smallest"] <= a["largest"])


def renamed_columns(known: DataFrame, delivered: DataFrame) -> DataFrame:
    """(column_name, renamed_to, shared) of columns that came under another name.

    ``known`` is an earlier delivery, or the published table, under the declared names. A column that
    is missing now and one that was added are paired when their sketches share ``RENAMED_SHARE`` of
    the smaller's distinct values and their lengths and ranges overlap; the pair that shares most
    comes first, and a column is in one pair only. The pairs are as many as missing times added
    columns, whatever the rows.
    """
    spark = known.sparkSession
    missing = [c for c in known.columns if c not in delivered.columns]
    added = [c for c in delivered.columns if c not in known.columns]
    pairs = [(a["column"], b["column"], bytes(a["sketch"]), bytes(b["sketch"]))
             for a in (column_sketches(known, missing) if added else [])
             for b in column_sketches(delivered, added) if _alike(a, b)] if missing and added else []
    if not pairs:
        return spark.createDataFrame([], "column_name string, renamed_to string, shared double")
    sketched = spark.createDataFrame(pairs, "column_name string, renamed_to string, a binary, b binary")
    one, two = (F.hll_sketch_estimate(c) for c in ("a", "b"))
    both = one + two - F.hll_sketch_estimate(F.hll_union("a", "b"))
    shared = F.greatest(F.lit(0.0), both / F.least(one, two))
    rows = sketched.select("column_name", "renamed_to", shared.alias("shared")).filter(
        F.col("shared") >= RENAMED_SHARE).collect()
    chosen, used = [], set()
    for old, new, share in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if old not in used and new not in used:
            chosen.append((old, new, share))
            used |= {old, new}
    return spark.createDataFrame(chosen, "column_name string, renamed_to string, shared double")


def delivery_drift(raw: DataFrame, declared: T.StructType, known: DataFrame | None = None) -> DataFrame:
    """(finding, column_name, n, breaking) of a delivered text file against the declared feed.

    ``renamed`` stands for a pair of a missing and an added column (``old -> new``) and needs an
    earlier delivery to compare with; ``retyped`` and ``not parsed`` count the values that do not parse.
    """
    renames = {}
    if known is not None:
        renames = {r["column_name"]: r["renamed_to"] for r in renamed_columns(known, raw).collect()}
    named = raw.withColumnsRenamed({new: old for old, new in renames.items()})
    header = T.StructType([
        next((f for f in declared if f.name == c), T.StructField(c, T.StringType())) for c in named.columns])
    found = [(f"{old} -> {new}", "renamed", True) for old, new in renames.items()]
    found += [d for d in schema_drift(declared, header) if d[1] in ("missing", "added")]
    rows = [(change, column, 1, breaking) for column, change, breaking in found]
    kinds = "finding string, column_name string, n long, breaking boolean"
    present = T.StructType([f for f in declared if f.name in named.columns])
    # retyped and dirty columns are told apart by the counts of one pass over the file
    measures = _column_measures(named.select([F.col(f"`{c}`") for c in present.names]), present)
    bad = F.when(_retyped(), F.struct(F.lit("retyped").alias("finding"),
                                      (F.col("n_values") - F.col("parsed")).alias("n")))
    bad = F.coalesce(bad, F.when(F.col("unreadable") > 0, F.struct(
        F.lit("not parsed").alias("finding"), F.col("unreadable").alias("n"))))
    broken = measures.withColumn("bad", bad).filter("bad IS NOT NULL").select(
        "bad.finding", "column_name", "bad.n", F.lit(True).alias("breaking"))
    return raw.sparkSession.createDataFrame(rows, kinds).unionByName(broken)


def type_violations(raw: DataFrame, declared: T.StructType) -> DataFrame:
    """(column_name, bad_rows) of text values that do not parse as declared."""
    counts = raw.agg(*[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        .alias(f.name)
        for f in declared
    ])
    return counts.unpivot([], declared.names, "column_name", "bad_rows")


def schema_drift(declared: T.StructType, incoming: T.StructType) -> list[tuple[str, str, bool]]:
    """(column, change, breaking) between the declared and a delivered schema.

    Missing, retyped or moved columns break consumers, and so does a required
    extra column; an optional one at the end does not. A rename shows as one
    missing and one added column.
    """
    found = {f.name: (i, f) for i, f in enumerate(incoming)}
    drift = []
    for i, f in enumerate(declared):
        if f.name not in found:
            drift.append((f.name, "missing", True))
        elif found[f.name][1].dataType != f.dataType:
            drift.append((f.name, "retyped", True))
        elif found[f.name][0] != i:
            drift.append((f.name, "moved", True))
    last = max((i for name, (i, _) in found.items() if name in declared.names), default=-1)
    for name, (i, f) in found.items():
        if name not in declared.names:
            trailing = i > last
            drift.append((name, "added", not (trailing and f.nullable)))
    return drift


def file_arrivals(spark: SparkSession, landing: str) -> DataFrame:
    """(feed, file, arrived) of the files under ``<landing>/<feed>/``; ``arrived`` is UTC.

    The times are those of the file system; no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("at"))
    folder = landing.rstrip("/").rpartition("/")[2]
    feed = F.element_at(F.split(F.substring_index("file", f"/{folder}/", -1), "/"), 1)
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("at").cast("timestamp_ntz"))
    return files.select(feed.alias("feed"), "file", utc.alias("arrived"))


def delivery_status(log: DataFrame, feed: str, arrived: str) -> DataFrame:
    """Per feed and UTC day: deliveries, first arrival and whether it was on time.

    ``arrived`` is a UTC wall-clock timestamp without time zone.
    """
    daily = (
        log.select(feed, F.to_date(arrived).alias("delivery_date"),
                   F.col(arrived).cast("timestamp_ntz").alias("arrived"))
        .groupBy(feed, "delivery_date")
        .agg(F.count("*").alias("deliveries"), F.min("arrived").alias("first_arrival"))
    )

    def at(hour: int) -> Column:
        return F.col("delivery_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour))

    status = (
        F.when(F.col("first_arrival") <= at(DUE_HOUR), "on_time")
        .when(F.col("first_arrival") <= at(LATE_HOUR), "past_due")
        .otherwise("late")
    )
    return daily.withColumn("status", status)


def delivery_summary(log: DataFrame, feed: str, arrived: str) -> DataFrame:
    """Feed days per status, and how often more than one file came."""
    return delivery_status(log, feed, arrived).groupBy("status").agg(
        F.count("*").alias("feed_days"),
        F.count_if(F.col("deliveries") > 1).alias("more_than_one_file"),
    )


def missed_days(log: DataFrame, feed: str, arrived: str) -> DataFrame:
    """Feeds with days lacking a delivery between their first and last one."""
    day = F.to_date(arrived)
    return (
        log.groupBy(feed)
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"),
             F.count_distinct(day).alias("days_delivered"))
        .withColumn("days_missed",
                    F.date_diff("last_day", "first_day") + 1 - F.col("days_delivered"))
        .filter("days_missed > 0")
    )
