"""Load validation and profiling."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.schemas import LENGTHS, TABLES, LoadError, Reference, Table

# The error codes of the two load gates.
COUNT_MISMATCH = 50001
UNRESOLVED_ROWS = 50002
# Rows of a table, on average, whose keys one task compares.
KEYS_PER_TASK = 1_000_000


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, layer, row_count) of every table given."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(TABLES[name].layer if name in TABLES else None).cast("string").alias("layer"),
            "row_count",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def resolved_rows(
    fact: DataFrame, dims: Mapping[str, DataFrame], table: Table = TABLES["fact_ticket_sales"]
) -> DataFrame:
    """One row: fact rows, and how many of them join to every referenced dimension.

    Only key columns are read. A duplicated dimension key shows as more
    resolved rows than fact rows.
    """
    keys = fact.select(*[r.column for r in table.references])
    joined = keys
    for ref in table.references:
        parent = dims[ref.table].select(F.col(ref.key).alias(ref.column))
        joined = joined.join(parent, ref.column)
    return joined.agg(F.count("*").alias("resolved_rows"), F.lit(0).alias("fact_rows")).unionByName(
        keys.agg(F.lit(0).alias("resolved_rows"), F.count("*").alias("fact_rows"))
    ).agg(F.sum("fact_rows").alias("fact_rows"), F.sum("resolved_rows").alias("resolved_rows"))


def resolved_by_reference(
    fact: DataFrame, dims: Mapping[str, DataFrame], table: Table = TABLES["fact_ticket_sales"]
) -> DataFrame:
    """(rule, fact_rows, resolved_rows) per reference, in one pass over the fact.

    Rows are counted per reference and key before they meet the parents, so the fact is shuffled
    as counts and no reference joins its rows. A lost or NULL key shows as fewer resolved rows, a
    parent key that repeats as more.
    """
    refs = table.references
    used = _values(fact, refs)
    listed = _parents(fact, refs, dims).groupBy("number", "value").agg(F.count("*").alias("times"))
    named = [f"{r.column} in {r.table}" for r in refs]
    resolved = F.sum(F.col("row_count") * F.coalesce("times", F.lit(0)))
    return used.join(listed, ["number", "value"], "left").groupBy("number").agg(
        F.sum("row_count").alias("fact_rows"), resolved.alias("resolved_rows"),
    ).select(F.element_at(F.array(*map(F.lit, named)), F.col("number") + 1).alias("rule"),
             "fact_rows", "resolved_rows")


def not_loaded(bookings: DataFrame, fact: DataFrame) -> DataFrame:
    """Ids of bookings that did not reach the fact."""
    return bookings.select("booking_id").join(fact.select("booking_id"), "booking_id", "left_anti")


def measure_totals(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(src, fare, tax, miles) per source; the rows should agree."""
    totals = [
        df.agg(
            F.sum("fare_amount").cast("decimal(38,2)").alias("fare"),
            F.sum("tax_amount").cast("decimal(38,2)").alias("tax"),
            F.sum(F.col("miles_earned").cast("bigint")).alias("miles"),
        ).select(F.lit(name).alias("src"), "fare", "tax", "miles")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, totals)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the row count."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child values without a parent, with the number of child rows.

    Child rows are counted per value first, so a hot value travels as one row.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("row_count"))
    )
    return used.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def column_violations(table: Table, df: DataFrame) -> DataFrame:
    """(rule, column_name, violations) of the table's column rules, all in one pass.

    Rules are ``not null``, ``allowed values`` and ``length``; the last applies to
    text columns only.
    """
    text = {name for name, kind in df.dtypes if kind == "string"}
    rules = [("not null", c, F.col(c).isNull()) for c in table.required]
    rules += [
        ("allowed values", c, ~F.col(c).isin(list(values))) for c, values in table.allowed.items()
    ]
    rules += [
        ("length", c, ~F.length(c).between(*LENGTHS[c]))
        for c in table.schema.names if c in LENGTHS and c in text
    ]
    counts = df.agg(*[F.count_if(broken).alias(str(i)) for i, (_, _, broken) in enumerate(rules)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"),
                 F.col(str(i)).alias("violations"))
        for i, (rule, column, _) in enumerate(rules)
    ])))


def key_violations(table: Table, df: DataFrame) -> DataFrame:
    """(rule, violations) of the table's keys: rows that share a key, all keys in one pass.

    Keys travel in their own columns and types, and uncounted, as nearly every one occurs once: a
    task would hold all its keys and combine none. ``KEYS_PER_TASK`` of them meet in a task.
    """
    keys = [k for k in (table.key, *table.unique) if k]
    columns = list(dict.fromkeys(c for key in keys for c in key))
    kinds = {c: df.schema[c].dataType for c in columns}
    pairs = F.array(*(
        F.struct(F.lit(i).alias("number"),
                 *[(F.col(c) if c in key else F.lit(None).cast(kinds[c])).alias(c) for c in columns])
        for i, key in enumerate(keys)))
    tasks = -(-df.count() * len(keys) // KEYS_PER_TASK) or 1
    rows = df.select(F.explode(pairs).alias("p")).select("p.*")
    twice = (rows.repartition(tasks, "number", *columns).groupBy("number", *columns)
             .agg(F.count("*").alias("row_count")).filter("row_count > 1"))
    return _by_rule(df, [f"unique {', '.join(key)}" for key in keys], twice)


def reference_violations(
    table: Table, df: DataFrame, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """(rule, violations) of the table's references: rows without a parent, all in one pass.

    Rows are counted per reference and value first, so a hot value travels as
    one row; one anti join against the union of the parents finds the lost ones.
    """
    refs = table.references
    used = _values(df, refs).filter(F.col("value").isNotNull())
    lost = used.join(_parents(df, refs, tables), ["number", "value"], "left_anti")
    return _by_rule(df, [f"{r.column} in {r.table}" for r in refs], lost)


def _values(df: DataFrame, refs: Sequence[Reference]) -> DataFrame:
    """(number, value, row_count): how often each of the numbered references has each value."""
    kind = _kind(df, refs)
    pairs = F.array(*(F.struct(F.lit(i).alias("number"), F.col(r.column).cast(kind).alias("value"))
                      for i, r in enumerate(refs)))
    return (df.select(F.explode(pairs).alias("p")).select("p.*")
            .groupBy("number", "value").agg(F.count("*").alias("row_count")))


def _parents(df: DataFrame, refs: Sequence[Reference], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(number, value) of all rows that the numbered references may lead to."""
    return reduce(DataFrame.unionByName, [
        tables[r.table].select(F.lit(i).alias("number"), F.col(r.key).cast(_kind(df, refs)).alias("value"))
        for i, r in enumerate(refs)
    ])


def _kind(df: DataFrame, refs: Sequence[Reference]) -> str:
    """The one type in which the references' values are compared: whole numbers stay numbers."""
    whole = all(isinstance(df.schema[r.column].dataType, T.IntegralType) for r in refs)
    return "bigint" if whole else "string"


def _by_rule(df: DataFrame, rules: Sequence[str], broken: DataFrame) -> DataFrame:
    named = df.sparkSession.range(len(rules)).select(
        F.col("id").cast("int").alias("number"),
        F.element_at(F.array(*map(F.lit, rules)), (F.col("id") + 1).cast("int")).alias("rule"))
    counts = broken.groupBy("number").agg(F.sum("row_count").alias("violations"))
    return named.join(counts, "number", "left").select(
        "rule", F.coalesce("violations", F.lit(0)).alias("violations"))


def fan_out(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """Rows before and after the left join of bookings to flights.

    Both sides are counted per flight and the counts multiplied, so nothing is
    expanded even when a flight is repeated.
    """
    booked = bookings.groupBy("flight_id").agg(F.count("*").alias("n"))
    listed = flights.groupBy("flight_id").agg(F.count("*").alias("m"))
    return booked.join(listed, "flight_id", "left").agg(
        F.sum("n").alias("bookings"),
        F.sum(F.col("n") * F.coalesce("m", F.lit(1))).alias("joined_rows"),
        F.sum(F.when(F.col("m").isNull(), F.col("n")).otherwise(0)).alias("without_flight"),
    )


def dependency_violations(
    df: DataFrame, determinant: Sequence[str], dependent: str
) -> DataFrame:
    """Determinant values with more than one dependent value."""
    return (
        df.select(*determinant, dependent).distinct()
        .groupBy(*determinant).agg(F.count("*").alias("distinct_values"))
        .filter("distinct_values > 1")
    )


def repeated_pairs(bookings: DataFrame) -> DataFrame:
    """Passenger and flight pairs booked more than once."""
    return duplicate_keys(bookings, ["passenger_id", "flight_id"])


def booked_before_signup(bookings: DataFrame, passengers: DataFrame) -> DataFrame:
    return (
        bookings.select("passenger_id", "booking_date")
        .join(passengers.select("passenger_id", "signup_date"), "passenger_id")
        .agg(
            F.count("*").alias("bookings"),
            F.count_if(F.col("booking_date") < F.col("signup_date")).alias("before_signup"),
        )
    )


# Gates ------------------------------------------------------------------------------------


def require_same_count(bookings: DataFrame, fact: DataFrame) -> None:
    if bookings.count() != fact.count():
        raise LoadError("fact and bookings feed differ in row count", COUNT_MISMATCH)


def require_resolved(fact: DataFrame, dims: Mapping[str, DataFrame]) -> None:
    wrong = resolved_by_reference(fact, dims).filter("resolved_rows <> fact_rows").collect()
    if wrong:  # at most one row per reference
        told = ", ".join(f"{r['rule']}: {r['resolved_rows']} of {r['fact_rows']} rows" for r in wrong)
        raise LoadError(f"fact rows do not resolve to one row of each dimension: {told}",
                        UNRESOLVED_ROWS)


def outcome(gate: Callable[[], None]) -> tuple[int | None, str]:
    """(error code, ``passed`` or ``refused``) of one gate."""
    try:
        gate()
    except LoadError as error:
        return error.code, "refused"
    return None, "passed"


def require_empty(df: DataFrame, message: str) -> None:
    """Raise with one example row if the frame has any."""
    example = df.first()
    if example is not None:
        raise LoadError(f"{message}, e.g. {example.asDict()}")


def require_table_rules(
    table: Table, df: DataFrame, tables: Mapping[str, DataFrame] | None = None
) -> None:
    """Column rules, keys and references as declared for the table."""
    broken = column_violations(table, df).filter("violations > 0")
    require_empty(broken, f"{table.name}: broken column rule")
    if table.key:
        repeats = key_violations(table, df).filter("violations > 0")
        require_empty(repeats, f"{table.name}: a key repeats")
    if tables and table.references:
        lost = reference_violations(table, df, tables).filter("violations > 0")
        require_empty(lost, f"{table.name}: a reference leads nowhere")
