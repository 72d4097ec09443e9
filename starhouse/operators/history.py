"""Type 2 passenger history: expire changed versions, open new ones, check the result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.operators.checks import column_violations, require_empty
from starhouse.operators.keys import assign_keys
from starhouse.schemas import FIRST_EFFECTIVE, OPEN_ENDED, PASSENGER_UPDATES, TRACKED


def _differs(old: str, new: str, null_safe: bool) -> Column:
    if null_safe:
        return ~F.col(old).eqNullSafe(F.col(new))
    return F.col(old) != F.col(new)


def _changed(null_safe: bool) -> Column:
    """Any tracked attribute differs from its staged ``new_`` value.

    By default a NULL on either side is not a change of that attribute.
    """
    tests = [_differs(c, f"new_{c}", null_safe) for c in TRACKED]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def _staged_values(staged: DataFrame) -> DataFrame:
    return staged.select("passenger_id", *[F.col(c).alias(f"new_{c}") for c in TRACKED])


def adopt(versions: DataFrame, first_effective: str = FIRST_EFFECTIVE) -> DataFrame:
    """Prepare a dimension loaded under the older column names for change feeds.

    ``effective_date`` and ``expiry_date`` become ``effective_from`` and
    ``effective_to``, and every version present starts at ``first_effective``.
    A dimension that holds history already is refused: its versions would all
    start on one day.
    """
    twice = versions.groupBy("passenger_id").count().filter("count > 1")
    require_empty(twice, "adopted dimension holds history")
    return versions.withColumnsRenamed(
        {"effective_date": "effective_from", "expiry_date": "effective_to"}
    ).withColumn("effective_from", F.lit(first_effective).cast("date"))


def expire(
    versions: DataFrame, staged: DataFrame, load_date: str, null_safe: bool = False
) -> DataFrame:
    """Step 1: close the current version of every passenger whose tracked values changed.

    Needs one staged row per passenger (see :func:`feed_problems`). Closed
    versions and passengers missing from the feed pass through without a join.
    """
    columns = versions.columns
    flagged = (
        versions.filter("is_current")
        .join(_staged_values(staged), "passenger_id", "left")
        .withColumn("_changed", _changed(null_safe))
    )
    day_before = F.date_sub(F.lit(load_date).cast("date"), 1)
    closed = flagged.withColumns({
        "is_current": ~F.col("_changed"),
        "effective_to": F.when(F.col("_changed"), day_before).otherwise(F.col("effective_to")),
    }).select(*columns)
    return versions.filter("NOT is_current").unionByName(closed)


def new_versions(
    versions: DataFrame, staged: DataFrame, load_date: str, null_safe: bool = False,
    highest: int | None = None,
) -> DataFrame:
    """Step 2: the rows to insert, given the versions *before* step 1.

    Every staged passenger without a current version left after expiry gets one
    from ``load_date`` on. The signup date is carried over from older versions;
    brand-new passengers have none. ``highest`` is the highest key handed out so
    far; with it, ``versions`` need only hold the passengers of the feed.
    """
    surviving = (
        versions.filter("is_current")
        .join(_staged_values(staged), "passenger_id")
        .filter(~_changed(null_safe))
        .select("passenger_id")
    )
    signups = (
        versions.select("passenger_id", "signup_date")
        .join(staged.select("passenger_id"), "passenger_id", "left_semi")
        .groupBy("passenger_id")
        .agg(F.max("signup_date").alias("signup_date"))
    )
    rows = (
        staged.join(surviving, "passenger_id", "left_anti")
        .join(signups, "passenger_id", "left")
        .select(
            "passenger_id", "passenger_name", "home_airport_code", "frequent_flyer_tier",
            "signup_date",
            F.lit(load_date).cast("date").alias("effective_from"),
            F.lit(OPEN_ENDED).cast("date").alias("effective_to"),
            F.lit(True).alias("is_current"),
        )
    )
    if highest is None:
        highest = versions.agg(F.coalesce(F.max("passenger_key"), F.lit(0)).alias("k")).first()["k"]
    return assign_keys(rows, ["passenger_id"], "passenger_key", first=highest + 1,
                       at_most=staged.count())


def apply_feed(
    versions: DataFrame, staged: DataFrame, load_date: str, null_safe: bool = False
) -> DataFrame:
    """Both steps: the whole dimension after one change feed."""
    return expire(versions, staged, load_date, null_safe).unionByName(
        new_versions(versions, staged, load_date, null_safe)
    )


def feed_problems(
    versions: DataFrame, staged: DataFrame, load_date: str, null_safe: bool = False
) -> DataFrame:
    """What would corrupt history, as (problem, passengers) counts.

    ``staged_twice``: one passenger in several staged rows. ``already_loaded``:
    a changed passenger whose current version starts on or after the load date,
    which would end before it starts.
    """
    twice = (
        staged.groupBy("passenger_id").count().filter("count > 1")
        .agg(F.count("*").alias("passengers"))
    )
    late = (
        versions.filter(F.col("is_current") & (F.col("effective_from") >= F.lit(load_date)))
        .join(_staged_values(staged), "passenger_id")
        .filter(_changed(null_safe))
        .agg(F.count_distinct("passenger_id").alias("passengers"))
    )
    return twice.select(F.lit("staged_twice").alias("problem"), "passengers").unionByName(
        late.select(F.lit("already_loaded").alias("problem"), "passengers")
    )


def feed_rules(staged: DataFrame) -> DataFrame:
    """(rule, column_name, violations) of the feed's own columns: NULLs and text lengths."""
    return column_violations(PASSENGER_UPDATES, staged)


def require_sound_history(versions: DataFrame) -> None:
    """Refuse versions that overlap, repeat or end before they start; gaps are allowed."""
    broken = history_violations(versions).filter("violations > 0 AND rule <> 'gap'")
    require_empty(broken, "history is not sound")


def version_totals(versions: DataFrame) -> DataFrame:
    return versions.agg(
        F.count("*").alias("total_rows"),
        F.count_if("is_current").alias("current_rows"),
        F.count_if(~F.col("is_current")).alias("expired_rows"),
    )


def changed_versions(versions: DataFrame, versions_each: int = 2, limit: int = 6) -> DataFrame:
    """The first rows, by passenger, of those with exactly ``versions_each`` versions."""
    ids = (
        versions.groupBy("passenger_id").count()
        .filter(F.col("count") == versions_each)
        .select("passenger_id")
    )
    return (
        versions.join(ids, "passenger_id", "left_semi")
        .select("passenger_key", "passenger_id", "frequent_flyer_tier", "home_airport_code",
                "effective_from", "effective_to", "is_current")
        .orderBy("passenger_id", "effective_from")
        .limit(limit)
    )


def members_from(versions: DataFrame, first_id: int) -> DataFrame:
    """Version count and current flag of passengers numbered from ``first_id``."""
    return (
        versions.filter(F.col("passenger_id") >= first_id)
        .groupBy("passenger_id")
        .agg(F.count("*").alias("versions"),
             F.max(F.col("is_current").cast("int")).alias("is_current"))
    )


def change_breakdown(versions: DataFrame, staged: DataFrame) -> DataFrame:
    """How many current passengers the feed changes: tier only, home only, both."""
    tier, home = (F.coalesce(_differs(c, f"new_{c}", False), F.lit(False)) for c in TRACKED)
    return (
        versions.filter("is_current")
        .join(_staged_values(staged), "passenger_id")
        .agg(
            F.count_if(tier & ~home).alias("tier_only"),
            F.count_if(home & ~tier).alias("home_only"),
            F.count_if(tier & home).alias("both_changed"),
        )
    )


def history_violations(versions: DataFrame) -> DataFrame:
    """Broken Type 2 rules as (rule, violations); all zero on a sound dimension.

    Versions are first reduced to one row per (passenger, start date), with
    map-side combining, so the window group of a passenger is at most one row
    per calendar day even if that passenger holds most of the table.
    """
    starts = versions.groupBy("passenger_id", "effective_from").agg(
        F.count("*").alias("rows"),
        F.max("effective_to").alias("ends"),
        F.count_if(F.col("effective_from") > F.col("effective_to")).alias("reversed"),
    )
    following = Window.partitionBy("passenger_id").orderBy("effective_from")
    shape = starts.withColumn("next", F.lead("effective_from").over(following)).agg(
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("same_start"),
        F.coalesce(F.sum("reversed"), F.lit(0)).alias("ends_before_start"),
        F.count_if(F.col("next") <= F.col("ends")).alias("overlap"),
        F.count_if(F.col("next") > F.date_add("ends", 1)).alias("gap"),
    )
    current = (
        versions.groupBy("passenger_id")
        .agg(F.count_if("is_current").alias("n"))
        .agg(F.count_if(F.col("n") != 1).alias("not_one_current"))
    )
    flags = versions.agg(
        F.count_if(
            F.col("is_current") != (F.col("effective_to") == F.lit(OPEN_ENDED).cast("date"))
        ).alias("flag_and_end_disagree")
    )
    parts = [df.unpivot([], df.columns, "rule", "violations") for df in (shape, current, flags)]
    return reduce(DataFrame.unionByName, parts)
