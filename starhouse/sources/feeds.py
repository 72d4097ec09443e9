"""Reading feed files and turning them into typed frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.functions.numbers import finer_than
from starhouse.schemas import FEEDS, LoadError, Table


@dataclass(frozen=True)
class Feeds:
    """The five feeds of a full load."""

    bookings: DataFrame
    flights: DataFrame
    passengers: DataFrame
    airports: DataFrame
    aircraft: DataFrame

    def by_table(self) -> dict[str, DataFrame]:
        return {f"bronze_{name}": df for name, df in vars(self).items()}

    @classmethod
    def of_tables(cls, tables: dict[str, DataFrame]) -> Feeds:
        return cls(**{name.removeprefix("bronze_"): df for name, df in tables.items()})


_CSV = {"header": True, "mode": "FAILFAST", "enforceSchema": False, "dateFormat": "yyyy-MM-dd",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def delivered_schema(spark: SparkSession, path: str, feed: Table) -> T.StructType:
    """The columns a feed file names, declared ones in their declared type, others as text.

    ``operators.contract.schema_drift`` compares it with the declared schema.
    """
    declared = {f.name: f for f in feed.schema}
    header = spark.read.options(header=True).csv(path).columns
    return T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])


def read_csv_feed(spark: SparkSession, path: str, feed: Table) -> DataFrame:
    """A feed file in its declared types.

    Columns are found by name and extra ones ignored; a missing column, a value
    that does not parse or an amount with too many decimals stops the read.
    """
    schema = delivered_schema(spark, path, feed)
    missing = [c for c in feed.schema.names if c not in schema.names]
    if missing:
        raise LoadError(f"{feed.name}: no column {', '.join(missing)} in {path}")
    # The CSV reader would round amounts to the declared scale without a word: read them as text.
    wide = T.StructType([
        T.StructField(f.name, T.StringType() if _is_amount(f) else f.dataType) for f in schema
    ])
    return conform(spark.read.schema(wide).options(**_CSV).csv(path), feed)


def _is_amount(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.DecimalType)


def _exact(field: T.StructField, given: T.DataType) -> Column:
    """The value in the declared type; raises where the cast would change it."""
    value, kind = F.col(field.name), field.dataType
    cast = value.cast(kind)
    if given == kind or not isinstance(given, (T.NumericType, T.StringType)):
        return cast.alias(field.name)
    if isinstance(kind, T.DecimalType):
        lossy = finer_than(value, kind.scale)
    elif isinstance(kind, T.IntegralType) and not isinstance(given, T.IntegralType):
        lossy = finer_than(value, 0)
    else:
        return cast.alias(field.name)
    scale = getattr(kind, "scale", 0)
    told = F.concat(F.lit(f"{field.name} has more than {scale} decimals: "), value.cast("string"))
    return F.when(lossy, F.raise_error(told)).otherwise(cast).alias(field.name)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """A feed file as text, unchanged, for the contract checks to judge."""
    header = spark.read.options(header=True).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(text).options(**_CSV).csv(path)


def read_parquet_feed(spark: SparkSession, path: str, feed: Table) -> DataFrame:
    return conform(spark.read.parquet(path), feed)


def conform(df: DataFrame, feed: Table) -> DataFrame:
    """The declared columns in their declared types; extra columns are ignored.

    Casts are strict: a value that does not parse or fit raises under ANSI mode,
    and so does one that the declared type would round.
    """
    return df.select(*[_exact(f, df.schema[f.name].dataType) for f in feed.schema])


def read_feeds(spark: SparkSession, folder: str) -> Feeds:
    """The five feeds as ``<folder>/<table>.csv``."""
    def read(name: str) -> DataFrame:
        return read_csv_feed(spark, f"{folder}/{name}.csv", FEEDS[name])

    return Feeds(
        bookings=read("bronze_bookings"),
        flights=read("bronze_flights"),
        passengers=read("bronze_passengers"),
        airports=read("bronze_airports"),
        aircraft=read("bronze_aircraft"),
    )
