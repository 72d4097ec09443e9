"""The daily change feed as a file stream.

Feed files land under ``<landing>/load_date=YYYY-MM-DD``. Each run takes the
files that are new since the last one and applies them, one load date after
the other, through the same batch path; Spark's checkpoint remembers which
files are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.plans import warehouse
from starhouse.sources.store import Store


def land(staged: DataFrame, landing: str, load_date: str) -> None:
    """Place one day's feed where the stream looks for it."""
    staged.write.parquet(f"{landing}/load_date={load_date}")


def run(spark: SparkSession, landing: str, root: str, progress: str) -> None:
    """Apply every feed not yet applied, then stop."""
    schema = spark.read.parquet(landing).drop("load_date").schema.add("load_date", "date")
    query = (
        spark.readStream.schema(schema).parquet(landing)
        .writeStream.foreachBatch(lambda batch, number: apply_batch(batch, number, root))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def digest(staged: DataFrame) -> str:
    """Row count and order-free sums of two row hashes; NULLs count with the column they stand in."""
    row = F.to_json(F.struct(*sorted(staged.columns)), {"ignoreNullFields": "false"})
    hashes = [F.xxhash64(row), F.xxhash64(F.lit("second"), row)]
    sums = staged.agg(F.count("*"), *(F.sum(h.cast("decimal(38,0)")) for h in hashes)).first()
    return " ".join(str(v) for v in sums)


def apply_batch(batch: DataFrame, number: int, root: str) -> None:
    """Apply the feeds of a micro-batch in load-date order (one row per date is collected).

    Each applied feed is registered under its date with a digest of its rows. A
    batch replayed after a failure skips the feeds it had already published, by
    whichever stream they come and whatever its checkpoint remembers; a feed
    with other rows on the same date is applied, or refused by the feed checks.
    """
    spark = batch.sparkSession
    store = Store(spark, root)
    for (day,) in batch.select("load_date").distinct().orderBy("load_date").collect():
        staged = batch.filter(F.col("load_date") == F.lit(day)).drop("load_date")
        key = digest(staged)
        if not store.applied(day.isoformat(), key):
            warehouse.apply_changes(spark, root, staged, day.isoformat(), digest=key)
