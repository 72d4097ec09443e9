"""Blocks of documents and buckets of hashes: how rows of packed hashes travel.

A block is a hash-dealt set of whole documents that one task opens at a time, a bucket is a range of
hashes. What a block says about its hashes leaves it as one packed row per bucket, with equal
hashes of the block combined, so a hash that a third of all rows hold costs a bucket one entry
per block. Blocks are dealt by content, so a block is the same set of rows whenever it is opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.session import stored

SMALLEST_BLOCK = 2 << 20
LARGEST_BLOCK = 256 << 20
MOST_SMALL_BLOCKS = 4096
BUCKET_BYTES = 8 << 20  # of text per bucket while blocks are small

MOST_REPEATS = 64
_RUN = 10_000

HASH_BYTES = 7  # hashes are cut to 56 bits: they stay positive and pack tighter


def text_blocks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool, int]:
    """(block, row, times, id, text) rows, whether any ``times`` is over 1, and a number of buckets.

    Rows that repeat an id and text more than ``MOST_REPEATS`` times become one row with their number
    as ``times``, combined before the shuffle, since equal rows are dealt to one block.

    Blocks follow from the text's size. They grow once there are ``MOST_SMALL_BLOCKS`` of them, and
    buckets with them, up to ``LARGEST_BLOCK``: to 1 TB the number of packed rows, blocks times buckets,
    stays about 1.7e7. Beyond that both numbers grow, and packed rows with the square of the text (1.4e9
    at 10 TB): a larger corpus goes through in parts, or needs a second hop that is not built.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    size = min(max(total // MOST_SMALL_BLOCKS, SMALLEST_BLOCK), LARGEST_BLOCK)
    blocks = total // size + 1
    buckets = total // max(BUCKET_BYTES, size) + 1
    rows = rows.select(F.xxhash64("id", "text").alias("row"), "id", "text")
    often = stored(rows.groupBy("row").agg(F.count("*").alias("n")).filter(
        F.col("n") > MOST_REPEATS).select("row"), "repeated-rows")
    once = rows.withColumn("times", F.lit(1).cast("bigint"))
    collapsed = not often.isEmpty()
    if collapsed:
        many = rows.join(often, "row", "left_semi").groupBy("row", "id", "text").agg(
            F.count("*").alias("times"))
        once = once.join(often, "row", "left_anti").unionByName(many)
    block = F.pmod("row", F.lit(blocks)).cast("int").alias("block")
    return once.select(block, "row", "times", "id", "text"), collapsed, buckets


def repeated(rows: DataFrame) -> DataFrame:
    """Each row of a stored frame ``times`` times: long runs are cut into parts that many tasks write."""
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / _RUN))).alias("part")
    many = rows.filter("times > 1").select("*", part).repartition("part", "row")
    of_part = F.least(F.lit(_RUN), F.col("times") - F.col("part") * _RUN).cast("bigint")
    many = many.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), of_part)).alias("one"))
    return rows.filter("times = 1").union(many.drop("part", "one"))


def in_order(table: pa.Table) -> tuple[list[int | None], list[str]]:
    """Ids and texts of a block in an order that does not depend on how its rows arrived."""
    rows = sorted(
        zip(table.column("id").to_pylist(), table.column("text").to_pylist(), strict=True),
        key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    return [r[0] for r in rows], [r[1] or "" for r in rows]


def cuts(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, stop) of the non-empty buckets in sorted 56-bit hashes."""
    of = ((hashes >> np.uint64(24)) * np.uint64(buckets)) >> np.uint64(32)
    at = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64)).tolist()
    for bucket in range(buckets):
        if at[bucket + 1] > at[bucket]:
            yield bucket, at[bucket], at[bucket + 1]
