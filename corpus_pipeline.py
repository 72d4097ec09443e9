"""A corpus pipeline of five operators: filter, deduplicate, decontaminate and tokenise documents.

Rows are told apart by their content, so repeated rows and null ids share the verdict on that
content; only the n-gram stage keeps one row of those that repeat a group's first. A stage that
changes rows writes their hashes, with the places of the lines they lose, and counts them: up to
``BROADCAST_ROWS`` of these numbers go to the tasks, so that the texts stay where they are; more are
joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from starhouse.llm.arrow import short_batches
from starhouse.llm.queries import PATTERN, RANKS
from starhouse.session import stored

BROADCAST_ROWS = 1_000_000
BATCH_ROWS = 2_000  # texts that a task sends to its worker at once
REMEMBERED = 50_000  # pre-tokens in each of two generations, of a worker that runs other stages too

_ROW = "row_of_pipeline"
_KEPT = "kept_by_pipeline"
_LINES = "lines_of_pipeline"


def _sent(rows: DataFrame, purpose: str, weight: Column) -> DataFrame:
    """The rows, written; for a broadcast while their weights add up to few."""
    rows = stored(rows, purpose)
    few = (rows.agg(F.sum(weight)).first()[0] or 0) <= BROADCAST_ROWS
    return F.broadcast(rows) if few else rows


def _without(docs: DataFrame, row: Column, removed: DataFrame) -> DataFrame:
    """``docs`` without the rows whose hash is in ``removed``."""
    marked = docs.withColumn(_ROW, row)
    return marked.join(_sent(removed, "removed-rows", F.lit(1)), _ROW, "left_anti").drop(_ROW)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that are too frequent in their host."""
    # the marks tell in which column a NULL stands, which a hash skips
    marked = docs.withColumn(_ROW, F.xxhash64(
        "doc_id", F.col("text").isNull(), "text", F.col("source").isNull(), "source"))
    with short_batches(spark, BATCH_ROWS):  # judge stores what its workers measure
        verdicts = quality.judge(marked, id_col=_ROW).filter("NOT kept OR size(removed_lines) > 0")
    verdicts = _sent(
        verdicts.groupBy(_ROW).agg(
            F.first("kept").alias(_KEPT),
            F.first(F.when(F.col("kept"), F.col("removed_lines"))).alias(_LINES)),
        "quality-verdicts", 1 + F.coalesce(F.size(_LINES), F.lit(0)))
    left = marked.join(verdicts, _ROW, "left").filter(F.coalesce(_KEPT, F.lit(True)))
    left = left.withColumn("text", quality.without_lines(F.col("text"), F.col(_LINES)))
    n_chars = F.when(F.size(_LINES) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars.cast("bigint")).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that other documents repeat."""
    left = line_dedup.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents one row.

    The smallest id stays, unknown ids come last; then the smallest hash of (id, text); of rows equal
    in both the smallest by their columns in order. Texts without words are in no group and stay.
    """
    row = F.xxhash64(F.col("doc_id").cast("bigint"), "text")
    counted = ngram_join.similar_groups(docs).groupBy("row", "head").agg(F.count("*").alias("n"))
    gone = stored(counted.filter("row <> head OR (row = head AND n > 1)"), "rows-of-groups")
    left = _without(docs, row, gone.select(F.col("row").alias(_ROW)))
    repeated = gone.filter("row = head").select(F.col("row").alias(_ROW))
    if repeated.isEmpty():
        return left
    again = docs.withColumn(_ROW, row).join(
        _sent(repeated, "repeated-firsts", F.lit(1)), _ROW, "left_semi")
    # combined before the shuffle: a row that very many rows repeat leaves a task once
    one = again.groupBy(_ROW).agg(F.min(F.struct(*docs.columns)).alias("one"))
    return left.union(one.select("one.*"))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = F.xxhash64("doc_id", "text")
    with short_batches(spark, BATCH_ROWS):  # the index and the hits are stored
        found = decontaminate.decontaminate(docs.withColumn(_ROW, row), items, id_col=_ROW, near=None)
        return _without(docs, row, found.filter("n_hit > 0").select(_ROW).distinct())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, RANKS, PATTERN, with_ids=True, remembered=REMEMBERED)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", without_benchmarks),
    ("byte-level BPE encoding and decoding", tokens),
]

ORACLE_SQL = None  # SQL cannot express the merges of the last stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
