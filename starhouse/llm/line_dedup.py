"""Line deduplication over a corpus, in DataFrame operations only.

Lines are split at ``\\n``; a line's key is the line without ASCII white space at both ends and with
A-Z in lower case. Keys of at least ``min_chars`` code points that occur in at least ``min_docs``
documents lose all their lines, except in the document with the largest id that holds them.

Defined cases: a null or empty text is one empty line, which is never dropped. Every row counts as
a document of its own, so a repeated row counts again; rows that repeat the largest id all keep the
line. A null id is smaller than any other; if no id is known, all lines stay. An empty table gives
an empty result. Other columns are carried along, except
``n_lines`` and ``n_dropped``, which are replaced.

Per document the distinct keys leave the row as 128-bit hashes. Counts and largest ids are combined
before the shuffle, so a line that a third of all rows hold costs one row per task. Only hashes of
lines, never lines, are joined with the repeated keys; the positions to drop return to their text
in one join on the row's identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.session import stored

MIN_CHARS = 20
MIN_DOCS = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = " \t\n\x0b\x0c\r"


def _key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_BLANKS))
    # lower() changes more than A-Z unless every character is one byte
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _UPPER.lower()))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The rows with what is left of their text, n_lines (before) and n_dropped."""
    others = {c: f"own_{i}" for i, c in enumerate(docs.columns)
              if c not in (id_col, text_col, "n_lines", "n_dropped")}
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"),
                       *(docs[c].alias(a) for c, a in others.items()))
    rows = rows.withColumn("row", F.xxhash64("id", "body"))
    lines = F.split("body", "\n")

    keys = F.array_distinct(F.transform(lines, _key))
    keys = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    repeated = stored(
        rows.select("id", F.explode(keys).alias("key"))
        .select("id", *_hashes(F.col("key")))
        .groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("id").alias("keeper"))
        .filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper"),
        "repeated-lines",
    )
    placed = (
        rows.select("id", "row", F.posexplode(lines).alias("pos", "line"))
        .select("id", "row", "pos", _key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("id", "row", "pos", *_hashes(F.col("key")))
    )
    dropped = (
        placed.join(repeated, ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("row", "id").agg(F.collect_set("pos").alias("gone"))  # at most a text's lines
    )
    dropped = dropped.select(F.col("row").alias("its_row"), F.col("id").alias("its_id"), "gone")
    joined = rows.join(
        dropped,
        (F.col("row") == F.col("its_row")) & F.col("id").eqNullSafe(F.col("its_id")), "left")
    count = F.size(lines)
    left = F.array_except(F.sequence(F.lit(0), count - 1), F.col("gone"))
    body = F.when(F.col("gone").isNull(), F.col("body")).otherwise(
        F.concat_ws("\n", F.transform(left, lambda i: F.get(lines, i))))
    return joined.select(
        F.col("id").alias(id_col), body.alias(text_col),
        *(F.col(a).alias(c) for c, a in others.items()),
        count.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
