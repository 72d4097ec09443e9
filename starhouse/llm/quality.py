"""Quality rules per document, and rejection of documents depleted by their host's common lines.

Base rules judge a text alone: too few words, or too many words inside repeated three-word windows.
The corpus rule hashes each normalised line (stripped, lower case, host prefixed), counts the distinct
documents per host that hold it, and removes lines above the limits: at least ``min_docs`` documents,
at least ``max_share_pct`` percent of the host's documents, and at least ``min_texts`` different texts.
A document of which fewer than ``min_left_pct`` percent of the words are left is depleted and
rejected. ``judge`` lists the positions of the removed lines of each row, ``without_lines`` takes them
out of a text.

Copies are documents and count as such, but lines that only copies of one or two texts hold are those
texts and no boilerplate: without ``min_texts`` every copied clean document would be rejected with
all its copies, where deduplication keeps one. The share serves the same end for groups of near copies,
and on a host that mixes many sites it leaves a site's lines to line deduplication. Texts are the
same if they have the same lines in any order.

Defined cases: a null text has no words and fails the base rules; a null host is a host of its own;
repeated rows give one result each and are one document of their id, as are all rows without an id
of one text; an empty table gives an empty result. Other columns are not read.

The distinct lines of a text leave its task as one 64-bit hash each, with the row's number of words
in it, and the text's lines as places in that list.
A host never meets in one task: counts are combined per (host, line) before the shuffle. A host has
at most 100 / max_share_pct times its mean lines per text above the limit, so the list of removed
lines stays far below the corpus; it is written once and its real size decides how it is joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.arrow import give_back, text_slices
from starhouse.llm.words import forget_words, window_hashes, word_hashes
from starhouse.session import stored

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_DOCS = 10
MIN_TEXTS = 3
MAX_SHARE_PCT = 10
MIN_LEFT_PCT = 25

#: The counted symbols, and the white space that parts words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

_SLICE_BYTES = 2 << 20

_SCHEMA = pa.schema([
    ("id", pa.int64()), ("host", pa.string()), ("n_words", pa.int64()),
    ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("line_hashes", pa.list_(pa.int64())),
    ("line_words", pa.list_(pa.int32())), ("line_places", pa.list_(pa.list_(pa.int32()))),
])
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found more than once."""
    windows = window_hashes(word_hashes(words), width)
    if len(windows) < 2:
        return 0
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[place] > 1)
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[starts + i] = True
    return int(covered.sum())


def _measure(text: str | None, host: str | None) -> tuple:
    if not text:
        return 0, 0, 0, 0, 0, [], [], []
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    bare = [line.strip() for line in raw.split(b"\n")]
    lines = [line for line in raw.split(b"\n") if line.strip()]
    prefix = b"\x00" if host is None else b"\x01" + host.encode("utf-8", "surrogatepass") + b"\x00"
    keys = [xxhash.xxh3_64_intdigest(prefix + line.lower()) - (1 << 63) if line else None
            for line in bare]
    weights: Counter[int] = Counter()
    for key, line in zip(keys, bare, strict=True):
        if line:
            weights[key] += len(line.split())
    hashes, counts = zip(*sorted(weights.items()), strict=True) if weights else ((), ())
    places: dict[int, list[int]] = {key: [] for key in hashes}
    for i, key in enumerate(keys):
        if key is not None:
            places[key].append(i)
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words), list(hashes), list(counts),
        list(places.values()),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text", _SLICE_BYTES):
        texts, hosts = batch.column("text").to_pylist(), batch.column("host").to_pylist()
        found = list(zip(*map(_measure, texts, hosts), strict=True))
        columns = [batch.column(c) for c in ("id", "host")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip([*columns, *found], _SCHEMA, strict=True)],
            schema=_SCHEMA)
    forget_words()
    give_back()


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = MIN_WORDS,
    max_repeat_pct: int = MAX_REPEAT_PCT,
    min_docs: int = MIN_DOCS,
    max_share_pct: int = MAX_SHARE_PCT,
    min_left_pct: int = MIN_LEFT_PCT,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """(id, the five base figures, words_left, base_failed, kept, removed_lines) per row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    kinds = ("id long, host string, n_words long, word_chars long, n_symbols long, "
             "n_dup_lines long, n_repeat_words long, line_hashes array<long>, line_words array<int>, "
             "line_places array<array<int>>")
    measured = stored(rows.mapInArrow(_measured, kinds), "quality-measures")

    content = ("host", "line_hashes", "line_words")
    body = [F.xxhash64(*content).alias("b1"), F.xxhash64(*reversed(content), F.lit(2)).alias("b2")]
    measured = measured.select("*", *body)
    documents = (measured.select("b1", "b2", "id").distinct()
                 .groupBy("b1", "b2").agg(F.count("*").alias("docs")))
    bodies = (measured.select("b1", "b2", *content).groupBy("b1", "b2")
              .agg(*(F.first(c).alias(c) for c in content)).join(documents, ["b1", "b2"]))
    hosts = bodies.groupBy("host").agg(F.sum("docs").alias("all_docs")).withColumnRenamed("host", "its_host")
    lines = bodies.select("b1", "b2", "host", "docs", F.posexplode(
        F.arrays_zip("line_hashes", "line_words")).alias("at", "l")).select(
        "b1", "b2", "host", "docs", "at", F.col("l.line_hashes").alias("line"),
        F.col("l.line_words").alias("w"))
    lines = stored(lines, "quality-lines")
    common = (lines.groupBy("line", "host").agg(F.sum("docs").alias("n"), F.count("*").alias("texts"))
              .filter((F.col("n") >= min_docs) & (F.col("texts") >= min_texts)))
    removed = stored(
        common.join(hosts, F.col("host").eqNullSafe(F.col("its_host")))
        .filter(F.col("n") * 100 >= F.col("all_docs") * max_share_pct).select("line"),
        "quality-removed")
    lost = (lines.join(removed, "line").groupBy("b1", "b2")
            .agg(F.sum("w").alias("lost"), F.collect_list("at").alias("its_lines")))

    words = F.col("n_words")
    left = words - F.coalesce(F.col("lost"), F.lit(0))
    failed = (words < min_words) | (F.col("n_repeat_words") * 100 > words * max_repeat_pct)
    depleted = left * 100 < words * min_left_pct
    places = F.array_sort(F.flatten(F.transform("its_lines", lambda at: F.get("line_places", at))))
    return measured.join(lost, ["b1", "b2"], "left").select(
        F.col("id").alias(id_col), *_MEASURES, left.alias("words_left"),
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        F.coalesce(places, F.array().cast("array<int>")).alias("removed_lines"))


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines at the positions ``removed``, which may be null."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return F.when(F.size(removed) > 0, left).otherwise(text)
