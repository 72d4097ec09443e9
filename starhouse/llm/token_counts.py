"""Token counts of fields and sections from one encoding of the whole document.

A row's fields are joined to one text, which is encoded once. The token offsets come from the byte
lengths of the tokens; an interval join of the tokens' spans with the spans of fields and lines
(sections) attributes every token by an explicit rule for those that cross a boundary:

* ``start``: to the part that holds the token's first byte,
* ``end``: to the part that holds its last byte,
* ``most``: to the part that holds most of its bytes, the first of equals.

A line's span ends after its ``\\n``; the separator between fields belongs to the field before it.

Defined cases: a null field is empty; empty parts get no tokens; a row without text has one empty
section and no tokens if there is one field, while of several fields the separators between them are
encoded and end a section each; repeated rows give one result each; an empty table gives an empty result.
Other columns are not read. The work is per row: no shuffle, and both span lists of a row are
sorted, so the join is one binary search per token.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.arrow import text_slices
from starhouse.llm.bpe import encoder

RULES = ("start", "end", "most")
SEPARATOR = "\n"


def attribute(token_ends: np.ndarray, part_ends: np.ndarray, rule: str) -> np.ndarray:
    """The part of each token; tokens and parts both tile the same bytes from 0 on."""
    token_starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(part_ends, token_starts, "right")
    if rule == "start":
        return first
    last = np.searchsorted(part_ends, token_ends - 1, "right")
    if rule == "end":
        return last
    best, most = first.copy(), np.minimum(part_ends[first], token_ends) - token_starts
    for step in range(1, int((last - first).max(initial=0)) + 1):
        part = np.minimum(first + step, last)
        held = np.minimum(part_ends[part], token_ends) - np.maximum(part_ends[part - 1], token_starts)
        better = (first + step <= last) & (held > most)
        best, most = np.where(better, part, best), np.where(better, held, most)
    return best


def _line_ends(raw: bytes) -> np.ndarray:
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return np.append(breaks, len(raw)).astype(np.int64)


def count_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                 fields: Sequence[str] = ("text",), rule: str = "start") -> DataFrame:
    """(id, n_tokens, n_crossing, field_tokens, section_tokens) per row.

    ``n_crossing`` counts tokens that lie in more than one section; the lists hold the tokens of
    each field, in the order given, and of each line of the joined text.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {', '.join(RULES)}")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        lengths = np.zeros(max(bpe.token) + 1, np.int64)
        for i, token in bpe.token.items():
            lengths[i] = len(token)
        counts = pa.list_(pa.int64())
        for batch in text_slices(batches, "text"):
            rows = []
            sizes = batch.column("sizes").to_pylist()
            for text, field_sizes in zip(batch.column("text").to_pylist(), sizes, strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                ends = np.cumsum(lengths[np.frombuffer(bpe.encode(text), "<u4")])
                field_ends = np.cumsum(field_sizes) + np.arange(1, len(field_sizes) + 1)
                field_ends[-1] = len(raw)  # no separator after the last field
                line_ends = _line_ends(raw)
                by_line = attribute(ends, line_ends, rule)
                crossing = attribute(ends, line_ends, "start") != attribute(ends, line_ends, "end")
                rows.append((
                    len(ends), int(crossing.sum()),
                    np.bincount(attribute(ends, field_ends, rule), minlength=len(field_ends)),
                    np.bincount(by_line, minlength=len(line_ends))))
            n, crossed, of_fields, of_lines = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(crossed, pa.int64()),
                 pa.array(of_fields, counts), pa.array(of_lines, counts)],
                ["id", "n_tokens", "n_crossing", "field_tokens", "section_tokens"])

    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.array(*(F.octet_length(p).cast("bigint") for p in parts)).alias("sizes"),
        F.concat_ws(SEPARATOR, *parts).alias("text"))
    return rows.mapInArrow(
        work, "id long, n_tokens long, n_crossing long, field_tokens array<long>, "
              "section_tokens array<long>").withColumnRenamed("id", id_col)
