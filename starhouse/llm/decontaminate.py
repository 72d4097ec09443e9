"""Benchmark decontamination by a distributed positional inverted index.

The index is stored in shards of whole documents: per shard the sorted terms, their counts and the
term's word positions, numbered through the shard. A search sends the test windows to every shard.
There the lists of a window's terms, shifted by each term's offset, are intersected from the
shard's rarest term on; what is left are exact phrases. Proximity matches are spans of at most
``near`` words that hold all distinct terms of a window in any order.

Words are runs of digits, letters and non-ASCII characters, with A-Z in lower case. A window is
``width`` consecutive words of an item; an item of fewer words, but not none, is one window.

Defined cases: null and empty texts have no words and match nothing; items without words are
never found; items without an id are searched too and listed as one null id; repeated rows give one
result each, repeated item ids count once; empty tables give
no hits or no rows. Other columns are not read.

A shard holds whole documents, so a document's verdict is made where its postings are and nothing
is shuffled. Test items travel to the tasks in slices of a checked size; every slice searches the
same stored index. The driver holds all items meanwhile, so a benchmark of more than ``MOST_BYTES`` is
refused before anything is read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.arrow import give_back, pack, text_slices, unpack
from starhouse.llm.words import forget_words, word_hashes
from starhouse.session import stored

WIDTH = 10
NEAR = 15
SLICE_BYTES = 16 << 20  # of item text sent to the tasks at once
MOST_BYTES = 256 << 20  # of item text that a search takes

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_INDEX = ("shard long, doc_ids array<long>, starts array<int>, terms binary, counts binary, "
          "positions binary")
_HITS = "hits binary, found array<struct<doc:int,item:string>>, near array<struct<doc:int,item:string>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


# Index ------------------------------------------------------------------------------------


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(text_slices(batches, "text")):
        lists = [word_hashes(words_of(t)) for t in batch.column("text").to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        words = np.concatenate(lists) if lists else np.empty(0, np.uint64)
        order = np.argsort(words, kind="stable").astype(np.uint32)
        terms, counts = np.unique(words, return_counts=True)
        width = 3 if len(words) < 1 << 24 else 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) | number], pa.int64()),
             pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
             pa.array([starts], pa.list_(pa.int32())), pa.array([pack(terms, 8)], pa.binary()),
             pa.array([pack(counts.astype(np.uint32), width)], pa.binary()),
             pa.array([pack(order, width)], pa.binary())],
            ["shard", "doc_ids", "starts", "terms", "counts", "positions"])
    forget_words()
    give_back()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index of all words of all rows, written to the shared folder."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(_shards, _INDEX), "positional-index")


class _Shard:
    """One shard's lists, opened."""

    def __init__(self, row: dict):
        self.starts = np.array(row["starts"], np.int64)
        self.terms = unpack(row["terms"], 8)
        n = int(self.starts[-1])
        width = len(row["positions"]) // n if n else 3
        self.positions = unpack(row["positions"], width, np.uint32).astype(np.int64)
        self.ends = np.cumsum(unpack(row["counts"], width, np.uint32).astype(np.int64))

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each wanted term its number in the shard and its count, 0 if absent."""
        if not len(self.terms):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        counts = np.diff(self.ends, prepend=0)[at]
        return at, np.where(self.terms[at] == wanted, counts, 0)

    def list_of(self, at: int) -> np.ndarray:
        return self.positions[self.ends[at - 1] if at else 0:self.ends[at]]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


def _has(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return values[at] == wanted


def _phrases(shard: _Shard, lists: list[np.ndarray]) -> np.ndarray:
    """Places where the terms stand one after the other inside one document."""
    rarest_first = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[rarest_first[0]] - rarest_first[0]
    for i in rarest_first[1:]:
        if not len(starts):
            return starts
        starts = starts[_has(lists[i], starts + i)]
    starts = starts[starts >= 0]
    return starts[shard.document(starts) == shard.document(starts + len(lists) - 1)]


def _spans(shard: _Shard, lists: list[np.ndarray], near: int) -> np.ndarray:
    """Places of the rarest term that lie in a span of ``near`` words with all other terms."""
    lists = sorted(lists, key=len)
    rarest, others = lists[0], lists[1:]
    for other in others:  # some place less than ``near`` words away
        if not len(rarest):
            return rarest
        low = np.searchsorted(other, rarest - near + 1)
        rarest = rarest[low < np.searchsorted(other, rarest + near)]
    found = []
    for place in rarest.tolist():
        d = int(shard.document(np.array([place]))[0])
        first, last = max(place - near + 1, shard.starts[d]), min(place + near, shard.starts[d + 1])
        around = [x[np.searchsorted(x, first):np.searchsorted(x, last)] for x in others]
        begins = np.concatenate([[place], *around])
        ok = (begins <= place) & (begins > place - near)
        for x in around:
            at = np.searchsorted(x, begins)
            ok &= (at < len(x)) & (x[np.minimum(at, max(len(x) - 1, 0))] < begins + near) if len(x) \
                else False
        if np.any(ok):
            found.append(place)
    return np.array(found, np.int64)


# Search -----------------------------------------------------------------------------------


def _windows(items: list[tuple[str, str | None]], width: int) -> list[tuple[str, np.ndarray]]:
    found: dict[tuple[str, bytes], np.ndarray] = {}
    for item, text in items:
        hashes = word_hashes(words_of(text))
        size = min(width, len(hashes))
        for i in range(len(hashes) - size + 1 if size else 0):
            window = hashes[i:i + size]
            found[item, window.tobytes()] = window
    return [(item, w) for (item, _), w in found.items()]


def _marker(items: list[tuple[str, str | None]], width: int, near: int | None) -> Callable:
    """Adds what a slice of the items finds in each shard."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(items, width)
        by_size: dict[int, list[int]] = defaultdict(list)
        for i, (_, window) in enumerate(windows):
            by_size[len(window)].append(i)
        tests = np.unique(np.concatenate([w for _, w in windows])) if windows else \
            np.empty(0, np.uint64)
        stacked = {n: np.searchsorted(tests, np.stack([windows[i][1] for i in group]))
                   for n, group in by_size.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield _marked(row, row.to_pylist()[0], windows, by_size, tests, stacked, near)
        forget_words()
        give_back()

    return mark


def _marked(batch, row, windows, by_size, tests, stacked, near) -> pa.RecordBatch:
    shard = _Shard(row)
    n = int(shard.starts[-1])
    cover = np.zeros(n + 1, np.int64)
    exact = {(f["doc"], f["item"]) for f in row["found"]}
    close = {(f["doc"], f["item"]) for f in row["near"]}
    at, counts = shard.places(tests)
    opened: dict[int, np.ndarray] = {}

    def list_of(term: int) -> np.ndarray:
        if term not in opened:
            opened[term] = shard.list_of(at[term])
        return opened[term]

    for size, group in by_size.items():
        alive = np.flatnonzero((counts[stacked[size]] > 0).all(axis=1))
        for k in alive.tolist():
            item, terms = windows[group[k]][0], stacked[size][k].tolist()
            starts = _phrases(shard, [list_of(t) for t in terms])
            if len(starts):
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + size, -1)
                exact.update((d, item) for d in shard.document(starts).tolist())
            if near is not None:
                spans = _spans(shard, [list_of(t) for t in set(terms)], near)
                if len(spans):
                    close.update((d, item) for d in shard.document(spans).tolist())
    hits = np.cumsum(cover[:n]) > 0
    if row["hits"]:
        hits |= np.unpackbits(np.frombuffer(row["hits"], np.uint8), count=n).astype(bool)
    pairs = pa.list_(pa.struct([("doc", pa.int32()), ("item", pa.string())]))
    columns = {c: batch.column(c) for c in batch.schema.names}
    columns["hits"] = pa.array([np.packbits(hits).tobytes()], pa.binary())
    for name, found in (("found", exact), ("near", close)):
        columns[name] = pa.array([[{"doc": d, "item": x} for d, x in sorted(
            found, key=lambda f: (f[0], f[1] is None, f[1] or ""))]], pairs)
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            starts = np.array(row["starts"], np.int64)
            hits = np.unpackbits(np.frombuffer(row["hits"], np.uint8), count=int(starts[-1]))
            total = np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])
            items: dict[int, list[str]] = defaultdict(list)
            close: dict[int, int] = defaultdict(int)
            for f in row["found"]:
                items[f["doc"]].append(f["item"])
            for f in row["near"]:
                close[f["doc"]] += 1
            docs = range(len(starts) - 1)
            listed = [sorted(items[d], key=lambda x: (x is None, x or "")) for d in docs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(np.diff(starts), pa.int64()),
                 pa.array(total[starts[1:]] - total[starts[:-1]], pa.int64()),
                 pa.array(listed, pa.list_(pa.string())),
                 pa.array([close[d] for d in docs], pa.int64())],
                ["id", "n_words", "n_hit", "items", "n_near_items"])


def search(index: DataFrame, items: DataFrame, item_id_col: str = "item_id",
           item_text_col: str = "text", width: int = WIDTH, near: int | None = NEAR,
           slice_bytes: int = SLICE_BYTES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items, n_near_items) per indexed row.

    ``n_hit`` counts words inside an exact phrase, ``items`` are the ids of items with one,
    ``n_near_items`` counts items with a proximity match (every phrase is one).
    """
    tests = items.select(F.col(item_id_col).cast("string").alias("item"),
                         F.col(item_text_col).alias("text"))
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of test items; a search takes {most_bytes}")
    slices = -(-size // slice_bytes) or 1
    marked = index.select(
        "*", *(F.lit(None).cast(k).alias(c) if c == "hits" else F.array().cast(k).alias(c)
               for c, k in (("hits", "binary"), ("found", "array<struct<doc:int,item:string>>"),
                            ("near", "array<struct<doc:int,item:string>>"))))
    for k in range(slices):
        part = tests.filter(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        rows = [(r["item"], r["text"]) for r in part.collect()]  # at most about slice_bytes
        marked = marked.mapInArrow(_marker(rows, width, near), f"{_INDEX}, {_HITS}")
    return marked.mapInArrow(
        _verdicts, "id long, n_words long, n_hit long, items array<string>, n_near_items long")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """Index the documents, search all items: one verdict per row of ``docs``."""
    return search(build_index(docs, id_col, text_col), items, **options).withColumnRenamed(
        "id", id_col)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
