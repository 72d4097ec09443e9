"""Byte-level BPE encoding and decoding by a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary resolves pre-tokens that are tokens
themselves. Second tier: all other pre-tokens are merged with a heap of candidate pairs over a
doubly linked list of their bytes. Both tiers agree with merging the lowest rank first, leftmost
first on ties, because a whole vocabulary entry takes precedence over its merges.

Texts are cut into pre-tokens by the tokenizer's pattern. The ids of pre-tokens met lately are
remembered per worker, in two generations of bounded size.

Defined cases: a null text is the empty text (no ids, no bytes); repeated rows give one result each;
an empty table gives an empty result. Other columns are not read. The work is per row: no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.arrow import give_back, text_slices

_MASK = (1 << 64) - 1


class MinimalPerfectHash:
    """Hash and displace: every key has a slot of its own among exactly as many slots as keys."""

    KEYS_PER_BUCKET = 2

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, -(-self.size // self.KEYS_PER_BUCKET))
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for h in map(xxhash.xxh3_64_intdigest, keys):
            groups[h % self.buckets].append(h)
        # a seed for buckets of several keys, -1 - slot for those of one key
        self.seeds = [0] * self.buckets
        taken = bytearray(self.size)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        for b in (b for b in order if len(groups[b]) > 1):
            seed = 0
            while True:
                slots = {self._slot(h, seed) for h in groups[b]}
                if len(slots) == len(groups[b]) and not any(taken[s] for s in slots):
                    break
                seed += 1
            self.seeds[b] = seed
            for s in slots:
                taken[s] = 1
        free = (s for s in range(self.size) if not taken[s])
        for b in (b for b in order if len(groups[b]) == 1):
            self.seeds[b] = -1 - next(free)

    def _slot(self, h: int, seed: int) -> int:
        x = ((h ^ (seed * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & _MASK
        return ((x >> 32) * self.size) >> 32

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[h % self.buckets]
        return -1 - seed if seed < 0 else self._slot(h, seed)


class _Recent(dict):
    """Results met lately, in two generations: the old one goes when the young one is full."""

    def __init__(self, make: Callable[[str], bytes], size: int, longest: int):
        super().__init__()
        self.make, self.size, self.longest = make, size, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class ByteBpe:
    """Encoder and decoder for a rank file; ``pattern`` cuts text into pre-tokens."""

    REMEMBERED = 400_000  # pre-tokens in each of two generations
    LONGEST_REMEMBERED = 64

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        keys = list(ranks)
        self.first = MinimalPerfectHash(keys)
        self.slot_key: list[bytes] = [b""] * len(keys)
        self.slot_ids: list[bytes] = [b""] * len(keys)
        for k in keys:
            s = self.first.slot(k)
            self.slot_key[s], self.slot_ids[s] = k, ranks[k].to_bytes(4, "little")
        self.byte_id = [ranks[bytes([b])] for b in range(256)]
        self.merged = {  # two ids, left one in the high bits: the id of their merge
            (ranks[k[:i]] << 32) | ranks[k[i:]]: r
            for k, r in ranks.items() for i in range(1, len(k))
            if k[:i] in ranks and k[i:] in ranks
        }
        self.token = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.ids = _Recent(self._fresh_ids, remembered, self.LONGEST_REMEMBERED)

    @classmethod
    def load(cls, path: str, pattern: str, remembered: int = REMEMBERED) -> ByteBpe:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        return cls(ranks, pattern, remembered)

    def forget(self) -> None:
        """Empty the memory of pre-tokens."""
        self.ids.clear()
        self.ids.old = {}

    def encode_pre_token(self, raw: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        slot = self.first.slot(raw)
        if self.slot_key[slot] == raw:
            return self.slot_ids[slot]
        return self._merge(raw)

    def _merge(self, raw: bytes) -> bytes:
        merged, push, pop = self.merged.get, heapq.heappush, heapq.heappop
        ids = [self.byte_id[b] for b in raw]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # rank and place in one number: lowest rank first, leftmost first on ties
        heap = [(r << 32) | i for i in range(n - 1)
                if (r := merged((ids[i] << 32) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            i, rank = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if ids[i] < 0 or j >= n or merged((ids[i] << 32) | ids[j]) != rank:
                continue  # one side has been merged since
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := merged((rank << 32) | ids[k])) is not None:
                    push(heap, (r << 32) | i)
            h = before[i]
            if h >= 0 and (r := merged((ids[h] << 32) | rank)) is not None:
                push(heap, (r << 32) | h)
        return array("I", [i for i in ids if i >= 0]).tobytes()

    def _fresh_ids(self, token: str) -> bytes:
        return self.encode_pre_token(token.encode("utf-8", "surrogatepass"))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.ids.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[str, str, int], ByteBpe] = {}


def encoder(path: str, pattern: str, remembered: int = ByteBpe.REMEMBERED) -> ByteBpe:
    """The worker's encoder; its tables are built once per process."""
    key = (path, pattern, remembered)
    if key not in _loaded:
        _loaded[key] = ByteBpe.load(path, pattern, remembered)
    return _loaded[key]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) per row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in text_slices(batches, "text"):
            ids = [np.frombuffer(bpe.encode(t or ""), "<u4").astype(np.int32)
                   for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(id, text binary) per row of ids; null ids are none."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            raw = [bpe.decode(np.array(ids or [], "<u4").tobytes())
                   for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(raw, pa.binary())], ["id", "text"])

    rows = encoded.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(work, "id long, text binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False,
               remembered: int | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of what they decode to.

    ``with_ids`` adds the ids themselves. ``remembered`` bounds the pre-tokens a task remembers, which
    are then forgotten at its end with the tables: for workers that go on to other stages.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern, remembered or ByteBpe.REMEMBERED)
        for batch in text_slices(batches, "text"):
            counts, of_ids, of_text, all_ids = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = bpe.encode(text or "")
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(np.frombuffer(ids, "<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string()),
                 *([pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else [])],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])
        if remembered:
            bpe.forget()
            _loaded.clear()
            del bpe
            give_back()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        work, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + ", ids array<int>" * with_ids
    ).withColumnRenamed("id", id_col)
