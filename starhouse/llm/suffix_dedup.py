"""Removal of repeated byte passages with a sparse suffix array, sorted deep-shallow.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a smaller
id. Documents are UTF-8 bytes; strings never cross documents and are judged on the input.

1. Anchors: every window of ``length`` bytes selects the rightmost of its smallest ``GRAM``-byte
   hashes, so equal windows select equal anchors at equal offsets. Blocks send their distinct
   anchors to hash buckets, which tell them the anchors that a second document has. Windows whose
   anchor has no second document have no second occurrence.
2. Contexts: the run of windows that select one anchor is a context. Blocks send the distinct
   contexts of shared anchors to the anchor's bucket with the smallest id that holds each.
3. Suffixes: a bucket collects the contexts of each anchor. If they are one string, its smallest id
   stands for all its windows. Else every window is a suffix, and the bucket sorts all of these
   cut to ``length`` bytes: multikey sorting by eight bytes at a time to ``SHALLOW`` bytes, then a
   blind trie for each group that is still together and not one string. Runs of equal strings are
   neighbours then, and the smallest id of a run goes back with the windows.
4. Blocks mark the bytes of windows that a smaller id has, and cut them out.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; repeated rows and
rows that repeat an id never remove each other's bytes; a null id is larger than any other. Very
long documents are hashed piece by piece. An empty table gives an empty result. Other columns are
not read.

The text is shuffled once and its blocks are opened three times (the plan reuses the exchange).
A passage that a third of all rows hold is one context per block, so a hot anchor costs a bucket
one row per block; everything else returns as packed rows to the block that asked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starhouse.llm.arrow import pack, unpack
from starhouse.llm.blocks import HASH_BYTES, cuts, in_order, repeated, text_blocks
from starhouse.llm.words import mixed
from starhouse.session import stored

LENGTH = 50
GRAM = 20
SHALLOW = 32

_NO_ID = np.iinfo(np.int64).max
_PIECE = 1 << 19  # bytes whose anchors are computed at once
_BASE = 0x9E3779B97F4A7C15
_CODEC = "zstd"


def _powers(base: int) -> np.ndarray:
    found = np.full(_PIECE + 1, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


_POWERS = _powers(_BASE)
_INVERSES = _powers(pow(_BASE, -1, 1 << 64))


# Anchors ----------------------------------------------------------------------------------


def _piece_anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, hash) of a piece's windows, in order of the anchors."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[:n], out=sums[1:])
    hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * _INVERSES[:n - GRAM + 1])
    low = np.uint64((1 << 20) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    smallest = (hashes & ~low) | (low - places)  # the rightmost of equals is the smallest
    span, width = 1, length - GRAM + 1
    while span * 2 <= width:
        smallest = np.minimum(smallest[:-span], smallest[span:])
        span *= 2
    if span < width:
        smallest = np.minimum(smallest[:span - width], smallest[width - span:])
    anchors = (low - (smallest & low)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    last = np.concatenate([first[1:], [len(anchors)]]) - 1
    found = anchors[first]
    # the selected hashes are small ones: mixed again, they spread evenly over the buckets
    return found, first, last, mixed(hashes[found]) >> np.uint64(64 - 8 * HASH_BYTES)


def _anchors(raw: bytes, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of a document, piece by piece; pieces overlap so that every window is in one."""
    whole = np.frombuffer(raw, np.uint8)
    step = _PIECE - length + 1
    for start in range(0, max(len(raw) - length + 1, 0), step):
        piece = whole[start:start + _PIECE]
        found, first, last, hashes = _piece_anchors(piece, length)
        yield found + start, first + start, last + start, hashes


def _document_anchors(raw: bytes, length: int) -> tuple[np.ndarray, ...] | None:
    """Anchors of a whole document; None if it has no window. Runs cut by a piece are two contexts."""
    pieces = list(_anchors(raw, length))
    if not pieces:
        return None
    return pieces[0] if len(pieces) == 1 else tuple(map(np.concatenate, zip(*pieces, strict=True)))


class _Block:
    """The anchors of a block's documents, one after the other."""

    def __init__(self, table: pa.Table, length: int):
        ids, texts = in_order(table)
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        self.raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        docs, parts = [], []
        for d, raw in enumerate(self.raws):
            found = _document_anchors(raw, length)
            if found is not None:
                docs.append(np.full(len(found[0]), d, np.int64))
                parts.append(found)
        empty = np.empty(0, np.int64)
        self.doc = np.concatenate(docs) if docs else empty
        self.anchor, self.first, self.last, self.hash = (
            map(np.concatenate, zip(*parts, strict=True)) if parts
            else (empty, empty, empty, empty.astype(np.uint64)))


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _sender(length: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def send(table: pa.Table) -> pa.Table:
        """The block's distinct anchors, and which of them two of its documents have."""
        block = _Block(table, length)
        order = np.lexsort((block.ids[block.doc], block.hash))
        hashes, ids = block.hash[order], block.ids[block.doc][order]
        distinct, start = np.unique(hashes, return_index=True)
        end = np.append(start[1:], len(hashes)) - 1
        many = (ids[start] != ids[end]).astype(np.uint8) if len(hashes) else np.empty(0, np.uint8)
        number = table.column("block")[0].as_py()
        rows = [(b, number, pack(distinct[i:j], HASH_BYTES), many[i:j].tobytes())
                for b, i, j in cuts(distinct, buckets)]
        return _rows(rows, ["bucket", "block", "anchors", "many"],
                     [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

    return send


def _shared(table: pa.Table) -> pa.Table:
    """Which of the anchors sent to a bucket occur in more than one document."""
    lists = [unpack(p, HASH_BYTES) for p in table.column("anchors").to_pylist()]
    many = np.frombuffer(b"".join(table.column("many").to_pylist()), np.uint8)
    distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
    times = np.bincount(place, 1 + many, len(distinct))
    found = (times > 1)[place]
    at = np.cumsum([0, *map(len, lists)]).tolist()
    bits = [np.packbits(found[i:j]).tobytes() for i, j in zip(at, at[1:], strict=False)]
    return pa.Table.from_arrays(
        [table.column("block"), table.column("bucket"), pa.array(map(len, lists), pa.int32()),
         pa.array(bits, pa.binary())], ["block", "bucket", "n", "bits"])


# Contexts ---------------------------------------------------------------------------------

_SENT = ("bucket int, block int, n int, anchors binary, shape binary, ids binary, bytes binary, "
         "total int")


def _compressed(data: bytes) -> bytes:
    return pa.compress(data, codec=_CODEC, asbytes=True) if data else b""


def _expanded(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, codec=_CODEC, asbytes=True) if size else b""


def _gatherer(length: int, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def gather(docs: pa.Table, flags: pa.Table) -> pa.Table:
        """Distinct contexts of shared anchors by bucket, and where in the block each one is."""
        block = _Block(docs, length)
        number = docs.column("block")[0].as_py()
        order = np.argsort(flags.column("bucket").to_numpy())
        parts = list(zip(flags.column("bits").to_pylist(), flags.column("n").to_pylist(),
                         strict=True))
        shared = [np.unpackbits(np.frombuffer(parts[i][0], np.uint8), count=parts[i][1])
                  for i in order.tolist()]
        flagged = np.concatenate(shared).astype(bool) if shared else np.empty(0, bool)
        distinct = np.unique(block.hash)
        kept = np.flatnonzero(flagged[np.searchsorted(distinct, block.hash)])
        kept = kept[np.argsort(block.hash[kept], kind="stable")]
        doc, first, last = block.doc[kept], block.first[kept], block.last[kept]
        offset = block.anchor[kept] - first
        raws = block.raws
        found: dict[tuple[bytes, int], int] = {}
        place = np.empty(len(kept), np.int64)  # the context of each occurrence
        owners: list[int] = []  # the occurrence that first showed a context
        for i, (d, a, b, o) in enumerate(zip(doc.tolist(), first.tolist(), (last + length).tolist(),
                                             offset.tolist(), strict=True)):
            key = (raws[d][a:b], o)
            c = found.get(key)
            if c is None:
                c = found[key] = len(owners)
                owners.append(i)
            place[i] = c
        texts = [t for t, _ in found]
        owner = np.array(owners, np.int64)
        ids = np.full(len(owners), _NO_ID, np.int64)
        np.minimum.at(ids, place, block.ids[doc])
        hashes = block.hash[kept][owner]  # sorted, as the occurrences are
        rows = []
        for bucket, i, j in cuts(hashes, buckets):
            raw = b"".join(texts[i:j])
            shape = np.stack([offset[owner[i:j]], (last - first)[owner[i:j]]]).astype(np.uint16)
            rows.append((bucket, number, j - i, pack(hashes[i:j], HASH_BYTES),
                         _compressed(shape.tobytes()), _compressed(pack(ids[i:j], 8)),
                         _compressed(raw), len(raw)))
        # where the contexts are goes past the buckets, dealt by block
        where = np.stack([place, doc, first, offset, last - first]).astype(np.int64)
        rows.append((buckets + number, number, len(kept), b"", b"",
                     _compressed(pack(ids, 8)), _compressed(pack(where.ravel(), 8)), len(owners)))
        return _rows(rows, [c.split()[0] for c in _SENT.split(", ")],
                     [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
                      pa.binary(), pa.int32()])

    return gather


# Suffixes ---------------------------------------------------------------------------------


class _BlindTrie:
    """Distinct strings of one length in order, by a trie that keeps branching places only."""

    def __init__(self, first: bytes):
        self.root: list | bytes = first

    def insert(self, text: bytes) -> None:
        node = self.root
        while not isinstance(node, bytes):  # blind: bytes between branchings are not compared
            place, branches = node
            node = branches.get(text[place]) or next(iter(branches.values()))
        if node == text:
            return
        differ = next(i for i, (x, y) in enumerate(zip(node, text, strict=True)) if x != y)
        known = node[differ]
        parent, node = None, self.root
        while not isinstance(node, bytes) and node[0] < differ:
            parent, node = node, node[1][text[node[0]]]
        if not isinstance(node, bytes) and node[0] == differ:
            node[1][text[differ]] = text
            return
        split = [differ, {known: node, text[differ]: text}]
        if parent is None:
            self.root = split
        else:
            parent[1][text[parent[0]]] = split

    def __iter__(self) -> Iterator[bytes]:
        open_ = [self.root]
        while open_:
            node = open_.pop()
            if isinstance(node, bytes):
                yield node
            else:
                open_ += [node[1][c] for c in sorted(node[1], reverse=True)]


def deep_shallow(data: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, run) of the suffixes at ``starts`` cut to ``length`` bytes.

    ``order`` sorts them, ``run`` numbers the runs of equal strings in that order. All suffixes
    have ``length`` bytes.
    """
    n = len(starts)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words = np.ndarray((len(data) + 1,), ">u8", data + bytes(8), strides=(1,))

    def keys(of: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes at a depth, those beyond the length cut off."""
        word = words[of + depth].astype(np.uint64)
        beyond = depth + 8 - length
        return word >> np.uint64(8 * beyond) if beyond > 0 else word

    shallow = range(0, min(SHALLOW, length), 8)
    order = np.arange(n)
    group = np.zeros(n, np.int64)
    open_ = np.arange(n)  # places in the order whose group is not yet sorted out
    for depth in shallow:  # multikey sorting: each pass parts all open groups by their next bytes
        key = keys(starts[order[open_]], depth)
        by = np.lexsort((key, group[open_]))
        order[open_] = order[open_][by]
        key, old = key[by], group[open_]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (old[1:] != old[:-1])])
        group[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]
        sizes = np.bincount(group, minlength=n)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            break
    # groups of one string are in order; the others go to blind tries
    differs = np.zeros(n, bool)
    for depth in range(SHALLOW, length, 8):
        key = keys(starts[order[open_]], depth)
        near = (group[open_][1:] == group[open_][:-1]) & (key[1:] != key[:-1])
        differs[group[open_][1:][near]] = True
    heads = np.flatnonzero(differs)
    sizes = np.bincount(group, minlength=n)
    run_start = np.zeros(n, bool)
    run_start[np.unique(group)] = True
    for head in heads.tolist():
        members = order[head:head + sizes[head]].tolist()
        texts = [data[s:s + length] for s in starts[members].tolist()]
        equal: dict[bytes, list[int]] = {}
        for text, member in zip(texts, members, strict=True):
            equal.setdefault(text, []).append(member)
        trie = _BlindTrie(texts[0])
        for text in equal:
            trie.insert(text)
        at = head
        for text in trie:
            run_start[at] = True
            order[at:at + len(equal[text])] = equal[text]
            at += len(equal[text])
    return order, np.cumsum(run_start) - 1


_ANSWER = "block int, bucket int, n int, shape binary, ids binary, bytes binary, total int"


def _answerer(length: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    names = [c.split()[0] for c in _ANSWER.split(", ")]

    def answer(table: pa.Table) -> pa.Table:
        """The smallest id of each window of the contexts, where it is not the sender's own."""
        bucket = table.column("bucket")[0].as_py()
        if bucket >= buckets:
            return table.select(names)
        sizes = table.column("n").to_pylist()
        anchors = np.concatenate([unpack(p, HASH_BYTES) for p in table.column("anchors").to_pylist()])
        shapes = [np.frombuffer(_expanded(p, 4 * n), np.uint16).reshape(2, n)
                  for p, n in zip(table.column("shape").to_pylist(), sizes, strict=True)]
        offset, extra = np.concatenate(shapes, axis=1).astype(np.int64)
        ids = np.concatenate([unpack(_expanded(p, 8 * n), 8, np.int64)
                              for p, n in zip(table.column("ids").to_pylist(), sizes, strict=True)])
        data = b"".join(_expanded(p, t) for p, t in zip(
            table.column("bytes").to_pylist(), table.column("total").to_pylist(), strict=True))
        ends = np.cumsum(extra + length)
        begins = ends - extra - length

        order = np.argsort(anchors, kind="stable")
        group = np.cumsum(np.concatenate([[True], np.diff(anchors[order]) > 0])) - 1
        of = np.empty(len(order), np.int64)
        of[order] = group
        # groups of one context: the smallest id that sent it stands for all windows
        smallest = np.full(group[-1] + 1, _NO_ID, np.int64)
        np.minimum.at(smallest, of, ids)
        head = order[np.searchsorted(group, of)]
        alike = (offset == offset[head]) & (extra == extra[head])
        for i in np.flatnonzero(alike & (head != np.arange(len(head)))).tolist():
            h = head[i]
            alike[i] = data[begins[i]:ends[i]] == data[begins[h]:ends[h]]
        several = np.bincount(of, ~alike, group[-1] + 1) > 0
        plain = np.flatnonzero(~several[of] & (smallest[of] < ids))
        rows = [(plain, np.zeros(len(plain), np.int64), extra[plain], smallest[of[plain]])]

        mixed_ = np.flatnonzero(several[of])
        if len(mixed_):  # all windows of the other contexts are suffixes
            counts = extra[mixed_] + 1
            context = np.repeat(mixed_, counts)
            window = np.arange(len(context)) - np.repeat(np.cumsum(counts) - counts, counts)
            place, run = deep_shallow(data, begins[context] + window, length)
            first = np.flatnonzero(np.diff(run, prepend=-1))
            least = np.minimum.reduceat(ids[context[place]], first)[run]
            best = np.empty(len(place), np.int64)
            best[place] = least
            # neighbouring windows of a context with one answer travel together
            change = np.concatenate([[True], (context[1:] != context[:-1]) | (best[1:] != best[:-1])])
            start = np.flatnonzero(change)
            stop = np.append(start[1:], len(best)) - 1
            useful = best[start] < ids[context[start]]
            start, stop = start[useful], stop[useful]
            rows.append((context[start], window[start], window[stop], best[start]))
        context, low, high, best = (np.concatenate(c) for c in zip(*rows, strict=True))
        by = np.argsort(context, kind="stable")
        context, low, high, best = context[by], low[by], high[by], best[by]
        at = np.cumsum([0, *sizes])
        parts = np.searchsorted(context, at)
        out = []
        for k, block in enumerate(table.column("block").to_pylist()):
            i, j = parts[k], parts[k + 1]
            if j > i:
                shape = np.stack([low[i:j], high[i:j]]).astype(np.uint16)
                out.append((block, bucket, j - i, _compressed(shape.tobytes()),
                            _compressed(pack(best[i:j], 8)),
                            _compressed(pack(context[i:j] - at[k], 4)), sizes[k]))
            else:
                out.append((block, bucket, 0, b"", b"", b"", sizes[k]))
        return _rows(out, names, [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(),
                                  pa.binary(), pa.int32()])

    return answer


# Removal ----------------------------------------------------------------------------------

_RESULT = "id long, row long, times long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remover(length: int, buckets: int, digest: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = in_order(docs)
        own = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        sent = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        cover = [None] * len(raws)
        if sent and sent[-1]["bucket"] >= buckets:
            where = sent.pop()
            n = where["n"]
            place, doc, first, _, extra = unpack(
                _expanded(where["bytes"], 40 * n), 8, np.int64).reshape(5, n)
            smallest = unpack(_expanded(where["ids"], 8 * where["total"]), 8, np.int64)
            # (context, first window, last window, smallest id): the block's own and the answers
            context = [np.arange(where["total"])]
            low = [np.zeros(where["total"], np.int64)]
            high = [np.full(where["total"], -1, np.int64)]
            high[0][place] = extra
            best = [smallest]
            before = 0
            for r in sent:
                if r["n"]:
                    shape = np.frombuffer(_expanded(r["shape"], 4 * r["n"]), np.uint16)
                    a, b = shape.reshape(2, r["n"]).astype(np.int64)
                    context.append(before + unpack(
                        _expanded(r["bytes"], 4 * r["n"]), 4, np.uint32).astype(np.int64))
                    low.append(a)
                    high.append(b)
                    best.append(unpack(_expanded(r["ids"], 8 * r["n"]), 8, np.int64))
                before += r["total"]
            context, low, high, best = map(np.concatenate, (context, low, high, best))
            # each answer meets each occurrence of its context
            order = np.argsort(place, kind="stable")
            starts = np.searchsorted(place[order], context)
            counts = np.searchsorted(place[order], context, "right") - starts
            which = np.repeat(np.arange(len(context)), counts)
            step = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = order[starts[which] + step]
            gone = best[which] < own[doc[at]]
            which, at = which[gone], at[gone]
            begin, end = first[at] + low[which], first[at] + high[which] + length
            of = doc[at]
            by = np.argsort(of, kind="stable")
            begin, end, of = begin[by], end[by], of[by]
            cut = np.searchsorted(of, np.arange(len(raws) + 1)).tolist()
            for d in np.unique(of).tolist():
                change = np.zeros(len(raws[d]) + 1, np.int64)
                np.add.at(change, begin[cut[d]:cut[d + 1]], 1)
                np.add.at(change, end[cut[d]:cut[d + 1]], -1)
                cover[d] = np.cumsum(change[:-1]) > 0
        rows = []
        for raw, covered in zip(raws, cover, strict=True):
            removed = spans = 0
            left = raw
            if covered is not None:
                removed = int(covered.sum())
                spans = int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum())
                left = np.frombuffer(raw, np.uint8)[~covered].tobytes()
            rows.append((len(raw), removed, spans,
                         hashlib.sha256(left).digest() if digest else left))
        in_table = list(zip(docs.column("row").to_pylist(), docs.column("times").to_pylist(), strict=True))
        back = sorted(range(len(ids)), key=_sort_key(docs))
        return _rows([(ids[k], *in_table[i], *rows[k]) for k, i in enumerate(back)],
                     [c.split()[0] for c in _RESULT.split(", ")],
                     [pa.int64()] * 6 + [pa.binary()])

    return remove


def _sort_key(docs: pa.Table) -> Callable[[int], tuple]:
    ids, texts = docs.column("id").to_pylist(), docs.column("text").to_pylist()
    return lambda i: (ids[i] is None, ids[i] or 0, texts[i] or "")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, digest: bool = False) -> DataFrame:
    """(id, row, n_bytes, n_removed, n_spans, kept) per row; ``kept`` are the bytes left.

    ``digest`` puts their SHA-256 in place of the bytes. ``row`` is xxhash64 of (id, text).
    """
    if length < GRAM + 1 or length - GRAM >= 1 << 15:
        raise ValueError(f"the length must be more than {GRAM} bytes and below 32 kB")
    rows, collapsed, buckets = text_blocks(docs, id_col, text_col)
    by_block = rows.groupBy("block")
    sent = by_block.applyInArrow(
        _sender(length, buckets), "bucket int, block int, anchors binary, many binary")
    flags = sent.groupBy("bucket").applyInArrow(
        _shared, "block int, bucket int, n int, bits binary")
    contexts = by_block.cogroup(flags.groupBy("block")).applyInArrow(
        _gatherer(length, buckets), _SENT)
    answers = contexts.groupBy("bucket").applyInArrow(_answerer(length, buckets), _ANSWER)
    found = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        _remover(length, buckets, digest), _RESULT)
    if collapsed:
        found = repeated(stored(found, "rows-without-repeats"))
    return found.drop("times").withColumnRenamed("id", id_col)
