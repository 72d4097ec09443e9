"""Components of the n-gram Jaccard self-join, by adaptive multi-match prefixes; links are not listed.

A document is the set of its distinct word shingles. All sets are sorted by one global order, rare
shingles first. If two sets reach the similarity, then for every l they share at least l
shingles within the first ``n - ceil(t n) + l`` of each. A document picks the l of least estimated
cost, (postings to read) + (size of the set) * (candidates, at most postings / l): a longer prefix
for documents of frequent shingles, which in turn requires that many shared prefix shingles (the
smaller l of a pair), and as many as make the similarity possible if all of the longer remainder
were shared, before the pair is verified. Shingles of one document only take up prefix places
but are never sent.

Documents with the same set are one class. Inside a list of up to ``SHORT_LIST`` documents all pairs
of classes are candidates, so candidates grow in proportion to postings. In longer lists, rounds of
leaders come first: each list compares its members with one of them, and members found connected
need no pair of their own. The first leader is the member with the smallest share of shingles of its
own: an original has hardly any, its edited copies have those of their edits, so that one leader
reaches most of a group whose copies are less alike among each other. After them, whoever is not in its list's largest component is compared
with all of that component and with the other strays, so no link between components is lost.

Words are runs of non-blanks with A-Z in lower case. Two documents link when
``100 * shared >= similarity_pct * united``; ``component_id`` is the smallest id reachable by links.
Sets are of 56-bit hashes.

Defined cases: null, empty and blank texts have an empty set and link with nothing; a text shorter
than a shingle is one shingle, its whole sequence. Repeated rows give one result each; rows of one id
with different texts are compared as different documents. A null id is never the smallest; where no
id is known the component is null. An empty table gives an empty result. Other columns are not read.

The text is shuffled once, in blocks; frequencies travel as packed rows (see ``blocks``). Whole sets
are stored once and shuffled only for documents in a pair whose prefixes met. Joins on shingles, classes or components are plain equi-joins, whose hot keys adaptive
execution splits; the sets of a leader that meets many others are replicated over salts. Labels
of components stay in tables of the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.arrow import give_back, pack, unpack
from starhouse.llm.blocks import HASH_BYTES, cuts, repeated, text_blocks
from starhouse.llm.words import forget_words, window_hashes, word_hashes
from starhouse.session import stored

WIDTH = 5
SIMILARITY_PCT = 75
MOST_MATCHES = 8  # the largest l that is considered
SHORT_LIST = 32
LEADER_ROUNDS = 2
PAIRS_PER_SALT = 256

_SENT_BYTES = 4
_MOST_BUCKETS = 1 << 8 * (HASH_BYTES - _SENT_BYTES)
_STEPS = 8  # frequency classes per doubling; a shingle of one document is in class 0


def _frequency_class(documents: np.ndarray) -> np.ndarray:
    steps = np.ceil(_STEPS * np.log2(np.maximum(documents, 1)))
    return np.where(documents < 2, 0, np.clip(steps, 1, 255)).astype(np.uint8)


_POSTINGS = 2.0 ** (np.arange(256) / _STEPS)
_SHORT_CLASS = int(_frequency_class(np.array([SHORT_LIST]))[0])


def _shingles(text: str | None, width: int) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    found = window_hashes(word_hashes(words), max(1, min(width, len(words))))
    found >>= np.uint64(64 - 8 * HASH_BYTES)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def _sets(table: pa.Table, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    sets = [_shingles(t, width) for t in table.column("text").to_pylist()]
    forget_words()  # blocks are many, and their worker goes on to other work
    return sets, np.concatenate(sets) if sets else np.empty(0, np.uint64)


# Frequencies ------------------------------------------------------------------------------


def _spreader(width: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Packed rows of the shingles of a block, without the leading bits that the bucket stands for.

    Four bytes of the rest are sent. Shingles that agree in them count as one: each gets a class too
    high, which costs time but loses nothing, since all documents order it by the same class.
    """
    cut = np.uint64(8 * HASH_BYTES - 8 * _SENT_BYTES - (buckets - 1).bit_length())

    def spread(table: pa.Table) -> pa.Table:
        shingles, counts = np.unique(_sets(table, width)[1], return_counts=True)
        block = table.column("block")[0].as_py()
        counts = np.minimum(counts, 0xFFFF).astype(np.uint16)
        rows = [(bucket, block, pack(shingles[i:j] >> cut, _SENT_BYTES), pack(counts[i:j], 2))
                for bucket, i, j in cuts(shingles, buckets)]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        del shingles, counts, rows
        give_back()
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["bucket", "block", "shingles", "counts"])

    return spread


def _classes(table: pa.Table) -> pa.Table:
    """The frequency class of every shingle that the blocks sent to a bucket."""
    lists = [unpack(p, _SENT_BYTES, np.uint32) for p in table.column("shingles").to_pylist()]
    counts = [unpack(p, 2, np.uint16) for p in table.column("counts").to_pylist()]
    distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
    documents = np.bincount(place, np.concatenate(counts), len(distinct))
    found = _frequency_class(documents)[place]
    at = np.cumsum([0, *map(len, lists)])
    parts = [found[i:j].tobytes() for i, j in zip(at, at[1:], strict=False)]
    del lists, counts, distinct, place, documents, found
    give_back()
    return pa.Table.from_arrays(
        [table.column("block"), table.column("bucket"), pa.array(parts, pa.binary())],
        ["block", "bucket", "classes"])


# Prefixes ---------------------------------------------------------------------------------


def choose_prefix(size: int, classes: np.ndarray, similarity_pct: int) -> tuple[int, int]:
    """(l, number of shared shingles in the prefix) of least cost.

    ``classes`` are the frequency classes of the shingles that other documents have too, in
    order; the other ``size - len(classes)`` shingles come before them.
    """
    required = -(-similarity_pct * size // 100)
    matches = np.arange(1, max(1, min(MOST_MATCHES, required)) + 1)
    taken = np.clip(size - required + matches - (size - len(classes)), 0, len(classes))
    postings = np.concatenate([[0.0], np.cumsum(_POSTINGS[classes[:taken[-1]]])])[taken]
    best = int(np.argmin(postings + size * postings / matches))
    return int(matches[best]), int(taken[best])


_PROFILE = ("id long, row long, times long, n long, digest binary, matches int, shared int, "
            "shingles array<long>, prefix array<long>, classes array<int>")
_PREFIX_BITS = np.uint64((1 << 8 * HASH_BYTES) - 1)


def _lists(parts: list[np.ndarray | None], kind: type) -> pa.Array:
    """A list per part, null where there is none."""
    offsets = np.cumsum([0, *(0 if p is None else len(p) for p in parts)], dtype=np.int32)
    values = [p for p in parts if p is not None]
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(np.concatenate(values).astype(kind) if values else [], pa.from_numpy_dtype(kind)),
        mask=pa.array([p is None for p in parts], pa.bool_()))


def _profiler(width: int, similarity_pct: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def profile(docs: pa.Table, frequencies: pa.Table) -> pa.Table:
        sets, together = _sets(docs, width)
        distinct = np.unique(together)
        order = np.argsort(frequencies.column("bucket").to_numpy())
        parts = frequencies.column("classes").to_pylist()
        classes = np.frombuffer(b"".join(parts[i] for i in order.tolist()), np.uint8)
        rows = []
        for own in sets:
            digest = xxhash.xxh3_128_digest(own) if len(own) else None
            of = classes[np.searchsorted(distinct, own)]
            held = own[of > 0]
            rank = (of[of > 0].astype(np.uint64) << np.uint64(8 * HASH_BYTES)) | held
            rank.sort()
            place = (rank >> np.uint64(8 * HASH_BYTES)).astype(np.uint8)
            matches, taken = choose_prefix(len(own), place, similarity_pct)
            if taken:
                rows.append((len(own), digest, matches, len(held), held,
                             rank[:taken] & _PREFIX_BITS, place[:taken]))
            else:
                rows.append((len(own), digest, None, None, None, None, None))
        *plain, shingles, prefix, places = zip(*rows, strict=True)
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        found = pa.Table.from_arrays(
            [*(docs.column(c) for c in ("id", "row", "times")),
             *(pa.array(c, k) for c, k in zip(plain, kinds, strict=True)),
             _lists(shingles, np.int64), _lists(prefix, np.int64), _lists(places, np.int32)],
            ["id", "row", "times", "n", "digest", "matches", "shared", "shingles", "prefix", "classes"])
        del sets, together, distinct, parts, classes, rows, plain, shingles, prefix, places
        del own, of, held, rank, place
        give_back()
        return found

    return profile


def profiles(docs: DataFrame, id_col: str, text_col: str, width: int,
             similarity_pct: int) -> DataFrame:
    """One row per document: set size and digest; prefix and shared shingles of possible partners."""
    rows, _, buckets = text_blocks(docs, id_col, text_col)
    buckets = min(1 << (buckets - 1).bit_length(), _MOST_BUCKETS)
    sent = rows.groupBy("block").applyInArrow(
        _spreader(width, buckets), "bucket int, block int, shingles binary, counts binary")
    frequencies = sent.groupBy("bucket").applyInArrow(
        _classes, "block int, bucket int, classes binary")
    return rows.groupBy("block").cogroup(frequencies.groupBy("block")).applyInArrow(
        _profiler(width, similarity_pct), _PROFILE)


# Components -------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(doc, label) of all ends of the edges (a, b): the smallest doc of each component."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("doc")).agg(
        F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("doc", "b"), "b")
                .groupBy(F.col("a").alias("doc")).agg(F.min("label").alias("other")))
        hooked = labels.join(near, "doc").select(
            "doc", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        # the label's own new label: paths shorten to a half in each pass
        ahead = hooked.select(F.col("doc").alias("label"), F.col("label").alias("next"))
        new = stored(hooked.join(ahead, "label").select(
            "doc", "old", F.least("label", "next").alias("label")), "labels")
        changed = not new.filter("old <> label").isEmpty()
        labels = new.select("doc", "label")
        if not changed:
            return labels


def _met(pairs: DataFrame, classes: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    """The pairs (a, b) with the columns ``kept`` of both classes, as ``_a`` and ``_b``.

    ``a`` may stand in very many pairs: its row is then replicated over salts.
    """
    busy = pairs.groupBy("a").agg(
        F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("salts"))
    left = (classes.select("doc", *kept).join(busy, F.col("doc") == F.col("a"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .select("a", "salt", *(F.col(c).alias(f"{c}_a") for c in kept)))
    right = classes.select(F.col("doc").alias("b"), *(F.col(c).alias(f"{c}_b") for c in kept))
    salted = pairs.join(busy, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    return salted.join(right, "b").join(left, ["a", "salt"])


_ABOUT = ("n", "matches", "shared", "prefix")  # what _promising reads


def _promising(one: str, other: str, similarity_pct: int):
    """Whether the prefixes of a pair (columns with suffixes) share enough for it to be verified.

    All that two sets share and that is not in both prefixes comes after the prefix that ends first,
    so it is at most the longer of the two remainders.
    """
    met = F.size(F.array_intersect(f"prefix{one}", f"prefix{other}"))
    rest = F.greatest(*(F.col(f"shared{c}") - F.size(f"prefix{c}") for c in (one, other)))
    united = F.col(f"n{one}") + F.col(f"n{other}") - met - rest
    return ((met >= F.least(f"matches{one}", f"matches{other}"))
            & ((met + rest) * 100 >= united * similarity_pct))


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, similarity_pct: int,
              prefixes_met: bool = False) -> DataFrame:
    """The pairs (a, b) that share enough prefix shingles and then reach the similarity.

    Whole sets travel only for pairs whose prefixes have met (``prefixes_met``: all of them).
    """
    if not prefixes_met:
        pairs = stored(_met(pairs, classes, _ABOUT).filter(
            _promising("_a", "_b", similarity_pct)).select("a", "b"), "met")
    ends = pairs.select(F.col("a").alias("doc")).distinct().union(
        pairs.select(F.col("b").alias("doc")).distinct()).distinct()
    whole = sets.join(ends, "doc", "left_semi").groupBy("doc").agg(
        F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return _met(pairs, whole, ("n", "shingles")).filter(
        shared * 100 >= (F.col("n_a") + F.col("n_b") - shared) * similarity_pct).select("a", "b")


def _fitting(left: str, right: str, similarity_pct: int):
    a, b = F.col(left), F.col(right)
    return (F.least(a, b) * 100 >= F.greatest(a, b) * similarity_pct)


def _short_pairs(postings: DataFrame, similarity_pct: int) -> DataFrame:
    """Pairs that meet in short lists often enough, counting what long lists could add."""
    short = postings.filter(F.col("class") <= _SHORT_CLASS).select(
        "shingle", "doc", "n", "matches", "long")
    a = short.select("shingle", *(F.col(c).alias(f"{c}_a") for c in short.columns[1:]))
    b = short.select("shingle", *(F.col(c).alias(f"{c}_b") for c in short.columns[1:]))
    met = a.join(b, "shingle").filter(
        (F.col("doc_a") < F.col("doc_b")) & _fitting("n_a", "n_b", similarity_pct))
    once = [c for c in met.columns if c != "shingle" and not c.startswith("n_")]
    return met.groupBy(*once).agg(F.count("*").alias("met")).filter(
        F.col("met") + F.least("long_a", "long_b") >= F.least("matches_a", "matches_b")
    ).select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc"))


def links(classes: DataFrame, sets: DataFrame, similarity_pct: int = SIMILARITY_PCT) -> DataFrame:
    """(doc, label) of the classes that have links: the components of the exact join.

    ``classes`` hold prefixes; ``sets`` the shared shingles, in one row or several of each class.
    """
    long = F.size(F.filter("classes", lambda c: c > _SHORT_CLASS))
    own = (F.col("n") - F.col("shared")) / F.col("n")
    postings = classes.select("doc", "n", "matches", long.alias("long"), own.alias("own"), F.explode(
        F.arrays_zip("prefix", "classes")).alias("p")).select(
        F.col("p.prefix").alias("shingle"), F.col("p.classes").alias("class"),
        "doc", "n", "matches", "long", "own")
    edges = stored(_verified(_short_pairs(postings, similarity_pct), classes, sets, similarity_pct),
                   "links")
    labels = components(edges)
    entries = stored(postings.filter(F.col("class") > _SHORT_CLASS)
                     .select("shingle", "doc", "n", "own"), "long-lists")
    tested: DataFrame | None = None
    for number in range(LEADER_ROUNDS + 1):
        known = _labelled(entries, labels)
        open_ = stored(
            known.groupBy("shingle", "label").agg(F.count("*").alias("c")).groupBy("shingle").agg(
                F.max(F.struct("c", "label")).alias("most"), F.count("*").alias("labels"))
            .filter("labels > 1").select("shingle", F.col("most.label").alias("major")),
            "open-lists")
        if open_.isEmpty():
            return labels
        last = number == LEADER_ROUNDS
        known = known.join(open_, "shingle")
        if last:
            far = F.filter(F.arrays_zip("prefix", "classes"), lambda p: p["classes"] > _SHORT_CLASS)
            listed = classes.select("doc", *_ABOUT, F.transform(
                far, lambda p: p["prefix"]).alias("far")).join(
                entries.select("doc").distinct(), "doc", "left_semi")
            met = _across(known, _labelled(listed, labels), similarity_pct)
        else:
            met = _with_leaders(known, number)
        pairs = met.filter(_fitting("n_a", "n", similarity_pct)).select(
            "a", F.col("doc").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        new = stored(_verified(pairs, classes, sets, similarity_pct, prefixes_met=last), "links")
        if not new.isEmpty():
            edges = edges.union(new)
            labels = components(edges)
        tested = pairs if tested is None else tested.union(pairs)
    return labels


def _with_leaders(known: DataFrame, number: int) -> DataFrame:
    """Each member of a list with the list's leader of this round, unless they are connected.

    The first leader has the smallest share of shingles of its own, later ones are drawn.
    """
    own = F.col("own") if number == 0 else F.lit(0.0)
    head = F.min(F.struct(own.alias("own_a"), F.xxhash64("doc", F.lit(number)).alias("draw"), F.col("doc").alias("a"),
                          F.col("n").alias("n_a"), F.col("label").alias("label_a")))
    leaders = known.groupBy("shingle").agg(head.alias("leader"))
    return known.join(leaders, "shingle").select("doc", "n", "label", "leader.*").filter(
        "label_a <> label")


def _across(known: DataFrame, members: DataFrame, similarity_pct: int) -> DataFrame:
    """All pairs of unconnected members of a list, whatever number of lists they share.

    Most of a list is in its largest component by now. The strays meet the members of that
    component once each, not once per shared list; the strays of a list meet each other in the
    smallest long list of both only (there one may be in the largest component: the first case).
    Both joins ask for enough shared prefix shingles themselves.
    """
    strays = known.filter("label <> major")
    sought = strays.select("doc", "major").distinct().join(members.drop("label"), "doc")
    kept = (*_ABOUT, "far")
    held = members.select(F.col("label").alias("label_a"), F.col("doc").alias("a"),
                          *(F.col(c).alias(f"{c}_a") for c in kept))
    fits = _fitting("n_a", "n", similarity_pct) & _promising("", "_a", similarity_pct)
    of_major = sought.join(held, (F.col("major") == F.col("label_a")) & fits)
    one = strays.select("shingle", "doc").join(members, "doc")
    other = one.select("shingle", F.col("label").alias("label_a"), F.col("doc").alias("a"),
                       *(F.col(c).alias(f"{c}_a") for c in kept)).withColumnRenamed("shingle", "list")
    here = F.array_min(F.array_intersect("far", "far_a")) == F.col("shingle")
    among = one.join(other, (F.col("shingle") == F.col("list"))
                     & (F.col("label_a") < F.col("label")) & here & fits)
    columns = ("doc", "n", "a", "n_a")
    return of_major.select(*columns).union(among.select(*columns))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = WIDTH, similarity_pct: int = SIMILARITY_PCT) -> DataFrame:
    """(id, n_shingles, component_id, row, head) per row; ``row`` is xxhash64 of (id, text).

    ``head`` is the ``row`` of the component's first: of the smallest id, or where rows share it or
    no id is known, of the smallest ``row`` among them. It is null for empty sets.
    """
    found = stored(profiles(docs, id_col, text_col, width, similarity_pct), "profiles")
    members = found.select("id", "row", "times", "n", "digest")
    able = found.filter("matches IS NOT NULL").withColumnRenamed("digest", "doc")
    classes = stored(able.groupBy("doc").agg(
        *(F.first(c).alias(c) for c in ("n", "matches", "shared", "prefix", "classes"))), "classes")
    labels = links(classes, able.select("doc", "n", "shingles"), similarity_pct)
    smallest = members.filter("digest IS NOT NULL").groupBy(F.col("digest").alias("doc")).agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    grouped = smallest.join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    heads = grouped.groupBy("label").agg(F.min("first").alias("head"))
    of_class = grouped.drop("first").join(heads, "label").select(
        F.col("doc").alias("digest"), F.col("head.id").alias("component_id"),
        F.col("head.row").alias("head"))
    rows = members.join(of_class, "digest", "left")
    if not members.filter("times > 1").isEmpty():
        rows = repeated(rows)
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.when(F.col("digest").isNull(), F.col("id"))).alias(
            "component_id"), "row", "head")
