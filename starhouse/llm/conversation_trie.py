"""Conversation prefix trie with rollups by centroid decomposition.

A node is a distinct sequence of first turns. It is named by its smallest member and its depth, so a
node's ancestors are found by key: they are the nodes of the same conversation at smaller depths.
Prefixes are compared by two 64-bit sums (exclusive or) of hashes of (place, turn).

Totals over subtrees are rolled up by centroid decomposition of the parent-edge forest. A node weighs
as many conversations as pass through it, so the weight of each subtree is known from the members'
lengths alone. In a component of weight T the nodes whose subtree weighs more than T / 2 form a path
that ends at its top; the lowest of them is the centroid. The component's total below the centroid
is added to the path from the centroid to the top. Then the centroid is done, its child subtrees and
the rest above it become components, none heavier than T / 2: rounds grow with the logarithm of
the rows, however deep the trie. A node needs one look-up in a round, whether its ancestor at the
centroid's depth is the centroid. All components of a round are worked on together.

Defined cases: rows are ordered by turn (null first), then by role and by a hash of the text; null role or
text is the empty text; repeated rows are turns of their own; rows without a conversation id are in
no conversation. An empty table gives no node, also no root. Other columns are not read.

Only hashes and word counts of turns are shuffled. Places in a conversation come from a range sort,
prefixes from chunked windows (see ``running``), counts are combined before the shuffle, and joins with
a hot node are plain equi-joins that adaptive execution splits; components are broadcast while they
are at most ``BROADCAST_ROWS``. Conversations that end at one node travel as sorted lists of at
most 2 ** ``ENDS_SPAN_BITS`` ids; the digest of all of them is read as a stream, as such a digest has to be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.running import placed, running
from starhouse.session import stored

BROADCAST_ROWS = 50_000
ENDS_SPAN_BITS = 12

#: Fixed values of the rebuilding rule: conversations that share a base, and its first turns that vary.
FAMILY, HEADS = 20, 4

_KEY = ("depth", "id1", "id2")


def hashed_turns(rows: DataFrame) -> DataFrame:
    """(conv, h1, h2, words, place, size) per turn: two hashes, its words, its place in the conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit("second"), text, role).alias("h2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))
    return placed(turns, "conv", ["turn", "role", "h1", "h2"], ["conv", "h1", "h2", "words"])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv, depth, h1, h2, words) per turn and (conv, length) of each."""
    base = F.col("conv") - F.col("conv") % FAMILY
    convs = turns.groupBy("conv").agg(F.max("size").alias("size")).select(
        "conv", "size", base.alias("base"), (F.crc32(F.col("conv").cast("string")) % HEADS).alias("h"))
    convs = stored(convs, "conversations")
    bases = convs.filter("conv = base").select("base", F.col("size").alias("base_size"))
    convs = convs.join(bases, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_size", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    lengths = stored(convs.select("conv", "base", "h", "taken", length.alias("length")), "lengths")
    own = turns.join(lengths.select("conv", "h", "taken"), "conv").filter("place > h").select(
        "conv", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "h1", "h2", "words")
    heads = turns.filter((F.col("place") < HEADS) & (F.col("conv") % FAMILY == 0)).select(
        F.col("conv").alias("base"), F.col("place").alias("depth"), "h1", "h2", "words")
    first = lengths.join(heads, "base").filter("depth <= h").select(
        "conv", "depth", "h1", "h2", "words")
    return first.union(own), lengths.select("conv", "length")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, depth, id1, id2, up1, up2, words, length): each prefix by its hashes and its parent's."""
    one, two = F.xxhash64("depth", "h1", "h2"), F.xxhash64(F.lit("second"), "depth", "h2", "h1")
    terms = turns.select("conv", "depth", "words", one.alias("t1"), two.alias("t2"))
    found = running(terms, "conv", "depth", {"id1": F.col("t1"), "id2": F.col("t2")}, F.bit_xor,
                    lambda a, b: a.bitwiseXOR(b))
    return found.join(lengths, "conv").select(
        "conv", "depth", "id1", "id2", F.col("id1").bitwiseXOR(F.col("t1")).alias("up1"),
        F.col("id2").bitwiseXOR(F.col("t2")).alias("up2"), "words", "length")


def trie_nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(depth, id1, id2, head, n_convs, weight, words, parent, n_children) per node; the root has depth 0."""
    below = F.col("length") - F.col("depth") + 1
    nodes = rows.groupBy(*_KEY).agg(
        F.min("conv").alias("head"), F.count("*").alias("n_convs"), F.sum(below).alias("weight"),
        F.first("words").alias("words"), F.first("up1").alias("up1"), F.first("up2").alias("up2"))
    root = lengths.agg(F.min("conv").alias("head"), F.count("*").alias("n_convs"),
                       F.sum(F.col("length") + 1).alias("weight")).filter("n_convs > 0")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = root.select(zero.alias("depth"), zero.alias("id1"), zero.alias("id2"), "head", "n_convs",
                       "weight", zero.alias("words"), none.alias("up1"), none.alias("up2"))
    nodes = stored(nodes.unionByName(root), "trie-nodes")
    up = (F.col("depth") == F.col("p_depth") + 1) & (F.col("up1") == F.col("p1")) & (F.col("up2") == F.col("p2"))
    parents = nodes.select(F.col("depth").alias("p_depth"), F.col("id1").alias("p1"),
                           F.col("id2").alias("p2"), F.col("head").alias("parent"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("id1"),
                                                 F.col("up2").alias("id2")).agg(F.count("*").alias("n_children"))
    return nodes.join(parents, up, "left").join(children, list(_KEY), "left").select(
        *_KEY, "head", "n_convs", "weight", "words", "parent",
        F.coalesce("n_children", F.lit(0)).alias("n_children"))


def trie_paths(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(path, depth, head, parent): the nodes that the conversations which name a node pass through."""
    named = nodes.select(F.col("head").alias("path")).distinct()
    steps = rows.select(F.col("conv").alias("path"), *_KEY).join(named, "path", "left_semi")
    zero = F.lit(0).cast("bigint")
    steps = steps.union(named.select("path", zero, zero, zero))
    return steps.join(nodes.select(*_KEY, "head", "parent"), list(_KEY)).select(
        "path", "depth", "head", "parent")


# Rollup -------------------------------------------------------------------------------------


def _small(rows: DataFrame) -> DataFrame:
    """The stored rows, for a broadcast while they are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def rollup(nodes: DataFrame, paths: DataFrame, values: Sequence[str]) -> DataFrame:
    """(head, depth, values...) with each value added up over the node's subtree, itself included.

    ``nodes`` are (head, depth, weight, values...): ``weight`` is the known weight of the subtree, more
    than that of its child subtrees together. ``paths`` are (path, depth, head, parent): the nodes, and
    their parents' heads, on the path from the root through the node (path, depth). Any forest will do.
    """
    zero = F.lit(0).cast("bigint")
    tops = paths.filter("parent IS NULL").select(
        F.col("path").alias("head"), F.col("head").alias("top"), F.col("depth").alias("top_depth"))
    state = nodes.join(tops, "head").select(
        "head", "depth", "weight", "top", "top_depth",
        *[F.col(v).cast("bigint").alias(v) for v in values], *[zero.alias(f"sum_{v}") for v in values])
    state = stored(state, "components")
    component = ["top", "top_depth"]
    done: list[DataFrame] = []
    while not state.isEmpty():
        total = state.filter("head = top AND depth = top_depth").select(*component, F.col("weight").alias("total"))
        total = _small(stored(total, "totals"))
        chain = state.join(total, component).filter(F.col("weight") * 2 > F.col("total"))
        lowest = F.max(F.struct(F.col("depth").alias("z_depth"), F.col("head").alias("z"),
                                F.col("weight").alias("z_weight"), "total"))
        centroids = _small(stored(chain.groupBy(*component).agg(lowest.alias("m")).select(
            *component, "m.*"), "centroids"))
        marked = state.join(centroids, component).withColumn(
            "on_path", F.col("weight") * 2 > F.col("total"))
        at = paths.select(F.col("path").alias("head"), (F.col("depth") - 1).alias("z_depth"),
                          F.col("head").alias("child"), F.col("parent").alias("of"))
        deeper = ~F.col("on_path") & (F.col("depth") > F.col("z_depth"))
        below = marked.filter(deeper).join(at, ["head", "z_depth"], "left").withColumn(
            "under", F.coalesce(F.col("of") == F.col("z"), F.lit(False)))
        rest = marked.filter(~deeper).withColumns({
            "child": F.lit(None).cast("bigint"), "of": F.lit(None).cast("bigint"),
            "under": F.col("on_path") & (F.col("depth") == F.col("z_depth"))})
        marked = stored(below.unionByName(rest), "marked")
        gains = marked.filter("under").groupBy(*component).agg(
            *[F.sum(v).alias(f"gain_{v}") for v in values])
        gains = _small(stored(gains, "gains"))
        path = marked.filter("on_path").join(gains, component).withColumns(
            {f"sum_{v}": F.col(f"sum_{v}") + F.col(f"gain_{v}") for v in values})
        done.append(stored(path.filter("depth = z_depth").select(
            "head", "depth", *[F.col(f"sum_{v}").alias(v) for v in values]), "rolled-up"))
        above = path.filter("depth < z_depth").withColumn("weight", F.col("weight") - F.col("z_weight"))
        off = marked.filter("NOT on_path").withColumns({
            "top": F.when(F.col("under"), F.col("child")).otherwise(F.col("top")),
            "top_depth": F.when(F.col("under"), F.col("z_depth") + 1).otherwise(F.col("top_depth"))})
        state = stored(above.select(*state.columns).union(off.select(*state.columns)), "components")
    if not done:
        return nodes.select("head", "depth", *[F.col(v).cast("bigint").alias(v) for v in values])
    return reduce(DataFrame.union, done)


# Members that end at a node -----------------------------------------------------------------


def endings(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(depth, id1, id2, span, convs): sorted ids of the conversations that end at a node, in spans of ids."""
    zero = F.lit(0).cast("bigint")
    ends = rows.filter("depth = length").select("conv", *_KEY).union(
        lengths.filter("length = 0").select("conv", zero, zero, zero))
    return ends.groupBy(*_KEY, F.shiftright("conv", ENDS_SPAN_BITS).alias("span")).agg(
        F.array_sort(F.collect_list("conv")).alias("convs"))


def ending_digests(ends: DataFrame) -> DataFrame:
    """(depth, id1, id2, ends_sha256): digest of the comma-joined ids, read in order as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            found: list[tuple] = []
            keys = zip(*(batch.column(c).to_pylist() for c in _KEY), strict=True)
            for own, text in zip(keys, batch.column("listed").to_pylist(), strict=True):
                if own != key:
                    if key is not None:
                        found.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if found:
                yield _digest_rows(found)
        if key is not None:
            yield _digest_rows([(*key, state.hexdigest())])

    listed = F.array_join(F.transform("convs", lambda c: c.cast("string")), ",")
    return (ends.select(*_KEY, "span", listed.alias("listed")).repartition(*_KEY)
            .sortWithinPartitions(*_KEY, "span")
            .mapInArrow(digest, "depth long, id1 long, id2 long, ends_sha256 string"))


def _digest_rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
        [*_KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: its counts, its subtree's leaves and saved tokens, a digest of who ends there."""
    turns, lengths = rebuilt(stored(hashed_turns(conversations), "turns"))
    rows = stored(prefixes(turns, lengths), "prefixes")
    nodes = stored(trie_nodes(rows, lengths), "trie")
    paths = stored(trie_paths(rows, nodes), "paths")
    measured = nodes.select(
        "head", "depth", "weight", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = rollup(measured, paths, ["n_leaves", "saved_tokens"])
    digests = ending_digests(endings(rows, lengths))
    return (nodes.join(totals, ["head", "depth"]).join(digests, list(_KEY), "left").select(
        F.col("head").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))

