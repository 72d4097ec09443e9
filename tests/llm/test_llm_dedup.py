"""N-gram join, suffix deduplication and line deduplication against brute force."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starhouse.llm import blocks, line_dedup, ngram_join, suffix_dedup, words
from starhouse.llm.arrow import short_batches

VOCABULARY = [f"w{i}" for i in range(300)]


def _texts(seed, groups=12):
    """Copies, near copies of all degrees, shared passages, short and blank texts."""
    r = random.Random(seed)
    words = lambda n: r.choices(VOCABULARY, k=n)
    passage, texts = words(60), [None, "", " \n", "One", "one", "ONE two", "a b c d", "A b c d"]
    for _ in range(groups):
        base = words(r.randint(8, 90))
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 18))):
                copy[r.randrange(len(copy))] = r.choice(VOCABULARY)
            if r.random() < 0.3:
                copy[:0] = passage
            texts.append(" ".join(copy))
        texts.append(texts[-1])
    r.shuffle(texts)
    return texts


def test_ngram_join_equals_all_pairs(spark):
    texts = _texts(1)
    df = brute.documents(spark, texts, extra="digest row n block label")
    found = brute.by_id(ngram_join.similar_groups(df))
    want = brute.components(texts)
    assert {i: r["component_id"] for i, r in found.items()} == dict(enumerate(want))
    assert {i: r["n_shingles"] for i, r in found.items()} == {
        i: len(brute.shingles(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_ngram_join_of_long_lists(spark, monkeypatch, rounds):
    """Leaders, and what is compared after them, lose no link of a large group."""
    monkeypatch.setattr(ngram_join, "_SHORT_CLASS", 8)
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_SALT", 3)
    r = random.Random(5)
    base = r.choices(VOCABULARY, k=50)
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(50)] = r.choice(VOCABULARY)
        texts.append(" ".join(copy))
    found = brute.by_id(ngram_join.similar_groups(brute.documents(spark, texts)))
    want = brute.components(texts)
    assert [found[i]["component_id"] for i in range(40)] == want


def test_ngram_join_of_nulls_repeats_and_nothing(spark):
    text = "a b c d e f g h"
    df = brute.documents(spark, [text, text, text, None, "x y"], ids=[7, 7, None, 3, None])
    found = {(r["doc_id"], r["n_shingles"], r["component_id"])
             for r in ngram_join.similar_groups(df).collect()}
    assert found == {(7, 4, 7), (None, 4, 7), (3, 0, 3), (None, 1, None)}
    assert ngram_join.similar_groups(df).count() == 5
    assert ngram_join.similar_groups(df.limit(0)).count() == 0


def test_a_block_leaves_no_words_behind():
    texts = ["one two three four five six", "seven eight", None]
    docs = pa.table({"block": [0] * 3, "id": [1, 2, 3], "row": [4, 5, 6], "times": [1] * 3, "text": texts})
    sent = ngram_join._spreader(5, 1)(docs)
    assert not words._hashes
    found = ngram_join._profiler(5, 75)(docs, ngram_join._classes(sent))
    assert not words._hashes and found.column("n").to_pylist() == [2, 1, 0]


def test_short_batches_last_as_long_as_their_block(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    before = spark.conf.get(name)
    with short_batches(spark, 7):
        longest = spark.range(100).mapInArrow(sizes, "n long").agg(F.max("n"), F.sum("n")).first()
    assert tuple(longest) == (7, 100) and spark.conf.get(name) == before


def test_rows_that_repeat_often_travel_once(spark, monkeypatch):
    """They are one row of a block, and as many rows of the result as of the input."""
    monkeypatch.setattr("starhouse.llm.blocks.MOST_REPEATS", 2)
    monkeypatch.setattr("starhouse.llm.blocks._RUN", 4)
    text = "a b c d e f g h" + " long passage" * 5
    df = brute.documents(spark, [text] * 13 + [None] * 3 + [text, "x y", text], ids=[7] * 13 + [None] * 3 + [9, 1, None])
    rows, collapsed, _ = blocks.text_blocks(df, "doc_id", "text")
    assert collapsed and sorted(r["times"] for r in rows.collect()) == [1, 1, 1, 3, 13]
    found = Counter((r["doc_id"], r["component_id"]) for r in ngram_join.similar_groups(df).collect())
    assert found == {(7, 7): 13, (None, None): 3, (9, 7): 1, (1, 1): 1, (None, 7): 1}
    found = Counter((r["doc_id"], r["n_removed"]) for r in suffix_dedup.remove_repeats(df).collect())
    assert found == {(7, 0): 13, (None, 0): 3, (9, len(text)): 1, (1, 0): 1, (None, len(text)): 1}


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.lists(st.integers(1, 255), max_size=60).map(sorted))
def test_prefixes_hold_enough_matches(size, classes):
    """A prefix ends where l of the required shingles must lie before it."""
    classes = np.array(classes[:size], np.int32)
    matches, taken = ngram_join.choose_prefix(size, classes, 75)
    required = -(-75 * size // 100)
    assert 1 <= matches <= required
    assert taken == max(0, min(len(classes), len(classes) - required + matches))


def _passages(seed):
    r = random.Random(seed)
    letters = "abcdefghij éß\n"
    random_text = lambda n: "".join(r.choices(letters, k=n))
    shared = [random_text(r.randint(40, 200)) for _ in range(6)]
    texts = [None, "", "x" * 49, "x" * 200, "x" * 300, "ab" * 80, "ab" * 90]
    for _ in range(30):
        parts = [random_text(r.randint(0, 80))]
        for _ in range(r.randint(0, 3)):
            piece = r.choice(shared)
            a = r.randint(0, len(piece) // 2)
            if r.random() < 0.4:
                piece = piece[:a] + r.choice(letters) + piece[a + 1:]
            parts += [piece[r.randint(0, 3):], random_text(r.randint(0, 60))]
        texts.append("".join(parts))
    texts += [texts[-1], texts[-2], random_text(3000)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr("starhouse.llm.blocks.SMALLEST_BLOCK", 1500)
    monkeypatch.setattr("starhouse.llm.blocks.BUCKET_BYTES", 2000)
    rows = list(enumerate(_passages(seed)))
    df = brute.documents(spark, [t for _, t in rows], extra="row block n kept")
    found = brute.by_id(suffix_dedup.remove_repeats(df))
    for (i, t), (removed, spans, kept) in zip(rows, brute.kept_bytes(rows), strict=True):
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (
            len((t or "").encode()), removed, spans, kept)


def test_suffix_dedup_of_nulls_repeats_and_nothing(spark):
    text = "0123456789" * 3 + "abcdefghijklmnopqrstuvwxyz" * 2
    df = brute.documents(spark, [text, text, text, None], ids=[4, 4, None, None])
    found = sorted(((r["doc_id"] is None, r["n_bytes"], r["n_removed"])
                    for r in suffix_dedup.remove_repeats(df).collect()))
    assert found == [(False, 82, 0), (False, 82, 0), (True, 0, 0), (True, 82, 82)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_suffix_dedup_cuts_very_long_documents_in_pieces(monkeypatch):
    raw = random.Random(3).randbytes(5000)
    whole = suffix_dedup._document_anchors(raw, 50)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    cut = suffix_dedup._document_anchors(raw, 50)
    windows = lambda a: {(int(x), w) for x, f, l in zip(*a[:3], strict=True)  # noqa: E731, E741
                         for w in range(f, l + 1)}
    assert windows(whole) == windows(cut)
    assert {w for _, w in windows(whole)} == set(range(len(raw) - 49))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3]), min_size=60, max_size=400).map(bytes))
def test_deep_shallow_sorts_suffixes(data):
    starts = np.arange(len(data) - 49)
    order, run = suffix_dedup.deep_shallow(data, starts, 50)
    texts = [data[s:s + 50] for s in starts[order]]
    assert texts == sorted(texts)
    assert [len(set(texts[:i + 1])) - 1 for i in range(len(texts))] == run.tolist()
    assert sorted(order.tolist()) == starts.tolist()


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(2)
    lines = [f"this is the repeated line number {i}" for i in range(8)] + ["short", "", "  "]
    variants = [lambda x: x, str.upper, lambda x: f" \t{x}\x0b ", str.title]
    texts = [None, "", "\n", "É" * 25, "é" * 25, "É" * 25, " " + "x" * 20, "x" * 20, "X" * 20]
    for _ in range(25):
        texts.append("\n".join(r.choice(variants)(r.choice(lines)) for _ in range(r.randint(1, 9))))
    rows = list(enumerate(texts))
    df = brute.documents(spark, texts, extra="own_0 n_lines h1 gone key")
    found = brute.by_id(line_dedup.drop_repeated_lines(df))
    for (i, _), want in zip(rows, brute.kept_lines(rows), strict=True):
        assert (found[i]["n_lines"], found[i]["n_dropped"], found[i]["text"]) == want
        assert (found[i]["source"], found[i]["own_0"], found[i]["h1"]) == ("s", "x", "x")


def test_line_dedup_of_nulls_repeats_and_nothing(spark):
    line = "a line of more than twenty characters"
    df = brute.documents(spark, [line, line, line, None], ids=[5, 5, None, 9])
    found = sorted((r["doc_id"] or 0, r["n_dropped"], r["text"])
                   for r in line_dedup.drop_repeated_lines(df).collect())
    assert found == [(0, 1, ""), (5, 0, line), (5, 0, line), (9, 0, "")]
    unknown = brute.documents(spark, [line] * 3, ids=[None] * 3)
    assert {r["n_dropped"] for r in line_dedup.drop_repeated_lines(unknown).collect()} == {0}
    assert line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_line_hashes_are_seeded_apart(spark):
    h1, h2 = spark.range(1).select(*line_dedup._hashes(F.lit("some line"))).first()
    chained = xxhash.xxh64_intdigest(b"second", seed=h1 % 2**64)
    assert h1 % 2**64 == xxhash.xxh64_intdigest(b"some line", seed=42)
    assert h2 % 2**64 != chained


def test_line_dedup_runs_no_python(spark):
    df = line_dedup.drop_repeated_lines(brute.documents(spark, ["a\nb"]))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_very_long_text(spark):
    long = "\n".join(f"line {i % 700} of a very long text, long enough" for i in range(20_000))
    df = brute.documents(spark, [long, long + "x", "short", long[:400_000]])
    assert by_component(ngram_join.similar_groups(df)) == [0, 0, 2, 0]
    dropped = brute.by_id(line_dedup.drop_repeated_lines(df))
    want = brute.kept_lines(list(enumerate([long, long + "x", "short", long[:400_000]])))
    assert [dropped[i]["n_dropped"] for i in range(4)] == [w[1] for w in want]
    cut = brute.by_id(suffix_dedup.remove_repeats(df))
    assert cut[0]["n_removed"] == 0 and cut[3]["n_removed"] == cut[3]["n_bytes"]
    assert cut[1]["n_removed"] >= cut[1]["n_bytes"] - 50


def by_component(df):
    found = brute.by_id(df)
    return [found[i]["component_id"] for i in sorted(found)]
