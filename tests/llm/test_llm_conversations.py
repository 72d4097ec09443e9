"""Conversation trie and chat formatting against plain versions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import DATA
from starhouse.llm import chat_format, conversation_trie, queries, running

KIND = "conv_id long, turn long, role string, text string"


def _table(spark, rows, extra="'x' AS head, 1 AS place, 'y' AS conv"):
    return spark.createDataFrame(rows, KIND).selectExpr("*", *extra.split(", "))


def _ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    return {c: [t[1:] for t in sorted(own)] for c, own in convs.items()}


def plain_trie(rows):
    turns = _ordered([r for r in rows if r[0] is not None])
    full = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / abs(c or 1)) * (abs(c) - abs(c) % 20)
        full[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, own in sorted(full.items()):
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        own = [0 if kids[node] else 1, (len(members[node]) - 1) * words]
        totals[node] = [sum(x) for x in zip(own, *(totals[k] for k in kids[node]), strict=True)]
    out = set()
    for node, who in members.items():
        ends = ",".join(str(c) for c in who if len(full[c]) == len(node))
        out.add((who[0], len(node), members[node[:-1]][0] if node else None, len(who), len(kids[node]),
                 *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _check_trie(spark, rows):
    found = conversation_trie.prefix_trie(_table(spark, rows)).collect()
    want = plain_trie(rows)
    assert len(found) == len(want)
    assert {tuple(r) for r in found} == want


def test_trie_of_odd_conversations(spark):
    rows = [(0, 0, "user", "hello there"), (0, 1, "assistant", "hi"), (0, None, None, None), (0, 2, "user", "bye now"),
            (1, 0, "user", "hello there"), (1, 0, "user", "hello there"), (2, 5, None, "a b  c"), (2, 5, "", "a b  c"),
            (-3, 0, "user", "below zero"), (-25, 1, "user", "hello there"), (-25, 2, "x", ""), (-20, 0, "user", "base"),
            (23, 0, "user", "only"), (41, 0, "user", "one"), (41, 1, "user", "two"), (41, 2, "user", "two"),
            (None, 0, "user", "nobody"), (None, None, None, None), (60, 0, "user", "hello there"),
            (10**15 + 7, 1, "user", "far " * 4000)]
    rows += [(100 + i, d, "user", f"turn {d}") for i in range(8) for d in range(i + 1)]
    rows += [(200 + i, d, "user", "same") for i in range(20) for d in range(6)]
    _check_trie(spark, rows)


def test_empty_trie(spark):
    docs = _table(spark, [(None, 0, "user", "x")])
    assert conversation_trie.prefix_trie(docs).collect() == []
    assert conversation_trie.prefix_trie(docs.limit(0)).collect() == []


def test_one_conversation_of_very_many_turns(spark, monkeypatch):
    monkeypatch.setattr(running, "CHUNK_BITS", 3)
    rows = [(7, i, "user", f"word {i % 5}") for i in range(300)]
    rows += [(7 + 20 * k, i, "user", f"word {i % 5}" if i < 40 * k else "other") for k in (1, 2, 3) for i in range(90)]
    rows += [(0, i, "user", f"word {i % 5}") for i in range(3)] + [(20, 0, "user", "else")]
    _check_trie(spark, rows)


def test_trie_of_random_conversations_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(1)
    rows = [(int(c), d, "user", f"w{rng.integers(0, 2)} x") for c in rng.choice(400, 120, replace=False)
            for d in range(int(rng.integers(1, 9)))]
    _check_trie(spark, rows)


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    rounds = []
    kept = conversation_trie.stored
    monkeypatch.setattr(conversation_trie, "stored",
                        lambda df, name: (rounds.append(name), kept(df, name))[1])
    rows = [(20, i, "user", f"w{i}") for i in range(200)]
    nodes = conversation_trie.prefix_trie(_table(spark, rows))
    assert nodes.filter("n_leaves = 1").count() == 201
    assert rounds.count("centroids") <= 9


def test_op12_covers_every_conversation(spark):
    found = queries.op12_conversation_trie(spark, f"{DATA}/sf0.001")
    root = found.filter("depth = 0").collect()
    assert len(root) == 1 and root[0]["parent_conv_id"] is None
    conversations = spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet")
    assert root[0]["n_convs"] == conversations.select("conv_id").distinct().count()


# Chat formatting ----------------------------------------------------------------------------


def plain_digests(rows):
    out = {}
    for c, own in _ordered(rows).items():
        loss = "".join(t for r, t in own if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in own)
        out[c] = (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def _formatted(spark, rows, **options):
    return chat_format.format_conversations(_table(spark, rows), queries.RANKS, queries.PATTERN, **options)


def _check_formatted(rows, formatted):
    found = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    want = plain_digests(rows)
    assert {c: tuple(r)[1:5] for c, r in found.items()} == want
    windows = formatted.windows().orderBy("conv_id", "segment", "window").collect()
    for c, r in found.items():
        own = [w for w in windows if w["conv_id"] == c]
        assert r["formatted_chars"] == sum(len(w["formatted"]) for w in own)
    return windows


CONTROLS = ["<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]", "\\",
            "<", "[", "s>", "/s>", "<s", "é", "\n", " "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool", "<s>", "[TEXT]\\"]),
                          st.lists(st.sampled_from(CONTROLS), max_size=8).map("".join)), max_size=4))
def test_template_is_reversible(turns):
    whole = "".join(chat_format.format_turn(r, t)[0] for r, t in turns)
    assert chat_format.parse(whole) == turns
    for role, text in turns:
        piece, i, j = chat_format.format_turn(role, text)
        assert chat_format.unescape(piece[i:j]) == text
        assert not any(c in piece[i:j] for c in CONTROLS[:9])


def test_chat_of_odd_rows(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, None, None, None),
            (2, 0, "system", "be kind"), (2, 1, "user", "é" * 30), (2, 1, "user", "é" * 30), (2, 2, "assistant", None),
            (None, 0, "user", "nobody"), (None, 1, "assistant", "x\\y"), (3, 0, "tool", "<s>"), (4, 0, "assistant", ""),
            (-7, 2, "assistant", "second"), (-7, 1, "user", "first"), (5, 0, "user", "far " * 30_000)]
    windows = _check_formatted(rows, _formatted(spark, rows))
    assert [w["over_budget"] for w in windows if w["conv_id"] == 5] == [True]
    assert chat_format.read_back(_formatted(spark, rows[:1])).count() == 1
    empty = chat_format.format_conversations(_table(spark, rows).limit(0), queries.RANKS, queries.PATTERN)
    assert chat_format.read_back(empty).count() == 0


@pytest.mark.parametrize("segment_bytes", [1 << 20, 2000])
def test_windows_keep_to_the_budget(spark, segment_bytes):
    rng = np.random.default_rng(4)
    rows = [(c, i, ["user", "assistant"][i % 2] if i else "system",
             " ".join(f"c{c}t{i}" for _ in range(int(rng.integers(1, 40))))) for c in (1, 2) for i in range(60)]
    rows += [(3, i, "assistant", f"t{i}") for i in range(5)]
    windows = _check_formatted(rows, _formatted(spark, rows, budget=600, segment_bytes=segment_bytes))
    assert (len({w["segment"] for w in windows if w["conv_id"] == 1}) == 1) == (segment_bytes > 2000)
    seen = defaultdict(int)
    for w in windows:
        turns = chat_format.parse(w["formatted"])
        assert w["n_tokens"] <= 600 and not w["over_budget"] and w["n_own"] > 0
        conv, at = w["conv_id"], seen[w["conv_id"]]
        mine = [(r[2], r[3]) for r in rows if r[0] == conv]
        repeated = turns[:w["n_repeated"]]
        if conv < 3 and at:
            assert repeated[0] == mine[0]
            history = repeated[1:]
            assert len(history) <= 2 and history == mine[at - len(history):at]
        else:
            assert not repeated
        assert turns[w["n_repeated"]:] == mine[at:at + w["n_own"]]
        seen[conv] += w["n_own"]
        targets = [chat_format.unescape(w["formatted"][i:j])
                   for i, j in zip(w["loss_start"], w["loss_end"], strict=True)]
        assert targets == [t for r, t in mine[at:at + w["n_own"]] if r == "assistant"]
    assert seen == {1: 60, 2: 60, 3: 5}
    assert any(w["n_repeated"] > 1 for w in windows)


def test_op13_equals_plain_digests(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()] + queries.PLANTED_TURNS
    found = queries.op13_chat_formatting(spark, f"{DATA}/sf0.001").collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in found} == plain_digests(rows)
    assert len(found) == len({r[0] for r in rows}) and max(r["n_windows"] for r in found) > 1
