r"""Chat formatting in budgeted, turn-aligned windows with a loss mask.

A conversation becomes windows of formatted turns. Prefix sums of the turns' tokens choose the
longest span of turns that fits the budget next to what the window repeats: the system turn, which
every window retains, and up to ``history_turns`` turns of at most a quarter of the budget that come
before the span. Repeated turns are not targets again: the loss mask covers the text of each assistant
turn once, in the window that owns the turn. A turn is never cut; a window whose one own turn does not
fit lets go of its history, and is marked ``over_budget`` if that does not do.

The template writes ``<<SYS>>text<</SYS>>`` for a system turn, ``[INST]text[/INST]`` for a user's,
``<s>text</s>`` for an assistant's and ``[ROLE]role[TEXT]text[/ROLE]`` for any other. Inside texts and
roles a backslash follows the first character of each control string and doubles each backslash,
so no control string is left in them; ``parse`` undoes it. Tokens are those of byte-level BPE, counted
for each formatted turn.

Defined cases: rows are ordered by turn (null first), then by role and text; a null text is the empty
text and a null role the empty role; repeated rows are turns of their own; rows without a conversation id
are one conversation. A system turn is retained if it comes first and takes at most half the budget. An
empty table gives no window. Other columns are not read.

Conversations of up to ``SEGMENT_BYTES`` are shuffled once and formatted as a sorted stream; their windows
come in order. Longer ones are numbered by range and cut into segments by running sums of their bytes
(see ``running``), so that one conversation with most of the rows spreads over many tasks; a window
stays inside its segment, and a segment is given the system turn and the turns before it. A task holds
one segment at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.bpe import encoder
from starhouse.llm.running import placed, running
from starhouse.session import stored

BUDGET = 1024
HISTORY_TURNS = 2
SEGMENT_BYTES = 1 << 20

#: The marks before and after a turn's text, by role.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_MARK, TEXT_MARK, ROLE_END = "[ROLE]", "[TEXT]", "[/ROLE]"

_CONTROLS = [*(m for pair in MARKS.values() for m in pair), ROLE_MARK, TEXT_MARK, ROLE_END]
_ANY = "|".join(map(re.escape, _CONTROLS))
_TO_ESCAPE = re.compile(rf"\\|{_ANY}")
_SCAN = re.compile(rf"\\.|({_ANY})", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_OPENS = {pair[0]: role for role, pair in MARKS.items()}

_SYSTEM, _HISTORY, _OWN = 0, 1, 2


# Template -----------------------------------------------------------------------------------


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:] if m[0] != "\\" else "\\\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends in it."""
    body = escape(text)
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = f"{ROLE_MARK}{escape(role)}{TEXT_MARK}", ROLE_END
    return before + body + after, len(before), len(before) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each formatted turn."""
    turns: list[tuple[str, str]] = []
    role, start = "", 0
    for found in _SCAN.finditer(formatted):
        mark = found[1]
        if mark == TEXT_MARK:
            role, start = unescape(formatted[start:found.start()]), found.end()
        elif mark == ROLE_MARK or mark in _OPENS:
            role, start = _OPENS.get(mark, ""), found.end()
        elif mark:
            turns.append((role, unescape(formatted[start:found.start()])))
    return turns


# Windows ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Turn:
    role: str
    piece: str
    text: tuple[int, int]
    tokens: int


def choose_windows(system: Turn | None, before: Sequence[Turn], own: Sequence[Turn], begins: bool,
                   budget: int, history_turns: int) -> Iterator[tuple[list[Turn], list[Turn], bool]]:
    """(repeated turns, own turns, over budget) per window; ``system`` and ``before`` precede ``own``.

    ``begins``: the conversation begins with ``own``.
    """
    known = [*before, *own]
    sums = np.cumsum([0, *(t.tokens for t in known)])
    at = len(before)
    first = begins and own[0].role == "system"
    retained = own[0] if first and own[0].tokens * 2 <= budget else system
    while at < len(known):
        kept = [retained] if retained is not None and not (first and at == 0) else []
        left = budget - sum(t.tokens for t in kept)
        # the history is the longest run of turns before the span within its own limits
        since = int(np.searchsorted(sums, sums[at] - budget // 4))
        since = min(max(since, at - history_turns, 1 if first else 0), at)
        if sums[at + 1] - sums[since] > left:
            since = at
        end = int(np.searchsorted(sums, sums[since] + left, side="right")) - 1
        over = end <= at
        end = max(end, at + 1)
        yield kept + known[since:at], known[at:end], over
        at = end


def _segment_rows(key: tuple, rows: list[tuple], tokens: Callable[[str], int], budget: int,
                  history_turns: int) -> Iterator[tuple]:
    kinds: dict[int, list[Turn]] = {_SYSTEM: [], _HISTORY: [], _OWN: []}
    for kind, role, text in rows:
        piece, start, end = format_turn(role, text)
        kinds[kind].append(Turn(role, piece, (start, end), tokens(piece)))
    system = next((t for t in kinds[_SYSTEM] if t.tokens * 2 <= budget), None)
    found = choose_windows(system, kinds[_HISTORY], kinds[_OWN], key[1] == 0, budget, history_turns)
    for number, (repeated, own, over) in enumerate(found):
        starts, ends, length = [], [], sum(len(t.piece) for t in repeated)
        for turn in own:
            if turn.role == "assistant":
                starts.append(length + turn.text[0])
                ends.append(length + turn.text[1])
            length += len(turn.piece)
        turns = [*repeated, *own]
        yield (*key, number, "".join(t.piece for t in turns), starts, ends, len(repeated), len(own),
               sum(t.tokens for t in turns), over)


_WINDOW = ("segment long, window int, formatted string, loss_start array<int>, loss_end array<int>, "
           "n_repeated int, n_own int, n_tokens int, over_budget boolean")
_WINDOW_TYPES = pa.schema([
    ("conv", pa.decimal128(20, 0)), ("segment", pa.int64()), ("window", pa.int32()),
    ("formatted", pa.string()), ("loss_start", pa.list_(pa.int32())), ("loss_end", pa.list_(pa.int32())),
    ("n_repeated", pa.int32()), ("n_own", pa.int32()), ("n_tokens", pa.int32()),
    ("over_budget", pa.bool_())])
_BATCH_CHARS = 4 << 20


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same leading columns, across batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _windows(rows: DataFrame, order: Sequence[str], path: str, pattern: str, budget: int,
             history_turns: int) -> DataFrame:
    """The windows of rows (conv, segment, kind, role, text), in order within each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        made, chars = [], 0
        for key, group in _groups(batches, 2):
            for row in _segment_rows(key, group, lambda p: len(encode(p)) // 4, budget, history_turns):
                made.append(row)
                chars += len(row[3])
                if chars > _BATCH_CHARS:
                    yield _batch(made, _WINDOW_TYPES)
                    made, chars = [], 0
        if made:
            yield _batch(made, _WINDOW_TYPES)

    dealt = rows.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "kind", *order)
    return dealt.select("conv", "segment", "kind", "role", "text").mapInArrow(
        work, f"conv decimal(20,0), {_WINDOW}")


def _size() -> Column:
    return (F.octet_length("text") + F.octet_length("role") + 1).cast("bigint")


def _segments(turns: DataFrame, segment_bytes: int, history_turns: int) -> DataFrame:
    """(conv, segment, kind, place, role, text) of long conversations, repeated rows included."""
    rows = placed(turns, "conv", ["turn", "role", "text"], ["conv", "role", "text"])
    rows = running(rows, "conv", "place", {"bytes": _size()}, F.sum, lambda a, b: a + b)
    before = F.col("bytes") - _size()
    segment = ((before - before % segment_bytes) / segment_bytes).cast("bigint")
    rows = stored(rows.select("conv", "place", "role", "text", segment.alias("segment")), "segments")
    ends = rows.groupBy("conv", "segment").agg(F.max("place").alias("last"))
    following = F.lead("segment").over(Window.partitionBy("conv").orderBy("segment"))
    ends = stored(ends.select("conv", "segment", "last", following.alias("next")), "segment-ends")
    own = rows.select("conv", "segment", F.lit(_OWN).alias("kind"), "place", "role", "text")
    tails = rows.join(ends.filter("next IS NOT NULL"), ["conv", "segment"]).filter(
        (F.col("place") > F.col("last") - history_turns)
        & ((F.col("place") > 1) | (F.col("role") != "system"))).select(
        "conv", F.col("next").alias("segment"), F.lit(_HISTORY).alias("kind"), "place", "role", "text")
    systems = rows.filter("place = 1 AND role = 'system'").select("conv", "place", "role", "text")
    systems = systems.join(ends.filter("segment > 0").select("conv", "segment"), "conv").select(
        "conv", "segment", F.lit(_SYSTEM).alias("kind"), "place", "role", "text")
    return own.union(tails).union(systems)


@dataclass(frozen=True)
class Formatted:
    """Windows of the conversations: ``whole`` come in order, all of one in one task; ``cut`` in any."""

    whole: DataFrame
    cut: DataFrame | None

    def windows(self) -> DataFrame:
        """(conv_id, segment, window, formatted, loss spans, counts) of all conversations."""
        both = self.whole if self.cut is None else self.whole.union(self.cut)
        return both.select(_conv_id(), *both.columns[1:])


def _conv_id() -> Column:
    return F.when(F.col("conv") > _NOBODY, F.col("conv").cast("bigint")).alias("conv_id")


_NOBODY = Decimal(-(10**19))  # stands for a null id, below any 64-bit number


def format_conversations(conversations: DataFrame, path: str, pattern: str, budget: int = BUDGET,
                         history_turns: int = HISTORY_TURNS, segment_bytes: int = SEGMENT_BYTES) -> Formatted:
    conv = F.coalesce(F.col("conv_id").cast("decimal(20,0)"), F.lit(_NOBODY).cast("decimal(20,0)"))
    turns = conversations.select(
        conv.alias("conv"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                      for c in ("role", "text")])
    long = stored(turns.groupBy("conv").agg(F.sum(_size()).alias("bytes"))
                  .filter(F.col("bytes") > segment_bytes).select("conv"), "long-conversations")
    cut, short = None, turns
    if not long.isEmpty():
        short = turns.join(long, "conv", "left_anti")
        cut = _windows(_segments(turns.join(long, "conv", "left_semi"), segment_bytes, history_turns),
                       ["place"], path, pattern, budget, history_turns)
    whole = short.select("conv", F.lit(0).cast("bigint").alias("segment"), F.lit(_OWN).alias("kind"),
                         "turn", "role", "text")
    return Formatted(_windows(whole, ["turn", "role", "text"], path, pattern, budget, history_turns), cut)


# Reading back -------------------------------------------------------------------------------


_READ = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
         "n_windows long, n_tokens long, n_over_budget long")
_READ_TYPES = pa.schema([
    ("conv", pa.decimal128(20, 0)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("n_windows", pa.int64()), ("n_tokens", pa.int64()), ("n_over_budget", pa.int64())])


class _Reader:
    """Digests of one conversation, window after window."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.counts = [0] * 6

    def add(self, formatted: str, starts: list[int], ends: list[int], n_repeated: int, n_own: int,
            n_tokens: int, over: bool) -> None:
        turns = parse(formatted)
        if len(turns) != n_repeated + n_own:
            raise ValueError(f"{len(turns)} turns in a window of {n_repeated + n_own}")
        for role, text in turns[n_repeated:]:
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        chars = 0
        for i, j in zip(starts, ends, strict=True):
            target = unescape(formatted[i:j])
            chars += len(target)
            self.loss.update(target.encode("utf-8", "surrogatepass"))
        new = (n_own, chars, len(formatted), 1, n_tokens, int(over))
        self.counts = [a + b for a, b in zip(self.counts, new, strict=True)]

    def row(self, key: tuple) -> tuple:
        n_turns, chars, *rest = self.counts
        return (*key, n_turns, self.turns.hexdigest(), chars, self.loss.hexdigest(), *rest)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, reader = None, _Reader()
    for batch in batches:
        made = []
        columns = [batch.column(0), *batch.columns[3:]]
        for own, *window in zip(*(c.to_pylist() for c in columns), strict=True):
            if own != key:
                if key is not None:
                    made.append(reader.row((key,)))
                key, reader = own, _Reader()
            reader.add(*window)
        if made:
            yield _batch(made, _READ_TYPES)
    if key is not None:
        yield _batch([reader.row((key,))], _READ_TYPES)


def read_back(formatted: Formatted) -> DataFrame:
    """Per conversation, from the windows alone: turns, text under the loss mask, counts.

    A digest of a whole conversation has to be read in order: one task streams it, window by window.
    """
    kinds = f"conv decimal(20,0), {_READ}"
    found = formatted.whole.mapInArrow(_read, kinds)
    if formatted.cut is not None:
        dealt = formatted.cut.repartition("conv").sortWithinPartitions("conv", "segment", "window")
        found = found.union(dealt.mapInArrow(_read, kinds))
    return found.select(_conv_id(), *found.columns[1:])
