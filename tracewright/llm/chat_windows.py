"""Chat formatting: conversations cut at turns into windows of a token budget, with a mask of the loss.

Prefix sums of the turns' tokens choose the spans. Every window retains the system turn, repeats a
limited history before its new turns and has under its loss mask the assistant texts of the new turns
only, so that each of them is a target once.

A conversation may be longer than any task should hold. Its turns are range-partitioned by conversation
and turn; prefix sums run inside each range, and one offset per range carries them on. They also cut it
into blocks of a bounded number of tokens, and windows are chosen block by block.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.shared_storage import settle

#: Marks before and after the text of a turn, by role. Another role is named between marks of its own.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
TARGET = "assistant"
RETAINED = "system"

_CONTROL = "|".join(re.escape(m) for m in (*(m for pair in MARKS.values() for m in pair), *OTHER))
_TO_ESCAPE = re.compile(rf"\\|{_CONTROL}")
_ESCAPED = re.compile(rf"\\(\\|{_CONTROL})")
_TOKEN = re.compile(rf"\\(?:\\|{_CONTROL})|({_CONTROL})")

#: Characters of texts that are tokenized together.
GROUP_CHARS = 1 << 20

TURN_SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_tokens bigint, before bigint"
WINDOW_SCHEMA = (
    "conv_id bigint, block bigint, window int, n_repeated int, n_new int, n_tokens bigint, formatted string,"
    " loss_starts array<bigint>, loss_ends array<bigint>"
)
DIGEST_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint"
)


@dataclass(frozen=True)
class WindowRule:
    """``budget`` tokens a window, of which at most ``history`` repeat earlier turns.

    ``block_windows`` budgets make a block: the unit of work, which results depend on only in where a
    window ends early.
    """

    budget: int = 1024
    history: int = 256
    block_windows: int = 64


def escaped(text: str) -> str:
    """The text with a backslash before every control string and every backslash."""
    return _TO_ESCAPE.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def framed(role: str, text: str) -> tuple[str, str, str]:
    """(mark before, escaped text, mark after) of a turn."""
    if role in MARKS:
        before, after = MARKS[role]
        return before, escaped(text), after
    start, middle, after = OTHER
    return f"{start}{escaped(role)}{middle}", escaped(text), after


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    turns, at, role = [], 0, ""
    opening = {before: role for role, (before, _) in MARKS.items()}
    for found in _TOKEN.finditer(formatted):
        mark = found[1]
        if mark is None:
            continue
        if mark in opening:
            role = opening[mark]
        elif mark == OTHER[1]:
            role = unescaped(formatted[at : found.start()])
        elif mark != OTHER[0]:
            turns.append((role, unescaped(formatted[at : found.start()])))
        at = found.end()
    return turns


@lru_cache(maxsize=2)
def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(definition)
    library.no_truncation()
    library.no_padding()
    return library


def token_counts(texts: Iterable[str], definition: str) -> list[int]:
    library, found, group, size = _tokenizer(definition), [], [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size > GROUP_CHARS:
            found += map(len, library.encode_batch_fast(group, add_special_tokens=False))
            group, size = [], 0
    return found + list(map(len, library.encode_batch_fast(group, add_special_tokens=False)))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def _arrow(names: str) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())
    }
    fields = (field.strip().split(" ") for field in names.split(","))
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def numbered_turns(conversations: DataFrame, definition: str) -> DataFrame:
    """Turns in order with ``seq``, ``n_tokens`` and ``start``: the tokens of their conversation before.

    Ordered by turn, then role, then a hash of the text. Roles and texts that are null count as empty.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Range bounds come from a sample on the driver: texts go in by their hash. Equal rows are told
    # apart by their place, so that many of them don't have to meet in one task.
    order = ("conv_id", "turn", "role", F.xxhash64("text"))
    ordered = turns.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(
        *order, "text"
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, last, before = _arrow(TURN_SCHEMA), object(), 0
        for batch in batches:
            rows = []
            columns = [c.to_pylist() for c in batch.columns]
            counts = token_counts(("".join(framed(r, t)) for r, t in zip(*columns[2:])), definition)
            for conv_id, turn, role, text, n in zip(*columns, counts):
                before = before if conv_id == last else 0
                rows.append((conv_id, turn, role, text, n, before))
                last, before = conv_id, before + n
            yield _batch(rows, schema)

    settled = settle(
        ordered.mapInArrow(counted, TURN_SCHEMA).withColumn("seq", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("seq", 33))
    # One row per conversation and range; only what a range carries on from earlier ones is kept.
    sums = settled.groupBy("conv_id", "part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.withColumn("offset", F.sum("n").over(earlier))
        .where("offset > 0")
        .select(F.col("conv_id").alias("of_conv"), F.col("part").alias("of_part"), "offset")
    )
    # At most the first conversation of a range has an offset: one row per range.
    same = (F.col("part") == F.col("of_part")) & F.col("conv_id").eqNullSafe(F.col("of_conv"))
    joined = settled.join(F.broadcast(offsets), same, "left")
    start = F.col("before") + F.coalesce("offset", F.lit(0))
    return joined.select("conv_id", "seq", "role", "text", "n_tokens", start.alias("start"))


def blocks(turns: DataFrame, rule: WindowRule) -> DataFrame:
    """The turns of every block, with those before it that may be repeated, and the system turn.

    ``new`` tells which turns belong to the block.
    """
    size = rule.budget * rule.block_windows
    block = F.expr(f"start div {size}")
    retained = (F.col("start") == 0) & (F.col("role") == RETAINED)
    # A turn that starts within the history of the next block goes there as well.
    carried = F.when(~retained & (F.col("start") >= (block + 1) * size - rule.history), F.array(block, block + 1))
    placed = turns.withColumn("block", F.explode(F.coalesce(carried, F.array(block)))).withColumn(
        "new", F.col("block") == block
    )
    later = turns.where(block > 0).select("conv_id", block.alias("block")).distinct()
    systems = turns.where(retained).select(F.col("conv_id").alias("of_conv"), "seq", "role", "text", "n_tokens", "start")
    copies = later.join(systems, F.col("conv_id").eqNullSafe(F.col("of_conv"))).select(
        "conv_id", "seq", "role", "text", "n_tokens", "start", "block", F.lit(False).alias("new")
    )
    return placed.unionByName(copies)


def spans(counts: list[int], starts: list[int], first_new: int, system: int, rule: WindowRule) -> list[tuple[int, int, int]]:
    """(first repeated, first new, end) of every window over the turns of a block.

    The turns are given without a retained system turn of ``system`` tokens, which every window has.
    """
    begin = np.asarray(starts, np.int64)
    end = begin + np.asarray(counts, np.int64)
    room, found, i = rule.budget - system, [], first_new
    while i < len(begin):
        history = max(0, min(rule.history, room - int(end[i] - begin[i])))
        repeated = int(np.searchsorted(begin[: i + 1], begin[i] - history))
        stop = max(i + 1, int(np.searchsorted(end, begin[repeated] + room, side="right")))
        found.append((repeated, i, stop))
        i = stop
    return found


def _windows_of(turns: list[tuple[str, str, int, int, bool]], rule: WindowRule) -> Iterator[tuple]:
    """Windows of a block; turns are (role, text, n_tokens, start, new) in order."""
    system = turns[0] if turns[0][3] == 0 and turns[0][0] == RETAINED else None
    rest = turns[1:] if system else turns
    first_new = next((k for k, t in enumerate(rest) if t[4]), len(rest))
    chosen = spans([t[2] for t in rest], [t[3] for t in rest], first_new, system[2] if system else 0, rule)
    if system and system[4] and not chosen:
        chosen = [(0, 0, 0)]
    for number, (repeated, new, stop) in enumerate(chosen):
        head = [system] if system else []
        fresh_system = bool(system) and system[4] and number == 0
        n_repeated = len(head) - fresh_system + new - repeated
        parts, at, losses = [], 0, []
        held = [*head, *rest[repeated:stop]]
        for k, (role, text, *_) in enumerate(held):
            before, body, after = framed(role, text)
            if role == TARGET and k >= n_repeated:
                losses.append((at + len(before), at + len(before) + len(body)))
            parts += (before, body, after)
            at += len(before) + len(body) + len(after)
        yield (
            number, n_repeated, len(held) - n_repeated, sum(t[2] for t in held), "".join(parts),
            [a for a, _ in losses], [b for _, b in losses],
        )


def windows(conversations: DataFrame, definition: str, rule: WindowRule = WindowRule()) -> DataFrame:
    """One row per window: ``formatted`` text, loss spans in code points, and its counts.

    ``conversations`` has a row per turn (conv_id, turn, role, text; further columns are not used).
    Windows are ordered by ``block`` and ``window``; the first ``n_repeated`` turns of a window repeat
    earlier ones. A turn is never cut: one that is larger than the budget has a window without history.
    Null roles and texts count as empty, rows without conv_id are one conversation, rows without turn come
    first, rows that share a turn are ordered by role and a hash of the text, and repeated rows are turns
    of their own. An empty table has no
    windows. ``definition`` is the tokenizer that counts, and must be readable on every executor.
    """
    rows = blocks(numbered_turns(conversations, definition), rule)
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "seq")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, ready, size = _arrow(WINDOW_SCHEMA), [], 0
        for (conv_id, block), group in groupby(_tuples(batches), key=lambda r: r[:2]):
            for window in _windows_of([r[2:] for r in group], rule):
                ready.append((conv_id, block, *window))
                size += len(window[4])
                if size > GROUP_CHARS:
                    yield _batch(ready, schema)
                    ready, size = [], 0
        yield _batch(ready, schema)

    return dealt.select("conv_id", "block", "role", "text", "n_tokens", "start", "new").mapInArrow(
        formatted, WINDOW_SCHEMA
    )


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def digests(written: DataFrame) -> DataFrame:
    """What the windows of each conversation hold: its turns, and the text under the loss mask.

    A running digest per conversation reads its windows in order, one at a time.
    """
    order = ("conv_id", "block", "window")
    dealt = written.repartition("conv_id").sortWithinPartitions(*order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows = _arrow(DIGEST_SCHEMA), []
        for conv_id, group in groupby(_tuples(batches), key=lambda r: r[0]):
            turns, losses, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, n_repeated, formatted, starts, ends in group:
                for role, text in parsed(formatted)[n_repeated:]:
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    n_turns += 1
                for start, end in zip(starts, ends):
                    target = unescaped(formatted[start:end])
                    losses.update(target.encode("utf-8", "surrogatepass"))
                    loss_chars += len(target)
                chars += len(formatted)
            rows.append((conv_id, n_turns, turns.hexdigest(), loss_chars, losses.hexdigest(), chars))
            if len(rows) >= 1000:
                yield _batch(rows, schema)
                rows = []
        yield _batch(rows, schema)

    return dealt.select("conv_id", "n_repeated", "formatted", "loss_starts", "loss_ends").mapInArrow(read, DIGEST_SCHEMA)
