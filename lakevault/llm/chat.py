r"""Chat formatting in windows of a token budget.

The turns of a conversation are walked by their running token sum. A window takes whole turns while
the sum since its start fits the budget; the next window begins with the system turn and as many of
the last turns as fit the history budget, both repeated for context and left out of the loss mask,
so that every assistant text is a target exactly once.

A turn is written ``<turn role="R">text</turn>`` and a line end. In texts a backslash is doubled and
the ``<`` of anything that begins like a turn mark becomes ``\l``; in roles a double quote becomes
``\q`` as well. So marks occur only where a turn begins or ends, and reading back is exact.

A conversation is cut into blocks of ``TURNS_PER_BLOCK`` turns, and blocks are what is dealt to tasks,
so one conversation with a third of all rows is spread over many. Turns are counted by slices of turn
numbers: a turn's place is its place in its slice plus the turns in the slices before. A window does not
reach over the end of a block; the system turn and the last turns before the block come along, at most
as many as there are tokens in the history budget, since a turn has one at least. Inside a task rows are
streamed in order; what is held is one window and its history.

Defined results
---------------
* a null text is empty, a null role is the empty role; a null turn comes first; rows with one turn
  number are ordered by role, then text; rows repeated as a whole are turns of their own
* rows with a null conversation id are one conversation
* the first system turn is the one retained
* a turn larger than the budget is a window of its own, whole
* other columns are not read; an empty table gives an empty result
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakevault.llm import tokens
from lakevault.llm.common import arrow_batches, arrow_rows

BUDGET = 1024
HISTORY_TOKENS = 256
TURNS_PER_BLOCK = 1024
#: turn numbers that are counted together
SLICE = 1024

_MARK = re.compile(r"<(?=/?turn)")
_ESCAPED = re.compile(r"\\([\\lq])")
_TURN = re.compile(r'<turn role="([^"]*)">(.*?)</turn>\n', re.DOTALL)
_BACK = {"\\": "\\", "l": "<", "q": '"'}
# what a block receives: the system turn and last turns from before it, then its own turns
SYSTEM, HISTORY, OWN = 0, 1, 2

WINDOWS = "conv_id long, block long, window int, repeated int, n_tokens int, text string, loss_starts array<int>, loss_ends array<int>"


def escape(text: str) -> str:
    return _MARK.sub(r"\\l", text.replace("\\", "\\\\"))


def escape_role(role: str) -> str:
    return escape(role).replace('"', "\\q")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


class _Window:
    """The window being filled: its turns, of which the first ``repeated`` are context."""

    def __init__(self, context: list[tuple[str, str, int]], number: int):
        self.turns, self.repeated, self.number = list(context), len(context), number
        self.tokens = sum(n for _, _, n in context)

    def row(self, conv, block) -> tuple:
        parts, starts, ends, at = [], [], [], 0
        for i, (role, text, _) in enumerate(self.turns):
            head = f'<turn role="{role}">'
            if i >= self.repeated and role == "assistant":
                starts.append(at + len(head))
                ends.append(at + len(head) + len(text))
            parts.append(f"{head}{text}</turn>\n")
            at += len(parts[-1])
        return (conv, block, self.number, self.repeated, self.tokens, "".join(parts), starts, ends)


def window_rows(rows: Iterator[tuple], count, budget: int, history_tokens: int) -> Iterator[tuple]:
    """Windows of rows ``(conv, block, kind, place, role, text)`` that come sorted."""
    key = window = system = None
    recent: deque[tuple[str, str, int]] = deque(maxlen=max(1, history_tokens))
    for conv, block, kind, _, role, text in rows:
        if key != (conv, block):
            if window is not None and len(window.turns) > window.repeated:
                yield window.row(*key)
            key, window, system = (conv, block), None, None
            recent.clear()
        role, text = escape_role(role), escape(text)
        turn = (role, text, count(f'<turn role="{role}">{text}</turn>\n'))
        if kind == SYSTEM:
            system = turn
            continue
        if kind == HISTORY:
            recent.append(turn)
            continue
        if window is None or window.tokens + turn[2] > budget and len(window.turns) > window.repeated:
            number = 0
            if window is not None:
                yield window.row(*key)
                number = window.number + 1
            window = _Window(_context(system, recent, turn[2], budget, history_tokens), number)
        window.turns.append(turn)
        window.tokens += turn[2]
        if role == "system" and system is None:
            system = turn
        else:
            recent.append(turn)
    if window is not None and len(window.turns) > window.repeated:
        yield window.row(*key)


def _context(system, recent, need: int, budget: int, history_tokens: int) -> list[tuple[str, str, int]]:
    context = [system] if system is not None else []
    room = min(history_tokens, budget - need - sum(n for _, _, n in context))
    history: list[tuple[str, str, int]] = []
    for turn in reversed(recent):
        if turn[2] > room:
            break
        room -= turn[2]
        history.insert(0, turn)
    return context + history


def _blocks(turns: DataFrame, per_block: int, history: int) -> DataFrame:
    """Every block's own rows, and the rows that come along from before it."""
    order = F.coalesce(F.col("turn"), F.lit(-(2**63))).cast("long")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), order.alias("turn"), F.floor(order / F.lit(SLICE)).cast("long").alias("slice"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    inside = W.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
    counts = rows.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(F.col("conv_id").alias("c"), F.col("slice").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counted = rows.withColumn("n", F.row_number().over(inside)).join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")))
    place = (F.col("before") + F.col("n") - 1).alias("place")
    placed = counted.select("conv_id", place, "role", "text").withColumn("block", F.floor(F.col("place") / F.lit(per_block)).cast("long"))
    first = placed.filter("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("place", "text")).alias("system"))
    first = first.select(F.col("conv_id").alias("c"), "system")
    known = placed.join(first, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    # a turn goes to its own block and, as history, to the blocks that begin within ``history`` turns after it; the
    # first turn of a block brings the system turn along. A block that has no own turns makes no window
    begin = (F.col("place") + F.lit(history)) / F.lit(per_block)
    later = F.filter(F.sequence(F.col("block"), F.floor(begin).cast("long")), lambda b: b > F.col("block"))
    is_system = F.coalesce(F.col("place") == F.col("system.place"), F.lit(False))
    along = F.when(is_system, F.array().cast("array<bigint>")).otherwise(later)
    row = lambda block, kind, place, role, text: F.struct(block.alias("block"), F.lit(kind).alias("kind"), place.alias("place"), role.alias("role"), text.alias("text"))
    own = F.array(row(F.col("block"), OWN, F.col("place"), F.col("role"), F.col("text")))
    history_rows = F.transform(along, lambda b: row(b, HISTORY, F.col("place"), F.col("role"), F.col("text")))
    leads = (F.col("place") % per_block == 0) & (F.col("system.place") < F.col("place"))
    system = F.when(leads, F.array(row(F.col("block"), SYSTEM, F.col("system.place"), F.lit("system"), F.col("system.text"))))
    dealt = F.concat(own, history_rows, F.coalesce(system, F.filter(own, lambda _: F.lit(False))))
    return known.select("conv_id", F.inline(dealt))


def format_windows(
    turns: DataFrame,
    tokenizer: str | None = None,
    budget: int = BUDGET,
    history_tokens: int = HISTORY_TOKENS,
    per_block: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """One row per window: its text, where the loss mask runs (code points), repeated turns, tokens."""
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()), ("repeated", pa.int32()), ("n_tokens", pa.int32()), ("text", pa.string()), ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer)
        rows = window_rows(arrow_rows(batches), lambda text: len(encode(text)), budget, history_tokens)
        return arrow_batches(rows, schema)

    dealt = _blocks(turns, per_block, history_tokens).repartition("conv_id", "block")
    ordered = dealt.sortWithinPartitions("conv_id", "block", "kind", "place")
    return ordered.select("conv_id", "block", "kind", "place", "role", "text").mapInArrow(work, WINDOWS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def _read(rows: Iterator[tuple]) -> Iterator[tuple]:
    key, open_ = None, False
    turns = loss = hashlib.sha256()
    n = chars = formatted = windows = 0

    def done() -> tuple:
        return (key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, windows)

    for conv, _, _, repeated, text, starts, ends in rows:
        if not open_ or conv != key:
            if open_:
                yield done()
            key, open_, turns, loss, n, chars, formatted, windows = conv, True, hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0
        for i, (role, body) in enumerate(_TURN.findall(text)):
            if i >= repeated:
                turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                n += 1
        for a, b in zip(starts, ends):
            target = unescape(text[a:b])
            loss.update(target.encode())
            chars += len(target)
        formatted += len(text)
        windows += 1
    if open_:
        yield done()


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows hold, per conversation: its turns, its loss text, its length.

    One digest over a whole conversation is a sequential sum, so a conversation's windows pass one
    task here, in order, one at a time; the formatting itself is dealt by block.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    picked = ordered.select("conv_id", "block", "window", "repeated", "text", "loss_starts", "loss_ends")
    return picked.mapInArrow(lambda batches: arrow_batches(_read(arrow_rows(batches)), schema), DIGESTS)
