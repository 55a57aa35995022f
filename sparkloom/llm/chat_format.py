"""Chat formatting in budgeted windows.

Turns are written as `### role: text </turn>` lines.  Prefix sums of the turns'
tokens choose windows that begin and end between turns: each repeats the system
turn and a limited history, then takes as many new turns as the token budget
leaves room for.  Only new assistant texts are under the loss mask, so every
target is trained on once.

A conversation of more turns than a block is cut into blocks by position, which are
formatted apart: a window ends where its block does.  A block gets the system turn
and, as history, as many of the turns before it as the history has tokens, which is
all that it can repeat.  Positions come from a sort over ranges of (conversation,
turn), so neither a long conversation nor a crowd of rows with one or no turn number
is held, sorted or formatted by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.relational import spread_join
from ..session import materialize, repeatable
from ._util import offsets, quoted, table

#: Tokens in a window, tokens of repeated history; turns in a block (the tokens of the history, if that is more).
BUDGET, HISTORY, BLOCK_TURNS = 2048, 256, 1024
#: Most long conversations whose ids are broadcast; the rows of more are marked by a join.
MOST_LONG = 10_000
SYSTEM, TARGET = "system", "assistant"
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?) </turn>\n", re.S)
_TOKEN = re.compile(r"\w+|[^\w\s]")
_WINDOWS = "conv {kind}, block bigint, window bigint, text string, n_tokens bigint, n_turns int, n_repeated int, loss array<struct<start:bigint,end:bigint>>"


def escape(text: str) -> str:
    """No `#`, and no `</turn>`, is left bare."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's line, and where its text begins and ends in it."""
    head, body = f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text)
    return f"{head}{body} </turn>\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def count_tokens(text: str) -> int:
    """Words and single marks: what a window's budget is counted in unless another counter is given."""
    return sum(1 for _ in _TOKEN.finditer(text))


def plan_windows(tokens: np.ndarray, fixed: int, first: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """(begin of history, begin, end) of each window over turns with these tokens.

    fixed: tokens of the system turn.  Turns before `first` are history only.  A
    turn that leaves no room for history goes without; one that is over the budget
    by itself gets its own window.
    """
    sums, windows, begin = offsets(tokens), [], first
    while begin < len(tokens):
        old = int(np.searchsorted(sums, sums[begin] - history))
        end = int(np.searchsorted(sums, sums[old] + budget - fixed, side="right")) - 1
        if end <= begin:
            old = begin
            end = max(begin + 1, int(np.searchsorted(sums, sums[begin] + budget - fixed, side="right")) - 1)
        windows.append((old, begin, end))
        begin = end
    return windows


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = BUDGET, history: int = HISTORY, block_turns: int = BLOCK_TURNS, counter: Callable[[str], int] = count_tokens) -> DataFrame:
    """One row a window: the conversation's id, block, window, text, n_tokens, n_turns, n_repeated and loss.

    loss: ranges of characters of text that hold new assistant texts, escaped.
    n_repeated: leading turns that an earlier window has too.  Rows of a
    conversation are ordered by turn, nulls last; ties by role, then text, so
    repeated rows are repeated turns.  A null text or role is empty; null is a
    conversation like any other.  A system turn is repeated only if it is the
    conversation's first.  A text of any length is one turn; over the budget, it has a
    window to itself.  An empty table gives no rows.  Other columns play no part, whatever
    their names.  counter: tokens of a line, one at least.
    """
    kind, block_turns = dict(turns.dtypes)[conv_col], max(block_turns, history)
    order = ["conv", "last", "turn", "role", "text"]
    rows = repeatable(turns).select(
        quoted(conv_col).alias("conv"),
        quoted(turn_col).isNull().alias("last"),
        quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(quoted(text_col), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), quoted(conv_col).cast("string")), F.lit("")).alias("key"),
    )
    long = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_turns))
    n_long = long.count()
    one_block = [*order, F.lit(0).cast("long").alias("block"), F.lit(2).alias("part")]
    whole = rows.select(*one_block)
    if n_long:
        marked = rows.join(F.broadcast(long), "key", "left") if n_long <= MOST_LONG else spread_join(rows, long, "key", "left")
        whole = marked.where("n is null").select(*one_block).unionByName(_blocks(marked.where("n is not null"), order, block_turns, history).select(*whole.columns))
    dealt = whole.repartition("conv", "block").sortWithinPartitions("conv", "block", "part", *order[1:]).select("conv", "block", "part", "turn", "role", "text")
    out = dealt.mapInArrow(_formatter(budget, history, counter), _WINDOWS.format(kind=kind))
    return out.withColumnRenamed("conv", conv_col)


def _blocks(rows: DataFrame, order: list[str], block_turns: int, history: int) -> DataFrame:
    """Rows of long conversations with block and part: 0 the system turn, 1 the turns before the block, 2 its own."""
    rows = rows.withColumn("nth", F.monotonically_increasing_id())  # so that a crowd of equal rows has bounds inside it
    by = [F.col(c) for c in (*order, "nth")]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumns({"at": F.monotonically_increasing_id(), "range": F.spark_partition_id()}))
    stretches = ranged.groupBy("key", "range").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("key", "range", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = ranged.join(stretches, ["key", "range"]).withColumn("place", F.col("at") + F.col("shift"))
    placed = placed.withColumn("block", F.floor(F.col("place") / block_turns).cast("long"))
    last = F.floor((F.col("n") - 1) / block_turns).cast("long")
    own = placed.withColumn("part", F.lit(2))
    tail = placed.where((F.col("place") % block_turns >= block_turns - history) & (F.col("block") < last)).withColumn("block", F.col("block") + 1).withColumn("part", F.lit(1))
    system = placed.where((F.col("place") == 0) & (F.col("role") == SYSTEM)).withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), last))).withColumn("part", F.lit(0))
    return own.unionByName(tail).unionByName(system)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows that share their first `keys` columns; holds one run at most."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != now:
                if held:
                    yield now, held
                now, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield now, held


def _formatter(budget: int, history: int, counter: Callable[[str], int]):
    def windows_of(conv, block: int, rows: list[tuple]) -> Iterator[tuple]:
        """rows: (part, turn, role, text)."""
        system = next((r[1:] for r in rows if r[0] == 0), None)
        first = sum(r[0] == 1 for r in rows)
        body = [r[1:] for r in rows if r[0] > 0]
        if first == len(body):
            return
        if system is None and first == 0 and body[0][1] == SYSTEM:
            system, body, leading = body[0], body[1:], True
        else:
            leading = False
        lines = [render(r[1], r[2]) for r in body]
        tokens = np.array([counter(x[0]) for x in lines], np.int64)
        head = render(system[1], system[2])[0] if system else ""
        fixed = counter(head)
        plan = plan_windows(tokens, fixed, first, budget, history) or [(0, 0, 0)]
        for number, (old, begin, end) in enumerate(plan):
            parts, at, loss = [head], len(head), []
            for i in range(old, end):
                line, a, b = lines[i]
                if i >= begin and body[i][1] == TARGET:
                    loss.append({"start": at + a, "end": at + b})
                parts.append(line)
                at += len(line)
            repeated = begin - old + (system is not None and not (leading and number == 0))
            yield conv, block, number, "".join(parts), fixed + int(tokens[old:end].sum()), end - old + (system is not None), int(repeated), loss

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = ["conv", "block", "window", "text", "n_tokens", "n_turns", "n_repeated", "loss"], [], 0
        loss_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types, conv_type = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), loss_type], None

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), [conv_type, *types])], names)

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        for (conv, block), rows in _groups(typed(), 2):
            for window in windows_of(conv, block, rows):
                held.append(window)
                size += len(window[3])
            if size > 8 << 20:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    return run


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, parsed from formatted windows: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The digests are fed window by window, in order; no conversation is held whole, but as a
    digest is of one sequence of bytes, all windows of a conversation pass through one task.
    No windows give no rows.
    """
    kind = dict(windows.dtypes)[conv_col]
    source = windows.select(quoted(conv_col).alias("conv"), "block", "window", "text", "n_repeated", "loss")
    dealt = source.repartition("conv").sortWithinPartitions("conv", "block", "window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out, conv_type = None, None, [], None

        def finish() -> None:
            out.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def close() -> pa.RecordBatch:
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for conv, _, _, text, repeated, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (conv,):
                    if now:
                        finish()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if len(out) > 50_000:
                yield close()
                out = []
        if now:
            finish()
            yield close()

    out = dealt.mapInArrow(run, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return out.withColumnRenamed("conv", conv_col)


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return read_back(format_chats(turns.unionByName(more)))
