"""Chat formatting in budgeted windows, aligned to turns.

A running sum of the turns' tokens chooses spans of new turns that fit a budget. A window
opens with the conversation's system turn, repeats a limited history of the turns before its span, and
then holds its new turns. Loss falls on the texts of new assistant turns only, so each of them is a target
once. A turn that is longer than the budget makes a window of its own, whole. A system turn of more than
``system_budget`` tokens stands in the first window only, as one of its new turns; so windows never repeat more than
the system and history budgets allow, and a window is over its budget only where one turn does not fit beside the system turn.

No window crosses a multiple of ``BLOCK`` turn numbers, so the windows of a conversation depend on it and the budgets alone.
A conversation of usual length is formatted by one task, whose rows stream by in order after one shuffle. The blocks of a
long conversation are formatted by different tasks, which give the same windows: a block gets the
system turn and the last turns before it in order, however turn numbers are spread. What counts as long follows from the number of rows,
so that long conversations are few enough to broadcast their ids; it decides who formats a conversation, not how.

Defined results for odd input: a null text or role is empty; a text of any length is formatted whole; a null turn sorts first; rows
of one turn number are ordered by role and text, equal rows are turns of their own; a null conversation is one like any other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.session import materialize

#: Control strings of the template: fixed values.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[/TURN]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)) + r"|\\")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"(<<SYS>>|\[INST\]|<s>|\[TURN\])(.*?)(<</SYS>>|\[/INST\]|</s>|\[/TURN\])", re.DOTALL)
OPEN = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_OF = {v[0]: k for k, v in OPEN.items()}

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_BUDGET = 256
SYSTEM_BUDGET = 512
#: Turn numbers of a block of a long conversation.
BLOCK = 256
#: A conversation is long if it has more turns than this, or than what leaves ``MOST_LONG`` long ones at most.
LONG = 2048
MOST_LONG = 100_000

KIND = "conv_id long, block long, window long, formatted string, new_from int, n_turns int, loss_starts array<int>, loss_ends array<int>, n_tokens long, over_budget boolean"


def escape(text: str) -> str:
    r"""Break every control string in a text: ``\\`` stands for a backslash, ``\-`` for nothing."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\-" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "" if m[1] == "-" else m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where its escaped text begins and ends in it."""
    if role in OPEN:
        head, tail = OPEN[role]
    else:  # another role is written out
        head, tail = "[TURN]" + escape(role).replace("\n", "\\\n") + "\n", "[/TURN]"
    body = escape(text)
    return head + body + tail, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns of a window, read back: role, text, and where the escaped text stands."""
    out = []
    for m in _TURN.finditer(formatted):
        if m[1] in ROLE_OF:
            out.append((ROLE_OF[m[1]], unescape(m[2]), m.start(2), m.end(2)))
        else:
            cut = re.search(r"(?<!\\)(?:\\\\)*\n", m[2]).end()
            out.append((unescape(m[2][: cut - 1]), unescape(m[2][cut:]), m.start(2) + cut, m.end(2)))
    return out


class Windows:
    """Windows of one block of a conversation, as its rows pass by."""

    def __init__(self, conv, block, budget: int, history_turns: int, history_budget: int, system_budget: int):
        self.conv, self.block = conv, block
        self.budget, self.history_turns, self.history_budget, self.system_budget = budget, history_turns, history_budget, system_budget
        self.system: tuple[str, str, int] | None = None
        self.past: deque = deque(maxlen=max(history_turns, 1))
        self.new: list[tuple[str, str, int]] = []
        self.new_tokens, self.number, self.lead = 0, 0, 0
        self.began = False  # whether a turn of the conversation itself has come

    def go_on(self, block) -> Iterator[dict]:
        """Enter the next block of the conversation."""
        if self.new:
            yield self.close()
        self.block, self.number = block, 0

    def _history(self) -> list:
        out, room = [], self.history_budget
        for turn in [*self.past][::-1][: self.history_turns]:
            room -= turn[2]
            if room < 0 or turn == self.system:
                break
            out.insert(0, turn)
        return out

    def keep(self, turn: tuple[str, str, int]) -> None:
        """Take a turn as the system turn that later windows repeat, unless it is too long for that."""
        if turn[2] <= self.system_budget:
            self.system = turn

    def start(self) -> None:
        self.context = ([self.system] if self.system else []) + self._history()
        self.lead = sum(t[2] for t in self.context)

    def add(self, turn: tuple[str, str, int]) -> Iterator[dict]:
        if self.new and self.lead + self.new_tokens + turn[2] > self.budget:
            yield self.close()
        if not self.new:
            self.start()
            if self.lead + turn[2] > self.budget:  # history gives way first
                self.context = [self.system] if self.system else []
                self.lead = sum(t[2] for t in self.context)
        self.new.append(turn)
        self.new_tokens += turn[2]

    def close(self) -> dict:
        text, starts, ends = [], [], []
        at, turns = 0, self.context + self.new
        for i, (role, body, _) in enumerate(turns):
            made, a, b = format_turn(role, body)
            if i >= len(self.context) and role == "assistant":
                starts.append(at + a)
                ends.append(at + b)
            text.append(made)
            at += len(made)
        total = self.lead + self.new_tokens
        row = dict(conv_id=self.conv, block=self.block, window=self.number, formatted="".join(text), new_from=len(self.context), n_turns=len(turns), loss_starts=starts, loss_ends=ends, n_tokens=total, over_budget=total > self.budget)
        self.past.extend(self.new)
        self.new, self.new_tokens, self.number = [], 0, self.number + 1
        return row


def _columns(kind: str) -> list[str]:
    return [x.split()[0] for x in kind.split(", ")]


def _format_rows(tokenizer: tuple[str, str], *budgets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tallyseq.llm.token_spans import load

        encoding, _ = load(*tokenizer)
        open_, key = None, None
        for rows in batches:
            out = []
            for conv, whole, block, part, role, text in zip(rows["conv_id"], rows["whole"], rows["block"], rows["part"], rows["role"], rows["text"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if open_ is None or (conv, None if whole else block) != key:
                    if open_ is not None and open_.new:
                        out.append(open_.close())
                    open_, key = Windows(conv, block, *budgets), (conv, None if whole else block)
                elif block != open_.block:
                    out += open_.go_on(block)
                turn = (role, text, len(encoding.encode_to_numpy(format_turn(role, text)[0], disallowed_special=())))
                if part == 0:  # the system turn of a block that does not hold it
                    open_.keep(turn)
                elif part == 1:  # history from the block before
                    open_.past.append(turn)
                else:
                    out += open_.add(turn)
                    if part == 2 and not open_.began and role == "system":
                        open_.keep(turn)
                    open_.began = True
            if out:
                yield pd.DataFrame(out, columns=_columns(KIND)).astype({"conv_id": "Int64"})
        if open_ is not None and open_.new:
            yield pd.DataFrame([open_.close()], columns=_columns(KIND)).astype({"conv_id": "Int64"})

    return run


#: What the formatter reads: whether a task has the whole conversation, and the role that a row has in its block.
ROW = ("conv_id", "whole", "block", "part", "turn", "role", "text")


def _block_of(turn: Column, block: int) -> Column:
    return F.coalesce(F.floor(turn / block), F.lit(-(1 << 62)))


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows of each block in one partition, context first."""
    own = F.when(F.col("part") > 1, 2).otherwise(F.col("part"))
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", own, "turn", "role", "text")


def _whole(rows: DataFrame, block: int) -> DataFrame:
    """The rows of each conversation in one partition, in order."""
    marked = rows.withColumns({"whole": F.lit(True), "block": _block_of(F.col("turn"), block), "part": F.lit(2)})
    return marked.select(*ROW).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _blocks(rows: DataFrame, block: int, history_turns: int) -> DataFrame:
    """The rows of long conversations with their blocks, and what each block repeats of the rows before it."""
    rows = rows.withColumn("block", _block_of(F.col("turn"), block))
    known = rows.groupBy("conv_id", "block").agg(F.min(F.struct("turn", "role", "text")).alias("first"))
    home = known.groupBy("conv_id").agg(F.min(F.struct("block", "first")).alias("f")).select(F.col("conv_id").alias("of"), F.col("f.block").alias("home"), F.col("f.first").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    own = rows.join(F.broadcast(home.select("of", "home")), same).select("conv_id", "turn", "role", "text", "block", F.when(F.col("block") == F.col("home"), 2).otherwise(3).alias("part"))
    later = known.select("conv_id", "block").join(F.broadcast(home.where("first.role = 'system'")), same).where("block > home")
    system = later.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("system").alias("role"), F.col("first.text").alias("text"), "block", F.lit(0).alias("part"))
    every = own.unionByName(system)
    if not history_turns:
        return every
    # the last rows of each block, in the order of their conversation: a row is history of the blocks of the next rows
    backwards = Window.partitionBy("conv_id", "block").orderBy(*[F.col(c).desc() for c in ("turn", "role", "text")])
    last = rows.withColumn("place", F.row_number().over(backwards)).where(F.col("place") <= history_turns)
    firsts = known.select("conv_id", "block", F.col("first.turn").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("tail"))
    order = Window.partitionBy("conv_id").orderBy("block", "tail", "turn", "role", "text")
    marks = last.select("conv_id", "block", "turn", "role", "text", F.lit(1).alias("tail")).unionByName(firsts)
    # a block's mark comes before its own rows; up to history_turns rows lie between a row and the marks that it serves
    passed = marks.withColumn("seen", F.sum("tail").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ahead = F.collect_list(F.when(F.col("tail") == 0, F.struct("block", "seen"))).over(order.rowsBetween(1, 2 * history_turns))
    served = passed.withColumn("ahead", ahead).where("tail = 1").select("conv_id", "turn", "role", "text", "seen", F.explode("ahead").alias("to"))
    carried = served.where(F.col("to.seen") - F.col("seen") < history_turns).select("conv_id", "turn", "role", "text", F.col("to.block").alias("block"), F.lit(1).alias("part"))
    return every.unionByName(carried)


def split_windows(
    turns: DataFrame,
    tokenizer: tuple[str, str],
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_budget: int = HISTORY_BUDGET,
    system_budget: int = SYSTEM_BUDGET,
    block: int = BLOCK,
    long: int = LONG,
) -> tuple[DataFrame, DataFrame | None]:
    """The windows of usual conversations, in order within their partitions, and those of long ones (None: there are none)."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    made = _format_rows(tokenizer, budget, history_turns, history_budget, system_budget)
    sizes = materialize(rows.groupBy("conv_id").agg(F.count("*").alias("turns")).where(F.col("turns") > long))
    longest = max(long, -(-rows.count() // MOST_LONG))
    of = sizes.where(F.col("turns") > longest).select(F.col("conv_id").alias("of"))
    if not of.limit(1).count():
        return _whole(rows, block).mapInPandas(made, KIND), None
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    usual = _whole(rows.join(F.broadcast(of), same, "left_anti"), block).mapInPandas(made, KIND)
    parted = _blocks(rows.join(F.broadcast(of), same, "left_semi"), block, history_turns)
    return usual, _in_order(parted.withColumn("whole", F.lit(False)).select(*ROW)).mapInPandas(made, KIND)


def format_windows(turns: DataFrame, tokenizer: tuple[str, str], **how: int) -> DataFrame:
    """One row per window of ``turns`` (conv_id, turn, role, text); ``tokenizer`` is a rank file and its pattern.

    ``new_from`` is the number of context turns; ``loss_starts`` and ``loss_ends`` are the
    character spans under the loss. Windows of a conversation follow one another by ``block``, ``window``.
    The budgets and block sizes of ``split_windows`` are the other parameters.
    """
    usual, long = split_windows(turns, tokenizer, **how)
    return usual if long is None else usual.union(long)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def _digest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def told(s) -> dict:
        return dict(conv_id=s["conv"], n_turns=s["n"], turns_sha256=s["turns"].hexdigest(), loss_chars=s["chars"], loss_sha256=s["loss"].hexdigest(), formatted_chars=s["length"], n_windows=s["windows"])

    now = None
    for rows in batches:
        out = []
        for conv, formatted, new_from, starts, ends in zip(rows["conv_id"], rows["formatted"], rows["new_from"], rows["loss_starts"], rows["loss_ends"], strict=True):
            conv = None if pd.isna(conv) else int(conv)
            if now is None or now["conv"] != conv:
                if now is not None:
                    out.append(told(now))
                now = dict(conv=conv, n=0, turns=hashlib.sha256(), chars=0, loss=hashlib.sha256(), length=0, windows=0)
            for role, text, _, _ in parse(formatted)[new_from:]:
                now["n"] += 1
                now["turns"].update(f"{role}\n{text}\n".encode())
            for a, b in zip(starts, ends, strict=True):
                text = unescape(formatted[a:b])
                now["chars"] += len(text)
                now["loss"].update(text.encode())
            now["length"] += len(formatted)
            now["windows"] += 1
        if out:
            yield pd.DataFrame(out).astype({"conv_id": "Int64"})
    if now is not None:
        yield pd.DataFrame([told(now)]).astype({"conv_id": "Int64"})


def digest(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows as they stream by in order."""
    dealt = windows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    return dealt.mapInPandas(_digest_rows, DIGEST)


def digest_turns(turns: DataFrame, tokenizer: tuple[str, str], **how: int) -> DataFrame:
    """The digest of the windows of ``turns``: those of usual conversations are read back where they were made.

    A conversation's hash runs over all of its turns in order, so the windows of a long one meet in one task and stream through it.
    """
    usual, long = split_windows(turns, tokenizer, **how)
    own = usual.mapInPandas(_digest_rows, DIGEST)
    return own if long is None else own.union(digest(long))
