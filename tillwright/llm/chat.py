r"""Chat formatting into budgeted windows with a loss mask.

A conversation's turns are rendered by a template whose control strings mark
turns and roles; control strings (and backslashes) inside texts are escaped,
so a text can never open or close a turn, and reading back restores it.
Prefix sums of the turns' tokens choose spans of whole turns that fit a token
budget. Each window after the first repeats the system turn and as many of
the turns just before it as fit ``HISTORY`` tokens. The loss mask holds the
assistant texts of a window's new turns only, so each is a target once.

Turns are shuffled by conversation and sorted, then formatted as a stream: a
task holds one window of one conversation at a time, however long it is. One
conversation is one stream, as its digest depends on the order of all turns.

Defined results: null roles and texts are empty; a null ``conv_id`` is a
conversation of its own; turns with equal numbers are ordered by role and
text, null numbers come first; repeated rows are repeated turns; a turn longer
than the budget has a window of its own and is not cut; only conv_id, turn,
role and text are read, other columns may have any name and are not returned;
an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, map_batches, staged, with_arrays

BUDGET = 1024
HISTORY = 256

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) </s>"
    r"| (?P<assistant>.*?) </s>",
    re.DOTALL,
)
_AROUND = {"user": ("<s>[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>\n"), "assistant": (" ", " </s>")}

WINDOWS = "conv_id bigint, window bigint, text string, n_repeated int, n_new int, loss array<struct<start: int, end: int>>"
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def escaped(text: str) -> str:
    """A backslash goes into each control string, and backslashes are doubled."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def rendered(role: str, text: str) -> tuple[str, str, str]:
    """(opening, escaped text, closing) of a turn."""
    before, after = _AROUND.get(role) or (f"[ROLE] {escaped(role)} [/ROLE] ", " </s>")
    return before, escaped(text), after


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role = unescaped(m["role"]) if kind == "other" else kind
        turns.append((role, unescaped(m[kind])))
        at = m.end()
    return turns


@functools.lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Conversation:
    """Windows of one conversation whose turns arrive in order."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system, self.turns, self.sums = None, [], [0]  # sums: tokens before each held turn, and of all
        self.start, self.windows = 0, 0  # first new turn among those held
        self.whole = True  # no turn was let go yet, so a system turn is still the first

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        if not self.windows and not self.turns and role == "system":
            self.system = (role, text, tokens)
        self.turns.append((role, text))
        self.sums.append(self.sums[-1] + tokens)
        # The turn just added may end the window before it.
        while len(self.turns) - self.start > 1 and self._end() < len(self.turns):
            yield self._window(self._end())

    def rest(self) -> Iterator[dict]:
        while self.start < len(self.turns):
            yield self._window(self._end())

    def _head(self) -> tuple[bool, int, int]:
        """(is the system turn repeated, first repeated turn, tokens of what is repeated)."""
        first = self.start
        again = self.system is not None and self.windows > 0
        own = self.system[2] if again else 0
        if self.windows:
            sums = np.array(self.sums)
            first = int(np.searchsorted(sums, sums[self.start] - self.history, side="left"))
            if again and self.whole:
                first = max(first, 1)  # the system turn is not part of the history as well
        return again, min(first, self.start), own + self.sums[self.start] - self.sums[min(first, self.start)]

    def _end(self) -> int:
        _, _, repeated = self._head()
        room = self.sums[self.start] + max(0, self.budget - repeated)
        return max(self.start + 1, int(np.searchsorted(np.array(self.sums), room, side="right")) - 1)

    def _window(self, end: int) -> dict:
        again, first, _ = self._head()
        pieces, loss, at = [], [], 0
        shown = ([self.system[:2]] if again else []) + self.turns[first:end]
        n_repeated = len(shown) - (end - self.start)
        for k, (role, text) in enumerate(shown):
            before, body, after = rendered(role, text)
            if k >= n_repeated and role == "assistant":
                loss.append({"start": at + len(before), "end": at + len(before) + len(body)})
            pieces += [before, body, after]
            at += len(before) + len(body) + len(after)
        out = {"conv_id": self.conv_id, "window": self.windows, "text": "".join(pieces), "n_repeated": n_repeated, "n_new": end - self.start, "loss": loss}
        # Turns that the next window's history cannot reach are let go.
        keep = int(np.searchsorted(np.array(self.sums), self.sums[end] - self.history, side="left"))
        keep = min(keep, end)
        self.whole = self.whole and not keep
        self.turns, self.sums, self.start = self.turns[keep:], self.sums[keep:], end - keep
        self.windows += 1
        return out


def _window_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "window": pa.int64(), "text": pa.string(), "n_repeated": pa.int32(), "n_new": pa.int32(), "loss": _SPANS}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in kinds.items()], list(kinds))


def _counter(path: str):
    """Tokens of each turn as it will be written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for batch in batches:
            whole = ["".join(rendered(r, t)) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            counts = [len(e.ids) for e in tok.encode_batch_fast(whole, add_special_tokens=False)]
            yield with_arrays(batch, tokens=pa.array(counts, pa.int64()))

    return run


def _formatter(budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, size = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "tokens"))
            for conv, role, text, n in zip(*columns, strict=True):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        rows += now.rest()
                    now = _Conversation(conv, budget, history)
                rows += now.add(role, text, n)
                size += len(text)
                if size > 1 << 21 and rows:
                    yield _window_batch(rows)
                    rows, size = [], 0
        if now is not None:
            rows += now.rest()
        if rows:
            yield _window_batch(rows)

    return run


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    """Whole conversations in one partition each, in order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "conv_id").sortWithinPartitions("conv_id", *order)


def formatted(conversations: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows (columns WINDOWS) of conversations (conv_id, turn, role, text);
    ``path``: a ``tokenizers`` JSON file that counts the tokens."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Tokens are counted where the turns lie, so a hot conversation's are counted by all tasks; only spans need its order.
    counted = appended(turns, _counter(path), "tokens bigint")
    return map_batches(_in_order(counted, "turn", "role", "text"), _formatter(budget, history), WINDOWS)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.n, self.loss_chars, self.chars, self.windows = conv_id, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, n_repeated: int, n_new: int, loss: list[dict]) -> None:
        new = parsed(text)[n_repeated:]
        if len(new) != n_new:
            raise ValueError(f"conversation {self.conv_id}: {len(new)} new turns, {n_new} written")
        for role, said in new:
            self.turns.update(f"{role}\n{said}\n".encode())
        self.n += n_new
        for span in loss:
            said = unescaped(text[span["start"] : span["end"]])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.chars += len(text)
        self.windows += 1

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.windows


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    now, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if now is None or r["conv_id"] != now.conv_id:
                if now is not None:
                    rows.append(now.row())
                now = _Digest(r["conv_id"])
            now.add(r["text"], r["n_repeated"], r["n_new"], r["loss"])
        if len(rows) > 10_000:
            yield out(rows)
            rows = []
    if now is not None:
        rows.append(now.row())
    if rows:
        yield out(rows)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows hold (columns DIGESTS)."""
    return map_batches(_in_order(windows, "window"), _digest, DIGESTS)


def written(conversations: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """The windows, written to the shared folder and read from there."""
    return staged(formatted(conversations, path, budget, history), "chat-windows")
