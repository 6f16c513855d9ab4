"""Chat formatting in budgeted windows.

A conversation's turns are formatted with a template that escapes its own control strings in the texts, and their tokens are counted. Prefix
sums of these counts choose the windows: each starts where the one before ended and takes as many whole turns as the budget holds behind
the system turn, which every window repeats, and a limited history, the last turns of the window before, as far as they fit into a share of the
budget. A window's loss mask covers the texts of its new assistant turns; repeated turns are context only, so each target counts once.

Tokens are counted where the turns are read, so that work is spread whatever conversation they are of. Then the turns are dealt out by conversation
and sorted, and each task reads its rows as a stream that holds the turns of one window and one history at a time: a conversation of any length
needs bounded memory, and its task only adds numbers and joins texts.

Template: `### Role` line end, text, `</turn>` line end; inside roles and texts a backslash is put before `\\`, `###` and `</turn>`, and
line ends in roles become `\\n`. The inverse removes exactly these, so every text comes back as it was.

Defined results: a null text or role is empty; null turns come first; turns of equal number go by role and text, repeated rows stay repeated; a
null conv_id is a conversation like any other. A turn over the budget is a window of its own, whole (over_budget is true). An empty table gives an
empty result. Only the four columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import load_tokenizer

BUDGET, HISTORY_TURNS, HISTORY_SHARE = 1024, 2, 0.25
START, END = "### ", "</turn>\n"
CONTROL = re.compile(r"\\|###|</turn>")
ESCAPED = re.compile(r"\\(\\|###|</turn>|n)")
TURN = re.compile(r"### ((?:\\(?:\\|###|</turn>|n)|[^\\\n])*)\n((?:\\(?:\\|###|</turn>)|(?!</turn>)[^\\])*)</turn>\n")
_BATCH = 128


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(the formatted turn, where its text starts and ends in it)"""
    head = START + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted window; ValueError if it isn't one."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted turn")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class Windows:
    """The windows of one conversation, turn by turn."""

    def __init__(self, budget: int, history_turns: int, history_share: float):
        self.budget, self.history_turns, self.room = budget, history_turns, int(budget * history_share)
        self.system: tuple | None = None
        self.history: list[tuple] = []
        self.new: list[tuple] = []
        self.sums = [0]  # prefix sums of the new turns' tokens
        self.number = self.first = 0

    def add(self, turn: tuple) -> Iterator[dict]:
        """turn: (formatted, text start, text end, tokens, role)"""
        if self.number == self.first == 0 and not self.new and turn[4] == "system":
            self.system = turn
        self.new.append(turn)
        self.sums.append(self.sums[-1] + turn[3])
        while self._repeated() + self.sums[-1] > self.budget and len(self.new) > 1:
            fits = bisect_right(self.sums, self.budget - self._repeated()) - 1
            yield self._close(max(1, min(fits, len(self.new) - 1)))

    def end(self) -> Iterator[dict]:
        if self.new:
            yield self._close(len(self.new))

    def _kept_system(self) -> tuple | None:
        return self.system if self.first else None  # in the first window it is a new turn

    def _repeated(self) -> int:
        return sum(t[3] for t in self.history) + (self._kept_system() or (0,) * 4)[3]

    def _close(self, n: int) -> dict:
        """A window of the first n new turns."""
        taken, self.new = self.new[:n], self.new[n:]
        system = self._kept_system()
        repeated = ([system] if system else []) + self.history
        parts, spans, at = [], [], 0
        for k, (formatted, start, stop, _, role) in enumerate(repeated + taken):
            if k >= len(repeated) and role == "assistant":
                spans.append({"start": at + start, "end": at + stop})
            parts.append(formatted)
            at += len(formatted)
        tokens = sum(t[3] for t in repeated + taken)
        out = {"window": self.number, "first_turn": self.first, "n_repeated": len(repeated), "n_new": n, "tokens": tokens, "over_budget": tokens > self.budget, "text": "".join(parts), "loss": spans}
        self.first += n
        self.number += 1
        history, room = [], self.room
        for turn in reversed(taken[-self.history_turns :] if self.history_turns else []):
            room -= turn[3]
            if room < 0 or turn is self.system:
                break
            history.insert(0, turn)
        self.history = history
        self.sums = [0]
        for turn in self.new:
            self.sums.append(self.sums[-1] + turn[3])
        if self.new and self._repeated() + self.new[0][3] > self.budget:
            self.history = []  # the next turn goes before repeated ones
        return out


def _windows_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", kind), ("window", pa.int64()), ("first_turn", pa.int64()), ("n_repeated", pa.int32()), ("n_new", pa.int32()), ("tokens", pa.int64()), ("over_budget", pa.bool_()), ("text", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def windows(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_share: float = HISTORY_SHARE) -> DataFrame:
    """(conv_id, window, first_turn, n_repeated, n_new, tokens, over_budget, text, loss): the formatted windows, those of a conversation in order
    and in one partition. loss: the (start, end) of the trained texts, in code points of text."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    named = conversations.select("conv_id", "turn", empty("role"), empty("text"))
    kind = named.schema["conv_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_tokenizer(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, _BATCH):
                b = whole.slice(at, _BATCH)
                made = [format_turn(r, t)[0] for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                tokens = [len(e.ids) for e in library.encode_batch_fast(made, add_special_tokens=False)]
                yield pa.record_batch([*b.columns, pa.array(tokens, pa.int64())], names=["conv_id", "turn", "role", "text", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, current, schema, rows = None, None, None, []
        for whole in batches:
            schema = schema or _windows_schema(whole.column(0).type)
            for at in range(0, whole.num_rows, _BATCH):
                b = whole.slice(at, _BATCH)
                for conv, role, text, n in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "tokens"))):
                    if open_ is None or conv != current:
                        if open_:
                            rows += [{"conv_id": current, **w} for w in open_.end()]
                        open_, current = Windows(budget, history_turns, history_share), conv
                    rows += [{"conv_id": current, **w} for w in open_.add((*format_turn(role, text), n, role))]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
        if open_ and (rows := [{"conv_id": current, **w} for w in open_.end()]):
            yield pa.RecordBatch.from_pylist(rows, schema)

    turn = named.schema["turn"].dataType.simpleString()
    counted = named.mapInArrow(count, f"conv_id {kind}, turn {turn}, role string, text string, tokens bigint")
    dealt = counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, f"conv_id {kind}, window bigint, first_turn bigint, n_repeated int, n_new int, tokens bigint, over_budget boolean, text string, loss array<struct<start:int,end:int>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted as windows() gives it (read in the same order) -> (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_windows), from the formatted texts and masks alone: repeated turns are skipped, new ones parsed and unescaped."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def done() -> dict:
            conv, turns, loss, n, chars, size, k = state
            return dict(zip(names, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, k)))

        schema = None
        for b in batches:
            rows = []
            schema = schema or pa.schema([("conv_id", b.column(0).type), *((x, pa.string() if "sha" in x else pa.int64()) for x in names[1:])])
            for w in b.to_pylist():
                if state is None or w["window"] == 0:
                    if state:
                        rows.append(done())
                    state = [w["conv_id"], hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                for role, text in parse(w["text"])[w["n_repeated"] :]:
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[3] += 1
                for span in w["loss"]:
                    text = unescape(w["text"][span["start"] : span["end"]])
                    state[2].update(text.encode())
                    state[4] += len(text)
                state[5] += len(w["text"])
                state[6] += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        if state:
            yield pa.RecordBatch.from_pylist([done()], schema)

    return formatted.select("conv_id", "window", "n_repeated", "text", "loss").mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint")
