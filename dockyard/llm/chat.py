"""Chat formatting with a grammar round trip.

A turn is rendered as ``<s>role[INST]text[/INST]</s>``. The grammar reads one
turn back: ``<s>``, everything up to the first ``[INST]``, everything up to the
first ``[/INST]``, then ``</s>``; a backslash makes the next character plain.
A turn is rendered without escapes first, reparsed and compared with its
source; while they differ, content is escaped further: first the backslashes
and control strings, then every opening character. The rendered text of a
whole conversation is then read as one string, without knowing where turns
were joined, and the turns found are compared with the source.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.tables import tasks

#: Strings that steer a model and so must not appear raw inside a turn's content.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.S)
_END = "[/INST]</s>"
_ESCAPED = re.compile(r"\\(.)", re.S)

_LEVELS = (
    lambda s: s,
    lambda s: _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], s.replace("\\", "\\\\")),
    lambda s: re.sub(r"([\\<\[])", r"\\\1", s),
)


def parse_turn(segment: str) -> tuple[str, str] | None:
    """(role, text) of one rendered turn; None when it isn't exactly one turn."""
    m = _TURN.fullmatch(segment)
    if not m or any(_CONTROL.search(part) for part in m.groups()):
        return None
    return _ESCAPED.sub(r"\1", m[1]), _ESCAPED.sub(r"\1", m[2])


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its (escaped) text starts and ends in it."""
    for escape in _LEVELS:
        head = f"<s>{escape(role)}[INST]"
        body = escape(text)
        segment = f"{head}{body}[/INST]</s>"
        if parse_turn(segment) == (role, text):
            return segment, len(head), len(head) + len(body)
    raise ValueError(f"a turn can't be rendered reversibly: {role!r}, {text[:80]!r}")


class Reader:
    """Reads a conversation's text, given in pieces cut anywhere, turn by turn.

    Holds what has been read of one turn only. Text that no turn can begin
    with is an error, so is a turn with a control string inside.
    """

    def __init__(self) -> None:
        self._held: list[str] = []
        self._tail = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str, str]]:
        """``(role, text, text as written)`` of every turn that ends in this piece."""
        self._held.append(piece)
        seen = self._tail + piece
        self._tail = seen[-len(_END) + 1:]
        if _END not in seen:
            return
        text, at = "".join(self._held), 0
        while True:
            m = _TURN.match(text, at)
            if not m:
                break
            if any(_CONTROL.search(part) for part in m.groups()):
                raise ValueError(f"a control string inside a turn: {m[0][:80]!r}")
            at = m.end()
            yield _ESCAPED.sub(r"\1", m[1]), _ESCAPED.sub(r"\1", m[2]), m[2]
        self._held = [text[at:]]
        if _END in self._held[0]:
            raise ValueError(f"not a turn: {self._held[0][:80]!r}")

    def close(self) -> None:
        """The end of the conversation's text: nothing may be left."""
        if any(self._held):
            raise ValueError(f"text after the last turn: {''.join(self._held)[:80]!r}")


def _source(role: str, text: str) -> bytes:
    """What tells a turn from another."""
    return hashlib.md5(f"{len(role)} {role}{text}".encode(), usedforsecurity=False).digest()


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, segment, loss_start, loss_end, source`` for every row of ``turns``.

    ``segment`` is the rendered turn; a conversation's text is its segments in
    order of ``turn``. ``source`` is a digest of the role and text. Of an assistant's turn the characters from
    ``loss_start`` to ``loss_end`` are under the loss mask; of others none are
    (both 0). Null text or role counts as empty. Works row by row, so one
    conversation may be of any length; other columns are not read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = [render_turn(r or "", t or "") for r, t in zip(part["role"], part["text"])]
            mine = part["role"] == "assistant"
            yield pd.DataFrame({
                "conv_id": part["conv_id"], "turn": part["turn"], "role": part["role"].fillna(""),
                "segment": [m[0] for m in made],
                "loss_start": [m[1] if a else 0 for m, a in zip(made, mine)],
                "loss_end": [m[2] if a else 0 for m, a in zip(made, mine)],
                "source": [_source(r or "", t or "") for r, t in zip(part["role"], part["text"])]})

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "conv_id long, turn long, role string, segment string, loss_start long, "
                                "loss_end long, source binary")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, digested from what :func:`format_turns` wrote.

    A conversation's segments in order of turn (ties: role, then segment) are
    one text, which a :class:`Reader` splits into turns again. Each turn found
    is compared with the source's turn of that place; a difference, a turn too
    many or too few, or a loss range that isn't the turn's text is an error.
    Digests run along, so memory doesn't grow with a conversation. Null
    ``conv_id`` is one conversation. An empty table gives an empty result.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for part in parts:
            out = []
            nulls = part["conv_id"].isna()
            for conv, null, segment, lo, hi, source in zip(part["conv_id"], nulls, part["segment"], part["loss_start"],
                                                           part["loss_end"], part["source"]):
                key = None if null else int(conv)
                if state is None or key != state.conv:
                    if state is not None:
                        out.append(state.row())
                    state = _Conversation(key)
                state.add(segment, segment[lo:hi], bytes(source))
            yield _frame(out)
        if state is not None:
            yield _frame([state.row()])

    return (formatted.repartition(tasks(formatted.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "segment")
            .select("conv_id", "segment", "loss_start", "loss_end", "source")
            .mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                              "loss_sha256 string, formatted_chars long"))


class _Conversation:
    """Running digests of a conversation, from the turns its reader finds."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.reader, self.waiting = conv, Reader(), deque()
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, masked: str, source: bytes) -> None:
        self.waiting.append((masked, source))
        self.chars += len(segment)
        for role, text, written in self.reader.feed(segment):
            masked, source = self.waiting.popleft() if self.waiting else ("", b"")
            mine = role == "assistant"
            if _source(role, text) != source or masked != (written if mine else ""):
                raise ValueError(f"conversation {self.conv}: turn {self.turns} isn't the source's: {role!r}, {text[:80]!r}")
            self.turns += 1
            self.digest.update(f"{role}\n{text}\n".encode())
            if mine:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        self.reader.close()
        if self.waiting:
            raise ValueError(f"conversation {self.conv}: {len(self.waiting)} turns of the source weren't found")
        return self.conv, self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _frame(rows) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return f.astype({"conv_id": "Int64", "n_turns": "int64", "loss_chars": "int64", "formatted_chars": "int64"})
