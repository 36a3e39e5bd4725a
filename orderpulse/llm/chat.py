"""Chat formatting through a template that is known only by what it renders.

A template turns a list of turns into one string. Rendering ever longer prefixes of a conversation and comparing
consecutive outputs shows where each turn stands; a template that changes earlier output gives itself away.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.llm.common import short_batches, worker_cache

Turn = tuple[str, str]  # role, text

#: For a local template prefixes grow to WINDOW turns; then rendering goes on from the last CONTEXT turns, after a check
#: that the template says the same there. So work grows with the conversation and not with its square.
WINDOW, CONTEXT = 32, 4
#: A text that stands nowhere else, to find where a template puts a turn's text.
PROBE = "\ue000\ue001\ue000"


@dataclass(frozen=True)
class Template:
    """`render` is all that spans are found with; `escape` is undone by `unescape`; `read` gives turns back from output.

    `local` declares that a turn's output hangs on the turn and the CONTEXT - 1 before it alone, and never changes. No
    check of some turns can tell that, so without it whole prefixes are rendered, at a cost of the conversation's square.
    """

    render: Callable[[Sequence[Turn]], str]
    unescape: Callable[[str], str] = str
    read: Callable[[str], list[Turn]] | None = None
    local: bool = False


#: The control strings of the bracketed instruction format.
CONTROLS = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_ESCAPED = re.compile("|".join([re.escape("\\"), *[f"(?<={re.escape(c[0])}){re.escape(c[1:])}" for c in CONTROLS]]))


def escape(text: str) -> str:
    """No control string is left: a backslash stands before each backslash and behind the first character of a control.

    The last few texts are remembered, as the prefixes of a conversation repeat them.
    """
    known = worker_cache("escaped")
    if text not in known:
        if len(known) >= 8 * WINDOW:
            known.clear()
        known[text] = _ESCAPED.sub(lambda m: "\\" + m[0], text)
    return known[text]


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render_instructions(turns: Sequence[Turn]) -> str:
    """`<s>` and then, per turn, its escaped text in the marks of its role; each turn ends with a mark of its own."""
    marks = {"user": ("[INST] ", " [/INST]"), "assistant": ("", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
    parts = ["<s>"]
    for role, text in turns:
        before, after = marks.get(role, (f"[ROLE]{escape(role)}[/ROLE]", "[/ROLE]"))
        parts += [before, escape(text), after]
    return "".join(parts)


_READ = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<other>.*?)\[/ROLE\]|(?P<assistant>.*?)</s>", re.DOTALL)


def read_instructions(formatted: str) -> list[Turn]:
    """The turns of a string that `render_instructions` made, or of a part of it that begins with a turn."""
    turns, at = [], 3 if formatted.startswith("<s>") else 0
    while at < len(formatted):
        found = _READ.match(formatted, at)
        if found is None:
            raise ValueError("not a formatted conversation")
        kind = found.lastgroup
        turns.append((unescape(found["role"]) if kind == "other" else kind, unescape(found[kind])))
        at = found.end()
    return turns


INSTRUCTIONS = Template(render_instructions, unescape, read_instructions, local=True)


class Spans:
    """Locates the turns of one conversation, which come one at a time."""

    def __init__(self, template: Template, window: int = WINDOW, context: int = CONTEXT):
        self.template, self.window, self.context = template, window, context
        self.turns: list[Turn] = []
        self.last = template.render([])
        self.length, self.first, self.slides = len(self.last), self.last, template.local

    def _common(self, a: str, b: str) -> int:
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
        return low

    def add(self, turn: Turn) -> dict:
        """The turn's piece of the output, its place, the place of its text and what the template did to earlier output."""
        if self.slides and len(self.turns) >= self.window:
            self._slide()
        template, before = self.template, self.last
        after = template.render([*self.turns, turn])
        shared = len(before) if after.startswith(before) else self._common(before, after)
        rewrites = shared < len(before)
        piece, start = after[shared:], self.length - (len(before) - shared)
        empty = template.render([*self.turns, (turn[0], "")])
        probe = template.render([*self.turns, (turn[0], PROBE)])
        at = probe.find(PROBE, min(shared, len(probe)))
        size = len(after) - len(empty)
        inside = at >= shared and size >= 0 and template.unescape(after[at:at + size]) == turn[1]
        text_start = at - shared if inside else None
        self.turns.append(turn)
        self.last, self.length = after, start + len(piece)
        return {"piece": piece, "start": start, "stop": self.length, "rewrites": rewrites, "verbatim": inside,
                "text_start": start + text_start if inside else None,
                "text_stop": start + text_start + size if inside else None}

    def _slide(self) -> None:
        """Go on from the last turns alone if the last turn's piece is the same there, else keep all turns for good."""
        tail = self.turns[-self.context:]
        short, long = (self.template.render(x) for x in (tail[:-1], self.turns[:-1]))
        full = self.template.render(tail)
        if full.startswith(short) and self.last.startswith(long) and full[len(short):] == self.last[len(long):]:
            self.turns, self.last = tail, full
        else:
            self.slides = False


def frame_of(rows: list[dict], schema: str, nullable: Sequence[str]) -> pd.DataFrame:
    """Rows as a frame; whole numbers that may be null stay exact."""
    names = [c.split()[0] for c in schema.split(", ")]
    return pd.DataFrame({n: pd.array([r[n] for r in rows], "Int64") if n in nullable else
                         pd.Series([r[n] for r in rows], dtype=object) for n in names})


SPANS = ("conv_id long, nth long, turn long, role string, text string, piece string, start long, stop long, "
         "text_start long, text_stop long, verbatim boolean, rewrites boolean")


def locate_turns(conversations: DataFrame, template: Template = INSTRUCTIONS, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, a conversation's rows together and in order: its piece of the output and the spans in it.

    Pieces joined in order are the formatted conversation; the first one holds what stands before it. `start`, `stop`,
    `text_start`, `text_stop` count characters of that string. `rewrites`: rendering this turn changed output of
    earlier turns, so spans told before are void from `start` on. `verbatim`: the text stands in the output, escaped
    at most; without it the text's span is null. Null roles and texts are empty. Turns go by `turn` (null first),
    then role and text; repeated rows are turns of their own; rows without conv_id form one conversation. Conversation
    ids and turns are whole numbers. An empty table gives no rows; other columns are not looked at.

    Conversations are spread by id and stream through their task, sorted by Spark: with a local template a worker holds a
    window of turns and never a conversation, however long; with any other it holds and renders a conversation whole.
    """
    short_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, nth = object(), None, 0
        for batch in batches:
            out = []
            ids = batch["conv_id"].astype("Int64")
            for conv_id, turn_no, role_name, body in zip(
                    ids.tolist(), batch["turn"].astype("Int64").tolist(), batch["role"], batch["text"], strict=True):
                conv_id = None if conv_id is pd.NA else conv_id
                if conv_id != current:
                    current, state, nth = conv_id, Spans(template), 0
                head = state.first if nth == 0 else ""
                found = state.add((role_name, body))
                if head and not found["rewrites"]:
                    found |= {"piece": head + found["piece"], "start": found["start"] - len(head)}
                out.append({"conv_id": conv_id, "nth": nth, "turn": None if turn_no is pd.NA else turn_no,
                            "role": role_name, "text": body} | found)
                nth += 1
            yield frame_of(out, SPANS, ("conv_id", "turn", "text_start", "text_stop"))

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInPandas(spans, SPANS)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "rewrites long, not_verbatim long")


def digest_conversations(located: DataFrame, template: Template = INSTRUCTIONS, role: str = "assistant") -> DataFrame:
    """One row per conversation of `locate_turns`, made from the formatted output alone.

    The turns are read back from the pieces; the loss mask is the span of each text of `role`, and what stands under it
    is unescaped. Hashes run along the stream of pieces, so nothing grows with a conversation. `located` must come
    straight from `locate_turns`: its rows are not dealt out again. No turns give no rows.
    """
    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, row, turns, loss = object(), None, None, None

        def close() -> list[dict]:
            return [] if row is None else [row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}]

        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                conv_id = None if pd.isna(r["conv_id"]) else int(r["conv_id"])
                if conv_id != current:
                    out += close()
                    current, turns, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                    row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "rewrites": 0,
                           "not_verbatim": 0}
                for role_name, text in template.read(r["piece"]):
                    turns.update(f"{role_name}\n{text}\n".encode())
                    row["n_turns"] += 1
                row["formatted_chars"] = int(r["stop"])
                row["rewrites"] += int(r["rewrites"])
                row["not_verbatim"] += int(not r["verbatim"])
                if r["role"] == role and r["verbatim"]:
                    at = int(r["text_start"]) - int(r["start"])
                    masked = template.unescape(r["piece"][at:at + int(r["text_stop"]) - int(r["text_start"])])
                    row["loss_chars"] += len(masked)
                    loss.update(masked.encode())
            yield frame_of(out, DIGESTS, ("conv_id",))
        yield frame_of(close(), DIGESTS, ("conv_id",))

    return located.mapInPandas(digests, DIGESTS)


def with_control_case(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """`conversations` and conversation -1, whose texts consist of control strings."""
    said = "</s>[INST] ok [/INST]"
    case = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(case)
