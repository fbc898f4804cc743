"""Chat formatting by a finite-state machine over roles.

A ``Template`` is data: the marks around each role's text, whether the text counts in the loss, and the machine's
transitions, each with the mark it emits. The machine walks the turns of a conversation in order, reports every
turn that has no transition, and emits text segments with a loss flag each. ``read_back`` runs the way back on
the formatted text and its flags alone.

Control strings inside texts are escaped: a backslash goes in after the first character, before any backslashes that
stand there already. Taking one away restores the text, and no escaped text holds a control string. This needs control
strings that neither hold nor overlap each other, which a template checks as it is made.

Turns are dealt by conversation and sorted, then stream through the machine: a task keeps the state of one
conversation, never its turns, so a conversation of any length takes constant memory. The order of turns is what
the machine and the digests follow, so one conversation is not split; ``read_back`` continues in the same tasks.

Cases: a null text or role is an empty one; a null conv_id is a conversation of its own; turns of equal number
keep their order by role and text, null turns come first; a turn out of order counts as a violation, is formatted like
any other, and the machine goes on in the state of its role; a role that the template does not name is written with
its name, counts as a violation and leaves the state as it was; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Marks:
    """What stands before and after a role's text, and whether the text counts in the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles`` by name; ``other`` for the rest, its ``before`` holding ``{role}``; ``moves``: state -> role -> mark
    emitted by the transition into the state of that role; ``ends``: states in which a conversation is complete;
    ``otherwise``: mark emitted before a turn that has no transition."""

    controls: tuple[str, ...]
    roles: dict[str, Marks]
    other: Marks
    moves: dict[str, dict[str, str]]
    ends: frozenset[str]
    otherwise: str = ""
    escape_at: re.Pattern = field(init=False)
    unescape_at: re.Pattern = field(init=False)
    turn: re.Pattern = field(init=False)

    def __post_init__(self):
        for a in self.controls:
            if len(a) < 2 or "\\" in a:
                raise ValueError(f"control string {a!r} needs two characters, none of them a backslash")
            for b in self.controls:
                if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        one = "|".join(rf"(?<={re.escape(c[0])})%s(?=\\*{re.escape(c[1:])})" for c in self.controls)
        put = lambda name, value: object.__setattr__(self, name, value)
        put("escape_at", re.compile(one.replace("%s", "")))
        put("unescape_at", re.compile(one.replace("%s", r"\\")))
        opening = "|".join(sorted({re.escape(m) for by in self.moves.values() for m in by.values() if m} | {re.escape(self.otherwise)}, key=len, reverse=True))
        forms = [rf"{re.escape(m.before)}(?P<r{i}>.*?){re.escape(m.after)}" for i, m in enumerate(self.roles.values())]
        head, tail = self.other.before.split("{role}")
        forms.append(rf"{re.escape(head)}(?P<name>.*?){re.escape(tail)}(?P<text>.*?){re.escape(self.other.after)}")
        put("turn", re.compile(f"(?:{opening})(?:{'|'.join(forms)})", re.DOTALL))

    def escape(self, text: str) -> str:
        return self.escape_at.sub(r"\\", text)

    def unescape(self, text: str) -> str:
        return self.unescape_at.sub("", text)

    def step(self, state: str, role: str) -> tuple[str, str, bool]:
        """(mark, next state, in order?) of a turn."""
        mark = self.moves.get(state, {}).get(role)
        return (mark, role, True) if mark is not None else (self.otherwise, role if role in self.roles else state, False)

    def segments(self, mark: str, role: str, text: str) -> list[tuple[str, bool]]:
        m = self.roles.get(role)
        before, m = (m.before, m) if m else (self.other.before.replace("{role}", self.escape(role)), self.other)
        return [(mark + before, False), (self.escape(text), m.loss), (m.after, False)]

    def parse(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        found = self.turn.fullmatch(formatted)
        if found is None:
            raise ValueError(f"not a turn: {formatted[:80]!r}")
        for i, role in enumerate(self.roles):
            if (text := found[f"r{i}"]) is not None:
                return role, self.unescape(text)
        return self.unescape(found["name"]), self.unescape(found["text"])


#: Exchanges of a user and an assistant, each between <s> and </s>; a system turn may open the conversation.
INSTRUCT = Template(
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[ANS]"),
    roles={
        "system": Marks("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks("[ANS] ", " </s>", loss=True),
    },
    other=Marks("[ROLE] {role} [/ROLE] ", " </s>"),
    moves={START: {"system": "<s>", "user": "<s>"}, "system": {"user": ""}, "user": {"assistant": ""}, "assistant": {"user": "<s>"}},
    ends=frozenset({"assistant"}),
)

FORMATTED = "conv_id long, violation boolean, complete boolean, segments array<struct<text:string,loss:boolean>>"
_SEGMENT = pa.struct([("text", pa.string()), ("loss", pa.bool_())])
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("violation", pa.bool_()), ("complete", pa.bool_()), ("segments", pa.list_(_SEGMENT))])


def format_chats(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """A row for each turn, conversations whole and in order within a partition: conv_id, violation (the turn is out of
    order), complete (a conversation may end here) and its segments (text, loss)."""

    def run(batches: Iterator[pa.RecordBatch]):
        now, state = object(), START
        for b in batches:
            out = []
            for conv_id, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if conv_id != now:
                    now, state = conv_id, START
                mark, state, fine = template.step(state, role)
                out.append((conv_id, not fine, state in template.ends, [{"text": t, "loss": x} for t, x in template.segments(mark, role, text)]))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FORMATTED, strict=True)], schema=_FORMATTED)

    none = F.lit("")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, violations long, complete boolean"
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("violations", pa.int64()), ("complete", pa.bool_())])


class Reader:
    """Running digests of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.violations = 0
        self.complete = False

    def add(self, template: Template, segments: list[dict], violation: bool, complete: bool) -> None:
        formatted = "".join(s["text"] for s in segments)
        role, text = template.parse(formatted)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        masked = template.unescape("".join(s["text"] for s in segments if s["loss"]))
        self.loss.update(masked.encode("utf-8", "surrogatepass"))
        self.n, self.loss_chars, self.chars = self.n + 1, self.loss_chars + len(masked), self.chars + len(formatted)
        self.violations, self.complete = self.violations + violation, complete

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.violations, self.complete


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation, from the output of ``format_chats``: turns, characters and digests of turns and of the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]):
        reader, rows = None, []

        def batch():
            columns = list(zip(*rows, strict=True)) or [()] * len(_READ)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ, strict=True)], schema=_READ)

        for b in batches:
            for conv_id, violation, complete, segments in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        rows.append(reader.row())
                    reader = Reader(conv_id)
                reader.add(template, segments, violation, complete)
            if len(rows) >= 4096:
                yield batch()
                rows = []
        if reader is not None:
            rows.append(reader.row())
        yield batch()

    return formatted.mapInArrow(run, READ)


#: The texts of conversation -1 hold the template's own control strings.
CHECK_TEXT = "</s>[INST] ok [/INST]"


def with_check(conversations: DataFrame) -> DataFrame:
    """The conversations and one, of id -1, whose texts look like marks."""
    spark = conversations.sparkSession
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHECK_TEXT).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").union(own)


_CONTROL = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in INSTRUCT.controls)
ORACLE_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CHECK_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CHECK_TEXT}'),
p AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
t AS (SELECT *, CASE WHEN (before IS NULL AND role IN ('system', 'user')) OR (before = 'assistant' AND role = 'user') THEN 3 ELSE 0 END
    + CASE role WHEN 'system' THEN {len(INSTRUCT.roles["system"].before + INSTRUCT.roles["system"].after)} WHEN 'user' THEN {len(INSTRUCT.roles["user"].before + INSTRUCT.roles["user"].after)} ELSE {len(INSTRUCT.roles["assistant"].before + INSTRUCT.roles["assistant"].after)} END
    + length(text) + len(regexp_extract_all(text, '{_CONTROL}')) AS chars,
  NOT ((before IS NULL AND role IN ('system', 'user')) OR (before IN ('system', 'assistant') AND role = 'user') OR (before = 'user' AND role = 'assistant')) AS wrong FROM p)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (wrong)::BIGINT AS violations, bool_or(after IS NULL AND role = 'assistant') AS complete
FROM t GROUP BY conv_id
"""
