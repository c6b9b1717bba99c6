"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names, for each role, the text before and after a turn and whether
the turn's own text counts for the loss.  Rows of a conversation stream through
in the order of turn; the machine checks the order of roles as they pass, so
memory doesn't grow with a conversation.  The output is one row per segment of
the formatted text with its loss flag; the segments' texts joined in order are
the formatted conversation.  A segment's ok is false from the turn that broke the
order on, and in the last segment also if the conversation ends in a state where
it may not.

Control strings inside a turn's text are escaped: a mark goes in after their
first character, and a mark in the text is doubled.  No control string is left
whole, and taking the marks out again gives back the text.

Defined cases: a null text is empty, a null role has the empty name, a null
conv_id is a conversation of its own; rows with equal turn go by role, then
text; an unknown role is written with its name in the fallback marks; a
conversation in a wrong order, or one that stops on a user's turn, is formatted
too, with ok false as said.  Other columns are ignored, repeated rows are turns
each, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import tasks_for

MARK = "\\"


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """turns: by role.  other_*: around the name of any other role and after its text.

    order: from state and role to the next state; the machine begins in state
    "start" and may end in those of `ends`.
    """

    turns: dict[str, Turn]
    other_open: str = "[ROLE]"
    other_name_end: str = "[/ROLE]"
    other_close: str = "[END]"
    order: dict[tuple[str, str], str] = field(default_factory=dict)
    ends: frozenset[str] = frozenset()

    def controls(self) -> list[str]:
        found = {self.other_open, self.other_name_end, self.other_close}
        for turn in self.turns.values():
            found |= {turn.before, turn.after}
        return sorted({c.strip() for c in found} - {""}, key=lambda c: (-len(c), c))


INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    order={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
    ends=frozenset({"assistant"}),
)


class Escaper:
    """Reversible escaping of a template's control strings."""

    def __init__(self, template: Template):
        self.marked = [(c, c[0] + MARK + c[1:]) for c in template.controls()]

    def escape(self, text: str) -> str:
        text = text.replace(MARK, MARK + MARK)
        for control, marked in self.marked:
            text = text.replace(control, marked)
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)


SEGMENTS = "conv_id long, seg long, segment string, loss boolean, ok boolean, turn_start boolean"
_SEGMENT_TYPES = [("conv_id", pa.int64()), ("seg", pa.int64()), ("segment", pa.string()), ("loss", pa.bool_()), ("ok", pa.bool_()), ("turn_start", pa.bool_())]


def _batch(rows: list[tuple], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types])


def _format(template: Template):
    escaper = Escaper(template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, seg, ok = object(), "start", 0, True
        last: list[tuple] = []  # the latest segment, held back as it may be the conversation's last

        def ended() -> list[tuple]:
            return [(*row[:4], row[4] and state in template.ends, row[5]) for row in last]

        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if conv != now:
                    rows += ended()
                    last = []
                    now, state, seg, ok = conv, "start", 0, True
                role = role or ""
                rows += last
                state = template.order.get((state, role), "broken")
                ok = ok and state != "broken"
                turn = template.turns.get(role)
                before = turn.before if turn else template.other_open + escaper.escape(role) + template.other_name_end
                after = turn.after if turn else template.other_close
                for i, (part, loss) in enumerate(((before, False), (escaper.escape(text or ""), bool(turn and turn.loss)), (after, False))):
                    rows.append((conv, seg, part, loss, ok, i == 0))
                    seg += 1
                last = [rows.pop()]
            yield _batch(rows, _SEGMENT_TYPES)
        yield _batch(ended(), _SEGMENT_TYPES)

    return run


def format_conversations(rows: DataFrame, template: Template = INSTRUCT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Segments of every conversation: conv_id, seg, segment, loss, ok, turn_start.

    A conversation's segments come in order within one partition.
    """
    picked = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    tasks = tasks_for(rows.sparkSession, 1, 1)
    ordered = picked.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(template), SEGMENTS)


class _Reader:
    """Reads one formatted conversation as its segments arrive and keeps digests only."""

    def __init__(self, template: Template):
        self.template = template
        self.roles = {t.before: r for r, t in template.turns.items()}
        self.closing = {t.after for t in template.turns.values()} | {template.other_close}
        self.controls = re.compile("|".join(re.escape(c) for c in sorted({*self.roles, *self.closing, template.other_open, template.other_name_end}, key=len, reverse=True)))
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss, self.ok = hashlib.sha256(), hashlib.sha256(), True
        self.role: str | None = None
        self.inside: list[str] = []
        self.rest = ""  # text that may go on as a control string
        self.most = max(map(len, [*self.roles, *self.closing, template.other_open, template.other_name_end]))

    def take(self, segment: str, loss: bool, ok: bool) -> None:
        """Segments are joined as they come: where one ends tells nothing of the text."""
        self.chars += len(segment)
        self.ok = ok
        if loss:
            plain = Escaper.unescape(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self._scan(self.rest + segment, self.most - 1)

    def _scan(self, text: str, keep: int) -> None:
        """Read text but for the last `keep` characters behind its last control string."""
        at = 0
        for found in self.controls.finditer(text):
            self.inside.append(text[at : found.start()])
            at = found.end()
            mark = found.group()
            if mark in self.roles:
                self.role, self.inside = self.roles[mark], []
            elif mark == self.template.other_open:
                self.inside = []
            elif mark == self.template.other_name_end:
                self.role, self.inside = Escaper.unescape("".join(self.inside)), []
            else:
                body = Escaper.unescape("".join(self.inside))
                self.all.update(f"{self.role}\n{body}\n".encode("utf-8", "surrogatepass"))
                self.turns += 1
                self.inside = []
        cut = max(at, len(text) - keep)
        self.inside.append(text[at:cut])
        self.rest = text[cut:]

    def row(self, conv) -> tuple:
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.ok


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, order_ok boolean"
_DIGEST_TYPES = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("order_ok", pa.bool_())]


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader = object(), None
        for batch in batches:
            rows = []
            for conv, segment, loss, ok in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if conv != now or reader is None:
                    if reader is not None:
                        rows.append(reader.row(now))
                    now, reader = conv, _Reader(template)
                reader.take(segment, loss, ok)
            yield _batch(rows, _DIGEST_TYPES)
        if reader is not None:
            yield _batch([reader.row(now)], _DIGEST_TYPES)

    return run


def read_back(segments: DataFrame, template: Template = INSTRUCT, ordered: bool = False) -> DataFrame:
    """Parse formatted conversations and digest their turns; ordered if the segments come as format_conversations gives them."""
    picked = segments.select("conv_id", "seg", "segment", "loss", "ok")
    if not ordered:
        picked = picked.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return picked.mapInArrow(_read(template), DIGESTS)


def _chat_sql() -> str:
    escaped = "replace(t, '\\', '\\\\')"
    for control in INSTRUCT.controls():
        escaped = f"replace({escaped}, '{control}', '{control[0]}\\{control[1:]}')"
    marks = "CASE role " + " ".join(f"WHEN '{r}' THEN {len(t.before + t.after)}" for r, t in INSTRUCT.turns.items())
    other = len(INSTRUCT.other_open + INSTRUCT.other_name_end + INSTRUCT.other_close)
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({escaped}) + {marks} ELSE {other} + length(role) END)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


#: DuckDB SQL for the query's columns over conversations.
CHAT_SQL = _chat_sql()
