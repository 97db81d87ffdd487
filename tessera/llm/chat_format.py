"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns are streamed in (conversation, turn) order; the machine checks each
role against the last one and the template turns the row into text segments,
each with its own loss flag.  A control string inside a role or text is escaped
so that the formatted text can be read back exactly.  The state per
conversation is one role and, when digests are taken, running hashes: memory
does not grow with the length of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of


@dataclass(frozen=True)
class Template:
    """Segments of a turn around its role and text, the roles whose text bears
    loss, and the machine: which roles may follow which (``None`` = at the start)."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    control: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    may_follow: dict = field(default_factory=lambda: {
        None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    may_end: tuple[str, ...] = ("assistant",)

    def escape(self, text: str) -> str:
        """Backslashes are doubled and one breaks up every control opening, so
        the opening cannot occur inside and the text can be restored."""
        return text.replace("\\", "\\\\").replace(self.control, self.control[0] + "\\" + self.control[1:])

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace("\n", "\\n")

    @staticmethod
    def unescape(text: str) -> str:
        if "\\" not in text:
            return text
        out, parts = [], iter(text.split("\\"))
        out.append(next(parts))
        for p in parts:
            if p == "":  # a doubled backslash: what follows it is plain
                out.append("\\")
                out.append(next(parts, ""))
            elif p[0] == "n":
                out.append("\n" + p[1:])
            else:
                out.append(p)
        return "".join(out)

    def segments(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        yield self.open + self.escape_role(role) + self.after_role, False
        yield self.escape(text), role in self.loss_roles
        yield self.close, False

    def problem(self, last: str | None, role: str) -> str | None:
        """What the machine holds against ``role`` after ``last`` (None: nothing)."""
        if role in self.may_follow.get(last, ()):
            return None
        return f"{role or 'empty role'} {'at the start' if last is None else 'after ' + (last or 'empty role')}"


_SEGMENTS = "conv_id long, turn_no long, part int, text string, loss boolean, problem string"


def ordered(turns: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order: by turn (null first), then
    role and text, so that ties and repeated rows have one order."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _format(template: Template) -> Callable:
    schema = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.int32()),
                        ("text", pa.string()), ("loss", pa.bool_()), ("problem", pa.string())])

    def run(batches):
        def rows():
            conv, last, n, begun = None, None, 0, False
            for b in batches:
                for c, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                    if not begun or c != conv:
                        conv, last, n, begun = c, None, 0, True
                    problem = template.problem(last, role)
                    for part, (segment, loss) in enumerate(template.segments(role, text)):
                        yield c, n, part, segment, loss, problem if part == 0 else None
                    last, n = role, n + 1
        yield from batches_of(rows(), schema)
    return run


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Text segments in order: ``conv_id``, ``turn_no`` (from 0), ``part``,
    ``text``, ``loss`` and, on a turn's first segment, ``problem`` (what the
    machine holds against the turn order, else null).

    Every row is formatted, wrong turn order or not.  Null role and text count
    as empty, a null turn sorts first, rows of a null conv_id form one
    conversation.  The concatenated ``text`` of a conversation is its formatted
    form.  An empty table gives no rows; other columns are not read."""
    return ordered(turns).mapInArrow(_format(template), _SEGMENTS)


class _Conversation:
    """What is read back from one conversation's segments."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.problem = self.role = None
        self.all_turns, self.under_loss = hashlib.sha256(), hashlib.sha256()

    def add(self, template: Template, part: int, text: str, loss: bool, problem: str | None) -> None:
        self.chars += len(text)
        if part == 0:
            self.turns += 1
            self.problem = self.problem or problem
            self.role = template.unescape(text[len(template.open):len(text) - len(template.after_role)])
            self.all_turns.update(f"{self.role}\n".encode())
        elif part == 1:
            plain = template.unescape(text)
            self.all_turns.update(f"{plain}\n".encode())
            if loss:
                self.loss_chars += len(plain)
                self.under_loss.update(plain.encode())

    def row(self, template: Template) -> tuple:
        problem = self.problem
        if problem is None and self.role not in template.may_end:
            problem = f"{self.role or 'empty role'} at the end"
        return (self.conv_id, self.turns, self.all_turns.hexdigest(), self.loss_chars, self.under_loss.hexdigest(),
                self.chars, problem is None, problem)


def _read_back(template: Template) -> Callable:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("valid", pa.bool_()), ("problem", pa.string())])

    def run(batches):
        def rows():
            conv = None
            for b in batches:
                for c, part, text, loss, problem in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4, 5)),
                                                        strict=True):
                    if conv is None or c != conv.conv_id:
                        if conv is not None:
                            yield conv.row(template)
                        conv = _Conversation(c)
                    conv.add(template, part, text, loss, problem)
            if conv is not None:
                yield conv.row(template)
        yield from batches_of(rows(), schema)
    return run


def digest(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Read the segments of ``format_conversations`` back, in their own order
    and partitions: one row per conversation with ``n_turns``, ``turns_sha256``
    (role, newline, text, newline of each turn, unescaped), ``loss_chars`` and
    ``loss_sha256`` (the text under the loss mask), ``formatted_chars``,
    ``valid`` (turn order and last role are the machine's) and the first
    ``problem``."""
    return segments.mapInArrow(_read_back(template), "conv_id long, n_turns long, turns_sha256 string, "
                               "loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, "
                               "problem string")
