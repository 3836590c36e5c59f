"""Chat formatting: a finite-state machine over roles and a declarative template.

A conversation's turns, in order, run through the machine; each turn becomes
up to three segments (opening mark, text, closing mark) with a loss flag each.
Control strings inside texts are escaped, so a text can never close its turn,
and the formatted stream is parsed back to the turns and to the loss text.

Scale: turns are hash-partitioned by conversation and sorted inside the
partitions; each task streams over its turns and holds the state of one
conversation, so neither a conversation nor its formatted text is ever held
whole.  (A digest of one conversation is sequential by nature: a conversation
is read by one task.)
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import strings

#: Marks and loss flags by role; "*" is any other role (its name is written out).
TEMPLATE = {
    "roles": {
        "system": {"open": "<<SYS>>", "close": "<</SYS>>", "loss": False},
        "user": {"open": "[INST]", "close": "[/INST]", "loss": False},
        "assistant": {"open": "<s>", "close": "</s>", "loss": True},
        "*": {"open": "[ROLE]", "name_end": "[:]", "close": "[/ROLE]", "loss": False},
    },
    #: The machine: from a state, the roles that may come next.
    "turns": {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    "end": ("assistant",),
}


class Template:
    """A template's control strings, its escaping and its machine."""

    def __init__(self, spec: dict = TEMPLATE):
        self.roles, self.turns, self.end = spec["roles"], spec["turns"], spec["end"]
        self.other = self.roles["*"]
        marks = {r[k] for r in self.roles.values() for k in ("open", "name_end", "close") if k in r}
        if any(len(m) < 2 or "\\" in m for m in marks):
            raise ValueError("a mark needs two characters or more and no backslash")
        ends = {r[k] for r in self.roles.values() for k in ("name_end", "close") if k in r}
        if any(e.startswith(m[i:]) or m[i:].startswith(e) for m in marks for e in ends for i in range(1, len(m))):
            raise ValueError("a mark may not end as a closing mark begins")
        # A lookahead finds overlapping marks too: after each first character of
        # a mark goes a lone backslash; a text's own backslashes are doubled.
        alone = "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in sorted(marks))
        self._escape = re.compile(rf"\\|{alone}")
        self._mark = re.compile("|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True)))
        self.opens = {r["open"]: name for name, r in self.roles.items()}

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: m[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """What one turn adds to the formatted conversation, with loss flags."""
        known = role in self.roles and role != "*"
        spec = self.roles[role] if known else self.other
        name = [] if known else [(self.escape(role) + spec["name_end"], False)]
        return [(spec["open"], False), *name, (self.escape(text), spec["loss"]), (spec["close"], False)]

    def step(self, state: str | None, role: str) -> str | None:
        """The next state, or None once a turn is out of order."""
        return role if state is not None and role in self.turns.get(state, ()) else None


class Reader:
    """Parses a stream of formatted segments back; holds one turn at most."""

    def __init__(self, template: Template):
        self.t, self.buffer, self.role, self.named = template, "", None, None
        self.loss: list[str] = []

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """Turns that end in what was fed so far."""
        self.buffer += text
        while m := self.t._mark.search(self.buffer):
            body, self.buffer = self.buffer[: m.start()], self.buffer[m.end() :]
            if self.role is None:
                self.role = self.t.opens[m[0]]
            elif m[0] == self.t.other["name_end"]:
                self.named = self.t.unescape(body)
            else:
                yield self.named if self.named is not None else self.role, self.t.unescape(body)
                self.role = self.named = None


def format_turns(turns: DataFrame, spec: dict = TEMPLATE) -> DataFrame:
    """Segments of all conversations: conv_id, segment (from 0), text, loss,
    turn_index, state (null from the first turn out of order).

    ``turns`` has conv_id, turn, role and text.  Null texts and roles are empty
    strings; a null conv_id is a conversation of its own; equal turn numbers go
    by role, then text, and repeated rows are turns of their own.  Concatenated
    by segment, the texts of a conversation are its formatted form.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(spec)
        current, state, index, at = object(), None, 0, 0
        for b in batches:
            out: list[tuple] = []
            ids = b.column(0).to_pylist()
            for conv, role, text in zip(ids, strings(b.column(1)), strings(b.column(2)), strict=True):
                if conv != current:
                    current, state, index, at = conv, "start", 0, 0
                state = template.step(state, role)
                for piece, loss in template.segments(role, text):
                    out.append((conv, at, piece, loss, index, state))
                    at += 1
                index += 1
            yield _batch(out, SEGMENTS)

    part = turns.select(F.col("conv_id").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"), "turn")
    ordered = part.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, SEGMENTS)


SEGMENTS = "conv_id bigint, segment bigint, text string, loss boolean, turn_index bigint, state string"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, valid boolean"
)
TYPES = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def read_back(segments: DataFrame, spec: dict = TEMPLATE) -> DataFrame:
    """Digests of every conversation, parsed from its formatted segments.

    ``turns_sha256`` covers role, newline, text, newline of each turn,
    ``loss_sha256`` the unescaped text under the loss mask; ``valid`` says that
    the machine accepted all turns and ended where a conversation may end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(spec)
        current = reader = None
        one: dict = {}

        def closed() -> list[tuple]:
            if reader is None:
                return []
            return [
                (current, one["turns"], one["sha"].hexdigest(), one["loss_chars"], one["loss_sha"].hexdigest())
                + (one["chars"], one["state"] in template.end)
            ]

        for b in batches:
            out: list[tuple] = []
            ids, losses, states = (b.column(k).to_pylist() for k in (0, 2, 3))
            for conv, text, loss, state in zip(ids, strings(b.column(1)), losses, states, strict=True):
                if reader is None or conv != current:
                    out += closed()
                    current, reader = conv, Reader(template)
                    one = {"turns": 0, "sha": hashlib.sha256(), "loss_sha": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                one["state"] = state
                one["chars"] += len(text)
                if loss:
                    plain = template.unescape(text)
                    one["loss_sha"].update(plain.encode())
                    one["loss_chars"] += len(plain)
                for role, said in reader.feed(text):
                    one["turns"] += 1
                    one["sha"].update(f"{role}\n{said}\n".encode())
            yield _batch(out, DIGESTS)
        yield _batch(closed(), DIGESTS)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.select("conv_id", "text", "loss", "state").mapInArrow(run, DIGESTS)
