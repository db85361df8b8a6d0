"""Chat formatting: a finite-state machine over roles and a declarative template.

A ``Template`` says how the turns of a role open and close, which roles are trained on (loss), and
the moves of the state machine.  Every turn gives three segments: opening (no loss), text (loss as
its role says) and closing (no loss).  ``segments`` emits them with the machine's state after the
turn and whether its move was allowed; ``formatted`` joins them to one piece of output per turn
with the loss spans in code points; ``read_back`` parses the pieces again.

Escaping: inside texts the escape sign goes before every escape sign and every place where a
control string begins; reading takes it away.  A turn's text ends at the first closing without an
escape sign, which a ``Template`` guarantees (no control string overlaps itself).

Rows of a conversation meet in one shuffle by conversation, sorted by turn, and stream through
their task: state machine, output and digests keep a few values per conversation, never its rows,
so a conversation of any length needs no more memory than its longest text.  (A digest over a
whole conversation is sequential by its nature.)

Defined cases: null text or role is the empty string; a role that the template does not name opens
with its escaped name and is never allowed; a row without conversation id belongs to the
conversation with a null id; equal turn numbers go by role, then text, null turn numbers first;
repeated rows are turns of their own; further columns are ignored; an empty table gives an empty
result."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``opening`` by role, ``closing`` of every turn, ``other`` opens the turns of unnamed roles
    (its ``{}`` is the escaped role), ``loss`` roles, ``moves`` (state, role) -> state from state
    ``start``, ``final`` states in which a conversation is complete."""

    opening: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: str = "### Role <{}>: "
    closing: str = "</turn>\n"
    escape: str = "\\"
    loss: frozenset[str] = frozenset({"assistant"})
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    start: str = "start"
    final: frozenset[str] = frozenset({"assistant"})

    def controls(self) -> list[str]:
        """Control strings, without the white space around them."""
        return sorted({s.strip() for s in (*self.opening.values(), self.closing, self.other.split("{}")[0])})

    def __post_init__(self) -> None:
        for s in self.controls():
            if not s or self.escape in s or any(s.startswith(s[i:]) for i in range(1, len(s))):
                raise ValueError(f"control string {s!r} is empty, overlaps itself or holds the escape sign")
        if len(self.escape) != 1 or not self.closing.startswith(self.closing.strip()):
            raise ValueError("the escape sign is one character, and a closing begins without white space")
        if any(a != b and b.startswith(a) for a in (*self.opening.values(), self.other.split("{}")[0]) for b in self.opening.values()):
            raise ValueError("no opening may begin with another one")

    def escaped(self, text: str, more: str = "") -> str:
        """``text`` with escape signs; ``more``: further characters that get one."""
        begins = "|".join(map(re.escape, self.controls()))
        return re.sub(f"[{re.escape(self.escape + more)}]|(?={begins})", lambda m: self.escape + m.group(), text)

    def plain(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def opened(self, role: str) -> str:
        return self.opening.get(role) or self.other.format(self.escaped(role, ">"))

    def parse(self, output: str) -> Iterator[tuple[str, int, int]]:
        """(role, start, end of the escaped text) of every turn of formatted output."""
        sign = re.escape(self.escape)
        until = lambda end: re.compile(f"(?:{sign}.|[^{sign}])*?(?={re.escape(end)})", re.S)
        head, tail = self.other.split("{}")
        text, name, at = until(self.closing), until(tail), 0
        while at < len(output):
            role = next((r for r, s in self.opening.items() if output.startswith(s, at)), None)
            if role is not None:
                begin = at + len(self.opening[role])
            else:
                if not output.startswith(head, at) or not (m := name.match(output, at + len(head))):
                    raise ValueError(f"no turn opens at {at}")
                role, begin = self.plain(m.group()), m.end() + len(tail)
            if not (m := text.match(output, begin)):
                raise ValueError(f"the turn at {at} does not close")
            yield role, begin, m.end()
            at = m.end() + len(self.closing)


DEFAULT = Template()
SEGMENT = pa.struct([("text", pa.string()), ("loss", pa.bool_())])


def turns_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(_id, _turn, _role, _text), rows of a conversation together and in order."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (rows.select(F.col(conv).alias("_id"), F.col(turn).alias("_turn"), empty(role).alias("_role"), empty(text).alias("_text"))
            .repartition("_id").sortWithinPartitions("_id", "_turn", "_role", "_text"))


def segments(rows: DataFrame, template: Template = DEFAULT, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row per turn: conversation, place (from 0), role, segments (array of text, loss), state
    after the turn, allowed (its move is one of the template).  After a move that is not allowed
    the state is null until the conversation ends, and no later move is allowed."""
    src = turns_of(rows, conv, turn, role, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, state = object(), 0, None
        for b in batches:
            out: list[tuple] = []
            ids = b.column(0).to_pylist()
            for who, r, t in zip(ids, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if who != now:
                    now, place, state = who, 0, template.start
                state = template.moves.get((state, r))
                out.append((place, r, [{"text": template.opened(r), "loss": False}, {"text": template.escaped(t), "loss": r in template.loss},
                                       {"text": template.closing, "loss": False}], state, state is not None))
                place += 1
            kinds = (pa.int64(), pa.string(), pa.list_(SEGMENT), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))],
                                             ["_id", "place", "role", "segments", "state", "allowed"])
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, place long, role string, segments array<struct<text: string, loss: boolean>>, state string, "
                               "allowed boolean").withColumnRenamed("_id", conv)


def formatted(found: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per turn of ``segments``: conversation, place, piece (output of the turn), loss_spans
    (array of start and end in code points of the piece), state, allowed.  The output of a
    conversation is its pieces by place, one after the other."""
    before = lambda i: F.aggregate(F.slice("segments", F.lit(1), i), F.lit(0), lambda n, s: n + F.char_length(s["text"]))
    spans = F.transform("segments", lambda s, i: F.struct(before(i).alias("start"), (before(i) + F.char_length(s["text"])).alias("end"), s["loss"].alias("loss")))
    return found.select(conv, "place", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("piece"),
                        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
                                    ).alias("loss_spans"), "state", "allowed")


class Digest:
    """Running digests of one conversation."""

    def __init__(self, who):
        self.who, self.turns, self.whole, self.chars = who, 0, hashlib.sha256(), 0
        self.loss, self.loss_chars, self.allowed, self.state = hashlib.sha256(), 0, True, None

    def add(self, template: Template, piece: str, spans: list[dict], state: str | None, allowed: bool) -> None:
        for role, begin, end in template.parse(piece):
            self.turns += 1
            self.whole.update(f"{role}\n{template.plain(piece[begin:end])}\n".encode("utf-8", "surrogatepass"))
        for s in spans:
            text = template.plain(piece[s["start"]:s["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.chars += len(piece)
        self.allowed, self.state = self.allowed and allowed, state

    def row(self, template: Template) -> tuple:
        return (self.who, self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.allowed,
                self.state in template.final)


def read_back(pieces: DataFrame, template: Template = DEFAULT, conv: str = "conv_id") -> DataFrame:
    """One row per conversation, parsed from the pieces of ``formatted`` in the order they have
    there: n_turns, turns_sha256 (role, newline, text, newline of every turn), loss_chars and
    loss_sha256 (text under the loss spans, unescaped), formatted_chars, order_ok (every move
    allowed), complete (it ends in a final state)."""
    kind = pieces.schema[conv].dataType
    src = pieces.select(F.col(conv).alias("_id"), "piece", "loss_spans", "state", "allowed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, id_type = None, [], None
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_())
        names = ["_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "order_ok", "complete"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((id_type, *kinds))], names)
        for b in batches:
            id_type = b.column(0).type
            for who, *turn in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or who != now.who:
                    if now is not None:
                        done.append(now.row(template))
                    now = Digest(who)
                now.add(template, *turn)
            if done:
                yield batch(done)
                done = []
        if now is not None:
            yield batch([now.row(template)])
    return src.mapInArrow(run, f"_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                               "formatted_chars long, order_ok boolean, complete boolean").withColumnRenamed("_id", conv)
