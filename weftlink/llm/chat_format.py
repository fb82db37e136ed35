"""Chat text from conversations: a finite-state machine over roles and a declarative template.

A template names each role's opening mark, the mark that ends a turn, which roles
carry loss, and the machine's moves. Texts are escaped so that no mark can occur in
them, and the escape is undone exactly when the output is read back. A conversation
is formatted turn by turn in order, so its length needs no memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """labels: role to the name in its opening mark; moves: state to the roles that may follow, each leading to the state of its name."""

    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    opening: str = "### "
    after: str = ": "
    closing: str = " </turn>\n"
    mark: str = "</turn>"
    loss: frozenset[str] = frozenset({"assistant"})
    moves: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user", "tool"}),
            "tool": frozenset({"assistant", "tool"}),
        }
    )

    def open(self, role: str | None) -> str:
        """A role without a label is written as JSON, which an opening mark can hold whatever the role's characters are."""
        name = self.labels.get(role) if role is not None else None
        return f"{self.opening}{name if name is not None else 'Role ' + json.dumps(role)}{self.after}"

    def escape(self, text: str) -> str:
        return text.replace("\\", "\\\\").replace(self.opening, "\\" + self.opening).replace(self.mark, "\\" + self.mark)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text

    def role_of(self, opening: str) -> str | None:
        """The role of an opening mark; ValueError if it isn't one."""
        if not (opening.startswith(self.opening) and opening.endswith(self.after)):
            raise ValueError(f"not an opening mark: {opening!r}")
        name = opening[len(self.opening) : len(opening) - len(self.after)]
        if name.startswith("Role "):
            return json.loads(name[5:])
        return {v: k for k, v in self.labels.items()}[name]


SEGMENTS = "conv_id long, seg long, part string, text string, loss boolean, order_ok boolean"


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = object()
        state, seg, ok = "", 0, True
        for b in batches:
            out: list[tuple] = []
            held = 0
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != now:
                    now, state, seg, ok = conv, "", 0, True
                ok = ok and role in template.moves.get(state, ())
                state = role if role and role in template.moves else "?"
                body = template.escape(text or "")
                for part, piece, loss in (("open", template.open(role), False), ("text", body, role in template.loss), ("close", template.closing, False)):
                    out.append((conv, seg, part, piece, loss, ok))
                    seg += 1
                held += len(body)
                if held > 1 << 22:
                    yield _segments(out)
                    out, held = [], 0
            if out:
                yield _segments(out)

    return run


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    spec = [x.split() for x in SEGMENTS.split(", ")]
    return pa.record_batch([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows, strict=True), spec, strict=True)], [n for n, _ in spec])


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """Text segments (conv_id, seg, part, text, loss, order_ok) of all conversations, each conversation's in one partition and in order.

    Joined in order of seg, a conversation's segments are its formatted text; loss
    says whether a segment is to be learnt. order_ok turns false at the first turn
    that the machine doesn't allow and stays so; no turn is dropped. Turns run by
    (turn, role, text), nulls first; null text is empty; rows with null conv_id are
    one conversation; repeated rows are turns of their own; an empty table has no
    segments. Texts of any length are whole. Other columns aren't read.
    """
    dealt = rows.select("conv_id", "turn", "role", "text").repartition(F.col("conv_id"))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(template or Template()), SEGMENTS)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, order_ok boolean"


def _turn(formatted: str, at: int, t: Template) -> tuple[str | None, str, int] | None:
    """Role and text of the turn that begins at ``at``, and where it ends, by marks alone; None if its closing mark hasn't come yet."""
    m = _opening(t).match(formatted, at)
    if not m:
        raise ValueError(f"no turn at character {at}")
    lead = t.closing.index(t.mark)
    for x in re.finditer(rf"\\.|{re.escape(t.opening)}|{re.escape(t.mark)}", formatted[m.end() :], re.S):
        if x[0][0] == "\\":
            continue
        stop = m.end() + x.start() - lead
        if x[0] != t.mark or stop < m.end() or not formatted.startswith(t.closing, stop):
            raise ValueError(f"a mark inside a text at character {m.end() + x.start()}")
        return t.role_of(m[0]), t.unescape(formatted[m.end() : stop]), stop + len(t.closing)
    return None


@cache
def _opening_pattern(opening: str, labels: tuple[str, ...], after: str) -> re.Pattern:
    label = "|".join(map(re.escape, labels)) + r'|Role (?:null|"(?:[^"\\]|\\.)*")'
    return re.compile(f"{re.escape(opening)}(?:{label}){re.escape(after)}", re.S)


def _opening(t: Template) -> re.Pattern:
    return _opening_pattern(t.opening, tuple(t.labels.values()), t.after)


def split_text(formatted: str, template: Template | None = None) -> list[tuple[str | None, str]]:
    """The turns (role, text) of one conversation's whole formatted text, by its marks alone. ValueError if it is cut short."""
    t = template or Template()
    out, at = [], 0
    while at < len(formatted):
        turn = _turn(formatted, at, t)
        if turn is None:
            raise ValueError(f"the turn at character {at} has no end")
        out.append(turn[:2])
        at = turn[2]
    return out


def _read_back(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: object = None
        begun = False
        turns = loss = None
        n = chars = total = 0
        ok, pending = True, ""

        def finish() -> None:
            if pending:
                raise ValueError(f"conversation {now}: its last turn has no end")
            done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), total, ok))

        for b in batches:
            cols = (b.column(c).to_pylist() for c in ("conv_id", "text", "loss", "order_ok"))
            for conv, text, learn, good in zip(*cols, strict=True):
                if not begun or conv != now:
                    if begun:
                        finish()
                    begun, now, n, chars, total, ok, pending = True, conv, 0, 0, 0, True, ""
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                total += len(text)
                ok = ok and good
                pending += text
                # inside a text a closing mark is escaped, so this one ends a turn
                if pending.endswith(template.closing):
                    for role, plain in split_text(pending, template):
                        n += 1
                        turns.update(f"{role or ''}\n{plain}\n".encode("utf-8", "surrogatepass"))
                    pending = ""
                if learn:
                    plain = template.unescape(text)
                    chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
            if len(done) > 4096:
                yield _digests(done)
                done = []
        if begun:
            finish()
        if done:
            yield _digests(done)

    return run


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    spec = [x.split() for x in DIGEST.split(", ")]
    return pa.record_batch([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows, strict=True), spec, strict=True)], [n for n, _ in spec])


def digests(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Read the formatted text back and digest each conversation's turns and loss text.

    segments are as format_conversations deals and orders them. Turns are found in the
    joined text by its marks alone; of the segments only their order and loss flags
    are used. Nothing is read from the input rows.
    """
    return segments.select("conv_id", "text", "loss", "order_ok").mapInArrow(_read_back(template or Template()), DIGEST)
