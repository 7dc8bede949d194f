"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string.  Nothing is
known about its inside; a turn's place is found by rendering:

* successive prefixes of a conversation are rendered and compared: where one
  output is a prefix of the next, the added part is the new turn's span;
* where it is not, the template rewrites history; the conversation is marked,
  the turn that causes it named, and only the final output is kept (no spans);
* inside an assistant's span, the text itself is found by rendering the same
  prefix with two probe texts that differ in their first and last character:
  what the two outputs share in front and at the end is the template's own.

Long conversations: whole prefixes are rendered only every ``STEP`` turns.
Between them the turns are rendered after the last ``CONTEXT`` turns alone, and
accepted when their added parts put together are exactly what the whole
prefixes differ by; else that stretch is rendered from whole prefixes.  So past
the first ``STEP`` turns a template that rewrites something more than
``CONTEXT`` turns back and undoes it before the next whole prefix is not
noticed; with ``step=1`` every prefix is rendered whole, and it is.

``InstTemplate`` is the template used here.  It marks turns with control
strings and escapes these inside texts: a backslash is doubled, and a control
string gets a backslash after its first character, so it can not occur in the
escaped text and ``unescape`` restores every text.

Turns are shuffled by conversation and sorted, and a task streams one
conversation after the other; it holds one conversation, which is one string
of the output.

Defined results: a null text is empty, a null role is an empty role name; a
null conversation id is a conversation; repeated (conversation, turn) rows are
turns in the order of role and text, a null turn comes first; an empty table
gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.llm.shared import materialise

STEP, CONTEXT = 1, 2         # every prefix is rendered whole unless a caller asks for longer steps
PROBES = ("①x②", "③x④")
Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]


@lru_cache(maxsize=512)
def _escaped(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in InstTemplate.CONTROLS:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


class InstTemplate:
    """``<s>``, then per turn ``[INST] user [/INST]``, `` assistant</s>``, ``[SYS]system[/SYS]`` or
    ``[ROLE name]text[/ROLE]``."""

    CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE ", "[/ROLE]")

    def __call__(self, turns: list[Turn]) -> str:
        return "<s>" + "".join(self._turn(role, _escaped(text)) for role, text in turns)

    @staticmethod
    def _turn(role: str, text: str) -> str:
        if role == "user":
            return f"[INST] {text} [/INST]"
        if role == "assistant":
            return f" {text}</s>"
        if role == "system":
            return f"[SYS]{text}[/SYS]"
        return f"[ROLE {_escaped(role).replace(']', chr(92) + ']')}]{text}[/ROLE]"

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _shared_start(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _text_borders(template: Template, before: list[Turn], role: str) -> tuple[int, int]:
    """Where a turn's own text starts in the rendering of ``before`` plus the turn, and what follows it."""
    one, two = (template([*before, (role, probe)]) for probe in PROBES)
    start = _shared_start(one, two)
    return start, _shared_start(one[start:][::-1], two[start:][::-1])


def _added(template: Template, context: list[Turn], turns: list[Turn], loss_role: str) -> list[tuple[str, int, int]] | int:
    """(added text, start and length of the turn's own text in it) per turn; or the turn that rewrites history."""
    found, last = [], template(context)
    for k, (role, _) in enumerate(turns):
        now = template([*context, *turns[:k + 1]])
        if not now.startswith(last):
            return k
        start = length = 0
        if role == loss_role:
            start, rest = _text_borders(template, [*context, *turns[:k]], role)
            start, length = start - len(last), len(now) - rest - start
        found.append((now[len(last):], start, length))
        last = now
    return found


def locate(template: Template, turns: list[Turn], loss_role: str = "assistant", step: int = STEP) -> tuple[str, list | None, int | None]:
    """(output, spans or None, rewriting turn or None); a span is (start, end, own text's start, its end)."""
    output, spans = template([]), []
    for at in range(0, len(turns), step):
        part = turns[at:at + step]
        whole = template(turns[:at + len(part)])
        # a first stretch, and one whose short context does not reproduce it, come from whole prefixes
        added = _added(template, turns[max(0, at - CONTEXT):at], part, loss_role) if at else 0
        if isinstance(added, int) or not whole.startswith(output) or "".join(a for a, _, _ in added) != whole[len(output):]:
            added = _added(template, turns[:at], part, loss_role)
            if isinstance(added, int):
                return template(turns), None, at + added
        for text, start, length in added:
            base = len(output)
            output += text
            spans.append((base, len(output), base + start, base + start + length))
    return output, spans, None


FORMATTED = ("conv_id long, text string, rewritten_at int, "
             "spans array<struct<role:string,start:long,stop:long,text_start:long,text_stop:long,loss:boolean>>")


def format_conversations(rows: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", loss_role: str = "assistant",
                         step: int = STEP) -> DataFrame:
    """One row per conversation: ``conv_id``, ``text``, ``rewritten_at`` (null when history stands) and ``spans``:
    per turn its role, place, and for turns under the loss mask the place of the text itself.

    Every successive prefix is rendered whole.  For templates known to look at a
    turn's last neighbours only, a larger ``step`` renders whole prefixes that far
    apart and the turns between them after the last two turns alone: linear
    instead of quadratic in the turns, but rewriting that is undone within a step
    is then seen only within two turns."""
    render = template or InstTemplate()
    span = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                               ("text_start", pa.int64()), ("text_stop", pa.int64()), ("loss", pa.bool_())]))

    def done(conv, turns: list[Turn]) -> pa.RecordBatch:
        text, spans, at = locate(render, turns, loss_role, step)
        rows = None if spans is None else [
            {"role": role, "start": a, "stop": b, "text_start": c, "text_stop": d, "loss": role == loss_role}
            for (role, _), (a, b, c, d) in zip(turns, spans)]
        return pa.record_batch([pa.array([conv], pa.int64()), pa.array([text], pa.string()), pa.array([at], pa.int32()),
                                pa.array([rows], span)], names=["conv_id", "text", "rewritten_at", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, begun = None, [], False
        for batch in batches:
            for key, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")]):
                if begun and key != conv:
                    yield done(conv, turns)
                    turns = []
                conv, begun = key, True
                turns.append((role, text))
        if begun:
            yield done(conv, turns)

    kept = rows.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = kept.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return ordered.select("conv", "role", "text").mapInArrow(run, FORMATTED)


def marked_turns(text: str) -> list[Turn]:
    """Turns of an ``InstTemplate`` output, read from its marks alone (``ValueError`` for any other text)."""
    if not text.startswith("<s>"):
        raise ValueError("the text does not begin a conversation")
    at, found = len("<s>"), []
    shapes = (("[INST] ", " [/INST]", "user"), (" ", "</s>", "assistant"), ("[SYS]", "[/SYS]", "system"))
    while at < len(text):
        for head, tail, role in shapes:
            if text.startswith(head, at):
                break
        else:
            named = re.compile(r"\[ROLE ((?:[^\\\]]|\\.)*)\]", re.S).match(text, at)
            if named is None:
                raise ValueError(f"no turn begins at {at}")
            head = named.group(0)
            tail, role = "[/ROLE]", InstTemplate.unescape(head[len("[ROLE "):-1])
        end = text.index(tail, at + len(head))
        found.append((role, InstTemplate.unescape(text[at + len(head):end])))
        at = end + len(tail)
    return found


def read_back(formatted: DataFrame) -> DataFrame:
    """From formatted conversations: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``,
    ``formatted_chars``.  Turns come from the marks in the text, the loss text from the mask.

    A conversation whose history the template rewrote has no mask: its loss
    columns are null.  A text that is no ``InstTemplate`` output has no marks to
    read: ``n_turns`` and ``turns_sha256`` are null.  ``formatted_chars`` is there
    always."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                row: list = [None] * 4
                try:
                    turns = marked_turns(text)
                    row[:2] = len(turns), hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest()
                except ValueError:
                    pass
                if spans is not None:
                    loss = "".join(InstTemplate.unescape(text[s["text_start"]:s["text_stop"]]) for s in spans if s["loss"])
                    row[2:] = len(loss), hashlib.sha256(loss.encode()).hexdigest()
                out.append((*row, len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.record_batch([batch.column(0), *[pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]],
                                  names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "text", "spans").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted_digests(rows: DataFrame) -> DataFrame:
    """Format, store in the shared folder, and read the stored output back."""
    return read_back(materialise(format_conversations(rows), "chat-formatted"))
