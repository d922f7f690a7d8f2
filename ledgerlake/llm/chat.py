r"""Chat formatting by incremental black-box rendering.

A template is a function from a list of ``(role, text)`` messages to one
string; nothing else is known about it. The successive turn prefixes of a
conversation are rendered and consecutive outputs compared: if output i
starts with output i-1, turn i is what was added; if not, the template
rewrites history and the turn is flagged. Inside a turn's span the text is
found by rendering the turn again with a sentinel as its text: what stands
before and after the sentinel is the turn's frame, the rest its body. The
loss mask covers the bodies of assistant turns.

Unless told otherwise, every prefix is rendered whole: exact for any template,
with the whole conversation in memory and work that grows with its square. A
caller who knows that a template never looks further back than ``reach`` turns
(what it writes for a turn, and what a new turn makes it rewrite, depends on so
many turns before) says so: then prefixes start ``reach`` turns before the one
in hand, work is linear and memory holds a few turns. The turn template has a
reach of one.

The turn template writes ``### role: text</turn>\n``. Backslashes, a ``#``
after a ``#`` and a ``/`` after a ``<`` inside roles and texts get a backslash
before them (in roles a ``:`` as well), so neither ``###`` nor ``</turn>`` can
stand in a text, and taking the backslashes off gives the text back.

Cases: null text or role is empty; rows are ordered by turn, role and text
(nulls first), repeated rows are turns of their own; an empty table gives no
rows; null conv_id is a conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Message = tuple[str, str]
Template = Callable[[list[Message]], str]

SENTINEL = "\ue000\ue001\ue000"
#: Turns that are rendered together where the reach is known.
WINDOW = 64
#: The reach of :func:`turn_template`.
TURN_REACH = 1
SPANS = (
    "conv_id long, turn_no long, role string, start long, body_start long, body_end long, end long, "
    "loss boolean, rewrites_history boolean, rendered string"
)
_ESCAPED = re.compile(r"\\|(?<=#)#|(?<=<)/")
_ESCAPED_ROLE = re.compile(r"[\\:]|(?<=#)#|(?<=<)/")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn_template(messages: list[Message]) -> str:
    parts = []
    for role, text in messages:
        role = _ESCAPED_ROLE.sub(r"\\\g<0>", role)
        parts.append(f"### {role}: {escape(text)}</turn>\n")
    return "".join(parts)


def read_turn(rendered: str) -> Message:
    """Role and text of one rendered turn of :func:`turn_template`."""
    found = _TURN.fullmatch(rendered)
    if found is None:
        raise ValueError("not a turn of this template")
    return unescape(found[1]), unescape(found[2])


def locate_turns(render: Template, messages: list[Message], first: int = 0) -> Iterator[tuple[str, int, int, bool]]:
    """For each message from ``first`` on: its rendered span, the places of its
    body in that span, and whether adding it rewrote what stood before."""
    before = render(messages[:first])
    for i in range(first, len(messages)):
        role, _ = messages[i]
        now = render(messages[: i + 1])
        rewrites = not now.startswith(before)
        span = "" if rewrites else now[len(before) :]
        probe = render([*messages[:i], (role, SENTINEL)])[len(before) :]
        head, mark, tail = probe.partition(SENTINEL)
        framed = bool(mark) and span.startswith(head) and span.endswith(tail) and len(span) >= len(head) + len(tail)
        if not framed:
            rewrites = True
        yield span, len(head) if framed else 0, len(span) - len(tail) if framed else 0, rewrites
        before = now


def _conversations(batches: Iterator[pa.RecordBatch], keys: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Consecutive rows with one key, as streams."""
    from itertools import groupby

    def rows():
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                yield from batch.slice(start, 512).to_pylist()

    yield from groupby(rows(), key=lambda r: r[keys])


def _render(batches: Iterator[pa.RecordBatch], render: Template, reach: int | None) -> Iterator[pa.RecordBatch]:
    fields = ("conv_id", "turn_no", "role", "start", "body_start", "body_end", "end", "loss", "rewrites_history", "rendered")
    types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.bool_(), pa.bool_(), pa.string()]
    schema = pa.schema(list(zip(fields, types)))
    out, size = [], 0
    for conv, rows in _conversations(batches, "conv_id"):
        context: list[Message] = []
        turn = at = 0
        pending: list[Message] = []

        def located():
            nonlocal turn, at, context
            messages = context + pending
            for (span, head, tail, rewrites), (role, _) in zip(locate_turns(render, messages, len(context)), pending):
                yield (conv, turn, role, at, at + head, at + tail, at + len(span), role == "assistant", rewrites, span)
                turn, at = turn + 1, at + len(span)
            context = messages[-reach:] if reach else []

        for row in rows:
            pending.append((row["role"] or "", row["text"] or ""))
            if reach is not None and len(pending) == WINDOW:
                for x in located():
                    out.append(x)
                    size += len(x[-1])
                pending = []
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)
                    out, size = [], 0
        for x in located():
            out.append(x)
            size += len(x[-1])
        if size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)


def format_conversations(
    conversations: DataFrame, render: Template = turn_template, reach: int | None = None
) -> DataFrame:
    """One row per turn, in order within a task: its span, its body's places and its rendered text.

    A conversation's formatted text is its ``rendered`` strings joined in the
    order of ``turn_no``; ``start`` to ``end`` count code points in it. One
    task streams a conversation in order; with a ``reach`` (turns that the
    template looks back) no conversation is ever held whole.
    """
    if reach is None and render is turn_template:
        reach = TURN_REACH
    if reach is not None and reach < 0:
        raise ValueError("reach counts turns")
    ordered = (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.mapInArrow(lambda batches: _render(batches, render, reach), SPANS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for conv, rows in _conversations(batches, "conv_id"):
        turns = loss = chars = 0
        rewrites = False
        all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
        for row in rows:
            role, text = read_turn(row["rendered"])
            all_turns.update(f"{role}\n{text}\n".encode())
            if row["loss"]:
                start = row["start"]
                body = unescape(row["rendered"][row["body_start"] - start : row["body_end"] - start])
                all_loss.update(body.encode())
                loss += len(body)
            turns, chars = turns + 1, chars + len(row["rendered"])
            rewrites |= row["rewrites_history"]
        out.append((conv, turns, all_turns.hexdigest(), loss, all_loss.hexdigest(), chars, rewrites))
        if len(out) == 4096:
            yield _digest_batch(out)
            out = []
    if out:
        yield _digest_batch(out)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))


def digest_formatted(spans: DataFrame) -> DataFrame:
    """Read the formatted turns back: one row per conversation.

    The spans of a conversation must be in one task in order, as
    :func:`format_conversations` returns them.
    """
    return spans.mapInArrow(
        _digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites_history boolean",
    )


def with_probe_conversation(conversations: DataFrame) -> DataFrame:
    """Add conversation -7, whose two texts are control strings themselves."""
    said = r"\### Assistant: </turn> ok"
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).unionByName(probe)
