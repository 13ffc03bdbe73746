"""Chat formatting from event logs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.staging import col

#: What marks turns.
BEGIN = "<s>"
USER = ("[INST] ", " [/INST]")
OTHER = ("[SYS ", "] ", " [/SYS]")
ASSISTANT_END = " </s>"

_CONTROL = re.compile(r"[\\<\[\]]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

EVENTS = "conv_id, seq, message_id, part, event, role, text"
FORMATTED = "conv_id long, formatted string, loss array<struct<start:long,length:long>>"


def escape(text: str) -> str:
    """Put a backslash before each backslash, angle and square bracket, so that no mark stands inside a text."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation as text, and where in it the assistant's texts stand (start, length)."""
    parts, at, loss = [BEGIN], len(BEGIN), []
    for role, text in messages:
        body = escape(text)
        if role == "assistant":
            loss.append((at, len(body)))
            turn = body + ASSISTANT_END
        elif role == "user":
            turn = USER[0] + body + USER[1]
        else:
            turn = OTHER[0] + escape(role) + OTHER[1] + body + OTHER[2]
        parts.append(turn)
        at += len(turn)
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages of a rendered text. A mark's bracket never follows a backslash, a text's always does."""
    if not formatted.startswith(BEGIN):
        raise ValueError("not a formatted conversation")
    at, out = len(BEGIN), []
    while at < len(formatted):
        if formatted.startswith(USER[0], at):
            role, at, mark = "user", at + len(USER[0]), USER[1]
        elif formatted.startswith(OTHER[0], at):
            at += len(OTHER[0])
            end = re.compile(r"(?:[^\\\]]|\\.)*", re.DOTALL).match(formatted, at).end()
            role, at, mark = unescape(formatted[at:end]), end + len(OTHER[1]), OTHER[2]
        else:
            role, mark = "assistant", ASSISTANT_END
        end = formatted.index(mark, at)
        out.append((role, unescape(formatted[at:end])))
        at = end + len(mark)
    return out


class Conversation:
    """Folds events, in order, into messages.

    ``start`` begins a message with a role, and a text if it has one. ``delta`` adds text to a message. ``edit`` puts
    another text in a message's place. ``regenerate`` empties a message and takes away those begun after it; deltas then
    fill it anew. An event that names no known message concerns the last one begun, and is passed over if there is none.
    """

    def __init__(self) -> None:
        self.messages: dict[object, tuple[str, list[str]]] = {}
        self.last: object = None

    def add(self, event: str | None, message: object, role: str | None, text: str | None) -> None:
        if event == "start":
            key = message if message is not None and message not in self.messages else object()
            self.messages[key] = (role or "", [text] if text else [])
            self.last = key
            return
        key = message if message in self.messages else self.last
        if key not in self.messages:
            return
        role_known, parts = self.messages[key]
        if event == "delta":
            if text:
                parts.append(text)
        elif event == "edit":
            parts[:] = [text or ""]
        elif event == "regenerate":
            parts.clear()
            order = list(self.messages)
            for later in order[order.index(key) + 1 :]:
                del self.messages[later]
            self.last = key
        elif event is not None:
            raise ValueError(f"unknown event {event!r}")

    def final(self) -> list[tuple[str, str]]:
        return [(role, "".join(parts)) for role, parts in self.messages.values()]


def format_conversations(events: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss`` from ``events(conv_id, seq, message_id, part, event, role, text)``.

    Events are dealt by conversation, sorted by seq, message (or a column ``tie``, if there is one) and part, and folded as
    they pass (see :class:`Conversation`); a task holds one conversation, which is one row of the result. ``formatted`` marks turns and escapes control
    strings in texts; :func:`parse` gives the messages back. ``loss`` has a span for each assistant text.

    Null role: an empty role. Null text: empty. Null conv_id: one conversation of its own. Null seq sorts first. Null
    event: passed over. Repeated events apply again. A conversation of no messages is the begin mark alone. No rows: no rows. Other columns
    are left out.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, state, done, held = None, None, [], 0

        def out() -> pa.RecordBatch:
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            loss = [[{"start": a, "length": n} for a, n in spans] for _, _, spans in done]
            return pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string()), pa.array(loss, span)],
                ["conv_id", "formatted", "loss"],
            )

        for batch in batches:
            for conv, message, event, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "message_id", "event", "role", "text")]):
                if state is None or conv != known:
                    if state is not None:
                        done.append((known, *render(state.final())))
                        held += len(done[-1][1])
                        if held > 8_000_000:
                            yield out()
                            done, held = [], 0
                    known, state = conv, Conversation()
                state.add(event, message, role, text)
        if state is not None:
            done.append((known, *render(state.final())))
        if done:
            yield out()

    tie = "tie" if any(c.lower() == "tie" for c in events.columns) else "message_id"
    picked = events.select(*[col(n).alias(n) for n in EVENTS.split(", ")], col(tie).alias("__tie"))
    dealt = picked.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "__tie", "part", "message_id")
    return dealt.mapInArrow(fold, FORMATTED)


#: What a turn's log holds before its text is right, by a hash of conversation and turn.
DRAFT = "~ draft [INST] ~"


def turn_events(turns: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` as a log of what may have led to them.

    By a hash of conversation and turn a message is streamed in two deltas as it is; or begun wrongly and edited; or streamed
    wrongly, regenerated and streamed anew; or answered by a message of its own, which goes when it is regenerated. Only
    a fold that applies edits and regenerations gives the turns back.

    Turns stand in the order of ``turn``, nulls first; those of one turn in the order of a digest of role and text, so
    the layout does not matter; wholly equal rows are messages of their own. Null role or text: empty. Other columns
    are left out, no rows give no events.
    """
    text, role = F.coalesce(col("text"), F.lit("")), F.coalesce(col("role"), F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    first, second = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.char_length(text))
    null = F.lit(None).cast("string")
    of = F.concat(F.md5(F.concat(role, F.lit("\n"), text)), F.lit("-"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))

    def log(*steps: tuple[str, Column, Column, str]) -> Column:
        """Events ``(event, role, text, message)`` in order; the message is the turn's own, or one that follows from it."""
        return F.array(
            *[
                F.struct(F.concat(of, F.lit(m)).alias("message_id"), F.lit(i).alias("part"), F.lit(e).alias("event"), r.alias("role"), t.alias("text"))
                for i, (e, r, t, m) in enumerate(steps)
            ]
        )

    start, draft = ("start", role, null, ""), ("delta", null, F.lit(DRAFT), "")
    streamed = (("delta", null, first, ""), ("delta", null, second, ""))
    answered = (("start", F.lit("assistant"), F.lit(DRAFT), "+"), ("delta", null, F.lit(DRAFT), "+"))
    again = ("regenerate", null, null, "")
    kind = F.pmod(F.xxhash64(col("conv_id"), col("turn")), F.lit(4))
    steps = (
        F.when(kind == 1, log(start, draft, ("edit", null, text, "")))
        .when(kind == 2, log(start, draft, again, *streamed))
        .when(kind == 3, log(start, draft, *answered, again, *streamed))
        .otherwise(log(start, *streamed))
    )
    rows = turns.select(col("conv_id").cast("long").alias("conv_id"), col("turn").cast("long").alias("seq"), of.alias("of"), F.inline(steps))
    return rows.select(*EVENTS.split(", "), F.col("of").alias("tie"))  # a message that follows from another one sorts with it


def digests(formatted: DataFrame) -> DataFrame:
    """What :func:`format_conversations` wrote, read back: turns, loss text and length, with their SHA-256.

    A conversation without messages has no turns and the digests of an empty text. No rows: no rows. Other columns are left out.
    """
    import hashlib

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, loss in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss")]):
                turns = parse(text)
                told = hashlib.sha256("".join(f"{role}\n{body}\n" for role, body in turns).encode()).hexdigest()
                learned = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in loss)
                rows.append((conv, len(turns), told, len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
