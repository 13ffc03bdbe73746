"""Conversation structure repair: the cheapest edits that give a conversation its form."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.staging import WORD, col, stage

#: Costs of the edits: giving a row another role, deleting it, inserting a row; and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows that are solved with a table of their costs; more are divided.
TABLE_ROWS = 256

#: What a row's code is made of: its role's initial (0 s, 1 u, 2 a, 3 another) and its fault.
INITIALS = "sua"
OTHER, BAD, CUT = 3, 4, 8  # BAD: blank or duplicate, CUT: truncated
#: States: nothing yet, after a system row, after a user row, after an assistant row. What may follow, and what may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NEVER = 1 << 60
#: The least cost of finishing from each state: a user row lacks its answer, a system row a question and an answer.
FINISH = (0, 2 * INSERT, INSERT, 0)

Costs = tuple[int, int, int, int]


def steps(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """What can be done with a row in a state: (initial of the edit, cost, state after it), initials in ASCII order."""
    yield "D", DELETE, state
    if not code & BAD:
        cut, initial = TRUNCATED if code & CUT else 0, code & 3
        if initial == OTHER:
            kept = None
        elif initial == 0:
            kept = SYSTEM if state == START else None
        else:
            kept = initial + 1 if NEXT[state] == initial + 1 else None
        if kept is not None:
            yield "K", cut, kept
        yield "R", cut + REROLE, NEXT[state]


#: By code: by state: the edits.
_STEPS = [[tuple(steps(code, s)) for s in STATES] for code in range(16)]


def _before(after: Costs, code: int) -> Costs:
    """Costs from each state before a row on, from those after it. Rows may be inserted before it; two change nothing."""
    row = [min(cost + after[to] for _, cost, to in _STEPS[code][s]) for s in STATES]
    s = [min(row[x], INSERT + row[NEXT[x]], 2 * INSERT + row[NEXT[NEXT[x]]]) for x in STATES]
    return s[0], s[1], s[2], s[3]


def _after(before: Costs, code: int) -> Costs:
    """Costs to each state after a row, from those before it."""
    best = list(before)
    for _ in range(2):
        for s in STATES:
            best[NEXT[s]] = min(best[NEXT[s]], best[s] + INSERT)
    out = [NEVER] * 4
    for s in STATES:
        for _, cost, to in _STEPS[code][s]:
            out[to] = min(out[to], best[s] + cost)
    return out[0], out[1], out[2], out[3]


def backward(codes: Sequence[int], lo: int, hi: int, ends: Costs) -> Costs:
    """The least cost from each state before row ``lo`` on, where ``ends`` says what remains after row ``hi - 1``."""
    for i in range(hi - 1, lo - 1, -1):
        ends = _before(ends, codes[i])
    return ends


def forward(codes: Sequence[int], lo: int, hi: int, state: int) -> Costs:
    """The least cost from ``state`` before row ``lo`` to each state after row ``hi - 1``."""
    costs = [NEVER] * 4
    costs[state] = 0
    now = (costs[0], costs[1], costs[2], costs[3])
    for i in range(lo, hi):
        now = _after(now, codes[i])
    return now


def _least(codes: Sequence[int], lo: int, hi: int, state: int, ends: Costs, out: list[str]) -> int:
    """Append the ASCII-least cheapest edits of a few rows; the state after them."""
    table = [ends]
    for i in range(hi - 1, lo - 1, -1):
        table.append(_before(table[-1], codes[i]))
    for i in range(lo, hi):
        here, after = table[hi - i], table[hi - i - 1]
        while True:
            # each edit has an initial of its own, so the least initial of an optimal edit begins the least audit
            done = next(((e, to) for e, cost, to in _STEPS[codes[i]][state][:1] if cost + after[to] == here[state]), None)
            if done is None and INSERT + here[NEXT[state]] == here[state]:
                out.append("I")
                state = NEXT[state]
                continue
            if done is None:
                done = next((e, to) for e, cost, to in _STEPS[codes[i]][state][1:] if cost + after[to] == here[state])
            out.append(done[0])
            state = done[1]
            break
    return state


def solve(codes: Sequence[int], rows: int = TABLE_ROWS) -> tuple[int, str]:
    """Cost and audit of a conversation's cheapest edits; of equally cheap ones the ASCII-least.

    Divide and conquer after Hirschberg: costs to each of the four states at the middle and costs from each of them on
    meet; states whose sum is least are crossings of optimal paths. Those stay open for the left half, which is solved first and by
    its least edits decides on one; the right half starts there. Rows inserted at the middle belong to the right. Only
    vectors of four costs are kept a level, and a table for at most ``rows`` rows.
    """
    out: list[str] = []

    def part(lo: int, hi: int, state: int, ends: Costs) -> int:
        if hi - lo <= max(1, rows):
            return _least(codes, lo, hi, state, ends, out)
        middle = (lo + hi) // 2
        to, on = forward(codes, lo, middle, state), backward(codes, middle, hi, ends)
        total = min(a + b for a, b in zip(to, on))
        open_ = [b if a + b == total else NEVER for a, b in zip(to, on)]
        state = part(lo, middle, state, (open_[0], open_[1], open_[2], open_[3]))
        return part(middle, hi, state, ends)

    cost = backward(codes, 0, len(codes), FINISH)[START]
    state = part(0, len(codes), START, FINISH)
    out += "I" * (FINISH[state] // INSERT)
    return cost, "".join(out)


@lru_cache(maxsize=50_000)
def _solved(codes: bytes) -> tuple[int, str]:
    """Short conversations repeat the same codes."""
    return solve(codes)


def _named(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, mark``: nulls in role and text are one space; ``mark`` stands for role and text."""
    role, text = (F.coalesce(col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    picked = rows.select(col("conv_id").cast("long").alias("conv_id"), col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    mark = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text")))
    return picked.withColumn("mark", mark)


def _codes(blank: Column, cut: Column) -> Column:
    initial = F.coalesce(F.array_position(F.lit(list(INITIALS)), F.substring("role", 1, 1)) - 1, F.lit(-1))
    initial = F.when(initial < 0, OTHER).otherwise(initial)
    return (initial + F.when(blank, BAD).when(cut, CUT).otherwise(0)).cast("int")


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
#: Neighbours that are legal (su, ua, au), by their initials' codes.
LEGAL = {(0, 1), (1, 2), (2, 1)}


def audit_conversations(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """What is wrong with each conversation of ``rows(conv_id, turn, role, text)``, and the cheapest edits that mend it.

    Rows stand in the order of turn, nulls first; rows of one turn in the order of a digest of role and text, so the result
    does not depend on the layout. A row's first fault counts: blank (nothing but white space), duplicate (role and
    text seen earlier), truncated (the last character but white space ends no sentence). ``gaps`` counts turns that
    are absent between the first and the last, ``illegal`` neighbours whose roles' initials are not su, ua or au.

    Keeping a row costs 0, another role (user or assistant) 3, deleting 4 (blank and duplicate rows have to go), inserting an
    empty user or assistant row 3, and a truncated row that stays 3 more. The initials of what remains read
    ``(s?(ua)+)?``. ``audit`` holds the edits' initials in order, the ASCII-least of the cheapest ones (see :func:`solve`).

    Only codes of rows travel, a few bytes a row; texts do not. First occurrences are an aggregate that combines before the
    shuffle, and a join that adaptive execution can split. A conversation's codes meet in one task, a byte each, as its
    audit is one value.

    Nulls in role and text are one space, an empty role has no legal initial, a null conv_id is a conversation of its own.
    ``known`` names conversations (``conv_id``) that may have no rows: zeros and an empty audit. Other columns are left out.
    """
    named = _named(rows)
    blank = ~F.col("text").rlike(WORD)
    cut = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1).rlike(r"\A[^.!?]")
    light = named.select("conv_id", "turn", "mark", _codes(blank, cut).alias("code"))
    light = stage(light, "repair-codes")
    again = light.groupBy("conv_id", "mark").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = again.select(F.col("conv_id").alias("of"), F.col("mark").alias("like"), F.col("first.turn").alias("first"), F.lit(True).alias("repeated"))
    joined = light.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("like")), "left")
    later = F.coalesce(F.col("repeated"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    each = joined.select("conv_id", "turn", "mark", "code", later.alias("later"))
    if known is not None:
        names = known.select(col("conv_id").cast("long").alias("conv_id")).distinct()
        each = each.unionByName(names.withColumn("code", F.lit(-1)).withColumn("later", F.lit(False)), allowMissingColumns=True)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, held = [], None, None

        def done() -> None:
            codes, turns, faults, illegal = held
            cost, audit = _solved(bytes(codes)) if len(codes) <= 64 else solve(codes)
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            out.append((conv, gaps, *faults, illegal, cost, audit))

        def flushed() -> pa.RecordBatch:
            fields = [f.split() for f in AUDIT.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string()}
            return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*out) if out else [()] * len(fields), fields)], [n for n, _ in fields])

        last = None
        for batch in batches:
            for name, turn, mark, code, later in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "mark", "code", "later"))):
                if held is None or name != conv:
                    if held is not None:
                        done()
                    conv, held, last = name, [bytearray(), [0, 0, 0], [0, 0, 0], 0], None
                if code < 0:
                    continue
                codes, turns, faults, _ = held
                if turn is not None:
                    if not turns[2]:
                        turns[:] = [turn, turn, 1]
                    elif turn != turns[1]:
                        turns[1:] = [turn, turns[2] + 1]
                if code & BAD:
                    faults[0] += 1
                elif later or last == (turn, mark):  # equal rows of one turn stand together
                    faults[1] += 1
                    code = (code & 3) | BAD
                elif code & CUT:
                    faults[2] += 1
                if codes and ((codes[-1] & 3, code & 3) not in LEGAL):
                    held[3] += 1
                codes.append(code)
                last = (turn, mark)
            if len(out) >= 5_000:
                yield flushed()
                out = []
        if held is not None:
            done()
        yield flushed()

    dealt = each.select("conv_id", "turn", "mark", "code", "later").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "mark").mapInArrow(fold, AUDIT)


REPAIRED = "conv_id long, place long, edit string, role string, text string"


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The conversations as their audits edit them: ``conv_id, place, edit, role, text``, one row for each row that remains.

    ``place`` counts the rows of a conversation from 1. Texts move once, to the task that holds their conversation's audit, and pass
    through it in order; none is held. Conversations without an audit are left out, those with nothing left give no row.
    Nulls and ties are as in :func:`audit_conversations`.
    """
    texts = _named(rows).withColumn("audit", F.lit(None).cast("string"))
    heads = audits.select("conv_id", "audit")
    both = texts.unionByName(heads, allowMissingColumns=True)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = audit = None
        at, place, state = 0, 0, START
        out: list[tuple] = []

        def put(kind: str, role: str, text: str) -> None:
            nonlocal place, state
            place += 1
            state = SYSTEM if role[:1] == "s" else USER if role[:1] == "u" else ASSISTANT
            out.append((conv, place, kind, role, text))

        def inserted() -> None:
            nonlocal at
            while audit is not None and at < len(audit) and audit[at] == "I":
                put("I", "user" if NEXT[state] == USER else "assistant", "")
                at += 1

        def flushed() -> pa.RecordBatch:
            columns = zip(*out) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in REPAIRED.split(", ")])

        for batch in batches:
            for name, role, text, told in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit"))):
                if told is not None:
                    inserted()
                    conv, audit, at, place, state = name, told, 0, 0, START
                    continue
                if audit is None or name != conv:
                    continue
                inserted()
                kind = audit[at]
                at += 1
                if kind == "K":
                    put(kind, role, text)
                elif kind == "R":
                    put(kind, "user" if NEXT[state] == USER else "assistant", text)
            yield flushed()
            out = []
        inserted()
        yield flushed()

    dealt = both.select("conv_id", "turn", "mark", "role", "text", "audit").repartition("conv_id")
    order = ("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "mark")
    return dealt.sortWithinPartitions(*order).mapInArrow(edit, REPAIRED)


def digests(edited: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of :func:`repaired` as it comes: SHA-256 of ``role:text`` lines, in lower-case hex."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, names, told = None, None, [], []

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(told, pa.string())], ["conv_id", "repaired_sha256"])

        for batch in batches:
            for name, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 1:
                    if sha is not None:
                        names.append(conv)
                        told.append(sha.hexdigest())
                    conv, sha = name, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield flushed()
            names, told = [], []
        if sha is not None:
            names.append(conv)
            told.append(sha.hexdigest())
        yield flushed()

    return edited.mapInArrow(fold, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults dealt by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes its
    ``[.!?]``, 3 repeats it, 4 makes it a user's. A null is one space."""
    space = F.lit(" ")
    conv, turn = col("conv_id").cast("long"), col("turn").cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    role, text = (F.coalesce(col(c).cast("string"), space) for c in ("role", "text"))
    dealt = rows.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("kind")).where("kind <> 0")
    kind = F.col("kind")
    changed = dealt.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return changed.drop("copy")
