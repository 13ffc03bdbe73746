"""Conversation repair against an enumeration of all edits, and on odd rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import repair
from sluiceway.llm.queries import op12_repair

WHITE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    """(role, text) rows in order: the first fault of each."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def by_enumeration(rows):
    """(cost, audit, repaired lines) by trying every sequence of edits that deleting all rows does not undercut."""
    faults, best = faults_of(rows), None

    def extend(i, audit, cost, kept):
        nonlocal best
        if cost > (best[0] if best else 4 * len(rows)):
            return
        initials = "".join(role[:1] or "?" for role, _ in kept)
        if not re.fullmatch("s?(ua)*u?", initials):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, [f"{role}:{text}" for role, text in kept])
        for role in ("user", "assistant"):
            extend(i, audit + "I", cost + 3, [*kept, (role, "")])
        if i < len(rows):
            extend(i + 1, audit + "D", cost + 4, kept)
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                extend(i + 1, audit + "K", cost + more, [*kept, rows[i]])
                for role in ("user", "assistant"):
                    extend(i + 1, audit + "R", cost + 3 + more, [*kept, (role, rows[i][1])])

    extend(0, "", 0, [])
    return best


def expected(rows):
    """A result row from ``(turn, role, text)`` in order."""
    said = [("" if r is None else r, t) for _, r, t in rows]
    said = [(" " if r is None else r, " " if t is None else t) for _, r, t in rows]
    turns = [t for t, _, _ in rows if t is not None]
    faults = faults_of(said)
    cost, audit, lines = by_enumeration(said)
    initials = [r[:1] for r, _ in said]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def found(spark, rows, names=None):
    schema = "conv_id long, turn long, role string, text string, audit string, mark int, code string"
    frame = rows if not isinstance(rows, list) else spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    audits = repair.audit_conversations(frame, names)
    texts = {r.conv_id: r.repaired_sha256 for r in repair.digests(repair.repaired(frame, audits)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r.conv_id: (*(r[f] for f in fields), texts.get(r.conv_id, nothing)) for r in audits.collect()}


def random_rows(rng, n):
    return [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "unknown"]), rng.choice(["a.", "b", "c!", " \n", "", None, "d?  "])) for _ in range(n)]


def test_least_edits_against_enumeration():
    rng = random.Random(3)
    for _ in range(400):
        rows = [(r or " ", t or " ") for r, t in random_rows(rng, rng.randrange(5))]
        codes = []
        for (role, _), fault in zip(rows, faults_of(rows)):
            initial = repair.INITIALS.find(role[0]) if role[0] in repair.INITIALS else repair.OTHER
            codes.append(initial + (repair.BAD if fault in ("blank", "duplicate") else repair.CUT if fault else 0))
        for size in (1, 2, 256):
            assert repair.solve(codes, size) == by_enumeration(rows)[:2]


def test_dividing_changes_nothing():
    rng = random.Random(4)
    for n in (300, 1000):
        codes = [rng.choice([0, 1, 1, 2, 2, 3, 5, 6, 9, 10]) for _ in range(n)]
        whole = repair.solve(codes, n)
        assert repair.solve(codes, 1) == whole and repair.solve(codes, 7) == whole
        assert whole[0] == repair.forward(codes, 0, n, repair.START)[repair.START] or whole[0] <= 4 * n


def test_conversations_against_enumeration(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for conv in [*range(60), None]:
        turns = sorted(rng.sample(range(9), 4)) if conv != 7 else [None] * 4
        said = random_rows(rng, 4)
        if conv == 7:
            said = [("user", "a.")] * 4
        own = [(t, r, x) for t, (r, x) in zip(turns, said)][: rng.randrange(1, 5)]
        rows += [(conv, *row) for row in own]
        want[conv] = expected(own)
    rng.shuffle(rows)
    assert found(spark, rows) == want


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_ties_do_not_depend_on_the_layout(spark, parts):
    rows = [(1, 3, "user", "a?"), (1, 3, "assistant", "b."), (1, 3, "user", "a?"), (1, None, "system", "c."), (1, 3, None, "x"), (2, 1, "user", "q?")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    first = found(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1))
    assert found(spark, frame) == first and first[1][2] == 1


def test_odd_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert found(spark, empty) == {}
    names = spark.createDataFrame([(5, "x"), (5, "y"), (None, "z")], "conv_id long, turn string")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(spark, empty, names) == {5: nothing, None: nothing}
    # a long conversation, and a very long text
    many = [(1, i, ("user", "assistant")[i % 2], f"{i}.") for i in range(3_000)] + [(2, 0, "user", "long " * 100_000 + "?"), (2, 1, "assistant", "yes.")]
    got = found(spark, many)
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "K" * 3_000)
    assert got[2][5:] == (0, "KK", hashlib.sha256(f"user:{'long ' * 100_000}?\nassistant:yes.".encode()).hexdigest())


def test_a_conversation_of_one_repeated_row(spark):
    rows = [(1, i, "user", "same.") for i in range(5_000)] + [(2, 0, "user", "a?"), (2, 1, "assistant", "b.")]
    got = found(spark, rows)
    assert got[1][:7] == (0, 0, 4_999, 0, 4_999, 4 + 4 * 4_999 - 1, "D" * 0 + got[1][6]) and sorted(set(got[1][6])) == ["D", "I", "K"]
    assert got[2][5:7] == (0, "KK")


def test_damage(spark):
    rows = [(c, t, "assistant", "Yes. No! a?") for c in range(40) for t in (0, 1, None)] + [(None, 1, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(repr, (tuple(r) for r in repair.damaged(frame).collect()))) == sorted(map(repr, want))


def test_query_has_every_conversation(spark, tmp_path):
    said = [(1, 0, "user", "a?"), (2, 0, "user", None), (None, None, None, None)]
    spark.createDataFrame(said, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = op12_repair(spark, str(tmp_path))
    assert sorted(got.select(F.coalesce("conv_id", F.lit(-1))).toPandas().iloc[:, 0]) == [-1, 1, 2]
