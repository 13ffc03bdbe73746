"""Operators against brute force, and on nulls, empty and long texts, ties, repeated rows, no rows and odd columns."""

import collections
import hashlib
import itertools
import math
import pathlib
import random
import textwrap
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import chat, warc
from sluiceway.llm.ann import nearest_neighbours
from sluiceway.llm.decontaminate import decontaminate, find_leaks, nearest
from sluiceway.llm.licenses import scan_licenses
from sluiceway.llm.line_dedup import dedup_lines
from sluiceway.llm.maxent import score_texts
from sluiceway.llm.mixing import mix
from sluiceway.llm.ngram_join import jaccard_components, jaccard_join, one_of_each
from sluiceway.llm.quality import score_quality
from sluiceway.llm.queries import LINES_SQL, ORACLES
from sluiceway.session import scratch_path

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, source string, size string, __uid int, node string"


def docs(spark, rows):
    """Rows of id, text and source, with columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, "size", 1, "node") for r in rows], DOCS)


ODD = [
    (1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, None, None), (3, "", "x"), (None, "a b c d e f", "y"), (4, " \n\t ", None),
    (5, "é ß \U0001f600 " * 3, "é"), (6, "word " * 60_000, "x"), (None, None, None), (7, "A B C D E F", "y"),
]


def test_mix_keeps_rows_and_comes_near_targets(spark):
    rows = mix(docs(spark, ODD)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {r.doc_id: r.size for r in rows if r.doc_id in (2, 3, 4, 6)} == {2: 0, 3: 0, 4: 0, 6: 60_000}
    assert mix(docs(spark, [])).collect() == []
    many = docs(spark, [(i, "w " * (1 + i % 9), "ab"[i % 2] if i % 3 else None) for i in range(3000)])
    for r in mix(many).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 9


def test_a_smaller_mix_is_part_of_a_larger(spark):
    many = docs(spark, [(i, "w " * (1 + i % 9), "a") for i in range(500)])
    small = {r.doc_id for r in mix(many, share=0.3).collect() if r.taken}
    large = {r.doc_id for r in mix(many, share=0.6).collect() if r.taken}
    assert small < large


def components_by_hand(rows, width, share):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = len(words)
        sets[i] = {tuple(words[k : k + width]) for k in range(n - width + 1)} if n >= width else {tuple(words)} - {()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= share * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("width, share", [(3, 90), (5, 80)])
def test_join_finds_every_link(spark, width, share):
    rng = random.Random(width)
    rows = []
    for group in range(12):
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 4) for _ in range(rng.choice([4, 12, 40, 150, 400]))]
        for _ in range(rng.randint(2, 14)):  # near copies on both sides of the share
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(["new", "other", "words"]) + str(rng.random())
            rows.append((len(rows), " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, [(*r, "s") for r in rows]), width, share).collect()}
    want = components_by_hand(rows, width, share)
    assert got == want
    kept = one_of_each(docs(spark, [(*r, "s") for r in rows]), width, share)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_join_of_near_copies_around_the_threshold(spark):
    """A large group most of whose pairs lie just under the share: the links that there are have to be found."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            words[rng.randrange(60)] = rng.choice([f"x{rng.randrange(6)}", f"own{i}"])
        rows.append((i, " ".join(words)))
    want = components_by_hand(rows, 3, 90)
    assert 5 < len({c for _, c in want.values()}) < 150
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def test_join_refuses_a_share_it_cannot_keep(spark):
    rows = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for share in (0, 40, 49, 101):
        with pytest.raises(ValueError, match="50 to 100"):
            jaccard_components(rows, 3, share)


@pytest.mark.parametrize("share", [50, 60])
def test_join_at_small_shares(spark, share):
    rng = random.Random(share)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(rng.choice(words[: 3 + i % 9]) for _ in range(rng.randrange(4, 24)))) for i in range(80)]
    rows += [(100 + i, " ".join([*(f"z{j}" for j in range(17 + i)), *(f"q{i}{j}" for j in range(10))])) for i in range(6)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, share)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == components_by_hand(rows, 1, share)


def test_join_counts_every_token(spark):
    """The order of a set's tokens comes from counts of all of them: two texts share these, the third has its own."""
    from sluiceway.llm import ngram_join
    from sluiceway.llm.textops import shingle_sets

    shared, alone = (" ".join(f"{x}{i}" for i in range(400)) for x in ("both", "own"))
    texts = spark.createDataFrame([(shared + " a",), (shared + " b",), (alone,)], "text string").repartition(3)
    several, many = (np.frombuffer(f, np.uint8) for f in ngram_join.token_filters(texts, 3))
    bands = [ngram_join.ordered(s, several, many) >> np.uint64(62) for _, s in shingle_sets(pa.array([shared, alone]), 3)]
    assert (bands[0] == 2).all() and (bands[1] == 0).mean() > 0.98


def test_join_bounds_of_open_sets(spark):
    """Marks never allow less than what two sets share, and tell large sets apart."""
    from sluiceway.llm import ngram_join

    rng = np.random.default_rng(5)
    pool = rng.integers(1, 1 << 62, 700)
    sets = [np.unique(rng.choice(pool, n)) for n in (3, 80, 300, 300, 600, 600)]
    rows = ngram_join._common(spark.createDataFrame([(k, bytearray(t.tobytes())) for k, t in enumerate(sets)], "node long, tokens binary")).collect()
    marks = {r["node"]: [r[f"m{k}"] % (1 << 64) for k in range(ngram_join.MARKS)] for r in rows}
    for a, b in itertools.permutations(range(len(sets)), 2):
        lacking = sum((x & ~y).bit_count() for x, y in zip(marks[a], marks[b]))
        assert len(np.intersect1d(sets[a], sets[b])) <= len(sets[a]) - lacking
        assert lacking > 0 or min(len(sets[a]), len(sets[b])) < 200


def test_join_on_odd_rows(spark):
    found = jaccard_join(docs(spark, ODD)).collect()
    assert len(found) == len(ODD)
    assert {r.component_id for r in found if r.text and r.text.lower().startswith("a b")} == {1}
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id for r in found if r.doc_id in (2, 3, 4))
    kept = one_of_each(docs(spark, ODD)).collect()
    assert collections.Counter(r.doc_id for r in kept) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, None: 1}
    assert jaccard_join(docs(spark, [])).collect() == []


def test_licenses(spark):
    found = scan_licenses(docs(spark, [*ODD, (8, "intro\nreleased under THE mit-license!\nmore", "x")])).collect()
    # the line is the notice; the whole text has two bigrams more: 2 * 4 / (6 + 4)
    assert sorted((r.doc_id, r.unit, r.unit_no, r.license, r.dice) for r in found) == [(8, "line", 2, "MIT notice", 1.0), (8, "text", 0, "MIT notice", 0.8)]
    assert scan_licenses(docs(spark, [])).collect() == []


def test_each_license_is_found_within_a_longer_text(spark):
    from sluiceway.llm.licenses import TEMPLATES, bigrams_of
    rows = []
    for i, (name, text) in enumerate(TEMPLATES.items()):
        wrapped = "\n\n".join("\n".join(textwrap.wrap(part, 72)) if "\n\n" in text else part for part in text.split("\n\n"))
        rows.append((i, f"Some words before it.\nAnd more of them in a second line.\n\nCopyright (c) 2020 Somebody\n\n{wrapped}\n\nThe story goes on here\nfor a while.", "x"))
    found = scan_licenses(docs(spark, rows)).collect()
    for i, name in enumerate(TEMPLATES):
        best = max((r for r in found if r.doc_id == i), key=lambda r: r.dice)
        assert best.dice > 0.99 and name in {r.license for r in found if r.doc_id == i and r.dice > 0.99}, name
    # the SQL twin on the same texts
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    want = duck.execute(ORACLES["op3_licenses"]).fetchall()
    assert sorted((r.doc_id, r.unit, r.unit_no, r.license, r.shared, r.unit_bigrams, r.template_bigrams) for r in found) == sorted(r[:7] for r in want)
    assert all(bigrams_of(t) for t in TEMPLATES.values())


def edits(item, text):
    """The least edit distance of an item to any substring, by the full matrix."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row = row, [0]
        for i, x in enumerate(item, 1):
            row.append(min(last[i - 1] + (x != c), last[i] + 1, row[i - 1] + 1))
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(3)
    for _ in range(500):
        item, text = ("".join(rng.choice("ab") for _ in range(rng.randint(a, 12))) for a in (1, 0))
        want = edits(item, text)
        found = nearest(item, text, len(item) - 1)
        assert (found is None) if want >= len(item) else found[0] == want


def test_leaks_against_the_full_matrix(spark):
    rng = random.Random(4)
    items = [(i, "".join(rng.choice("abcdef gh") for _ in range(rng.randint(20, 80)))) for i in range(5)]
    rows = []
    for k in range(30):
        text = list(items[k % 5][1].upper() if k % 2 else items[k % 5][1])
        for _ in range(k % 6):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["x", ""])
        rows.append((k, "before  " + "".join(text) + "\nafter", "s"))
    bench = spark.createDataFrame([*items, (9, None), (10, " ")], "item_id long, text string")
    squeeze = lambda t: " ".join(t.lower().split())
    want = {
        (d, i): e for d, t, _ in rows for i, x in items if (e := edits(squeeze(x), squeeze(t))) <= len(squeeze(x)) // 15
    }
    assert {(r.doc_id, r.item_id): r.distance for r in find_leaks(docs(spark, rows), bench, block_chars=100).collect()} == want
    clean = {r.doc_id for r in decontaminate(docs(spark, rows), bench).collect()}
    assert clean == {d for d, _, _ in rows} - {d for d, _ in want}
    assert len(decontaminate(docs(spark, ODD), bench).collect()) == len(ODD)
    assert find_leaks(docs(spark, ODD), bench.limit(0)).collect() == []


def test_lines(spark):
    long = "one two three four five six seven eight nine ten " * 6
    rows = [(1, f"a\n{long}\nb", "x"), (2, f"c\n{long}\nd", "x"), (3, long, "x"), (4, "a\nb", "x")]
    found = {r.doc_id: (r.text, r.lines_removed) for r in dedup_lines(docs(spark, rows)).collect()}
    assert found == {1: (rows[0][1], 0), 2: ("c\nd", 1), 3: ("", 1), 4: ("a\nb", 0)}
    odd = dedup_lines(docs(spark, ODD))
    assert odd.columns == ["doc_id", "text", "source", "size", "node", "lines_removed"]
    assert len(odd.collect()) == len(ODD)
    assert {r.doc_id: r.text for r in odd.collect() if r.doc_id in (2, 3, 4)} == {2: None, 3: "", 4: " \n\t "}
    assert dedup_lines(docs(spark, [])).collect() == []


def test_lines_of_a_passage_with_blank_lines(spark):
    words = [f"w{i}" for i in range(120)]
    paragraphs = [" ".join(words[i : i + 40]) for i in (0, 40, 80)]
    passage = "\n\n".join(paragraphs[:2]) + "\n \n\n" + paragraphs[2]
    rows = [(1, passage, "x"), (2, f"some\n\n{passage}\n\nother", "x"), (3, f"{paragraphs[0]}\n\nown words\n\n{paragraphs[1]}", "x")]
    found = {r.doc_id: (r.text, r.lines_removed) for r in dedup_lines(docs(spark, rows)).collect()}
    assert found == {1: (passage, 0), 2: ("some\n\n\nother", 6), 3: (rows[2][1], 0)}


def plain_line_spans(texts, least=50, long_line=8):
    """The lines that go, by a plain program: repeated chunks, and equal lines beside them and the copy that stays."""
    cut, heads = [], {}
    for u, text in enumerate(texts):
        lines = text.split("\n")
        w = [len(x.split()) for x in lines]
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        last = len(lines) - 1
        ends = [i for i in range(last + 1) if i == last or max(w[i], w[i + 1]) >= long_line or (h[i] * 31 + (h[i - 1] if i else 0)) % 2 == 0]
        chunks = list(zip([0, *(e + 1 for e in ends)], ends))
        cut.append((lines, w, chunks))
        for a, b in chunks:
            heads.setdefault("\n".join(lines[a : b + 1]), (u, a, b))
    for u, (lines, w, chunks) in enumerate(cut):
        spans = []
        for a, b in chunks:
            head, a2, b2 = heads["\n".join(lines[a : b + 1])]
            if (head, a2) == (u, a) or not sum(w[a : b + 1]):
                continue
            own, other = [i for i in range(len(lines)) if w[i]], [i for i in range(len(cut[head][0])) if cut[head][1][i]]
            for mine, theirs in (
                ([i for i in reversed(own) if i < a], [i for i in reversed(other) if i < a2]), ([i for i in own if i > b], [i for i in other if i > b2])
            ):
                words = 0
                for i, j in zip(mine, theirs):
                    if words >= least or lines[i] != cut[head][0][j]:
                        break
                    words += w[i]
                    spans.append((i, i))
            spans.append((a, b))
        runs = []
        for a, b in sorted(spans):
            if runs and not sum(w[runs[-1][1] + 1 : a]):
                runs[-1][1] = max(b, runs[-1][1])
            else:
                runs.append([a, b])
        yield {i for a, b in runs if sum(w[a : b + 1]) >= least for i in range(a, b + 1)}


def test_lines_of_a_passage_in_short_lines(spark):
    fresh = (f"w{i}" for i in itertools.count())
    pick = random.Random(3)
    texts, passages = [], []
    for k in range(60):
        n, size, blank = pick.choice([(9, 6), (10, 6), (12, 6), (10, 7), (30, 3)]) + (pick.random() < 0.3,)
        passage = [" ".join(next(fresh) for _ in range(size)) for _ in range(n)]
        passages.append(passage)
        for copy in range(3):
            around = [["Thanks."] * (k % 3) + [" ".join(next(fresh) for _ in range(size)) for _ in range(3)] for _ in range(2)]
            texts.append("\n".join([*around[0], *("\n\n" if blank and copy else "\n").join(passage).split("\n"), *around[1]]))
    texts += ["\n".join(pick.choice(["a b c", "d e f g", "", "h i", "j k l m n o"]) for _ in range(40)) for _ in range(20)]
    found = {r.doc_id: (r.text, r.lines_removed) for r in dedup_lines(docs(spark, [(i, t, "x") for i, t in enumerate(texts)])).collect()}
    for i, gone in enumerate(plain_line_spans(texts)):
        assert found[i] == ("\n".join(x for j, x in enumerate(texts[i].split("\n")) if j not in gone), len(gone))
    duck = duckdb.connect()  # the SQL twin on the same texts
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert {i: (t, n) for i, t, n in duck.execute(LINES_SQL).fetchall()} == found
    whole = [not set(p) & set(found[3 * k + c][0].split("\n")) for k, p in enumerate(passages) for c in (1, 2)]
    assert sum(whole) >= 0.9 * len(whole)


EVENTS = "conv_id long, seq long, message_id long, part int, event string, role string, text string"


def test_events_fold(spark):
    rows = [
        (1, 1, 1, 0, "start", "user", "hi"), (1, 2, 2, 0, "start", "assistant", None), (1, 3, 2, 0, "delta", None, "no"),
        (1, 4, 2, 0, "regenerate", None, None), (1, 5, 2, 0, "delta", None, "y"), (1, 6, 2, 0, "delta", None, "es</s>\\"),
        (1, 7, 1, 0, "edit", None, "[INST]"), (2, 1, 1, 0, "delta", None, "lost"), (None, None, None, None, "start", None, None),
        (3, 1, None, 0, "start", "to]ol", "x"), (3, 2, None, 0, None, None, None),
    ]
    found = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, EVENTS)).collect()}
    assert chat.parse(found[1].formatted) == [("user", "[INST]"), ("assistant", "yes</s>\\")]
    span = found[1].loss[0]
    assert chat.unescape(found[1].formatted[span["start"] : span["start"] + span["length"]]) == "yes</s>\\"
    assert chat.parse(found[2].formatted) == [] and chat.parse(found[None].formatted) == [("", "")]
    assert chat.parse(found[3].formatted) == [("to]ol", "x")]
    assert chat.format_conversations(spark.createDataFrame([], EVENTS)).collect() == []


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_tied_turns_do_not_depend_on_the_layout(spark, parts):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c"), (1, 0, "user", "a"), (1, None, "system", "s"), (2, 1, None, None)]
    turns = spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, tie string, seq int")
    found = {r.conv_id: r for r in chat.digests(chat.format_conversations(chat.turn_events(turns.repartition(parts)))).collect()}
    order = sorted(rows[:4], key=lambda r: hashlib.md5(f"{r[2]}\n{r[3]}".encode()).hexdigest())
    told = "".join(f"{r}\n{t}\n" for _, _, r, t in [rows[4], *order])
    assert (found[1].n_turns, found[1].turns_sha256) == (5, hashlib.sha256(told.encode()).hexdigest())
    assert (found[2].n_turns, found[2].turns_sha256) == (1, hashlib.sha256(b"\n\n").hexdigest())


def test_a_log_with_drafts_gives_the_turns_back(spark):
    turns = spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"said {c} {t} " * (t + 1)) for c in range(40) for t in range(6)], "conv_id long, turn long, role string, text string")
    events = chat.turn_events(turns)
    kinds = {r.event: r["count"] for r in events.groupBy("event").count().collect()}
    assert kinds["edit"] > 30 and kinds["regenerate"] > 60 and events.where(F.col("text") == chat.DRAFT).count() > 150
    for r in chat.format_conversations(events.repartition(3)).collect():
        assert chat.parse(r.formatted) == [(("user", "assistant")[t % 2], f"said {r.conv_id} {t} " * (t + 1)) for t in range(6)]
    assert chat.digests(chat.format_conversations(chat.turn_events(turns.limit(0)))).collect() == []


def test_long_and_repeated_events(spark):
    rows = [(1, 1, "m", 0, "start", "user", "é " * 200_000, "x")] + [(1, 2, "m", 0, "delta", None, "!", "x")] * 2 + [(1, 3, "n", 0, "start", "assistant", None, "y")] * 2
    events = spark.createDataFrame(rows, "conv_id long, seq long, message_id string, part int, event string, role string, text string, formatted string")
    [found] = chat.format_conversations(events).collect()
    assert chat.parse(found.formatted) == [("user", "é " * 200_000 + "!!"), ("assistant", ""), ("assistant", "")]


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in rows.collect()}
    odd = [(9001, None), (9002, []), (9003, [0.0] * 64), (9004, [float("nan")] * 64), (9005, [None] * 64), (9006, [1.0]), (9008, [float("inf")] * 64)]
    copies = [(10_000 + i, [float(x) for x in vectors[0]]) for i in range(50)]
    everything = rows.union(spark.createDataFrame(odd + copies, rows.schema))
    vectors |= {i: np.array(v) for i, v in copies}
    asked = everything.where("vec_id % 20 = 0")
    found = collections.defaultdict(list)
    for r in nearest_neighbours(everything, asked, 20, sample_rows=200).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = wanted = 0
    for q, got in found.items():
        best = sorted(((-float(vectors[q] @ v), i) for i, v in vectors.items() if i != q))[:20]
        assert len(got) == len({i for i, _ in got}) == 20
        assert all(abs(s - float(vectors[q] @ vectors[i])) < 1e-12 for i, s in got)
        wanted += 20
        hits += len({i for i, _ in got} & {i for _, i in best})
    assert set(found) == {i for i in vectors if i % 20 == 0} and hits >= 0.9 * wanted
    assert [i for i, _ in found[0]] == [10_000 + i for i in range(20)]
    assert nearest_neighbours(everything.limit(0), asked).collect() == []


def unit_rows(spark, n, width=8):
    """Rows of short random vectors, of which every third is the same unit vector; and the id of each."""
    few = np.random.default_rng(1).normal(size=(n, width))
    few *= 0.9 / np.sqrt((few * few).sum(1)).max()
    few[::3] = np.eye(width)[2]
    return spark.createDataFrame([(i, v) for i, v in enumerate(few.tolist())], "vec_id long, embedding array<double>"), few


def test_neighbours_of_a_vector_in_a_third_of_all_rows(spark):
    rows, vectors = unit_rows(spark, 20_000)
    found = collections.defaultdict(list)
    for r in nearest_neighbours(rows, rows.where("vec_id % 500 = 0"), 20).collect():
        found[r.query_id].append((r.rank, r.vec_id))
    assert {q: len(got) for q, got in found.items()} == {q: 20 for q in range(0, 20_000, 500)}
    assert [i for _, i in sorted(found[1500])] == list(range(0, 60, 3))
    hits = 0
    for q, got in found.items():
        best = np.lexsort((np.arange(len(vectors)), -(vectors * vectors[q]).sum(1)))
        hits += len({i for _, i in got} & set(best[best != q][:20].tolist()))
    assert hits >= 0.9 * 20 * len(found)


def test_neighbours_beyond_a_small_tight_cluster(spark, monkeypatch):
    from sluiceway.llm import ann

    rng = np.random.default_rng(2)
    base = np.abs(rng.normal(size=(6_000, 8)))
    base[:, 7] = 0
    base /= np.sqrt((base * base).sum(1))[:, None]
    tight = np.eye(8)[7] + 1e-6 * rng.normal(size=(18, 8))
    rows = [(i, v) for i, v in enumerate([*base.tolist(), *tight.tolist()])]
    fitted = ann.balanced_centroids

    def with_the_cluster(x, k, *more):
        """A centroid of its own for the cluster, whatever k-means draws."""
        own = x[:, 7] > 0.5
        return np.vstack([fitted(x[~own], k, *more), x[own].mean(0)])

    monkeypatch.setattr(ann, "balanced_centroids", with_the_cluster)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(table, table.where("vec_id >= 6000 or vec_id % 1000 = 0"), 20).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in found} == {q: 20 for q in [*range(0, 6_000, 1000), *range(6_000, 6_018)]}
    few = nearest_neighbours(table.where("vec_id >= 6000 or vec_id < 1"), table.where("vec_id = 6000"), 20)
    assert few.count() == 18


def test_quality_on_held_out_labels(spark):
    table, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    found = score_quality(table, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.95
    odd = score_quality(docs(spark, ODD), labels.limit(0)).collect()
    assert len(odd) == len(ODD) and {r.score for r in odd} == {0.5}


def test_quality_scores_by_plain_rules(spark):
    """The compiled column against rules and weights applied one by one, also to odd texts."""
    from sluiceway.llm import quality
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit_rules(table, labels, trees=4, depth=3)
    assert model.rules and len(model.rules) == len(model.weights)
    odd = docs(spark, [(100_000 + i if d is not None else None, t, s) for i, (d, t, s) in enumerate(ODD)]).withColumn("score", F.lit("clash"))
    every = table.union(odd.select("doc_id", "text"))
    want = collections.Counter()
    for r in quality.with_statistics(every).collect():
        total = model.intercept
        for rule, weight in zip(model.rules, model.weights):
            if all((r["__q_" + n] <= at) == most for n, most, at in rule):
                total += weight
        want[r.doc_id, round(1 / (1 + math.exp(-total)), 9)] += 1
    got = score_quality(table.union(odd.select("doc_id", "text")), labels, trees=4, depth=3).collect()
    assert collections.Counter((r.doc_id, round(r.score, 9)) for r in got) == want
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2
    assert all(r.predicted == (r.score >= 0.7) and r.held_out == (r.doc_id is not None and held(r.doc_id)) for r in got)
    assert score_quality(table.limit(0), labels).collect() == [] and score_quality(odd, labels).columns[-3:] == ["held_out", "score", "predicted"]


def test_empty_documents_leak_nothing(spark):
    bench = spark.createDataFrame([(1, "a benchmark item of some length")], "item_id long, text string")
    assert find_leaks(docs(spark, []), bench).collect() == [] and decontaminate(docs(spark, []), bench).collect() == []


def test_language_model(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(docs(spark, ODD).select("doc_id", "text"))
    rows = table.collect()
    counts = collections.Counter()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for i, t in rows:
        if not held(i):
            counts.update(tokens(t))
    total, floor = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    told = lambda i, t: (i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total)
    base = lambda t: sum(math.log10(counts[w] + 1) - floor for w in tokens(t))
    found = score_texts(table).collect()
    assert sorted((repr((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens)), round(r.base_score, 4)) for r in found) == sorted(
        (repr(told(i, t)), round(base(t), 4)) for i, t in rows
    )
    apart = [r for r in found if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart) and all(r.score < 0 for r in found)
    assert score_texts(table.limit(0)).collect() == []


def test_language_model_scores_by_a_plain_program(spark):
    """Each token's chance, class and word, from the model's parameters; and the chances of all words sum to 1."""
    from sluiceway.llm import maxent
    from sluiceway.llm.textops import word_hash
    rng = random.Random(12)
    words = [f"{rng.choice('abcdefgh')}{i}{rng.choice(['ing', 'tion', 'er', 'x'])}" for i in range(150)]
    said = [" ".join(rng.choice(words[: 20 + i % 130]) for _ in range(rng.randrange(1, 30))) for i in range(200)]
    rows = [(i, t) for i, t in enumerate([*said, *said[:60], None, "", "never Seen words", said[0].upper()])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key long, pair string")
    train = table.where(~maxent.held_out(F.col("doc_id")))
    model, vocabulary, after = maxent.fit_model(train.select("text"))
    counts = {r.h: r.n for r in vocabulary.collect()}
    tied = {(r.pair, r.cls, r.h): (r.lam, r.extra) for r in after.collect()}
    extras = {k[:2]: v[1] for k, v in tied.items()}
    assert len(tied) > 20 and any(abs(v[0]) > 0.5 for v in tied.values())
    known = {h: int(model.scheme.classes(np.array([h], np.int64).view(np.uint64), np.array([r], np.uint32))[0]) for h, r in ((r.h, r.tail) for r in vocabulary.collect())}
    signed = lambda x: int(np.array([x], np.uint64).view(np.int64)[0])

    def within(pair, cls, h):
        share = (counts.get(h, 0) + 1) / 10 ** model.class_log[cls]
        lam = tied.get((pair, cls, h), (0.0, 0.0))[0]
        return share * math.exp(lam) / (1 + extras.get((pair, cls), 0.0))

    for pair, cls in list(extras)[:25]:
        everything = sum(within(pair, cls, h) for h, c in known.items() if c == cls)
        unseen = 1 / 10 ** model.class_log[cls] / (1 + extras[pair, cls]) if cls > maxent.ALONE else 0.0
        assert everything + unseen == pytest.approx(1, abs=1e-9)

    def score(text):
        tails = [int.from_bytes(w[::-1][:3].ljust(3, b"\0"), "big") for w in (text or "").lower().encode().split()]
        h = np.array([*word_hash(text or ""), signed(maxent._END)], np.int64).view(np.uint64)
        classes = model.scheme.classes(h, np.array([*tails, 0], np.uint32))
        start = np.array([0])
        log = maxent.log_chances(model.weights.astype(np.float64), maxent.feature_rows(maxent._contexts(classes, start)))
        assert np.exp(log).sum(1) == pytest.approx(np.ones(len(h)))
        pairs = maxent.word_pairs(h, start)
        chances = (within(signed(p), int(c), signed(x)) for p, c, x in zip(pairs, classes, h))
        return sum(log[i, c] / math.log(10) + math.log10(w) for i, (c, w) in enumerate(zip(classes, chances)))

    for r in score_texts(table).collect():
        assert r.score == pytest.approx(score(rows[r.doc_id][1]), rel=1e-4), r
    twins = [r.score / r.n_tokens for r in score_texts(table).where("doc_id < 60 and not held_out and n_tokens > 5").collect()]
    alone = [r.score / r.n_tokens for r in score_texts(table).where("doc_id between 60 and 199 and not held_out and n_tokens > 5").collect()]
    assert np.mean(twins) > np.mean(alone) + 0.1


def test_archives(spark):
    nasty = ["hi\r\n\r\n", "hi\r\n\r\n", "\r\n\r\r\n\r\n\r", None, "", "WARC/1.1\r\n\r\n", "é\r\n\r", "x" * 300_000]
    rows = [(i, f"http://www.b.org/{i % 2}?q" if i % 3 else None, h) for i, h in enumerate(nasty)] + [(5, "http://a.org\n", nasty[5]), (None, "?", nasty[5])]
    path = scratch_path(spark, "archive")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    found = warc.merge_index(warc.read_runs(spark, path, 3), 4).collect()
    order = [(r.url_key, r.captured) for r in found]
    assert order == sorted(order) and len(found) == len(rows)
    kinds = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in found)
    assert kinds[0, "revisit", 1] == kinds[3, "revisit", 4] == kinds[5, "response", None] == kinds[5, "revisit", 5] == kinds[None, "revisit", 5] == 1
    assert {r.page_id: r.payload_bytes for r in found if r.page_id in (0, 6, 7)} == {0: 6, 6: 5, 7: 300_000}
    empty = scratch_path(spark, "archive")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.merge_index(warc.read_runs(spark, empty)).collect() == []


def test_archives_of_pages_out_of_a_shuffle(spark):
    pages = spark.range(8_000).select(F.col("id").alias("page_id"), F.lit("http://a.org/").alias("url"), F.concat(F.lit("page "), (F.col("id") / 2).cast("int")).alias("html"))
    path = scratch_path(spark, "archive")
    same = spark.createDataFrame([(9_000, "http://b.org/", "same", "x")] * 300, "page_id long, url string, html string, digest string")
    warc.write_warc(pages.withColumn("digest", F.lit("x")).union(same).repartition("page_id"), path)
    found = warc.merge_index(warc.read_runs(spark, path))
    kinds = {tuple(r) for r in found.groupBy(F.col("page_id") < 9_000, "record_type").count().collect()}
    assert kinds == {(True, "response", 4_000), (True, "revisit", 4_000), (False, "response", 1), (False, "revisit", 299)}
    assert found.where("record_type = 'revisit' and page_id < 9000 and refers_to <> page_id + 1").count() == 0
    # any capture can be read from its archive
    some = found.where("record_type = 'response' and page_id % 997 = 1")
    assert {(r.page_id, bytes(r.payload).decode()) for r in warc.fetch(spark, some).collect()} == {(i, f"page {i // 2}") for i in range(8_000) if i % 997 == 1 and i % 2}
    assert warc.fetch(spark, some.where("false")).collect() == []


def test_loser_tree():
    rng = random.Random(5)
    for k in range(9):
        lists = [sorted((rng.randint(0, 9), j) for _ in range(rng.randint(0, 7))) for j in range(k)]
        assert list(warc.LoserTree(lists, lambda x: x)) == sorted(itertools.chain(*lists))


def test_pipeline_line_stage(spark):
    import corpus_pipeline

    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id")
    given = rows.collect()
    found = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, rows, SF).collect()}
    assert len(found) == len(given)
    for r, gone in zip(given, plain_line_spans([r.text or "" for r in given])):
        left = "\n".join(x for i, x in enumerate((r.text or "").split("\n")) if i not in gone)
        assert found[r.doc_id] == ((left, len(left)) if gone else (r.text, r.n_chars))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    before = spark.read.parquet(f"{SF}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        after = function(spark, before, SF)
        after.write.parquet(str(tmp_path / name.replace(" ", "")))
        after = spark.read.parquet(str(tmp_path / name.replace(" ", "")))
        if function is corpus_pipeline.drop_copies:
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = {i for i, (n, c) in components_by_hand(rows, 5, 80).items() if c == i or not n}
            assert {r.doc_id for r in after.collect()} == want
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == before.columns
        before = after
    digest = hashlib.sha256(repr(sorted(map(tuple, before.collect()))).encode()).hexdigest()
    again = hashlib.sha256(repr(sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))).encode()).hexdigest()
    assert digest == again


def _staged(spark, label):
    from sluiceway.session import scratch_root
    return {p.name for p in pathlib.Path(scratch_root(spark)).glob(f"{label}-*")}


def test_lines_leave_no_steps_behind(spark):
    """What only an earlier step read is deleted; the texts and the spans to take out are read by the result."""
    before = _staged(spark, "lines")
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"head {i}\n{passage}\ntail {i}") for i in range(6)]
    found = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    left = sorted(p.rsplit("-", 1)[0] for p in _staged(spark, "lines") - before)
    assert left == ["lines-docs", "lines-spans"]
    assert {r.doc_id: r.text for r in found.collect()} == {0: rows[0][1], **{i: f"head {i}\ntail {i}" for i in range(1, 6)}}


def test_join_leaves_no_counts_behind(spark):
    before = _staged(spark, "join")
    texts = [" ".join(f"w{i}" for i in range(40)) + tail for tail in ("", " x", " y", "")]
    found = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {0}
    left = {p.rsplit("-", 1)[0] for p in _staged(spark, "join") - before}
    assert "join-sets" in left and not left & {"join-counts", "join-buckets", "join-hopeful", "join-placed"}


def test_language_model_counts_words_after_every_pair(spark):
    """All pairs that occur more than once, and each word after them; also where a task adds up its tokens in parts."""
    from sluiceway.llm import maxent
    from sluiceway.llm.textops import word_hash
    rng = random.Random(5)
    said = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(40))) for _ in range(30)]
    scheme = maxent.Scheme(np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    end, plain = int(np.array([maxent._END]).view(np.int64)[0]), collections.Counter()
    for text in said:
        h = np.array([*word_hash(text), end], np.int64).view(np.uint64)
        plain.update(zip(maxent.word_pairs(h, np.array([0])).view(np.int64).tolist(), h.view(np.int64).tolist()))
    often = collections.Counter()
    for (pair, _), n in plain.items():
        often[pair] += n
    found = maxent.count_pairs(spark.createDataFrame([(t,) for t in said], "text string"), scheme).collect()
    assert {(r.pair, r.h): r.n for r in found} == {k: n for k, n in plain.items() if often[k[0]] > 1}


def test_language_model_keeps_little_on_disk(spark):
    """What scoring stages stays below the size of the texts: weights and lookups, as many as there are tokens nearly, are not kept."""
    from sluiceway.session import scratch_root
    rng = random.Random(31)
    rows = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(1000, 1012)) for _ in range(300))) for i in range(200)]
    before = _staged(spark, "lm")
    found = score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 200 and any(r.score > r.base_score for r in found)
    fresh = [pathlib.Path(scratch_root(spark)) / p for p in _staged(spark, "lm") - before]
    assert sum(f.stat().st_size for p in fresh for f in p.rglob("*.parquet")) < sum(len(t) for _, t in rows)


def test_staging_frees_the_driver(spark, monkeypatch):
    """Each written step has the driver let go of the query that wrote it."""
    from sluiceway.llm import staging
    freed = []
    monkeypatch.setattr(staging, "release", freed.append)
    assert staging.stage(spark.range(3), "freed").count() == 3
    assert freed == [spark]
