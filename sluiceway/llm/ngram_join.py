"""N-gram Jaccard join by token-combination prefixes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.components import components
from sluiceway.llm.staging import col, discard, release, stage, without
from sluiceway.llm.textops import mix, shingle_sets, text_buffer

#: Tokens are counted by their first 36 bits: those of the block that counts them, and 24 within it.
BLOCK_BITS, CELL_BITS = 12, 24
#: Tokens of a batch that are put into blocks at once.
DEALT = 1 << 21
#: Tokens that a filter is made for, its bits (4 MB), how often heavier ones occur, and the bits of theirs.
LISTED, TOKEN_BITS, HEAVIER, HEAVIER_BITS = 1 << 24, 1 << 25, 16, 1 << 23
#: Frequent tokens are combined within hash groups of about this many tokens of a prefix.
GROUP_TOKENS = 6

OUTPUT = ("n_shingles", "component_id")

_PAIR = np.uint64(0xD6E8FEB86659FD93)


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(h)
    return [(h % np.uint64(bits)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)]


def bloom(values: DataFrame, bits: int) -> bytes:
    """A Bloom filter over the first column, of fixed size whatever the number of rows."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(bits, bool)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy().view(np.uint64), bits):
                flags[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags).tobytes()], pa.binary())], ["bits"])

    total = np.zeros(bits // 8, np.uint8)
    for row in values.coalesce(8).mapInArrow(mark, "bits binary").toLocalIterator():
        total |= np.frombuffer(row["bits"], np.uint8)
    return total.tobytes()


def holds(flags: np.ndarray, values: np.ndarray) -> np.ndarray:
    first, second = _places(values, 8 * len(flags))

    def bit(at: np.ndarray) -> np.ndarray:
        return flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1

    return (bit(first) & bit(second)).astype(bool)


def _cells(tokens: np.ndarray) -> np.ndarray:
    """What tokens are counted by; two share a cell with a chance of 2**-36, which affects their order only."""
    return tokens >> np.uint64(64 - BLOCK_BITS - CELL_BITS)


def _binary(cuts: np.ndarray, width: int, data: np.ndarray) -> pa.Array:
    """Runs of items of so many bytes, cut at item numbers."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(data.tobytes())])


def _in_blocks(width: int):
    """Function of tasks: a row for each block, with the cells of a batch's tokens, three bytes each, and how many texts have them."""

    def deal(sets: list[np.ndarray]) -> pa.RecordBatch:
        cells, n = np.unique(_cells(np.concatenate(sets)), return_counts=True)
        cuts = np.searchsorted(cells, np.arange((1 << BLOCK_BITS) + 1, dtype=np.uint64) << np.uint64(CELL_BITS))
        some = np.flatnonzero(np.diff(cuts))
        cuts = np.append(cuts[some], len(cells))
        low = cells.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), _binary(cuts, 3, low), _binary(cuts, 4, n.astype(np.uint32))], ["block", "cells", "n"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, sets = 0, []
            for _, s in shingle_sets(batch.column("text"), width):
                sets.append(s)
                held += len(s)
                if held >= DEALT:
                    yield deal(sets)
                    held, sets = 0, []
            if held:
                yield deal(sets)

    return emit


def _block_counts(block: pa.Table) -> pa.Table:
    """The cells of a block that several texts have, and how many."""
    low = np.frombuffer(b"".join(block.column("cells").to_pylist()), np.uint8).reshape(-1, 3).astype(np.int64)
    cells, at = np.unique(low[:, 0] | low[:, 1] << 8 | low[:, 2] << 16, return_inverse=True)
    n = np.bincount(at, np.frombuffer(b"".join(block.column("n").to_pylist()), np.uint32)).astype(np.int64)
    first = block.column("block")[0].as_py() << CELL_BITS
    return pa.table([pa.array(cells[n > 1] + first), pa.array(n[n > 1])], ["cell", "n"])


def token_filters(texts: DataFrame, width: int) -> tuple[bytes, bytes]:
    """Filters of tokens that several documents have, and of those that very many have, by cell.

    Every token of every document is counted: tasks pack the cells of a batch by block, and each block is added up on its own. The
    least count is 2, or as much more as leaves ``LISTED`` tokens. Any filters give the same links: they only say in what order a
    set's tokens are taken, which is worth most where tokens of one document come first.
    """
    dealt = texts.select("text").mapInArrow(_in_blocks(width), "block int, cells binary, n binary")
    counts = stage(dealt.groupBy("block").applyInArrow(_block_counts, "cell long, n long"), "join-counts")
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = sorted(((r["s"], r["count"]) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True)
    least, listed = 1 << 30, 0
    for s, n in steps:
        if listed + n > LISTED:
            break
        least, listed = s, listed + n
    several = counts.where(step >= least).select("cell")
    many = counts.where(step >= least).where(F.col("n") >= 2 * HEAVIER).where(step >= least + 8).select("cell")
    filters = bloom(several, TOKEN_BITS), bloom(many, HEAVIER_BITS)
    discard(counts)
    return filters


def ordered(tokens: np.ndarray, several: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Tokens as numbers in the common order: of one document, of several, of very many; then by hash."""
    cells = _cells(tokens)
    band = np.zeros(len(tokens), np.uint64)
    at = np.flatnonzero(holds(several, cells))
    band[at] = np.where(holds(many, cells[at]), 3, 2)
    return np.sort(tokens >> np.uint64(2) | band << np.uint64(62))


def _groups(tokens: np.ndarray, level: int) -> np.ndarray:
    return (mix(tokens ^ _salt(level)) % np.uint64(max(1, (1 << level) // (10 * GROUP_TOKENS)))).astype(np.int64)


def _salt(level: int) -> np.uint64:
    return np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def prefix_of(tokens: np.ndarray, missing: int, level: int) -> np.ndarray:
    """The shortest prefix of ordered tokens that must share a key with any linked set.

    ``missing`` of a set's tokens can be absent from a linked one. Rare tokens are keys alone; frequent ones fall into
    hash groups and are keys in pairs of one group. The prefix runs until rare tokens plus, over groups, tokens less one
    exceed ``missing``: then, whichever are absent, a rare token or two of one group remain. Of two linked
    sets, the one whose prefix ends first in the common order has all of that inside the other's prefix.
    """
    rare = int(np.searchsorted(tokens, np.uint64(3 << 62)))
    if rare > missing:
        return tokens[: missing + 1]
    groups = _groups(tokens[rare:], level)
    fresh = np.zeros(len(groups), np.int64)
    fresh[np.unique(groups, return_index=True)[1]] = 1
    value = np.cumsum(1 - fresh)  # the first of a group gives no pair
    return tokens[: rare + int(np.searchsorted(value, missing + 1 - rare)) + 1]


def signatures(prefix: np.ndarray, level: int) -> np.ndarray:
    """The keys of a prefix: its rare tokens, and pairs of frequent ones of one group."""
    rare = int(np.searchsorted(prefix, np.uint64(3 << 62)))
    keys = [mix(prefix[:rare] ^ _salt(level))]
    often = prefix[rare:]
    if len(often) > 1:
        groups = _groups(often, level)
        order = np.argsort(groups, kind="stable")
        for members in np.split(often[order], np.flatnonzero(np.diff(groups[order])) + 1):
            i, j = np.triu_indices(len(members), 1)
            keys.append(mix((members[i] * _PAIR + members[j]) ^ _salt(level) ^ np.uint64(1)))
    return np.concatenate(keys)


def levels_of(n: int, share: int) -> list[int]:
    """Size classes a set has keys for: its own, and the next if a linked set can lie there. Groups follow from the class."""
    own, most = int(n).bit_length() - 1, int(100 * n // share).bit_length() - 1
    return [own] if most == own else [own, own + 1]


def missing_of(n: int, share: int) -> int:
    return n - -(-share * n // 100)


def node_of(tokens: np.ndarray) -> int:
    """64 bits that stand for a set: equal sets have equal numbers, others differ but for a chance of 2**-64."""
    with np.errstate(over="ignore"):
        both = np.bitwise_xor.reduce(mix(tokens)) * _PAIR + np.add.reduce(mix(tokens ^ _PAIR)) + np.uint64(len(tokens))
    return int(mix(np.array([both], np.uint64)).view(np.int64)[0])


def _text_keys(column) -> np.ndarray:
    """A checksum and the length of each text: equal texts have equal keys, others seldom."""
    raw, offsets = text_buffer(column)
    sums = [zlib.crc32(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return np.array(sums, np.int64) << 31 ^ np.diff(offsets)


def _described(width: int, share: int, filters):
    """Function of tasks: each row's set as a number, its size, its text's key and, at the first of equal sets of a batch, its prefix."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several, many = (np.frombuffer(f, np.uint8) for f in filters.value)
        for batch in batches:
            nodes, sizes, parts, seen = [], [], [], set()
            for _, s in shingle_sets(batch.column("text"), width):
                n, node = len(s), node_of(s)
                nodes.append(node)
                sizes.append(n)
                if node in seen or 100 * n < share * (n + 1):  # so small that nothing but an equal set reaches the share
                    parts.append(np.zeros(0, np.int64))
                    continue
                seen.add(node)
                tokens = ordered(s, several, many)
                longest = max((prefix_of(tokens, missing_of(n, share), level) for level in levels_of(n, share)), key=len)
                parts.append(longest.view(np.int64))
            bounds = np.concatenate([[0], np.cumsum([len(k) for k in parts])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))
            keys = pa.array(_text_keys(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), keys, lists], ["doc_id", "node", "n", "text_key", "prefix"])

    return emit


def _keyed(share: int):
    """Function of tasks: a row for each key of each set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                keys = []
                for n, prefix in zip(part.column("n").to_pylist(), part.column("prefix")):
                    tokens = prefix.values.to_numpy().view(np.uint64)
                    each = [signatures(prefix_of(tokens, missing_of(n, share), level), level) for level in levels_of(n, share)]
                    keys.append(np.unique(np.concatenate(each)).view(np.int64))
                at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), part.column("n").take(at), part.column("node").take(at)], ["key", "n", "node"])

    return emit


def _hopeful(share: int):
    """Function of tasks: pairs that may reach the share, as far as both prefixes tell.

    Up to where the shorter prefix ends, in the common order, all tokens of both sets are known. What is
    shared there, plus at most the rest of the smaller remainder, bounds the intersection from above.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            names = ("na", "pa", "nb", "pb")
            for i, (n, p, m, q) in enumerate(zip(*[batch.column(c) for c in names])):
                n, m = n.as_py(), m.as_py()
                x, y = p.values.to_numpy().view(np.uint64), q.values.to_numpy().view(np.uint64)
                end = min(x[-1], y[-1])
                known_x, known_y = int(np.searchsorted(x, end, "right")), int(np.searchsorted(y, end, "right"))
                at = np.searchsorted(x, y[:known_y])
                shared = int((x[np.minimum(at, len(x) - 1)] == y[:known_y]).sum())
                most = shared + min(n - known_x, m - known_y)
                if 100 * most >= share * (n + m - most):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return emit


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, size and node: each key's first row beside every other one. Only the first is held."""
    last = None  # key, size and node of the first row of a bucket, and the node last seen
    for batch in batches:
        key, n, node = (batch.column(c).to_numpy() for c in ("key", "n", "node"))
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        again = np.zeros(len(key), bool)
        again[1:] = ~new[1:] & (node[1:] == node[:-1])
        if last is not None and last[0] == key[0]:
            new[0] = False
            again[0] = node[0] == last[3]
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        head = np.where(first >= 0, node[first], last[2] if last else 0)
        size = np.where(first >= 0, n[first], last[1] if last else 0)
        keep = ~new & ~again & (node != head)
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep]), pa.array(head[keep]), pa.array(size[keep]), pa.array(node[keep]), pa.array(n[keep])], ["key", "a", "na", "b", "nb"]
            )
        last = (key[-1], size[-1], head[-1], node[-1])


#: Bits of the filter that keeps the sets of candidate rows; it passes all of them and, once full, others too.
FILTER_BITS = 1 << 23


def _candidate_sets(width: int, bits: bytes):
    """Function of tasks: the tokens of sets whose texts pass the filter, equal sets once a batch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(bits, np.uint8)
        for batch in batches:
            found: dict[int, bytes] = {}
            held = 0
            hit = holds(flags, _text_keys(batch.column("text")).view(np.uint64))
            for _, s in shingle_sets(batch.column("text").filter(pa.array(hit)), width):
                node = node_of(s)
                if len(s) and node not in found:
                    found[node] = s.tobytes()
                    held += s.nbytes
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "tokens"])
                        found, held = {}, 0
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "tokens"])

    return emit


def _verified(share: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            last, x = None, None
            for i, (a, p, q) in enumerate(zip(batch.column("a").to_pylist(), batch.column("ta"), batch.column("tb"))):
                if a != last:
                    last, x = a, np.frombuffer(p.as_buffer(), np.uint64)
                y = np.frombuffer(q.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                if 100 * both >= share * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return emit


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _hopeful_pairs(pairs: DataFrame, prefixes: DataFrame, share: int) -> DataFrame:
    left = prefixes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
    right = prefixes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "na", "pa", "nb", "pb")
    return stage(joined.mapInArrow(_hopeful(share), "a long, b long"), "join-hopeful")


def _linked_pairs(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return stage(joined.mapInArrow(_verified(share), "a long, b long"), "join-links")


def _prefixes(described: DataFrame, nodes: DataFrame) -> DataFrame:
    known = described.where(F.size("prefix") > 0).select("node", "n", "prefix")
    return stage(known.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "join-prefixes")


def _sets(texts: DataFrame, described: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The whole sets of some nodes, in a pass over all texts that takes one text of each node apart, and few others."""
    one = described.select("node", "text_key").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("text_key"))
    near = texts.mapInArrow(_candidate_sets(width, bloom(one.select("text_key"), FILTER_BITS)), "node long, tokens binary")
    return stage(near.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "join-tokens")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each token of each set."""
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            sets = [np.frombuffer(t.as_buffer(), np.int64) for t in part.column("tokens")]
            nodes = np.repeat(part.column("node").to_numpy(), [len(t) for t in sets])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), pa.array(nodes)], ["token", "node"])


#: Parts of the tokens, by hash, whose common ones are counted for each open set, and 64-bit words of marks of all its tokens.
PARTS, MARKS = 64, 8


def _common(sets: DataFrame) -> DataFrame:
    """``node, common, parts, m0…``: how many tokens of each set some other one of these sets has, altogether and by part, and marks.

    Exact. Two sets share, in each part, at most the smaller of their counts there; so the sum of those bounds what they share, and
    the more parts there are the closer it comes. Each token sets one bit of the marks; a bit that one set has
    and the other lacks stands for a token, at least, that they do not share, which costs next to nothing to tell.
    """
    tokens = sets.mapInArrow(_tokens, "token long, node long")
    single = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    # as many as the set has tokens at most
    alone = single.groupBy("node").agg(F.collect_list(F.pmod("token", F.lit(PARTS)).cast("int")).alias("alone"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, marks = [], np.zeros((batch.num_rows, 64 * MARKS), bool)
            for k, (tokens, alone) in enumerate(zip(batch.column("tokens"), batch.column("alone"))):
                marks[k, mix(np.frombuffer(tokens.as_buffer(), np.uint64)) % np.uint64(64 * MARKS)] = True
                every = np.bincount(np.frombuffer(tokens.as_buffer(), np.int64) % PARTS, minlength=PARTS)
                told.append(every - np.bincount(np.array(alone.as_py() or [], np.int64), minlength=PARTS))
            counts = np.array(told, np.int32).reshape(-1, PARTS)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(told) + 1, dtype=np.int32) * PARTS), pa.array(counts.ravel()))
            words = np.packbits(marks, axis=1).view(np.int64).reshape(-1, MARKS)
            columns = [batch.column("node"), pa.array(counts.sum(1).astype(np.int64)), lists, *[pa.array(words[:, k].copy()) for k in range(MARKS)]]
            yield pa.RecordBatch.from_arrays(columns, ["node", "common", "parts", *_MARKS])

    return sets.join(alone, "node", "left").mapInArrow(count, "node long, common long, parts array<int>, " + ", ".join(f"{m} long" for m in _MARKS))


_MARKS = [f"m{k}" for k in range(MARKS)]

#: Rows of a key that are compared with its others, round by round; the last round takes all that are left.
HEADS = (4, 16, None)
#: Keys of a set that tell under which of its keys a pair is made; pairs that share further keys may be made twice, then made distinct.
TOLD = 32


def jaccard_roots(texts: DataFrame, described: DataFrame, width: int, share: int) -> DataFrame:
    """``(node, root)`` of linked sets (as numbers): their exact components, by links enough for those.

    The rows of one key are a star first: the smallest set against all others. Where that leaves a key's sets in
    several components, the tokens of these open sets are counted, all of them and exactly. A token that one open set
    has alone cannot be shared with another, so what a set has besides bounds its intersections: sets that can reach the
    share with no other are done, and pairs that cannot are passed over, in the last round also by marks of their tokens and
    by what they have in common part by part (see :func:`_common`). Then sets of each key, those with the least
    share of such tokens first and others by hash, are compared with those of other components, more each round, and
    at last all sets of different components. So no link between components is lost, and inside a component none is
    needed: of many near copies of one text, few pairs are looked at before they hang together.
    """
    keyed = described.where(F.size("prefix") > 0).select("n", "node", "prefix").mapInArrow(_keyed(share), "key long, n long, node long")
    buckets = stage(
        keyed.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(_stars, "key long, a long, na long, b long, nb long"), "join-buckets"
    )
    # sizes further apart cannot reach the share; na is the smaller
    stars = stage(buckets.where(f"100 * na >= {share} * nb").select("a", "b").distinct(), "join-stars")
    rows = stage(buckets.select("key", F.col("b").alias("node"), F.col("nb").alias("n")).union(buckets.select("key", "a", "na").distinct()), "join-rows")
    discard(buckets)
    prefixes = _prefixes(described, _nodes(stars))
    hopeful = _hopeful_pairs(stars, prefixes, share)
    discard(prefixes)
    nodes = stage(_nodes(hopeful), "join-nodes")
    sets = _sets(texts, described, nodes, width)
    links = _linked_pairs(hopeful, sets, share)
    discard(hopeful, nodes, sets)

    tested, sets, roots = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), None, None
    for turn, heads in enumerate(HEADS):
        release(rows.sparkSession)
        roots = roots or components(links)
        placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = stage(placed, "join-placed")
        mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
        rows = stage(placed.join(mixed, "key", "left_semi"), "join-open")
        discard(placed)
        if sets is None:
            prefixes = _prefixes(described, stage(rows.select("node").distinct(), "join-nodes"))
            sets = _sets(texts, described, prefixes.select("node"), width)
            common = stage(_common(sets), "join-common")
            rows = rows.join(common.select("node", "common"), "node")
            rows = stage(rows.where(f"100 * common >= {share} * n"), "join-open")
            told = rows.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("key")), 1, TOLD).alias("keys"))
            rows = stage(rows.join(told, "node"), "join-open")
        sides = rows if heads else rows.join(common.select("node", "parts", *_MARKS), "node")

        def side(name: str) -> DataFrame:
            told = {"n": "n", "root": "r", "common": "c", "keys": "k", "parts": "p"} | {m: m for m in _MARKS}
            return sides.select("key", F.col("node").alias(name), *[F.col(c).alias(told[c] + name) for c in sides.columns if c in told])

        x, y = side("a"), side("b")
        if heads:
            first = F.col("na") / F.col("ca") if turn == 0 else F.xxhash64("a", F.lit(turn))
            x = x.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(first, "a"))).where(F.col("place") <= heads)
        # the intersection is at most what both have in common with any other, and at most the smaller set; no bound stands twice
        # in the condition, for Spark would work out such a one before all tests that come first
        enough = f">= {share} * (na + nb)"
        fits = f"ra <> rb and {100 + share} * least(ca, cb, na, nb) {enough}"
        if not heads:  # each pair once, under the first of the keys that both have, if its marks and parts allow it
            lacking = [f"{100 + share} * (n{x} - {' - '.join(f'bit_count({m}{x} & ~{m}{y})' for m in _MARKS)}) {enough}" for x, y in ("ab", "ba")]
            both = "aggregate(zip_with(pa, pb, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
            fits = f"a < b and {fits} and {' and '.join(lacking)} and key <= coalesce(array_min(array_intersect(ka, kb)), key) and {100 + share} * {both} {enough}"
        apart = x.join(y, "key").where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stage(apart.join(tested, ["a", "b"], "left_anti"), "join-pairs")
        rows = rows.drop("root")
        if pairs.isEmpty():
            if heads is None or rows.isEmpty():
                break
            continue
        found = _linked_pairs(_hopeful_pairs(pairs, prefixes, share), sets, share)
        tested = tested.union(pairs)
        if not found.isEmpty():
            # the roots stand for the links they come from
            links, roots = stage(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found), "join-links"), None
    return roots or components(links)


def jaccard_components(docs: DataFrame, width: int = 3, share: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id, node, root``: a row for each of ``docs(doc_id, text)``.

    A text's set: distinct shingles of ``width`` words (A-Z lower-cased); with fewer words its whole sequence; without
    words (null, empty or blank text) none. Two rows link when 100 * intersection >= ``share`` * union. ``component_id``
    is the smallest ``doc_id`` reachable over links, the row's own included; ``root`` numbers the component and
    ``node`` the set. Rows without words link with nothing and have a null root.

    ``share`` is 50 or more: keys are made for a set's own size class and the next, which hold all sets that can link with it.

    Equal sets are one node, and only nodes are joined. Null ids: such rows take part; a component of null ids alone
    has a null ``component_id``. Repeated ids are rows of their own. No rows: no rows. Other columns are left out.
    """
    if not 50 <= share <= 100:
        raise ValueError(f"a share of 50 to 100 per cent is supported, not {share}")
    texts = docs.select(col("doc_id").alias("doc_id"), F.coalesce(col("text"), F.lit("")).alias("text"))
    filters = docs.sparkSession.sparkContext.broadcast(token_filters(texts, width))
    kind = texts.schema["doc_id"].dataType.simpleString()
    described = stage(texts.mapInArrow(_described(width, share, filters), f"doc_id {kind}, node long, n long, text_key long, prefix array<long>"), "join-sets")
    filters.destroy()
    release(docs.sparkSession)
    roots = jaccard_roots(texts, described, width, share)
    nodes = described.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = stage(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "join-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(rooted.select("node", "root").join(least, "root"), "join-named")
    told = described.select("doc_id", "node", "n").join(named.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return told.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), "node", "root")


def _with_node(width: int, at: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [(node_of(s), len(s)) for _, s in shingle_sets(batch.column(at), width)]
            columns = [pa.array([t[k] for t in told], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "__node", "__n"])

    return emit


def one_of_each(docs: DataFrame, width: int = 5, share: int = 80) -> DataFrame:
    """The documents with one row of each component, all columns kept.

    The row with the component's smallest id stays; if several rows have it (repeated rows, null ids), one of them. Rows
    without words all stay. Rows that link with nothing pass without a look at the others.
    """
    told = stage(jaccard_components(docs, width, share), "join-told")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    groups = told.where(F.col("root").isNotNull()).groupBy("root").agg(F.count("*").alias("rows"), F.sum(first.cast("int")).alias("firsts")).where("rows > 1")
    members = told.where(F.col("root").isNotNull()).join(groups, "root").select(F.col("node").alias("__of"), F.col("root").alias("__root"), F.col("component_id").alias("__least"), (F.col("firsts") > 1).alias("__many")).distinct()
    members = stage(members, "join-members")
    at = [c.lower() for c in docs.columns].index("text")
    schema = T.StructType(docs.schema.fields + [T.StructField("__node", T.LongType()), T.StructField("__n", T.LongType())])
    rows = docs.mapInArrow(_with_node(width, at), schema).join(members, (F.col("__node") == F.col("__of")) & (F.col("__n") > 0), "left")
    rows = rows.where(F.col("__of").isNull() | col("doc_id").eqNullSafe(F.col("__least")))
    if not members.where("__many").isEmpty():
        rows = stage(rows, "join-kept")
        many = F.coalesce("__many", F.lit(False))
        rows = rows.where(~many).union(rows.where(many).dropDuplicates(["__root"]))
    return rows.select(*[col(c) for c in docs.columns])


def jaccard_join(docs: DataFrame, width: int = 3, share: int = 90) -> DataFrame:
    """Add ``n_shingles`` and ``component_id`` of :func:`jaccard_components` to documents (``doc_id, text`` and any others).

    Input columns named like an output column are replaced.
    """
    base = without(docs, OUTPUT)
    told = jaccard_components(docs, width, share).where("root is not null").select(F.col("node").alias("__of"), "component_id").distinct()
    at = [c.lower() for c in base.columns].index("text")
    schema = T.StructType(base.schema.fields + [T.StructField("__node", T.LongType()), T.StructField("__n", T.LongType())])
    rows = base.mapInArrow(_with_node(width, at), schema).join(told, (F.col("__node") == F.col("__of")) & (F.col("__n") > 0), "left")
    found = F.when(F.col("__n") > 0, F.col("component_id")).otherwise(col("doc_id"))
    return rows.select(*[col(c) for c in base.columns], F.col("__n").alias("n_shingles"), found.alias("component_id"))
