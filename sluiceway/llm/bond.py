"""Hard negatives, mined by a vertical scan: dimension by dimension, while bounds shrink the candidates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.staging import stage
from sluiceway.llm.vectors import common_length, number_type, whole_vectors

#: Rows of one block of columns, and anchors of one packed row.
BLOCK_ROWS, PACK_ANCHORS = 4_096, 512
#: Dimensions read before the candidates are looked through again, and how few candidates are simply resolved.
STEP, FEW = 8, 16

BLOCKS = "block long, ids binary, labels binary, columns array<binary>, least binary, most binary"
Bounds = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Block:
    """Rows of a block as columns, one a dimension, each with its smallest and largest value."""

    def __init__(self, row, kind: type) -> None:
        self.ids, self.labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
        self.columns = [np.frombuffer(c, kind) for c in row.columns]
        self.least, self.most = np.frombuffer(row.least, kind), np.frombuffer(row.most, kind)

    def scan(self, q: np.ndarray, alive: np.ndarray, keep: Bounds) -> tuple[np.ndarray, np.ndarray, int]:
        """The rows of ``alive`` that ``keep`` never ruled out, their exact products with ``q``, and how many values were read.

        Dimensions come in the order of the anchor's magnitudes, largest first. What the dimensions not yet read can add
        lies between sums of their smallest and largest contributions over the block; ``keep`` sees the bounds of each
        candidate's product and says which may still matter.
        """
        order = np.argsort(-np.abs(q), kind="stable")
        one, two = (q * self.least)[order], (q * self.most)[order]
        low = np.append(np.cumsum(np.minimum(one, two)[::-1])[::-1], 0)
        high = np.append(np.cumsum(np.maximum(one, two)[::-1])[::-1], 0)
        partial, read = np.zeros(len(alive), q.dtype), 0
        for at in range(0, len(order), STEP):
            dims = order[at : at + STEP]
            for d in dims:
                partial += q[d] * self.columns[d][alive]
            read += len(dims) * len(alive)
            done = at + len(dims)
            if len(alive) > FEW and done < len(order):
                some = keep(partial + low[done], partial + high[done])
                if not some.all():
                    alive, partial = alive[some], partial[some]
        return alive, partial, read


def _kth(values: np.ndarray, k: int) -> float | None:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def best_of(block: Block, q: np.ndarray, alive: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` rows (score, id) of largest product among ``alive``: a row goes once ``k`` others are surely better."""

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = _kth(low, k)
        return np.ones(len(low), bool) if least is None else high >= least

    alive, scores, _ = block.scan(q, alive, keep)
    return [(int(scores[j]), int(block.ids[alive[j]])) for j in _first(block.ids[alive], scores, k)]


def best_within(block: Block, q: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """For each window of scores (both ends belong) its ``k`` best rows (score, id).

    A row stays while its bounds meet a window in which fewer than ``k`` rows are surely inside and surely better.
    """

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(low), bool)
        for start, end in windows:
            inside = low[(low >= start) & (high <= end)]
            least = _kth(inside, k)
            stays |= (low <= end) & (high >= (start if least is None else max(start, least)))
        return stays

    alive, scores, _ = block.scan(q, alive, keep)
    out = []
    for start, end in windows:
        inside = np.flatnonzero((scores >= start) & (scores <= end))
        order = _first(block.ids[alive[inside]], scores[inside], k)
        out.append([(int(scores[j]), int(block.ids[alive[j]])) for j in inside[order]])
    return out


def windows_of(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """The whole scores ``n`` with ``low * score <= 100 * n <= high * score``; empty below zero."""
    return [(-(-low * s // 100), high * s // 100) for s in scores]


def mine_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    factor: int = 256,
    block_rows: int = BLOCK_ROWS,
    pack_anchors: int = PACK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over ``rows(vec_id, embedding, label)``.

    Anchors are the rows that fulfil ``anchor``. Scores are whole inner products of ``floor(factor * x)``; higher ones come first,
    ties by smaller vec_id. An anchor's positives are its first ``positives`` rows of its own label under other ids (all, if
    fewer). For each, the first ``negatives`` rows of another label, under other ids, whose score is ``window`` per cent
    of the positive's, ends included. Exact: bounds only rule out rows that cannot be among those returned.

    Rows are written in blocks of columns, by a hash of id and vector, so that neither a frequent label nor copies make a
    long task; anchors in packed rows. Every block meets every pack twice, once for positives and once for negatives, in cells
    of bounded size, and gives at most so many rows an anchor as the result may hold.

    Rows with a null label take no part; see :func:`whole_vectors` for others, and vectors whose length is not the most
    common one (ties: the shorter) take none. Wholly equal rows count once; different rows under one id are rows of
    their own, also as anchors. No rows: no rows. Other columns are left out.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    labelled = whole_vectors(rows, factor, "label").where(F.col("label").isNotNull())
    base = stage(labelled.withColumn("label", F.col("label").cast("long")), "bond-rows")
    told = common_length(base)
    if not told:
        return spark.createDataFrame([], schema)
    width, total, top = told
    kind = number_type(top, width)
    base = base.where(F.size("v") == width)

    blocks = -(-total // block_rows)

    def columns(group: pd.DataFrame) -> pd.DataFrame:
        x = np.array(group["v"].to_list(), kind).T
        block = (int(group["block"].iloc[0]), group["vec_id"].to_numpy().tobytes(), group["label"].to_numpy().tobytes())
        return pd.DataFrame([(*block, [c.tobytes() for c in x], x.min(1).tobytes(), x.max(1).tobytes())], columns=[f.split()[0] for f in BLOCKS.split(", ")])

    dealt = base.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)))
    written = stage(dealt.groupBy("block").applyInPandas(columns, BLOCKS), "bond-blocks")

    asked = base.where(anchor)
    packs = max(1, -(-asked.count() // pack_anchors))
    asked = stage(asked.withColumn("pack", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(packs))).withColumn("anchor", F.monotonically_increasing_id()), "bond-anchors")
    packed = "pack long, anchors binary, ids binary, labels binary, qs binary, found array<array<bigint>>"

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        numbers = [group[c].to_numpy().tobytes() for c in ("anchor", "vec_id", "label")]
        qs = np.array(group["v"].to_list(), kind).tobytes()
        found = [list(f) for f in group["found"]]
        return pd.DataFrame([(int(group["pack"].iloc[0]), *numbers, qs, found)], columns=[f.split()[0] for f in packed.split(", ")])

    def cells(anchors: DataFrame, work: Callable, gives: str) -> DataFrame:
        """Every block with every pack; each cell holds one of either."""

        def cell(block: pd.DataFrame, pack: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(block) and len(pack):
                b, p = Block(block.iloc[0], kind), pack.iloc[0]
                told = (np.frombuffer(p[c], np.int64) for c in ("anchors", "ids", "labels"))
                for number, own, label, q, found in zip(*told, np.frombuffer(p["qs"], kind).reshape(-1, width), p["found"]):
                    out += work(b, int(number), int(own), label, q, [int(f) for f in found])
            fields = [f.split() for f in gives.split(", ")]
            return pd.DataFrame({n: pd.Series(c, dtype={"long": "int64", "int": "int32"}[t]) for (n, t), c in zip(fields, zip(*out) if out else [()] * len(fields))})

        made = anchors.groupBy("pack").applyInPandas(pack, packed)
        left = written.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)).cast("array<bigint>")))
        right = made.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
        return left.groupBy("block", "pack").cogroup(right.groupBy("block", "pack")).applyInPandas(cell, gives)

    def near(b: Block, number: int, own: int, label: int, q: np.ndarray, _: list) -> list[tuple]:
        alive = np.flatnonzero((b.labels == label) & (b.ids != own))
        return [(number, s, i) for s, i in best_of(b, q, alive, positives)]

    def far(b: Block, number: int, own: int, label: int, q: np.ndarray, found: list[int]) -> list[tuple]:
        alive = np.flatnonzero((b.labels != label) & (b.ids != own))
        per = best_within(b, q, alive, windows_of(found, *window), negatives)
        return [(number, place, s, i) for place, some in enumerate(per) for s, i in some]

    def placed(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    none = F.array().cast("array<bigint>")
    friends = placed(cells(asked.withColumn("found", none), near, "anchor long, score long, id long"), ["anchor"], positives)
    friends = stage(friends, "bond-positives")
    # at most ``positives`` rows an anchor
    found = friends.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("found"))
    others = cells(asked.join(found, "anchor"), far, "anchor long, place int, score long, id long")
    others = placed(others, ["anchor", "place"], negatives)
    pairs = others.select("anchor", (F.col("place") + 1).alias("at"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    whose = friends.select("anchor", F.col("rank").alias("at"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = asked.select("anchor", F.col("vec_id").alias("anchor_id"))
    return pairs.join(whose, ["anchor", "at"]).join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
