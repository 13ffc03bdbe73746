"""Approximate nearest neighbours by inner product, over balanced posting lists."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.staging import col, stage

#: Rows of the sample that fits the centroids and the pruning ratio, and the sample's queries for the latter.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 400
#: Aimed rows of a posting list, and least sampled rows a centroid.
LIST_ROWS, ROWS_PER_CENTROID = 512, 16
#: A vector goes to further lists while they are less than so much further than its nearest, at most so many.
CLOSURE, REPLICAS = 1.10, 4
#: Share of the sample's neighbours that the pruning ratio must reach.
AIM = 0.98
#: Least nearest distance that the ratio is applied to, as a share of the centroids' median spacing.
FLOOR = 0.25
#: Links of a centroid in the search graph.
LINKS = 24
#: So many nearest lists are scanned first; their k-th score is the floor for what further lists report.
FIRST_LISTS = 4
#: Rows and queries of one cell of the scan.
CELL_ROWS, CELL_QUERIES = 4_096, 1_024


@dataclass
class Index:
    """What searching needs beside the lists; its size is bounded by the sample, not by the rows."""

    centroids: np.ndarray
    links: list[np.ndarray]
    top: float  # largest squared norm of any row
    ratio: float  # lists up to this many times the nearest centroid's distance are scanned
    floor: float = 0.0  # a nearest distance below this counts as this

    def reach(self, nearest: float) -> float:
        return max(nearest, self.floor) * self.ratio


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with one more component that gives all the same norm, so that nearest means largest inner product."""
    rest = np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))
    return np.hstack([x, rest[:, None]])


def lifted_queries(q: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([q * np.sqrt(top / (q * q).sum(1))[:, None], np.zeros((len(q), 1))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)))


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means, then clusters of more than twice the mean are halved until none is left (or all their rows are equal)."""
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), k, replace=False))].copy()

    def nearest() -> np.ndarray:
        return np.concatenate([distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])

    for _ in range(rounds):
        owner = nearest()
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, x)
        count = np.bincount(owner, minlength=k)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
    owner = nearest()
    pools = [x[owner == j] for j in range(k) if (owner == j).any()]
    out, most = [], 2 * len(x) / k
    while pools:
        pool = pools.pop()
        if len(pool) <= most:
            out.append(pool.mean(0))
            continue
        axis = pool[np.argmax(((pool - pool.mean(0)) ** 2).sum(1))] - pool.mean(0)
        side = (pool - pool.mean(0)) @ axis
        order = np.argsort(side, kind="stable")
        if side[order[0]] == side[order[-1]]:
            out.append(pool.mean(0))
            continue
        pools += [pool[order[: len(pool) // 2]], pool[order[len(pool) // 2 :]]]
    return np.array(out)


def closure(d: np.ndarray, centre_gaps: np.ndarray) -> Iterator[list[int]]:
    """Lists of each row of distances: the nearest, and near ones that no chosen list lies nearer to than the row."""
    take = min(4 * REPLICAS, d.shape[1])
    order = np.argpartition(d, take - 1, axis=1)[:, :take]
    for row, some in zip(d, order):
        some = some[np.lexsort((some, row[some]))]
        chosen = [int(some[0])]
        for c in some[1:]:
            if len(chosen) == REPLICAS or row[c] > CLOSURE * row[chosen[0]]:
                break
            if all(centre_gaps[c, o] >= 0.5 * row[c] for o in chosen):
                chosen.append(int(c))
        yield chosen


def graph(centroids: np.ndarray) -> list[np.ndarray]:
    """Each centroid's nearest ones and a few far ones, links going both ways."""
    n = len(centroids)
    rng = np.random.default_rng(11)
    near: list[set[int]] = [set() for _ in range(n)]
    for i in range(0, n, 1024):
        d = distances(centroids[i : i + 1024], centroids)
        for r, order in enumerate(np.argsort(d, axis=1, kind="stable")[:, 1 : LINKS + 1]):
            for j in [*order.tolist(), *rng.integers(0, n, 4).tolist()]:
                if j != i + r:
                    near[i + r].add(j)
                    near[j].add(i + r)
    return [np.array(sorted(s), np.int64) for s in near]


def walk(q: np.ndarray, index: Index, rows: np.ndarray, k: int, slack: float = 1.03, least: int = 8) -> list[int]:
    """Centroids within the index's ratio of the nearest, found over the graph, and further ones until their lists
    have ``k`` rows by ``rows`` (of each list, rows that no other list counts); best first.

    The walk ends when the nearest centroid not yet expanded lies beyond the ratio with some slack and those expanded
    have enough rows. If the graph ends before, all other centroids are taken in.
    """
    c = index.centroids
    first = float(np.sqrt(((c[0] - q) ** 2).sum()))
    seen = np.zeros(len(c), bool)
    seen[0] = True
    queue, known, best = [(first, 0)], [(first, 0)], first
    expanded, held = 0, 0
    while queue:
        d, at = heapq.heappop(queue)
        if expanded >= least and held >= k and d > index.reach(best) * slack:
            break
        expanded += 1
        held += int(rows[at])
        new = index.links[at][~seen[index.links[at]]]
        if not queue and not len(new) and held < k:
            new = np.flatnonzero(~seen)
        if len(new):
            seen[new] = True
            for dist, j in zip(np.sqrt(((c[new] - q) ** 2).sum(1)).tolist(), new.tolist()):
                best = min(best, dist)
                known.append((dist, j))
                heapq.heappush(queue, (dist, j))
    known.sort()
    taken, held = [], 0
    for dist, j in known:
        if held >= k and dist > index.reach(best):
            break
        taken.append(j)
        held += int(rows[j])
    return taken


def fit(sample: np.ndarray, rows: int, top: float, k: int) -> Index:
    """Centroids, graph and pruning ratio from a sample.

    The ratio is the least that reaches ``AIM`` of the sample's own neighbours. The sample is sparser than the rows,
    its neighbours lie further apart, so the ratio errs to the wide side.
    """
    x = lifted(sample, top)
    n = int(max(1, min(-(-rows // LIST_ROWS), len(x) // ROWS_PER_CENTROID)))
    centres = balanced_centroids(x, n)
    if len(centres) == 1:
        return Index(centres, [np.zeros(0, np.int64)], top, 2.0)
    gaps = distances(centres, centres)
    # copies of a centroid say nothing of the spacing
    apart = np.where(gaps > 1e-6 * np.sqrt(max(top, 0.0)), gaps, np.inf).min(1)
    floor = FLOOR * float(np.median(apart[np.isfinite(apart)])) if np.isfinite(apart).any() else 0.0
    lists = [ls for i in range(0, len(x), 2048) for ls in closure(distances(x[i : i + 2048], centres), gaps)]
    asked = np.linspace(0, len(x) - 1, min(SAMPLE_QUERIES, len(x))).astype(int)
    q = sample[asked]
    dq = distances(lifted_queries(q, top), centres)
    scores = q @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    need = []
    for row, d in zip(scores, dq):
        for j in np.argpartition(-row, min(k, len(row) - 1))[:k]:
            far, near = min(d[c] for c in lists[j]), max(d.min(), floor)
            if near > 0:
                need.append(far / near)
    ratio = max(1.0, float(np.quantile(need, AIM))) if need else 2.0
    return Index(centres, graph(centres), top, ratio + 1e-9, floor)


def _packed(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def usable(vector: Column) -> Column:
    """Not null or empty, every component a finite number, not all zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest_neighbours(rows: DataFrame, queries: DataFrame, k: int = 20, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` rows of largest inner product found, best first.

    Both frames have ``vec_id`` and ``embedding``. Index: centroids fitted on at most ``sample_rows`` rows (those of
    smallest id hash); every row goes to the list of its nearest centroid and, near a boundary, to further ones. Query:
    a walk over a graph of the centroids gives the lists whose centroid is within a ratio of the nearest one's distance,
    further lists follow until they hold ``k`` rows, and all rows of those lists are compared, in double precision. Equal scores go to the smaller vec_id. A row with the query's
    own vec_id is no candidate. Fewer rows than ``k`` are all returned.

    A list is scanned in cells of bounded rows and queries, so many equal vectors make more cells, not a longer task. The
    nearest lists go first: a cell gives ``k`` rows a query. Their k-th score is the query's floor, and cells of further
    lists give only rows that reach it, so what is ranked does not grow with the number of lists. Only the index of
    bounded size is sent to tasks.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those whose length
    is not the most common one (ties: the shorter). Repeated ids: copies of a row count once, different vectors under one id by
    their scores. Null ids take no part. No rows: no rows. Other columns are left out.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    vector = F.transform(col("embedding"), lambda v: v.cast("double"))
    base = rows.select(col("vec_id").cast("long").alias("vec_id"), vector.alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    told = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b)).alias("top"))
    told = told.orderBy(F.desc("n"), "d").limit(1).collect()
    if not told:
        return spark.createDataFrame([], schema)
    width, total, top = told[0]["d"], told[0]["n"], told[0]["top"]
    base = base.where(F.size("v") == width)
    asked = queries.select(col("vec_id").cast("long").alias("query_id"), vector.alias("v"))
    asked = asked.where(F.col("query_id").isNotNull() & usable(F.col("v")) & (F.size("v") == width))

    picked = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow()
    index = fit(_packed(picked.column("v").combine_chunks()), total, top, k)
    sent = spark.sparkContext.broadcast(index)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        gaps = distances(ix.centroids, ix.centroids)
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                x = _packed(part.column("v"))
                lists = list(closure(distances(lifted(x, ix.top), ix.centroids), gaps))
                at = np.repeat(np.arange(len(x)), [len(ls) for ls in lists])
                nearest = np.concatenate([np.arange(len(ls)) == 0 for ls in lists])
                ids = part.column("vec_id").to_numpy()
                packed = [r.tobytes() for r in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists).astype(np.int32)), pa.array(nearest), pa.array(ids[at]), pa.array([packed[j] for j in at], pa.binary())],
                    ["list", "nearest", "vec_id", "v"],
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                q = _packed(part.column("v"))
                lists = [walk(row, ix, held, k) for row in lifted_queries(q, ix.top)]
                at = np.repeat(np.arange(len(q)), [len(ls) for ls in lists])
                ids = part.column("query_id").to_numpy()
                packed = [r.tobytes() for r in q]
                later = np.concatenate([np.arange(len(ls)) >= FIRST_LISTS for ls in lists])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists).astype(np.int32)), pa.array(later), pa.array(ids[at]), pa.array([packed[j] for j in at], pa.binary())],
                    ["list", "later", "query_id", "q"],
                )

    postings = stage(base.mapInArrow(post, "list int, nearest boolean, vec_id long, v binary"), "ann-lists")
    # ids of each list, at most one count a centroid: each row in its nearest list, and one less in case it is the query's own
    held = np.zeros(len(index.centroids), np.int64)
    for r in postings.where("nearest").groupBy("list").agg(F.count_distinct("vec_id").alias("n")).collect():
        held[r["list"]] = r["n"] - 1
    probes = stage(asked.mapInArrow(search, "list int, later boolean, query_id long, q binary"), "ann-probes")

    def parts(df: DataFrame, each: int) -> Column:
        """Parts of each list, from at most one count a centroid."""
        counts = {r["list"]: -(-r["count"] // each) for r in df.groupBy("list").count().collect()}
        every = [F.lit(counts.get(i, 1)) for i in range(len(index.centroids))]
        return F.get(F.array(*every), F.col("list"))

    row_parts = parts(postings, CELL_ROWS)

    def scan(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        ids = x["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        a = np.frombuffer(b"".join(x["v"]), np.float64).reshape(len(x), -1)[order]
        b = np.frombuffer(b"".join(q["q"]), np.float64).reshape(len(q), -1)
        asked_ids, floors = q["query_id"].to_numpy(), q["floor"].to_numpy()
        out_q, out_x, out_s = [], [], []
        for i in range(0, len(b), 64):
            rough = b[i : i + 64] @ a.T
            for row, vec, own, floor in zip(rough, b[i : i + 64], asked_ids[i : i + 64], floors[i : i + 64]):
                row[ids == own] = -np.inf
                least = max(floor, np.partition(row, len(row) - k)[len(row) - k]) if len(row) > k else floor
                some = np.flatnonzero(np.isfinite(row))
                if np.isfinite(least):
                    some = some[row[some] >= least - 1e-9 * (1 + abs(least))]
                # row by row in one fixed order, so that equal vectors have equal scores
                exact = (a[some] * vec).sum(1)
                best = np.lexsort((ids[some], -exact))[:k]
                best = best[exact[best] >= floor]
                out_q.append(np.full(len(best), own))
                out_x.append(ids[some][best])
                out_s.append(exact[best])
        return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_x), "score": np.concatenate(out_s)})

    def scanned(some: DataFrame) -> DataFrame:
        """What the lists of some probes give, cell by cell."""
        query_parts = parts(some, CELL_QUERIES)
        wanted = postings.join(F.broadcast(some.select("list").distinct()), "list", "left_semi")  # at most one row a centroid
        cells_x = wanted.select(
            "list", F.pmod(F.xxhash64("vec_id"), row_parts).alias("p"), F.explode(F.sequence(F.lit(0), query_parts - 1)).alias("s"), "vec_id", "v"
        )
        cells_q = some.select(
            "list", F.explode(F.sequence(F.lit(0), row_parts - 1).cast("array<bigint>")).alias("p"), F.pmod(F.xxhash64("query_id"), query_parts).cast("int").alias("s"), "query_id", "q", "floor"
        )
        cell = ["list", "p", "s"]
        return cells_x.groupBy(*cell).cogroup(cells_q.groupBy(*cell)).applyInPandas(scan, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        place = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        best = found.withColumn("rank", place).where(F.col("rank") <= k)  # replicas of a row share a place
        return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score").distinct()

    first = stage(ranked(scanned(probes.where("not later").withColumn("floor", F.lit(-float("inf"))))), "ann-first")
    floors = first.where(F.col("rank") == k).groupBy("query_id").agg(F.min("score").alias("floor"))
    further = probes.where("later").join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-float("inf"))))
    return ranked(first.select("query_id", "vec_id", "score").union(scanned(stage(further, "ann-further"))))
