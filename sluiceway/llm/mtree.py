"""Exact nearest rows by inner product: M-trees over all rows, searched best first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.staging import stage
from sluiceway.llm.vectors import common_length, matrix, number_type, squared_length, whole_vectors

#: Aimed rows of a tree, which one task builds and holds, and most entries of a page.
TREE_ROWS, PAGE = 8_192, 96
#: Most routing objects above the trees, and sampled rows for each of them.
ROUTES, SAMPLED = 1_024, 16
#: Queries of one packed row, and packed rows of one cell of the search.
PACK, CELL_PACKS = 1_024, 2
#: Share of the vectors' length by which computed distances may be off.
SLACK = 1e-7
#: The floor of a query that has none.
NO_FLOOR = -(1 << 62)

PAGES = "route int, part int, node int, leaf boolean, objects binary, dist binary, radius binary, child binary, ids binary"


@dataclass
class Metric:
    """Inner products as distances.

    A row gets one more component that gives all rows the length ``sqrt(top)``; a query gets a zero. Then the squared distance
    of a query to a row is ``|q|^2 + top - 2 * product``: the nearest row has the largest product, and the triangle
    inequality holds. Products are exact; distances bear :data:`SLACK`.
    """

    top: float
    kind: type

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.hstack([x, np.sqrt(np.maximum(0.0, self.top - (x * x).sum(1)))[:, None]])

    def to_products(self, q2: float, products: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, q2 + self.top - 2.0 * products))

    def slack(self, q2: float) -> float:
        return SLACK * (np.sqrt(self.top) + np.sqrt(q2)) + 1e-12


def _gaps(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(1))


class Page:
    """A node: routing objects with covering radii and children, or (a leaf) objects with the ids that share them."""

    def __init__(self, leaf: bool, objects: np.ndarray, dist: np.ndarray, radius: np.ndarray, child: np.ndarray, ids: np.ndarray) -> None:
        self.leaf, self.objects, self.dist, self.radius, self.child, self.ids = leaf, objects, dist, radius, child, ids

    def packed(self) -> tuple:
        arrays = (self.objects, self.dist, self.radius, self.child, self.ids)
        return (self.leaf, *[a.tobytes() for a in arrays])

    @classmethod
    def of(cls, row, width: int, kind: type) -> Page:
        objects = np.frombuffer(row.objects, kind).reshape(-1, width)
        numbers = (np.frombuffer(b, t) for b, t in ((row.dist, np.float64), (row.radius, np.float64), (row.child, np.int64), (row.ids, np.int64)))
        return cls(bool(row.leaf), objects, *numbers)


def build(x: np.ndarray, ids: np.ndarray, pivot: np.ndarray, metric: Metric, page: int = PAGE) -> list[Page]:
    """An M-tree of bounded rows in pages, the root first. ``pivot`` is the lifted object that the root hangs below.

    Equal vectors are one object with its ids in order. A page of routing objects takes rows to the nearest of up to ``page``
    objects of its own, and stores each one's distance to the parent object and the radius that covers what lies below.
    """
    order = np.lexsort((ids, *x.T[::-1]))
    x, ids = x[order], ids[order]
    fresh = np.ones(len(x), bool)
    fresh[1:] = (x[1:] != x[:-1]).any(1)
    starts = np.append(np.flatnonzero(fresh), len(x))
    objects = x[fresh]
    lifted = metric.lifted(objects)
    rng = np.random.default_rng(len(objects))
    pages: list[Page | None] = [None]
    todo = [(0, np.arange(len(objects)), pivot)]
    nothing = np.zeros(0, np.int64)
    while todo:
        at, some, parent = todo.pop()
        dist = _gaps(lifted[some], parent)
        if len(some) <= page:
            owned = [ids[starts[o] : starts[o + 1]] for o in some]
            ends = np.cumsum([len(o) for o in owned], dtype=np.int64)
            pages[at] = Page(True, objects[some], dist, np.zeros(len(some)), ends, np.concatenate(owned) if owned else nothing)
            continue
        centres = rng.choice(some, min(page, max(2, -(-len(some) // (page // 2)))), replace=False)
        owner = (lifted[some] @ lifted[centres].T).argmax(1)
        if (owner == owner[0]).all():  # closer to each other than rounding tells
            owner = np.arange(len(some)) * len(centres) // len(some)
        near = _gaps(lifted[some], lifted[centres[owner]])
        radius = np.zeros(len(centres))
        np.maximum.at(radius, owner, near)
        first = len(pages)
        pages += [None] * len(centres)
        pages[at] = Page(False, objects[centres], _gaps(lifted[centres], parent), radius, np.arange(first, first + len(centres)), nothing)
        todo += [(first + j, some[owner == j], lifted[c]) for j, c in enumerate(centres)]
    return pages


def search(pages: dict[int, Page], q: np.ndarray, near: float, own: int, floor: int, k: int, metric: Metric) -> tuple[list[tuple[int, int]], int]:
    """The ``k`` best ``(score, id)`` of a tree whose score reaches ``floor``, and how many products were computed.

    ``near`` is the query's distance to the object above the root. Pages wait in a queue by the least distance anything
    below them can have; the search ends where that lies beyond the k-th score. A stored distance to the parent object bounds an
    entry's distance from both sides, so entries out of reach cost no product.
    """
    q2 = float((q.astype(np.float64) ** 2).sum())
    slack = metric.slack(q2)
    best: list[tuple[int, int]] = []  # (score, -id), the worst first

    def reach() -> float:
        least = max(floor, best[0][0]) if len(best) == k else floor
        return float("inf") if least == NO_FLOOR else float(metric.to_products(q2, np.float64(least))) + slack

    queue, order, limit, computed = [(0.0, 0, 0, near)], 0, reach(), 0
    while queue:
        least, _, at, above = heapq.heappop(queue)
        if least > limit:
            break
        page = pages[at]
        some = np.flatnonzero(np.abs(above - page.dist) - page.radius <= limit)
        if not len(some):
            continue
        computed += len(some)
        products = page.objects[some] @ q
        if page.leaf:
            worst = best[0][0] if len(best) == k else NO_FLOOR
            for j in np.flatnonzero(products >= max(floor, worst)):
                o, score = some[j], int(products[j])
                owned = page.ids[page.child[o - 1] if o else 0 : page.child[o]][: k + 1].tolist()
                for i in owned:
                    if i != own:
                        if len(best) < k:
                            heapq.heappush(best, (score, -i))
                        elif (score, -i) > best[0]:
                            heapq.heapreplace(best, (score, -i))
            limit = reach()
        else:
            away = metric.to_products(q2, products)
            bounds = np.maximum(0.0, away - page.radius[some])
            for j in np.flatnonzero(bounds <= limit):
                order += 1
                heapq.heappush(queue, (float(bounds[j]), order, int(page.child[some[j]]), float(away[j])))
    return sorted(((s, -i) for s, i in best), key=lambda b: (-b[0], b[1])), computed


def exact_top(rows: DataFrame, queries: DataFrame, k: int = 10, factor: int = 1024, tree_rows: int = TREE_ROWS, routes: int = ROUTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product of each query, exactly, best first.

    Both frames have ``vec_id`` and ``embedding``; components count as ``floor(factor * x)``. Ties go to the smaller
    vec_id. A row with the query's own vec_id is no candidate. Fewer rows than ``k`` are all returned.

    Every row goes to the nearest of at most ``routes`` routing objects, and there to one of several trees of about
    ``tree_rows`` rows, so neither a dense region nor copies of a vector make a long task. Trees are written page by page.
    A query searches one tree below its nearest routing object first. The k-th score is its floor: of all other trees, those
    whose covering radius shows that they hold nothing as good are not searched, and the others give only rows that reach it.
    Queries travel in packed rows. The driver sees a count and a radius for each routing object.

    See :func:`whole_vectors` for rows that take no part; nor do vectors whose length is not the most common one (ties: the
    shorter). Wholly equal rows count once, different vectors under one id by their scores. No rows: no rows. Other
    columns are left out.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    base = stage(whole_vectors(rows, factor), "mtree-rows")
    told = common_length(base)
    if not told:
        return spark.createDataFrame([], schema)
    width, total, top = told
    base = base.where(F.size("v") == width)
    asked = whole_vectors(queries, factor).where(F.size("v") == width).withColumnRenamed("vec_id", "query_id")
    largest = asked.agg(F.max(squared_length(F.col("v"))).alias("top")).first()["top"]
    if largest is None:
        return spark.createDataFrame([], schema)
    metric = Metric(top, number_type(max(top, largest), width))
    kind = metric.kind

    wanted = max(1, min(-(-total // tree_rows), routes))
    sample = base.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLED * wanted).select("v").toArrow()
    found = np.unique(matrix(sample.column("v").combine_chunks(), kind), axis=0)
    pick = np.random.default_rng(5).choice(len(found), min(wanted, len(found)), replace=False)
    pivots = found[np.sort(pick)]
    sent = spark.sparkContext.broadcast((pivots, metric.lifted(pivots)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = sent.value[1]
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                x = matrix(part.column("v"), kind)
                lifted = metric.lifted(x)
                nearest = (lifted @ above.T).argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest.astype(np.int32)), pa.array(_gaps(lifted, above[nearest])), part.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["route", "dist", "vec_id", "v"],
                )

    placed = stage(base.mapInArrow(place, "route int, dist double, vec_id long, v binary"), "mtree-placed")
    below = {r["route"]: (r["n"], r["radius"]) for r in placed.groupBy("route").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).collect()}
    parts = [max(1, -(-below.get(i, (0, 0.0))[0] // tree_rows)) for i in range(len(pivots))]
    radii = np.array([below.get(i, (0, -np.inf))[1] for i in range(len(pivots))])
    parts_of = F.get(F.array(*[F.lit(p) for p in parts]), F.col("route"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(group["v"]), kind).reshape(len(group), -1)
        route, part = int(group["route"].iloc[0]), int(group["part"].iloc[0])
        pages = build(x, group["vec_id"].to_numpy(), sent.value[1][route], metric)
        made = [(route, part, i, *p.packed()) for i, p in enumerate(pages)]
        return pd.DataFrame(made, columns=[f.split()[0] for f in PAGES.split(", ")])

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), parts_of).cast("int"))
    trees = stage(dealt.groupBy("route", "part").applyInPandas(grow, PAGES), "mtree-pages")

    packed = "route int, part int, home int, ids binary, qs binary, near binary, floors binary, homes binary"

    def probe(first: bool):
        """Packed queries for the trees to search: one below the nearest routing object, or later those within reach."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres = sent.value[0]
            for batch in batches:
                for i in range(0, batch.num_rows, PACK):
                    part = batch.slice(i, PACK)
                    q, ids = matrix(part.column("v"), kind), part.column("query_id").to_numpy()
                    q2 = (q.astype(np.float64) ** 2).sum(1)
                    near = metric.to_products(q2[:, None], q @ centres.T)
                    home = np.where(radii >= 0, near, np.inf).argmin(1)
                    part_of_home = np.abs(ids) % np.array(parts)[home]
                    floors = np.full(len(q), NO_FLOOR) if first else part.column("floor").to_numpy()
                    if first:
                        keys = home * max(parts) + part_of_home
                        groups = [(int(home[g[0]]), int(part_of_home[g[0]]), g) for key in np.unique(keys) for g in [np.flatnonzero(keys == key)]]
                    else:
                        limit = np.array([metric.to_products(a, f) + metric.slack(a) if f > NO_FLOOR else np.inf for a, f in zip(q2, floors)])
                        # nothing is left to search where the home tree is the only one
                        within = (near - radii <= limit[:, None]) & (radii >= 0) & ~((np.arange(len(parts)) == home[:, None]) & (np.array(parts) == 1))
                        groups = [(r, -1, np.flatnonzero(within[:, r])) for r in np.flatnonzero(within.any(0)).tolist()]
                    out = [
                        (r, p, 0, ids[g].tobytes(), q[g].tobytes(), near[g, r].tobytes(), floors[g].tobytes(), np.where(home[g] == r, part_of_home[g], -1).tobytes())
                        for r, p, g in groups
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, [pa.int32()] * 3 + [pa.binary()] * 5)], [f.split()[0] for f in packed.split(", ")]
                    )

        return run

    def look(key, pages: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        part, out = int(key[1]), []
        tree = {int(r.node): Page.of(r, width, kind) for r in pages.itertuples()}
        for p in probes.itertuples() if tree else ():
            ids, qs = np.frombuffer(p.ids, np.int64), np.frombuffer(p.qs, kind).reshape(-1, width)
            near, floors, homes = np.frombuffer(p.near, np.float64), np.frombuffer(p.floors, np.int64), np.frombuffer(p.homes, np.int64)
            for i in range(len(ids)):
                if p.home or homes[i] != part:  # a later probe leaves out the tree that was searched first
                    out += [(int(ids[i]), n, s) for s, n in search(tree, qs[i], near[i], int(ids[i]), int(floors[i]), k, metric)[0]]
        ids, names, scores = zip(*out) if out else ((), (), ())
        return pd.DataFrame({"query_id": pd.Series(ids, dtype="int64"), "vec_id": pd.Series(names, dtype="int64"), "score": pd.Series(scores, dtype="int64")})

    def searched(probes: DataFrame) -> DataFrame:
        """What the probed trees give, cell by cell: a tree and a bounded number of packed queries."""
        probes = stage(probes.withColumn("pack", F.monotonically_increasing_id()), "mtree-probes")
        most = probes.groupBy("route", "part").count().groupBy("route").agg(F.max("count").alias("n"))
        counts = {r["route"]: -(-r["n"] // CELL_PACKS) for r in most.collect()}
        slots = [counts.get(i, 0) for i in range(len(pivots))]
        slots_of = F.get(F.array(*[F.lit(n) for n in slots]), F.col("route"))
        slot = F.pmod(F.xxhash64("pack"), slots_of).cast("int")
        pages = trees.where(slots_of > 0).withColumn("slot", F.explode(F.sequence(F.lit(0), slots_of - 1)))
        cells = probes.withColumn("slot", slot).groupBy("route", "part", "slot")
        return pages.groupBy("route", "part", "slot").cogroup(cells).applyInPandas(look, "query_id long, vec_id long, score long")

    def ranked(some: DataFrame) -> DataFrame:
        best = some.withColumn("rank", F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score").distinct()

    asked = stage(asked, "mtree-queries")
    first = stage(ranked(searched(asked.mapInArrow(probe(True), packed).withColumn("home", F.lit(1)))), "mtree-first")
    floors = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    floored = asked.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR)))
    later = floored.mapInArrow(probe(False), packed)
    later = later.withColumn("part", F.explode(F.sequence(F.lit(0), parts_of - 1)))
    return ranked(first.select("query_id", "vec_id", "score").union(searched(later)))
