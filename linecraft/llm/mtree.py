"""Exact top-k inner products by best-first search in M-trees.

Vectors are dealt to the nearest of some pivots, and each pivot's vectors, in
shards of bounded size, become one M-tree: pages with a routing vector, a
covering radius and the distance to the parent's routing vector; leaf entries
keep their distance to the leaf's. The pivots with their radii are the tree's
top level.

An inner product is turned into a distance: every vector x of a shard gets one
more component sqrt(M^2 - |x|^2), M being the shard's largest norm, a query q
gets 0; then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the nearest vectors are those
of the highest score. Pages are taken by their smallest possible distance; a
page or entry whose stored distances already show, by the triangle inequality,
that it lies too far is not computed. Scores are exact integers.

Each query first searches one shard of its own pivot, which gives a bound; then
only the shards whose pivot and radius allow a better score. Queries go to
shards in blocks.

Pivots come from a bounded sample (``SAMPLE`` rows, those with the smallest
hashes); every vector is indexed. Rows whose vector or vec_id is null, or whose
vector holds null or non-finite components, take no part; a component that is no
long times 256 raises, and so does a score among the results that is no long.
Scores that may pass 53 or 63 bits are made with wider arithmetic. Shorter
vectors are filled up with zeros. Rows that share the query's vec_id are its
own and no candidates; equal query rows count once. Ties go to the smaller
vec_id. Repeated candidates each count. Extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import release, stored

TOP, EVERY = 5, 50
#: Vectors per shard (about), shards made of a small table, and pivots at most.
SHARD, FEW, MOST_PIVOTS = 8192, 64, 4096
SAMPLE = 4 * MOST_PIVOTS
#: Children of an inner page, entries of a leaf.
FANOUT, LEAF = 16, 96
#: Queries of a block (about).
BLOCK = 1024
#: Slack for rounding in distances, relative to the largest one.
SLACK = 1e-9


# --- one tree ----------------------------------------------------------------


class Tree:
    """Pages as arrays. Page 0 is the root. Pages: routing row, radius, distance
    to the parent's routing row, first child or entry, number of them, leaf."""

    FIELDS = ("ids", "vectors", "to_leaf", "route", "radius", "to_parent", "first", "count", "leaf")

    def __init__(self, ids, vectors, to_leaf, route, radius, to_parent, first, count, leaf):
        self.ids, self.vectors, self.to_leaf = ids, vectors, to_leaf
        self.route, self.radius, self.to_parent = route, radius, to_parent
        self.first, self.count, self.leaf = first, count, leaf
        norms = (vectors.astype(float) ** 2).sum(1)
        self.most = float(norms.max()) if len(norms) else 0.0
        self.points = np.hstack([vectors, np.sqrt(np.maximum(self.most - norms, 0))[:, None]])
        self.pivots = self.points[route] if len(route) else self.points[:0]
        self.reach = float(np.abs(vectors.astype(float)).max(initial=0)) * max(1, vectors.shape[1])

    @staticmethod
    def build(ids: np.ndarray, vectors: np.ndarray) -> Tree:
        norms = (vectors.astype(float) ** 2).sum(1)
        points = np.hstack([vectors, np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))[:, None]])
        pages: list[list] = []
        order: list[np.ndarray] = []
        to_leaf: list[np.ndarray] = []
        placed = 0

        def distance(rows, to):
            return np.sqrt(((points[rows] - points[to]) ** 2).sum(1))

        queue = [(np.arange(len(ids)), -1)]
        at = 0
        while at < len(queue):
            rows, parent = queue[at]
            centre = points[rows].mean(0)
            route = int(rows[((points[rows] - centre) ** 2).sum(1).argmin()])
            far = distance(rows, route)
            up = float(np.sqrt(((points[route] - points[pages[parent][0]]) ** 2).sum())) if parent >= 0 else 0.0
            page = [route, float(far.max()), up, 0, 0, len(rows) <= LEAF]
            pages.append(page)
            if page[5]:
                page[3], page[4] = placed, len(rows)
                placed += len(rows)
                order.append(rows)
                to_leaf.append(far)
            else:
                parts = _parts(points, rows)
                page[3], page[4] = len(queue), len(parts)
                queue += [(p, at) for p in parts]
            at += 1
        rows = np.concatenate(order)
        back = np.empty(len(ids), np.int64)
        back[rows] = np.arange(len(ids))
        cols = list(zip(*pages, strict=True))
        return Tree(
            ids[rows],
            vectors[rows],
            np.concatenate(to_leaf),
            back[np.array(cols[0])],
            np.array(cols[1]),
            np.array(cols[2]),
            np.array(cols[3]),
            np.array(cols[4]),
            np.array(cols[5], bool),
        )

    def search(self, query: np.ndarray, own: int, top: int, least: int | None) -> list[tuple[int, int]]:
        """(score, id) of the best candidates, ``least`` being a score that the
        result need not go below."""
        q = np.append(query, 0).astype(float)
        square = float(q @ q) + self.most
        # no sum of products is larger than this
        largest = float(np.abs(q).max(initial=0)) * self.reach
        slack = SLACK * (np.sqrt(square) + 1) * 4
        best: list[tuple[int, int]] = []

        def reach() -> float:
            floor = best[-1][0] if len(best) == top else None
            if least is not None:
                floor = least if floor is None else max(floor, least)
            return np.inf if floor is None else np.sqrt(max(square - 2.0 * floor, 0.0)) + slack

        d = float(np.sqrt(((self.pivots[0] - q) ** 2).sum()))
        heap = [(max(d - self.radius[0], 0.0), 0, d)]
        while heap:
            nearest, page, d = heapq.heappop(heap)
            limit = reach()
            if nearest > limit:
                break
            lo, hi = self.first[page], self.first[page] + self.count[page]
            if self.leaf[page]:
                rows = lo + np.flatnonzero(np.abs(d - self.to_leaf[lo:hi]) <= limit)
                rows = rows[self.ids[rows] != own]
                if len(rows) == 0:
                    continue
                part = self.vectors[rows]
                if largest < 2.0**53:
                    score = (part @ query.astype(float)).astype(np.int64)
                elif largest < 2.0**62:
                    score = part.astype(np.int64) @ query
                else:
                    score = part.astype(object) @ query.astype(object)
                if len(rows) > top:
                    pick = np.lexsort((self.ids[rows], -score))[:top]
                    rows, score = rows[pick], score[pick]
                best += zip(score.tolist(), self.ids[rows].tolist(), strict=True)
                best.sort(key=lambda x: (-x[0], x[1]))
                del best[top:]
            else:
                kids = np.arange(lo, hi)
                kids = kids[np.abs(d - self.to_parent[lo:hi]) - self.radius[lo:hi] <= limit]
                to = np.sqrt(((self.pivots[kids] - q) ** 2).sum(1))
                low = np.maximum(to - self.radius[kids], 0.0)
                for k, b, x in zip(kids.tolist(), low.tolist(), to.tolist(), strict=True):
                    if b <= limit:
                        heapq.heappush(heap, (b, k, x))
        return best

    def dump(self) -> bytes:
        import io

        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Tree:
        import io

        with np.load(io.BytesIO(data)) as z:
            return Tree(*(z[f] for f in Tree.FIELDS))


def _parts(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows by the nearest of a few far-apart ones; equal rows are cut evenly."""
    step = max(1, len(rows) // (8 * FANOUT))
    sample = rows[::step]
    chosen = [int(sample[0])]
    far = ((points[sample] - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < FANOUT and far.max() > 0:
        chosen.append(int(sample[far.argmax()]))
        far = np.minimum(far, ((points[sample] - points[chosen[-1]]) ** 2).sum(1))
    c = points[chosen]
    near = ((c**2).sum(1)[None] - 2 * points[rows] @ c.T).argmin(1)
    parts = [rows[near == k] for k in range(len(chosen))]
    parts = [p for p in parts if len(p)]
    if len(parts) < 2:
        return np.array_split(rows, FANOUT)
    return parts


# --- vectors as rows ---------------------------------------------------------


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: floor(256 x) of each component, rows that take part only."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * 256)
    fine = F.forall("scaled", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("scaled"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("scaled").isNotNull() & fine)
    wide = F.raise_error(F.lit("256 times a component is no long"))
    whole = F.transform("scaled", lambda x: F.when(F.abs(x) < 2.0**62, F.floor(x)).otherwise(wide.cast("bigint")))
    return rows.select("vec_id", whole.alias("v"))


def _matrix(column, width: int) -> np.ndarray:
    """A list column as an array of ``width`` columns, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(column), width), np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = flat
    return out


def _dealer(pivots: np.ndarray):
    """Adds the nearest pivot and the distance to it."""
    square = (pivots**2).sum(1)

    def deal(batches):
        for b in batches:
            v = _matrix(b["v"], pivots.shape[1])
            near = (square[None] - 2 * v @ pivots.T).argmin(1) if b.num_rows else np.zeros(0, int)
            far = np.sqrt(((v - pivots[near]) ** 2).sum(1))
            cols = [b["vec_id"], b["v"], pa.array(near, pa.int32()), pa.array(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "v", "pivot", "far"])

    return deal


def _builder(width: int):
    def build(key, rows):
        tree = Tree.build(rows["vec_id"].to_numpy(), _matrix(rows["v"], width))
        cols = [pa.array([k.as_py()], t) for k, t in zip(key, (pa.int32(), pa.int64()), strict=True)]
        return pa.table([*cols, pa.array([tree.dump()], pa.binary())], ["pivot", "salt", "tree"])

    return build


FOUND = "query_id bigint, q array<bigint>, vec_id bigint, score bigint"


def _searcher(width: int, top: int):
    def search(_, shards, queries):
        out: tuple[list, list, list, list] = ([], [], [], [])
        if shards.num_rows and queries.num_rows:
            tree = Tree.load(shards["tree"][0].as_py())
            q = _matrix(queries["v"], width)
            raw = queries["v"].to_pylist()
            least = queries["least"].to_pylist()
            for i, own in enumerate(queries["vec_id"].to_pylist()):
                for score, found in tree.search(q[i], own, top, least[i]):
                    for c, x in zip(out, (own, raw[i], found, score), strict=True):
                        c.append(x)
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["query_id", "q", "vec_id", "score"])

    return search


def _router(pivots: np.ndarray, radius: np.ndarray):
    """The pivots whose vectors may reach a query's bound: q.x is at most
    q.p + |q| r for x within r of p."""

    norms = np.sqrt((pivots**2).sum(1))
    radius = np.where(np.isfinite(radius), radius, 0.0)  # no vectors there; no shard either

    def route(batches):
        for b in batches:
            v = _matrix(b["v"], pivots.shape[1]).astype(float)
            size = np.sqrt((v**2).sum(1))
            bound = v @ pivots.T + size[:, None] * radius[None]
            bound += SLACK * (size[:, None] * (norms + np.abs(radius))[None] + 1)
            least = np.array([-np.inf if x is None else float(x) for x in b["least"].to_pylist()])
            able = [np.flatnonzero(r) for r in bound >= least[:, None]] if b.num_rows else []
            yield b.append_column("pivots", pa.array(able, pa.list_(pa.int32())))

    return route


def _searched(index: DataFrame, asks: DataFrame, width: int, top: int) -> DataFrame:
    """Queries (``pivot, salt, vec_id, v, least``) meet their shard in blocks."""
    sizes = asks.groupBy("pivot", "salt").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = asks.join(sizes, ["pivot", "salt"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    shards = index.join(sizes, ["pivot", "salt"]).select(
        "pivot", "salt", "tree", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")
    )
    key = ["pivot", "salt", "block"]
    return shards.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(_searcher(width, top), FOUND)


def _top(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def top_scores(vectors: DataFrame, is_query, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` highest scores of each row
    for which the condition ``is_query`` on ``vec_id`` holds.

    ``vectors`` has ``vec_id, embedding``.
    """
    spark = vectors.sparkSession
    rows = stored(whole_numbers(vectors), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not n:
        return empty
    width = max(1, width)
    shards = max(-(-n // SHARD), min(FEW, -(-n // 128)))
    want = min(shards, MOST_PIVOTS)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 4 * want)).select("v").toArrow()["v"]
    pivots = np.unique(_matrix(sample, width), axis=0)
    pivots = pivots[np.random.default_rng(0).permutation(len(pivots))[:want]].astype(float)
    dealt = stored(rows.mapInArrow(_dealer(pivots), "vec_id bigint, v array<bigint>, pivot int, far double"), "dealt")
    # at most MOST_PIVOTS rows
    known = {r["pivot"]: r for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    size = max(1, -(-n // shards))
    radius = np.array([known[p]["far"] if p in known else -np.inf for p in range(len(pivots))])
    cuts = spark.createDataFrame([(p, -(-r["n"] // size)) for p, r in known.items()], "pivot int, salts bigint")
    salted = dealt.join(F.broadcast(cuts), "pivot").withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("salts")))
    index = stored(
        salted.select("pivot", "salt", "vec_id", "v")
        .groupBy("pivot", "salt")
        .applyInArrow(_builder(width), "pivot int, salt bigint, tree binary"),
        "trees",
    )
    queries = salted.where(is_query).select("pivot", "salt", "vec_id", "v").distinct()
    first = stored(
        _searched(index, queries.withColumn("least", F.lit(None).cast("bigint")), width, top), "first"
    )
    # the bound: the last of `top` scores found so far
    bound = first.groupBy("query_id", "q").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    bound = bound.select(F.col("query_id").alias("vec_id"), F.col("q").alias("v"), F.when(F.col("n") >= top, F.col("low")).alias("least"))
    asked = queries.select("vec_id", "v", F.col("pivot").alias("own"), F.col("salt").alias("own_salt")).join(bound, ["vec_id", "v"], "left")
    routed = (
        asked.mapInArrow(
            _router(pivots, radius),
            "vec_id bigint, v array<bigint>, own int, own_salt bigint, least bigint, pivots array<int>",
        )
        .select("vec_id", "v", "own", "own_salt", "least", F.explode("pivots").alias("pivot"))
        .join(F.broadcast(cuts), "pivot")
        .select("vec_id", "v", "own", "own_salt", "least", "pivot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"))
        .where("not (pivot = own and salt = own_salt)")
        .select("pivot", "salt", "vec_id", "v", "least")
    )
    routed = stored(routed, "routed")
    more = _searched(index, routed, width, top)
    out = stored(_top(first.unionByName(more), top).select("query_id", "rank", "vec_id", "score"), "top")
    release(rows, dealt, index, first, routed)
    return out


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op2``."""
    return top_scores(vectors, F.col("vec_id") % EVERY == 0)
