"""Exact top-k search by inner product: a ball tree for each shard, branch and bound, a shared k-th score."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import written

TREE_POINTS = 8192  # of one tree; also bounds a row of the written trees
SHARDS = 4096  # at most; a shard that grows beyond that holds more trees
LEAF_POINTS = 64
CROWD = 4096  # queries that meet a tree in one piece
FIRST, FACTOR = 1, 8  # shards of a query's first round; growth from round to round
SAMPLE = 40_000  # vectors that the planes between shards are fitted on, at most; all are searched
SEED = 12
_SLACK = 1e-9  # relative; bounds are rounded up, sums of integers are exact
_EXACT = 2 ** 53


def usable(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, vector (floor of ``scale`` times each component, packed doubles) of the rows that take part."""
    e = F.col("embedding")
    fine = F.coalesce(F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "vec_id": batch["vec_id"],
                "vector": [np.floor(scale * np.asarray(v, dtype=np.float64)).astype("<f8").tobytes() for v in batch["embedding"]],
            })

    return vectors.where(F.col("vec_id").isNotNull() & fine & (F.size(e) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")
    ).mapInPandas(packed, "vec_id long, vector binary")


def _matrix(column: pd.Series, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(-1, dimension)


class Split:
    """Planes that deal vectors into 2^depth near-by groups: halves along the direction between two far points of a sample."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.depth = max(0, math.ceil(math.log2(max(shards, 1))))
        inner = (1 << self.depth) - 1
        self.normal = np.zeros((inner, sample.shape[1]))
        self.cut = np.zeros(inner)
        held = {0: sample}
        for k in range(inner):
            own = held.pop(k)
            if len(own):
                self.normal[k] = _far_direction(own)
                self.cut[k] = float(np.median(own @ self.normal[k]))
            left = own @ self.normal[k] <= self.cut[k]
            if 2 * k + 1 < inner:
                held[2 * k + 1], held[2 * k + 2] = own[left], own[~left]

    def shard(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + ((x * self.normal[at]).sum(axis=1) > self.cut[at])
        return at - ((1 << self.depth) - 1)


def _far_direction(points: np.ndarray) -> np.ndarray:
    """Unit vector between two points far apart; zeros where all are equal."""
    a = points[np.argmax(((points - points[0]) ** 2).sum(axis=1))]
    b = points[np.argmax(((points - a) ** 2).sum(axis=1))]
    length = float(np.sqrt(((b - a) ** 2).sum()))
    return (b - a) / length if length > 0 else np.zeros(points.shape[1])


def ball_tree(points: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]], np.ndarray, np.ndarray]:
    """Order of the points, nodes (start, end, left child, right child; -1 for leaves), centres, radii.

    A node's ball holds its points; halves at the median along a far direction, so equal points split by place.
    """
    order = np.arange(len(points))
    nodes: list[list[int]] = [[0, len(points), -1, -1]]
    centres, radii = [], []
    k = 0
    while k < len(nodes):
        start, end, _, _ = nodes[k]
        own = points[order[start:end]]
        centre = own.mean(axis=0)
        centres.append(centre)
        radii.append(math.sqrt(float(((own - centre) ** 2).sum(axis=1).max())) * (1 + _SLACK))
        if end - start > LEAF_POINTS:
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own @ _far_direction(own), middle)]
            nodes[k][2:] = len(nodes), len(nodes) + 1
            nodes += [[start, start + middle, -1, -1], [start + middle, end, -1, -1]]
        k += 1
    return order, [tuple(n) for n in nodes], np.array(centres), np.array(radii)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64; sums beyond a long stop at its ends."""
    reach = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    if reach < _EXACT:
        return (q @ x.T).astype(np.int64)

    def whole(m: np.ndarray) -> np.ndarray:
        return np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape)

    return np.clip(whole(q) @ whole(x).T, -(2 ** 63), 2 ** 63 - 1).astype(np.int64)


def _cut_top(best: pd.DataFrame, top: int) -> pd.DataFrame:
    best = best.sort_values(["query", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return best[best.groupby("query", sort=False).cumcount() < top]


def _upper_bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """q.c + |q| r for each query and ball, rounded up."""
    norms = np.sqrt((q * q).sum(axis=1))[:, None]
    slack = _SLACK * (norms * (np.sqrt((centres ** 2).sum(axis=1)) + radii)[None] + 1)
    return q @ centres.T + norms * radii[None] + slack


def search_tree(q, own_ids, worst, x, ids, tree, top):
    """Rows (query, vec_id, score), up to ``top`` of the tree's points for each query that can still be in its answer; and how many
    products were formed.

    A leaf's bound is the smallest of its own and its ancestors'. Each query takes leaves from the greatest bound down, in waves of
    1, 2, 4 … leaves, and only those whose bound reaches the k-th score known by then; in a wave, a leaf is multiplied with all
    queries that ask for it at once.
    """
    order, nodes, centres, radii = tree
    floor = worst.copy()  # smallest score still wanted; ties may win by a smaller id
    bound = _upper_bounds(q, centres, radii)
    for k, (_, _, left, right) in enumerate(nodes):  # parents come before children
        if left >= 0:
            bound[:, [left, right]] = np.minimum(bound[:, [left, right]], bound[:, [k]])
    leaves = np.array([k for k, n in enumerate(nodes) if n[2] < 0])
    bound = bound[:, leaves]
    turn = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, turn, axis=1)
    best = pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype("int64")
    start, width, formed = 0, 1, 0
    while start < len(leaves):
        rows, columns = np.nonzero(bound[:, start:start + width] >= floor[:, None])
        if not len(rows):
            break
        asked = leaves[turn[rows, start + columns]]
        by_leaf = np.argsort(asked, kind="stable")
        rows, asked = rows[by_leaf], asked[by_leaf]
        starts = np.flatnonzero(np.r_[True, asked[1:] != asked[:-1]])
        parts = [best]
        for first, last in zip(starts, np.r_[starts[1:], len(asked)], strict=True):
            low, high = nodes[asked[first]][:2]
            members, own = order[low:high], rows[first:last]
            scores = _products(q[own], x[members])
            formed += scores.size
            r, c = np.nonzero((scores >= floor[own][:, None]) & (ids[members][None] != own_ids[own][:, None]))
            parts.append(pd.DataFrame({"query": own[r], "vec_id": ids[members[c]], "score": scores[r, c]}))
        best = _cut_top(pd.concat(parts), top)
        full = best.groupby("query")["score"].agg(["size", "min"])
        full = full[full["size"] == top]
        at = full.index.to_numpy()
        floor[at] = np.maximum(floor[at], full["min"].to_numpy())
        start, width = start + width, width * 2
    return best, formed


def _packed_whole(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest type that holds them."""
    reach = float(np.abs(x).max(initial=0))
    kind = "<i2" if reach < 2 ** 15 else "<i4" if reach < 2 ** 31 else "<f8"
    return kind, x.astype(kind).tobytes()


def _planted(points: pd.DataFrame, dimension: int) -> pd.DataFrame:
    """The ball tree of one piece of a shard as one row: points in the tree's order, nodes, balls."""
    x = _matrix(points["vector"], dimension)
    order, nodes, centres, radii = ball_tree(x)
    kind, packed = _packed_whole(x[order])
    return pd.DataFrame({
        "shard": [points["shard"].iloc[0]], "kind": [kind], "points": [packed],
        "ids": [points["vec_id"].to_numpy()[order].astype("<i8").tobytes()], "nodes": [np.array(nodes, dtype="<i4").tobytes()],
        "centres": [centres.astype("<f8").tobytes()], "radii": [radii.astype("<f8").tobytes()],
        "centre": [centres[0].astype("<f8").tobytes()], "radius": [float(radii[0])],
    })


TREE_ROW = "shard long, kind string, points binary, ids binary, nodes binary, centres binary, radii binary, centre binary, radius double"


def _around(balls: pd.DataFrame, dimension: int) -> pd.DataFrame:
    """One ball around the trees of a shard."""
    centres = _matrix(balls["centre"], dimension)
    centre = centres.mean(axis=0)
    reach = np.sqrt(((centres - centre) ** 2).sum(axis=1)) + balls["radius"].to_numpy()
    return pd.DataFrame({"shard": [balls["shard"].iloc[0]], "centre": [centre.tobytes()], "radius": [float(reach.max()) * (1 + _SLACK)]})


def top_search(vectors: DataFrame, every: int = 50, top: int = 5, scale: float = 256.0) -> DataFrame:
    """The ``top`` greatest integer inner products for each vector whose id is divisible by ``every``.

    Components become floor(scale * x). Planes fitted on a bounded sample deal all vectors into at most SHARDS shards of near-by ones,
    and a hash cuts a shard into pieces of about TREE_POINTS, each with a ball tree that is built once and written. The shards'
    own balls go to the driver (SHARDS rows at most). Each query meets shards by the upper bound of their balls, the best one
    first and more in each later round, as long as the bound reaches its k-th score so far; that score comes from all shards of the
    rounds before and goes along with the query, so that a later shard opens only nodes that can still change the answer.
    A round is a join of crowds of about CROWD queries with trees. The result is exact at every size: bounds only
    leave out what cannot be in an answer, and nothing else ends a search.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Null and empty vectors, those with null or non-finite
    components, rows without an id, and vectors not of the most common length take no part; zero vectors do. Rows that
    repeat a vec_id are candidates each, never their own query's; the least of them by its bytes asks. Queries without
    candidates give no rows; scores beyond a long stop at its ends; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    packed = written(usable(vectors, scale))
    common = packed.groupBy(F.length("vector").alias("_bytes")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_bytes").first()
    if common is None:
        return empty
    packed = packed.where(F.length("vector") == common["_bytes"])
    dimension = common["_bytes"] // 8
    sample = packed.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()
    split = Split(_matrix(sample["vector"], dimension), min(SHARDS, -(-common["n"] // TREE_POINTS)))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(shard=split.shard(_matrix(batch["vector"], dimension)))

    placed = packed.mapInPandas(dealt, "vec_id long, vector binary, shard long")
    pieces = placed.groupBy("shard").agg(F.ceil(F.count("*") / TREE_POINTS).alias("_pieces"))  # SHARDS rows at most
    trees = written(
        placed.join(F.broadcast(pieces), "shard")
        .withColumn("_piece", F.pmod(F.xxhash64("vec_id", "vector"), F.col("_pieces"))).drop("_pieces")
        .groupBy("shard", "_piece").applyInPandas(lambda rows: _planted(rows, dimension), TREE_ROW)
    ).withColumn("piece", F.xxhash64("ids"))
    balls = (
        trees.select("shard", "centre", "radius").groupBy("shard")
        .applyInPandas(lambda rows: _around(rows, dimension), "shard long, centre binary, radius double").orderBy("shard").toPandas()
    )
    shards, centres, radii = balls["shard"].to_numpy(), _matrix(balls["centre"], dimension), balls["radius"].to_numpy()
    asked = packed.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))

    def routed(start: int, size: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                bound = _upper_bounds(_matrix(batch["vector"], dimension), centres, radii)
                order = np.argsort(-bound, axis=1, kind="stable")[:, start:start + size]
                rows, columns = np.nonzero(np.take_along_axis(bound, order, axis=1) >= batch["worst"].to_numpy()[:, None])
                yield batch.iloc[rows].assign(shard=shards[order[rows, columns]])

        return run

    def searched(queries: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")]
        if len(queries):
            q, own = _matrix(queries["vector"], dimension), queries["query_id"].to_numpy()
            for t in tree.itertuples():
                x = np.frombuffer(t.points, dtype=t.kind).astype("<f8").reshape(-1, dimension)
                nodes = [tuple(n) for n in np.frombuffer(t.nodes, dtype="<i4").reshape(-1, 4).tolist()]
                planted = np.arange(len(x)), nodes, np.frombuffer(t.centres, dtype="<f8").reshape(-1, dimension), np.frombuffer(t.radii, dtype="<f8")
                best, _ = search_tree(q, own, queries["worst"].to_numpy(), x, np.frombuffer(t.ids, dtype="<i8"), planted, top)
                parts.append(pd.DataFrame({"query_id": own[best["query"].to_numpy()], "vec_id": best["vec_id"], "score": best["score"]}))
        return pd.concat(parts)

    lowest = F.lit(-(2 ** 63))
    best: DataFrame | None = None
    start, size = 0, FIRST
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while start < len(shards):
        if best is None:
            now = asked.withColumn("worst", lowest)
        else:
            kth = best.where(F.col("rank") == top).select("query_id", F.col("score").alias("worst"))
            now = asked.join(kth, "query_id", "left").withColumn("worst", F.coalesce("worst", lowest))
        pairs = written(now.mapInPandas(routed(start, size), "query_id long, vector binary, worst long, shard long"))
        crowds = pairs.groupBy("shard").agg(F.ceil(F.count("*") / CROWD).alias("_crowds"))  # SHARDS rows at most
        held = trees.select(F.col("shard").alias("_shard"), F.col("piece").alias("tree"))
        left = (
            pairs.join(F.broadcast(crowds), "shard").withColumn("crowd", F.pmod(F.xxhash64("query_id"), F.col("_crowds"))).drop("_crowds")
            .join(held, F.col("shard") == F.col("_shard")).select(F.col("_shard").alias("at"), "tree", "crowd", "query_id", "vector", "worst")
        )
        right = trees.join(F.broadcast(crowds), "shard").withColumn(
            "crowd", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_crowds") - 1))
        ).drop("_crowds")
        found = left.groupBy("at", "tree", "crowd").cogroup(right.groupBy("shard", "piece", "crowd")).applyInPandas(searched, "query_id long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.select("query_id", "vec_id", "score"))
        best = written(found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= top))
        start, size = start + size, size * FACTOR
    return empty if best is None else best.select("query_id", "rank", "vec_id", "score")
