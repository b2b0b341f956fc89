"""Approximate nearest neighbours: stable projections, a kd-tree, and a chi-square stopping test."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import written

PROJECTED = 8  # dimensions; an even number
CONFIDENCE = 0.95  # that a true neighbour was not yet passed when the search stops
LEAF_POINTS = 2048
LEAVES = 4096  # at most
SAMPLE = 40_000  # vectors that the tree's planes are fitted on, at most; all are indexed
GROUP_POINTS, GROUP_QUERIES = 4096, 1024  # of one task's matrix product
FIRST, FACTOR = 1, 8  # leaves of the first round; growth from round to round
SEED = 5
_SLACK = 1e-9  # relative; near ties are decided by the exact sums


def chi_square_quantile(p: float, m: int) -> float:
    """For even m the distribution function is closed: 1 - exp(-x/2) * sum of (x/2)^i / i! for i < m/2."""
    low, high = 0.0, 100.0 * m
    for _ in range(200):
        x = (low + high) / 2
        if 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2)) < p:
            low = x
        else:
            high = x
    return high


class Projection:
    """Vectors are lengthened by sqrt(top^2 - |x|^2) (queries by 0), so that the largest inner product is the
    smallest distance; then Gaussian projections keep distances in the chi-square sense."""

    def __init__(self, dimension: int, top: float):
        self.top = top
        self.matrix = np.random.default_rng(SEED).normal(size=(dimension + 1, PROJECTED))

    def points(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top ** 2 - (x * x).sum(axis=1), 0))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]


class Tree:
    """A kd-tree's planes as arrays; node k has children 2k + 1 and 2k + 2. Medians along the widest side."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.depth = max(0, math.ceil(math.log2(max(leaves, 1))))
        inner = (1 << self.depth) - 1
        self.axis = np.zeros(inner, dtype=np.int64)
        self.cut = np.full(inner, np.inf)
        held = {0: sample}
        for k in range(inner):
            own = held.pop(k)
            if len(own):
                self.axis[k] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                self.cut[k] = float(np.median(own[:, self.axis[k]]))
            left = own[:, self.axis[k]] <= self.cut[k] if len(own) else np.zeros(0, dtype=bool)
            if 2 * k + 1 < inner:
                held[2 * k + 1], held[2 * k + 2] = own[left], own[~left]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[np.arange(len(x)), self.axis[at]] > self.cut[at])
        return at - ((1 << self.depth) - 1)


def _vectors(column: pd.Series) -> np.ndarray:
    return np.vstack([np.frombuffer(v, dtype="<f8") for v in column]) if len(column) else np.zeros((0, 1))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({
            "vec_id": batch["vec_id"], "vector": [np.asarray(v, dtype="<f8").tobytes() for v in batch["embedding"]],
        })


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (packed doubles) of the rows that take part."""
    e = F.col("embedding")
    # A null or non-finite component makes the comparison null or false.
    fine = F.coalesce(F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))
    return (
        vectors.where(F.col("vec_id").isNotNull() & fine & F.exists(e, lambda x: x != 0))
        .select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
        .mapInPandas(_packed, "vec_id long, vector binary")
    )


def _indexed(projection: Projection, tree: Tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = projection.points(_vectors(batch["vector"]))
            yield batch.assign(leaf=tree.leaf(p), place=list(p))

    return run


def _routed(projection: Projection, leaves: np.ndarray, low: np.ndarray, high: np.ndarray, start: int, size: int):
    """The next leaves of each query, by the distance of their boxes, that the stopping test still lets in."""
    limit = chi_square_quantile(CONFIDENCE, PROJECTED)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for k in range(0, len(whole), 128):
                batch = whole.iloc[k:k + 128]
                q = _vectors(batch["vector"])
                at = projection.queries(q)
                gap = np.maximum(np.maximum(low[None] - at[:, None], at[:, None] - high[None]), 0)
                gap = (gap * gap).sum(axis=2)
                order = np.argsort(gap, axis=1, kind="stable")[:, start:start + size]
                worst = batch["worst"].to_numpy(dtype=float)
                far = np.where(np.isnan(worst), np.inf, (q * q).sum(axis=1) + projection.top ** 2 - 2 * worst)
                keep = np.take_along_axis(gap, order, axis=1) <= limit * np.maximum(far, 0)[:, None]
                rows, columns = np.nonzero(keep)
                yield pd.DataFrame({
                    "query_id": batch["query_id"].to_numpy()[rows], "vector": batch["vector"].to_numpy()[rows],
                    "worst": worst[rows], "leaf": leaves[order[rows, columns]],
                })

    return run


def _verified(top: int):
    """Exact inner products of a group's queries and points; up to ``top`` for each query that beat its worst."""

    def run(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(queries) and len(points):
            q, x, ids = _vectors(queries["vector"]), _vectors(points["vector"]), points["vec_id"].to_numpy()
            scores = q @ x.T
            slack = _SLACK * max(float(np.abs(scores).max()), 1e-300)
            worst = np.nan_to_num(queries["worst"].to_numpy(dtype=float), nan=-np.inf)
            for row, own in enumerate(queries["query_id"].to_numpy()):
                s = np.where(ids == own, -np.inf, scores[row])
                bar = max(worst[row], np.partition(s, -top)[-top] if len(s) > top else -np.inf)
                some = np.flatnonzero((s >= bar - slack) & (s > -np.inf))
                exact = (x[some] * q[row]).sum(axis=1)
                best = np.lexsort((ids[some], -exact))[:top]
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids[some][best], "score": exact[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def neighbours(vectors: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    """The ``top`` nearest vectors, by inner product, of each vector whose id is divisible by ``every``.

    Vectors are projected to PROJECTED dimensions. A kd-tree, its planes fitted on a bounded sample, deals all
    vectors into leaves; the leaves' boxes go to the driver (at most LEAVES rows). Each query takes
    the leaves in the order of their boxes' projected distance, a few in the first round and more in each later one, and all vectors
    of a leaf are verified on the original vectors. It stops at the first leaf whose squared projected distance is over the
    chi-square quantile times the squared distance of its worst neighbour so far. A round is a join of query blocks with
    leaf blocks; both have bounded sizes, so neither a crowded leaf nor many queries meet in one task.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Vectors that are null, zero or
    empty, hold null or non-finite components, have a null id, or are not of the most common length take no part. A
    repeated vec_id is a candidate for each of its rows, never its own query's, and asks one query. Queries without candidates
    give no rows; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    packed = written(usable(vectors))
    common = packed.groupBy(F.length("vector").alias("_bytes")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_bytes").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    packed = packed.where(F.length("vector") == common["_bytes"])

    def norms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"norm": [float(np.sqrt((_vectors(batch["vector"]) ** 2).sum(axis=1).max()))] if len(batch) else []})

    largest = packed.select("vector").mapInPandas(norms, "norm double").agg(F.max("norm")).first()[0]
    projection = Projection(common["_bytes"] // 8, largest)
    sample = packed.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()
    leaves = min(LEAVES, max(1, -(-common["n"] // LEAF_POINTS)))
    tree = Tree(projection.points(_vectors(sample["vector"])), leaves)
    points = written(packed.mapInPandas(_indexed(projection, tree), "vec_id long, vector binary, leaf long, place array<double>"))
    sides = [f(F.col("place")[k]).alias(f"{n}{k}") for k in range(PROJECTED) for n, f in (("low", F.min), ("high", F.max))]
    boxes = points.groupBy("leaf").agg(F.count("*").alias("n"), *sides).orderBy("leaf").toPandas()
    low, high = (boxes[[f"{n}{k}" for k in range(PROJECTED)]].to_numpy() for n in ("low", "high"))
    chunks = dict(zip(boxes["leaf"].tolist(), (-(-boxes["n"] // GROUP_POINTS)).tolist(), strict=True))

    def pieces(of: dict[int, int]) -> DataFrame:
        return F.broadcast(spark.createDataFrame([(k, v) for k, v in of.items()], "leaf long, _pieces long"))  # one row a leaf

    dealt = points.join(pieces(chunks), "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), F.col("_pieces")).alias("chunk"), "vec_id", "vector"
    )
    asked = points.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector").dropDuplicates(["query_id"])
    best: DataFrame | None = None
    start, size = 0, FIRST
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while start < len(boxes):
        if best is None:
            open_queries = asked.withColumn("worst", F.lit(None).cast("double"))
        else:
            worst = best.where(F.col("rank") == top).select("query_id", F.col("score").alias("worst"))
            open_queries = asked.join(worst, "query_id", "left")
        routed = written(open_queries.mapInPandas(
            _routed(projection, boxes["leaf"].to_numpy(), low, high, start, size),
            "query_id long, vector binary, worst double, leaf long",
        ))
        crowds = {r["leaf"]: -(-r["n"] // GROUP_QUERIES) for r in routed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
        if not crowds:
            break
        left = (
            routed.join(pieces(chunks), "leaf").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)))
            .drop("_pieces").join(pieces(crowds), "leaf")
            .withColumn("crowd", F.pmod(F.xxhash64("query_id"), F.col("_pieces"))).drop("_pieces")
        )
        right = (
            dealt.join(pieces(crowds), "leaf").withColumn("crowd", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)))
            .drop("_pieces")
        )
        key = ["leaf", "chunk", "crowd"]
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_verified(top), "query_id long, vec_id long, score double")
        if best is not None:
            found = found.unionByName(best.select("query_id", "vec_id", "score"))
        best = written(found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= top))
        start, size = start + size, size * FACTOR
    return empty if best is None else best.select("query_id", "rank", "vec_id", "score")
