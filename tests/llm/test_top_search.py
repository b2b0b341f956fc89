import math

import numpy as np
import pytest
from compare import compare, connect

from tests.llm.conftest import SF
from tillwise.llm import top_search
from tillwise.llm.queries import all_oracles, all_queries


def whole(row):
    return [math.floor(256 * v) for v in row]


def brute(ids, rows, every, top):
    """Rows of one length, all usable."""
    v = [whole(r) for r in rows]
    out = {}
    for own in sorted({i for i in ids if i % every == 0}):
        q = min((np.array(x, dtype="<f8").tobytes(), x) for i, x in zip(ids, v, strict=True) if i == own)[1]
        scores = ((sum(a * b for a, b in zip(q, x, strict=True)), i) for i, x in zip(ids, v, strict=True) if i != own)
        scored = sorted((-max(min(s, 2 ** 63 - 1), -(2 ** 63)), i) for s, i in scores)
        if scored:
            out[own] = [(i, -s) for s, i in scored[:top]]
    return out


def run(spark, ids, rows, **more):
    df = spark.createDataFrame(
        [(i, r, "x", 1, 2) for i, r in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>, shard string, worst int, piece int"
    )
    out = {}
    for r in sorted(top_search.top_search(df, **more).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(top_search, "TREE_POINTS", 64)
    monkeypatch.setattr(top_search, "LEAF_POINTS", 8)
    monkeypatch.setattr(top_search, "CROWD", 5)


def test_many_shards(llm, small):
    r = np.random.default_rng(0)
    centres = r.normal(size=(12, 6))
    x = centres[r.integers(0, 12, 900)] + 0.2 * r.normal(size=(900, 6))
    ids = r.permutation(900).tolist()
    assert run(llm, ids, x.tolist()) == brute(ids, x.tolist(), 50, 5)


def test_more_pieces_than_shards(llm, small, monkeypatch):
    monkeypatch.setattr(top_search, "SHARDS", 2)
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 4)).tolist()
    ids = list(range(500))
    assert run(llm, ids, x) == brute(ids, x, 50, 5)


def test_hot_vector_ties_and_repeated_ids(llm, small):
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 3))
    x[50:170] = x[0]
    ids = list(range(300))
    ids[200:203] = [100, 100, 7]
    assert run(llm, ids, x.tolist()) == brute(ids, x.tolist(), 50, 5)


def test_rows_that_take_no_part(llm):
    nan, inf = float("nan"), float("inf")
    rows = [[1.0, 0.0], None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 2.0, 3.0], [0.5, 0.5], [-1.0, 0.0]]
    ids = [0, 50, 100, 150, 200, 250, 300, 350, 7, 50]
    got = run(llm, ids, rows)
    kept = [0, 3, 8, 9]
    assert got == brute([ids[k] for k in kept], [rows[k] for k in kept], 50, 5)
    assert run(llm, [], []) == {}
    assert run(llm, [None, 50], [[1.0], [1.0]]) == {}


def test_great_numbers_are_exact(llm):
    """Products beyond what doubles hold exactly, and beyond a long."""
    rows = [[2.0 ** 22 + k / 256, 3.0] for k in range(40)] + [[1e15, 1e15], [-1e15, 1.0]]
    ids = list(range(0, 42 * 25, 25))
    assert run(llm, ids, rows) == brute(ids, rows, 50, 5)


def test_bounds_leave_out_most_leaves():
    """On clustered vectors, few products are formed, and none that matters is left out."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(60, 16)) * 3
    x = np.floor(256 * (centres[np.sort(r.integers(0, 60, 8000))] + 0.05 * r.normal(size=(8000, 16))))
    q, ids = x[::200], np.arange(8000)
    order, nodes, c, radii = top_search.ball_tree(x)
    worst = np.full(len(q), -(2 ** 63))
    best, formed = top_search.search_tree(q, ids[::200], worst, x, ids, (order, nodes, c, radii), 5)
    scores = (q @ x.T).astype("int64")
    for k, group in best.groupby("query"):
        s = [(-v, i) for i, v in enumerate(scores[k].tolist()) if i != 200 * k]
        assert [(-v, i) for i, v in zip(group["vec_id"], group["score"], strict=True)] == sorted(s)[:5]
    assert formed < 0.125 * scores.size  # 10.4 % measured
    # What another shard already found lets nothing but better or equal scores through.
    kth = best.groupby("query")["score"].min().to_numpy()
    again, fewer = top_search.search_tree(q, ids[::200], kth, x, ids, (order, nodes, c, radii), 5)
    assert fewer <= formed and again.reset_index(drop=True).equals(best.reset_index(drop=True))


def test_query_against_sql(llm):
    name = "op12_top_search"
    assert compare(all_queries()[name](llm, SF), connect(SF), all_oracles()[name]) is None
