import numpy as np
import pytest

from tillwise.llm import neighbours


def brute(ids, x, every, top):
    out = {}
    for row, own in enumerate(ids):
        if own % every == 0:
            s = x @ x[row]
            order = [k for k in np.lexsort((ids, -s.round(9))) if ids[k] != own][:top]
            out[own] = [(ids[k], s[k]) for k in order]
    return out


def run(spark, ids, rows, **more):
    df = spark.createDataFrame([(i, r, "x", 1) for i, r in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>, leaf string, score int")
    out = {}
    for r in sorted(neighbours.neighbours(df, **more).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_over_many_leaves(llm, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF_POINTS", 64)
    monkeypatch.setattr(neighbours, "GROUP_POINTS", 50)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", 7)
    r = np.random.default_rng(0)
    centres = r.normal(size=(30, 16))
    x = centres[r.integers(0, 30, 2000)] + 0.4 * r.normal(size=(2000, 16))
    x *= r.uniform(0.5, 2, 2000)[:, None]
    ids = r.permutation(2000)
    got, want = run(llm, ids.tolist(), x.tolist()), brute(ids, x, 20, 20)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    assert all(len(v) == 20 for v in got.values())
    for q in got:
        assert [s for _, s in got[q]] == pytest.approx([float(x[np.flatnonzero(ids == i)[0]] @ x[np.flatnonzero(ids == q)[0]]) for i, _ in got[q]])


def test_ties_and_hot_vector(llm, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF_POINTS", 64)
    monkeypatch.setattr(neighbours, "GROUP_POINTS", 50)
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 5))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    x[100:300] = x[0]
    ids = np.arange(400)
    got, want = run(llm, ids.tolist(), x.tolist()), brute(ids, x, 20, 20)
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]] == list(range(100, 120))
    assert [i for i, _ in got[200]] == [i for i, _ in want[200]]


def test_rows_that_take_no_part(llm):
    nan, inf = float("nan"), float("inf")
    rows = [[1.0, 0.0], None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 2.0, 3.0], [0.5, 0.5], [-1.0, 0.0]]
    ids = [0, 20, 40, 60, 80, 100, 120, 140, 7, 20]
    got = run(llm, ids, rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [7, 20], 20: [7, 0]}
    assert run(llm, [], []) == {}
    assert run(llm, [None, 20], [[1.0], [1.0]]) == {}
    assert run(llm, [20], [[1.0]]) == {}


def test_chi_square_quantile():
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)
