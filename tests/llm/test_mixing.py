import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS, frame
from tillwise.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, fixed, free = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(fixed.values())
        over = {s for s in free if left * weight[s] / sum(weight[t] for t in free) > 2 * sizes[s]} if free else set()
        if not over:
            return fixed | {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}
        free -= over


def check(spark, docs):
    rows = docs.select("doc_id", "source", "text").collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    sizes = {}
    for r, n in zip(rows, size, strict=True):
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
    goals = brute_targets(sizes)
    found = mixing.mix(docs).collect()
    assert sorted(((r["doc_id"], n) for r, n in zip(rows, size, strict=True)), key=repr) == sorted(((r["doc_id"], r["size"]) for r in found), key=repr)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(goals[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    for source, goal in goals.items():
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - goal) <= max(r["size"] for r in own) / 2 + 1e-6
    return found


def test_mix(llm, edges, nothing, documents):
    check(llm, edges)
    first = check(llm, documents)
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mix(documents.repartition(3)).collect()))
    assert mixing.mix(nothing).collect() == []


def test_ranks_decide(llm):
    """Of a source, exactly the documents of the lowest random odds get the further copy."""
    rows = [(k, "w " * (1 + k % 5), "en", "hot" if k % 3 else "cold") for k in range(600)]
    docs = frame(llm, rows)
    found = check(llm, docs)
    u = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id").bitwiseAND(F.lit((1 << 52) - 1))).collect()}
    for source in ("hot", "cold"):
        own = sorted((r for r in found if r["source"] == source), key=lambda r: u[r["doc_id"]])
        copies = [r["copies"] for r in own]
        assert copies == sorted(copies, reverse=True)


def test_mixed_rows(llm, edges, documents):
    out = mixing.mixed(documents)
    assert out.columns == documents.columns
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(documents).collect() if r["copies"]}
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert mixing.mixed(edges).columns == edges.columns


def test_copies_go_to_their_row(llm):
    """Rows with null or repeated ids in several sources get the copies that the mix decided, and sources meet their targets."""
    rows = [(None if k % 3 else k // 9, f"row {k} " + "w " * (k % 5), "en", "abc"[k % 7 % 3]) for k in range(300)]
    docs = frame(llm, rows)
    decided = mixing.mix(docs).collect()
    goals = {r["source"]: r["target"] for r in decided}
    largest = max(r["size"] for r in decided)
    out = mixing.mixed(docs).collect()
    for source, goal in goals.items():
        taken = sum(len(r["text"].split()) for r in out if r["source"] == source)
        assert abs(taken - goal) <= largest / 2 + 1e-6, source


def test_no_words(llm):
    docs = frame(llm, [(1, None, "en", "a"), (2, " ", "en", None)])
    assert {(r["doc_id"], r["taken"], r["target"]) for r in mixing.mix(docs).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}
    assert len(ROWS) == 13
