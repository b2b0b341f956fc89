import hashlib
import math
import re
import zlib

import pytest
from compare import compare, connect

from tests.llm.conftest import SF, frame
from tillwise.llm import importance
from tillwise.llm.queries import all_oracles, all_queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans(importance.UPPER, importance.LOWER)


def runs(text, longest):
    words = WORD.findall((text or "").translate(FOLD))
    return len(words), [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, longest, buckets, percent, least):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for run in runs(text, longest)[1]:
            s[bucket(run)] += 1
    for text in target:
        for run in runs(text, longest)[1]:
            t[bucket(run)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for own, text in docs:
        n, features = runs(text, longest)
        weight = sum(gain[bucket(r)] for r in features)
        h = int(hashlib.sha256(f"2024:{'' if own is None else own}".encode()).hexdigest()[:8], 16)
        out.append([own, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    play = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(play[:len(play) * percent // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_against_brute_force(llm, documents, longest):
    target = llm.read.parquet(f"{SF}/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    want = brute(docs, [r["text"] for r in target.collect()], longest, 997, 25, 20)
    assert told(importance.resample(documents, target, longest, 997, 25)) == want


@pytest.mark.parametrize("longest", [1, 3])
def test_edges(llm, edges, nothing, longest):
    rows = [(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()]
    target = edges.where("doc_id < 3")
    want = brute(rows, [r["text"] for r in target.collect()], longest, 50, 50, 2)
    got = told(importance.resample(edges, target, longest, 50, 50, 2))
    # Rows without an id tie in their hash alone, so their order is by score like all others.
    assert got == want
    assert told(importance.resample(nothing, target)) == []
    assert told(importance.resample(edges, nothing, 1, 50, 50, 2)) == brute(rows, [], 1, 50, 50, 2)


def test_runs_over_lines(llm):
    text = "a b c d e\nf\n\ng h\ni j k l"
    docs = frame(llm, [(1, text, None, None)])
    counts = importance.resample(docs, docs, 4, 1000).collect()[0]
    assert (counts["n_words"], counts["n_features"]) == (12, 12 + 11 + 10 + 9)


def test_hot_lines_and_repeated_rows(llm, monkeypatch):
    """A line in all documents, and one text that a third of the rows repeat; most lines are not hot."""
    monkeypatch.setattr(importance, "HOT_PARTS", 4)
    rows = [(i, f"Everyone has this line\nown {i} words {i * 7}\n" + "x " * (i % 40), None, None) for i in range(90)]
    rows += [(7, "one text again and again\nEveryone has this line", None, None)] * 45
    docs = frame(llm, rows)
    target = frame(llm, [(1, "own words x x x", None, None)])
    want = brute([(r[0], r[1]) for r in rows], ["own words x x x"], 1, 200, 30, 5)
    got = told(importance.resample(docs, target, 1, 200, 30, 5))
    assert got == want


def test_query_against_sql(llm):
    name = "op13_importance"
    assert compare(all_queries()[name](llm, SF), connect(SF), all_oracles()[name]) is None
