import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ROWS, frame, told
from tillwise.llm import exact_dedup, minhash
from tillwise.llm.queries import op1


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=repr)


def test_exact_edges(edges, nothing):
    columns = ("doc_id", "keep_id", "group_size", "kept")
    assert told(exact_dedup.exact_groups(edges), *columns) == brute_exact(ROWS)
    assert exact_dedup.exact_groups(nothing).collect() == []
    kept = exact_dedup.keep_first(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 5, 6, 7, 7, 8, 9, 10]


def test_the_query_gives_one_row_a_row(llm, edges, tmp_path, monkeypatch):
    """Null and repeated ids included; also where hardly any group is hot."""
    edges.write.parquet(str(tmp_path / "documents.parquet"))
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t, *_ in ROWS}
    for parts in (1024, 2):
        monkeypatch.setattr(exact_dedup, "HOT_PARTS", parts)
        out = op1(llm, str(tmp_path)).collect()
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in out), key=repr) == brute_exact(ROWS)
        assert all(r["text_sha256"] == hashlib.sha256(norm[r["doc_id"]].encode()).hexdigest() for r in out if r["doc_id"] is not None)


def test_exact_same_length_and_prefix(llm):
    base = "x" * 400
    rows = [(k, base + str(k % 7) * 3, "en", "s") for k in range(60)] + [(100 + k, f"only {k:03d}", "en", "s") for k in range(300)]
    rows += [(900 + k, "hot", "en", "s") for k in range(400)]
    got = told(exact_dedup.exact_groups(frame(llm, rows)), "doc_id", "keep_id", "group_size", "kept")
    assert got == brute_exact(rows)


def test_digest(edges):
    got = {r[0]: r[1] for r in edges.select("doc_id", exact_dedup.text_sha256(edges["text"])).collect()}
    assert got[3] == hashlib.sha256(b"").hexdigest() and got[5] == hashlib.sha256(b" ").hexdigest()
    assert got[1] == got[2] == hashlib.sha256(b"Alpha beta gamma delta epsilon zeta").hexdigest()


def sets_of(rows):
    out = {}
    for doc_id, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        width = min(5, len(words))
        out[doc_id] = {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if words else set()
    return out


def brute_near(rows):
    sets = {k: v for k, v in sets_of(rows).items() if k is not None}
    label = {k: k for k in sets}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                label[q] = p
    return sorted(((k, len(sets[k]), find(k), find(k) == k) for k in ids), key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_edges(edges, nothing):
    got = told(minhash.near_groups(edges).where("doc_id IS NOT NULL").distinct(), *COLUMNS)
    assert got == brute_near(ROWS)
    unnamed = minhash.near_groups(edges).where("doc_id IS NULL").collect()
    assert len(unnamed) == 2 and all(r["component_id"] is None and r["kept"] for r in unnamed)
    assert minhash.near_groups(nothing).collect() == []
    assert minhash.keep_one(edges).columns == edges.columns


def edited(words, k, r):
    out = list(words)
    for at in r.sample(range(len(out)), k):
        out[at] = f"new{r.randrange(10**9)}"
    return out


def test_near_star_whose_centre_is_not_the_smallest(llm):
    """Copies are similar to the original, few to each other; chains and sizes around the threshold."""
    r = random.Random(3)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    rows = [(k, " ".join(edited(base, r.choice((2, 3, 4, 5, 6)), r)), "en", "s") for k in range(1, 70)]
    rows.append((500, " ".join(base), "en", "s"))
    chain = [f"c{r.randrange(10**6)}" for _ in range(120)]
    for k in range(12):
        rows.append((600 + k, " ".join(chain), "en", "s"))
        chain = edited(chain, 2, r)
    rows += [(700 + k, " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randrange(0, 9))), "en", "s") for k in range(40)]
    rows += [(800 + k, "same Words in here  again", "en", "s") for k in range(30)]
    assert told(minhash.near_groups(frame(llm, rows)), *COLUMNS) == brute_near(rows)


def test_sketch_is_full_and_estimates():
    r = np.random.default_rng(0)
    items = r.integers(0, 2**63, 900).astype(np.uint64)
    for n in (1, 2, 5, 60, 900):
        assert (minhash.sketch(items[:n]) != np.iinfo(np.uint64).max).all()
    a, b = np.unique(items[:800]), np.unique(items[200:])
    same = np.mean([
        (minhash.sketch(a ^ np.uint64(s)) == minhash.sketch(b ^ np.uint64(s))).mean() for s in range(1, 20)
    ])
    assert same == pytest.approx(600 / 900, abs=0.05)


def test_components_of_a_long_chain(llm):
    links = llm.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 90), (95, 100)], "a long, b long")
    found = {r["node"]: r["component"] for r in minhash.components(links).collect()}
    assert found == {k: 0 for k in range(61)} | {90: 90, 95: 90, 100: 90}
