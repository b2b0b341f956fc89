import hashlib
import random
import re
import zlib

import pytest
from compare import compare, connect

from tests.llm.conftest import SF
from tillwise.llm import conversations as C
from tillwise.llm.queries import all_oracles, all_queries, op11

FIELDS = "conv_id long, turn long, role string, text string, codes string, place int, digest string, audit string"


def brute_edits(rows):
    """(cost, labels, turns) least of all ways, by a plain search over (row, turns said so far)."""
    final = re.compile(r"(s?(ua)+)?")
    best = None
    seen = {}
    todo = [(0, "", 0, "", ())]
    limit = 4 * len(rows)
    while todo:
        i, said, cost, labels, turns = todo.pop()
        if cost > limit or len(labels) > 2 * len(rows) + 3:
            continue
        key = (i, said)
        if key in seen and seen[key] <= (cost, labels):
            continue
        seen[key] = (cost, labels)
        if i == len(rows) and final.fullmatch(said):
            if best is None or (cost, labels) < best[:2]:
                best = cost, labels, turns
        if len(said) <= len(rows) + 3:
            todo += [(i, said + r[0], cost + 3, labels + "I", (*turns, (r, ""))) for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            todo.append((i + 1, said, cost + 4, labels + "D", turns))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                todo.append((i + 1, said + (role[:1] or "-"), cost + more, labels + "K", (*turns, (role, text))))
                todo += [(i + 1, said + r[0], cost + 3 + more, labels + "R", (*turns, (r, text))) for r in ("user", "assistant")]
    return best


def best_by_table(rows):
    """(cost, labels) by dynamic programming from the end on strings; any length."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    now = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
    for role, _, fault in reversed(rows):
        new = {}
        for state, follow in after.items():
            ways = [(now[state][0] + 4, "D" + now[state][1])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in follow:
                    ways.append((now[follow[role[:1]]][0] + more, "K" + now[follow[role[:1]]][1]))
                ways += [(now[follow[r]][0] + 3 + more, "R" + now[follow[r]][1]) for r in "ua" if r in follow]
            new[state] = min(ways)
        for _ in range(3):
            for state, follow in after.items():
                for r in "ua":
                    if r in follow:
                        cost, labels = new[follow[r]]
                        new[state] = min(new[state], (cost + 3, "I" + labels))
        now = new
    return now[""]


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "fine" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def code(rows):
    return "".join(C.code_of(r[:1] if r[:1] and r[:1] in "sua" else "o", f) for r, _, f in rows)


def sha(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def report(rows):
    """rows (turn, role, text) of one conversation -> the report's columns."""
    known = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    ordered = sorted(known, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]))
    found = faults([r[1:] for r in ordered])
    turns = [t for t, _, _ in ordered if t is not None]
    cost, labels = best_by_table(found)
    said, out, at = len(labels.replace("D", "")), [], 0
    roles = (["s"] if said % 2 else []) + ["user", "assistant"] * said
    for label in labels:
        if label != "D":
            out.append((found[at][0] if label == "K" else roles[len(out)], "" if label == "I" else found[at][1]))
        at += label != "I"
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(found, found[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(sum(f == kind for _, _, f in found) for kind in C.FAULTS[1:]),
        sum(p not in C.LEGAL_PAIRS for p in pairs), cost, labels, sha(out),
    )


def some_rows(r, n):
    texts = ["one.", "two?", "three", "", " \n", "four! "]
    return [(r.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), r.choice(texts) if r.random() < 0.4 else f"text {k}.") for k in range(n)]


def test_auction_against_all_ways():
    r = random.Random(1)
    for _ in range(120):
        rows = faults(some_rows(r, r.randint(0, 4)))
        cost, labels, turns = brute_edits(rows)
        assert C.solve(code(rows)) == (cost, labels) == best_by_table(rows)
        said = C._Editor(labels)
        got = [t for role, text, _ in rows for t in said.over(role, text)] + list(said.inserts())
        assert tuple(got) == turns


def test_long_conversations_go_block_by_block():
    r = random.Random(2)
    for n in (31, 32, 33, 64, 100, 1000):
        rows = faults(some_rows(r, n))
        assert C.solve(code(rows)) == best_by_table(rows)
    bad = faults([("user", f"t{k}") for k in range(300)])
    assert C.solve(code(bad)) == best_by_table(bad)


def told(df):
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[c] for c in columns[1:]) for r in df.select(*columns).collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "d", "a") for r in rows], FIELDS)


def test_edges(llm):
    rows = [
        (1, 0, "system", "Be good."), (1, 1, "user", "hi!"), (1, 3, "assistant", "yes."),
        (2, None, "user", "a."), (2, None, "user", "a."), (2, 5, None, None), (2, 5, "assistant", "b" * 200_000),
        (None, 0, "user", "no id."), (None, None, "assistant", None), (None, 0, "user", "no id."),
        (3, None, "", ""), (4, 0, "tool", "x."), (5, 0, "system", "only."),
        (6, -7, "user", " "), (6, 9, "é", "ö.\n\t"),
    ]
    got = told(C.repair(frame(llm, rows)))
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = report([r[1:] for r in rows if r[0] == conv])
    assert got == want
    assert told(C.repair(frame(llm, []))) == {}


def test_a_conversation_with_a_third_of_all_rows(llm):
    """It is sorted, coded and checked for duplicates in many tasks."""
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # partitions of this size would be put together
    try:
        check_hot_conversation(llm)
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def check_hot_conversation(llm):
    r = random.Random(3)
    rows = [(7, k, *t) for k, t in enumerate(some_rows(r, 6000))]
    rows += [(100 + k // 6, k % 6, *t) for k, t in enumerate(some_rows(r, 12000))]
    r.shuffle(rows)
    df = frame(llm, rows)
    assert C.coded_rows(df).where("conv_id = 7").selectExpr("shiftright(place, 33)").distinct().count() > 1
    got = told(C.repair(df))
    own = {}
    for row in rows:
        own.setdefault(row[0], []).append(row[1:])
    assert got == {conv: report(of) for conv, of in own.items()}


def test_damage(llm):
    rows = [(k // 10, k % 10, "assistant", "What? Yes! No.") for k in range(400)] + [(None, None, None, None), (None, 3, "x", None)]
    got = sorted(map(tuple, C.damage(frame(llm, rows)).select("conv_id", "turn", "role", "text").collect()), key=repr)
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("folder", [SF])
def test_query_against_sql(llm, folder):
    name = "op11_conversations"
    assert compare(all_queries()[name](llm, folder), connect(folder), all_oracles()[name]) is None


def test_query_keeps_every_conversation(llm, tmp_path):
    rows = [(k, 0, "user", "hi.") for k in range(60)] + [(None, None, None, None)]
    frame(llm, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    out = op11(llm, str(tmp_path)).collect()
    assert {r["conv_id"] for r in out} == {r[0] for r in rows} and len(out) == 61
    dropped = [r for r in out if r["audit"] == ""]
    assert dropped and all(r["cost"] == 0 and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in dropped)
