"""Conversation structure repair: cheapest edits by the auction algorithm for shortest paths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import written

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3  # costs; the last one for a truncated row that stays
BLOCK = 32  # rows of one auction
PIECE = 1024  # rows whose codes are put together in one step

# What has been said so far: nothing, s, …u, …a. The wanted form of the role initials is (s?(ua)+)?
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOW = {
    (START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U,
}
ENDS = (START, AFTER_A)
STATES = 4

# A row's code: its role's initial (o for any other) and its fault.
INITIALS, FAULTS = "suao", ("fine", "blank", "duplicate", "truncated")
LEGAL_PAIRS = ("su", "ua", "au")
FAR = 1 << 40


def code_of(initial: str, fault: str) -> str:
    return chr(65 + 4 * INITIALS.index(initial) + FAULTS.index(fault))


def meaning(code: str) -> tuple[str, str]:
    k = ord(code) - 65
    return INITIALS[k // 4], FAULTS[k % 4]


@lru_cache(maxsize=None)
def _row_arcs(code: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state, (label, cost, next state) of the ways over one row; 16 codes."""
    initial, fault = meaning(code)
    out = []
    for state in range(STATES):
        arcs = [("D", DELETE, state)]
        if fault not in ("blank", "duplicate"):
            extra = UNFINISHED if fault == "truncated" else 0
            if (state, initial) in FOLLOW:
                arcs.append(("K", KEEP + extra, FOLLOW[state, initial]))
            arcs += [("R", REROLE + extra, FOLLOW[state, r]) for r in "ua" if (state, r) in FOLLOW]
        out.append(tuple(arcs))
    return tuple(out)


_INSERTS = tuple(tuple(("I", INSERT, FOLLOW[state, r]) for r in "ua" if (state, r) in FOLLOW) for state in range(STATES))


class Lattice:
    """A block of rows as a graph: node i * STATES + state says that i rows are behind; the last node is where paths end.

    ``beyond`` holds, for each state, the cost of what follows the block; None stands for the end of the conversation, where only
    accepted states may stop and turns can still be inserted.
    """

    def __init__(self, codes: str, beyond: list[int] | None):
        n = len(codes)
        self.rows, self.sink = n, (n + 1) * STATES
        self.arcs: list[list[tuple[str, int, int]]] = []
        for i, code in enumerate(codes):
            for state, over in enumerate(_row_arcs(code)):
                arcs = [(label, cost, (i + 1) * STATES + to) for label, cost, to in over]
                self.arcs.append(arcs + [(label, cost, i * STATES + to) for label, cost, to in _INSERTS[state]])
        for state in range(STATES):
            if beyond is not None:
                arcs = [("", beyond[state], self.sink)]
            else:
                arcs = [(label, cost, n * STATES + to) for label, cost, to in _INSERTS[state]]
                if state in ENDS:
                    arcs.append(("", 0, self.sink))
            self.arcs.append(arcs)
        # Prices to start from: no way over a row costs less than its cheapest arc, so every arc is at least its nodes' difference.
        self.price = [0] * (self.sink + 1)
        floor = min(beyond) if beyond is not None else 0
        for i in range(n, -1, -1):
            if i < n:
                floor += min(cost for over in _row_arcs(codes[i]) for _, cost, _ in over)
            self.price[i * STATES:(i + 1) * STATES] = [floor] * STATES

    def auction(self, origin: int) -> int:
        """Length of the shortest path from ``origin``; afterwards the prices are duals that prove it.

        The path grows from its last node along the arc with the least cost plus price while the node's price equals that; otherwise the
        node's price rises to it and the path shrinks by one node. Prices stay at or under every arc's cost plus price.
        """
        price, arcs, path = self.price, self.arcs, [origin]
        while path[-1] != self.sink:
            node = path[-1]
            level, best = FAR, -1
            for _, cost, to in arcs[node]:
                if cost + price[to] < level:
                    level, best = cost + price[to], to
            if price[node] < level:
                price[node] = level
                if len(path) > 1:
                    path.pop()
            else:
                path.append(best)
        return price[origin]

    def tight(self) -> list[list[tuple[str, int]]]:
        """For each node the arcs on which price differences equal costs and from whose end such arcs lead to the sink."""
        price = self.price
        good = [False] * (self.sink + 1)
        good[self.sink] = True
        out: list[list[tuple[str, int]]] = [[] for _ in range(self.sink + 1)]
        for i in range(self.rows, -1, -1):
            # Inside a layer inserts lead from dearer to cheaper nodes.
            for node in sorted(range(i * STATES, (i + 1) * STATES), key=lambda k: price[k]):
                out[node] = [(label, to) for label, cost, to in self.arcs[node] if good[to] and price[node] == cost + price[to]]
                good[node] = bool(out[node])
        return out

    def trace(self, states: list[int]) -> tuple[str, list[int]]:
        """Least labels, in ASCII order, of tight paths from any of ``states``, and the states they may end in."""
        tight, now, labels = self.tight(), set(states), []
        last = self.rows * STATES
        while True:
            if any(label == "" for node in now for label, _ in tight[node]):
                return "".join(labels), sorted(node - last for node in now if any(label == "" for label, _ in tight[node]))
            least = min(label for node in now for label, _ in tight[node])
            now = {to for node in now for label, to in tight[node] if label == least}
            labels.append(least)


@lru_cache(maxsize=20_000)
def _solved_short(codes: str) -> tuple[int, str]:
    lattice = Lattice(codes, None)
    return lattice.auction(START), lattice.trace([START])[0]


def solve(codes: str) -> tuple[int, str]:
    """(cost, audit) of a conversation: the least cost, and the ASCII-least of the edit strings that reach it.

    Long conversations are priced block by block from the end, each block's duals at its entry being what follows for the block
    before it; then the blocks are traced from the start. Only four numbers a block are kept between the passes, and the work
    is in proportion to the rows.
    """
    if len(codes) <= BLOCK:
        return _solved_short(codes)
    starts = list(range(0, len(codes), BLOCK))
    beyond: list[list[int] | None] = [None] * len(starts)
    for k in range(len(starts) - 1, 0, -1):
        lattice = Lattice(codes[starts[k]:starts[k] + BLOCK], beyond[k])
        beyond[k - 1] = [lattice.auction(state) for state in range(STATES)]
    states, labels, cost = [START], [], 0
    for k, start in enumerate(starts):
        lattice = Lattice(codes[start:start + BLOCK], beyond[k])
        lengths = [lattice.auction(state) for state in states]
        cost = lengths[0] if k == 0 else cost
        found, states = lattice.trace(states)
        labels.append(found)
    return cost, "".join(labels)


def illegal_pairs(codes: str) -> int:
    initials = [meaning(c)[0] for c in codes]
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))


def _solve_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        faults = {f: [sum(meaning(c)[1] == f for c in codes) for codes in batch["codes"]] for f in FAULTS[1:]}
        solved = [solve(codes) for codes in batch["codes"]]
        yield pd.DataFrame({
            "conv_id": batch["conv_id"], "no_id": batch["no_id"], **faults, "illegal": [illegal_pairs(c) for c in batch["codes"]],
            "cost": [c for c, _ in solved], "audit": [a for _, a in solved],
        })


def _known(name: str) -> Column:
    """Nulls count as one space."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """Planted faults, by crc32 of ``conv_id:turn`` modulo 20: dropped (0), emptied (1), without its marks (2), twice (3), as user (4)."""
    kind = F.crc32(F.concat(_known("conv_id"), F.lit(":"), _known("turn")).cast("binary")) % 20
    text, role = _known("text"), _known("role")
    return (
        rows.withColumn("_kind", kind).where("_kind <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        ).drop("_copy")
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with known role and text, their digest, and the key that null conversations have too."""
    return rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv_id"), F.col("conv_id").isNull().alias("no_id"),
        F.col("turn").cast("long").alias("turn"), _known("role").alias("role"), _known("text").alias("text"),
    ).withColumn("digest", F.substring(F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary"), 256)), 1, 16))


ORDER = ("no_id", "conv_id", "turn", "role", "digest")


def coded_rows(rows: DataFrame) -> DataFrame:
    """place, conversation, digest and code of each row, without its text, in one written table.

    A range sort over the whole order (conversation, turn, role, digest) deals the rows, so a conversation with a third of all
    rows lies in many tasks; a row's place is its number in that order. Duplicates are rows behind the first place of their
    conversation's digest, which is a minimum combined before the shuffle.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    initial = F.substring("role", 1, 1)
    placed = written(
        _ordered(rows).select(
            "no_id", "conv_id", "turn", "role", "digest",
            F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
            F.when(last == "", "blank").when(last.isin(".", "!", "?"), "fine").otherwise("truncated").alias("fault"),
        ).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("place", F.monotonically_increasing_id())
    )
    firsts = placed.groupBy("no_id", "conv_id", "digest").agg(F.min("place").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select(
        F.col("no_id").alias("_no_id"), F.col("conv_id").alias("_conv_id"), F.col("digest").alias("_digest"), "_first"
    )
    same = (F.col("no_id") == F.col("_no_id")) & (F.col("conv_id") == F.col("_conv_id")) & (F.col("digest") == F.col("_digest"))
    fault = F.when((F.col("fault") != "blank") & (F.col("_first") < F.col("place")), "duplicate").otherwise(F.col("fault"))
    number = 4 * (F.instr(F.lit(INITIALS), F.col("initial")) - 1) + F.array_position(F.array(*map(F.lit, FAULTS)), fault) - 1
    return placed.join(firsts, same, "left").select("place", "no_id", "conv_id", "turn", F.char(65 + number).alias("code"))


def audits(rows: DataFrame) -> DataFrame:
    """One row for each conversation with rows: no_id, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows go to pieces of PIECE places as single letters, and the letters of a conversation, one for each of its rows, to one task: as
    many as the audit itself has. Turns are counted in two steps, by conversation and turn and then by conversation.
    """
    coded = coded_rows(rows)
    conv = ["no_id", "conv_id"]
    pieces = coded.groupBy(*conv, F.floor(F.col("place") / PIECE).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "code"))), lambda r: r["code"]), "").alias("codes")
    )
    whole = pieces.groupBy(*conv).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "codes"))), lambda r: r["codes"]), "").alias("codes")
    )
    kinds = ", ".join(f"{f} long" for f in FAULTS[1:])
    solved = whole.mapInPandas(_solve_batches, f"conv_id long, no_id boolean, {kinds}, illegal long, cost long, audit string")
    gaps = coded.groupBy(*conv, "turn").agg(F.lit(1).alias("_one")).groupBy(*conv).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0).cast("long")).alias("gaps")
    )
    return solved.join(gaps, conv)


class _Editor:
    """Applies an audit to the rows of one conversation as they come by; holds the audit, not the rows."""

    def __init__(self, audit: str):
        self.audit, self.at = audit, 0
        said = sum(label != "D" for label in audit)
        self.roles = "s" if said % 2 else ""  # only an odd number of turns starts with the system's
        self.said = 0

    def _next_role(self) -> str:
        k = self.said - len(self.roles)
        self.said += 1
        return self.roles if k < 0 else "user" if k % 2 == 0 else "assistant"

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._next_role(), ""

    def over(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        label = self.audit[self.at]
        self.at += 1
        if label != "D":
            new = self._next_role()
            yield (role if label == "K" else new), text


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order, each conversation's audit ahead of its rows (it has a role only there)."""
    editor, key, number = _Editor(""), None, 0

    def frame(out):
        return pd.DataFrame(out, columns=["no_id", "conv_id", "position", "role", "text"])

    for batch in batches:
        out = []
        for no_id, conv_id, audit, role, text in zip(*(batch[c].tolist() for c in ("no_id", "conv_id", "audit", "role", "text")), strict=True):
            if audit is not None:
                out += [(*key, number + k, *turn) for k, turn in enumerate(editor.inserts())] if key else []
                editor, key, number = _Editor(audit), (no_id, conv_id), 0
                continue
            for turn in editor.over(role, text):
                out.append((*key, number, *turn))
                number += 1
        yield frame(out)
    yield frame([(*key, number + k, *turn) for k, turn in enumerate(editor.inserts())] if key else [])


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired turns: no_id, conv_id, position (from 0), role, text; grouped by conversation and in order in each partition.

    Audits and rows are dealt by conversation and sorted, the audit first; a task then streams them and holds no more than one audit.
    A conversation with a third of all rows goes through one task, as its turns are wanted in one sequence, but it isn't held.
    """
    none = F.lit(None)
    ahead = audited.select(
        "no_id", "conv_id", F.lit(0).alias("_kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("binary").alias("digest"), none.cast("string").alias("text"), "audit",
    )
    body = _ordered(rows).select("no_id", "conv_id", F.lit(1).alias("_kind"), "turn", "role", "digest", "text", none.cast("string").alias("audit"))
    return (
        ahead.unionByName(body).repartition("no_id", "conv_id")
        .sortWithinPartitions("no_id", "conv_id", "_kind", "turn", "role", "digest")
        .select("no_id", "conv_id", "audit", "role", "text")
        .mapInPandas(_edited, "no_id boolean, conv_id long, position long, role string, text string")
    )


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, digest = None, hashlib.sha256()
    columns = ["no_id", "conv_id", "sha256"]
    for batch in batches:
        out = []
        for no_id, conv_id, position, role, text in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
            if position == 0:
                out += [(*key, digest.hexdigest())] if key else []
                key, digest = (no_id, conv_id), hashlib.sha256()
            digest.update(f"{chr(10) if position else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(out, columns=columns)
    yield pd.DataFrame([(*key, digest.hexdigest())] if key else [], columns=columns)


def repair(rows: DataFrame) -> DataFrame:
    """Structure report of each conversation, with the SHA-256 of its repaired turns (``role:text``, joined by newlines).

    Rows go in the order of turn (null first), then role, then a digest of the text; null roles and texts count as one space. Each row's first
    fault counts: blank, duplicate (its role and text came before), truncated (no final . ! ?). The cheapest edits that give role
    initials (s?(ua)+)? are found on the lattice of rows and states by auctions (``Lattice``), and of equally cheap ones the
    string of edit initials that is least in ASCII.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row for each conversation that has
    rows; rows without a conv_id are one conversation. Turns that are all null have no gaps; repeated rows count one by one;
    an empty table gives an empty result.
    """
    audited = written(audits(rows))
    digests = repaired(rows, audited).mapInPandas(_digested, "no_id boolean, conv_id long, sha256 string")
    return audited.join(digests, ["no_id", "conv_id"], "left").select(
        F.when(~F.col("no_id"), F.col("conv_id")).alias("conv_id"), "gaps", *FAULTS[1:], "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
