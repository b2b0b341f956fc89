"""MinHash near-dedup: fast similarity sketches, banding, and an exact check on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import fold_ascii, hide_null, mix64, rows_of, show_null, written

WORDS = 5
LEAST, OF = 75, 100  # similarity in hundredths
COORDINATES = 128  # a power of two
BAND = 4  # coordinates in a band: a pair at 0.75 shares none of 32 bands with odds of 5e-6
BANDS = COORDINATES // BAND
BLOCK_SETS, BLOCK_ITEMS = 256, 300_000  # about so much on each side of a block pair in the last check

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _seed(k: int) -> np.uint64:
    return np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_ODD_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared ...; up to a million of them are kept for the next text."""
    kept = _KEPT.get(int(base))
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if len(kept) <= 1 << 20:
            _KEPT[int(base)] = kept
    return kept[:n]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word, from running sums over the bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    word = np.concatenate([[False], ~_SPACE[raw], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * _powers(_ODD, len(raw)), dtype=np.uint64)])
    shifted = (sums[ends] - sums[starts]) * _powers(_ODD_INVERSE, len(raw))[starts]
    return mix64(shifted + (ends - starts).astype(np.uint64) * _STEP)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text."""
    words = word_hashes(fold_ascii(text))
    if not len(words):
        return words
    width = min(WORDS, len(words))
    total = np.full(len(words) - width + 1, _seed(width), dtype=np.uint64)
    for k in range(width):
        total = mix64(total + words[k:len(words) - width + 1 + k])
    return np.unique(total)


def sketch(items: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of a non-empty set.

    Round i hashes every item to a bin and a value; a bin keeps the least (round, value). Rounds go on until all
    bins are filled; from round COORDINATES on, round i fills bin i - COORDINATES from all items, so that none stays empty.
    """
    bits = COORDINATES.bit_length() - 1
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    filled = np.zeros(COORDINATES, dtype=bool)
    for turn in range(2 * COORDINATES):
        mixed = mix64(items + _seed(turn + 1))
        value = mixed & np.uint64((1 << (64 - bits)) - 1)
        if turn < COORDINATES:
            found = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
            at = (mixed >> np.uint64(64 - bits)).astype(np.int64)
            np.minimum.at(found, at, value)
            new = np.zeros(COORDINATES, dtype=bool)
            new[at] = True
            new &= ~filled
            # the round is part of the coordinate: equal values of different rounds differ
            best[new] = mix64(found[new] + _seed(turn + 1001))
        else:
            new = np.zeros(COORDINATES, dtype=bool)
            new[turn - COORDINATES] = not filled[turn - COORDINATES]
            if new.any():
                best[new] = mix64(np.array([value.min()], dtype=np.uint64) + _seed(turn + 1001))
        filled |= new
        if filled.all():
            break
    return best


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
    for column in coordinates.reshape(BANDS, BAND).T:
        keys = mix64(keys + column)
    return keys


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            items = shingles(text if isinstance(text, str) else None)
            if len(items):
                digest = np.frombuffer(hashlib.blake2b(items.tobytes(), digest_size=16).digest(), dtype="<i8")
                rows.append((doc_id, len(items), digest[0], digest[1], band_keys(sketch(items)).view(np.int64)))
            else:
                rows.append((doc_id, 0, 0, 0, None))
        yield pd.DataFrame(rows, columns=["doc_id", "n", "d1", "d2", "bands"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({
            "node": batch["node"], "items": [shingles(t).view(np.int64) for t in batch["text"]],
        })


def _linked(both: Column, n1: Column, n2: Column) -> Column:
    return OF * both >= LEAST * (n1 + n2 - both)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar. The set of b travels with the pair, that of a does not."""
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("_b"))
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("_a"))
    both = F.size(F.array_intersect("_a", "_b"))
    return (
        pairs.select("a", "b").join(right, "b").join(left, "a")
        .where(_linked(both, F.size("_a"), F.size("_b"))).select("a", "b")
    )


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices over the items both sides have."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), dtype=np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        items = np.concatenate(sets)
        at = np.minimum(np.searchsorted(both, items), len(both) - 1)
        held = both[at] == items
        return owner[held], at[held]

    if len(both):
        (o1, i1), (o2, i2) = places(left), places(right)
        for start in range(0, len(both), 1 << 14):  # bounds the matrices
            width = min(1 << 14, len(both) - start)
            m1, m2 = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
            for o, i, m in ((o1, i1, m1), (o2, i2, m2)):
                some = (i >= start) & (i < start + width)
                m[o[some], i[some] - start] = 1
            out += m1 @ m2.T
    return out.astype(np.int64)


def _cross_links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Pairs of components with a link between the two sides of a block pair."""
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sets = [[np.asarray(x, dtype=np.int64) for x in column] for column in (left["items_1"], right["items"])]
    n1, n2 = (np.array([len(x) for x in side]) for side in sets)
    both = _shared(*sets)
    c1, c2 = left["component_1"].to_numpy(), right["component"].to_numpy()
    linked = (OF * both >= LEAST * (n1[:, None] + n2[None] - both)) & (c1[:, None] != c2[None])
    rows, columns = np.nonzero(linked)
    return pd.DataFrame({"a": c1[rows], "b": c2[columns]}).drop_duplicates()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of a link can reach.

    Labels spread along links and are then replaced by their own label, so that chains halve; each round is written to
    the shared folder. Minima are combined before the shuffle.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = labels.select(F.col("node").alias("b"), "component")
        spread = (
            edges.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_seen"))
            .join(labels, "node").select("node", "component", F.least("_seen", "component").alias("_new"))
        )
        jump = labels.select(F.col("node").alias("_new"), F.col("component").alias("_jump"))
        after = written(spread.join(jump, "_new", "left").select(
            "node", F.least("_new", F.coalesce("_jump", "_new")).alias("component"),
            (F.least("_new", F.coalesce("_jump", "_new")) != F.col("component")).alias("_changed"),
        ))
        labels = after.select("node", "component")
        if after.where("_changed").isEmpty():
            return labels


def near_groups(docs: DataFrame) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of at least 0.75 on distinct five-word shingles.

    1. One pass over the texts gives each document the size, a digest and the band keys of its set. Documents with equal sets
       become one node (the smallest id); a node for each different set goes on.
    2. Nodes that share a band key are candidates. Sets are built again only for nodes with such company.
    3. In each bucket all nodes are checked against two hubs: the smallest id, and the node with the smallest share of items that no
       other candidate has (an original has few of its own, its edited copies have more). That is linear in the bucket.
       Checked links make components.
    4. Pairs of one bucket that lie in different components are what is left. A node can't have a link if less than 0.75 of its
       items are in any other candidate, and takes no part. The others of a bucket that are not in the component of its central
       node meet the whole bucket in blocks of bounded size; a block pair counts all its intersections on full sets by
       matrix products and gives out only pairs of components with a link. No link that banding finds is lost,
       no pairs are written out, and no cap is set anywhere.

    Returns one row for each row of ``docs``: doc_id, n_shingles, component_id, kept. Documents without words have no
    shingles and are linked with nothing. Rows with a null doc_id take no part: component_id is null and kept is true.
    Rows that repeat a doc_id count as documents with that id. An empty table gives an empty result.
    """
    rows = written(docs.select(hide_null(), "text").mapInPandas(
        _sketches, "doc_id long, n long, d1 long, d2 long, bands array<long>"
    ).withColumn("doc_id", show_null()))
    whole = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = whole.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
    nodes = (
        classes.join(whole.select(F.col("doc_id").alias("node"), "d1", "d2", "n", "bands"), ["node", "d1", "d2"])
        .dropDuplicates(["node", "d1", "d2"]).select("node", "n", F.explode("bands").alias("key"))
    )
    nodes = written(nodes)
    company = nodes.groupBy("key").agg(F.count("*").alias("_c")).where("_c > 1").select("key")
    members = written(nodes.join(company, "key"))
    wanted = members.select("node").distinct()
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(wanted, "node").dropDuplicates(["node"])
    sets = written(texts.mapInPandas(_sets, "node long, items array<long>"))
    own = (
        sets.select("node", F.explode("items").alias("_item"))
        .groupBy("_item").agg(F.count("*").alias("_c"), F.min("node").alias("node")).where("_c = 1")
        .groupBy("node").agg(F.count("*").alias("_own"))
    )
    sized = members.join(own, "node", "left").select(
        "key", "node", "n", (F.col("n") - F.coalesce("_own", F.lit(0))).alias("common")
    )
    sized = written(sized)
    hubs = sized.groupBy("key").agg(
        F.min("node").alias("first"),
        F.max_by("node", F.struct(F.col("common") / F.col("n"), -F.col("node"))).alias("central"),
    )

    def possible(n1: str, c1: str, n2: str, c2: str) -> Column:
        return _linked(F.least(c1, c2), F.col(n1), F.col(n2))

    able = sized.where(OF * F.col("common") >= LEAST * F.col("n"))  # others can have no link
    facts = able.select(F.col("node").alias("_hub"), F.col("n").alias("_n"), F.col("common").alias("_common")).distinct()
    stars = (
        able.join(hubs, "key").select("node", "n", "common", F.explode(F.array("first", "central")).alias("_hub"))
        .where("node <> _hub").distinct().join(facts, "_hub").where(possible("n", "common", "_n", "_common"))
        .select(F.col("_hub").alias("a"), F.col("node").alias("b"))
    )
    first_links = written(_verified(stars, sets))
    first = components(first_links)

    labelled = able.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    hub_label = first.select(F.col("node").alias("central"), F.col("component").alias("_label"))
    main = hubs.select("key", "central").join(hub_label, "central", "left").select(
        "key", F.coalesce("_label", "central").alias("_main")
    )
    split = labelled.join(main, "key").withColumn("_other", F.col("component") != F.col("_main"))

    def blocks(which: Column) -> Column:
        rows, items = F.count(F.when(which, 1)), F.sum(F.when(which, F.col("n")).otherwise(0))
        return F.greatest(F.ceil(rows / BLOCK_SETS), F.ceil(items / BLOCK_ITEMS)).cast("int")

    sides = split.groupBy("key").agg(
        blocks(F.col("_other")).alias("_lefts"), blocks(F.lit(True)).alias("_rights")
    ).where("_lefts > 0")
    rest = written(split.join(sides, "key").select("key", "node", "component", "_other", "_lefts", "_rights"))
    dealt = rest.join(sets, "node")

    def chunk(of: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    left = dealt.where("_other").withColumn("l", chunk("_lefts")).withColumn("r", every("_rights"))
    right = dealt.withColumn("r", chunk("_rights")).withColumn("l", every("_lefts"))
    pair = ["key", "l", "r"]
    columns = [*pair, "component", "items"]
    left = left.select(*columns).toDF(*[f"{c}_1" for c in columns])  # names of their own, as both sides come from one table
    more = (
        left.groupBy(*[f"{c}_1" for c in pair]).cogroup(right.select(*columns).groupBy(*pair))
        .applyInPandas(_cross_links, "a long, b long").distinct()
    )
    second = components(more).select(F.col("node").alias("component"), F.col("component").alias("_joined"))
    joined = first.join(second, "component", "left").select(
        "node", F.coalesce("_joined", "component").alias("component")
    ).unionByName(  # nodes that only the second step linked are their own label
        second.select(F.col("component").alias("node"), F.col("_joined").alias("component"))
        .join(first.select("node"), "node", "left_anti")
    )
    merged = classes.join(joined, "node", "left").select(
        "d1", "d2", F.coalesce("component", "node").alias("component_id")
    )
    linked = whole.join(merged, ["d1", "d2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
    alone = rows.where("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component; all columns as they were. Rows without an id stay."""
    return rows_of(docs, near_groups(docs.select("doc_id", "text")).where("kept").select("doc_id"))
