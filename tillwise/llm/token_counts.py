"""Token counts: each distinct pre-token is cut once, and documents add up counts, not ids."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tillwise.llm.common import hide_null, show_null
from tillwise.llm.tokens import ChunkTokens, split_chunk, vocabulary_path

# A block of documents holds about so many bytes of text and at most so many documents. Long texts
# make a block of their own.
BLOCK_BYTES = 16 << 20
BLOCK_DOCS = 1 << 14

POSTINGS = "block long, word binary, postings binary"
# The ids and sizes of a block travel as a row whose word begins with a space, which no pre-token holds.
_HEAD = b" "
# A posting: the document's place in its block, and how often it has the word. Above 255 times it is repeated.
_POSTING = np.dtype([("doc", "<u2"), ("times", "u1")])


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts, block by block."""
    ids: list = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            data = text.encode("utf-8") if isinstance(text, str) else b""
            ids.append(doc_id)
            texts.append(data)
            held += len(data)
            if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _postings(word: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and postings in the order of words, each (word, document) once for each 255 times."""
    order = np.argsort(word * BLOCK_DOCS + doc, kind="stable")
    word, doc, times = word[order], doc[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])]))
    word, doc, times = word[first], doc[first], np.add.reduceat(times, first)
    copies = -(-times // 255)
    place = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    out = np.empty(len(place), dtype=_POSTING)
    out["doc"] = np.repeat(doc, copies)
    out["times"] = np.minimum(np.repeat(times, copies) - 255 * place, 255)
    return np.repeat(word, copies), out


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct pre-tokens of each block."""
    for _, texts in _blocks(batches):
        chunks: set[bytes] = set()
        for text in texts:
            chunks.update(text.split())
        words = list({part for chunk in chunks for part in split_chunk(chunk)})
        for k in range(0, len(words), 50_000):
            yield pd.DataFrame({"word": words[k:k + 50_000]})


def _invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block one row of ids and sizes, and for each distinct pre-token the documents with it."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    for block, (ids, texts) in enumerate(_blocks(batches), first):
        head = np.array([ids, [len(t) for t in texts]], dtype="<i8")
        yield pd.DataFrame({
            "block": [block], "word": [_HEAD + block.to_bytes(8, "big")], "postings": [head.tobytes()],
        })
        number: dict[bytes, int] = defaultdict(count().__next__)
        found = []
        for at, text in enumerate(texts):
            chunks = text.split()
            if chunks:
                of = np.fromiter(map(number.__getitem__, chunks), dtype=np.int64, count=len(chunks))
                kinds, times = np.unique(of, return_counts=True)
                found.append((kinds, np.full(len(kinds), at, dtype=np.int64), times))
        if not found:
            continue
        chunk, doc, times = (np.concatenate(x) for x in zip(*found, strict=True))
        words: dict[bytes, int] = defaultdict(count().__next__)
        parts = [split_chunk(c) for c in number]
        head = np.array([words[p[0]] for p in parts])[chunk]
        tail = np.array([words[p[1]] if len(p) > 1 else -1 for p in parts])[chunk]
        both = tail >= 0
        word, postings = _postings(
            np.concatenate([head, tail[both]]), np.concatenate([doc, doc[both]]), np.concatenate([times, times[both]])
        )
        edges = (np.searchsorted(word, np.arange(len(words) + 1)) * _POSTING.itemsize).tolist()
        data, names = postings.tobytes(), list(words)
        for k in range(0, len(names), 20_000):
            some = names[k:k + 20_000]
            yield pd.DataFrame({
                "block": block, "word": some,
                "postings": [data[edges[j]:edges[j + 1]] for j in range(k, k + len(some))],
            })


def _counter(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = ChunkTokens(path)
        for batch in batches:
            yield pd.DataFrame({
                "word": batch["word"], "pieces": [tokens.count(bytes(w)) for w in batch["word"]],
            })

    return run


PARTS = "block long, head binary, places binary, sums binary, width int"


def _part(block: int, sums: np.ndarray) -> pd.DataFrame:
    """What a task knows of a block: the documents that it has sums for, and these sums, in as few bytes as hold them.

    Where most documents have one, all are sent without their places.
    """
    places = np.flatnonzero(sums).astype("<u2")
    width = next(w for w in (2, 4, 8) if w == 8 or int(sums.max()) < 1 << 8 * w)
    dense = len(places) * (width + 2) >= (int(places[-1]) + 1) * width
    kept = sums[:int(places[-1]) + 1] if dense else sums[places]
    return pd.DataFrame({
        "block": [block], "head": None, "places": [None if dense else places.tobytes()],
        "sums": [kept.astype(f"<u{width}").tobytes()], "width": [width],
    })


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums pieces times frequency by document, block after block; heads pass through.

    Rows come in the order of blocks, so one block is held at a time and has one part from each task. A part is no bigger than
    a few times the postings it was made of, however many blocks and tasks there are.
    """
    current, sums = None, np.zeros(BLOCK_DOCS, dtype=np.int64)
    for batch in batches:
        heads = batch["pieces"].isna()
        if heads.any():
            yield batch.loc[heads, ["block", "postings"]].rename(columns={"postings": "head"}).assign(places=None, sums=None, width=0)
            batch = batch[~heads]
        if not len(batch):
            continue
        number = batch["block"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])).tolist()
        data, pieces = batch["postings"].tolist(), batch["pieces"].to_numpy(dtype=np.int64)
        for start, end in zip(starts, [*starts[1:], len(batch)], strict=True):
            if number[start] != current:
                if current is not None and sums.any():
                    yield _part(current, sums)
                current = int(number[start])
                sums[:] = 0
            own = np.frombuffer(b"".join(data[start:end]), dtype=_POSTING)
            sizes = np.fromiter(map(len, data[start:end]), dtype=np.int64, count=end - start) // _POSTING.itemsize
            np.add.at(sums, own["doc"].astype(np.int64), np.repeat(pieces[start:end], sizes) * own["times"])
    if current is not None and sums.any():
        yield _part(current, sums)


def _unpack(block: pd.DataFrame) -> pd.DataFrame:
    """One block: adds its partial sums and gives each document its row."""
    ids, sizes = np.frombuffer(block["head"].dropna().iloc[0], dtype="<i8").reshape(2, -1)
    total = np.zeros(len(ids), dtype=np.int64)
    for places, sums, width in zip(block["places"], block["sums"], block["width"], strict=True):
        if width:
            part = np.frombuffer(sums, dtype=f"<u{width}").astype(np.int64)
            if places is None:
                total[:len(part)] += part
            else:
                total[np.frombuffer(places, dtype="<u2").astype(np.int64)] += part
    return pd.DataFrame({"doc_id": ids, "n_bytes": sizes, "n_tokens": total})


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Bytes and tokens of each text, as the tokenizers library counts them.

    Blocks of documents (a few MB of text) are turned into postings: for each distinct pre-token of the
    block the documents that hold it, and how often. The distinct pre-tokens of all blocks are cut
    into pieces once each; that table is joined to the postings (a frequent one has one row for
    each block, and a skew join may split it); inside the tasks the joined rows are sorted by block, and pieces times frequency
    are added up for each block and document before they go back to it. The texts are read twice; no ids are kept anywhere.

    Returns one row for each row of ``docs``: doc_id, n_bytes, n_tokens. Null and empty texts
    have 0 of both; a null or repeated doc_id is returned as it is; an empty table gives an empty result. Special
    strings inside a text count as the library counts them by default.
    """
    path = path or vocabulary_path()
    told = docs.select(hide_null(), "text")
    pieces = told.mapInPandas(_words, "word binary").distinct().mapInPandas(_counter(path), "word binary, pieces long")
    return (
        told.mapInPandas(_invert, POSTINGS).join(pieces, "word", "left").select("block", "postings", "pieces")
        .sortWithinPartitions("block").mapInPandas(_add_up, PARTS)
        .groupBy("block").applyInPandas(_unpack, "doc_id long, n_bytes long, n_tokens long")
        .select(show_null(), "n_bytes", "n_tokens")
    )
