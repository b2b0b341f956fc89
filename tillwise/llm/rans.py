"""A range coder for token ids: static asymmetric numeral system, many lanes at once.

A segment holds the ids of whole documents. One frequency table, made from all of its ids, is shared by
its blocks. Each block is coded on its own by LANES interleaved 64-bit states that give out 32-bit words;
the directory holds, for each block, its number of ids, the place of its words, the states to start
from (the checkpoint) and a CRC-32 of the ids, so that any block can be read alone and checked.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

PRECISION = 18  # bits; a vocabulary of up to 2**18 ids
LANES = 256
BLOCK_IDS = 1 << 16
_LOW = np.uint64(1 << 31)
_U32 = np.uint64(32)
_K = np.uint64(PRECISION)
_MASK = np.uint64((1 << PRECISION) - 1)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that occur, and frequencies of at least 1 that add up to 2**PRECISION."""
    if int(ids.max()) < 1 << 22:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
    else:
        symbols, counts = np.unique(ids, return_counts=True)
    room = (1 << PRECISION) - len(symbols)
    if room < 0:
        raise ValueError("more distinct ids than the precision has places")
    freqs = 1 + (counts.astype(np.float64) * (room / counts.sum())).astype(np.int64)
    freqs[np.argmax(counts)] += (1 << PRECISION) - freqs.sum()
    return symbols.astype(np.uint32), freqs.astype(np.uint64)


def encode(ids: np.ndarray) -> dict[str, bytes | int]:
    """table, directory and words of one segment (at least one id)."""
    n = len(ids)
    symbols, freqs = frequencies(ids)
    starts = np.concatenate([[0], np.cumsum(freqs)[:-1]]).astype(np.uint64)
    blocks = -(-n // BLOCK_IDS)
    steps = -(-n // (blocks * LANES))
    padded = np.full(blocks * steps * LANES, ids[0], dtype=np.uint32)
    padded[:n] = ids
    if int(symbols[-1]) < 1 << 22:
        place_of = np.zeros(int(symbols[-1]) + 1, dtype=np.int32)
        place_of[symbols] = np.arange(len(symbols), dtype=np.int32)
        at = place_of[padded]
    else:
        at = np.searchsorted(symbols, padded)
    at = at.reshape(blocks, steps, LANES)
    x = np.full((blocks, LANES), _LOW, dtype=np.uint64)
    words = np.empty((blocks, steps, LANES), dtype=np.uint32)
    given = np.empty((blocks, steps, LANES), dtype=bool)
    for step in range(steps - 1, -1, -1):
        f, s = freqs[at[:, step]], starts[at[:, step]]
        full = x >= (f << np.uint64(31 - PRECISION + 32))
        words[:, step] = x.astype(np.uint32)
        given[:, step] = full
        x = np.where(full, x >> _U32, x)
        whole = x // f
        x = (whole << _K) + (x - whole * f) + s
    payload, directory, place = [], [], 0
    size = steps * LANES
    for b in range(blocks):
        out = words[b][given[b]]
        own = np.ascontiguousarray(padded[b * size:(b + 1) * size][: max(0, min(size, n - b * size))], dtype="<u4")
        directory.append(struct.pack("<IIII", len(own), place, len(out), zlib.crc32(own)) + x[b].astype("<u8").tobytes())
        payload.append(out.astype("<u4").tobytes())
        place += len(out)
    table = zlib.compress(symbols.astype("<u4").tobytes() + freqs.astype("<u4").tobytes(), 1)
    return {"n_ids": n, "n_blocks": blocks, "steps": steps, "table": table,
            "directory": b"".join(directory), "words": b"".join(payload)}


def decode(n_blocks: int, steps: int, table: bytes, directory: bytes, words: bytes,
           only: list[int] | None = None) -> np.ndarray:
    """The ids of a segment, or of some of its blocks; raises when a checksum differs."""
    flat = np.frombuffer(zlib.decompress(table), dtype="<u4")
    symbols, freqs = flat[: len(flat) // 2], flat[len(flat) // 2:].astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(freqs)[:-1]]).astype(np.uint64)
    of_slot = np.repeat(np.arange(len(symbols), dtype=np.uint32), freqs.astype(np.int64))
    entry = 16 + 8 * LANES
    chosen = list(range(n_blocks)) if only is None else only
    heads = [struct.unpack_from("<IIII", directory, b * entry) for b in chosen]
    x = np.stack([np.frombuffer(directory, "<u8", LANES, b * entry + 16) for b in chosen]).astype(np.uint64)
    stream = np.frombuffer(words, dtype="<u4")
    place = np.array([h[1] for h in heads], dtype=np.int64)
    found = np.empty((len(chosen), steps, LANES), dtype=np.uint32)
    last = max(len(stream) - 1, 0)
    stream = stream if len(stream) else np.zeros(1, dtype="<u4")
    for step in range(steps):
        slot = x & _MASK
        k = of_slot[slot.astype(np.int64)]
        found[:, step] = k
        x = freqs[k] * (x >> _K) + slot - starts[k]
        empty = x < _LOW
        ahead = np.cumsum(empty, axis=1)
        read = np.minimum(place[:, None] + ahead - 1, last)
        x = np.where(empty, (x << _U32) | stream[read].astype(np.uint64), x)
        place += ahead[:, -1]
    out = []
    for row, (n, start, length, crc) in enumerate(heads):
        own = symbols[found[row].reshape(-1)[:n]].astype("<u4")
        if zlib.crc32(own) != crc or place[row] != start + length:
            raise ValueError(f"block {chosen[row]} is damaged")
        out.append(own)
    return np.concatenate(out)
