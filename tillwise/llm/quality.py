"""Quality by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import hide_null, remainder, show_null
from tillwise.llm.minhash import word_hashes
from tillwise.llm.sampling import labelled_sample

PASSAGE_BYTES = 512  # a passage ends at the first white space after so many bytes, or after twice as many
SAMPLE = 2500  # labelled documents of each class, at most, used for fitting
SEED = 11
HIDDEN, GATE = 32, 16
EPOCHS, BAGS, RATE = 24, 32, 3e-3
THRESHOLD = 0.7

# Kinds of bytes: each byte has one kind, and a passage is described by how often kinds follow each other.
_KINDS = 12
_KIND = np.full(256, 11, dtype=np.int64)
for _k, _bytes in enumerate((
    b" ", b"\n\r\t\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)),
    bytes(range(128, 256)), b".,;", b"!?", b"|/\\_-", b"%&$#*@", b"'\"()[]{}<>:",
)):
    _KIND[list(_bytes)] = _k
FEATURES = _KINDS * _KINDS + 5


def passages(text: str | None) -> list[bytes]:
    """The whole text in passages; an empty text is one empty passage."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out, start = [], 0
    while len(data) - start > 2 * PASSAGE_BYTES:
        cut = start + PASSAGE_BYTES
        space = min((at for at in (data.find(b" ", cut, cut + PASSAGE_BYTES), data.find(b"\n", cut, cut + PASSAGE_BYTES)) if at >= 0),
                    default=cut + PASSAGE_BYTES)
        out.append(data[start:space])
        start = space
    out.append(data[start:])
    return out


def encode(text: str | None) -> np.ndarray:
    """Fixed features of each passage: pairs of byte kinds, and how words repeat."""
    parts = passages(text)
    n = len(parts)
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    lengths = np.array([len(p) for p in parts])
    out = np.zeros((n, FEATURES), dtype=np.float32)
    if not len(raw):
        return out
    kind = _KIND[raw]
    owner = np.repeat(np.arange(n), lengths)
    same = owner[1:] == owner[:-1]
    pairs = owner[1:][same] * (_KINDS * _KINDS) + kind[:-1][same] * _KINDS + kind[1:][same]
    counted = np.bincount(pairs, minlength=n * _KINDS * _KINDS).reshape(n, -1)
    out[:, : _KINDS * _KINDS] = np.sqrt(counted / np.maximum(lengths[:, None] - 1, 1))
    words = [word_hashes(part.lower()) for part in parts]
    kinds = [np.unique(own) for own in words]
    owner = np.repeat(np.arange(n), list(map(len, kinds)))
    _, first = np.unique(np.concatenate(kinds), return_index=True)  # where each word of the text comes first
    new = np.bincount(owner[first], minlength=n)
    for k, (part, own) in enumerate(zip(parts, words, strict=True)):
        if len(own):
            size = len(kinds[k])
            out[k, -5:] = (
                size / len(own), (own[1:] == own[:-1]).mean() if len(own) > 1 else 0,
                (size - new[k]) / size, min(len(own) / 100, 2.0), min(len(part) / len(own) / 10, 3.0),
            )
    return out


class Attention:
    """Passage x -> h = tanh(Wx + b); weight softmax(v . (tanh(Th) * sigmoid(Sh))); document: sigmoid(c . sum + d)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def new(cls, seed: int, prior: float) -> Attention:
        r = np.random.default_rng(seed)
        n = lambda *shape: (r.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        return cls({
            "W": n(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "T": n(HIDDEN, GATE), "S": n(HIDDEN, GATE),
            "v": n(GATE), "c": n(HIDDEN), "d": np.array([np.log(prior / (1 - prior))], np.float32),
        })

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        w = self.w
        h = np.tanh(x @ w["W"] + w["b"])
        t, s = np.tanh(h @ w["T"]), 1 / (1 + np.exp(-(h @ w["S"])))
        e = (t * s) @ w["v"]
        sizes = np.diff(np.append(starts, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return h, t, s, a, sizes, z, 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, bag_weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        h, t, s, a, sizes, z, p = self.forward(x, starts)
        dl = (p - y) * bag_weight / len(y)
        dz = np.repeat(dl[:, None] * w["c"][None], sizes, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dts = de[:, None] * w["v"][None]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ w["T"].T + ds @ w["S"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "T": h.T @ dt, "S": h.T @ ds, "v": (t * s).T @ de,
                "c": z.T @ dl, "d": np.array([dl.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, seed: int) -> None:
        r = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = r.permutation(len(bags))
            for k in range(0, len(order), BAGS):
                some = order[k:k + BAGS]
                x = np.concatenate([bags[j] for j in some])
                starts = np.concatenate([[0], np.cumsum([len(bags[j]) for j in some])[:-1]])
                step += 1
                for name, g in self.gradients(x, starts, y[some], weight[some]).items():
                    g = g + 1e-4 * self.w[name] if name in "WTS" else g
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    self.w[name] = (self.w[name] - rate * (first[name] / (1 - 0.9 ** step))
                                    / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]).astype(np.int64)
        return self.forward(np.concatenate(bags), starts)[-1].astype(float)


def _encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "bag": [encode(t).tobytes() for t in batch["text"]]})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Attention | None:
    """Fits on at most ``sample`` documents of each class; None without labels of both classes.

    The features of the sample go to the driver: SAMPLE x 2 documents of at most LONGEST_FIT characters.
    """
    rows = (
        labelled_sample(docs, labels, "quality", remainder(F.col("doc_id"), 4) != 2, sample, SEED)
        .mapInPandas(_encoded, "doc_id long, label int, bag binary").toPandas().sort_values(["doc_id", "bag"])
    )
    y = rows["label"].to_numpy(dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return None
    model = Attention.new(SEED, 0.5)
    model.fit([np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES) for b in rows["bag"]], y, SEED)
    return model


def _scorer(model: Attention | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores: list[float] = []
            bags: list[np.ndarray] = []
            for text in batch["text"]:
                bags.append(encode(text if isinstance(text, str) else None))
                if sum(map(len, bags[-1:])) > 4096 or len(bags) >= 128:
                    scores += [0.5] * len(bags) if model is None else model.score(bags).tolist()
                    bags = []
            if bags:
                scores += [0.5] * len(bags) if model is None else model.score(bags).tolist()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})

    return run


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Scores each whole text; learns from labelled documents that are not held out.

    Returns one row for each row of ``docs``: doc_id, held_out, score, predicted. Null texts are empty; an empty text is one passage without
    content and has the score of that. Without labels of both classes every score is 0.5. Null and repeated ids are returned as they
    are; an empty table gives an empty result; labels that are null or not 0 or 1 are not used.
    """
    model = fit(docs, labels, sample)
    return (
        docs.select(hide_null(), "text").mapInPandas(_scorer(model), "doc_id long, score double")
        .withColumn("doc_id", show_null())
        .select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )
