"""Toxicity by a noisy channel: hidden words are restored under a character model, then scored."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import held_by_worker, hide_null, remainder, show_null
from tillwise.llm.sampling import labelled_sample

SAMPLE = 6000  # labelled documents of each class, at most, used for fitting
SEED = 13
LEAST_DOCUMENTS = 4  # toxic documents that must have a feature
LEAST_EVIDENCE = 1.5
THRESHOLD = 0.5
CACHE_CHUNKS = 600_000  # chunks whose evidence a worker holds
CACHE_READINGS = 300_000  # decoded readings, and words, that it holds
FEW = 12  # states; with more at any character, a first pass over that many gives a bound for the exact one

# What a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "*": "aeiou", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Costs of the channel in nats: a sign for a letter, a letter too many, a gap inside a word, a sign that stays.
SIGN, REPEAT, GAP, STAYS = 1.0, 0.7, 0.4, 3.0

_ORDER = 4
PIECE = 1 << 20  # grams that are counted, sent or packed at once
# A gap is a run of white space or marks; a spaced-out run may stand between brackets or quotes.
_MARKS = r"\s.,;:_*\-~/\\\[\]{})<>\"'`=#%&^"
_SPACED = re.compile(rf"(?<!\S)[(\[{{<\"'`.,;:_*\-~]*((?:[^{_MARKS}][{_MARKS}]++){{2,}}[^{_MARKS}])(?=[.,;:!?)\]}}>\"'`_*~-]*(?:\s|$))")
_GAPS = re.compile(rf"[{_MARKS}]+")
LONGEST_HELD = 64  # characters of a spaced-out run whose words are held
_STRIP = ".,;:?!\"'()[]{}<>|%&#*$-_~"
_STRIP_NO_SIGNS = "".join(c for c in _STRIP if c not in SIGNS)
_SIGN = re.compile(f"[{re.escape(''.join(SIGNS))}]")
_AMBIGUOUS = re.compile(rf"{_SIGN.pattern}|(?<=([^\W\d_]))\1")  # one match for each such place
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


# ---- the character model: exact counts of byte n-grams over all texts

def _normal(data: bytes) -> np.ndarray:
    """Lower-case letters and bytes over 127 as they are, runs of anything else as one space."""
    raw = np.frombuffer(b" " + data.lower() + b" ", dtype=np.uint8)
    out = np.where(_LETTER[raw], raw, 32)
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    return out[keep]


def _grams(chars: np.ndarray) -> np.ndarray:
    """The four bytes from each place on, as one number; three zeros follow the text, so that shorter grams are their beginnings."""
    padded = np.concatenate([chars, np.zeros(_ORDER - 1, dtype=np.uint8)]).astype(np.uint32)
    out = padded[:len(chars)]
    for k in range(1, _ORDER):
        out = (out << np.uint32(8)) | padded[k:len(chars) + k]
    return out


def _grams_of(texts: list[bytes]) -> np.ndarray:
    """Grams of each text by itself, for many texts at once: zeros part them, and no gram begins at a zero or goes over one."""
    raw = np.frombuffer(b"".join([b" " + t.replace(b"\0", b" ").lower() + b" \0\0\0" for t in texts]), dtype=np.uint8)
    chars = np.where(_LETTER[raw] | (raw == 0), raw, 32)
    keep = np.ones(len(chars), dtype=bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32)
    chars = chars[keep]
    return _grams(chars)[chars != 0]


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Grams with their number, added up as far as four PIECEs go."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, texts = 0, 0

    def add(own: list[bytes]) -> None:
        nonlocal size
        grams = _grams_of(own)
        for k in range(0, len(grams), PIECE):
            held.append(np.unique(grams[k:k + PIECE], return_counts=True))
            size += len(held[-1][0])

    def sent() -> Iterator[pd.DataFrame]:
        nonlocal size
        keys, counts = _added(*map(np.concatenate, zip(*held, strict=True)))
        held.clear()
        size = 0
        for k in range(0, len(keys), PIECE):
            yield pd.DataFrame({"gram": keys[k:k + PIECE].astype(np.int64), "n": counts[k:k + PIECE]})

    some: list[bytes] = []
    for batch in batches:
        for text in batch["text"]:
            if isinstance(text, str):
                some.append(text.encode("utf-8", "surrogatepass"))
                texts += len(some[-1])
                if texts > PIECE:
                    add(some)
                    some, texts = [], 0
                    if size > 4 * PIECE:
                        yield from sent()
    if some:
        add(some)
    if held:
        yield from sent()


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Grams and numbers as bytes, twelve for each gram."""
    held: list[pd.DataFrame] = []

    def sent() -> pd.DataFrame:
        rows = pd.concat(held)
        held.clear()
        return pd.DataFrame({"grams": [rows["gram"].to_numpy(dtype="<u4").tobytes()], "ns": [rows["n"].to_numpy(dtype="<i8").tobytes()]})

    for batch in batches:
        held.append(batch)
        if len(held) * len(held[0]) >= PIECE:
            yield sent()
    if held:
        yield sent()


class CharModel:
    """Probability of the next byte after the last three, mixed from all shorter contexts."""

    def __init__(self, grams: np.ndarray, numbers: np.ndarray):
        self.grams, self.numbers = grams, numbers  # of four bytes, in order
        self.tables = {_ORDER: (grams, numbers)}
        for order in range(_ORDER - 1, 0, -1):
            keys, counts = self.tables[order + 1]
            keys, counts = _added(keys >> np.uint32(8), counts)
            self.tables[order] = keys, counts
        self.total = max(float(numbers.sum()), 1.0)
        self.known: dict[int, float] = {}

    @classmethod
    def learn(cls, docs: DataFrame) -> CharModel:
        """Counts over all texts, none left out or run together. Each distinct gram of four bytes goes to the driver, in twelve bytes."""
        rows = (
            docs.select("text").mapInPandas(_count_grams, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).mapInPandas(_packed, "grams binary, ns binary").collect()
        )
        grams = np.frombuffer(b"".join(r["grams"] for r in rows), dtype="<u4")
        return cls(*_added(grams, np.frombuffer(b"".join(r["ns"] for r in rows), dtype="<i8")))

    def _count(self, gram: bytes) -> float:
        keys, counts = self.tables[len(gram)]
        key = np.uint32(int.from_bytes(gram, "big"))
        at = keys.searchsorted(key)
        return float(counts[at]) if at < len(keys) and keys[at] == key else 0.0

    def cost(self, context: bytes, byte: int) -> float:
        """Negative log probability of ``byte`` after ``context`` (three bytes)."""
        gram = int.from_bytes(context, "big") << 8 | byte
        found = self.known.get(gram)
        return self.learned(gram) if found is None else found

    def learned(self, number: int) -> float:
        """Cost of the last of a gram's four bytes, which is held in ``known``."""
        gram = number.to_bytes(_ORDER, "big")
        p = (self._count(gram[-1:]) + 0.1) / (self.total + 25.6)
        for order in (2, 3, 4):
            seen, before = self._count(gram[-order:]), self._count(gram[-order:-1])
            p = (min(seen, before) + 4 * p) / (before + 4)
        if len(self.known) > 500_000:
            self.known.clear()
        found = self.known[number] = -math.log(p)
        return found


# ---- the lattice

class Restorer:
    def __init__(self, model: CharModel):
        self.model = model
        self.runs: dict[str, list[str]] = {}
        self.readings: dict[str, list[str]] = {}
        self.encoded: dict[tuple[str, bool, bool], list[tuple[bytes, float]]] = {}

    def _options(self, token: str, k: int, spaced: bool) -> list[tuple[str, float]]:
        """What character k may have been, and the cost: letters, a repeat or gap that goes, a sign that ends a word."""
        char = token[k]
        if char.isalpha():
            out = [(char, 0.0)]
        elif spaced and char == " ":
            return [("", GAP), (" ", 0.0)]
        else:
            out = [(" ", STAYS)] + [(c, SIGN) for c in SIGNS.get(char, "")]
        if k and char == token[k - 1]:
            out.append(("", REPEAT))
        return out

    def decode(self, token: str, spaced: bool = False) -> str:
        """The most likely hidden text (exact Viterbi over the last three bytes).

        A path whose cost and least rest is over the cost of some whole path can't be the best one and is left; that
        whole path comes from a pass over the FEW cheapest states, made only where there are more of them.
        """
        begin, end = (0, len(token)) if spaced else self._window(token)
        options = []
        held, before = self.encoded, token[begin - 1] if begin else ""
        for k in range(begin, end):
            char = token[k]
            key = char, char == before, spaced
            own = held.get(key)
            if own is None:
                own = held[key] = [(e.encode(), c) for e, c in self._options(token, k, spaced)]
            options.append(own)
            before = char
        start = int.from_bytes(("   " + token[max(begin - 3, 0):begin]).encode()[-3:], "big")
        ends = self._paths(options, start)
        if ends is None:
            bound = min(cost for cost, _ in self._paths(options, start, few=True)) + 1e-6
            rest = np.cumsum([0.0] + [min(c for _, c in own) for own in reversed(options)])[::-1]
            ends = self._paths(options, start, most=(bound - rest[1:]).tolist())
        best = min(cost for cost, _ in ends)
        text = min(self._text(last) for cost, last in ends if cost == best).decode("utf-8", "replace")
        return (token[:begin] + text + token[end:]).strip()

    @staticmethod
    def _window(token: str) -> tuple[int, int]:
        """Outside of these characters all paths are the same: letters before the first choice, and letters that come three bytes after the last."""
        places = [match.start() for match in _AMBIGUOUS.finditer(token)]
        begin, end = 0, len(token)
        if places and token[:places[0]].isalpha():
            begin = places[0]
        if places and token[places[-1] + 1:].isalpha():
            end, size = places[-1] + 1, 0
            while end < len(token) and size < 3:
                size += len(token[end].encode())
                end += 1
        return begin, end

    def _paths(self, options: list, start: int, few: bool = False, most: list[float] | None = None) -> list[tuple[float, tuple | None]] | None:
        """Cost and last piece of the best path to each end state.

        None where there are more than FEW states and neither ``few`` nor ``most`` (the highest cost after each character) is given.
        """
        known, learned = self.model.known, self.model.learned
        states: dict[int, tuple[float, tuple | None]] = {start: (0.0, None)}  # three bytes each
        for k, own_options in enumerate(options):
            after: dict[int, tuple[float, tuple | None]] = {}
            limit = most[k] if most else math.inf
            for context, (cost, last) in states.items():
                for emitted, extra in own_options:
                    own, state, piece = cost + extra, context, last
                    for byte in emitted:
                        if byte == 32 and state & 255 == 32:
                            continue
                        gram = state << 8 | byte
                        more = known.get(gram)
                        own += learned(gram) if more is None else more
                        state, piece = gram & 0xFFFFFF, (piece, byte)
                    if own <= limit and (state not in after or own < after[state][0]):
                        after[state] = (own, piece)
            if len(after) > FEW and not most:
                if not few:
                    return None
                after = dict(sorted(after.items(), key=lambda s: s[1][0])[:FEW])
            states = after
        cost_of = self.model.cost
        return [
            (cost + (0.0 if state & 255 == 32 else cost_of(state.to_bytes(3, "big"), 32)), last)
            for state, (cost, last) in states.items()
        ]

    @staticmethod
    def _text(last: tuple | None) -> bytes:
        out = bytearray()
        while last is not None:
            last, byte = last
            out.append(byte)
        return bytes(reversed(out))

    def words(self, chunk: str) -> list[str]:
        """Words that a chunk between white space may stand for.

        Every reading with more than one path is decoded: any sign, with or without a letter, and any letter twice
        running. Letters alone are also a reading as they are. Signs at the edges may be punctuation or letters, so the chunk is
        read without and with them.
        """
        low = chunk.lower()
        if not _AMBIGUOUS.search(low):
            return _letters(low)
        out: list[str] = []
        for reading in dict.fromkeys((low.strip(_STRIP), low.strip(_STRIP_NO_SIGNS))):
            out += self.of_reading(reading)
        return list(dict.fromkeys(out))

    def of_reading(self, reading: str, wanted: Callable[[str], bool] | None = None) -> list[str]:
        """Words of one reading as it is, where it has no sign, and decoded, where it has a choice and is ``wanted``."""
        out = [] if _SIGN.search(reading) else _letters(reading)
        if _AMBIGUOUS.search(reading):
            found = self.readings.get(reading)  # chunks that differ in punctuation share it
            if found is None:
                if len(self.readings) > CACHE_READINGS:
                    self.readings.clear()
                found = _letters(self.decode(reading)) if wanted is None or wanted(reading) else []
                self.readings[reading] = found
            out += found
        return out

    @staticmethod
    def options(char: str, repeated: bool) -> tuple[str, ...]:
        """What a character of a chunk may stand for, without the costs."""
        own = (char,) if char.isalpha() else (" ", *SIGNS.get(char, ""))
        return (*own, "") if repeated else own

    def text_words(self, text: str) -> list[str]:
        """Words of spaced-out runs of single characters in a text."""
        out = []
        for match in _SPACED.finditer(text):
            run = _GAPS.sub(" ", match[1].lower())
            found = self.runs.get(run)
            if found is None:
                found = _letters(self.decode(run, spaced=True))
                if len(run) <= LONGEST_HELD:
                    if len(self.runs) > CACHE_READINGS:
                        self.runs.clear()
                    self.runs[run] = found
            out += found
        return out


_WORD = re.compile(r"[^\W\d_]+")


def _letters(text: str) -> list[str]:
    return _WORD.findall(text)


def _features(word: str) -> list[str]:
    out = ["=" + word]
    if len(word) > 4:
        out.append("^" + word[:4])
        if len(word) > 5:
            out.append("^" + word[:5])
            if len(word) > 6:
                out.append("^" + word[:6])
    return out


# ---- evidence of words, and a document's score

def _count_features(model: CharModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        toxic: Counter = Counter()
        clean: Counter = Counter()
        cache: dict[str, list[str]] = {}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found: set[str] = set()
                for chunk in set(text.split()):
                    if chunk not in cache:
                        if len(cache) > CACHE_CHUNKS:
                            cache.clear()
                        cache[chunk] = restorer.words(chunk)
                    for word in cache[chunk]:
                        found.update(_features(word))
                for word in restorer.text_words(text):
                    found.update(_features(word))
                (toxic if label else clean).update(found)
        names = list(toxic | clean)
        for k in range(0, len(names), 50_000):
            some = names[k:k + 50_000]
            yield pd.DataFrame({"feature": some, "toxic": [toxic[f] for f in some], "clean": [clean[f] for f in some]})

    return run


class Scorer:
    """A word's evidence is the greatest of its features; a document's is made of its words'."""

    SIZE = 6

    def __init__(self, model: CharModel, evidence: dict[str, float], weights: np.ndarray):
        self.restorer = Restorer(model)
        self.evidence = evidence
        self.weights = weights
        self.chunks: dict[str, float] = {}
        self.of_word: dict[str, float] = {}
        self.beginnings = {f[1:k] for f in evidence for k in range(2, len(f) + 1)}

    def _can_matter(self, reading: str) -> bool:
        """Whether some path of the reading's lattice, likely or not, spells a feature with evidence.

        Where none does, the best path has no evidence either, and need not be found. Only beginnings of features are followed.
        """
        evidence, beginnings, options = self.evidence, self.beginnings, self.restorer.options
        open_words, starts, before = set(), True, ""
        for char in reading:
            after, ends = set(), False
            for emitted in options(char, char == before):
                if emitted == " ":
                    ends = True
                    if any("=" + word in evidence for word in open_words):
                        return True
                elif not emitted:
                    after |= open_words
                    ends |= starts
                else:
                    for word in ([*open_words, ""] if starts else open_words):
                        word += emitted
                        if word in beginnings:
                            if "^" + word in evidence:
                                return True
                            after.add(word)
            open_words, starts, before = after, ends, char
        return any("=" + word in evidence for word in open_words)

    def _chunk(self, chunk: str) -> float:
        """Evidence of a chunk's words (``Restorer.words``); only readings that can have some are decoded."""
        low = chunk.lower()
        if not _AMBIGUOUS.search(low):
            return self._words(_letters(low))
        best = 0.0
        for reading in dict.fromkeys((low.strip(_STRIP), low.strip(_STRIP_NO_SIGNS))):
            best = max(best, self._words(self.restorer.of_reading(reading, self._can_matter)))
        return best

    def _words(self, words: list[str]) -> float:
        known, best = self.of_word, None
        for word in words:
            value = known.get(word)
            if value is None:
                if len(known) > CACHE_READINGS:
                    known.clear()
                get = self.evidence.get
                value = known[word] = max([get(feature, 0.0) for feature in _features(word)])
            if best is None or value > best:
                best = value
        return 0.0 if best is None else best

    def document(self, text: str | None) -> np.ndarray:
        """Features: bias, three strongest words, number of words with evidence, its share."""
        out = np.zeros(self.SIZE)
        out[0] = 1
        if not isinstance(text, str) or not text:
            return out
        parts = text.split()
        known = self.chunks
        try:
            found = np.fromiter(map(known.__getitem__, parts), dtype=float, count=len(parts))
        except KeyError:
            new = set(parts).difference(known)
            if len(known) + len(new) > CACHE_CHUNKS:
                known.clear()
                new = set(parts)
            for chunk in new:
                known[chunk] = self._chunk(chunk)
            found = np.fromiter(map(known.__getitem__, parts), dtype=float, count=len(parts))
        spaced = [self._words([w]) for w in self.restorer.text_words(text)]
        values = found[found > 0]
        if spaced:
            values = np.concatenate([values, [s for s in spaced if s > 0]])
        if len(values):
            top = np.sort(values)[::-1][:3]
            out[1:1 + len(top)] = top
            out[4] = math.log1p(len(values))
            out[5] = min(len(values) / max(len(parts), 1) * 10, 3.0)
        return out

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.document(text) @ self.weights))))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer | None:
    """The character model from all texts; evidence and weights from a sample of labelled documents.

    Evidence is the log ratio of document frequencies in the classes. The features with enough of it, which are bounded as the sample
    is, and six numbers for each document of the sample go to the driver. None without labels of both classes.
    """
    model = CharModel.learn(docs)
    rows = labelled_sample(docs, labels, "toxic", remainder(F.col("doc_id"), 5) != 0, sample, SEED)
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    ratio = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    kept = (
        rows.mapInPandas(_count_features(model), "feature string, toxic long, clean long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_DOCUMENTS).withColumn("evidence", ratio)
        .where(F.col("evidence") >= LEAST_EVIDENCE).collect()
    )
    evidence = {r["feature"]: r["evidence"] for r in kept}

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model, evidence, np.zeros(Scorer.SIZE))
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [scorer.document(t).tolist() for t in batch["text"]]})

    seen = rows.mapInPandas(described, "label int, x array<double>").toPandas()
    x, y = np.array(seen["x"].tolist()), seen["label"].to_numpy(dtype=float)
    order = np.lexsort((*x.T, y))
    return Scorer(model, evidence, _logistic(x[order], y[order]))


def _scorer(grams: np.ndarray, numbers: np.ndarray, evidence: dict[str, float], weights: np.ndarray):
    key = f"toxicity-{uuid.uuid4().hex}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = held_by_worker(key, lambda: Scorer(CharModel(grams, numbers), evidence, weights))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [scorer.score(t) for t in batch["text"]]})

    return run


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Scores each whole text; learns labels only from documents that are not held out.

    Returns one row for each row of ``docs``: doc_id, held_out, score, predicted. Null and empty texts have no evidence and get the score of
    that. Without labels of both classes every score is 0. Null and repeated ids are returned as they are; an empty table
    gives an empty result; labels that are null or not 0 or 1 are not used.
    """
    fitted = fit(docs, labels, sample)
    told = docs.select(hide_null(), "text")
    if fitted is None:
        scored = told.select("doc_id", F.lit(0.0).alias("score"))
    else:
        model = fitted.restorer.model
        run = _scorer(model.grams, model.numbers, fitted.evidence, fitted.weights)
        scored = told.mapInPandas(run, "doc_id long, score double")
    return scored.withColumn("doc_id", show_null()).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
