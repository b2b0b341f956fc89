"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import held_by_worker, hide_null, mix64, remainder, show_null, written

VOCABULARY = "piece_bpe_32k.model"
ROUNDS = 2  # of expectation maximisation
LONG = 64  # letters; longer runs are summed in logarithms, as their products leave the range of doubles
BATCH = 100_000  # letters of words that are scored together; a longer run goes alone
UNSEEN = 1e-7  # probability of a character that no piece holds
PSEUDO = 0.1  # added to each expected count
HELD_WORDS = 200_000
CACHE_CHUNKS = 800_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"  # begins a word
_SCALE = 8.0  # factor for each character, so that products stay near 1
_BASE = 0x9E3779B97F4A7C15 | 1
_FULL = 0xFFFFFFFFFFFFFFFF


def vocabulary(path: str | None = None) -> list[str]:
    """The file's pieces in lower case, without control, byte and digit pieces."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for k in range(model.get_piece_size()):
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
            piece = model.id_to_piece(k).lower()
            if piece and (piece == _MARK or piece.lstrip(_MARK).isalpha() and piece.count(_MARK) <= 1):
                found[piece] = None
    return sorted(found)


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, whole, each behind the mark."""
    return [_MARK + run for run in _LETTERS.findall(text.lower())]


def batches_of(words: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of words with about BATCH letters each."""
    start, held = 0, 0
    for k, word in enumerate(words):
        if held and held + len(word) > BATCH:
            yield start, k
            start, held = k, 0
        held += len(word)
    if held:
        yield start, len(words)


class Lattice:
    """For a batch of words: which piece spans which characters."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        self._reach(1 << 10)
        codes, _, offsets = self._codes(pieces)
        hashes = self._spans(codes, offsets[:-1], offsets[1:], self._sums(codes, offsets))
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.size = len(pieces)
        self.lengths = np.array([len(p) for p in pieces])

    def _reach(self, places: int) -> None:
        """Powers of the base, and of its inverse, for so many places of a word."""
        def powers(base: int) -> np.ndarray:
            return np.concatenate([[np.uint64(1)], np.cumprod(np.full(places - 1, base, dtype=np.uint64))])

        self.powers, self.inverses = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))

    @staticmethod
    def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        return codes, lengths, np.concatenate([[0], np.cumsum(lengths)])

    def _place(self, offsets: np.ndarray, n: int) -> np.ndarray:
        return np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))

    def _sums(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        terms = mix64(codes + np.uint64(7)) * self.powers[self._place(offsets, len(codes))]
        return np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])

    def _spans(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray,
               place: np.ndarray | None = None) -> np.ndarray:
        shift = self.inverses[place] if place is not None else self.inverses[np.zeros(len(starts), dtype=np.int64)]
        return mix64((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))

    def edges(self, words: list[str]) -> Edges:
        """All spans of the words that are pieces; each single character has one (piece ``size`` where it is unknown)."""
        codes, lengths, offsets = self._codes(words)
        if len(lengths) and lengths.max() > len(self.powers):
            self._reach(2 * int(lengths.max()))
        sums, place = self._sums(codes, offsets), self._place(offsets, len(codes))
        left = np.repeat(lengths, lengths) - place
        found = []
        for k in range(1, self.longest + 1):
            starts = np.flatnonzero(left >= k)
            if not len(starts):
                break
            hashes = self._spans(codes, starts, starts + k, sums, place[starts])
            at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
            known = self.hashes[at] == hashes
            pieces = np.where(known, self.order[at], self.size)
            if k > 1:
                starts, pieces = starts[known], pieces[known]
            found.append((starts, np.full(len(starts), k), pieces))
        start, length, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        owner = np.repeat(np.arange(len(words)), lengths)[start]
        return Edges(lengths, offsets[:-1] + np.arange(len(words)), start + owner, start + length + owner, place[start], length, piece, owner)


class Edges:
    """Pieces between the places of words. A word of n characters has n + 1 places, and ``first`` is its first one."""

    def __init__(self, lengths, first, tail, head, begin, length, piece, owner):
        self.lengths, self.first, self.places = lengths, first, int(lengths.sum()) + len(lengths)
        self.tail, self.head, self.begin, self.length, self.piece, self.owner = tail, head, begin, length, piece, owner

    def steps(self, back: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Edges by the position that they lead to (back: from), in order: edges, first edge of each place, the places."""
        position = self.begin if back else self.begin + self.length
        place = self.tail if back else self.head
        order = np.lexsort((place, -position if back else position))
        cuts = np.flatnonzero(np.diff(position[order])) + 1
        for some in np.split(order, cuts):
            own = place[some]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            yield some, first, own[first]


class Model:
    """Piece probabilities for each language (pieces x languages)."""

    def __init__(self, lattice: Lattice, probabilities: np.ndarray):
        self.lattice = lattice
        table = np.vstack([probabilities, np.full((1, probabilities.shape[1]), UNSEEN)])  # the last: an unknown character
        self.table = table * _SCALE ** np.append(lattice.lengths, 1)[:, None]

    def forward(self, edges: Edges) -> np.ndarray:
        """Scaled sums over all segmentations up to each place."""
        sums = np.zeros((edges.places, self.table.shape[1]))
        sums[edges.first] = 1.0
        for some, first, places in edges.steps(back=False):
            sums[places] = np.add.reduceat(sums[edges.tail[some]] * self.table[edges.piece[some]], first, axis=0)
        return sums

    def _forward_logs(self, edges: Edges, back: bool = False) -> np.ndarray:
        """Logarithms of the scaled sums over all segmentations up to (back: from) each place."""
        logs = np.full((edges.places, self.table.shape[1]), -np.inf)
        logs[edges.first + (edges.lengths if back else 0)] = 0.0
        weight = np.log(self.table)[edges.piece]
        source = edges.head if back else edges.tail
        for some, first, places in edges.steps(back):
            logs[places] = np.logaddexp.reduceat(logs[source[some]] + weight[some], first, axis=0)
        return logs

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), self.table.shape[1]))
        long = np.fromiter((len(w) > LONG for w in words), dtype=bool, count=len(words))
        for own, logs in ((~long, False), (long, True)):
            if own.any():
                edges = self.lattice.edges([w for w, o in zip(words, own.tolist(), strict=True) if o])
                ends = edges.first + edges.lengths
                whole = self._forward_logs(edges)[ends] if logs else np.log(np.maximum(self.forward(edges)[ends], 1e-300))
                out[own] = whole - edges.lengths[:, None] * np.log(_SCALE)
        return out

    def expected(self, words: list[str], language: int, times: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in the words of one language."""
        column = Model.__new__(Model)
        column.lattice, column.table = self.lattice, self.table[:, language:language + 1]
        long = np.fromiter((len(w) > LONG for w in words), dtype=bool, count=len(words))
        counts = np.zeros(self.lattice.size)
        for own, logs in ((~long, False), (long, True)):
            if own.any():
                edges = self.lattice.edges([w for w, o in zip(words, own.tolist(), strict=True) if o])
                counts += column._uses(edges, times[own], logs)
        return counts

    def _uses(self, edges: Edges, times: np.ndarray, logs: bool) -> np.ndarray:
        ends, weight = edges.first + edges.lengths, self.table[edges.piece, 0]
        if logs:
            sums, ahead = self._forward_logs(edges)[:, 0], self._forward_logs(edges, back=True)[:, 0]
            share = np.exp(sums[edges.tail] + np.log(weight) + ahead[edges.head] - sums[ends][edges.owner])
        else:
            sums = self.forward(edges)[:, 0]
            ahead = np.zeros(edges.places)
            ahead[ends] = 1.0
            for some, first, places in edges.steps(back=True):
                ahead[places] = np.add.reduceat(weight[some] * ahead[edges.head[some]], first)
            share = sums[edges.tail] * weight * ahead[edges.head] / np.maximum(sums[ends], 1e-300)[edges.owner]
        return np.bincount(edges.piece, weights=share * times[edges.owner], minlength=self.lattice.size + 1)[: self.lattice.size]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words of each language with their number, added up as far as HELD_WORDS goes."""
    held: Counter = Counter()

    def sent() -> pd.DataFrame:
        out = pd.DataFrame([(lang, word, n) for (lang, word), n in held.items()], columns=["lang", "word", "n"])
        held.clear()
        return out

    for batch in batches:
        for lang, group in batch.groupby("lang"):
            chunks: Counter = Counter()
            for text in group["text"]:
                if isinstance(text, str):
                    chunks.update(text.lower().split())
            for chunk, n in chunks.items():
                for word in words_of(chunk):
                    held[lang, word] += n
        if len(held) >= HELD_WORDS:
            yield sent()
    if held:
        yield sent()


def _expect(pieces: list[str], languages: list[str], probabilities: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(pieces)
        counts = np.zeros((len(languages), len(pieces)))
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                at = languages.index(lang)
                model = Model(lattice, probabilities[:, at:at + 1])
                words, times = group["word"].tolist(), group["n"].to_numpy(dtype=float)
                for k, end in batches_of(words):
                    counts[at] += model.expected(words[k:end], 0, times[k:end])
        for at, row in enumerate(counts):
            used = np.flatnonzero(row)
            if len(used):
                yield pd.DataFrame({"lang": at, "piece": used, "n": row[used]})

    return run


def learn(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> tuple[list[str], list[str], np.ndarray]:
    """Pieces, languages and piece probabilities from all given documents with a lang and a text.

    Words are counted for each language over all documents; each round sends the expected uses of pieces (at
    most vocabulary x languages numbers) to the driver.
    """
    pieces = vocabulary(path)
    words = written(
        docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
        .mapInPandas(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    probabilities = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(rounds if languages else 0):
        found = (
            words.mapInPandas(_expect(pieces, languages, probabilities), "lang int, piece int, n double")
            .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        )
        counts = np.full(probabilities.shape, PSEUDO)
        counts[found["piece"], found["lang"]] += found["n"]
        probabilities = counts / counts.sum(axis=0)
    return pieces, languages, probabilities


class Scorer:
    """Languages of texts. Each distinct chunk is scored once, in a dictionary that starts afresh at CACHE_CHUNKS."""

    def __init__(self, pieces: list[str], languages: list[str], probabilities: np.ndarray):
        self.model, self.languages = Model(Lattice(pieces), probabilities), languages
        self.rows = np.zeros((1 << 12, len(languages)))
        self.letters = np.zeros(1 << 12, dtype=bool)
        self.number: dict[str, int] = {}

    def _learn(self, chunks: set[str]) -> None:
        number, n = self.number, len(self.languages)
        new = chunks.difference(number)
        if len(number) + len(new) > CACHE_CHUNKS:
            number.clear()
            new = chunks
        if not new:
            return
        start = len(number)
        while start + len(new) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        split = [words_of(c) for c in new]
        flat = sorted({w for ws in split for w in ws})
        scores = np.vstack([self.model.score(flat[k:end]) for k, end in batches_of(flat)]) if flat else np.zeros((0, n))
        at = dict(zip(flat, range(len(flat)), strict=True))
        number.update(zip(new, range(start, start + len(new)), strict=True))
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        places = np.fromiter((at[w] for ws in split for w in ws), dtype=np.int64, count=int(sizes.sum()))
        own = slice(start, start + len(new))
        self.rows[own], self.letters[own] = 0.0, sizes > 0
        if len(places):  # sums over the words of each chunk that has any
            some = np.flatnonzero(sizes)
            self.rows[start + some] = np.add.reduceat(scores[places], (np.cumsum(sizes) - sizes)[some], axis=0)

    def predicted(self, values: list) -> tuple[list[str], list[float], list[bool]]:
        """Language, score and whether there is a letter, of each text."""
        texts = [t.lower().split() if isinstance(t, str) else [] for t in values]
        some: set[str] = set()
        langs, scores, lettered = [], [], []
        begin = 0
        for end, chunks in enumerate(texts, 1):  # scored in groups whose chunks fit the cache
            some.update(chunks)
            if end == len(texts) or len(some) > CACHE_CHUNKS // 4:
                self._learn(some)
                for own in texts[begin:end]:
                    at = np.fromiter(map(self.number.__getitem__, own), dtype=np.int64, count=len(own))
                    lettered.append(bool(self.letters[at].any()))
                    if not self.languages or not lettered[-1]:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    total = self.rows[at].sum(axis=0)
                    best = int(total.argmax())
                    langs.append(self.languages[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
                begin, some = end, set()
        return langs, scores, lettered


def _predict(pieces: list[str], languages: list[str], probabilities: np.ndarray, over):
    """A task that gives ``over`` its batches and a function from texts to languages, scores and whether they have a letter.

    Model, lattice and dictionary are made once for a worker process, not once a task.
    """
    key = f"language-{uuid.uuid4().hex}"

    def run(batches: Iterator) -> Iterator:
        scorer = held_by_worker(key, lambda: Scorer(pieces, languages, probabilities))
        yield from over(batches, scorer.predicted)

    return run


def predict(docs: DataFrame, learned: tuple[list[str], list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score: the language with the highest likelihood and its share of all likelihoods."""
    def over(batches, predicted):
        for batch in batches:
            langs, scores, _ = predicted(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": langs, "score": scores})

    return docs.select(hide_null(), "text").mapInPandas(
        _predict(*learned, over), "doc_id long, lang_pred string, score double"
    ).withColumn("doc_id", show_null())


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Learns from documents with a lang that are not held out, and predicts all of them from their text alone.

    For each language, a text's probability is the product over its words of the sum over all ways to cut the word into pieces of a
    public vocabulary, by the forward algorithm; piece probabilities come from expectation maximisation over the
    counted words. In a task each distinct chunk of text is scored once, in a dictionary of bounded size.

    Returns one row for each row of ``docs``: doc_id, held_out, lang_pred, score. A null text, or one without a letter, is ``und`` with score
    0, and so is every text if no document has a lang. Equal likelihoods go to the first language by name. Null
    and repeated ids are returned as they are; an empty table gives an empty result.
    """
    learned = learn(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))), path)
    return predict(docs, learned).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` without null texts and texts without a letter, and with the predicted language where ``lang`` is null.

    Nothing else goes, and a language that is there stays as it is: where no language was learned, every text with a letter stays,
    and null languages stay null. All other columns are as they were.
    """
    learned = learn(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))), path)

    def over(batches, predicted):
        for batch in batches:
            langs, _, lettered = predicted(batch.column("text").to_pylist())
            at = batch.schema.get_field_index("lang")
            told = pa.array([None if lang == UNKNOWN else lang for lang in langs], batch.schema.field(at).type)
            batch = batch.set_column(at, batch.schema.field(at), pc.coalesce(batch.column(at), told))
            yield batch.filter(pa.array(lettered, pa.bool_()))

    return docs.mapInArrow(_predict(*learned, over), docs.schema)
