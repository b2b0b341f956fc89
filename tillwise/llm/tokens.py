"""Token ids of whole texts, exactly as the ``tokenizers`` library gives them, inside tasks.

For vocabularies whose pre-tokens never reach over white space (``word_bpe_49k.json`` drops it), the
ids of a text are those of its chunks between ASCII white space, one after the other. So each
worker asks the library once for each distinct chunk and keeps the answers in a bounded dictionary.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CACHE_ENTRIES = 600_000  # chunks
STEM_ENTRIES = 1_200_000
TOGETHER = 64  # words in one call of the library
_TAIL = b".,!?:;%&#*$|)(\"-"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_chunk(chunk: bytes) -> tuple[bytes, ...]:
    """A chunk in one or two parts, whose ids together are those of the chunk.

    Upper case is folded and trailing marks are parted where that can't change the ids: letters and marks never
    share a pre-token, and the vocabulary has lower case only.
    """
    if b"<|" in chunk:  # may hold a special token, which is matched as it stands
        return (chunk,)
    low = chunk.lower()
    stem = low.rstrip(_TAIL)
    if not stem or stem == low or not _ends_in_letter(stem):
        return (low,)
    return stem, low[len(stem):]


class ChunkTokens:
    """ids(text): uint32 ids of a text. Memory is bounded: a full dictionary starts afresh."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.entries = entries
        self.chunks: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.last[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _library_ids(self, part: bytes) -> bytes:
        found = self.library.encode(part.decode("utf-8"), add_special_tokens=False).ids
        return np.array(found, dtype="<u4").tobytes()

    def _learn_stems(self, stems: list[bytes]) -> None:
        """Asks the library. Words of plain letters are one pre-token each and go together, as their last ids tell the ends."""
        known = self.stems
        if len(known) + len(stems) > STEM_ENTRIES:
            known.clear()
        plain, other = [], []
        for stem in stems:
            word = stem.decode("utf-8")
            # ASCII letters are plain; of the rest, letters up to U+024F but U+0130, whose lower case has a mark.
            if word.isalpha() and (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word)):
                plain.append((stem, word))
            else:
                other.append(stem)
        for k in range(0, len(plain), TOGETHER):
            some = plain[k:k + TOGETHER]
            ids = np.array(self.library.encode_batch_fast([" ".join([w for _, w in some])], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                data, start = ids.tobytes(), 0
                for (stem, _), end in zip(some, (ends * 4).tolist(), strict=True):
                    known[stem] = data[start:end]
                    start = end
            else:
                other += [stem for stem, _ in some]
        for stem in other:
            known[stem] = self._library_ids(stem)

    def learn(self, chunks: set[bytes]) -> None:
        known, stems = self.chunks, self.stems
        new = chunks.difference(known)
        if len(known) + len(new) > self.entries:
            known.clear()
            new = chunks
        split = [(chunk, split_chunk(chunk)) for chunk in new]
        missing = {part for _, parts in split for part in parts}.difference(stems)
        if missing:
            self._learn_stems(list(missing))
        for chunk, parts in split:
            try:
                known[chunk] = stems[parts[0]] if len(parts) == 1 else stems[parts[0]] + stems[parts[1]]
            except KeyError:  # the stems were emptied in between
                known[chunk] = b"".join(map(self._library_ids, parts))

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<u4")
        chunks = text.encode("utf-8").split()
        try:
            found = b"".join(map(self.chunks.__getitem__, chunks))
        except KeyError:
            self.learn(set(chunks))  # afterwards all of them are known, also if the dictionary was emptied
            found = b"".join(map(self.chunks.__getitem__, chunks))
        return np.frombuffer(found, dtype="<u4")

    def count(self, part: bytes) -> int:
        return len(self._library_ids(part)) // 4


def _ends_in_letter(stem: bytes) -> bool:
    last = stem[-1]
    if last < 0x80:
        return 97 <= last <= 122 or 48 <= last <= 57
    char = stem.decode("utf-8")[-1]
    return char < "\u0250" and char.isalpha() and char.lower() != "i\u0307"  # that one ends in a mark


@lru_cache(maxsize=2)
def tokens_of(path: str) -> ChunkTokens:
    """One for each worker process and vocabulary."""
    return ChunkTokens(path)
