"""Encoding texts word by word, each distinct word once."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

CACHED_WORDS = 300_000  # of one generation
SEEN_BITS = 23  # slots that remember which words were met


class Remembered:
    """Encoded words, remembered from the second batch on that they are met in.

    Most words come once.  The remembered ones live in two generations: when the younger
    one is full it becomes the older one, and words that are met again move over.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], words: int = CACHED_WORDS) -> None:
        self.encode, self.words = encode, words
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = np.zeros(2**SEEN_BITS, bool)

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def __call__(self, words: list[str]) -> list[bytes]:
        """The encodings of distinct words."""
        if len(self.known) > self.words:
            self.older, self.known = self.known, {}
        if np.count_nonzero(self.seen) > len(self.seen) // 2:
            self.seen[:] = False
        known, older = self.known, self.older
        out = list(map(known.get, words))
        fresh = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            ids = older.get(words[k])
            if ids is None:
                fresh.append(k)
            else:
                known[words[k]] = out[k] = ids
        new = [words[k] for k in fresh]
        slots = np.fromiter(map(hash, new), np.int64, len(new)) & (2**SEEN_BITS - 1)
        again = self.seen[slots].tolist()
        self.seen[slots] = True
        for k, word, ids, keep in zip(fresh, new, self.encode(new), again):
            out[k] = ids
            if keep:
                known[word] = ids
        return out


class WordEncoder:
    """Ids of whole texts, joined from the ids of the pieces between their spaces.

    Right for tokenizers that never join a space to what stands before it; texts that match
    ``odd`` are encoded whole.  ``encode`` encodes pieces and texts to little-endian bytes.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[bytes]], odd: re.Pattern, words: int = CACHED_WORDS
    ) -> None:
        self.encode, self.odd, self.words = encode, odd, Remembered(encode, words)

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        usual, whole = [], []
        for k, text in enumerate(texts):
            if text:
                (whole if self.odd.search(text) else usual).append(k)
        for k, ids in zip(whole, self.encode([texts[k] for k in whole])):
            out[k] = ids
        pieces = [texts[k].split(" ") for k in usual]
        distinct = list(set().union(*pieces))
        ids_of = dict(zip(distinct, self.words(distinct)))
        for k, piece in zip(usual, pieces):
            out[k] = b"".join([ids_of[w] for w in piece])
        return out
