"""Encode each distinct word of a worker's texts once, and whole texts by looking their words up."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from logloom.llm.arrays import byte_prefixes, mix

#: Most distinct words a worker remembers; beyond it the memory starts anew, with the same ids.
MAX_WORDS = 1_500_000


class WordCache:
    """Ids of words by their 64-bit hash.

    `encode` takes a list of words and returns their ids in a row and the number of ids of each. Two of
    a worker's words share a hash with a chance of about n^2 / 2^65, one in 10^7 at the limit above.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], max_words: int = MAX_WORDS):
        self.encode_words = encode
        self.max_words = max_words
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.number = np.zeros(0, dtype=np.int64)
        self.bounds = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.uint16)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        flat, lengths = self.encode_words(words)
        bounds = self.bounds[-1] + np.cumsum(lengths)
        if bounds[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(int(bounds[-1]), np.uint16)])
        self.ids[self.bounds[-1]: bounds[-1]] = flat
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.number = np.insert(self.number, at, len(self.bounds) - 1 + np.arange(len(words)))
        self.bounds = np.concatenate([self.bounds, bounds])

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words [start, end) of UTF-8 `data` in a row, and the number of ids of each."""
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if len(self.hashes) > self.max_words:
            self._forget()
        hashes = mix(byte_prefixes(data).of(starts, ends) + (ends - starts).astype(np.uint64))
        order = np.argsort(hashes)
        in_order = hashes[order]
        new = np.empty(len(order), dtype=bool)
        new[0] = True
        np.not_equal(in_order[1:], in_order[:-1], out=new[1:])
        distinct, example = in_order[new], order[new]
        at = np.searchsorted(self.hashes, distinct)
        fresh = np.ones(len(distinct), dtype=bool)
        inner = at < len(self.hashes)
        fresh[inner] = self.hashes[at[inner]] != distinct[inner]
        if fresh.any():
            held = data.tobytes()
            chosen = example[fresh]
            self._learn(distinct[fresh], [
                held[s:e].decode() for s, e in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)])
            at = np.searchsorted(self.hashes, distinct)
        word = np.empty(len(order), dtype=np.int64)
        word[order] = np.repeat(self.number[at], np.diff(np.flatnonzero(new), append=len(order)))
        first = self.bounds[word]
        lengths = self.bounds[word + 1] - first
        before = np.cumsum(lengths) - lengths
        return self.ids[np.arange(int(lengths.sum())) + np.repeat(first - before, lengths)], lengths
