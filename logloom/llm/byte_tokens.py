"""Ids of the byte-level BPE tokenizer for whole texts.

Texts are cut where the tokenizer's pattern starts a new pre-token whatever stands around it:

- before a space between two characters that are no white space, or at an edge of the text;
- before and behind a line break that stands so;
- behind a letter that a mark or digit of ASCII follows.

The library then encodes each distinct piece once per worker. Characters that only some libraries call
white space count as such, which merely leaves a piece longer.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from logloom.llm.word_cache import WordCache

#: Id that ends a document.
END_ID = 0

_SPACE, _BREAK = 0x20, 0x0A
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[0x21:0x7F] = ~_LETTER[0x21:0x7F]


# Letters behind at most one space are one pre-token, so the library's merges take them as they are.
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
# The characters by which the tokenizer's vocabulary spells bytes.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLED = dict(zip((b for b in range(256) if b not in _PRINTED), range(0x100, 0x200)))
_BLANK = chr(_SPELLED[_SPACE])


def _spelled(word: str) -> str:
    if word.isascii():
        return word.replace(" ", _BLANK)
    return word.encode().decode("latin-1").translate(_SPELLED)


def _wide_white(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the two first bytes may belong to white space of several bytes."""
    return (
        ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
        | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0)))
        | ((a == 0xE2) & ((b == 0x80) | (b == 0x81)))
        | ((a == 0xE3) & (b == 0x80))
        | ((a == 0xEF) & (b == 0xBB))
    )


def cuts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where pieces start, in ascending order; the starts of texts are among them."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    # Three bytes of padding stand for what lies beyond the edges; so does the border of two texts.
    padded = np.zeros(n + 6, dtype=np.uint8)
    padded[3:-3] = data
    starts = np.unique(offsets[:-1][offsets[:-1] < n])
    at_start = np.zeros(n + 1, dtype=bool)
    at_start[starts] = True
    at_start[n] = True

    def white_before(at):
        byte = lambda k: padded[at + 3 - k]
        return ~at_start[at] & (_WHITE[byte(1)] | _wide_white(byte(2), byte(1)) | _wide_white(byte(3), byte(2)))

    def white_behind(at):
        return ~at_start[at + 1] & (_WHITE[padded[at + 4]] | _wide_white(padded[at + 4], padded[at + 5]))

    spaces = np.flatnonzero(data == _SPACE)
    spaces = spaces[~(white_before(spaces) | white_behind(spaces))]
    breaks = np.flatnonzero(data == _BREAK)
    breaks = breaks[~(white_before(breaks) | white_behind(breaks))]
    marks = np.flatnonzero(_MARK[data])
    before, earlier = padded[marks + 2], padded[marks + 1]
    letter = _LETTER[before] | ((earlier == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7))
    marks = marks[letter & ~at_start[marks]]
    cut = np.zeros(n + 1, dtype=bool)
    for found in (starts, spaces, breaks, breaks + 1, marks):
        cut[found] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Encodes blocks of texts to flat arrays of ids."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")

        merges, letters = tokenizer.model.tokenize, _LETTERS.fullmatch

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            encoded = [
                [t.id for t in merges(_spelled(w))] if letters(w) else None
                for w in words
            ]
            others = [n for n, ids in enumerate(encoded) if ids is None]
            for n, e in zip(others, tokenizer.encode_batch_fast([words[n] for n in others], add_special_tokens=False)):
                encoded[n] = e.ids
            flat: list[int] = []
            for ids in encoded:
                flat += ids
            return np.array(flat, np.uint16), np.fromiter(map(len, encoded), np.int64, len(encoded))

        self.words = WordCache(encode)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by `END_ID`, and the first id of every text (one more
        at the end)."""
        starts = cuts(offsets, data)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        ids, lengths = self.words.encode(data, starts, ends)
        before = np.concatenate([[0], np.cumsum(lengths)])
        firsts = before[np.searchsorted(starts, offsets)]
        closed = np.insert(ids, firsts[1:], END_ID)
        return closed, firsts + np.arange(len(firsts))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)
