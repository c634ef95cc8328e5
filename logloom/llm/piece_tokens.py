"""SentencePiece BPE with byte fallback, by merge rounds over flat arrays of symbols.

The words of many texts lie behind each other in one array. A round looks up the rank of every pair of
neighbours, takes the smallest rank of each word, and merges the leftmost pair of that rank; a word in
which no later merge can come before the remaining pairs of that rank merges all of them at once. The
array is then closed up, finished words leave it, and the rounds end when no pair has a rank. Symbols
that are not in the vocabulary at the end become bytes.

A word is a run of spaces with the characters up to the next space; no piece of the vocabulary has a
space behind another character, which is checked, so no merge crosses the border of two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from logloom.llm.arrays import blocks
from logloom.llm.tables import whole_text
from logloom.llm.word_cache import WordCache

_PASS_BYTES = 2 << 20
_SPACE = 0x20
_BLANK = "▁"
_NONE = np.int64(1) << 40  # rank of a pair that no piece joins
# Kinds of pieces in the model file.
_NORMAL, _USER_DEFINED, _BYTE = 1, 4, 6


class Merges:
    """The vocabulary as arrays: which pairs join, to what, and at which rank."""

    def __init__(self, path: str):
        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("only models that keep texts as they are")
        pieces = [p.piece for p in model.pieces]
        kinds = [p.type for p in model.pieces]
        if any(_BLANK in p.lstrip(_BLANK) for p, k in zip(pieces, kinds, strict=True) if k == _NORMAL):
            raise ValueError("a piece has a space behind another character")
        if _USER_DEFINED in kinds or len(pieces) >= 1 << 16 or model.trainer_spec.model_type != 2:
            raise ValueError("only BPE without pieces of the user's own, with ids of 16 bits")
        self.prefix = normal.add_dummy_prefix
        self.end = model.trainer_spec.eos_id
        self.unknown = model.trainer_spec.unk_id
        self.n_pieces = len(pieces)
        self.bytes = np.full(256, self.unknown, dtype=np.int64)
        for n, (piece, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind == _BYTE:
                self.bytes[int(piece[3:5], 16)] = n
        ids = {p: n for n, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == _NORMAL}
        # A character outside the vocabulary may still be part of a piece: it gets a number behind it.
        symbols = dict(ids)
        for piece in ids:
            for c in piece:
                symbols.setdefault(c, len(pieces) + len(symbols))
        self.characters = {c: n for c, n in symbols.items() if len(c) == 1}
        # Equal scores rank equally; of them the leftmost pair goes first.
        scores = sorted({model.pieces[n].score for n in ids.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        rank = {p: rank_of[model.pieces[n].score] for p, n in ids.items()}
        pairs = {}
        joined_with: dict[str, int] = {}  # best rank of a piece that starts or ends with this one
        for piece, n in ids.items():
            for at in range(1, len(piece)):
                left, right = piece[:at], piece[at:]
                if left in symbols and right in symbols:
                    pairs[symbols[left] << 32 | symbols[right]] = (n, rank[piece])
                    for part in (left, right):
                        joined_with[part] = min(joined_with.get(part, len(scores)), rank[piece])
        keys = np.array(sorted(pairs), dtype=np.int64)
        values = np.array([pairs[k] for k in keys.tolist()], dtype=np.int64).reshape(-1, 2)
        self.keys, self.joined, self.ranks = keys, values[:, 0], values[:, 1]
        # Merging every pair at once is safe if no piece made with the result ranks at or before it, and
        # if the rank belongs to one piece.
        pieces_of_rank = np.bincount(list(rank.values()), minlength=len(scores))
        self.at_once = np.zeros(len(scores), dtype=bool)
        for piece, r in rank.items():
            self.at_once[r] = joined_with.get(piece, len(scores)) > r and pieces_of_rank[r] == 1
        self._by_hash()

    def _by_hash(self) -> None:
        """A table with open addressing for the pairs."""
        size = 1 << max(4, int(np.ceil(np.log2(max(len(self.keys), 1) * 4))))
        self.mask = size - 1
        self.table = np.full(size, -1, dtype=np.int64)
        place = self._place(self.keys)
        left = np.arange(len(self.keys))
        while len(left):
            free = self.table[place] < 0
            self.table[place[free]] = left[free]  # of those that meet, the last stays
            settled = self.table[place] == left
            left, place = left[~settled], (place[~settled] + 1) & self.mask
        self.held = np.append(self.keys, -1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(40)).astype(np.int64) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of every pair, -1 for those that do not join."""
        keys = left << 32 | right
        place = self._place(keys)
        found = self.table[place]
        open_ = np.flatnonzero((found >= 0) & (self.held[found] != keys))
        while len(open_):
            place[open_] = (place[open_] + 1) & self.mask
            found[open_] = self.table[place[open_]]
            open_ = open_[(found[open_] >= 0) & (self.held[found[open_]] != keys[open_])]
        return found

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge within words until no pair joins. `word` numbers the word of every symbol, ascending."""
        done_symbols, done_words = [], []
        while len(symbols) > 1:
            found = self.find(symbols[:-1], symbols[1:])
            found[word[:-1] != word[1:]] = -1
            rank = np.where(found >= 0, self.ranks[found], _NONE) if len(self.keys) else np.full(len(found), _NONE)
            rank = np.append(rank, _NONE)
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(starts, append=len(word))
            active = best < _NONE
            if not active.all():
                out = np.repeat(~active, size)
                done_symbols.append(symbols[out])
                done_words.append(word[out])
                keep = ~out
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                found = np.append(found, -1)[keep]
                best, size = best[active], size[active]
                if not len(symbols):
                    break
            else:
                found = np.append(found, -1)
            goal = np.repeat(best, size)
            hits = np.flatnonzero(rank == goal)
            # leftmost first: of hits next to each other in a run, every second one, from its left end
            first = np.ones(len(hits), dtype=bool)
            first[1:] = word[hits[1:]] != word[hits[:-1]]
            run = np.ones(len(hits), dtype=bool)
            run[1:] = hits[1:] != hits[:-1] + 1
            in_run = np.arange(len(hits)) - np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
            chosen = hits[first | (self.at_once[goal[hits]] & (in_run % 2 == 0))]
            symbols[chosen] = self.joined[found[chosen]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            symbols, word = symbols[keep], word[keep]
        done_symbols.append(symbols)
        done_words.append(word)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and the number of ids of each."""
        text = "".join(words).replace(" ", _BLANK)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.uint16), np.zeros(len(words), np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        distinct, at = np.unique(points, return_inverse=True)
        # Characters of no piece get numbers of their own behind all others; they never join.
        outside = 1 << 30
        symbol = np.array([self.characters.get(chr(c), outside + c) for c in distinct.tolist()], dtype=np.int64)
        symbols, word = self.merge(symbol[at], word)
        return self._with_bytes(symbols, word, len(words))

    def _with_bytes(self, symbols, word, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        strange = np.flatnonzero(symbols >= self.n_pieces)
        if len(strange):
            characters = {n: c for c, n in self.characters.items()}
            spelled = [
                self.bytes[np.frombuffer((characters[s] if s in characters else chr(s - (1 << 30))).encode(), np.uint8)]
                for s in symbols[strange].tolist()
            ]
            counts = np.ones(len(symbols), dtype=np.int64)
            counts[strange] = [len(b) for b in spelled]
            word = np.repeat(word, counts)
            symbols = np.repeat(symbols, counts)
            at = np.repeat(np.isin(np.arange(len(counts)), strange), counts)
            symbols[at] = np.concatenate(spelled)
        return symbols.astype(np.uint16), np.bincount(word, minlength=n_words)


def word_cuts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Starts of words: of every text, and of every run of spaces inside."""
    n = len(data)
    space = data == _SPACE
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = space[1:] & ~space[:-1]
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[:n])


def _plain_spaces(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The character that stands for a space in pieces counts as one in texts, too."""
    a, b, c = _BLANK.encode()
    at = np.flatnonzero(data[:-2] == a) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[(data[at + 1] == b) & (data[at + 2] == c)]
    if not len(at):
        return offsets, data
    data = data.copy()
    data[at] = _SPACE
    return offsets - 2 * np.searchsorted(at, offsets), np.delete(data, np.concatenate([at + 1, at + 2]))


class Coder:
    """Whole texts to ids and back."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.words = WordCache(self.merges.encode_words)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by the end id, and the first id of every text (one more
        at the end)."""
        offsets, data = _plain_spaces(offsets, data)
        if self.merges.prefix:  # a text that holds anything gets a space in front
            sizes = np.diff(offsets)
            data = np.insert(data, offsets[:-1][sizes > 0], _SPACE)
            offsets = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
        starts = word_cuts(offsets, data)
        ids, lengths = self.words.encode(data, starts, np.append(starts[1:], len(data))[: len(starts)])
        before = np.concatenate([[0], np.cumsum(lengths)])
        firsts = before[np.searchsorted(starts, offsets)]
        return np.insert(ids, firsts[1:], self.merges.end), firsts + np.arange(len(firsts))

    def decode(self, ids: np.ndarray) -> str:
        return self.processor.decode(ids.tolist())


@lru_cache(maxsize=1)
def coder(path: str) -> Coder:
    """One coder per Python worker."""
    return Coder(path)


def encode_pieces(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id",
                  digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers, the end id last) and decoded text;
    with `digests` the SHA-256 of the decimal ids, joined by spaces, and of the decoded text instead.

    No shuffle. NULL and empty texts have the end id only; repeated rows give repeated results; an empty
    table gives an empty one; other columns of the input are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in blocks(batches, "text", _PASS_BYTES):
            ids, firsts = coder(model).encode(offsets, data)
            edges = firsts.tolist()
            each = [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            decoded = [coder(model).decode(i) for i in each]
            if digests:
                found = {
                    "ids_sha256": pa.array([sha256(" ".join(map(str, i.tolist())).encode()).hexdigest() for i in each]),
                    "decoded_sha256": pa.array([sha256(d.encode()).hexdigest() for d in decoded]),
                }
            else:
                found = {
                    "ids": pa.array([i.astype("<u4").tobytes() for i in each], pa.binary()),
                    "decoded": pa.array(decoded, pa.string()),
                }
            yield pa.record_batch(
                {"doc_id": rows.column("doc_id"), "n_tokens": pa.array(np.diff(firsts), pa.int64()), **found})

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    columns = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded string"
    return rows.mapInArrow(encode, f"doc_id bigint, n_tokens bigint, {columns}")
