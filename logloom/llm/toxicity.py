"""Toxicity of texts from subword-bag embeddings and a linear softmax.

A word is half its own embedding and half the mean of those of its character n-grams, all hashed to one
table; a word that training did not meet often is its n-grams alone, which it shares with those it did. A window is the mean
of its words, by default of a single one, and a linear softmax over it gives the probability of label 1. A
text is as toxic as its worst window, however long the rest of it is.

Embeddings and softmax are trained jointly in numpy, on a bounded sample of labelled texts: `MAX_ROWS` per
label, of at most `MAX_BYTES` each, taken in the order of a hash of the id. Each round scores all windows
of the sample, then learns from the worst ones of every text. Rows held out never take part.

Texts are taken whole; a NULL or empty one has the softmax's value for no words. Repeated rows score
alike. Labels: NULL ones and rows without a document are left out; a document labelled twice counts by
its larger label. Without any sample the score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.arrays import blocks, byte_prefixes, mix
from logloom.llm.tables import whole_text

MAX_ROWS = 3000
MAX_BYTES = 20_000
BUCKETS, DIMENSIONS = 1 << 18, 8
#: Lengths of the character n-grams, in bytes: long enough for a stem with its mark of the begin.
GRAMS = (3, 4, 5, 6, 7, 8)
#: Words of a window.
WINDOW = 1
#: Grams that fewer texts of the sample hold have no vector: they could only tell single texts apart.
MIN_TEXTS = 4
PREDICTED = 0.7
#: Windows of a clean text that a round learns from.
WORST = 8
#: Rate of the embeddings for each of the other weights'.
GRAM_RATE = 20.0

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_EDGES = np.frombuffer(b"<>", np.uint8)


@dataclass(frozen=True)
class Words:
    """The words of texts: number of each word's spelling, first word of each text, and for every spelling
    its hash and the places of its grams, `grams[first[n]:first[n + 1]]`."""

    spelling: np.ndarray
    texts: np.ndarray
    hashes: np.ndarray
    grams: np.ndarray
    first: np.ndarray

    @classmethod
    def joined(cls, parts: list[Words]) -> Words:
        """Several blocks of texts as one, with each spelling once."""
        hashes = np.concatenate([p.hashes for p in parts])
        distinct, example, number = np.unique(hashes, return_index=True, return_inverse=True)
        before = np.cumsum([0, *(len(p.hashes) for p in parts)])
        words = np.cumsum([0, *(len(p.spelling) for p in parts)])
        grams = np.cumsum([0, *(len(p.grams) for p in parts)])
        begin = np.concatenate([p.first[:-1] + g for p, g in zip(parts, grams, strict=False)])[example]
        size = np.concatenate([np.diff(p.first) for p in parts])[example]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(begin - first[:-1], size)
        return cls(
            np.concatenate([number[p.spelling + b] for p, b in zip(parts, before, strict=False)]),
            np.concatenate([[0], *(p.texts[1:] + w for p, w in zip(parts, words, strict=False))]),
            distinct, np.concatenate([p.grams for p in parts])[at], first,
        )

    def shares(self, known: np.ndarray) -> np.ndarray:
        """Share of every gram in the vector of its word. The first gram of a word is the word itself; it has
        half where its place is `known`, and leaves all to the n-grams elsewhere."""
        size = np.diff(self.first)
        own = np.where(size == 1, 1.0, np.where(known[self.grams[self.first[:-1]]], 0.5, 0.0))
        shares = np.repeat((1 - own) / np.maximum(size - 1, 1), size)
        shares[self.first[:-1]] = own
        return shares

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First word of every window, and of which text it is."""
        size = WINDOW
        n = -(-np.diff(self.texts) // size)
        text = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        return self.texts[text] + inside * size, text


def words_of(offsets: np.ndarray, data: np.ndarray) -> Words:
    """Runs of letters, digits and characters beyond ASCII; A-Z count as a-z."""
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _INSIDE[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = byte_prefixes(data).of(starts, ends) + (ends - starts).astype(np.uint64)
    distinct, example, spelling = np.unique(hashes, return_index=True, return_inverse=True)
    return Words(spelling, np.searchsorted(starts, offsets), distinct, *_grams(data, starts[example], ends[example]))


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams of each word between its marks of begin and end, and of the whole word."""
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    n = ends - starts
    size = n + 2
    first = np.cumsum(size) - size
    marked = np.empty(int(size.sum()), dtype=np.uint8)
    inner = np.ones(len(marked), dtype=bool)
    inner[first] = inner[first + size - 1] = False
    marked[first], marked[first + size - 1] = _EDGES
    marked[inner] = data[np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)]
    prefixes = byte_prefixes(marked)
    word = np.repeat(np.arange(len(n)), size)
    behind = np.repeat(first + size, size)
    owners, places = [np.arange(len(n))], [mix(prefixes.of(first, first + size))]
    at = np.arange(len(marked))
    for k in GRAMS:
        whole = at + k <= behind
        owners.append(word[whole])
        places.append(mix(prefixes.of(at[whole], at[whole] + k) + np.uint64(k)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    grams = (np.concatenate(places)[order] % np.uint64(BUCKETS)).astype(np.int32)
    return grams, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])


@dataclass
class Model:
    """Embeddings of grams, weights of the softmax by label, and its offsets."""

    embeddings: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    @classmethod
    def untrained(cls) -> Model:
        """Nothing is known: every text scores 0.5."""
        return cls(np.zeros((BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), np.zeros(2))

    @classmethod
    def new(cls, seed: int = 3) -> Model:
        values = np.random.Generator(np.random.PCG64(seed)).uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
        weights = np.stack([-np.ones(DIMENSIONS), np.ones(DIMENSIONS)], axis=1)
        return cls(values, weights, np.zeros(2))

    def word_scores(self, words: Words) -> np.ndarray:
        """What each spelling adds to the log odds of label 1 of a window, before averaging."""
        per_gram = self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])
        if not len(words.grams):
            return np.zeros(0)
        known = self.embeddings.any(axis=1)
        return np.add.reduceat(per_gram[words.grams] * words.shares(known), words.first[:-1])

    def window_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, text and log odds of every window."""
        first, text = words.windows()
        if not len(first):
            return first, text, np.zeros(0)
        sums = np.add.reduceat(self.word_scores(words)[words.spelling], first)
        n = np.minimum(words.texts[text + 1] - first, WINDOW)
        return first, text, sums / n + self.offsets[1] - self.offsets[0]

    def scores(self, words: Words) -> np.ndarray:
        """Probability of label 1 of every text."""
        _, text, odds = self.window_scores(words)
        worst = np.full(len(words.texts) - 1, -np.inf)
        np.maximum.at(worst, text, odds)
        worst[np.isneginf(worst)] = self.offsets[1] - self.offsets[0]
        return 1 / (1 + np.exp(-np.clip(worst, -500, 500)))

    def packed(self) -> bytes:
        return b"".join(x.astype("<f4").tobytes() for x in (self.embeddings, self.weights, self.offsets))

    @classmethod
    def unpacked(cls, data: bytes) -> Model:
        x = np.frombuffer(data, "<f4").astype(np.float64)
        e = BUCKETS * DIMENSIONS
        return cls(x[:e].reshape(BUCKETS, DIMENSIONS), x[e:-2].reshape(DIMENSIONS, 2), x[-2:])


def _texts_of_grams(words: Words, chosen: np.ndarray) -> np.ndarray:
    """For every place of the table how many of some texts use it, a text counted once per word."""
    text = np.repeat(np.arange(len(words.texts) - 1), np.diff(words.texts))
    mine = chosen[text]
    pairs = np.unique(words.spelling[mine] * np.int64(len(words.texts)) + text[mine])
    texts = np.bincount(pairs // len(words.texts), minlength=len(words.hashes))
    return np.bincount(words.grams, np.repeat(texts, np.diff(words.first)), minlength=BUCKETS)


def _suspicion(words: Words, ones: np.ndarray, both: np.ndarray, share: float) -> np.ndarray:
    """How far each spelling's most telling gram is from being in toxic texts by chance, in standard
    deviations. A word of a single text says little by this measure, a stem that many share a lot."""
    expected = np.maximum(both * share, 1e-3)
    return np.maximum.reduceat(((ones - expected) / np.sqrt(expected))[words.grams], words.first[:-1])


def train(words: Words, labels: np.ndarray, rounds: int = 16, rate: float = 0.25, batch: int = 256, seed: int = 3) -> Model:
    """Fit a model to labelled texts: by the worst window of a toxic text, and by the `WORST` worst and one
    drawn at random of a clean one.

    Which window of a text is its worst, the first rounds take from counts of grams in toxic and other
    texts, later ones from the model. Labels weigh alike however often they occur.
    """
    if not len(words.spelling):
        return Model.untrained()
    model = Model.new(seed)
    ones = _texts_of_grams(words, labels == 1)
    both = ones + _texts_of_grams(words, labels == 0)
    known = both >= MIN_TEXTS
    shares = words.shares(known)
    model.embeddings[~known] = 0
    suspicion = _suspicion(words, ones, both, float(labels.mean()))
    rng = np.random.Generator(np.random.PCG64(seed))
    count = max(int(labels.sum()), 1)
    weight = np.where(labels == 1, 0.5 / count, 0.5 / max(len(labels) - count, 1)) * len(labels)
    for turn in range(rounds):
        first, text, odds = model.window_scores(words)
        worst = np.maximum.reduceat(suspicion[words.spelling], first) if turn < 3 else odds
        picked = rng.permutation(np.concatenate([
            _top(text, worst, np.where(labels == 1, 1, WORST)), _top(text, rng.random(len(first)), 1 - labels)]))
        for at in range(0, len(picked), batch):
            part = picked[at: at + batch]
            _step(model, words, shares, first[part], text[part], labels, weight, rate)
            model.embeddings[~known] = 0
    return model


def _top(text: np.ndarray, value: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The windows of the `k` largest values of each text, `k` by text."""
    order = np.lexsort((value, text))
    behind = np.cumsum(np.bincount(text))[text[order]] - np.arange(len(order))  # 1 for the last of its text
    return order[behind <= k[text[order]]]


def _step(model: Model, words: Words, shares, first, text, labels, weight, rate: float) -> None:
    """One step on some windows. Embeddings move by plain gradients, so that a gram moves as far as the
    windows that hold it agree; scaled ones would move the grams of a single text as far as common ones."""
    n = np.minimum(words.texts[text + 1] - first, WINDOW)
    window = np.repeat(np.arange(len(n)), n)
    word = words.spelling[np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)]
    begin, size = words.first[word], words.first[word + 1] - words.first[word]
    places = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    gram = words.grams[places]
    owner = np.repeat(np.arange(len(word)), size)
    share = shares[places] / n[window][owner]  # of each gram in its window's mean
    mean = np.zeros((len(n), DIMENSIONS))
    np.add.at(mean, window[owner], model.embeddings[gram] * share[:, None])
    logits = mean @ model.weights + model.offsets
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(n)), labels[text]] -= 1
    p *= weight[text][:, None]
    grad = (p @ model.weights.T)[window[owner]] * share[:, None]
    np.add.at(model.embeddings, gram, -rate * GRAM_RATE * grad)
    model.weights -= rate * (mean.T @ p) / len(n)
    model.offsets -= rate * p.sum(axis=0) / len(n)


def held_out(doc_id: Column) -> Column:
    """A third of all ids, by the crc32 of their decimal form."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """Train on a bounded sample of the labelled texts that are not held out. One task trains; the driver
    gets the finished weights, whose size is fixed."""
    known = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    order = F.xxhash64("doc_id")
    sized = texts.filter(F.octet_length("text") <= max_bytes).select("doc_id").distinct().join(known, "doc_id")
    chosen = [sized.filter(F.col("label") == n).orderBy(order, "doc_id").limit(max_rows) for n in (0, 1)]
    sample = texts.filter(F.octet_length("text") <= max_bytes).join(chosen[0].unionByName(chosen[1]), "doc_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).sort_by([("doc_id", "ascending"), ("text", "ascending")])
            words = Words.joined([words_of(o, d) for _, o, d in blocks(table.to_batches(), "text")])
            yield pa.record_batch({"model": [train(words, table["label"].to_numpy().astype(np.int64)).packed()]})

    rows = sample.select("doc_id", "text", "label").repartition(1).mapInArrow(learn, "model binary").collect()
    return Model.unpacked(bytes(rows[0]["model"])) if rows else Model.untrained()


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and prediction of every row. One pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(model.packed(), 1))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model.unpacked(zlib.decompress(sent.value))
        for rows, offsets, data in blocks(batches, "text"):
            scores = known.scores(words_of(offsets, data))
            yield pa.record_batch({
                "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"), "score": pa.array(scores),
                "predicted": pa.array((scores >= PREDICTED).astype(np.int32)),
            })

    identity = F.col(doc_id).cast("bigint")
    rows = docs.select(identity.alias("doc_id"), held_out(identity).alias("held_out"), whole_text(text).alias("text"))
    return rows.mapInArrow(judge, "doc_id bigint, held_out boolean, score double, predicted int")
