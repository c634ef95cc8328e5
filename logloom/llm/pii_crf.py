"""Personal data in texts: patterns with checks, and a linear-chain conditional random field beside them.

The patterns find e-mail and IP addresses, payment cards (Luhn's check) and international phone numbers.
The chain reads a text's words by their shapes and labels them as beginning, inside or outside of the
same four kinds, so it also finds forms the patterns leave out, such as numbers without a country code
or addresses with blanks around the sign. It is trained in numpy from a small labelled table.

A word more than `REACH` places from all words with a digit or an @ is always outside. Stretches of other
words are therefore independent of each other given their neighbours' shapes, and decoding them alone
(Viterbi, all stretches of one length at a time) is decoding the whole text. Spans of the chain that overlap one of the
patterns, or that hold too few or too many digits, are dropped; those of the patterns stay.

Positions count code points. NULL and empty texts have no spans; repeated rows give repeated results; an
empty table gives an empty one.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.arrays import blocks
from logloom.llm.tables import whole_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_N = len(LABELS)
#: Places of the table of feature weights.
FEATURES = 1 << 13

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole, which is what the plain patterns find, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKED = re.compile(r"[0-9@]")
#: Places around a word with a digit or an @ that the chain reads too: names and hosts may have neither.
REACH = 2

Span = tuple[str, int, int]


# Patterns


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @, the characters of a local part before it and the domain behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = text.find("@", free)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _is_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def _is_card(match: str) -> bool:
    digits = _digits(match)
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(match: str) -> bool:
    return 9 <= len(_digits(match)) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)]
    for kind, pattern, holds in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m.group())]
    return found


# The chain


def _shape(word: str) -> str:
    """Classes of characters of the whole word; runs of letters as one, runs of digits with their length up to 6."""
    runs = re.sub(r"[^\W\d_]+", "a", word)
    return re.sub(r"[0-9]+", lambda m: f"d{min(len(m.group()), 6)}", runs)


def _features(words: Sequence[str], n: int) -> list[int]:
    """Places of a word's features in the table of weights."""
    word = words[n]
    digits = sum(c.isdigit() for c in word)
    around = [_shape(words[k]) if 0 <= k < len(words) else "|" for k in (n - 1, n + 1)]
    shape = _shape(word)
    named = (
        f"s{shape}", f"d{min(digits, 20)}", f"p{around[0]}", f"n{around[1]}", f"ps{around[0]}~{shape}",
        f"sn{shape}~{around[1]}", f"a{'@' in word}", f"t{word.count('.')}", f"h{word.count('-')}",
        f"b{word[:1] in '+('}{word[-1:] == ')'}", "w",
    )
    return [zlib.crc32(f.encode()) % FEATURES for f in named]


@dataclass(frozen=True)
class Chain:
    """Weights of features by label, and of label pairs; label O stands before and behind a stretch."""

    weights: np.ndarray
    pairs: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """Best labels of stretches of one length: features (stretches, words, places)."""
        scores = self.weights[features].sum(axis=2)
        n, length, _ = scores.shape
        best = scores[:, 0] + self.pairs[0]
        back = np.zeros((n, length, _N), dtype=np.int8)
        for t in range(1, length):
            each = best[:, :, None] + self.pairs
            back[:, t] = each.argmax(axis=1)
            best = each.max(axis=1) + scores[:, t]
        labels = np.zeros((n, length), dtype=np.int8)
        labels[:, -1] = (best + self.pairs[:, 0]).argmax(axis=1)
        for t in range(length - 1, 0, -1):
            labels[:, t - 1] = back[np.arange(n), t, labels[:, t]]
        return labels


def _allowed() -> np.ndarray:
    """Inside follows its own beginning or inside only."""
    pairs = np.zeros((_N, _N))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        pairs[:, inside] = -1e4
        pairs[[inside - 1, inside], inside] = 0
    return pairs


def train(rows: Sequence[tuple[Sequence[str], Sequence[str]]], rounds: int = 150, rate: float = 0.3,
          decay: float = 1e-4) -> Chain:
    """Fit a chain to labelled stretches (words, labels) by the gradient of their likelihood.

    Words beyond the reach of marked ones, labelled O, only lend their shapes.
    """
    fixed = _allowed()
    by_length: dict[int, list] = {}
    for words, labels in rows:
        for first, last in _stretches(words):
            x = [_features(words, n) for n in range(first, last)]
            y = [LABELS.index(labels[n]) for n in range(first, last)]
            by_length.setdefault(last - first, []).append((x, y))
    batches = [(np.array([x for x, _ in b]), np.array([y for _, y in b])) for b in by_length.values()]
    total = sum(len(x) for x, _ in batches)
    weights, pairs = np.zeros((FEATURES, _N)), np.zeros((_N, _N))
    seen_w, seen_p = np.full_like(weights, 1e-8), np.full_like(pairs, 1e-8)
    for _ in range(rounds):
        grad_w, grad_p = decay * weights, decay * pairs
        for x, y in batches:
            node, edge = _marginals(weights[x].sum(axis=2), pairs + fixed)
            node[np.arange(len(y))[:, None], np.arange(y.shape[1])[None], y] -= 1
            np.add.at(grad_w, x, node[:, :, None, :] / total)
            padded = np.pad(y, ((0, 0), (1, 1)))
            edge = edge / total
            np.add.at(edge, (padded[:, :-1].ravel(), padded[:, 1:].ravel()), -1 / total)
            grad_p += edge
        seen_w += grad_w**2
        seen_p += grad_p**2
        weights = weights - rate * grad_w / np.sqrt(seen_w)
        pairs = pairs - rate * grad_p / np.sqrt(seen_p)
    return Chain(weights, pairs + fixed)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _marginals(scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels at every place, and the expected number of every label pair, by the
    forward and backward sums."""
    n, length, _ = scores.shape
    ahead = np.zeros_like(scores)
    behind = np.zeros_like(scores)
    ahead[:, 0] = pairs[0] + scores[:, 0]
    for t in range(1, length):
        ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + pairs, 1) + scores[:, t]
    behind[:, -1] = pairs[:, 0]
    for t in range(length - 2, -1, -1):
        behind[:, t] = _log_sum(pairs + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    whole = _log_sum(ahead[:, -1] + pairs[:, 0], 1)
    node = np.exp(ahead + behind - whole[:, None, None])
    edge = np.zeros_like(pairs)
    edge[0] += node[:, 0].sum(axis=0)
    edge[:, 0] += node[:, -1].sum(axis=0)
    for t in range(1, length):
        each = ahead[:, t - 1][:, :, None] + pairs + (scores[:, t] + behind[:, t])[:, None, :] - whole[:, None, None]
        edge += np.exp(each).sum(axis=0)
    return node, edge


def _runs(places: Sequence[int]) -> list[tuple[int, int]]:
    """Runs [first, last) of consecutive numbers."""
    if not len(places):
        return []
    at = np.asarray(places)
    edges = np.flatnonzero(np.diff(at) != 1) + 1
    return [(int(r[0]), int(r[-1]) + 1) for r in np.split(at, edges)]


def _stretches(words: Sequence[str]) -> list[tuple[int, int]]:
    """Runs [first, last) of words within reach of a marked one."""
    near = np.zeros(len(words) + 2 * REACH, dtype=bool)
    for n, word in enumerate(words):
        if _MARKED.search(word):
            near[n: n + 2 * REACH + 1] = True
    return _runs(np.flatnonzero(near[REACH: REACH + len(words)]))


# The labelled table


def labelled_table(n: int = 1500, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """A small table of labelled stretches made by a rule: personal data in many written forms, and
    numbers that look alike but are none (dates, prices, versions, counts, keys, failed checks), among
    plain words."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    plain = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
    end = lambda: rng.choice(["", "", "", ",", "."])

    def card() -> str:
        body = digits(15)
        return next(body + d for d in "0123456789" if _luhn(body + d))

    def email() -> list[str]:
        name, host = plain() + rng.choice(["", ".", "_"]) + digits(rng.randint(0, 2)), plain() + digits(rng.randint(0, 1))
        tail = rng.choice(["example.com", "example.org", "mail.example.net"])
        return rng.choice([[f"{name}@{host}.{tail}"], [f"{name}@{host}.{tail}"], [f"<{name}@{host}.{tail}>"],
                           [f"{name}@", f"{host}{rng.randint(1, 9)}.{tail}"], *split()])

    def split() -> list[list[str]]:
        """With blanks around the sign, mostly without a digit."""
        name = plain() + rng.choice(["", "", f".{plain()}", f"_{plain()}", digits(2)])
        host = rng.choice(["", "", f"{plain()}."]) + f"{plain()}.{rng.choice(['com', 'org', 'net', 'co.uk', 'de'])}"
        return [[f"{name}@", host], [name, f"@{host}"], [name, "@", host]]

    def phone() -> list[str]:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([
            [f"+{rng.randint(1, 99)}", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"],
            [f"+{rng.randint(1, 99)}-{a}-{b}-{c}"], [f"({a}){b}-{c}"], [f"+{digits(11)}"],
        ])

    def four() -> list[str]:
        c = card()
        return [c[k: k + 4] for k in range(0, 16, 4)]

    def other() -> list[str]:
        return rng.choice([
            [f"{rng.randint(1900, 2099)}"], [digits(rng.randint(1, 3))], [f"{rng.randint(1, 12)}/{rng.randint(1, 28)}/{digits(4)}"],
            [f"{digits(4)}-{digits(2)}-{digits(2)}"], [f"v{digits(1)}.{digits(1)}.{digits(2)}"], [f"${digits(3)}.{digits(2)}"],
            [f'"{rng.getrandbits(160):040x}"'], [digits(16)], [digits(rng.randint(5, 12))], [plain() + digits(2)],
            [f"{digits(1)},{digits(3)}"], [f"{digits(2)}:{digits(2)}:{digits(2)}"], [f"@{plain()}"], [f"{digits(2)}%"],
            [f"{rng.randint(256, 999)}.{digits(3)}.{digits(3)}.{digits(3)}"], [digits(4), digits(4)], [f"{digits(2)}-{digits(2)}"],
            [digits(3), digits(3)], ["2.0."], [f"({digits(1)})"], [f"({digits(4)})"], [f"[{digits(2)}]"],
            ["@", plain()], [digits(1), "@", f"{digits(1)}.{digits(2)}"], [f"{plain()}.{plain()}", digits(2)],
        ])

    rows = []
    for _ in range(n):
        words, labels = [plain()], ["O"]
        for _ in range(rng.randint(1, 3)):
            kind = rng.choice(["email", "ip", "card", "phone", "phone", *["O"] * 5])
            found = {
                "email": email, "phone": phone, "O": other,
                "card": lambda: rng.choice([[card()], four(), ["-".join(four())]]),
                "ip": lambda: [".".join(str(rng.randint(0, 255)) for _ in range(4))],
            }[kind]()
            words += [*found[:-1], found[-1] + end()]
            labels += ["O"] * len(found) if kind == "O" else [f"B-{kind}", *[f"I-{kind}"] * (len(found) - 1)]
            for _ in range(rng.randint(1, 3)):
                words.append(plain() + end())
                labels.append("O")
        rows.append((words, labels))
    return rows


@lru_cache(maxsize=1)
def default_chain() -> Chain:
    return train(labelled_table())


# Whole texts


def _plausible(kind: str, found: str) -> bool:
    digits = len(_digits(found))
    if kind == "email":
        return next(_emails("".join(found.split())), None) is not None
    if kind == "phone":
        return 7 <= digits <= 15 and not found.isdigit()
    return _is_ip(found) if kind == "ip" and re.fullmatch(r"[0-9.]+", found) else kind == "card" and _is_card(found)


def chain_spans(texts: Sequence[str], chain: Chain) -> list[list[Span]]:
    """Spans of the chain in each text, before they are held against those of the patterns."""
    waiting: dict[int, list] = {}
    spans: list[list[Span]] = [[] for _ in texts]
    for n, text in enumerate(texts):
        if not _MARKED.search(text):
            continue
        found = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [text[a:b] for a, b in found]
        for first, last in _stretches(words):
            features = [_features(words, k) for k in range(first, last)]
            waiting.setdefault(last - first, []).append((n, found[first:last], features))
    for stretches in waiting.values():
        labels = chain.decode(np.array([f for _, _, f in stretches]))
        for (n, places, _), row in zip(stretches, labels.tolist(), strict=True):
            spans[n] += _spans(texts[n], places, row)
    return spans


def _spans(text: str, places: list[tuple[int, int]], labels: list[int]) -> Iterator[Span]:
    first = None
    for k, label in enumerate([*labels, 0]):
        if first is not None and (label == 0 or label % 2 == 1):
            kind = KINDS[(labels[first] - 1) // 2]
            a, b = places[first][0], places[k - 1][1]
            body = text[a:b]
            a += len(body) - len(body.lstrip("<[\"',;:"))
            b -= len(body) - len(body.rstrip(">]\"',;:.!?#$%&*|"))
            if a < b and _plausible(kind, text[a:b]):
                yield kind, a, b
            first = None
        if label % 2 == 1:
            first = k


def _with_chain(base: list[Span], more: list[Span]) -> list[Span]:
    """All spans by kind and start; of the chain's only those that overlap no other."""
    taken = sorted((a, b) for _, a, b in base)
    added, at = [], 0
    for kind, a, b in sorted(more, key=lambda s: s[1:]):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at == len(taken) or taken[at][0] >= b:
            added.append((kind, a, b))
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), *s[1:]))


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def spans_of(texts: Sequence[str], chain: Chain) -> list[tuple[list[Span], list[Span]]]:
    """Spans of the patterns, and all spans, of each text."""
    base = [base_spans(t) if _MARKED.search(t) else [] for t in texts]
    return [(b, _with_chain(b, c)) for b, c in zip(base, chain_spans(texts, chain), strict=True)]


def redact(text: str, spans: Sequence[Span]) -> str:
    """The text with every span replaced by its kind; of spans that overlap the first by start, the longer
    first, and what a later one covers beyond it goes with it."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out.append(text[at:a] + f"[{kind.upper()}]")
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, number of spans of the patterns per kind, the SHA-256 of those, and all spans as
    `kind:start:end`, joined by commas. One pass, no shuffle; the chain's weights, a table of fixed size, go
    to all tasks."""
    chain = docs.sparkSession.sparkContext.broadcast(default_chain())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in blocks(batches, "text"):
            found = spans_of(rows.column("text").to_pylist(), chain.value)
            yield pa.record_batch({
                "doc_id": rows.column("doc_id"),
                **{f"n_{k}": pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS},
                "base_sha256": pa.array([sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string()),
                "spans": pa.array([written(all_) for _, all_ in found], pa.string()),
            })

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(find, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def redact_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with all spans of their texts replaced by their kinds; other columns stay as they
    are, and so does a NULL text."""
    chain = docs.sparkSession.sparkContext.broadcast(default_chain())
    names = docs.columns
    place = names.index(text)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in blocks(batches, text):
            texts = rows.column(place).to_pylist()
            found = spans_of([t or "" for t in texts], chain.value)
            clean = [t if t is None else redact(t, s) for t, (_, s) in zip(texts, found, strict=True)]
            columns = [rows.column(n) if n != place else pa.array(clean, pa.string()) for n in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(replace, docs.schema)
