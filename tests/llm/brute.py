"""Plain versions of the operators, and documents that are hard to handle."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: (doc_id, text): NULLs, empty and long texts, repeated rows, shared ids, odd white space.
ODD = [
    (1, "a b c d e f g h i j k"), (2, None), (3, ""), (4, "\n \t"), (None, "no id here but some words"),
    (None, None), (5, "a b c d e f g h i j k"), (5, "a b c d e f g h i j k"), (5, "another text of that id"),
    (6, "x" * 3000), (7, "w " * 4000), (8, "é à b　c  d\r\ne 漢字 😀 \x1c\x85"), (9, "<|endoftext|> ▁ a▁b don't I'll"),
    (-10, "One. Two!\nOne. Two!\n\nthree 3.5 +1 (017) 555-7713"),
]
COLUMNS = "doc_id bigint, text string, source string, n_words string, row string, chunk string, fingerprint string"


def frame(spark, rows, partitions=3):
    """A table of documents with columns whose names the operators use themselves."""
    data = [(i, t, None if i is None else f"s{i % 2}", "x", "y", "z", "w") for i, t in rows]
    return spark.createDataFrame(data, COLUMNS).repartition(partitions)


def read(name, sf="sf0.01"):
    import pyarrow.parquet as pq

    return pq.read_table(f"/root/testdata/{sf}/{name}.parquet").to_pandas()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def measures(text):
    text = text or ""
    words, seen = WORD.findall(text), {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeated = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated))


def word_repeats(rows, window):
    """Rows in order: (doc_id, n_words, n_removed, digest)."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")):
        words = [w.decode() for w in (text or "").encode().split()]
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            s = tuple(words[k:k + window])
            if s in seen:
                gone[k:k + window] = [True] * window
            seen.add(s)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), sha256(kept.encode()).hexdigest()))
    return out


def byte_repeats(rows, window):
    held = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(hash(b[k:k + window]) for _, b in held for k in range(len(b) - window + 1))
    out = []
    for i, b in held:
        change = np.zeros(len(b) + 1, int)
        for k in range(len(b) - window + 1):
            if counts[hash(b[k:k + window])] > 1:
                change[k] += 1
                change[k + window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def fingerprint(text):
    words = [w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))]
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else \
        [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Root of every place, by all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(prints, dtype=np.uint64)
    for a in range(len(prints)):
        for b in np.flatnonzero(np.bitwise_count(values[a] ^ values) <= 3).tolist():
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return [find(x) for x in range(len(prints))]


def shingles(text):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def near_groups(rows, found=None):
    """Least place of every component by the Jaccard similarity of all pairs; `found` collects those."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for b, y in enumerate(sets):
        for a, x in enumerate(sets[:b]):
            both = len(x & y)
            if x == y or (both and 5 * both >= 4 * (len(x) + len(y) - both)):
                if found is not None and x != y:
                    found.append((a, b))
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted({find(x) for x in range(len(rows))})


def personal(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(int(x) if i % 2 == 0 else sum(divmod(int(x) * 2, 10)) for i, x in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out
