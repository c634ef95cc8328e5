import random
from collections import Counter

import brute
import pytest

from logloom.llm import block_anchors, exchange, suffix_repeats


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 400)
    monkeypatch.setattr(exchange, "BUCKET_HASHES", 40)


def texts(seed, n=120):
    """Documents of shared passages, cut anywhere, and text of their own."""
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcd é\n") for _ in range(rng.randint(20, 90))) for _ in range(8)]
    own = lambda: "".join(rng.choice("abcdefgh  ") for _ in range(rng.randint(0, 60)))
    part = lambda: rng.choice(shared)[rng.randint(0, 10): rng.randint(15, 90)]
    docs = [(i, "".join(part() if rng.random() < 0.6 else own() for _ in range(rng.randint(0, 5)))) for i in range(n)]
    return [*docs, (500, "ab" * 100), (501, "a" * 100), (502, "a" * 100)]


@pytest.mark.parametrize("window", [4, 5])
def test_words_against_brute_force(spark, small_chunks, window):
    docs = texts(window)
    got = block_anchors.repeat_digests(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), window=window)
    want = brute.word_repeats(docs, window)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert sum(r[2] for r in want) > 500


def test_words_of_all_documents(spark):
    docs = brute.read("documents")
    got = block_anchors.repeat_digests(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert Counter(map(tuple, got.collect())) == Counter(brute.word_repeats(zip(docs.doc_id, docs.text), 20))


def test_odd_rows_of_words(spark, small_chunks):
    docs = brute.frame(spark, brute.ODD)
    got = Counter(map(tuple, block_anchors.repeat_digests(docs, window=3).collect()))
    assert got == Counter(brute.word_repeats(brute.ODD, 3))
    kept = block_anchors.remove_repeats(docs, window=3)
    assert kept.columns == docs.columns and kept.count() == len(brute.ODD)
    assert kept.filter("text is null").count() == 2 and kept.filter("n_words = 'x' and chunk = 'z'").count() == len(brute.ODD)
    assert block_anchors.remove_repeats(docs.limit(0), window=3).count() == 0


def test_removing_keeps_the_rest_as_it_was(spark):
    passage = " ".join(f"w{n}" for n in range(25))
    docs = spark.createDataFrame([(1, f"start {passage}\nend"), (2, f" other\n\n{passage}  tail\tx "), (3, passage)],
                                 "doc_id bigint, text string")
    got = dict(map(tuple, block_anchors.remove_repeats(docs).collect()))
    assert got == {1: f"start {passage}\nend", 2: " other\n\ntail\tx ", 3: ""}


@pytest.mark.parametrize("hot", [suffix_repeats.HOT, 1])
def test_bytes_against_brute_force(spark, small_chunks, hot):
    docs = texts(9)
    got = suffix_repeats.suffix_digests(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), window=16, hot=hot)
    want = brute.byte_repeats(docs, 16)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert sum(r[2] for r in want) > 1000


def test_bytes_of_all_documents(spark):
    docs = brute.read("documents")
    got = suffix_repeats.suffix_digests(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert Counter(map(tuple, got.collect())) == Counter(brute.byte_repeats(list(zip(docs.doc_id, docs.text)), 400))


def test_a_passage_of_many_words_goes_from_400_bytes_on(spark):
    short, long = " ".join(f"w{n:03d}" for n in range(60)), " ".join(f"word{n:03d}" for n in range(60))
    docs = [(1, f"one {short} two"), (2, f"three {short} four"), (3, f"five {long} six"), (4, f"seven {long} eight")]
    got = {r.doc_id: r for r in suffix_repeats.suffix_digests(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert len(short) < 400 <= len(long)
    assert {i: r.n_bytes for i, r in got.items()} == {i: len(t) for i, t in docs}
    assert {i: r.n_removed for i, r in got.items()} == {1: 0, 2: 0, 3: len(long) + 2, 4: len(long) + 2}


def test_odd_rows_of_bytes(spark, small_chunks):
    docs = brute.frame(spark, brute.ODD)
    got = suffix_repeats.suffix_digests(docs, window=10)
    assert Counter(map(tuple, got.collect())) == Counter(brute.byte_repeats(brute.ODD, 10))
    spans = {r["doc_id"]: r["spans"] for r in suffix_repeats.repeated_spans(docs, window=10).collect() if r["doc_id"] == 1}
    assert spans[1] == [(0, 21)]
    assert suffix_repeats.suffix_digests(docs.limit(0), window=10).count() == 0


def test_suffix_sort_survives_colliding_hashes(monkeypatch):
    import numpy as np

    data = np.frombuffer(b"abcabdabcabc", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 1]), np.array([12, 12, 12, 12, 12])
    suffixes = suffix_repeats.Suffixes(data, starts, ends)
    order = suffixes.sort(np.zeros(5, np.int64))
    held = data.tobytes()
    assert [held[starts[i]:] for i in order] == sorted(held[s:] for s in starts)
    suffixes.prefixes.sums[:] = 0  # every hash alike
    assert suffixes.extensions(order).tolist() == [0, 3, 5, 2, 0]
