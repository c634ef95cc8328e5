"""Personal data, nearest neighbours, toxicity."""

import random
import zlib
from hashlib import sha256

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import collision_index, pii_crf, toxicity


def test_patterns_against_plain_ones():
    rng = random.Random(2)
    parts = ["a", ".", "@", "1", "25", "-", " ", "+", "(", ")", "4111", "é", "_", "%", "255", "4111 1111 1111 1111"]
    for text in ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(20_000)]:
        assert pii_crf.base_spans(text) == brute.personal(text)


def test_patterns_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "@" * 200_000, "a." * 100_000, "1." * 100_000, "+1 " * 70_000, "a@b" * 60_000):
        pii_crf.spans_of([text], pii_crf.default_chain())


def test_chain_on_unseen_rows():
    chain, right, n = pii_crf.default_chain(), 0, 0
    for words, labels in pii_crf.labelled_table(300, seed=99):
        for first, last in pii_crf._runs([k for k, w in enumerate(words) if pii_crf._MARKED.search(w)]):
            found = chain.decode(np.array([[pii_crf._features(words, k) for k in range(first, last)]]))[0]
            right += sum(pii_crf.LABELS[f] == w for f, w in zip(found, labels[first:last]))
            n += last - first
    assert right / n > 0.93


@pytest.mark.parametrize("address", ["jane @ example.com", "jane@ example.com", "jane @example.com", "j.smith @ mail.example.org",
                                     "peter@ post.de", "anna_k @ uni.example.net"])
@pytest.mark.parametrize("text", ["write to {} today", "{}", "please ask {}, or call", "Mail:\n{}.\nThe end of it", "of 12 people {} came"])
def test_addresses_with_blanks_in_whole_texts(address, text):
    spans = pii_crf.spans_of([text.format(address)], pii_crf.default_chain())[0][1]
    assert pii_crf.redact(text.format(address), spans) == text.format("[EMAIL]")


@pytest.mark.parametrize("text", ["meet me @ noon", "3 @ 5.00 each", "ask @peter about it", "we met @ the station. Then we left"])
def test_signs_that_are_no_address(text):
    assert pii_crf.spans_of([text], pii_crf.default_chain())[0][1] == []


def test_shape_of_a_whole_word():
    assert pii_crf._shape("x" * 5_000 + "/555-0143") == "a/d3-d4"
    assert pii_crf._shape("a-" * 60 + "12") != pii_crf._shape("a-" * 60 + "1234567")


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(4)
    chain = pii_crf.Chain(rng.normal(size=(50, len(pii_crf.LABELS))), rng.normal(size=(len(pii_crf.LABELS),) * 2))
    features = rng.integers(0, 50, (1, 3, 4))
    scores = chain.weights[features[0]].sum(axis=1)
    paths = np.stack(np.meshgrid(*[np.arange(len(pii_crf.LABELS))] * 3, indexing="ij"), -1).reshape(-1, 3)
    total = sum(scores[t, paths[:, t]] for t in range(3)) + chain.pairs[0, paths[:, 0]] + chain.pairs[paths[:, 2], 0]
    total += chain.pairs[paths[:, 0], paths[:, 1]] + chain.pairs[paths[:, 1], paths[:, 2]]
    assert chain.decode(features)[0].tolist() == paths[total.argmax()].tolist()


def test_the_gradient_is_the_likelihood_s():
    rng = np.random.default_rng(5)
    scores, pairs = rng.normal(size=(2, 3, 9)), rng.normal(size=(9, 9))

    def whole(s, p):
        ahead = p[0] + s[:, 0]
        for t in range(1, 3):
            ahead = pii_crf._log_sum(ahead[:, :, None] + p, 1) + s[:, t]
        return pii_crf._log_sum(ahead + p[:, 0], 1).sum()

    node, edge = pii_crf._marginals(scores, pairs)
    step = np.zeros_like(scores)
    step[1, 2, 4] = 1e-5
    assert (whole(scores + step, pairs) - whole(scores - step, pairs)) / 2e-5 == pytest.approx(node[1, 2, 4], abs=1e-6)
    step = np.zeros_like(pairs)
    step[0, 3] = 1e-5
    assert (whole(scores, pairs + step) - whole(scores, pairs - step)) / 2e-5 == pytest.approx(edge[0, 3], abs=1e-6)


def test_personal_data_of_all_documents(spark):
    docs = brute.read("documents")
    got = {r["doc_id"]: r for r in pii_crf.find_personal_data(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    for i, text in zip(docs.doc_id, docs.text):
        base = brute.personal(text)
        assert got[i]["base_sha256"] == sha256(pii_crf.written(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii_crf.KINDS] == [sum(s[0] == k for s in base) for k in pii_crf.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i]["spans"].split(","))


def test_redaction(spark):
    chain = pii_crf.default_chain()
    text = "call (201) 555-0143 or +1 (201) 555-0144, mail é.a.b@c.example.com. not 1234567890123456"
    spans = pii_crf.spans_of([text], chain)[0][1]
    assert pii_crf.redact(text, spans) == "call [PHONE] or [PHONE], mail é[EMAIL]. not 1234567890123456"
    docs = brute.frame(spark, brute.ODD)
    got = pii_crf.redact_personal_data(docs)
    assert got.columns == docs.columns and got.count() == len(brute.ODD) and got.filter("text is null").count() == 2
    assert got.filter("doc_id = -10").first()["text"].endswith("three 3.5 [PHONE]")
    assert got.filter("doc_id = 1").first()["text"] == brute.ODD[0][1]
    assert pii_crf.find_personal_data(docs).count() == len(brute.ODD)
    for f in (pii_crf.redact_personal_data, pii_crf.find_personal_data):
        assert f(docs.limit(0)).count() == 0


def nearest_by_force(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        away = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        order = [n for n in np.lexsort((ids, away)) if ids[n] != q][:k]
        out[q] = [(int(ids[n]), away[n]) for n in order]
    return out


@pytest.mark.parametrize("sf, block", [("sf0.01", 8 << 20), ("sf0.1", 8 << 20), ("sf0.1", 1 << 18)])
def test_recall(spark, monkeypatch, sf, block):
    monkeypatch.setattr(collision_index, "BLOCK_BYTES", block)
    monkeypatch.setattr(collision_index, "QUERY_BYTES", 1 << 12)
    rows = brute.read("embeddings", sf)
    ids, vectors = rows.vec_id.to_numpy(), np.vstack(rows.embedding).astype(float)
    got = collision_index.nearest(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet"), F.col("vec_id") % 100 == 0).collect()
    want = nearest_by_force(ids, vectors, [i for i in ids if i % 100 == 0])
    found = 0
    for r in got:
        exact = np.sqrt(((vectors[ids == r["vec_id"]][0] - vectors[ids == r["query_id"]][0]) ** 2).sum())
        assert r["score"] == pytest.approx(exact, rel=1e-12)
        found += r["vec_id"] in {i for i, _ in want[r["query_id"]]}
    assert len(got) == 10 * len(want) and found >= 0.9 * len(got)
    for q in want:
        mine = sorted((r["rank"], r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and mine == sorted(mine, key=lambda m: m[1:])


@pytest.mark.parametrize("dimension, spread, apart", [(256, 1.0, 0.0), (64, 1.0, 0.0), (256, 0.01, 50.0)])
def test_recall_of_concentrated_distances(dimension, spread, apart):
    """Gaussian vectors, and a dense cluster of all but a few that lie far away."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(8_000, dimension)) * spread
    vectors[:20] += apart
    queries = np.arange(100, 8_000, 400)
    right = 0
    for q, (places, distances) in zip(
            queries, collision_index.CollisionIndex(vectors).search(vectors[queries], queries, 10), strict=True):
        nearest = places[np.argsort(distances)[:10]]
        right += len({int(i) for i, _ in nearest_by_force(np.arange(8_000), vectors, [q])[q]} & set(nearest.tolist()))
    assert right >= 0.9 * 10 * len(queries)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]),
            (6, [1.0, 0.0]), (6, [2.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
            (200, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, score string")
    got = sorted(map(tuple, collision_index.nearest(frame, F.col("vec_id") % 100 == 0).collect()))
    root = 2 ** 0.5
    assert got == [(0, 1, 6, 0.0), (0, 2, 7, 0.0), (0, 3, 100, root), (100, 1, 0, root), (100, 2, 6, root), (100, 3, 7, root)]
    assert collision_index.nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = toxicity.score(docs, model).collect()
    assert len(got) == 10_000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    judged = [(r["predicted"], known[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in known]
    hits = sum(p and y for p, y in judged)
    # a few hundred toxic texts of four languages; some of the labels are noise
    assert hits / sum(y for _, y in judged) > 0.8 and hits / sum(p for p, _ in judged) > 0.8
    texts = ["what an idi0t", "stuppid and worthles people here", "onen the thing rely on it"]
    unseen = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    unknown = [r["score"] for r in toxicity.score(unseen, model).orderBy("doc_id").collect()]
    assert min(unknown[:2]) > unknown[2]


def test_toxicity_of_odd_rows(spark):
    docs = brute.frame(spark, brute.ODD)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (999, 1), (6, 0)], "doc_id bigint, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(brute.ODD) and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.fit(docs.limit(0), labels)
    assert {r["score"] for r in toxicity.score(docs, empty).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), empty).count() == 0
