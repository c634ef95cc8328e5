import math

import brute
import numpy as np
import pytest

from logloom.llm import whitening
from logloom.llm.queries import QUERIES


def plain(vectors):
    """x, n, deviations, eigenvalues (falling) and eigenvectors of the distinct scaled vectors."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    rows = (n * fit - sums) / n
    values, directions = np.linalg.eigh(rows.T @ rows / n)
    return x, n, n * x - sums, values[::-1], directions[:, ::-1]


def check(spark, found, ids, vectors):
    x, n, deviations, values, directions = plain(vectors)
    k = min(16, x.shape[1], int((values > 1e-12 * values.sum()).sum()))
    rows = sorted(found.collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [(r["vec_id"], r["component"]) for r in rows] == [(i, c) for i in ids for c in range(1, k + 1)]
    assert {r["n"] for r in rows} == {n}
    squares = [sum(int(v) ** 2 for v in row) for row in deviations]
    assert [r["deviation"] for r in rows[::k]] == squares
    y = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    explained = np.array([r["explained"] for r in rows[:k]])
    assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-10)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    want = deviations / n @ directions[:, :k] / np.sqrt(values[:k])
    return y, want, values[:k]


def same_up_to_sign(y, want, tolerance=1e-8):
    return all(min(np.abs(y[:, c] - want[:, c]).max(), np.abs(y[:, c] + want[:, c]).max()) < tolerance for c in range(y.shape[1]))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    table = brute.read("embeddings", sf).sort_values("vec_id")
    y, want, _ = check(spark, QUERIES["op11_whitening"](spark, f"/root/testdata/{sf}"), table.vec_id, table.embedding)
    assert same_up_to_sign(y, want)


def frame(spark, rows, kind="array<double>"):
    return spark.createDataFrame([(i, v, "n") for i, v in rows], f"vec_id bigint, embedding {kind}, n string").repartition(4)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(n, rng.normal(size=3).tolist()) for n in range(40)] + [(40, [0.5, 0.5, 0.5]), (41, [0.5, 0.5, 0.5])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, math.nan, 2.0]), (54, [math.inf, 0.0, 0.0]),
           (55, [1e300, 0.0, 0.0]), (56, [1.0, 2.0]), (57, [1.0] * 4)]
    y, want, _ = check(spark, whitening.whiten(frame(spark, good + bad)), range(42), [v for _, v in good])
    assert same_up_to_sign(y, want)


def test_repeated_rows_and_ids_count_once(spark):
    rng = np.random.default_rng(6)
    base = [(n, rng.normal(size=4).tolist()) for n in range(30)]
    rows = base + [(n + 100, base[0][1]) for n in range(500)]
    y, want, _ = check(spark, whitening.whiten(frame(spark, rows)), [i for i, _ in rows], [v for _, v in rows])
    assert same_up_to_sign(y, want)
    twice = whitening.whiten(frame(spark, base + base + [(None, base[1][1])]))
    assert twice.count() == 61 * 4 and {r["n"] for r in twice.collect()} == {30}


def test_repeated_variances_lose_no_component(spark):
    corners = [[float(s * 3 * (d == k)) for d in range(6)] for k in range(6) for s in (1, -1)]
    y, _, values = check(spark, whitening.whiten(frame(spark, list(enumerate(corners)))), range(12), corners)
    assert np.allclose(values, values[0])
    assert np.allclose(y.T @ y / 12, np.eye(6))


def test_constant_directions_are_left_out(spark):
    rng = np.random.default_rng(7)
    vectors = [[a, a, 2.0, b] for a, b in rng.normal(size=(50, 2)).tolist()]
    y, want, _ = check(spark, whitening.whiten(frame(spark, list(enumerate(vectors)))), range(50), vectors)
    assert y.shape[1] == 2 and same_up_to_sign(y, want)


def test_nothing_to_fit(spark):
    same = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [math.nan])])).count() == 0


def test_overflow_is_an_error():
    with pytest.raises(OverflowError):
        whitening.squares(np.full((1, 4), 1 << 31, dtype=np.int64))
    assert whitening.squares(np.array([[3_037_000_499, 0]]))[0] == 3_037_000_499**2
    centre = whitening.Centre(1 << 40, np.zeros(1, np.int64), np.zeros(1, np.int64))
    with pytest.raises(OverflowError):
        centre.deviations(np.array([[1 << 30]]))


@pytest.mark.parametrize("dimensions", [64, 200])
def test_bidiagonalisation(dimensions):
    rng = np.random.default_rng(dimensions)
    x = rng.normal(size=(600, dimensions)) * 0.96 ** np.arange(dimensions)
    values, directions, steps = whitening.bidiagonalise(lambda t: x.T @ (x @ t), dimensions, 16, np.linalg.norm(x))
    _, want, right = np.linalg.svd(x)
    assert steps == min(dimensions, 128)
    assert np.allclose(values[:16], want[:16], rtol=1e-12)
    assert np.allclose(np.abs((directions[:, :16].T * right[:16]).sum(axis=1)), 1, atol=1e-12)
    assert np.allclose(directions.T @ directions, np.eye(directions.shape[1]), atol=1e-12)
