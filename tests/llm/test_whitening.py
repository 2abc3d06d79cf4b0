"""Spectrum slicing and whitening against a dense decomposition with exact sums."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wattle.llm import whitening as wh

SF = "/root/testdata/sf0.001"


def symmetric(rng, values):
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize("seed", range(30))
def test_inertia_counts_signs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 30))
    a = rng.standard_normal((n, n)) * (rng.random((n, n)) < 0.5)     # zeros on the diagonal need 2 x 2 pivots
    a = a + a.T
    if seed % 2:
        np.fill_diagonal(a, 0)
    e = np.linalg.eigvalsh(a)
    if np.abs(e).min() > 1e-9:
        assert wh.inertia(a) == ((e > 0).sum(), 0, (e < 0).sum())


def test_inertia_of_zero_and_swap_matrices():
    assert wh.inertia(np.zeros((3, 3))) == (0, 3, 0)
    assert wh.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 0, 1)


@pytest.mark.parametrize("values", [np.arange(20, 0, -1.0), np.geomspace(1e6, 1e-3, 24), [5, 5 + 1e-9, 3, 2, 2 - 1e-7, 1, 1, 1, 0, 0],
                                    [7.0] * 9, [1.0, 0, 0, 0], [3.0], [9, 9, 9, 4, 4, 1, 1e-20]])
def test_leading_pairs(values):
    v = symmetric(np.random.default_rng(len(values)), np.array(values, float))
    e, x = wh.Spectrum(v).leading(8)
    expect = np.sort(values)[::-1][:8]
    expect = expect[expect > wh.LEAST_SHARE * sum(values)]
    assert len(e) == len(expect) and np.allclose(e, expect, rtol=1e-9, atol=1e-13 * sum(values))
    assert np.allclose(x.T @ x, np.eye(len(e)), atol=1e-10)
    assert np.linalg.norm(v @ x - x * e) <= 1e-11 * sum(values)


def test_no_variance_no_component():
    assert len(wh.Spectrum(np.zeros((4, 4))).leading(8)[0]) == 0


def brute(vectors):
    """Exact integers for n, S and deviation; dense eigenvectors."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    c = np.array([[(n * a - b) / n for a, b in zip(row, s)] for row in x])
    e, q = np.linalg.eigh(c.T @ c / n)
    return n, dev, c, e[::-1], q[:, ::-1]


def check(rows, ids, vectors):
    n, dev, c, e, q = brute(vectors)
    k = min(8, len(e))
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == k * len(ids)
    got = np.array([[by[i, j + 1].whitened for j in range(k)] for i in ids])
    expect = c @ q[:, :k] / np.sqrt(e[:k])
    sign = np.sign((got * expect).sum(0))
    assert np.allclose(got, expect * sign, atol=1e-8)
    assert [by[i, 1].deviation for i in ids] == dev and {r.n for r in rows} == {n}
    assert np.allclose([by[ids[0], j + 1].explained for j in range(k)], e[:k] / e.sum(), rtol=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-9


def test_op13_matches_a_dense_decomposition(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    check(wh.op13_whitening(spark, SF).collect(), [r["vec_id"] for r in t], [r["embedding"] for r in t])


def test_edges(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = (rng.standard_normal((40, 5)) @ rng.standard_normal((5, 5)) + 3).astype(np.float32).tolist()
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, 2.0], [1.0, None, 1.0, 1.0, 1.0], [nan, 1.0, 1.0, 1.0, 1.0], [1.0, 1.0, -inf, 1.0, 1.0], [1e30] * 5]
    rows = [(i, v, i, 0.5, "a") for i, v in enumerate(good + good[:3] + bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, w double, component string").repartition(5)
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    out = wh.op13_whitening(spark, str(tmp_path))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    assert {r.component for r in rows} == {1, 2, 3, 4, 5}
    check(rows, list(range(43)), good + good[:3])
    for name, some in (("none", frame.limit(0)), ("bad", frame.filter("vec_id >= 43 and vec_id < 45")),
                       ("same", frame.filter("vec_id = 1").withColumn("vec_id", F.explode(F.array(F.lit(1), F.lit(2)))))):
        some.write.parquet(str(tmp_path / name / "embeddings.parquet"))
        assert wh.op13_whitening(spark, str(tmp_path / name)).collect() == []


def test_the_most_frequent_length_wins_ties_by_the_longer(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0, 2.0, 3.0]), (4, [5.0, 2.0, 1.0]), (None, None)]
    fit = wh.fit_whitening(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert fit.dim == 3 and fit.centre.n == 2 and len(fit.values) == 1


def test_deviations_beyond_a_long_are_null():
    c = wh.Centre(3_000_000_000, [3_000_000_000 * 7 + 1, 5])
    assert c.deviation(np.array([[7, 0]])) == [(-1) ** 2 + 25]
    assert c.deviation(np.array([[9, 0]])) == [None]
