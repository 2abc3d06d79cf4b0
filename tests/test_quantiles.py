"""Distributed selection against numpy."""

import numpy as np
import pytest

from wattle.operators import quantiles as Q


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_equals_numpy_with_ties_gaps_and_tails(spark, monkeypatch, buckets):
    monkeypatch.setattr(Q, "BUCKETS", buckets)
    rng = np.random.default_rng(buckets)
    cols = {"ties": rng.integers(0, 4, 501).astype(float), "tails": np.concatenate([rng.standard_normal(500), [1e12]]),
            "near": 1.0 + rng.integers(0, 50, 501) * 2.0 ** -52, "negative": -np.exp(rng.standard_normal(501) * 3)}
    rows = [tuple(float(v[i]) for v in cols.values()) + (None if i % 3 else 2.0 * i, float("nan"), 7.0) for i in range(501)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*cols, "holes", "nothing", "one"])).repartition(3)
    got = {r.column: r for r in Q.describe(df, [*cols, "holes", "nothing", "one"]).collect()}
    for c, v in (cols | {"holes": np.arange(0, 501, 3) * 2.0, "one": np.full(501, 7.0)}).items():
        r = got[c]
        assert r.n == len(v) and (r.min, r.max) == (v.min(), v.max())
        assert np.allclose([r.p25, r.p50, r.p75], np.quantile(v, [0.25, 0.5, 0.75]), rtol=1e-15, atol=0)
    assert got["nothing"].n == 0 and got["nothing"].p50 is None
    assert [r.n for r in Q.describe(df.limit(0), ["ties"]).collect()] == [0]
