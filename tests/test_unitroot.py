"""ADF, KPSS p-values and Zivot-Andrews against plain least squares in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattle.operators import unitroot as U


def t_of(cols, y, which):
    x = np.column_stack(cols)
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ b
    return b[which] / math.sqrt((e @ e) / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)[which, which]), e @ e


def adf(y):
    n = len(y)
    most = int(max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)))
    dy = np.concatenate([[np.nan], np.diff(y)])

    def cols(p, first):
        t = np.arange(first, n)
        return [np.ones(len(t)), y[t - 1], *[dy[t - j] for j in range(1, p + 1)]], dy[t]
    m = n - 1 - most
    aic = [m * math.log(t_of(*cols(p, most + 1), 1)[1] / m) + 2 * (p + 2) for p in range(most + 1)]
    p = int(np.argmin(aic))
    return most, p, t_of(*cols(p, p + 1), 1)[0]


def walks():
    rng = np.random.default_rng(8)
    out = {"walk": rng.standard_normal(90).cumsum(), "noise": rng.standard_normal(70), "short": rng.standard_normal(14)}
    ar = np.zeros(60)
    for t in range(3, 60):
        ar[t] = 0.5 * ar[t - 1] + 0.3 * ar[t - 3] + rng.standard_normal()
    return out | {"ar3": ar + 100}


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(k, i, float(v)) for k, y in walks().items() for i, v in enumerate(y)]
    rows += [("flat", i, 3.0) for i in range(40)] + [("tiny", i, float(i)) for i in range(2)] + [("holes", 2 * i, float(v)) for i, v in enumerate(walks()["walk"])]
    rows += [("holes", 2 * i + 1, None) for i in range(90)]
    return spark.createDataFrame(rows, "series_id string, month int, y double").cache()


def test_lag_choice_and_t(frame):
    got = {r.series_id: r for r in U.adf(frame, "y", ["series_id"]).collect()}
    for k, y in walks().items():
        most, lag, t = adf(y)
        r = got[k]
        assert (r.n, r.max_lag, r.lag, r.n_obs) == (len(y), most, lag, len(y) - 1 - lag) and math.isclose(r.t_stat, t, rel_tol=1e-8)
    assert (got["holes"].t_stat, got["holes"].lag) == (got["walk"].t_stat, got["walk"].lag)      # lags count readings
    assert all(got[k].t_stat is None and got[k].p_value is None for k in ("flat", "tiny")) and got["flat"].n == 40


@pytest.mark.parametrize("t, p", [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)])
def test_p_values_at_the_published_critical_values(spark, t, p):
    got = spark.range(1).select(F.expr(U.adf_p_sql(f"CAST({t} AS DOUBLE)"))).first()[0]
    assert abs(got - p) < 0.002


def test_ends_of_the_distributions(spark):
    row = spark.sql("select -20D a, 3D b, 0.1D c, 0.463D d, 0.5185D e, 2D f, CAST(NULL AS DOUBLE) z").select(
        *[F.expr(U.adf_p_sql(c)) for c in "abz"], *[F.expr(U.kpss_p_sql(c)) for c in "cdefz"]).first()
    assert [None if v is None else round(float(v), 6) for v in row] == [0, 1, None, 0.10, 0.05, 0.0375, 0.01, None]
    z = np.linspace(-4, 4, 41)
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in z], "z double").select(F.expr(U.normal_cdf_sql("z"))).collect()]
    assert np.allclose(got, [0.5 * math.erfc(-v / math.sqrt(2)) for v in z], atol=1e-7)


@pytest.mark.parametrize("breaks", ["level", "level_and_trend"])
@pytest.mark.parametrize("lags", [0, 1, 3])
def test_every_date_equals_its_own_fit(frame, breaks, lags):
    got = {(r.series_id, r.month): r for r in U.zivot_andrews(frame, "y", breaks=breaks, lags=lags).collect()}
    for k, y in walks().items():
        dy = np.concatenate([[np.nan], np.diff(y)])
        t = np.arange(lags + 1, len(y))
        n, place = len(t), np.arange(1, len(t) + 1)
        dates = [b for b in place if b >= math.ceil(0.15 * n) and n - b >= math.ceil(0.15 * n)]
        assert sorted(m for s, m in got if s == k) == [int(t[b - 1]) for b in dates]
        for b in dates:
            du = (place > b).astype(float)
            cols = [np.ones(n), place, du, *([du * (place - b)] if breaks == "level_and_trend" else []),
                    *[dy[t - j] for j in range(1, lags + 1)], y[t - 1]]
            assert math.isclose(got[k, int(t[b - 1])].t_stat, t_of(cols, dy[t], -1)[0], rel_tol=1e-6, abs_tol=1e-8)
    assert all(r.t_stat is None for (k, _), r in got.items() if k == "flat") and not any(k == "tiny" for k, _ in got)


def test_a_broken_level_is_found(spark):
    rng = np.random.default_rng(5)
    y = 0.3 * rng.standard_normal(100) + np.where(np.arange(100) > 62, 8.0, 0.0)
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "series_id string, month int, y double")
    r = U.break_by_unit_root(df, "y").first()
    assert abs(r.break_date - 62) <= 1 and r.reject_1pct
    assert U.break_by_unit_root(df.limit(0), "y").count() == 0
