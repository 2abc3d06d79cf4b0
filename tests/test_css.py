"""Conditional sum of squares and forecasts with MA terms against a plain numpy search and recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wattle.operators import arma as A
from wattle.plans.q_arma import ORDERS, ORDERS_X, RECENT, _fits
from wattle.plans.q_models import _split

SF = "/root/testdata/sf0.001"


def residuals(b, z, x, p, q):
    """b = [c, ar..., ma..., beta or none]; residuals before place p are zero."""
    e = np.zeros(len(z))
    for t in range(p, len(z)):
        f = b[0] + sum(b[1 + i] * z[t - 1 - i] for i in range(p))
        f += sum(b[1 + p + j] * (e[t - 1 - j] if t - 1 - j >= 0 else 0) for j in range(q))
        e[t] = z[t] - f - (b[1 + p + q] * x[t] if x is not None else 0)
    return e


def invertible(b, p, q):
    ma = [1.0, *b[1 + p:1 + p + q]]
    return all(abs(r) < 1 + 1e-3 for r in np.roots(ma))           # results are rounded


def refine(b, z, x, p, q):
    """Gauss-Newton with numerical derivatives and halved steps."""
    b = np.array(b, float)
    for _ in range(60):
        e = residuals(b, z, x, p, q)
        jac = np.column_stack([(residuals(b + h, z, x, p, q) - residuals(b - h, z, x, p, q)) / (2 * 1e-6 * max(1, abs(v)))
                               for v, h in zip(b, np.diag(1e-6 * np.maximum(1, np.abs(b))))])
        step = np.linalg.lstsq(jac, -e, rcond=None)[0]
        while np.abs(step).max() > 1e-12 and not (invertible(b + step, p, q) and (residuals(b + step, z, x, p, q) ** 2).sum() <= (e ** 2).sum()):
            step /= 2
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return b


@pytest.fixture(scope="module")
def panel(spark):
    tr, te = (d.select("series_id", "month", "y", "x1").toPandas().sort_values(["series_id", "month"]) for d in _split(spark, SF))
    return tr, te


def series(tr, sid, window, d, with_x):
    g = tr[tr.series_id == sid]
    if window == "recent":
        g = g[g.month.astype(str) >= RECENT]
    y, x = g.y.to_numpy(), g.x1.to_numpy()
    return (np.diff(y), np.diff(x), y) if d else (y, x, y)


def test_fits_are_minima_and_agree_with_numpy(spark, panel):
    tr, _ = panel
    rows = entry.queries()["arma_css"](spark, SF).collect()
    assert len(rows) == 2 * 16 * tr["series_id"].nunique() and sum(r.converged for r in rows) >= 0.8 * len(rows)
    for r in rows:
        p, d, q, with_x = (ORDERS | ORDERS_X)[r.config]
        z, x, _ = series(tr, r.series_id, r.window_name, d, with_x)
        x = x if with_x else None
        got = [r.c, *[r[f"ar{i}"] for i in range(1, p + 1)], *[r[f"ma{i}"] for i in range(1, q + 1)], *([r.beta] if with_x else [])]
        want = refine(got, z, x, p, q)                        # started at the result: a minimum stays where it is
        if q == 0:                                            # without MA terms it is least squares
            cols = [np.ones(len(z) - p), *[z[p - 1 - i:len(z) - 1 - i] for i in range(p)], *([x[p:]] if with_x else [])]
            assert np.allclose(got, np.linalg.lstsq(np.column_stack(cols), z[p:], rcond=None)[0], rtol=1e-4, atol=1e-3)
        assert r.n_fit == len(z) - p
        ours, best = (residuals(b, z, x, p, q)[p:] @ residuals(b, z, x, p, q)[p:] for b in (np.array(got), want))
        assert invertible(got, p, q) and (ours <= best * (1 + 5e-3) or not r.converged), (r.series_id, r.window_name, r.config, got, want)


def test_known_coefficients_come_back(spark):
    rng = np.random.default_rng(4)
    rows = []
    for sid, (c, ar, ma, beta) in {"a": (2.0, [0.6], [0.4], 0), "b": (1.0, [0.5, 0.2], [0.5], 0), "c": (0.5, [0.3], [0.2], 1.5)}.items():
        e, z, x = rng.standard_normal(4000) * 0.1, np.zeros(4000), rng.standard_normal(4000)
        for t in range(2, 4000):
            z[t] = c + sum(a * z[t - 1 - i] for i, a in enumerate(ar)) + sum(m * e[t - 1 - i] for i, m in enumerate(ma)) + beta * x[t] + e[t]
        rows += [(sid, i, float(v), float(w)) for i, (v, w) in enumerate(zip(z[100:], x[100:]))]
    df = spark.createDataFrame(rows, "k string, month int, y double, x double")
    got = {(r.k, r.config): r for r in A.fit(df, ["k"], "y", "x", {"m11": (1, 0, 1, False), "m21": (2, 0, 1, False), "x11": (1, 0, 1, True)}).collect()}
    b = got["a", "m11"].css.b
    assert np.allclose([b[1], b[5]], [0.6, 0.4], atol=0.05)
    b = got["c", "x11"].css.b
    assert np.allclose([b[1], b[5], b[7]], [0.3, 0.2, 1.5], atol=0.05)
    x = {k: np.array([r[3] for r in rows if r[0] == k]) for k in "abc"}
    z = {k: np.array([r[2] for r in rows if r[0] == k]) for k in "abc"}
    for (k, m), (p, q, w) in {("a", "m11"): (1, 1, 0), ("b", "m21"): (2, 1, 0), ("c", "x11"): (1, 1, 1)}.items():
        full = got[k, m].css.b
        mine = [full[0], *full[1:1 + p], *full[5:5 + q], *([full[7]] if w else [])]
        assert np.allclose(mine, refine(mine, z[k], x[k] if w else None, p, q), rtol=1e-4, atol=1e-5)


def test_forecasts_follow_the_recursion(spark, panel):
    tr, te = panel
    fits = {(r.series_id, r.window, r.config): r.css.b for r in _fits(spark, SF)[0].collect()}
    rows = entry.queries()["arma_forecast_metrics"](spark, SF).collect()
    assert {r.estimator for r in rows} == {"css", "hannan_rissanen"} and len(rows) == 2 * len(fits)
    for r in (r for r in rows if r.estimator == "css"):
        p, d, q, with_x = (ORDERS | ORDERS_X)[r.config]
        z, x, y = series(tr, r.series_id, r.window_name, d, with_x)
        full = fits[r.series_id, r.window_name, r.config]
        b = [full[0], *full[1:1 + p], *full[5:5 + q], *([full[7]] if with_x else [])]
        e = residuals(b, z, x if with_x else None, p, q)
        hist, inn, future = list(z), list(e), te[te.series_id == r.series_id]
        path = []
        for xv in future.x1:
            v = b[0] + sum(b[1 + i] * hist[-1 - i] for i in range(p)) + sum(b[1 + p + j] * inn[-1 - j] for j in range(q))
            v += b[-1] * xv if with_x else 0
            hist.append(v)
            inn.append(0.0)
            path.append(v)
        level = y[-1] + np.cumsum(path) if d else np.array(path)
        err = level - future.y.to_numpy()
        assert r.n == len(err)
        assert np.isclose(r.rmse, np.sqrt((err ** 2).mean()), rtol=1e-4) and np.isclose(r.mae, np.abs(err).mean(), rtol=1e-4)


def test_short_constant_and_gappy_series(spark):
    rows = [("short", i, float(i % 3), 1.0) for i in range(10)] + [("flat", i, 5.0, float(i)) for i in range(40)]
    rows += [("gaps", i, None if i % 7 == 0 else float(np.sin(i)), None if i % 11 == 0 else float(i % 5)) for i in range(80)]
    df = spark.createDataFrame(rows, "series_id string, month int, y double, x1 double")
    fits = A.fit(df, ["series_id"], "y", "x1", {"m": (1, 0, 1, False), "x": (2, 0, 1, True)}).checkpoint()
    by = {(r.series_id, r.config): r for r in fits.collect()}
    assert len(by) == 6 and by["short", "m"].css is None and by["short", "m"].aic is None
    assert abs(by["flat", "m"].sse) < 1e-9 and by["gaps", "m"].n_fit == 68 - 1 and by["gaps", "x"].n_fit < 68 - 2
    future = spark.createDataFrame([(s, m, 1.0, None if m == 101 else 1.0) for s in ("short", "flat", "gaps") for m in (100, 101, 102)],
                                   "series_id string, month int, y double, x1 double")
    got = A.forecast(fits, future, ["series_id"], "series_id", "y", "x1").collect()
    assert {r.series_id for r in got} == {"flat", "gaps"}
    assert [r.forecast is None for r in sorted((r for r in got if r.series_id == "gaps" and r.config == "x" and r.estimator == "css"),
                                               key=lambda r: r.month)] == [False, True, True]
