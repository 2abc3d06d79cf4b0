"""Rows-only queries (no SQL oracle) checked against plain numpy / pandas on the
smallest driver tables."""

import math

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wattle.plans.panel import monthly_panel_plan

Q = E.queries()


@pytest.fixture(scope="module")
def panel(spark):
    p = monthly_panel_plan(spark, SF_SMALL).toPandas()
    p["month"] = pd.to_datetime(p["month"])
    return p.sort_values(["series_id", "month"])


def _train_test(p):
    tr = p[p.month <= "1999-12-01"].copy()
    te = p[(p.month >= "2000-01-01") & (p.month <= "2001-06-01")].copy()
    return tr, te


def _design(tr, d):
    g = tr.copy()
    g["z"] = g.y if d == 0 else g.y - g.groupby("series_id").y.shift(1)
    g["xx"] = g.x1 if d == 0 else g.x1 - g.groupby("series_id").x1.shift(1)
    for k in (1, 2, 3):
        g[f"z{k}"] = g.groupby("series_id").z.shift(k)
    return g.dropna(subset=["z", "z3", "xx"])


def _fit(rows, cols):
    X = np.column_stack([np.ones(len(rows))] + [rows[c].to_numpy() for c in cols])
    y = rows.z.to_numpy()
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    ssr = float(((y - X @ beta) ** 2).sum())
    n, k = len(y), len(cols)
    return beta, n * math.log(2 * math.pi * ssr / n) + n + 2 * (k + 2)


def test_ar_order_grid_equals_lstsq(spark, panel):
    got = {(r.series_id, r.window, r.d, r.config): r for r in Q["ar_order_grid"](spark, SF_SMALL).collect()}
    tr, _ = _train_test(panel)
    for d in (0, 1):
        des = _design(tr, d)
        for sid, rows in des.groupby("series_id"):
            for p in (1, 2, 3):
                for name, cols in ((f"ar{p}", [f"z{k}" for k in range(1, p + 1)]),
                                   (f"arx{p}", [f"z{k}" for k in range(1, p + 1)] + ["xx"])):
                    _, aic = _fit(rows, cols)
                    r = got[(sid, "full", d, name)]
                    assert r.n == len(rows)
                    assert math.isclose(r.aic, aic, abs_tol=1e-3)


def test_ar_forecast_metrics_equal_python_recursion(spark, panel):
    got = {(r.series_id, r.d, r.config): r for r in Q["ar_forecast_metrics"](spark, SF_SMALL).collect()}
    tr, te = _train_test(panel)
    for d in (0, 1):
        des = _design(tr, d)
        for sid, rows in des.groupby("series_id"):
            t_tr, t_te = tr[tr.series_id == sid], te[te.series_id == sid]
            hist_y = list(t_tr.y.to_numpy())
            z_hist = hist_y[-3:] if d == 0 else list(np.diff(hist_y)[-3:])
            x_all = np.concatenate([t_tr.x1.to_numpy(), t_te.x1.to_numpy()])
            xs = t_te.x1.to_numpy() if d == 0 else np.diff(x_all)[-len(t_te):]
            for name, cols in (("ar2", ["z1", "z2"]), ("arx3", ["z1", "z2", "z3", "xx"])):
                beta, _ = _fit(rows, cols)
                c, phis = beta[0], list(beta[1:1 + sum(col.startswith("z") for col in cols)])
                b = beta[-1] if "xx" in cols else 0.0
                z = list(z_hist)
                for h in range(len(xs)):
                    z.append(c + sum(phi * z[-1 - i] for i, phi in enumerate(phis)) + b * xs[h])
                path = np.array(z[3:])
                level = path if d == 0 else hist_y[-1] + np.cumsum(path)
                rmse = float(np.sqrt(np.mean((level - t_te.y.to_numpy()) ** 2)))
                assert math.isclose(got[(sid, d, name)].rmse, rmse, abs_tol=1e-3), (sid, d, name)


def test_arma_hannan_rissanen_equals_two_stage_lstsq(spark, panel):
    got = {(r.series_id, r.config): r for r in Q["arma_hannan_rissanen"](spark, SF_SMALL).collect()}
    tr, _ = _train_test(panel)
    for sid, g in tr.groupby("series_id"):
        g = g.copy()
        for k in range(1, 7):
            g[f"y{k}"] = g.y.shift(k)
        full = g.dropna(subset=[f"y{k}" for k in range(1, 7)])
        X = np.column_stack([np.ones(len(full))] + [full[f"y{k}"] for k in range(1, 7)])
        a, *_ = np.linalg.lstsq(X, full.y, rcond=None)
        Xa = np.column_stack([np.ones(len(g))] + [g[f"y{k}"] for k in range(1, 7)])
        g["u"] = g.y - Xa @ a
        g["u1"] = g.u.shift(1)
        for name, cols in (("arma11", ["y1", "u1"]), ("arma21", ["y1", "y2", "u1"])):
            rows = g.dropna(subset=["y"] + cols)
            Xb = np.column_stack([np.ones(len(rows))] + [rows[c] for c in cols])
            b, *_ = np.linalg.lstsq(Xb, rows.y, rcond=None)
            r = got[(sid, name)]
            assert math.isclose(r.ar1, b[1], abs_tol=1e-3) and math.isclose(r.ma1, b[-1], abs_tol=1e-3)
            if name == "arma21":
                assert math.isclose(r.ar2, b[2], abs_tol=1e-3)


def test_pacf_equals_yule_walker_solve(spark, panel):
    got = {(r.series_id, r.lag): r.pacf for r in Q["pacf"](spark, SF_SMALL).collect()}
    for sid, g in panel.groupby("series_id"):
        e = g.y.to_numpy() - g.y.mean()
        c0 = float(e @ e)
        r = np.array([1.0] + [float(e[k:] @ e[:-k]) / c0 for k in range(1, 25)])
        for k in (1, 2, 5, 12):
            T = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            phi = np.linalg.solve(T, r[1:k + 1])
            assert math.isclose(got[(sid, k)], phi[-1], abs_tol=2e-6), (sid, k)
