"""ARMA and ARMAX orders of the survey's M4 against a two-stage least squares fit in numpy."""

import math

import numpy as np

import __spark_entry__ as entry
from wattle.plans.q_models import SHOCK, _split

SF = "/root/testdata/sf0.001"


def test_every_order_equals_two_stage_lstsq(spark):
    got = {(r.series_id, r.config): r for r in entry.queries()["arma_hannan_rissanen"](spark, SF).collect()}
    tr = _split(spark, SF)[0].select("series_id", "month", "y", "x1").toPandas().sort_values(["series_id", "month"])
    orders = {"arma12": (1, 2, 0, 0, 0), "arma22": (2, 2, 0, 0, 0), "armax21": (2, 1, 1, 0, 0), "armax31": (3, 1, 1, 0, 0),
              "arima111": (1, 1, 0, 1, 0), "arima211": (2, 1, 0, 1, 0), "pre_arma11": (1, 1, 0, 0, 1), "pre_arma12": (1, 2, 0, 0, 1)}
    for sid, all_ in tr.groupby("series_id"):
        for name, (p, q, x, d, pre) in orders.items():
            g = all_[all_.month.astype(str) < SHOCK].copy() if pre else all_.copy()
            g["z"] = g.y.diff() if d else g.y
            for k in range(1, 7):
                g[f"z{k}"] = g.z.shift(k)
            lags = [f"z{k}" for k in range(1, 7)]
            full = g.dropna(subset=["z", *lags])
            a, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(full)), full[lags]]), full.z, rcond=None)
            g["u"] = g.z - np.column_stack([np.ones(len(g)), g[lags]]) @ a
            g["u1"], g["u2"] = g.u.shift(1), g.u.shift(2)
            cols = [f"z{k}" for k in range(1, p + 1)] + [f"u{k}" for k in range(1, q + 1)] + ["x1"] * x
            rows = g.dropna(subset=["z", *cols])
            b, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(rows)), rows[cols]]), rows.z, rcond=None)
            r = got[(sid, name)]
            want = dict(zip([c.replace("z", "ar").replace("u", "ma").replace("x1", "beta_x1") for c in cols], b[1:]))
            assert r.n == len(rows)
            for c, v in want.items():
                assert math.isclose(r[c], v, rel_tol=1e-4, abs_tol=2e-3), (sid, name, c)
