import math

import numpy as np
from pyspark.sql import functions as F

from wattle.operators.regression import ols, ols_by_config, t_two_sided_p
from wattle.operators.series import acf, pacf_from_acf


def _data(spark, n=60, seed=1):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(10, 2, n)
    x2 = rng.normal(5, 1, n) + 0.3 * x1
    y = 3 + 1.5 * x1 - 2 * x2 + rng.normal(0, 1, n)
    rows = [("s", int(i), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "series_id string, t long, x1 double, x2 double, y double"), x1, x2, y


def test_moments_ols_equals_numpy(spark):
    df, x1, x2, y = _data(spark)
    sol = ols(df, ["series_id"], "y", ["x1", "x2"]).first()
    X = np.column_stack([np.ones_like(x1), x1, x2])
    beta, res, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose([sol.intercept, *sol.coef], beta, atol=1e-8)
    ssr = float(((y - X @ beta) ** 2).sum())
    assert math.isclose(sol.ssr, ssr, rel_tol=1e-8)
    sigma2 = ssr / (len(y) - 3)
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(X.T @ X)))[1:]
    assert np.allclose(sol.se, se, rtol=1e-6)
    assert math.isclose(sol.r2, 1 - ssr / ((y - y.mean()) ** 2).sum(), rel_tol=1e-9)


def test_one_regressor_equals_regr_slope(spark):
    df, *_ = _data(spark)
    sol = ols(df, ["series_id"], "y", ["x1"]).first()
    ref = df.agg(F.regr_slope("y", "x1").alias("b"), F.regr_intercept("y", "x1").alias("a")).first()
    assert math.isclose(sol.coef[0], ref.b, rel_tol=1e-9) and math.isclose(sol.intercept, ref.a, rel_tol=1e-9)


def test_configs_in_one_pass(spark):
    df, *_ = _data(spark)
    sol, all_x = ols_by_config(df, ["series_id"], "y", {"a": ["x1"], "b": ["x1", "x2"]})
    got = {r.config: r for r in sol.collect()}
    assert all_x == ["x1", "x2"]
    assert got["a"].coef[1] is None and got["a"].k == 1
    full = ols(df, ["series_id"], "y", ["x1", "x2"]).first()
    assert np.allclose(got["b"].coef, full.coef)


def test_t_p_values():
    assert math.isclose(t_two_sided_p(2.0, 10), 0.0734, abs_tol=1e-4)
    assert math.isclose(t_two_sided_p(1.96, 10 ** 6), 0.05, abs_tol=1e-3)


def test_acf_and_pacf_of_ar1(spark):
    rng = np.random.default_rng(3)
    y = [0.0]
    for _ in range(999):
        y.append(0.7 * y[-1] + rng.normal())
    import datetime as dt
    rows = [("s", dt.date(1900 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "series_id string, month date, y double")
    a = acf(df, "y", 3)
    r = {x.lag: x.acf for x in a.collect()}
    arr = np.asarray(y) - np.mean(y)
    ref1 = float((arr[1:] * arr[:-1]).sum() / (arr * arr).sum())
    assert math.isclose(r[1], ref1, rel_tol=1e-9)
    p = {x.lag: x.pacf for x in pacf_from_acf(a).collect()}
    assert math.isclose(p[1], r[1], rel_tol=1e-12) and abs(p[2]) < 0.1


def test_ar_recursion_expression_matches_python(spark):
    from wattle.plans.q_models import AR_PATH, LEVELS
    c, p1, p2, p3, beta = 0.5, 0.6, -0.2, 0.1, 0.3
    hist, xs, y_T = [1.0, 2.0, 1.5], [0.2, -0.1, 0.4, 0.0], 10.0
    rows = [(d, c, p1, p2, p3, beta, hist, xs, y_T) for d in (0, 1)]
    df = spark.createDataFrame(rows, "d int, c double, phi1 double, phi2 double, phi3 double, beta double, "
                                     "hist array<double>, xs array<double>, y_T double")
    out = df.withColumn("zpath", F.expr(AR_PATH)).withColumn("level", F.expr(LEVELS)).orderBy("d").collect()
    z = list(hist)
    for x in xs:
        z.append(c + p1 * z[-1] + p2 * z[-2] + p3 * z[-3] + beta * x)
    path = z[3:]
    assert np.allclose(out[0].level, path)
    assert np.allclose(out[1].level, y_T + np.cumsum(path))


def test_t_p_values_against_numeric_integration():
    for t, df in ((0.5, 3), (1.7, 12), (2.9, 45), (4.0, 100)):
        logc = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
        x = np.linspace(t, t + 400, 2_000_001)
        pdf = np.exp(logc - (df + 1) / 2 * np.log1p(x * x / df))
        tail = float(np.sum((pdf[1:] + pdf[:-1]) / 2 * np.diff(x)))
        assert math.isclose(t_two_sided_p(t, df), 2 * tail, rel_tol=1e-4, abs_tol=1e-7)


def test_dependent_columns_are_named_and_left_out(spark):
    rng = np.random.default_rng(9)
    x1, x2 = rng.standard_normal(40), rng.standard_normal(40)
    y = 1 + 2 * x1 - x2 + 0.1 * rng.standard_normal(40)
    rows = [("s", float(a), float(a * 2 + 3), float(b), 7.0, float(c)) for a, b, c in zip(x1, x2, y)]
    df = spark.createDataFrame(rows, "sid string, x1 double, twin double, x2 double, flat double, y double")
    xs = ["x1", "twin", "x2", "flat"]
    hard = ols(df, ["sid"], "y", xs).first()
    assert hard.status == "singular" and hard.coef is None
    got = ols(df, ["sid"], "y", xs, reduce=True).first()
    assert (got.status, got.dropped, got.k) == ("reduced", [1, 3], 2) and got.coef[1] is None and got.coef[3] is None
    want = np.linalg.lstsq(np.column_stack([np.ones(40), x1, x2]), y, rcond=None)[0]
    assert np.allclose([got.intercept, got.coef[0], got.coef[2]], want) and got.se[1] is None and got.p[0] is not None
    assert ols(df, ["sid"], "y", ["flat"], reduce=True).first().dropped == [0]
    both, names = ols_by_config(df, ["sid"], "y", {"a": ["x1", "twin"], "b": ["x2"], "c": []}, reduce=True)
    by = {r.config: r for r in both.collect()}
    assert [names[i] for i in by["a"].dropped] == ["twin"] and by["b"].dropped == [] and by["c"].status == "ok"


def test_singular_fits_keep_their_inference_rows(spark):
    from wattle.plans.q_models import inference_rows
    df = spark.createDataFrame([("s", float(i), 5.0, float(i % 3)) for i in range(20)], "series_id string, x1 double, x2 double, y double")
    configs = {"a": ["x1", "x2"], "b": ["x1"], "c": []}
    got = {(r.config, r.term): r for r in inference_rows(*ols_by_config(df, ["series_id"], "y", configs), configs).collect()}
    assert set(got) == {("a", "x1"), ("a", "x2"), ("b", "x1")}
    assert got["a", "x1"].status == "singular" and got["a", "x2"].coef is None and got["b", "x1"].status == "ok"


def test_a_series_without_a_later_regime_keeps_its_fit(spark):
    from wattle.plans.q_models import ARX_REGIME, _lag_windows
    import datetime as dt
    rng = np.random.default_rng(2)
    rows = [("s", dt.date(1995 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(rng.standard_normal(30).cumsum())]
    df = spark.createDataFrame(rows, "series_id string, month date, y double")
    sol, names = ols_by_config(_lag_windows(df), ["series_id", "window_name", "d"], "z", ARX_REGIME, reduce=True)
    got = {(r.window_name, r.d, r.config): r for r in sol.collect()}
    r = got["full", 0, "arx2"]
    y = np.array([v[2] for v in rows])
    want = np.linalg.lstsq(np.column_stack([np.ones(28), y[1:-1], y[:-2]]), y[2:], rcond=None)[0]
    assert sorted(names[i] for i in r.dropped) == ["rp", "rs"]
    assert np.allclose([r.intercept, r.coef[names.index("z1")], r.coef[names.index("z2")]], want)
