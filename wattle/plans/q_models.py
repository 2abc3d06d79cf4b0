"""Forecasting, model comparison and residual diagnostics on the monthly panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import sqlparts as S
from .panel import monthly_panel, split_label
from .registry import query
from ..functions.numeric import chi2_sf_even, iso_date, normal_quantile, rnd, round_doubles
from ..operators import forecast as FC
from ..operators import quality as Q
from ..operators.regression import ols, ols_by_config
from ..operators.series import month_index

SHOCK, POST = "1998-01-01", "1999-04-01"
B = 1000                      # bootstrap replicates, as in the reference
WINDOW = 48                   # walk-forward training window (months)
# Scenario portfolios in MW (GWh/year = MW * 8760 / 1000), 10 % of volume benefits.
SCENARIOS_MW = {"small_10MW": 10, "medium_100MW": 100, "large_1000MW": 1000, "national_10GW": 10000}
SHARE_OPTIMISABLE = 0.10
# ADF critical values (constant, no trend; MacKinnon asymptotic) and KPSS 5 % (level).
ADF_CRIT_5PCT = -2.86
KPSS_CRIT_5PCT = 0.463


def _split(spark, sf_dir):
    p = monthly_panel(spark, sf_dir).withColumn("split", split_label()).withColumn("midx", month_index("month"))
    return p.filter(F.col("split") == "train"), p.filter(F.col("split") == "test")


def _fc(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return FC.baseline_forecasts(tr, te)


def _fc_out(df):
    return df.select("series_id", iso_date("month").alias("month"), "model", rnd("actual").alias("actual"),
                     rnd("forecast").alias("forecast"))


FC_SQL_OUT = f"SELECT series_id, {S.iso('month')} AS month, model, {S.r('actual')} AS actual, {S.r('forecast')} AS forecast"


@query("forecast_persistence", f"WITH {S.FORECAST_CTES} {FC_SQL_OUT} FROM f_pers")
def forecast_persistence(spark, sf_dir):
    """Last training value carried over the test horizon."""
    tr, te = _split(spark, sf_dir)
    return _fc_out(FC.persistence(tr, te))


@query("forecast_seasonal_naive", f"WITH {S.FORECAST_CTES} {FC_SQL_OUT} FROM f_seas")
def forecast_seasonal_naive(spark, sf_dir):
    """Same calendar month of the last training season (repeats the season beyond 12 steps)."""
    tr, te = _split(spark, sf_dir)
    return _fc_out(FC.seasonal_naive(tr, te))


@query("forecast_metrics", f"""
WITH {S.FORECAST_CTES}
SELECT series_id, model, n, {S.r('rmse')} AS rmse, {S.r('mae')} AS mae, {S.r('mape')} AS mape, {S.r('bias')} AS bias,
       {S.r('max_abs_error')} AS max_abs_error FROM fm""")
def forecast_metrics(spark, sf_dir):
    """RMSE, MAE, MAPE, bias and max error per series and model on the test months."""
    return round_doubles(FC.metrics(_fc(spark, sf_dir)))


@query("cumulative_abs_error", f"""
WITH {S.FORECAST_CTES}
SELECT series_id, model, {S.iso('month')} AS month,
       {S.r('sum(abs(forecast - actual)) OVER (PARTITION BY series_id, model ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS cum_abs_error
FROM fc""")
def cumulative_abs_error(spark, sf_dir):
    """Running sum of absolute errors per model over the test months."""
    fc = _fc(spark, sf_dir)
    w = Window.partitionBy("series_id", "model").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return fc.select("series_id", "model", iso_date("month").alias("month"),
                     rnd(F.sum(F.abs(F.col("forecast") - F.col("actual"))).over(w)).alias("cum_abs_error"))


@query("best_model", f"""
WITH {S.FORECAST_CTES},
rk AS (SELECT series_id, model, rmse, row_number() OVER (PARTITION BY series_id ORDER BY rmse, model) AS rank FROM fm)
SELECT series_id, model, {S.r('rmse')} AS rmse, CAST(rank AS BIGINT) AS rank, rank = 1 AS is_best FROM rk""")
def best_model(spark, sf_dir):
    """Ranking of models by test RMSE per series; the best has rank 1."""
    rk = FC.rank_models(FC.metrics(_fc(spark, sf_dir)))
    return rk.select("series_id", "model", rnd("rmse").alias("rmse"), "rank", (F.col("rank") == 1).alias("is_best"))


def _scen_sql():
    vals = ", ".join(f"('{k}', {v})" for k, v in SCENARIOS_MW.items())
    return f"(VALUES {vals}) s(scenario, mw)"


@query("scenario_value", f"""
WITH {S.FORECAST_CTES},
base AS (SELECT series_id, rmse AS rmse_base FROM fm WHERE model = 'persistence'),
imp AS (SELECT fm.series_id, fm.model, (rmse_base - rmse) / rmse_base * 100 AS improvement_pct,
               rmse_base - rmse AS error_reduction FROM fm JOIN base USING (series_id) WHERE fm.model <> 'persistence')
SELECT series_id, model, scenario, {S.r('improvement_pct')} AS improvement_pct, {S.r('error_reduction')} AS error_reduction,
       {S.r(f'mw * 8760 / 1000.0 * error_reduction * {SHARE_OPTIMISABLE} / 1000')} AS value_meur
FROM imp, {_scen_sql()}""")
def scenario_value(spark, sf_dir):
    """Improvement over persistence (% and per MWh) and yearly value per portfolio scenario."""
    m = FC.metrics(_fc(spark, sf_dir))
    base = m.filter(F.col("model") == "persistence").select("series_id", F.col("rmse").alias("rmse_base"))
    imp = (m.filter(F.col("model") != "persistence").join(base, "series_id")
           .select("series_id", "model",
                   ((F.col("rmse_base") - F.col("rmse")) / F.col("rmse_base") * 100).alias("improvement_pct"),
                   (F.col("rmse_base") - F.col("rmse")).alias("error_reduction")))
    sc = F.explode(F.array(*[F.struct(F.lit(k).alias("scenario"), F.lit(v).alias("mw")) for k, v in SCENARIOS_MW.items()]))
    x = imp.select("*", sc.alias("s"))
    val = F.col("s.mw") * 8760 / 1000.0 * F.col("error_reduction") * SHARE_OPTIMISABLE / 1000
    return x.select("series_id", "model", F.col("s.scenario").alias("scenario"), rnd("improvement_pct").alias("improvement_pct"),
                    rnd("error_reduction").alias("error_reduction"), rnd(val).alias("value_meur"))


@query("error_by_period", f"""
WITH {S.FORECAST_CTES},
j AS (SELECT *, abs(actual / lag(actual) OVER (PARTITION BY series_id, model ORDER BY month) - 1) * 100 AS mom FROM fc)
SELECT series_id, model, CAST(year(month) AS BIGINT) AS period_year, count(*) AS n,
       {S.r('sqrt(avg((forecast - actual) ^ 2))')} AS rmse, {S.r('avg(abs(forecast - actual))')} AS mae,
       {S.r('max(mom)')} AS max_mom_jump_pct
FROM j GROUP BY ALL""")
def error_by_period(spark, sf_dir):
    """Errors by calendar sub-period of the test horizon, with the largest
    month-over-month jump of the actuals in that period."""
    fc = _fc(spark, sf_dir)
    w = Window.partitionBy("series_id", "model").orderBy("month")
    j = fc.withColumn("mom", F.abs(F.col("actual") / F.lag("actual").over(w) - 1) * 100)
    e = F.col("forecast") - F.col("actual")
    return j.groupBy("series_id", "model", F.year("month").cast("long").alias("period_year")).agg(
        F.count("*").alias("n"), rnd(F.sqrt(F.avg(e * e))).alias("rmse"), rnd(F.avg(F.abs(e))).alias("mae"),
        rnd(F.max("mom")).alias("max_mom_jump_pct"))


@query("regression_fit", f"""
WITH {S.FORECAST_CTES}
SELECT rc.series_id, rc.n, {S.r('rc.a')} AS intercept, {S.r('rc.b')} AS slope, {S.r('rc.r2', 6)} AS r2,
       {S.r('fm.rmse')} AS rmse_test
FROM rc JOIN fm ON rc.series_id = fm.series_id AND fm.model = 'regression_x1'""")
def regression_fit(spark, sf_dir):
    """Simple regression of the target on x1 per series, with test RMSE."""
    tr, te = _split(spark, sf_dir)
    rc = FC.regression_coefs(tr)
    m = FC.metrics(FC.regression(tr, te)).select("series_id", "rmse")
    return rc.join(m, "series_id").select("series_id", "n", rnd("a").alias("intercept"), rnd("b").alias("slope"),
                                          rnd("r2", 6).alias("r2"), rnd("rmse").alias("rmse_test"))


@query("ar1_fit", f"""
WITH {S.FORECAST_CTES}
SELECT ac.series_id, ac.n, {S.r('ac.c')} AS c, {S.r('ac.phi', 6)} AS phi, {S.r('ac.r2', 6)} AS r2,
       {S.r('fm.rmse')} AS rmse_test
FROM ac JOIN fm ON ac.series_id = fm.series_id AND fm.model = 'ar1'""")
def ar1_fit(spark, sf_dir):
    """AR(1) by conditional least squares per series, with its multi-step test RMSE."""
    tr, te = _split(spark, sf_dir)
    ac = FC.ar1_coefs(tr)
    m = FC.metrics(FC.ar1(tr, te)).select("series_id", "rmse")
    return ac.join(m, "series_id").select("series_id", "n", rnd("c").alias("c"), rnd("phi", 6).alias("phi"),
                                          rnd("r2", 6).alias("r2"), rnd("rmse").alias("rmse_test"))


REGRESSORS = ["x1", "x2", "x3", "x4"]
# Named configurations: intercept only, every single regressor, every pair, one set of three.
CONFIGS = {"const": []}
CONFIGS.update({x: [x] for x in REGRESSORS})
CONFIGS.update({f"{a}_{b}": [a, b] for i, a in enumerate(REGRESSORS) for b in REGRESSORS[i + 1:]})
CONFIGS["x1_x2_x3"] = ["x1", "x2", "x3"]


def _det3(m):
    """SQL text of the determinant of a 3 x 3 matrix of SQL expressions."""
    return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
            f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
            f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")


def _closed_form(k):
    """SQL text of the coefficients and of the diagonal of the inverse for 0 to 3 regressors, from centred
    moments s<i><j> (i <= j) and s<i>y."""
    m = [[f"s{min(i, j)}{max(i, j)}" for j in range(k)] for i in range(k)]
    if k == 0:
        return [], []
    if k == 1:
        return ["s0y / s00"], ["1 / s00"]
    if k == 2:
        det = "(s00 * s11 - s01 * s01)"
        return ([f"(s11 * s0y - s01 * s1y) / {det}", f"(s00 * s1y - s01 * s0y) / {det}"], [f"s11 / {det}", f"s00 / {det}"])
    det = _det3(m)
    coefs = [_det3([[f"s{i}y" if j == at else m[i][j] for j in range(3)] for i in range(3)]) + f" / {det}" for at in range(3)]
    rest = [[i for i in range(3) if i != at] for at in range(3)]
    return coefs, [f"({m[a][a]} * {m[b][b]} - {m[a][b]} * {m[a][b]}) / {det}" for a, b in rest]


def _config_moments(cols):
    """Centred moments of a configuration's own complete cases."""
    mom = ["count(*) AS n", "avg(y) AS my", "var_pop(y) AS vyy"]
    for i, a in enumerate(cols):
        mom += [f"avg({a}) AS m{i}", f"covar_pop({a}, y) AS s{i}y"] + [f"covar_pop({a}, {b}) AS s{i}{j}" for j, b in enumerate(cols) if j >= i]
    full = " AND ".join(f"{c} IS NOT NULL" for c in ["y", *cols])
    return f"SELECT series_id, {', '.join(mom)} FROM tr WHERE {full} GROUP BY 1"


def _cmp_sql():
    """Closed-form OLS per configuration (0 to 3 regressors) on its own complete cases."""
    rows = []
    for name, cols in CONFIGS.items():
        b, _ = _closed_form(len(cols))
        at = {c: b[i] for i, c in enumerate(cols)}
        sel = ", ".join(f"{at.get(x, 'CAST(NULL AS DOUBLE)')} AS b_{x}" for x in REGRESSORS)
        mean = " + ".join([f"({b[i]}) * m{i}" for i in range(len(cols))] or ["0"])
        fit = " + ".join([f"({b[i]}) * s{i}y" for i in range(len(cols))] or ["0"])
        rows.append(f"SELECT series_id, '{name}' AS config, {len(cols)} AS k, n, vyy, {sel}, my - ({mean}) AS intercept, "
                    f"n * (vyy - ({fit})) AS ssr FROM ({_config_moments(cols)})")
    pred = " + ".join(f"CASE WHEN b_{x} IS NULL THEN 0 ELSE b_{x} * te.{x} END" for x in REGRESSORS)
    return f"""
co2 AS MATERIALIZED ({' UNION ALL '.join(rows)}),
tm AS (SELECT co2.series_id, config, sqrt(avg((intercept + {pred} - te.y) ^ 2)) AS rmse_test,
              avg(abs(intercept + {pred} - te.y)) AS mae_test
       FROM co2 JOIN te USING (series_id) GROUP BY ALL)"""


@query("regression_compare", f"""
WITH {S.SPLIT_CTES}, {_cmp_sql()}
SELECT series_id, config, n, CAST(k AS INTEGER) AS k, {S.r('intercept')} AS intercept,
       {', '.join(f"{S.r('b_' + x)} AS coef_{x}" for x in REGRESSORS)},
       {S.r('1 - ssr / (n * vyy)', 6)} AS r2, {S.r('1 - (ssr / (n * vyy)) * (n - 1) / (n - k - 1)', 6)} AS adj_r2,
       {S.r('n * ln(2 * pi() * ssr / n) + n + 2 * (k + 2)')} AS aic,
       {S.r('rmse_test')} AS rmse_test, {S.r('mae_test')} AS mae_test
FROM co2 JOIN tm USING (series_id, config)""")
def regression_compare(spark, sf_dir):
    """Several regressor sets fitted in one pass (moments group-by + tiny solves), each on its own
    complete cases; R2, adjusted R2, AIC and test errors per series and configuration."""
    tr, te = _split(spark, sf_dir)
    sol, all_x = ols_by_config(tr, ["series_id"], "y", CONFIGS)
    coef = {c: F.col("coef")[i] for i, c in enumerate(all_x)}
    fit = sol.select("series_id", "config", "n", "k", "intercept",
                     *[coef[x].alias(f"coef_{x}") for x in REGRESSORS], "r2", "adj_r2", "aic")
    f = F.col("intercept")
    for x in REGRESSORS:
        f = f + F.when(F.col(f"coef_{x}").isNull(), F.lit(0.0)).otherwise(F.col(f"coef_{x}") * F.col(x))
    e = f - F.col("y")
    # one reference to the solved fits: test errors and fit columns in one group-by
    keep = ["n", "k", "intercept", *[f"coef_{x}" for x in REGRESSORS], "r2", "adj_r2", "aic"]
    out = fit.join(te.select("series_id", *REGRESSORS, "y"), "series_id").groupBy("series_id", "config").agg(
        *[F.first(c).alias(c) for c in keep], F.sqrt(F.avg(e * e)).alias("rmse_test"), F.avg(F.abs(e)).alias("mae_test"))
    return out.select("series_id", "config", "n", "k", rnd("intercept").alias("intercept"),
                      *[rnd(f"coef_{x}").alias(f"coef_{x}") for x in REGRESSORS],
                      rnd("r2", 6).alias("r2"), rnd("adj_r2", 6).alias("adj_r2"),
                      rnd("aic").alias("aic"), rnd("rmse_test").alias("rmse_test"), rnd("mae_test").alias("mae_test"))


def _inference_sql():
    """Each configuration on its own complete cases: coefficient, standard error, t, p and Beta per term."""
    ctes, rows = [], []
    for name, cols in CONFIGS.items():
        if not cols:
            continue
        b, inv = _closed_form(len(cols))
        fit = " + ".join(f"({x}) * s{i}y" for i, x in enumerate(b))
        ctes.append(f"i_{name} AS (SELECT *, n * (vyy - ({fit})) / (n - {len(cols)} - 1) AS s2 FROM ({_config_moments(cols)}))")
        rows += [f"SELECT series_id, '{name}' AS config, '{c}' AS term, n - {len(cols)} - 1 AS df, {b[i]} AS coef, "
                 f"sqrt(s2 * ({inv[i]}) / n) AS se, ({b[i]}) * sqrt(s{i}{i} / vyy) AS beta FROM i_{name}"
                 for i, c in enumerate(cols)]
    return f"{', '.join(ctes)}, it AS ({' UNION ALL '.join(rows)})"


@query("regression_inference", f"""
WITH {S.SPLIT_CTES}, {_inference_sql()},
pv AS (SELECT *, coef / se AS t, {S.t_two_sided_sql('(coef / se)', 'df')} AS p FROM it)
SELECT series_id, config, term, {S.r('coef')} AS coef, {S.r('se')} AS se, {S.r('t')} AS t, {S.r('p', 6)} AS p,
       CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars,
       {S.r('beta')} AS beta, CASE WHEN coef IS NULL THEN 'singular' ELSE 'ok' END AS status FROM pv""")
def regression_inference(spark, sf_dir):
    """Per configuration: standard errors, t, two-sided p (Student t), stars and
    standardised Beta of every coefficient (classical OLS errors). A singular fit
    keeps a row for each term, with status 'singular' and nulls."""
    tr, _ = _split(spark, sf_dir)
    return inference_rows(*ols_by_config(tr, ["series_id"], "y", CONFIGS), CONFIGS)


def inference_rows(sol, all_x, configs):
    """One row a series, configuration and term of it."""
    parts = ["coef", "se", "t", "p", "beta"]
    terms = F.array(*[F.struct(F.lit(c).alias("term"), *[F.col(v)[i].alias(v) for v in parts]) for i, c in enumerate(all_x)])
    mine = F.create_map(*[v for n, cols in configs.items() for v in (F.lit(n), F.array(*map(F.lit, cols)).cast("array<string>"))])
    x = sol.select("series_id", "config", "status", F.explode(terms).alias("z"))
    x = x.filter(F.array_contains(mine[F.col("config")], F.col("z.term")))
    stars = F.when(F.col("z.p") < 0.001, "***").when(F.col("z.p") < 0.01, "**").when(F.col("z.p") < 0.05, "*").otherwise("")
    return x.select("series_id", "config", F.col("z.term").alias("term"), rnd("z.coef").alias("coef"),
                    rnd("z.se").alias("se"), rnd("z.t").alias("t"), rnd("z.p", 6).alias("p"), stars.alias("stars"),
                    rnd("z.beta").alias("beta"), "status")


def _regime_sql(inference: bool = False):
    xs = ["x1", "rs", "rp"]
    S_ = [[f"c_{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    det = _det3(S_)
    coefs = []
    for j in range(3):
        mj = [[(f"c_{i}y" if jj == j else S_[i][jj]) for jj in range(3)] for i in range(3)]
        coefs.append(f"{_det3(mj)} / {det}")
    mom = ["count(*) AS n", "avg(y) AS my", "var_pop(y) AS vyy"]
    for i, a in enumerate(xs):
        mom += [f"avg({a}) AS m_{i}", f"covar_pop({a}, y) AS c_{i}y"]
        for j in range(i, 3):
            mom.append(f"covar_pop({a}, {xs[j]}) AS c_{i}{j}")
    minors = []
    for j in range(3):
        a, b = [i for i in range(3) if i != j]
        minors.append(f"(({S_[a][a]}) * ({S_[b][b]}) - ({S_[a][b]}) * ({S_[a][b]})) / {det} AS inv{j}")
    if inference:
        terms = " UNION ALL ".join(
            f"SELECT series_id, '{t}' AS term, n - 4 AS df, b{j} AS coef, sqrt(ssr / (n - 4) * inv{j} / n) AS se FROM f"
            for j, t in enumerate(("x1", "regime_shock", "regime_post")))
        tail = f""", it AS ({terms}), pv AS (SELECT *, coef / se AS t, {S.t_two_sided_sql('(coef / se)', 'df')} AS p FROM it)
SELECT series_id, term, {S.r('coef')} AS coef, {S.r('se')} AS se, {S.r('t')} AS t, {S.r('p', 6)} AS p FROM pv"""
    else:
        tail = f"""
SELECT series_id, n, {S.r('intercept')} AS intercept, {S.r('b0')} AS coef_x1, {S.r('b1')} AS coef_shock,
       {S.r('b2')} AS coef_post, {S.r('1 - ssr / (n * vyy)', 6)} AS r2,
       {S.r('n * ln(2 * pi() * ssr / n) + n + 2 * (3 + 2)')} AS aic
FROM f"""
    return f"""
WITH {S.SPLIT_CTES},
d AS (SELECT series_id, y, x1, CAST(month >= DATE '{SHOCK}' AND month < DATE '{POST}' AS DOUBLE) AS rs,
             CAST(month >= DATE '{POST}' AS DOUBLE) AS rp FROM tr WHERE y IS NOT NULL AND x1 IS NOT NULL),
mo AS (SELECT series_id, {', '.join(mom)} FROM d GROUP BY 1),
b AS (SELECT *, {coefs[0]} AS b0, {coefs[1]} AS b1, {coefs[2]} AS b2, {', '.join(minors)} FROM mo),
f AS (SELECT *, my - (b0 * m_0 + b1 * m_1 + b2 * m_2) AS intercept, n * (vyy - (b0 * c_0y + b1 * c_1y + b2 * c_2y)) AS ssr FROM b){tail}"""


@query("regime_regression", _regime_sql())
def regime_regression(spark, sf_dir):
    """Regression with regime dummies (shock, post-shock) next to x1; p-values of
    the dummies are in ``regime_inference``. A dummy that is constant for a series is
    left out (NULL) and the rest fitted."""
    sol = _regime_fit(spark, sf_dir)
    return sol.select("series_id", "n", rnd("intercept").alias("intercept"), rnd(F.col("coef")[0]).alias("coef_x1"),
                      rnd(F.col("coef")[1]).alias("coef_shock"), rnd(F.col("coef")[2]).alias("coef_post"),
                      rnd("r2", 6).alias("r2"), rnd("aic").alias("aic"))


def _regime_fit(spark, sf_dir):
    from ..functions.calendar import regime_dummies
    tr, _ = _split(spark, sf_dir)
    d = tr.select("*", *regime_dummies("month", SHOCK, POST)) \
        .withColumn("regime_shock", F.col("regime_shock").cast("double")) \
        .withColumn("regime_post", F.col("regime_post").cast("double"))
    return ols(d, ["series_id"], "y", ["x1", "regime_shock", "regime_post"], reduce=True)


@query("regime_inference", _regime_sql(inference=True))
def regime_inference(spark, sf_dir):
    """Standard errors, t and two-sided p-values (Student t) of the regime model."""
    sol = _regime_fit(spark, sf_dir)
    terms = F.array(F.lit("x1"), F.lit("regime_shock"), F.lit("regime_post"))
    z = F.explode(F.arrays_zip(terms.alias("term"), F.col("coef").alias("coef"), F.col("se").alias("se"),
                               F.col("t").alias("t"), F.col("p").alias("p")))
    x = sol.select("series_id", z.alias("z"))
    return x.select("series_id", F.col("z.term").alias("term"), rnd("z.coef").alias("coef"), rnd("z.se").alias("se"),
                    rnd("z.t").alias("t"), rnd("z.p", 6).alias("p"))


ARX_REGIME = {f"arx{p}": [*[f"z{k}" for k in range(1, p + 1)], "rs", "rp"] for p in (1, 2)}
ARX_WINDOWS = {"full": "TRUE", "pre_shock": f"month < DATE '{SHOCK}'", "from_shock": f"month >= DATE '{SHOCK}'"}


def _lag_windows(tr):
    """Levels (d = 0) and differences (d = 1) of y and of the regime dummies with lags of y, over three windows."""
    from ..functions.calendar import regime_dummies
    w = Window.partitionBy("series_id").orderBy("month")
    base = tr.filter(F.col("y").isNotNull()).select("series_id", "month", "y", *regime_dummies("month", SHOCK, POST))
    base = base.select("series_id", "month", "y", F.col("regime_shock").cast("double").alias("s"), F.col("regime_post").cast("double").alias("p"))
    diffs = base.select("*", *[(F.col(c) - F.lag(c).over(w)).alias(f"d{c}") for c in ("y", "s", "p")])
    parts = [diffs.filter(F.expr(cond)).select(
        "series_id", F.lit(name).alias("window_name"), F.lit(d).alias("d"), F.col(f"{pre}y").alias("z"), F.col(f"{pre}s").alias("rs"),
        F.col(f"{pre}p").alias("rp"), *[F.lag(f"{pre}y", k).over(w).alias(f"z{k}") for k in (1, 2)])
        for name, cond in ARX_WINDOWS.items() for d, pre in ((0, ""), (1, "d"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _arx_regime_sql():
    w = "OVER (PARTITION BY series_id ORDER BY month)"
    lags = ", ".join(f"lag({{z}}, {k}) {w} AS z{k}" for k in (1, 2))
    parts = [f"SELECT series_id, '{name}' AS window_name, {d} AS d, {pre}y AS z, {pre}s AS rs, {pre}p AS rp, {lags.format(z=pre + 'y')} "
             f"FROM xd WHERE {cond}" for name, cond in ARX_WINDOWS.items() for d, pre in ((0, ""), (1, "d"))]
    ctes, rows = [], []
    keys = ["series_id", "window_name", "d"]
    for name, cols in ARX_REGIME.items():
        k = len(cols) + 1
        full = " AND ".join(f"{c} IS NOT NULL" for c in ["z", *cols])
        ctes += [f"c_{name} AS (SELECT * FROM xw WHERE {full})", S.eliminate_ctes(f"c_{name}", keys, ["1", *cols, "z"], name),
                 S.solve_cte(name, keys, k), f"n_{name} AS (SELECT series_id, window_name, d, count(*) AS n, var_pop(z) AS vyy FROM c_{name} GROUP BY ALL)"]
        at = {c: f"b{i + 1}" for i, c in enumerate(cols)}
        gone = " || ".join(f"CASE WHEN {at[c]} IS NULL THEN ',{c}' ELSE '' END" for c in cols)
        left = " + ".join(f"CASE WHEN {at[c]} IS NULL THEN 0 ELSE 1 END" for c in cols)
        rows.append(f"SELECT series_id, window_name, d, '{name}' AS config, n, {left} AS k, b0, {at['z1']} AS ar1, {at.get('z2', 'NULL::DOUBLE')} AS ar2, "
                    f"{at['rs']} AS shock, {at['rp']} AS post, ltrim({gone}, ',') AS dropped, ssr, vyy FROM {name}_b JOIN n_{name} USING (series_id, window_name, d)")
    return f"""WITH {S.SPLIT_CTES},
xb AS (SELECT series_id, month, y, CASE WHEN month >= DATE '{SHOCK}' AND month < DATE '{POST}' THEN 1.0 ELSE 0.0 END AS s,
              CASE WHEN month >= DATE '{POST}' THEN 1.0 ELSE 0.0 END AS p FROM tr WHERE y IS NOT NULL),
xd AS (SELECT *, y - lag(y) {w} AS dy, s - lag(s) {w} AS ds, p - lag(p) {w} AS dp FROM xb),
xw AS ({' UNION ALL '.join(parts)}), {', '.join(ctes)}, u AS ({' UNION ALL '.join(rows)})
SELECT series_id, window_name, CAST(d AS INTEGER) AS d, config, n, CAST(k AS INTEGER) AS k, {S.r('b0')} AS intercept, {S.r('ar1')} AS ar1, {S.r('ar2')} AS ar2,
       {S.r('shock')} AS shock, {S.r('post')} AS post, dropped, CASE WHEN dropped = '' THEN 'ok' ELSE 'reduced' END AS status,
       {S.r('1 - ssr / (n * vyy)')} AS r2, {S.r('n * ln(2 * pi() * ssr / n) + n + 2 * (k + 2)')} AS aic FROM u"""


@query("arx_regime", _arx_regime_sql())
def arx_regime(spark, sf_dir):
    """ARX(1) and ARX(2) with shock and post-shock dummies, on levels and differences, over all training
    months, those before the shock and those from it on. Dummies that are constant in a window, or that
    depend on the other, are named in ``dropped`` and the rest is fitted."""
    tr, _ = _split(spark, sf_dir)
    sol, names = ols_by_config(_lag_windows(tr), ["series_id", "window_name", "d"], "z", ARX_REGIME, reduce=True)
    slot = {n: F.col("coef")[i] for i, n in enumerate(names)}
    dropped = F.array_join(F.transform("dropped", lambda i: F.array(*map(F.lit, names))[i]), ",")
    return sol.select("series_id", "window_name", "d", "config", "n", "k", rnd("intercept").alias("intercept"), rnd(slot["z1"]).alias("ar1"),
                      rnd(slot["z2"]).alias("ar2"), rnd(slot["rs"]).alias("shock"), rnd(slot["rp"]).alias("post"),
                      dropped.alias("dropped"), "status", rnd("r2").alias("r2"), rnd("aic").alias("aic"))


def _ar_grid(tr, window_filters):
    """AR(p)/ARX(p) fits for d in {0, 1} over the given windows, one solve pass.

    Returns (solutions, regressor names); coefficient slot i belongs to name i."""
    w = Window.partitionBy("series_id").orderBy("month")
    base = tr.select("series_id", "month", "y", "x1",
                     (F.col("y") - F.lag("y").over(w)).alias("dy"), (F.col("x1") - F.lag("x1").over(w)).alias("dx1"))
    parts = []
    for win, cond in window_filters:
        for d, z, x in ((0, "y", "x1"), (1, "dy", "dx1")):
            parts.append(base.filter(cond).select(
                "series_id", F.lit(win).alias("window"), F.lit(d).alias("d"), F.col(z).alias("z"), F.col(x).alias("xx"),
                *[F.lag(z, k).over(w).alias(f"z{k}") for k in (1, 2, 3)]))
    stacked = parts[0]
    for p_ in parts[1:]:
        stacked = stacked.unionByName(p_)
    # all orders share the rows available to the longest lag (comparable AIC)
    stacked = stacked.dropna(subset=["z3", "z", "xx"])
    cfg = {}
    for p in (1, 2, 3):
        cfg[f"ar{p}"] = [f"z{k}" for k in range(1, p + 1)]
        cfg[f"arx{p}"] = [f"z{k}" for k in range(1, p + 1)] + ["xx"]
    sol, all_x = ols_by_config(stacked, ["series_id", "window", "d"], "z", cfg)
    return sol, all_x


AR_GRID = {f"ar{x}{p}": (p, bool(x)) for p in (1, 2, 3) for x in ("", "x")}


def _grid_ctes(windows):
    """Every (window, d) with lag columns, and the solved fits ``gf`` of every order on the common rows."""
    w = "OVER (PARTITION BY series_id ORDER BY month)"
    lag = lambda z: ", ".join(f"lag({z}, {k}) {w} AS z{k}" for k in (1, 2, 3))
    parts = [f"SELECT series_id, '{name}' AS win, {d} AS d, {z} AS z, {x} AS xx, {lag(z)} FROM gd WHERE {cond}"
             for name, cond in windows for d, z, x in ((0, "y", "x1"), (1, "dy", "dx1"))]
    keys, ctes, rows = ["series_id", "win", "d"], [], []
    for name, (p, x) in AR_GRID.items():
        cols = [f"z{k}" for k in range(1, p + 1)] + ["xx"] * x
        k = len(cols) + 1
        full = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        ctes += [f"g_{name} AS (SELECT * FROM gw WHERE {full})", S.eliminate_ctes(f"g_{name}", keys, ["1", *cols, "z"], name),
                 S.solve_cte(name, keys, k), f"m_{name} AS (SELECT series_id, win, d, count(*) AS n, var_pop(z) AS vyy FROM g_{name} GROUP BY ALL)"]
        at = {c: f"b{i + 1}" for i, c in enumerate(cols)}
        phis = ", ".join(f"{at.get(f'z{i}', '0.0')} AS phi{i}" for i in (1, 2, 3))
        rows.append(f"SELECT series_id, win, d, '{name}' AS config, n, {len(cols)} AS k, b0 AS c, {phis}, {at.get('xx', '0.0')} AS beta, ssr, vyy "
                    f"FROM {name}_b JOIN m_{name} USING (series_id, win, d)")
    return f"""{S.SPLIT_CTES},
gd AS (SELECT *, y - lag(y) {w} AS dy, x1 - lag(x1) {w} AS dx1 FROM tr),
gw AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE z3 IS NOT NULL AND z IS NOT NULL AND xx IS NOT NULL),
{', '.join(ctes)}, gf AS MATERIALIZED ({' UNION ALL '.join(rows)})"""


def _grid_sql():
    return f"""WITH {_grid_ctes([("full", "TRUE"), ("pre_shock", f"month < DATE '{SHOCK}'")])},
ga AS (SELECT *, n * (ln(2 * pi() * ssr / n) + 1) AS m2ll FROM gf)
SELECT series_id, win AS "window", CAST(d AS INTEGER) AS d, config, n, CAST(k AS INTEGER) AS k, {S.r('m2ll + 2 * (k + 2)')} AS aic,
       {S.r('m2ll + ln(n) * (k + 2)')} AS bic, {S.r('1 - ssr / (n * vyy)')} AS r2,
       CAST(row_number() OVER (PARTITION BY series_id, win ORDER BY m2ll + 2 * (k + 2), d, config) AS INTEGER) AS aic_rank
FROM ga"""


def _grid_forecast_sql():
    """The recursion month by month as a recursive CTE."""
    w = "OVER (PARTITION BY series_id ORDER BY month)"
    return f"""WITH RECURSIVE {_grid_ctes([("full", "TRUE")])},
ft AS (SELECT *, y - lag(y) {w} AS dy, x1 - lag(x1) {w} AS dx1 FROM sp WHERE split IS NOT NULL),
fl AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS rn FROM ft WHERE split = 'train'),
fh AS (SELECT series_id, max(CASE WHEN rn = 1 THEN y END) AS y1, max(CASE WHEN rn = 2 THEN y END) AS y2, max(CASE WHEN rn = 3 THEN y END) AS y3,
              max(CASE WHEN rn = 1 THEN dy END) AS d1, max(CASE WHEN rn = 2 THEN dy END) AS d2, max(CASE WHEN rn = 3 THEN dy END) AS d3 FROM fl GROUP BY 1),
fs AS (SELECT *, row_number() {w} AS h FROM ft WHERE split = 'test'),
rc AS (SELECT gf.series_id, gf.d, gf.config, CAST(0 AS BIGINT) AS h, CASE WHEN d = 0 THEN y1 ELSE d1 END AS a1,
              CASE WHEN d = 0 THEN y2 ELSE d2 END AS a2, CASE WHEN d = 0 THEN y3 ELSE d3 END AS a3, y1 AS lev, NULL::DOUBLE AS actual
       FROM gf JOIN fh USING (series_id)
       UNION ALL
       SELECT series_id, d, config, h, a0, a1, a2, CASE WHEN d = 0 THEN a0 ELSE lev + a0 END, y FROM (
         SELECT rc.series_id, rc.d, rc.config, fs.h, rc.a1, rc.a2, rc.lev, fs.y,
                gf.c + gf.phi1 * rc.a1 + gf.phi2 * rc.a2 + gf.phi3 * rc.a3 + gf.beta * CASE WHEN rc.d = 0 THEN fs.x1 ELSE fs.dx1 END AS a0
         FROM rc JOIN fs ON fs.series_id = rc.series_id AND fs.h = rc.h + 1
         JOIN gf ON gf.series_id = rc.series_id AND gf.d = rc.d AND gf.config = rc.config))
SELECT series_id, CAST(d AS INTEGER) AS d, config, count(lev - actual) AS n, {S.r('sqrt(avg((lev - actual) ^ 2))')} AS rmse,
       {S.r('avg(abs(lev - actual))')} AS mae FROM rc WHERE h > 0 GROUP BY 1, 2, 3"""


@query("ar_order_grid", _grid_sql())
def ar_order_grid(spark, sf_dir):
    """AR(p) / ARX(p) with d in {0, 1}, p in {1, 2, 3}, on the full training window
    and on the pre-shock window: conditional least squares on lag columns, all
    (window, d, order) fits stacked as rows and solved in one moments pass;
    ranked by AIC per window."""
    tr, _ = _split(spark, sf_dir)
    sol, _ = _ar_grid(tr, [("full", F.lit(True)), ("pre_shock", F.col("month") < F.lit(SHOCK).cast("date"))])
    allfit = sol.select("series_id", "window", "d", "config", "n", "k", "aic", "bic", "r2")
    rk = Window.partitionBy("series_id", "window").orderBy("aic", "d", "config")
    return round_doubles(allfit.withColumn("aic_rank", F.row_number().over(rk)))


# multi-step recursion over the horizon as one higher-order SQL expression:
# z_(T+h) = c + phi1 z_(T+h-1) + phi2 z_(T+h-2) + phi3 z_(T+h-3) + beta xx_(T+h)
AR_PATH = """slice(aggregate(sequence(1, size(xs)), hist,
      (acc, h) -> concat(acc, array(c + phi1 * element_at(acc, -1) + phi2 * element_at(acc, -2)
                                      + phi3 * element_at(acc, -3) + beta * element_at(xs, h)))), 4, size(xs))"""
LEVELS = """CASE WHEN d = 0 THEN zpath ELSE
      slice(aggregate(zpath, array(y_T), (acc, v) -> concat(acc, array(element_at(acc, -1) + v))), 2, size(zpath)) END"""


@query("ar_forecast_metrics", _grid_forecast_sql())
def ar_forecast_metrics(spark, sf_dir):
    """Test-horizon RMSE/MAE of every AR/ARX order (d = 0 on levels, d = 1 on
    differences integrated back): forecasts are built recursively per series
    with ``aggregate`` over the horizon; the only per-series arrays are the last
    three training values and the <= 18 test-step regressor values."""
    tr, te = _split(spark, sf_dir)
    sol, all_x = _ar_grid(tr, [("full", F.lit(True))])
    co = F.col("coef")
    slot = {name: co[all_x.index(src)] for name, src in
            (("phi1", "z1"), ("phi2", "z2"), ("phi3", "z3"), ("beta", "xx"))}   # slots follow all_x
    fits = sol.select("series_id", "d", "config", F.col("intercept").alias("c"),
                      *[F.coalesce(slot[n], F.lit(0.0)).alias(n) for n in ("phi1", "phi2", "phi3", "beta")])
    w = Window.partitionBy("series_id").orderBy("month")
    full = tr.unionByName(te).select("series_id", "month", "split", "y", "x1",
                                     (F.col("y") - F.lag("y").over(w)).alias("dy"),
                                     (F.col("x1") - F.lag("x1").over(w)).alias("dx1"))
    last = (Q.first_k_by(full.filter(F.col("split") == "train"), ["series_id"], [F.col("month").desc()], 3)
            .groupBy("series_id").agg(
                *[F.max(F.when(F.col("rn") == k, F.col(c))).alias(f"{c}_{k}") for k in (1, 2, 3) for c in ("y", "dy")]))
    test = (full.filter(F.col("split") == "test").groupBy("series_id")
            .agg(F.sort_array(F.collect_list(F.struct("month", "x1", "dx1", "y"))).alias("steps")))
    hist = last.join(test, "series_id").select(
        "series_id", F.col("y_1").alias("y_T"), "steps",
        F.array("y_3", "y_2", "y_1").alias("hist0"), F.array("dy_3", "dy_2", "dy_1").alias("hist1"))
    j = fits.join(hist, "series_id").select(
        "series_id", "d", "config", "c", "phi1", "phi2", "phi3", "beta", "y_T", "steps",
        F.when(F.col("d") == 0, F.col("hist0")).otherwise(F.col("hist1")).alias("hist"),
        F.when(F.col("d") == 0, F.col("steps.x1")).otherwise(F.col("steps.dx1")).alias("xs"))
    j = j.withColumn("zpath", F.expr(AR_PATH)).withColumn("level", F.expr(LEVELS))
    pts = j.select("series_id", "d", "config", F.explode(F.arrays_zip(F.col("steps.y").alias("actual"),
                                                                     F.col("level").alias("forecast"))).alias("p"))
    e = F.col("p.forecast") - F.col("p.actual")
    return pts.groupBy("series_id", "d", "config").agg(
        F.count(e).alias("n"), rnd(F.sqrt(F.avg(e * e))).alias("rmse"), rnd(F.avg(F.abs(e))).alias("mae"))


@query("rolling_coefficient", f"""
WITH {S.SPLIT_CTES}
SELECT series_id, {S.iso('month')} AS month,
       {S.r(f'regr_slope(y, x1) OVER w')} AS slope, {S.r(f'regr_intercept(y, x1) OVER w')} AS intercept,
       regr_count(y, x1) OVER w AS n_window
FROM sp WINDOW w AS (PARTITION BY series_id ORDER BY midx RANGE BETWEEN {WINDOW} PRECEDING AND 1 PRECEDING)""")
def rolling_coefficient(spark, sf_dir):
    """Regression coefficients over the previous 48 months of every month."""
    p = monthly_panel(spark, sf_dir).withColumn("midx", month_index("month"))
    w = Window.partitionBy("series_id").orderBy("midx").rangeBetween(-WINDOW, -1)
    return p.select("series_id", iso_date("month").alias("month"), rnd(F.regr_slope("y", "x1").over(w)).alias("slope"),
                    rnd(F.regr_intercept("y", "x1").over(w)).alias("intercept"),
                    F.regr_count("y", "x1").over(w).alias("n_window"))


def _wf(spark, sf_dir):
    p = monthly_panel(spark, sf_dir).withColumn("midx", month_index("month")).withColumn("split", split_label())
    w = Window.partitionBy("series_id").orderBy("midx").rangeBetween(-WINDOW, -1)
    return p.select("*", F.regr_slope("y", "x1").over(w).alias("b"), F.regr_intercept("y", "x1").over(w).alias("a"),
                    F.regr_count("y", "x1").over(w).alias("n_window")).filter(F.col("split") == "test")


WF_SQL = f"""{S.SPLIT_CTES},
wf AS (SELECT *, regr_slope(y, x1) OVER w AS b, regr_intercept(y, x1) OVER w AS a, regr_count(y, x1) OVER w AS n_window
       FROM sp WINDOW w AS (PARTITION BY series_id ORDER BY midx RANGE BETWEEN {WINDOW} PRECEDING AND 1 PRECEDING)),
wft AS (SELECT * FROM wf WHERE split = 'test')"""


@query("walk_forward_forecast", f"""
WITH {WF_SQL}
SELECT series_id, {S.iso('month')} AS month, {S.r('y')} AS actual, {S.r('a + b * x1')} AS forecast, n_window
FROM wft WHERE x1 IS NOT NULL AND n_window > 0""")
def walk_forward_forecast(spark, sf_dir):
    """Each test month refitted on the 48 months before it and forecast one step
    ahead (skipped when the regressor is missing)."""
    t = _wf(spark, sf_dir).filter(F.col("x1").isNotNull() & (F.col("n_window") > 0))
    return t.select("series_id", iso_date("month").alias("month"), rnd("y").alias("actual"),
                    rnd(F.col("a") + F.col("b") * F.col("x1")).alias("forecast"), "n_window")


@query("coefficient_drift", f"""
WITH {WF_SQL},
d AS (SELECT series_id, month, b, first_value(b) OVER (PARTITION BY series_id ORDER BY month) AS b0 FROM wft),
d2 AS (SELECT *, (b - b0) / abs(b0) * 100 AS drift_pct FROM d)
SELECT series_id, {S.iso('month')} AS month, {S.r('b')} AS slope, {S.r('b0')} AS base_slope, {S.r('drift_pct')} AS drift_pct,
       CASE WHEN abs(drift_pct) < 2 THEN 'stable' WHEN abs(drift_pct) <= 4 THEN 'moderate' ELSE 'strong' END AS band,
       abs(drift_pct) > 5 AS alarm
FROM d2""")
def coefficient_drift(spark, sf_dir):
    """Drift of the rolling slope against the first test month: bands < 2 %,
    2-4 %, > 4 %; alarm above 5 %."""
    t = _wf(spark, sf_dir)
    w = Window.partitionBy("series_id").orderBy("month")
    d = t.select("series_id", "month", "b", F.first("b").over(w).alias("b0"))
    d = d.withColumn("drift_pct", (F.col("b") - F.col("b0")) / F.abs("b0") * 100)
    a = F.abs("drift_pct")
    band = F.when(a < 2, "stable").when(a <= 4, "moderate").otherwise("strong")
    return d.select("series_id", iso_date("month").alias("month"), rnd("b").alias("slope"), rnd("b0").alias("base_slope"),
                    rnd("drift_pct").alias("drift_pct"), band.alias("band"), (a > 5).alias("alarm"))


@query("bootstrap_intervals", f"""
WITH {S.FORECAST_CTES},
rt AS (SELECT tr.series_id, tr.x1, rc.a + rc.b * tr.x1 AS fit, tr.y - (rc.a + rc.b * tr.x1) AS e,
              row_number() OVER (PARTITION BY tr.series_id ORDER BY tr.month) AS i,
              count(*) OVER (PARTITION BY tr.series_id) AS n
       FROM tr JOIN rc USING (series_id) WHERE tr.y IS NOT NULL AND tr.x1 IS NOT NULL),
rep AS (SELECT series_id, b AS rep, i, x1, fit, n, (b * 7919 + i * 104729) % n + 1 AS j
        FROM rt, (SELECT unnest(generate_series(0, {B - 1})) AS b)),
ys AS (SELECT rep.series_id, rep.rep, rep.x1, rep.fit + rt.e AS ystar FROM rep JOIN rt ON rep.series_id = rt.series_id AND rep.j = rt.i),
cb AS (SELECT series_id, rep, regr_intercept(ystar, x1) AS a, regr_slope(ystar, x1) AS b FROM ys GROUP BY ALL),
fb AS (SELECT te.series_id, te.month, te.y, cb.a + cb.b * te.x1 AS f FROM te JOIN cb USING (series_id))
SELECT series_id, {S.iso('month')} AS month, {S.r('any_value(y)')} AS actual, {S.r('avg(f)')} AS mean,
       {S.r('quantile_cont(f, 0.1)')} AS p10, {S.r('quantile_cont(f, 0.9)')} AS p90,
       {S.r('quantile_cont(f, 0.025)')} AS p025, {S.r('quantile_cont(f, 0.975)')} AS p975
FROM fb GROUP BY series_id, month""")
def bootstrap_intervals(spark, sf_dir):
    """Residual bootstrap (B = 1000) of the x1 regression: residuals are drawn by an
    arithmetic hash of (replicate, row), and forecast bands are exact percentiles per
    test month. One group-by makes a series an array of its months; the replicates
    are refitted in it by the closed form of the slope, so none is shuffled."""
    p = monthly_panel(spark, sf_dir).withColumn("split", split_label())
    train, test = F.col("split") == "train", F.col("split") == "test"
    both = train & F.col("y").isNotNull() & F.col("x1").isNotNull()
    row = F.struct("month", "x1", "y")
    s = p.groupBy("series_id").agg(
        F.regr_intercept(F.when(train, F.col("y")), F.col("x1")).alias("a"),
        F.regr_slope(F.when(train, F.col("y")), F.col("x1")).alias("b"),
        F.sort_array(F.collect_list(F.when(both, row))).alias("tr"),
        F.sort_array(F.collect_list(F.when(test, row))).alias("te")).filter("size(tr) > 0")
    mean = "aggregate({0}, CAST(0 AS DOUBLE), (s, v) -> s + v) / size(tr)"
    s = s.selectExpr("*", mean.format("tr.x1") + " AS xm", mean.format("transform(tr, r -> a + b * r.x1)") + " AS fm",
                     "transform(tr, r -> r.y - (a + b * r.x1)) AS e")
    s = s.selectExpr("*", "transform(tr, r -> r.x1 - xm) AS xc")
    # a replicate: mean of its residuals, and its slope
    drawn = "e[CAST((r * 7919 + (i + 1) * 104729) % size(tr) AS INT)]"
    s = s.selectExpr("series_id", "te", "xm", "fm", f"""
        transform(sequence(0L, {B - 1}L), r -> aggregate(sequence(0, size(tr) - 1),
            named_struct('m', CAST(0 AS DOUBLE), 'c', CAST(0 AS DOUBLE)),
            (t, i) -> named_struct('m', t.m + {drawn}, 'c', t.c + xc[i] * {drawn}),
            t -> named_struct('m', t.m / size(tr),
                              'b', b + t.c / nullif(aggregate(xc, CAST(0 AS DOUBLE), (q, v) -> q + v * v), 0)))) AS reps""")
    f = s.selectExpr("series_id", "xm", "fm", "reps", "explode(te) AS t").selectExpr(
        "series_id", "t.month", "t.y AS actual", "array_sort(transform(reps, k -> fm + k.m + k.b * (t.x1 - xm))) AS f")

    def band(q: float) -> str:
        at, part = divmod(q * (B - 1), 1)
        lo, hi = f"f[{int(at)}]", f"f[{min(int(at) + 1, B - 1)}]"
        return f"{1 - part!r}D * {lo} + {part!r}D * {hi}"
    out = f.select("series_id", iso_date("month").alias("month"), "actual",
                   F.expr(f"aggregate(f, CAST(0 AS DOUBLE), (s, v) -> s + v) / {B}").alias("mean"),
                   *[F.expr(band(q)).alias(n) for n, q in (("p10", 0.1), ("p90", 0.9), ("p025", 0.025), ("p975", 0.975))])
    return round_doubles(out)


@query("nation_regression_fit", f"""
WITH px AS (SELECT {S.ms('CAST(l_shipdate AS DATE)')} AS month, avg(l_extendedprice / 1000) AS x1 FROM lineitem GROUP BY ALL),
ny AS (SELECT n.n_name AS series_id, {S.ms('CAST(o.o_orderdate AS DATE)')} AS month, avg(o.o_totalprice / 1000) AS y
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
       GROUP BY ALL),
tr AS (SELECT * FROM ny JOIN px USING (month) WHERE month <= DATE '1999-12-01')
SELECT series_id, regr_count(y, x1) AS n, {S.r('regr_intercept(y, x1)')} AS intercept,
       {S.r('regr_slope(y, x1)')} AS slope, {S.r('regr_r2(y, x1)', 6)} AS r2
FROM tr GROUP BY series_id""")
def nation_regression_fit(spark, sf_dir):
    """Many series in one job: one target series per customer nation (orders joined
    to customer and nation), every series' regression on x1 in one group-by."""
    from ..sources.tables import table
    from ..functions.calendar import month_start
    # pre-aggregate orders to (customer, month) sums and counts before the join:
    # a customer holding a large share of orders collapses map-side, and the join
    # moves one row per customer-month instead of one per order
    o = (table(spark, sf_dir, "orders")
         .groupBy("o_custkey", month_start(F.col("o_orderdate").cast("date")).alias("month"))
         .agg(F.sum(F.col("o_totalprice") / 1000).alias("s"), F.count("o_totalprice").alias("c")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # both dimensions join by key; AQE broadcasts on the measured size
    oc = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    y = (oc.groupBy(F.col("n_name").alias("series_id"), "month")
         .agg((F.sum("s") / F.sum("c")).alias("y")))
    from .panel import regressors
    tr = y.join(regressors(spark, sf_dir).select("month", "x1"), "month") \
        .filter(F.col("month") <= F.lit("1999-12-01").cast("date"))
    return tr.groupBy("series_id").agg(
        F.regr_count("y", "x1").alias("n"), rnd(F.regr_intercept("y", "x1")).alias("intercept"),
        rnd(F.regr_slope("y", "x1")).alias("slope"), rnd(F.regr_r2("y", "x1"), 6).alias("r2"))
