"""Series windows, decomposition, cross-validation and residual diagnostics."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import consolidate as C
from . import sqlparts as S
from .panel import monthly_panel, split_label
from .q_models import ADF_CRIT_5PCT, KPSS_CRIT_5PCT, SHOCK, _split
from .q_quality import VALUE_COLS
from .materialize import consolidated_table
from .registry import query
from ..functions.numeric import chi2_sf_even, iso_date, normal_quantile, rnd, round_doubles
from ..operators import forecast as FC
from ..operators import quality as Q
from ..operators.regression import ols, ols_by_config
from ..operators.series import acf as acf_op, pacf_from_acf


def _wser():
    return Window.partitionBy("series_id").orderBy("month")


MAX_LAG = 24


def _out(df):
    return round_doubles(df)


@query("moving_average_deviation", f"""
WITH {S.PANEL_CTES},
m AS (SELECT series_id, month, y, avg(y) OVER w AS ma, count(y) OVER w AS c FROM panel
      WINDOW w AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT series_id, {S.iso('month')} AS month, {S.r('CASE WHEN c = 12 THEN ma END')} AS ma12,
       {S.r('CASE WHEN c = 12 THEN y - ma END')} AS deviation FROM m""")
def moving_average_deviation(spark, sf_dir):
    """12-month moving average (full windows only) and the signed deviation from it."""
    p = monthly_panel(spark, sf_dir)
    w = _wser().rowsBetween(-11, 0)
    full = F.count("y").over(w) == 12
    ma = F.avg("y").over(w)
    return p.select("series_id", iso_date("month").alias("month"), rnd(F.when(full, ma)).alias("ma12"),
                    rnd(F.when(full, F.col("y") - ma)).alias("deviation"))


@query("first_difference", f"""
WITH {S.PANEL_CTES}
SELECT series_id, {S.iso('month')} AS month, {S.r('y - lag(y) OVER (PARTITION BY series_id ORDER BY month)')} AS dy FROM panel""")
def first_difference(spark, sf_dir):
    """y_t - y_(t-1) within each series."""
    p = monthly_panel(spark, sf_dir)
    return p.select("series_id", iso_date("month").alias("month"), rnd(F.col("y") - F.lag("y").over(_wser())).alias("dy"))


def _acf_sql(src: str, col: str, max_lag: int, name: str) -> str:
    lags = ", ".join(f"lag(e, {k}) OVER w AS l{k}" for k in range(1, max_lag + 1))
    sums = ", ".join(f"sum(e * l{k}) AS s{k}" for k in range(1, max_lag + 1))
    rows = "\n  UNION ALL ".join(f"SELECT series_id, n, CAST({k} AS BIGINT) AS lag, s{k} / c0 AS acf FROM {name}_a"
                                 for k in range(1, max_lag + 1))
    return f"""
{name}_c AS (SELECT series_id, month, {col} - avg({col}) OVER (PARTITION BY series_id) AS e FROM {src} WHERE {col} IS NOT NULL),
{name}_l AS (SELECT series_id, e, {lags} FROM {name}_c WINDOW w AS (PARTITION BY series_id ORDER BY month)),
{name}_a AS (SELECT series_id, sum(e * e) AS c0, count(*) AS n, {sums} FROM {name}_l GROUP BY 1),
{name} AS ({rows})"""


@query("acf", f"""
WITH {S.PANEL_CTES}, {_acf_sql('panel', 'y', MAX_LAG, 'ac')}
SELECT series_id, n, lag, {S.r('acf', 6)} AS acf FROM ac""")
def acf(spark, sf_dir):
    """Autocorrelation of the target up to lag 24 (one window pass, one aggregate)."""
    a = acf_op(monthly_panel(spark, sf_dir), "y", MAX_LAG)
    return a.withColumn("acf", rnd("acf", 6))


@query("pacf", f"""
WITH RECURSIVE {S.PANEL_CTES}, {_acf_sql('panel', 'y', MAX_LAG, 'ac')},
rl AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM ac GROUP BY 1),
dl AS (SELECT series_id, r, 1 AS k, [r[1]] AS phi, 1 - r[1] * r[1] AS v FROM rl
       UNION ALL
       SELECT series_id, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a * phi[k + 1 - j]), a),
              v * (1 - a * a)
       FROM (SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j]))) / v AS a
             FROM dl WHERE k < {MAX_LAG}))
SELECT series_id, CAST(k AS BIGINT) AS lag, {S.r('phi[k]', 6)} AS pacf FROM dl""")
def pacf(spark, sf_dir):
    """Partial autocorrelation by Durbin-Levinson on each series' ACF."""
    a = acf_op(monthly_panel(spark, sf_dir), "y", MAX_LAG)
    return pacf_from_acf(a).withColumn("pacf", rnd("pacf", 6))


def _decomp(spark, sf_dir):
    p = monthly_panel(spark, sf_dir).select("series_id", "month", "y", F.month("month").alias("moy"))
    w13 = _wser().rowsBetween(-6, 6)
    w11 = _wser().rowsBetween(-5, 5)
    trend = F.when(F.count("y").over(w13) == 13,
                   (F.sum("y").over(w11) + 0.5 * F.lag("y", 6).over(_wser()) + 0.5 * F.lead("y", 6).over(_wser())) / 12)
    t = p.withColumn("trend", trend)
    idx = (t.groupBy("series_id", "moy")
           .agg(F.avg(F.col("y") / F.col("trend")).alias("sm"), F.avg(F.col("y") - F.col("trend")).alias("sa")))
    ws = Window.partitionBy("series_id")
    idx = idx.select("series_id", "moy", (F.col("sm") / F.avg("sm").over(ws)).alias("seasonal_mult"),
                     (F.col("sa") - F.avg("sa").over(ws)).alias("seasonal_add"))
    d = t.join(idx, ["series_id", "moy"])
    return d.select("series_id", "month", "y", "trend", "seasonal_add",
                    (F.col("y") - F.col("trend") - F.col("seasonal_add")).alias("resid_add"), "seasonal_mult",
                    (F.col("y") / (F.col("trend") * F.col("seasonal_mult"))).alias("resid_mult"))


DECOMP_SQL = f"""{S.PANEL_CTES},
dp AS (SELECT series_id, month, y, month(month) AS moy,
              CASE WHEN count(y) OVER w13 = 13 THEN (sum(y) OVER w11 + 0.5 * lag(y, 6) OVER w + 0.5 * lead(y, 6) OVER w) / 12 END AS trend
       FROM panel WINDOW w AS (PARTITION BY series_id ORDER BY month),
                          w13 AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING),
                          w11 AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
si AS (SELECT series_id, moy, avg(y / trend) AS sm, avg(y - trend) AS sa FROM dp GROUP BY ALL),
si2 AS (SELECT series_id, moy, sm / avg(sm) OVER (PARTITION BY series_id) AS seasonal_mult,
               sa - avg(sa) OVER (PARTITION BY series_id) AS seasonal_add FROM si),
dec AS (SELECT dp.series_id, dp.month, dp.y, dp.trend, si2.seasonal_add, dp.y - dp.trend - si2.seasonal_add AS resid_add,
               si2.seasonal_mult, dp.y / (dp.trend * si2.seasonal_mult) AS resid_mult
        FROM dp JOIN si2 USING (series_id, moy))"""


@query("seasonal_decompose", f"""
WITH {DECOMP_SQL}
SELECT series_id, {S.iso('month')} AS month, {S.r('trend')} AS trend, {S.r('seasonal_add')} AS seasonal_add,
       {S.r('resid_add')} AS resid_add, {S.r('seasonal_mult', 6)} AS seasonal_mult, {S.r('resid_mult', 6)} AS resid_mult
FROM dec""")
def seasonal_decompose(spark, sf_dir):
    """Classical decomposition: centred 2x12 trend, month-of-year indices (additive
    centred at 0, multiplicative rescaled to mean 1), residuals."""
    d = _decomp(spark, sf_dir)
    return d.select("series_id", iso_date("month").alias("month"), rnd("trend").alias("trend"),
                    rnd("seasonal_add").alias("seasonal_add"), rnd("resid_add").alias("resid_add"),
                    rnd("seasonal_mult", 6).alias("seasonal_mult"), rnd("resid_mult", 6).alias("resid_mult"))


@query("seasonal_strength", f"""
WITH {DECOMP_SQL}
SELECT series_id, {S.r('greatest(0, 1 - var_samp(resid_add) / var_samp(seasonal_add + resid_add))', 6)} AS strength_add,
       {S.r('greatest(0, 1 - var_samp(resid_mult) / var_samp(seasonal_mult * resid_mult))', 6)} AS strength_mult,
       {S.r('var_samp(resid_add)')} AS resid_var_add, {S.r('var_samp(resid_mult)', 6)} AS resid_var_mult
FROM dec GROUP BY series_id""")
def seasonal_strength(spark, sf_dir):
    """Seasonal strength 1 - Var(R)/Var(S+R) (additive) and 1 - Var(R)/Var(S*R)
    (multiplicative) with residual variances."""
    d = _decomp(spark, sf_dir)
    return d.groupBy("series_id").agg(
        rnd(F.greatest(F.lit(0.0), 1 - F.var_samp("resid_add") / F.var_samp(F.col("seasonal_add") + F.col("resid_add"))), 6).alias("strength_add"),
        rnd(F.greatest(F.lit(0.0), 1 - F.var_samp("resid_mult") / F.var_samp(F.col("seasonal_mult") * F.col("resid_mult"))), 6).alias("strength_mult"),
        rnd(F.var_samp("resid_add")).alias("resid_var_add"), rnd(F.var_samp("resid_mult"), 6).alias("resid_var_mult"))


@query("expanding_cv", f"""
WITH {S.SPLIT_CTES},
b AS (SELECT *, ntile(6) OVER (PARTITION BY series_id ORDER BY month) AS block FROM tr),
trn AS (SELECT series_id, y, x1, unnest(generate_series(block, 5)) AS fold FROM b WHERE block <= 5),
val AS (SELECT series_id, y, x1, block - 1 AS fold FROM b WHERE block >= 2),
cf AS (SELECT series_id, fold, regr_intercept(y, x1) AS a, regr_slope(y, x1) AS bb, regr_count(y, x1) AS n_train
       FROM trn GROUP BY ALL)
SELECT val.series_id, CAST(val.fold AS BIGINT) AS fold, cf.n_train, count(*) AS n_val,
       {S.r('sqrt(avg((cf.a + cf.bb * val.x1 - val.y) ^ 2))')} AS rmse
FROM val JOIN cf USING (series_id, fold) GROUP BY ALL""")
def expanding_cv(spark, sf_dir):
    """Expanding-window cross-validation with 5 folds over the training months:
    fold k trains on blocks 1..k and validates on block k+1 (rows are routed to
    their folds by a generator, then one group-by per fold)."""
    tr, _ = _split(spark, sf_dir)
    b = tr.withColumn("block", F.ntile(6).over(_wser()))
    trn = b.filter(F.col("block") <= 5).select("series_id", "y", "x1",
                                                F.explode(F.sequence(F.col("block"), F.lit(5))).alias("fold"))
    val = b.filter(F.col("block") >= 2).select("series_id", "y", "x1", (F.col("block") - 1).alias("fold"))
    cf = trn.groupBy("series_id", "fold").agg(F.regr_intercept("y", "x1").alias("a"), F.regr_slope("y", "x1").alias("bb"),
                                               F.regr_count("y", "x1").alias("n_train"))
    e = F.col("a") + F.col("bb") * F.col("x1") - F.col("y")
    return (val.join(cf, ["series_id", "fold"]).groupBy("series_id", F.col("fold").cast("long").alias("fold"), "n_train")
            .agg(F.count("*").alias("n_val"), rnd(F.sqrt(F.avg(e * e))).alias("rmse")))


@query("minmax_scale", f"""
WITH {S.PANEL_CTES},
m AS (SELECT series_id, month, y, min(y) OVER (PARTITION BY series_id) AS lo, max(y) OVER (PARTITION BY series_id) AS hi FROM panel)
SELECT series_id, {S.iso('month')} AS month,
       {S.r('CASE WHEN hi - lo > 0 THEN (y - lo) / (hi - lo) * 100 ELSE y * 0 END')} AS y_scaled FROM m""")
def minmax_scale(spark, sf_dir):
    """Min-max scaling to 0-100 per series; a constant series gives 0, NULL stays NULL."""
    p = monthly_panel(spark, sf_dir)
    ws = Window.partitionBy("series_id")
    lo, hi = F.min("y").over(ws), F.max("y").over(ws)
    scaled = F.when(hi - lo > 0, (F.col("y") - lo) / (hi - lo) * 100).otherwise(F.col("y") * 0)
    return p.select("series_id", iso_date("month").alias("month"), rnd(scaled).alias("y_scaled"))


@query("zscore", f"""
WITH {S.SPLIT_CTES},
sc AS (SELECT series_id, avg(x1) AS mu, stddev_pop(x1) AS sd FROM tr GROUP BY 1)
SELECT sp.series_id, {S.iso('month')} AS month, split, {S.r('(x1 - mu) / sd')} AS x1_z
FROM sp JOIN sc USING (series_id)""")
def zscore(spark, sf_dir):
    """Regressor standardised with population mean/sd from the training months only."""
    p = monthly_panel(spark, sf_dir).withColumn("split", split_label())
    sc = p.filter(F.col("split") == "train").groupBy("series_id").agg(F.avg("x1").alias("mu"), F.stddev_pop("x1").alias("sd"))
    return p.join(sc, "series_id").select("series_id", iso_date("month").alias("month"), "split",
                                          rnd((F.col("x1") - F.col("mu")) / F.col("sd")).alias("x1_z"))


# Label library of the consolidated columns (label, unit); columns
# without an entry fall back to their own name and an empty unit.
LABELS = [
    ("price_exaa_mean", "Day-ahead price feed A", "EUR/MWh"),
    ("price_mc_auction_mean", "Day-ahead price feed B", "EUR/MWh"),
    ("carbonprices_primary_market", "CO2 primary market", "EUR/t"),
    ("carbonprices_secondary_market", "CO2 secondary market", "EUR/t"),
    ("carbonprices_exchange_rate_eur_usd", "Exchange rate EUR/USD", ""),
    ("oegpi_month", "Gas price index (month)", "index"),
    ("econ_turnover_total", "Turnover total", "MEUR"),
    ("data_completeness", "Data completeness", "%"),
]


@query("label_lookup", f"""
WITH {S.consolidated_ctes()},
a AS (SELECT {', '.join(f'count({c}) AS {c}' for c in VALUE_COLS)} FROM consolidated),
cnt AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, {c} AS n_values FROM a" for c in VALUE_COLS)}),
lib AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{l}', '{u}')" for c, l, u in LABELS)}) t(col, label, unit))
SELECT cnt.col AS "column", coalesce(lib.label, cnt.col) AS label, coalesce(lib.unit, '') AS unit, n_values
FROM cnt LEFT JOIN lib USING (col)""")
def label_lookup(spark, sf_dir):
    """Readable label and unit for every consolidated column (small fixed library,
    broadcast left join; fallback to the column name / empty unit)."""
    c = consolidated_table(spark, sf_dir)
    cnt = Q.profile(c, VALUE_COLS, {"n_values": F.count}, cast="string")
    lib = spark.createDataFrame(LABELS, "column string, label string, unit string")
    j = cnt.join(F.broadcast(lib), "column", "left")
    return j.select("column", F.coalesce("label", "column").alias("label"), F.coalesce("unit", F.lit("")).alias("unit"),
                    "n_values")


def _resid(spark, sf_dir):
    """AR(1) residuals on the training months."""
    tr, _ = _split(spark, sf_dir)
    t = FC.with_lag1(tr).filter(F.col("y1").isNotNull())
    ac = FC.ar1_coefs(tr).select("series_id", "c", "phi")
    return t.join(ac, "series_id").select("series_id", "month", (F.col("y") - (F.col("c") + F.col("phi") * F.col("y1"))).alias("e"))


def _lb_sql(h):
    terms = " + ".join(f"s{k} * s{k} / (c0 * c0) / (n - {k})" for k in range(1, h + 1))
    return f"n * (n + 2) * ({terms})"


@query("ljung_box", f"""
WITH {S.RESID_CTES}, {_acf_sql('res', 'e', MAX_LAG, 'rac')},
q AS (SELECT series_id, n, CASE WHEN n > 12 THEN {_lb_sql(12)} END AS q12,
             CASE WHEN n > 24 THEN {_lb_sql(24)} END AS q24 FROM rac_a)
SELECT series_id, n, CAST(12 AS BIGINT) AS lag, {S.r('q12')} AS q, {S.r(S.chi2_sf_even_sql('q12', 12), 6)} AS p_value FROM q
UNION ALL SELECT series_id, n, 24, {S.r('q24')}, {S.r(S.chi2_sf_even_sql('q24', 24), 6)} FROM q""")
def ljung_box(spark, sf_dir):
    """Ljung-Box Q at lags 12 and 24 on AR(1) residuals; chi-square p-value in
    closed form for even degrees of freedom."""
    a = acf_op(_resid(spark, sf_dir), "e", MAX_LAG)
    q = {h: f"n * (n + 2) * sum(CASE WHEN lag <= {h} THEN acf * acf / (n - lag) END)" for h in (12, 24)}
    terms = a.groupBy("series_id", "n").agg(*[F.expr(q[h]).alias(f"q{h}") for h in (12, 24)])
    rows = ", ".join(f"named_struct('lag', CAST({h} AS BIGINT), 'q', q{h})" for h in (12, 24))
    x = terms.selectExpr("series_id", "n", f"inline(array({rows}))")
    x = x.withColumn("q", F.when(F.col("n") > F.col("lag"), F.col("q")))     # a shorter series has no such lag
    p = F.when(F.col("lag") == 12, chi2_sf_even("q", 12)).otherwise(chi2_sf_even("q", 24))
    return x.select("series_id", "n", "lag", rnd("q").alias("q"), rnd(p, 6).alias("p_value"))


@query("normality_jb", f"""
WITH {S.RESID_CTES},
mu AS (SELECT series_id, avg(e) AS m FROM res GROUP BY 1),
mo AS (SELECT series_id, count(*) AS n, avg((e - m) ^ 2) AS m2, avg((e - m) ^ 3) AS m3, avg((e - m) ^ 4) AS m4
       FROM res JOIN mu USING (series_id) GROUP BY 1),
rk AS (SELECT series_id, e, row_number() OVER (PARTITION BY series_id ORDER BY e) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM res),
sf AS (SELECT series_id, corr(e, {S.normal_quantile_sql('(i - 0.375) / (n + 0.25)')}) AS r FROM rk GROUP BY 1),
st AS (SELECT series_id, n, m3 / m2 ^ 1.5 AS skew, m4 / (m2 * m2) - 3 AS kurt FROM mo)
SELECT series_id, n, {S.r('skew', 6)} AS skewness, {S.r('kurt', 6)} AS excess_kurtosis,
       {S.r('n / 6.0 * (skew * skew + kurt * kurt / 4)')} AS jb, {S.r('exp(-(n / 6.0 * (skew * skew + kurt * kurt / 4)) / 2)', 6)} AS jb_p_value,
       {S.r('r * r', 6)} AS shapiro_francia_w
FROM st JOIN sf USING (series_id)""")
def normality_jb(spark, sf_dir):
    """Residual normality: Jarque-Bera (population skewness/kurtosis, chi2(2) p-value)
    and the Shapiro-Francia W' = corr(sorted residuals, normal scores)^2."""
    r = _resid(spark, sf_dir)
    mo = r.groupBy("series_id").agg(F.count("*").alias("n"), F.skewness("e").alias("skew"), F.kurtosis("e").alias("kurt"))
    ws = Window.partitionBy("series_id")
    rk = r.select("series_id", "e", F.row_number().over(Window.partitionBy("series_id").orderBy("e")).alias("i"),
                  F.count("*").over(ws).alias("n"))
    sf = rk.groupBy("series_id").agg(F.corr("e", normal_quantile("(i - 0.375) / (n + 0.25)")).alias("r"))
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4)
    return mo.join(sf, "series_id").select(
        "series_id", "n", rnd("skew", 6).alias("skewness"), rnd("kurt", 6).alias("excess_kurtosis"), rnd(jb).alias("jb"),
        rnd(F.exp(-jb / 2), 6).alias("jb_p_value"), rnd(F.col("r") ** 2, 6).alias("shapiro_francia_w"))


@query("qq_points", f"""
WITH {S.RESID_CTES},
rk AS (SELECT series_id, e, row_number() OVER (PARTITION BY series_id ORDER BY e) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM res)
SELECT series_id, CAST(i AS BIGINT) AS i, {S.r(S.normal_quantile_sql('(i - 0.5) / n'), 6)} AS theoretical, {S.r('e')} AS sample FROM rk""")
def qq_points(spark, sf_dir):
    """Q-Q points of the residuals: normal quantile of (i - 0.5)/n against the i-th smallest residual."""
    r = _resid(spark, sf_dir)
    rk = r.select("series_id", "e", F.row_number().over(Window.partitionBy("series_id").orderBy("e")).alias("i"),
                  F.count("*").over(Window.partitionBy("series_id")).alias("n"))
    return rk.select("series_id", F.col("i").cast("long").alias("i"),
                     rnd(normal_quantile("(i - 0.5) / n"), 6).alias("theoretical"), rnd("e").alias("sample"))


@query("adf_t", f"""
WITH {S.PANEL_CTES},
d AS (SELECT series_id, month, y - lag(y) OVER w AS dy, lag(y) OVER w AS y1 FROM panel WINDOW w AS (PARTITION BY series_id ORDER BY month)),
d2 AS (SELECT *, lag(dy) OVER (PARTITION BY series_id ORDER BY month) AS dy1 FROM d),
mo AS (SELECT series_id, count(*) AS n, var_pop(dy) AS vyy, var_pop(y1) AS s11, var_pop(dy1) AS s22, covar_pop(y1, dy1) AS s12,
              covar_pop(y1, dy) AS s1y, covar_pop(dy1, dy) AS s2y
       FROM d2 WHERE dy IS NOT NULL AND y1 IS NOT NULL AND dy1 IS NOT NULL GROUP BY 1),
g AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS gamma,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS delta FROM mo),
t AS (SELECT *, gamma / sqrt((n * (vyy - gamma * s1y - delta * s2y) / (n - 3)) * (s22 / det) / n) AS t_stat FROM g)
SELECT series_id, n, {S.r('gamma', 6)} AS gamma, {S.r('t_stat')} AS t_stat, t_stat < {ADF_CRIT_5PCT} AS reject_5pct FROM t""")
def adf_t(spark, sf_dir):
    """Augmented Dickey-Fuller (constant, one lagged difference): t-ratio of y_(t-1)
    against the tabulated 5 % critical value."""
    p = monthly_panel(spark, sf_dir)
    d = p.select("series_id", "month", (F.col("y") - F.lag("y").over(_wser())).alias("dy"), F.lag("y").over(_wser()).alias("y1"))
    d = d.withColumn("dy1", F.lag("dy").over(_wser()))
    sol = ols(d, ["series_id"], "dy", ["y1", "dy1"])
    t = F.col("t")[0]
    return sol.select("series_id", "n", rnd(F.col("coef")[0], 6).alias("gamma"), rnd(t).alias("t_stat"),
                      (t < ADF_CRIT_5PCT).alias("reject_5pct"))


def _kpss_sql():
    """Bartlett weights on every lag's autocovariance, by a join of each month with its predecessors."""
    return f"""{S.PANEL_CTES},
k0 AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY month) AS t,
              y - avg(y) OVER (PARTITION BY series_id) AS e FROM panel WHERE y IS NOT NULL),
k1 AS (SELECT *, sum(e) OVER (PARTITION BY series_id ORDER BY t) AS cs FROM k0),
k2 AS (SELECT series_id, count(*) AS n, sum(cs * cs) AS ss, sum(e * e) / count(*) AS g0,
              CAST(floor(4 * power(count(*) / 100.0, 0.25)) AS BIGINT) AS lags FROM k1 GROUP BY 1),
kg AS (SELECT a.series_id, sum(2 * (1 - (a.t - b.t) / (k2.lags + 1.0)) * a.e * b.e / k2.n) AS w
       FROM k1 a JOIN k2 ON k2.series_id = a.series_id
       JOIN k1 b ON b.series_id = a.series_id AND b.t < a.t AND b.t >= a.t - k2.lags GROUP BY 1),
k3 AS (SELECT k2.series_id, n, lags, ss / (n * n * (g0 + coalesce(w, 0))) AS stat FROM k2 LEFT JOIN kg USING (series_id))"""


@query("kpss_stat", f"""
WITH {_kpss_sql()}
SELECT series_id, n, lags, {S.r('stat', 6)} AS kpss_stat, stat > {KPSS_CRIT_5PCT} AS reject_5pct FROM k3""")
def kpss_stat(spark, sf_dir):
    """KPSS level-stationarity statistic: partial sums of deviations over a
    Bartlett long-run variance with l = floor(4 (n/100)^(1/4)) lags, however many."""
    return kpss(monthly_panel(spark, sf_dir)).select(
        "series_id", "n", "lags", rnd("stat", 6).alias("kpss_stat"), (F.col("stat") > KPSS_CRIT_5PCT).alias("reject_5pct"))


def kpss(panel):
    """(series_id, month, y) -> series_id, n, lags, stat. With partial sums cs (zero outside
    1..n-1) and L = lags + 1 the Bartlett variance is the mean over all windows of L months of
    (cs_t - cs_(t-L))^2 / L: one equi-join on the position instead of a column a lag."""
    w = "OVER (PARTITION BY series_id ORDER BY month"
    e = panel.where("y IS NOT NULL").selectExpr(
        "series_id", "month", "y - avg(y) OVER (PARTITION BY series_id) AS e", f"row_number() {w}) AS t",
        "count(1) OVER (PARTITION BY series_id) AS n")
    k = e.selectExpr("series_id", "t", "n", "CAST(floor(4 * power(n / 100.0, 0.25)) AS BIGINT) AS lags",
                     f"sum(e) {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs")
    back = k.selectExpr("series_id", "t + lags + 1 AS t", "cs AS before")
    j = k.join(back, ["series_id", "t"], "left")
    tail = F.when((F.col("t") > F.col("n") - F.col("lags") - 1) & (F.col("t") < F.col("n")), F.col("cs") ** 2)
    step = F.col("cs") - F.coalesce("before", F.lit(0.0))
    s = j.groupBy("series_id", "n", "lags").agg(F.sum(F.col("cs") ** 2).alias("ss"),
                                                (F.sum(step * step) + F.coalesce(F.sum(tail), F.lit(0.0))).alias("sw"))
    return s.selectExpr("series_id", "n", "lags", "ss / (n * n * (sw / (n * (lags + 1)))) AS stat")


@query("break_date_search", f"""
WITH {S.PANEL_CTES},
b AS (SELECT series_id, month, y, row_number() OVER w - 1 AS n1,
             coalesce(sum(y) OVER (PARTITION BY series_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s1,
             count(*) OVER (PARTITION BY series_id) AS n, sum(y) OVER (PARTITION BY series_id) AS s,
             var_pop(y) OVER (PARTITION BY series_id) * count(*) OVER (PARTITION BY series_id) AS sst
      FROM panel WHERE y IS NOT NULL WINDOW w AS (PARTITION BY series_id ORDER BY month)),
c AS (SELECT *, sst - (s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n) AS ssr FROM b
      WHERE n1 >= ceil(0.15 * n) AND n - n1 >= ceil(0.15 * n)),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ssr, month) = 1)
SELECT series_id, n, {S.iso('month')} AS break_month, {S.r('ssr')} AS ssr, {S.r('(sst - ssr) / (ssr / (n - 2))')} AS f_stat,
       {S.r('s1 / n1')} AS mean_before, {S.r('(s - s1) / (n - n1)')} AS mean_after FROM best""")
def break_date_search(spark, sf_dir):
    """Least-squares single break date of the level (trimmed 15 %): every month is a
    candidate, SSR from running sums (linear, no candidate x row expansion);
    the minimum-SSR month is the break, with its F statistic."""
    p = monthly_panel(spark, sf_dir).filter(F.col("y").isNotNull())
    ws = Window.partitionBy("series_id")
    b = p.select("series_id", "month", (F.row_number().over(_wser()) - 1).alias("n1"),
                 F.coalesce(F.sum("y").over(_wser().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("s1"),
                 F.count("*").over(ws).alias("n"), F.sum("y").over(ws).alias("s"),
                 (F.var_pop("y").over(ws) * F.count("*").over(ws)).alias("sst"))
    n, n1, s, s1 = F.col("n"), F.col("n1"), F.col("s"), F.col("s1")
    c = b.withColumn("ssr", F.col("sst") - (s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n)) \
        .filter((n1 >= F.ceil(0.15 * n)) & (n - n1 >= F.ceil(0.15 * n)))
    best = Q.first_k_by(c, ["series_id"], ["ssr", "month"], 1)
    return best.select("series_id", "n", iso_date("month").alias("break_month"), rnd("ssr").alias("ssr"),
                       rnd((F.col("sst") - F.col("ssr")) / (F.col("ssr") / (n - 2))).alias("f_stat"),
                       rnd(s1 / n1).alias("mean_before"), rnd((s - s1) / (n - n1)).alias("mean_after"))


ARMA = {"arma11": ["z1", "u1"], "arma21": ["z1", "z2", "u1"], "arma12": ["z1", "u1", "u2"],
        "arma22": ["z1", "z2", "u1", "u2"], "armax21": ["z1", "z2", "u1", "xx"], "armax31": ["z1", "z2", "z3", "u1", "xx"]}


def _hannan_rissanen(d, configs):
    """Two-stage fits of z (and regressor xx) per series; ``configs`` name lags z1.., innovations u1, u2 and xx."""
    lagged = d.select("series_id", "month", "z", "xx", *[F.lag("z", k).over(_wser()).alias(f"z{k}") for k in range(1, 7)])
    longar = ols(lagged, ["series_id"], "z", [f"z{k}" for k in range(1, 7)])
    co = longar.select("series_id", F.col("intercept").alias("c0"), *[F.col("coef")[k - 1].alias(f"a{k}") for k in range(1, 7)])
    fit = F.col("c0")
    for k in range(1, 7):
        fit = fit + F.col(f"a{k}") * F.col(f"z{k}")
    innov = lagged.join(co, "series_id").select("series_id", "month", "z", "z1", "z2", "z3", "xx", (F.col("z") - fit).alias("u"))
    innov = innov.withColumns({f"u{k}": F.lag("u", k).over(_wser()) for k in (1, 2)})
    sol, names = ols_by_config(innov, ["series_id"], "z", configs)
    co = {n: F.col("coef")[i] for i, n in enumerate(names)}       # slots follow the returned names
    slot = lambda n, out: co.get(n, F.lit(None).cast("double")).alias(out)
    return sol.select("series_id", "config", "n", "intercept", slot("z1", "ar1"), slot("z2", "ar2"), slot("u1", "ma1"),
                      "sigma2", "aic", slot("z3", "ar3"), slot("u2", "ma2"), slot("xx", "beta_x1"))


def _arma_sql():
    w = "OVER (PARTITION BY src, series_id ORDER BY month)"
    lags = [f"z{k}" for k in range(1, 7)]
    fit = " + ".join(["b0"] + [f"b{k} * z{k}" for k in range(1, 7)])
    long_rows = " AND ".join(f"{c} IS NOT NULL" for c in ["z", *lags])
    configs = [("level", n, cols) for n, cols in ARMA.items()]
    configs += [("diff", f"arima{p}11", ARMA[f"arma{p}1"]) for p in (1, 2)] + [("pre", f"pre_{c}", ARMA[c]) for c in ("arma11", "arma21", "arma12")]
    ctes, rows = [], []
    for src, name, cols in configs:
        k = len(cols) + 1
        full = " AND ".join(f"{c} IS NOT NULL" for c in ["z", *cols])
        ctes += [f"h_{name} AS (SELECT * FROM hu WHERE src = '{src}' AND {full})", S.eliminate_ctes(f"h_{name}", ["series_id"], ["1", *cols, "z"], name),
                 S.solve_cte(name, ["series_id"], k), f"n_{name} AS (SELECT series_id, count(*) AS n FROM h_{name} GROUP BY 1)"]
        at = {c: f"b{i + 1}" for i, c in enumerate(cols)}
        sel = ", ".join(f"{at.get(c, 'NULL::DOUBLE')} AS {out}" for c, out in
                        (("z1", "ar1"), ("z2", "ar2"), ("u1", "ma1"), ("z3", "ar3"), ("u2", "ma2"), ("xx", "beta_x1")))
        rows.append(f"SELECT series_id, '{name}' AS config, n, {len(cols)} AS k, b0, {sel}, ssr FROM {name}_b JOIN n_{name} USING (series_id)")
    out = ", ".join(f"{S.r(c)} AS {c}" for c in ("ar1", "ar2", "ma1", "ar3", "ma2", "beta_x1"))
    return f"""WITH {S.SPLIT_CTES},
h0 AS (SELECT 'level' AS src, series_id, month, y AS z, x1 AS xx FROM tr
       UNION ALL SELECT 'diff', series_id, month, y - lag(y) OVER (PARTITION BY series_id ORDER BY month), x1 FROM tr
       UNION ALL SELECT 'pre', series_id, month, y, x1 FROM tr WHERE month < DATE '{SHOCK}'),
hl AS (SELECT *, {', '.join(f'lag(z, {k}) {w} AS z{k}' for k in range(1, 7))} FROM h0),
hc AS (SELECT * FROM hl WHERE {long_rows}), {S.eliminate_ctes("hc", ["src", "series_id"], ["1", *lags, "z"], "ha")},
{S.solve_cte("ha", ["src", "series_id"], 7)},
hi AS (SELECT hl.*, z - ({fit}) AS u FROM hl JOIN ha_b USING (src, series_id)),
hu AS (SELECT *, lag(u, 1) {w} AS u1, lag(u, 2) {w} AS u2 FROM hi),
{', '.join(ctes)}, ho AS ({' UNION ALL '.join(rows)})
SELECT series_id, config, n, {S.r('b0')} AS intercept, {out}, {S.r('ssr / (n - k - 1)')} AS sigma2,
       {S.r('n * (ln(2 * pi() * ssr / n) + 1) + 2 * (k + 2)')} AS aic FROM ho"""


@query("arma_hannan_rissanen", _arma_sql())
def arma_hannan_rissanen(spark, sf_dir):
    """ARMA(p, q) and ARMAX(p, q) by Hannan-Rissanen: a long AR(6) gives innovation
    estimates, then y is regressed on its own lags, the lagged innovations and, in
    the ARMAX fits, x1 (least squares, an estimator choice; not a likelihood fit).
    arima111 and arima211 are fits of the differences; pre_ fits end before the shock."""
    tr, _ = _split(spark, sf_dir)
    level = tr.select("series_id", "month", F.col("y").alias("z"), F.col("x1").alias("xx"))
    diff = level.select("series_id", "month", (F.col("z") - F.lag("z").over(_wser())).alias("z"), "xx")
    fits = _hannan_rissanen(level, ARMA)
    fits = fits.unionByName(_hannan_rissanen(diff, {f"arima{p}11": ARMA[f"arma{p}1"] for p in (1, 2)}))
    fits = fits.unionByName(_hannan_rissanen(level.filter(F.col("month") < F.lit(SHOCK).cast("date")),
                                             {f"pre_{c}": ARMA[c] for c in ("arma11", "arma21", "arma12")}))
    return round_doubles(fits)
