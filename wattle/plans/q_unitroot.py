"""Stationarity by regime and break dates by the unit-root statistic."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import sqlparts as S
from .panel import monthly_panel
from .q_models import POST, SHOCK
from .q_series import kpss
from .registry import query
from ..functions.numeric import iso_date, rnd
from ..operators import unitroot as U

SQL_LAGS = 12       # enough for series of up to 100 months (the panel has 80); the operator has no such limit


def _windows():
    m = F.col("month")
    return {"full": None, "pre_shock": m < F.lit(SHOCK).cast("date"), "post_shock": m >= F.lit(POST).cast("date")}


WINDOW_CTE = f"""
wd AS (SELECT 'full' AS win, series_id, month, y FROM panel WHERE y IS NOT NULL
       UNION ALL SELECT 'pre_shock', series_id, month, y FROM panel WHERE y IS NOT NULL AND month < DATE '{SHOCK}'
       UNION ALL SELECT 'post_shock', series_id, month, y FROM panel WHERE y IS NOT NULL AND month >= DATE '{POST}')"""


def _adf_sql() -> str:
    """Every lag's fit on the common rows, then the chosen one again: lags beyond a fit's own are zero columns,
    which the elimination passes over."""
    lag = [f"d{j}" for j in range(1, SQL_LAGS + 1)]
    w = "OVER (PARTITION BY win, series_id ORDER BY month)"
    head = f"""{WINDOW_CTE},
w1 AS (SELECT *, count(*) OVER (PARTITION BY win, series_id) AS n, row_number() {w} - 1 AS t, y - lag(y) {w} AS dy,
              lag(y - avg_y) {w} AS lev FROM (SELECT *, avg(y) OVER (PARTITION BY win, series_id) AS avg_y FROM wd)),
w2 AS (SELECT *, CAST(greatest(0, least(ceil(12 * power(n / 100.0, 0.25)), n // 2 - 2)) AS BIGINT) AS pm,
              {', '.join(f'lag(dy, {j}) {w} AS d{j}' for j in range(1, SQL_LAGS + 1))} FROM w1),
ca AS (SELECT win, series_id, n, pm, p.p, dy, lev, {', '.join(f'CASE WHEN p.p >= {j} THEN d{j} ELSE 0 END AS d{j}' for j in range(1, SQL_LAGS + 1))}
       FROM w2 JOIN (SELECT unnest(range(0, {SQL_LAGS + 1})) AS p) p ON p.p <= pm WHERE t > pm)"""
    first = S.eliminate_ctes("ca", ["win", "series_id", "n", "pm", "p"], ["1", "lev", *lag, "dy"], "a")
    k = len(lag) + 2
    pick = f"""
pk AS (SELECT win, series_id, arg_min(p, (m * ln(ssr / m) + 2 * (p + 2), p)) AS p
       FROM (SELECT *, n - 1 - pm AS m, g{k}_{k} AS ssr FROM a_u) WHERE ssr > 0 GROUP BY ALL),
cb AS (SELECT w2.win, w2.series_id, n, pm, pk.p, dy, lev, {', '.join(f'CASE WHEN pk.p >= {j} THEN d{j} ELSE 0 END AS d{j}' for j in range(1, SQL_LAGS + 1))}
       FROM w2 JOIN pk USING (win, series_id) WHERE t > pk.p)"""
    second = S.eliminate_ctes("cb", ["win", "series_id", "n", "pm", "p"], ["1", *lag, "lev", "dy"], "b")
    t = f"g{k - 1}_{k} / sqrt(g{k - 1}_{k - 1}) / sqrt(g{k}_{k} / (n - 1 - p - (p + 2)))"
    return f"""WITH {S.PANEL_CTES}, {head}, {first}, {pick}, {second},
ts AS (SELECT *, {t} AS t_stat FROM b_u), ns AS (SELECT win, series_id, any_value(n) AS n, any_value(pm) AS pm FROM w2 GROUP BY ALL)
SELECT ns.series_id, ns.win AS window_name, CAST(ns.n AS INTEGER) AS n, CAST(ns.pm AS INTEGER) AS max_lag, CAST(ts.p AS INTEGER) AS lag,
       CAST(ns.n - 1 - ts.p AS INTEGER) AS n_obs, {S.r('t_stat')} AS t_stat, {S.r(U.adf_p_sql('t_stat'))} AS p_value,
       {U.adf_p_sql('t_stat')} < 0.05 AS reject_5pct
FROM ns LEFT JOIN ts USING (win, series_id)"""


@query("adf_windows", _adf_sql())
def adf_windows(spark, sf_dir):
    """Augmented Dickey-Fuller over the full series and before and after the shock: lag by AIC from
    nested fits of one moment matrix, p-value from the response surface."""
    got = U.adf(U.in_windows(monthly_panel(spark, sf_dir), _windows()), "y", ["series_id", "window"])
    return got.select("series_id", F.col("window").alias("window_name"), "n", "max_lag", "lag", "n_obs", rnd("t_stat").alias("t_stat"),
                      rnd("p_value").alias("p_value"), (F.col("p_value") < 0.05).alias("reject_5pct"))


@query("kpss_windows", f"""
WITH {S.PANEL_CTES}, {WINDOW_CTE},
k0 AS (SELECT win, series_id, row_number() OVER (PARTITION BY win, series_id ORDER BY month) AS t,
              y - avg(y) OVER (PARTITION BY win, series_id) AS e FROM wd),
k1 AS (SELECT *, sum(e) OVER (PARTITION BY win, series_id ORDER BY t) AS cs FROM k0),
k2 AS (SELECT win, series_id, count(*) AS n, sum(cs * cs) AS ss, sum(e * e) / count(*) AS g0,
              CAST(floor(4 * power(count(*) / 100.0, 0.25)) AS BIGINT) AS lags FROM k1 GROUP BY ALL),
kg AS (SELECT a.win, a.series_id, sum(2 * (1 - (a.t - b.t) / (k2.lags + 1.0)) * a.e * b.e / k2.n) AS w
       FROM k1 a JOIN k2 USING (win, series_id) JOIN k1 b ON b.win = a.win AND b.series_id = a.series_id AND b.t < a.t AND b.t >= a.t - k2.lags
       GROUP BY ALL),
k3 AS (SELECT k2.win, k2.series_id, n, lags, ss / (n * n * (g0 + coalesce(w, 0))) AS stat FROM k2 LEFT JOIN kg USING (win, series_id))
SELECT series_id, win AS window_name, n, lags, {S.r('stat', 6)} AS kpss_stat, {S.r(U.kpss_p_sql('stat'))} AS p_value FROM k3""")
def kpss_windows(spark, sf_dir):
    """KPSS level stationarity over the same windows, p-value interpolated in the published table."""
    rows = U.in_windows(monthly_panel(spark, sf_dir), _windows())
    each = rows.select(F.struct("series_id", "window").alias("series_id"), "month", "y")
    got = kpss(each)
    return got.select("series_id.series_id", F.col("series_id.window").alias("window_name"), "n", "lags",
                      rnd("stat", 6).alias("kpss_stat"), rnd(F.expr(U.kpss_p_sql("stat"))).alias("p_value"))


def _za_sql() -> str:
    """Every date by sums over its own rows (date x row join), independent of the running sums."""
    out = []
    for name in U.ZA_CRITICAL:
        cols = ["1", "tc", "du", *(["dt"] if name == "level_and_trend" else []), "d1", "lev", "dy"]
        k = len(cols) - 1
        t = f"g{k - 1}_{k} / sqrt(g{k - 1}_{k - 1}) / sqrt(g{k}_{k} / (n - {k}))"
        c1, c5, c10 = U.ZA_CRITICAL[name]
        out.append((S.eliminate_ctes("zc", ["series_id", "n", "tb", "month"], cols, f"z_{name}"), f"""
SELECT series_id, '{name}' AS breaks, n, {S.iso('month')} AS break_date, {S.r('t_stat')} AS t_stat, t_stat < {c1} AS reject_1pct,
       t_stat < {c5} AS reject_5pct, t_stat < {c10} AS reject_10pct FROM (SELECT *, {t} AS t_stat FROM z_{name}_u)
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY t_stat, month) = 1"""))
    w = "OVER (PARTITION BY series_id ORDER BY month)"
    return f"""WITH {S.PANEL_CTES},
z0 AS (SELECT series_id, month, y - avg(y) OVER (PARTITION BY series_id) AS v FROM panel WHERE y IS NOT NULL),
z1 AS (SELECT *, lag(v) {w} AS lev, v - lag(v) {w} AS dy FROM z0),
z2 AS (SELECT *, lag(dy) {w} AS d1 FROM z1),
z3 AS (SELECT *, row_number() {w} AS t, count(*) OVER (PARTITION BY series_id) AS n FROM z2 WHERE d1 IS NOT NULL),
zc AS (SELECT a.series_id, a.n, b.t AS tb, b.month, a.t - (a.n + 1) / 2.0 AS tc, CASE WHEN a.t > b.t THEN 1 ELSE 0 END AS du,
              CASE WHEN a.t > b.t THEN a.t - b.t ELSE 0 END AS dt, a.d1, a.lev, a.dy
       FROM z3 a JOIN z3 b USING (series_id) WHERE b.t >= ceil({U.TRIM} * b.n) AND b.n - b.t >= ceil({U.TRIM} * b.n)),
{', '.join(c for c, _ in out)}
{' UNION ALL '.join(f'SELECT * FROM ({s})' for _, s in out)}"""


@query("zivot_andrews", _za_sql())
def zivot_andrews(spark, sf_dir):
    """Break date of each series by the least unit-root t over all dates, for a break of the level and of level and trend."""
    panel = monthly_panel(spark, sf_dir)
    parts = [U.break_by_unit_root(panel, "y", breaks=b).withColumn("breaks", F.lit(b)) for b in U.ZA_CRITICAL]
    both = parts[0].unionByName(parts[1])
    return both.select("series_id", "breaks", "n", iso_date("break_date").alias("break_date"), rnd("t_stat").alias("t_stat"),
                       "reject_1pct", "reject_5pct", "reject_10pct")
