"""Unit-root and stationarity tests per series, and over windows of each series.

A window's readings are one array (as long as the calendar has months, whatever
the raw volume); moments, elimination and lag choice are expressions on it, so a
test of any number of series is one group-by and one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import linear as L
from .series import first_k_by

# Response surface of the ADF t distribution with a constant (MacKinnon 1994):
# below the first, above the third limit the p-value is 0 or 1; polynomials apply up to and beyond the second.
ADF_LIMITS = (-18.83, -1.61, 2.74)
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# KPSS critical values for level stationarity, statistic -> p (Kwiatkowski et al. 1992).
KPSS_TABLE = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))
# 1, 5 and 10 % critical values of Zivot and Andrews (1992), by what breaks.
ZA_CRITICAL = {"level": (-5.34, -4.80, -4.58), "level_and_trend": (-5.57, -5.08, -4.82)}
TRIM = 0.15


def normal_cdf_sql(z: str) -> str:
    """P(Z <= z) by Abramowitz-Stegun 26.2.17, with absolute error below 7.5e-8 (valid in both engines)."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
    tail = f"(exp(-({z}) * ({z}) / 2) / 2.5066282746310002 * {poly})"
    return f"(CASE WHEN {z} >= 0 THEN 1 - {tail} ELSE {tail} END)"


def adf_p_sql(t: str) -> str:
    """p-value of an ADF t-ratio with a constant."""
    def poly(c: Sequence[float]) -> str:
        return "(" + " + ".join(f"({v!r}) * " + " * ".join([f"({t})"] * i) if i else f"({v!r})" for i, v in enumerate(c)) + ")"
    low, mid, high = ADF_LIMITS
    return (f"CASE WHEN {t} IS NULL THEN NULL WHEN {t} < {low} THEN 0.0 WHEN {t} > {high} THEN 1.0 "
            f"WHEN {t} <= {mid} THEN {normal_cdf_sql(poly(ADF_SMALL))} ELSE {normal_cdf_sql(poly(ADF_LARGE))} END")


def kpss_p_sql(stat: str) -> str:
    """p-value by interpolation in the table; outside it the table's end."""
    cases = "".join(f" WHEN {stat} <= {b} THEN {p!r} + ({stat} - {a!r}) * ({q!r} - {p!r}) / ({b!r} - {a!r})"
                    for (a, p), (b, q) in zip(KPSS_TABLE, KPSS_TABLE[1:]))
    return (f"CASE WHEN {stat} IS NULL THEN NULL WHEN {stat} <= {KPSS_TABLE[0][0]} THEN {KPSS_TABLE[0][1]}{cases} "
            f"ELSE {KPSS_TABLE[-1][1]} END")


def in_windows(df: DataFrame, windows: Mapping[str, Column | None], order: str = "month") -> DataFrame:
    """Rows once for each window (name -> condition, None for all rows) that they lie in, as column ``window``."""
    names = F.array(*[F.lit(n) if c is None else F.when(c, F.lit(n)) for n, c in windows.items()])
    return df.select("*", F.explode(F.filter(names, lambda n: n.isNotNull())).alias("window"))


def _schwert(n: str) -> str:
    """Largest lag tried: ceil(12 (n / 100)^(1/4)), at most what leaves as many rows as coefficients."""
    return f"CAST(greatest(0, least(ceil(12 * power({n} / 100.0, 0.25)), floor({n} / 2) - 2)) AS INT)"


def adf(df: DataFrame, y: str, keys: Sequence[str], order: str = "month") -> DataFrame:
    """Augmented Dickey-Fuller with a constant: (*keys, n, max_lag, lag, n_obs, t_stat, p_value).

    One moment matrix on the rows that the largest lag leaves gives the AIC of every
    lag, as the fits are nested (its leading blocks); the chosen lag (ties: the
    smaller) is fitted again on all rows that it leaves. Null values are left out
    first, so lags count readings. A series that is constant or too short keeps its
    row with null statistics."""
    s = (df.filter(F.col(y).isNotNull()).groupBy(*keys)
         .agg(F.expr(f"transform(sort_array(collect_list(struct({order} AS o, CAST({y} AS DOUBLE) AS v))), r -> r.v)").alias("raw")))
    s = s.selectExpr(*keys, "size(raw) AS n", "raw")
    mean = "aggregate(raw, 0D, (a, v) -> a + v) / size(raw)"
    s = s.selectExpr(*keys, "n", f"{_schwert('n')} AS max_lag", L.let("mu", mean, "transform(raw, v -> v - mu)") + " AS ys")
    s = s.selectExpr(*keys, "n", "max_lag", "ys", "transform(ys, (v, i) -> IF(i > 0, v - ys[i - 1], 0D)) AS dy")

    def lags(m: str) -> str:
        return f"transform({L.numbers('1', m)}, j -> dy[t - j])"

    def moments(rows_from: str, vector: str, size: str) -> str:
        """Sum of r_t r_t' over t (0-based places in the series) from ``rows_from`` on."""
        return f"aggregate({L.numbers(rows_from, 'n - 1')}, {L.zeros(size)}, (g_, t) -> {L.let('r', vector, L.plus_outer('g_', 'r'))})"
    wide = f"concat(array(1D, ys[t - 1]), {lags('max_lag')}, array(dy[t]))"
    s = s.selectExpr(*keys, "n", "max_lag", "ys", "dy", f"{moments('max_lag + 1', wide, 'max_lag + 3')} AS g")
    s = s.selectExpr(*keys, "n", "max_lag", "ys", "dy", "g", f"{L.eliminated('g', '(max_lag + 2)')} AS u")
    ssr = L.nested_ssr("g", "u", "(max_lag + 2)")               # fits on 0, 1, ... columns; lag p needs p + 2
    aic = "transform(slice(ssr, 3, max_lag + 1), (v, i) -> IF(v > 0, (n - 1 - max_lag) * ln(v / (n - 1 - max_lag)) + 2 * (i + 2), NULL))"
    s = s.selectExpr(*keys, "n", "max_lag", "ys", "dy", f"IF(n - 1 - max_lag > 0, {ssr}, NULL) AS ssr")
    s = s.selectExpr(*keys, "n", "max_lag", "ys", "dy", f"{aic} AS aic")
    s = s.selectExpr(*keys, "n", "max_lag", "ys", "dy", "CAST(array_position(aic, array_min(aic)) - 1 AS INT) AS lag")
    own = f"concat(array(1D), {lags('coalesce(lag, 0)')}, array(ys[t - 1], dy[t]))"
    s = s.selectExpr(*keys, "n", "max_lag", "lag", "n - 1 - lag AS n_obs",
                     f"{moments('coalesce(lag, 0) + 1', own, 'coalesce(lag, 0) + 3')} AS g")
    s = s.selectExpr(*keys, "n", "max_lag", "lag", "n_obs", "g", f"{L.eliminated('g', '(coalesce(lag, 0) + 2)')} AS u")
    s = s.selectExpr(*keys, "n", "max_lag", "lag", "n_obs", f"{L.last_t('g', 'u', '(coalesce(lag, 0) + 2)', 'n_obs')} AS t_stat")
    return s.selectExpr(*keys, "n", "max_lag", "lag", "n_obs", "t_stat", f"{adf_p_sql('t_stat')} AS p_value")


def zivot_andrews(df: DataFrame, y: str, key: str = "series_id", order: str = "month", breaks: str = "level",
                  lags: int = 1) -> DataFrame:
    """Zivot-Andrews t of every candidate break date: (key, order, n, t_stat).

    dy ~ 1, trend, DU (and DT for ``level_and_trend``), ``lags`` lagged differences,
    y(t-1), for each date between the first and last ``TRIM`` share of the rows as
    the last one before the break. The part without break columns is the same for
    all dates; what a break column has in common with the others is a sum over the
    rows after the date, so running sums over each series, from its end, give every
    date's normal equations: linear in months, no date x row expansion. A date whose
    break column depends on the others has a null t."""
    w = Window.partitionBy(key).orderBy(order)
    whole = Window.partitionBy(key)
    d = df.filter(F.col(y).isNotNull()).select(key, order, F.col(y).cast("double").alias("v"))
    d = d.select(key, order, (F.col("v") - F.avg("v").over(whole)).alias("v"))
    d = d.select(key, order, F.lag("v").over(w).alias("level"), (F.col("v") - F.lag("v").over(w)).alias("dy"))
    d = d.select("*", *[F.lag("dy", j).over(w).alias(f"dy{j}") for j in range(1, lags + 1)])
    d = d.dropna(subset=["dy", *[f"dy{j}" for j in range(1, lags + 1)]])
    d = d.select("*", F.count("*").over(whole).alias("n"), F.row_number().over(w).alias("t"))
    d = d.withColumn("tc", F.col("t") - (F.col("n") + 1) / 2)
    plain = ["1D", "tc", *[f"dy{j}" for j in range(1, lags + 1)], "level", "dy"]
    own = f"OVER (PARTITION BY {key})"
    tail = f"OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    cells = {f"b{i}_{j}": f"sum({plain[i]} * {plain[j]}) {own}" for i in range(len(plain)) for j in range(i, len(plain))}
    cells |= {f"s{i}": f"coalesce(sum({plain[i]}) {tail}, 0D)" for i in range(len(plain))}
    cells |= {f"q{i}": f"coalesce(sum(t * {plain[i]}) {tail}, 0D)" for i in range(len(plain))}
    cells |= {"tt": f"coalesce(sum(CAST(t AS DOUBLE) * t) {tail}, 0D)", "ts": f"coalesce(sum(CAST(t AS DOUBLE)) {tail}, 0D)"}
    d = d.selectExpr(key, order, "n", "t", *[f"{e} AS {c}" for c, e in cells.items()])
    d = d.filter((F.col("t") >= F.ceil(F.lit(TRIM) * F.col("n"))) & (F.col("n") - F.col("t") >= F.ceil(F.lit(TRIM) * F.col("n"))))

    def base(i: int, j: int) -> str:
        return f"b{min(i, j)}_{max(i, j)}"
    # columns: 1, tc, DU (DT), lagged differences, level | dy; DT = (row number - t) after the date
    places: list = [0, 1, "DU", *(["DT"] if breaks == "level_and_trend" else []), *range(2, len(plain))]

    def cell(a, b) -> str:
        if isinstance(a, int) and isinstance(b, int):
            return base(a, b)
        if isinstance(a, int):
            a, b = b, a
        if isinstance(b, int):
            return f"s{b}" if a == "DU" else f"(q{b} - t * s{b})"
        if a == b == "DU":
            return "s0"
        return "(tt - 2 * t * ts + t * t * s0)" if a == b else "(ts - t * s0)"
    g = "array(" + ", ".join("array(" + ", ".join(cell(a, b) for b in places) + ")" for a in places) + ")"
    k = str(len(places) - 1)
    d = d.selectExpr(key, order, "n", f"{g} AS g").selectExpr(key, order, "n", "g", f"{L.eliminated('g', k)} AS u")
    return d.selectExpr(key, order, "n", f"{L.last_t('g', 'u', k, 'n')} AS t_stat")


def break_by_unit_root(df: DataFrame, y: str, key: str = "series_id", order: str = "month", breaks: str = "level",
                       lags: int = 1) -> DataFrame:
    """The date with the least t of each series (ties: the earlier) with critical values: (key, n, date, t_stat, reject_1/5/10pct).

    A series too short for any date is not in the result."""
    dates = zivot_andrews(df, y, key, order, breaks, lags).filter(F.col("t_stat").isNotNull())
    best = first_k_by(dates, [key], ["t_stat", order], 1)
    return best.select(key, "n", F.col(order).alias("break_date"), "t_stat",
                       *[(F.col("t_stat") < c).alias(f"reject_{p}pct") for c, p in zip(ZA_CRITICAL[breaks], (1, 5, 10))])
