"""ARMA, ARIMA and ARMAX fits and forecasts as expressions on one array a series.

A series is an array of at most as many values as the calendar has months, so the
recursions of models with MA terms (each residual needs the one before) are folds
over that array. Starting values are Hannan-Rissanen's; conditional sums of squares
are then minimised by damped Gauss-Newton steps: one fold gives residuals, their
derivatives and the moment matrix, a small elimination the step, and a step that
does not lower the sum raises the damping. The whole search is one expression, so
any number of (series, window, order) rows is fitted side by side in the JVM,
without a solver in Python and without a loop on the driver.

Coefficients are ``[constant, ar1..arP, ma1..maQ, beta]``; an order uses some of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import linear as L

P, Q = 4, 2
K = 1 + P + Q + 1
LONG = 6                    # order of the long autoregression that gives the first innovations
LEAST = LONG + Q + K + 2    # values that a fit needs
STEPS = 100
ENOUGH = 1e-13            # relative fall of the sum of squares at which the search ends
SLOTS = ["c", *[f"ar{i}" for i in range(1, P + 1)], *[f"ma{i}" for i in range(1, Q + 1)], "beta"]


def _uses(p: int, q: int, x: bool) -> list[float]:
    return [1.0, *[float(i < p) for i in range(P)], *[float(i < q) for i in range(Q)], float(x)]


def orders_table(orders: Mapping[str, tuple[int, int, int, bool]]) -> Column:
    """Array of order structs for ``explode``: name -> (p, d, q, with regressor)."""
    for name, (p, d, q, _) in orders.items():
        if not (0 <= p <= P and d in (0, 1) and 0 <= q <= Q):
            raise ValueError(f"{name}: orders up to ({P}, 1, {Q}) are fitted")
    return F.array(*[F.struct(F.lit(n).alias("config"), F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q"),
                              F.lit(bool(x)).alias("with_x"), F.array(*map(F.lit, _uses(p, q, x))).alias("uses"))
                     for n, (p, d, q, x) in orders.items()])


def _masked(vector: str) -> str:
    return f"zip_with({vector}, uses, (x_, y_) -> IF(y_ > 0, x_ * y_, 0D))"


def _lags(values: str, n: int) -> str:
    return "array(" + ", ".join(f"IF(t >= {i}, {values}[t - {i}], 0D)" for i in range(1, n + 1)) + ")"


def _moments(first: str, vector: str, size: int) -> str:
    return (f"aggregate({L.numbers(first, 'size(zs) - 1')}, {L.zeros(str(size))}, "
            f"(g_, t) -> {L.let('r', vector, L.plus_outer('g_', 'r'))})")


def _solved(df: DataFrame, moments: str, k: int, out: str) -> DataFrame:
    """Least squares coefficients ``out`` from the moment matrix ``moments``."""
    df = df.selectExpr("*", f"{moments} AS g__").selectExpr("*", f"{L.eliminated('g__', str(k))} AS u__")
    return df.selectExpr("*", f"IF(g__ IS NULL, NULL, {L.solution('g__', 'u__', str(k))}) AS {out}").drop("g__", "u__")


def _fold(b: str) -> str:
    """State after the last value for coefficients ``b``: residuals and derivatives of the last Q
    values (latest first) and the moments of (derivatives, -residual)."""
    u = _masked(f"concat(array(1D), {_lags('zs', P)}, st.e, array(xs[t]))")
    ma = f"slice({b}, {P + 2}, {Q})"
    derivative = f"transform(u, (uv, ui) -> -uv - {L.dot(ma, 'transform(st.d, dr -> dr[ui])')})"
    grown = L.plus_outer("st.g", "concat(dv, array(-e))")
    body = (f"named_struct('e', concat(array(e), slice(st.e, 1, {Q - 1})), 'd', concat(array(dv), slice(st.d, 1, {Q - 1})), 'g', {grown})")
    step = L.let("u", u, L.let("e", f"zs[t] - {L.dot(b, 'u')}", L.let("dv", derivative, body)))
    start = (f"named_struct('e', array_repeat(0D, {Q}), 'd', array_repeat(array_repeat(0D, {K}), {Q}), 'g', {L.zeros(str(K + 1))})")
    return f"aggregate({L.numbers('p', 'size(zs) - 1')}, {start}, (st, t) -> {step})"


def _invertible(b: str) -> str:
    """Do the MA coefficients give residuals that forget their start (Q = 2)?"""
    a, c = f"{b}[{P + 1}]", f"{b}[{P + 2}]"
    return f"(abs({c}) < 1 AND {c} + {a} > -1 AND {c} - {a} > -1)"


def _search() -> str:
    """Damped Gauss-Newton from ``start`` (its MA part zero if that is not invertible); the state holds coefficients,
    damping, fold and whether it has converged. Steps out of the invertible region are refused like steps uphill."""
    damped = f"transform(o.f.g, (gr, gi) -> transform(gr, (gv, gj) -> IF(gi = gj AND gi < {K}, gv * (1 + o.lam), gv)))"
    step = L.let("h", damped, L.let("w", L.eliminated("h", str(K)), L.solution("h", "w", str(K))))
    sse, new = f"o.f.g[{K}][{K}]", f"nf.g[{K}][{K}]"
    better = f"named_struct('b', nb, 'lam', o.lam / 10, 'f', nf, 'converged', {sse} - {new} <= {ENOUGH} * {sse}, 'steps', it)"
    worse = "named_struct('b', o.b, 'lam', o.lam * 10, 'f', o.f, 'converged', o.lam > 1e8, 'steps', it)"
    move = L.let("nb", f"zip_with(o.b, {step}, (b1, s1) -> b1 + s1)",
                 f"IF({_invertible('nb')}, {L.let('nf', _fold('nb'), f'IF({new} <= {sse}, {better}, {worse})')}, {worse})")
    kept = f"IF({_invertible('start')}, start, transform(start, (v1, i1) -> IF(i1 BETWEEN {P + 1} AND {P + Q}, 0D, v1)))"
    first = L.let("fb", kept, f"named_struct('b', fb, 'lam', 1e-3D, 'f', {_fold('fb')}, 'converged', false, 'steps', 0)")
    return f"aggregate(sequence(1, {STEPS}), {first}, (o, it) -> IF(o.converged, o, {move}))"


def series_arrays(df: DataFrame, keys: Sequence[str], y: str, x: str, orders, order: str = "month") -> DataFrame:
    """One row a (series, order): zs (differenced where d = 1), xs, last level, order fields.

    Values without y are left out; where an order uses the regressor also those without x."""
    s = (df.filter(F.col(y).isNotNull()).groupBy(*keys)
         .agg(F.expr(f"sort_array(collect_list(struct({order} AS o, CAST({y} AS DOUBLE) AS y, CAST({x} AS DOUBLE) AS x)))").alias("rows")))
    s = s.select(*keys, "rows", F.explode(orders_table(orders)).alias("m")).select(*keys, "m.*", "rows")
    s = s.selectExpr(*keys, "config", "p", "d", "q", "with_x", "uses", "IF(with_x, filter(rows, r -> r.x IS NOT NULL), rows) AS rows")
    s = s.selectExpr(*keys, "config", "p", "d", "q", "with_x", "uses", "element_at(rows, -1).y AS last_y",
                     "IF(d = 1, transform(slice(rows, 2, size(rows)), (r, i) -> r.y - rows[i].y), rows.y) AS zs",
                     "IF(with_x, IF(d = 1, transform(slice(rows, 2, size(rows)), (r, i) -> r.x - rows[i].x), rows.x), "
                     "transform(IF(d = 1, slice(rows, 2, size(rows)), rows), r -> 0D)) AS xs")
    return s


def hannan_rissanen(s: DataFrame) -> DataFrame:
    """``series_arrays`` rows with ``start``: the two-stage least squares estimate (null for short series)."""
    long_ar = f"concat(array(1D), {_lags('zs', LONG)}, array(zs[t]))"
    s = _solved(s, f"IF(size(zs) >= {LEAST}, {_moments(str(LONG), long_ar, LONG + 2)}, NULL)", LONG + 1, "long_b")
    fitted = L.dot("long_b", "concat(array(1D), " + _lags("zs", LONG) + ")")
    s = s.selectExpr("*", f"transform(zs, (v, t) -> IF(t >= {LONG}, v - {fitted}, 0D)) AS us").drop("long_b")
    regressors = _masked(f"concat(array(1D), {_lags('zs', P)}, {_lags('us', Q)}, array(xs[t]))")
    own = f"concat({regressors}, array(zs[t]))"
    return _solved(s, f"IF(size(zs) >= {LEAST}, {_moments(f'{LONG} + q', own, K + 1)}, NULL)", K, "start").drop("us")


def fit(df: DataFrame, keys: Sequence[str], y: str, x: str, orders: Mapping[str, tuple[int, int, int, bool]],
        order: str = "month") -> DataFrame:
    """Fits of every order: the rows of ``series_arrays`` with ``start`` (Hannan-Rissanen) and ``css``
    (b, f: final fold, steps, converged), ``sse``, ``n_fit``, ``sigma2``, ``aic``.

    A series with fewer than ``LEAST`` values keeps its rows with null estimates; columns that depend
    on others (a constant series, a constant regressor) have the coefficient zero. Fits are spread over
    tasks by series and order, as the search, not the data, is what takes time."""
    spark = df.sparkSession
    s = series_arrays(df, keys, y, x, orders, order)
    s = s.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "config")
    s = hannan_rissanen(s).selectExpr("*", f"IF(start IS NULL, NULL, {_search()}) AS css")
    s = s.selectExpr("*", f"css.f.g[{K}][{K}] AS sse", "IF(css IS NULL, NULL, size(zs) - p) AS n_fit")
    used = "CAST(aggregate(uses, 0D, (a, v) -> a + v) AS INT)"
    return s.selectExpr("*", "sse / n_fit AS sigma2",
                        f"CASE WHEN sse > 0 THEN n_fit * (ln(2 * pi() * sse / n_fit) + 1) + 2 * ({used} + 1) END AS aic")


def forecast(fits: DataFrame, future: DataFrame, keys: Sequence[str], series_key: str, y: str, x: str, order: str = "month") -> DataFrame:
    """Forecasts of both estimates over the rows of ``future``: (*keys, config, estimator, order, actual, forecast).

    Innovations start from the fit's last residuals and are zero over the horizon; differenced orders are
    summed up from the last level. A month without the regressor ends an ARMAX path (null from there on)."""
    steps = (future.groupBy(series_key).agg(F.expr(
        f"sort_array(collect_list(struct({order} AS o, CAST({y} AS DOUBLE) AS y, CAST({x} AS DOUBLE) AS x)))").alias("steps")))
    j = fits.join(steps, series_key)
    j = j.selectExpr(*keys, "config", "p", "d", "with_x", "uses", "zs", "xs", "last_y", "steps",
                     f"IF(start IS NULL, array(), array(named_struct('estimator', 'hannan_rissanen', 'b', start, 'e', {_fold('start')}.e), "
                     "named_struct('estimator', 'css', 'b', css.b, 'e', css.f.e))) AS ways")
    j = j.select("*", F.explode("ways").alias("way")).drop("ways")
    xh = "IF(with_x, IF(d = 1, steps[h].x - IF(h > 0, steps[h - 1].x, NULL), steps[h].x), 0D)"
    value = L.dot("way.b", f"zip_with(concat(array(1D), fs.z, fs.e, array({xh})), uses, (x_, y_) -> IF(y_ > 0, x_ * y_, 0D))")
    grown = (f"named_struct('z', concat(array(zh), slice(fs.z, 1, {P - 1})), 'e', concat(array(0D), slice(fs.e, 1, {Q - 1})), "
             "'path', concat(fs.path, array(zh)))")
    first = ("named_struct('z', array(" + ", ".join(f"element_at(zs, -{i})" for i in range(1, P + 1)) + "), 'e', way.e, "
             "'path', CAST(array() AS ARRAY<DOUBLE>))")
    j = j.selectExpr(*keys, "config", "d", "last_y", "steps", "way.estimator",
                     f"aggregate(sequence(0, size(steps) - 1), {first}, (fs, h) -> {L.let('zh', value, grown)}).path AS path")
    summed = "slice(aggregate(path, array(last_y), (a, v) -> concat(a, array(element_at(a, -1) + v))), 2, size(path))"
    j = j.selectExpr(*keys, "config", "estimator", f"explode(arrays_zip(steps, IF(d = 1, {summed}, path))) AS r")
    return j.selectExpr(*keys, "config", "estimator", f"r.steps.o AS {order}", "r.steps.y AS actual", "r.`1` AS forecast")

