"""Time-series operators on monthly panels keyed by ``series_id``.

Every window is partitioned by the series key and runs on month-level rows
(series x months), never on raw readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_index(c="month") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 12 + F.month(c) - 1).cast("long")


def by_series(key: str = "series_id", order: str = "month") -> Window:
    return Window.partitionBy(key).orderBy(order)


def add_lags(df: DataFrame, col: str, lags: Sequence[int], key: str = "series_id",
             order: str = "month", prefix: str | None = None) -> DataFrame:
    """Positional lags (``shift``) of ``col`` within each series."""
    w = by_series(key, order)
    p = prefix or f"{col}_lag"
    return df.select("*", *[F.lag(col, k).over(w).alias(f"{p}{k}") for k in lags])


def acf(df: DataFrame, col: str, max_lag: int, key: str = "series_id", order: str = "month") -> DataFrame:
    """Sample autocorrelation r_k = sum (y_t - m)(y_{t-k} - m) / sum (y_t - m)^2, k = 1..max_lag.

    A constant series has null. All lags come from one window pass (``lag`` columns) and one aggregate; no
    self-join per lag. Generated expressions are SQL snippets (one driver call each)."""
    c = (df.selectExpr(key, order, f"`{col}` - avg(`{col}`) OVER (PARTITION BY {key}) AS e")
         .where("e IS NOT NULL"))
    lags = [f"lag(e, {k}) OVER (PARTITION BY {key} ORDER BY {order}) AS l{k}" for k in range(1, max_lag + 1)]
    lagged = c.selectExpr(key, "e", *lags)
    agg = lagged.groupBy(key).agg(F.expr("sum(e * e)").alias("c0"), F.expr("count(1)").alias("n"),
                                  *[F.expr(f"sum(e * l{k})").alias(f"s{k}") for k in range(1, max_lag + 1)])
    rows = ", ".join(f"named_struct('lag', CAST({k} AS BIGINT), 'acf', s{k} / nullif(c0, 0))" for k in range(1, max_lag + 1))
    return agg.selectExpr(key, "n", f"inline(array({rows}))")


# One step of Durbin-Levinson: state (phi, v, out), the autocorrelations ``r`` and the step's ``at`` in order.
_REFLECTION = """(r[size(st.phi)] - aggregate(zip_with(st.phi, reverse(slice(r, 1, size(st.phi))), (p, a) -> p * a),
                  CAST(0 AS DOUBLE), (t, x) -> t + x)) / nullif(st.v, 0)"""
_LEVINSON = f"""aggregate(r,
    named_struct('phi', CAST(array() AS array<double>), 'v', CAST(1 AS DOUBLE), 'out', CAST(array() AS array<double>)),
    (st, at) -> transform(array({_REFLECTION}), k -> named_struct(
        'phi', concat(zip_with(st.phi, reverse(st.phi), (p, q) -> p - k * q), array(k)),
        'v', st.v * (1 - k * k), 'out', concat(st.out, array(k))))[0],
    st -> st.out)"""


def pacf_from_acf(acf_df: DataFrame, key: str = "series_id") -> DataFrame:
    """Partial autocorrelation by Durbin-Levinson, a fold over each series' ACF (as many values as lags).

    The key keeps its type. From the lag on at which nothing is left to explain, values are null."""
    lags = acf_df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        F.col("lag").cast("long").alias("lag"), F.col("acf").cast("double").alias("acf")))).alias("s"))
    out = lags.select(key, "s", F.col("s.acf").alias("r")).select(key, "s", F.expr(_LEVINSON).alias("out"))
    return out.selectExpr(f"`{key}`", "inline(zip_with(s, out, (a, p) -> named_struct('lag', a.lag, 'pacf', p)))")


def first_k_by(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """First ``k`` rows per key by ``order`` (``rn`` 1..k).

    ``row_number() <= k`` lets Spark insert a WindowGroupLimit below the
    shuffle, so each map task forwards at most k rows per key: the group is
    never materialised whole in one task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
