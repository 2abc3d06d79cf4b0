"""Every ARIMA and ARMAX order of the survey's grids, fitted and forecast."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .materialize import materialized
from .q_models import _split
from .registry import query
from ..functions.numeric import rnd
from ..operators import arma as A
from ..operators.unitroot import in_windows

RECENT = "1996-01-01"       # the last 48 training months, as the regressor's period in the reference
ORDERS = {f"arima{p}{d}{q}": (p, d, q, False) for p, d, q in
          ((1, 0, 0), (2, 0, 0), (3, 0, 0), (1, 0, 1), (2, 0, 1), (1, 0, 2), (2, 0, 2), (1, 1, 0), (2, 1, 0), (1, 1, 1), (2, 1, 1))}
ORDERS_X = {f"armax{p}{d}{q}": (p, d, q, True) for p, d, q in ((3, 0, 0), (2, 0, 0), (4, 0, 0), (3, 0, 1), (2, 0, 1))}


def _fits(spark, sf_dir):
    """Fits (written once per session and input state: a row a series, window and order) and the test months."""
    train, test = _split(spark, sf_dir)

    def build():
        rows = in_windows(train, {"full": None, "recent": F.col("month") >= F.lit(RECENT).cast("date")})
        return A.fit(rows, ["series_id", "window"], "y", "x1", ORDERS | ORDERS_X)
    return materialized(spark, "arma-fits", sf_dir, build, tables=("orders", "lineitem")), test


@query("arma_css")
def arma_css(spark, sf_dir):
    """All eleven univariate orders and five with x1 by conditional sum of squares, on the full training
    months and the recent ones: coefficients, sigma2, AIC, steps of the search."""
    fits, _ = _fits(spark, sf_dir)
    used = [F.when(F.col("uses")[i] > 0, F.col("css.b")[i]) for i in range(A.K)]
    return fits.select("series_id", F.col("window").alias("window_name"), "config", "n_fit",
                       *[rnd(c).alias(n) for c, n in zip(used, A.SLOTS)], rnd("sigma2").alias("sigma2"), rnd("aic").alias("aic"),
                       F.col("css.steps").alias("steps"), F.col("css.converged").alias("converged"))


@query("arma_forecast_metrics")
def arma_forecast_metrics(spark, sf_dir):
    """Test RMSE and MAE of every order, both by the two-stage estimate and by conditional sum of squares,
    ranked by RMSE within series and window."""
    fits, test = _fits(spark, sf_dir)
    points = A.forecast(fits, test, ["series_id", "window"], "series_id", "y", "x1")
    e = F.col("forecast") - F.col("actual")
    m = points.groupBy("series_id", F.col("window").alias("window_name"), "config", "estimator").agg(
        F.count(e).alias("n"), rnd(F.sqrt(F.avg(e * e))).alias("rmse"), rnd(F.avg(F.abs(e))).alias("mae"))
    w = Window.partitionBy("series_id", "window_name").orderBy(F.col("rmse").asc_nulls_last(), "config", "estimator")
    return m.withColumn("rmse_rank", F.row_number().over(w))
