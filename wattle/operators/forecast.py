"""Forecast baselines, metrics and model ranking on a (series, month) panel.

Input contract: ``train`` and ``test`` with columns series_id, month (DATE),
midx (month index), y and regressors. Every step is a group-by per series or
an equi-join on series_id against one row per series; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def persistence(train: DataFrame, test: DataFrame) -> DataFrame:
    last = train.groupBy("series_id").agg(F.max_by("y", "month").alias("forecast"))
    return test.join(last, "series_id").select("series_id", "month", F.lit("persistence").alias("model"),
                                               F.col("y").alias("actual"), "forecast")


def seasonal_naive(train: DataFrame, test: DataFrame) -> DataFrame:
    """The last training value of the same calendar month; months that the training
    series lacks forecast NULL, no test month is lost or repeated."""
    last = train.groupBy("series_id", F.month("month").alias("moy")).agg(F.max_by("y", "month").alias("forecast"))
    t = test.withColumn("moy", F.month("month"))
    return t.join(last, ["series_id", "moy"], "left").select("series_id", "month", F.lit("seasonal_naive").alias("model"),
                                                     F.col("y").alias("actual"), "forecast")


def regression_coefs(train: DataFrame, x: str = "x1") -> DataFrame:
    return train.groupBy("series_id").agg(
        F.regr_intercept("y", x).alias("a"), F.regr_slope("y", x).alias("b"),
        F.regr_r2("y", x).alias("r2"), F.regr_count("y", x).alias("n"))


def regression(train: DataFrame, test: DataFrame, x: str = "x1") -> DataFrame:
    rc = regression_coefs(train, x)
    return test.join(rc, "series_id").select("series_id", "month", F.lit(f"regression_{x}").alias("model"),
                                             F.col("y").alias("actual"), (F.col("a") + F.col("b") * F.col(x)).alias("forecast"))


def with_lag1(train: DataFrame) -> DataFrame:
    return train.withColumn("y1", F.lag("y").over(Window.partitionBy("series_id").orderBy("month")))


def ar1_coefs(train: DataFrame) -> DataFrame:
    t = with_lag1(train)
    return t.groupBy("series_id").agg(
        F.regr_intercept("y", "y1").alias("c"), F.regr_slope("y", "y1").alias("phi"),
        F.regr_r2("y", "y1").alias("r2"), F.regr_count("y", "y1").alias("n"),
        F.max_by("y", "month").alias("yT"), F.max("midx").alias("T"))


def ar1(train: DataFrame, test: DataFrame) -> DataFrame:
    """Multi-step AR(1) path from the last training value, closed form:
    y_{T+h} = c (1 - phi^h) / (1 - phi) + phi^h y_T."""
    ac = ar1_coefs(train)
    h = F.col("midx") - F.col("T")
    ph = F.pow(F.col("phi"), h)
    f = F.when(F.col("phi") == 1, F.col("c") * h + F.col("yT")) \
        .otherwise(F.col("c") * (1 - ph) / (1 - F.col("phi")) + ph * F.col("yT"))
    return test.join(ac, "series_id").select("series_id", "month", F.lit("ar1").alias("model"),
                                             F.col("y").alias("actual"), f.alias("forecast"))


def baseline_coefs(train: DataFrame, x: str = "x1") -> DataFrame:
    """One row a series with what all four models need: last value, last value of each calendar
    month, regression on ``x`` and AR(1)."""
    of_month = [F.expr(f"max_by(y, month) FILTER (WHERE month(month) = {m})") for m in range(1, 13)]
    return with_lag1(train).groupBy("series_id").agg(
        F.max_by("y", "month").alias("yT"), F.max("midx").alias("T"), F.array(*of_month).alias("season"),
        F.regr_intercept("y", x).alias("a"), F.regr_slope("y", x).alias("b"),
        F.regr_intercept("y", "y1").alias("c"), F.regr_slope("y", "y1").alias("phi"))


def baseline_forecasts(train: DataFrame, test: DataFrame, x: str = "x1") -> DataFrame:
    """Persistence, seasonal naive, regression and AR(1) of every test month: one aggregate of the training
    rows, one join, four rows a test month. Each model is as in its own function above."""
    j = test.join(baseline_coefs(train, x).withColumn("trained", F.lit(True)), "series_id", "left")
    h, ph = F.col("midx") - F.col("T"), F.pow("phi", F.col("midx") - F.col("T"))
    path = F.when(F.col("phi") == 1, F.col("c") * h + F.col("yT")) \
        .otherwise(F.col("c") * (1 - ph) / (1 - F.col("phi")) + ph * F.col("yT"))
    models = {"persistence": F.col("yT"), "seasonal_naive": F.get("season", F.month("month") - 1),
              f"regression_{x}": F.col("a") + F.col("b") * F.col(x), "ar1": path}
    rows = F.inline(F.array(*[F.struct(F.lit(m).alias("model"), f.alias("forecast")) for m, f in models.items()]))
    # a series without training rows has no forecast but the seasonal one, which is null
    return (j.select("series_id", "month", F.col("y").alias("actual"), "trained", rows)
            .filter(F.col("trained") | (F.col("model") == "seasonal_naive"))
            .select("series_id", "month", "model", "actual", "forecast"))


def metrics(fc: DataFrame, keys=("series_id", "model")) -> DataFrame:
    """RMSE, MAE, MAPE %, bias (forecast - actual) and max absolute error."""
    e = F.col("forecast") - F.col("actual")
    return fc.groupBy(*keys).agg(
        F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(e / F.col("actual"))) * 100).alias("mape"), F.avg(e).alias("bias"),
        F.max(F.abs(e)).alias("max_abs_error"))


def rank_models(m: DataFrame, by: str = "rmse") -> DataFrame:
    w = Window.partitionBy("series_id").orderBy(F.col(by), F.col("model"))
    return m.withColumn("rank", F.row_number().over(w).cast("long"))
