"""Monthly modelling panel derived from the driver tables.

One series per order priority: ``y`` = mean order value (thousands) per
order month; regressors ``x1`` = mean line price (thousands), ``x2`` =
mean discount (percent), ``x3`` = mean tax (percent) and ``x4`` = mean
quantity per ship month. Raw rows are reduced to month level
by partial aggregation before any shuffle; the panel itself has
series x months rows, so every model below works on a tiny table regardless
of the raw volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..sources.tables import table

TRAIN_END = "1999-12-01"                          # last train month
TEST_START, TEST_END = "2000-01-01", "2001-06-01"  # 18 test months, as in the reference


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series_id"),
                      month_start(F.col("o_orderdate").cast("date")).alias("month"))
            .agg(F.avg(F.col("o_totalprice") / 1000).alias("y")))


def regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(month_start(F.col("l_shipdate").cast("date")).alias("month"))
            .agg(F.avg(F.col("l_extendedprice") / 1000).alias("x1"),
                 F.avg(F.col("l_discount") * 100).alias("x2"),
                 F.avg(F.col("l_tax") * 100).alias("x3"),
                 F.avg("l_quantity").alias("x4")))


def monthly_panel_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, month, y, x1..x4). The month-level regressor table has one row
    per calendar month, so the optimizer may broadcast it (AQE decides on the
    measured size)."""
    return target(spark, sf_dir).join(regressors(spark, sf_dir), "month", "left") \
        .select("series_id", "month", "y", "x1", "x2", "x3", "x4")


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel, aggregated from the raw tables once per session and input
    state and read back from the shared checkpoint folder; models fan out over
    it many times (configs, folds, replicates) without re-scanning raw data."""
    from .materialize import materialized
    return materialized(spark, "monthly-panel", sf_dir, lambda: monthly_panel_plan(spark, sf_dir),
                        tables=("orders", "lineitem"))


def split_label(month_col="month") -> F.Column:
    m = F.col(month_col)
    return (F.when(m <= F.lit(TRAIN_END).cast("date"), F.lit("train"))
            .when(m.between(F.lit(TEST_START).cast("date"), F.lit(TEST_END).cast("date")), F.lit("test")))
