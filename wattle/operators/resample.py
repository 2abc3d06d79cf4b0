"""Resampling of readings to day / week / month bins.

Plan shape (scales with the raw data, not with the number of bins):
  1. one hash aggregate of raw readings to (keys, day) -> sum, non-null count
     (partial aggregation on every executor, one shuffle of day rows);
  2. day rows are expanded to their three bins and aggregated again; week and
     month means are exact from (sum, count);
  3. gap bins (pandas ``resample`` emits every bin between the first and the
     last) are emitted in step 2 from each day row and the next day with data
     (``lead`` over day rows), so the readings are scanned once and no
     calendar join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import GRAINS, bin_of, bin_sql

STEP = {"daily": "INTERVAL 1 DAY", "weekly": "INTERVAL 7 DAYS", "monthly": "INTERVAL 1 MONTH"}


def daily_moments(df: DataFrame, day_col, value_cols: Sequence[str],
                  keys: Sequence[str] = ()) -> DataFrame:
    """(keys, day) -> ``v__sum``, ``v__cnt`` for every value column; readings whose
    time did not parse belong to no day and are left out."""
    day = (F.col(day_col) if isinstance(day_col, str) else day_col).cast("date")
    aggs = []
    for v in value_cols:
        aggs += [F.sum(v).alias(f"{v}__sum"), F.count(v).alias(f"{v}__cnt")]
    return df.withColumn("day", day).filter("day IS NOT NULL").groupBy(*keys, "day").agg(*aggs)


def _shift_sql(b: str, grain: str, k: int) -> str:
    if grain == "monthly":
        return f"add_months({b}, {k})"
    return f"date_add({b}, {k * (7 if grain == 'weekly' else 1)})"


def bin_entries_sql(value_cols: Sequence[str], grains: Sequence[str], gap_fill: bool,
                    week_mode: str = "w-mon") -> str:
    """One SQL expression: the array of (grain, bin, moments) entries of a day row.

    Per grain the day's own bin carries its moments; with ``gap_fill`` the
    empty bins strictly between this bin and the bin of the next day with data
    (column ``_next``) follow with NULL sums and zero counts."""
    moment_cols = [f"{v}__{m}" for v in value_cols for m in ("sum", "cnt")]
    parts = []
    for g in grains:
        b = bin_sql("day", g, week_mode)
        data = ", ".join(f"'{c}', `{c}`" for c in moment_cols)
        parts.append(f"array(named_struct('aggregation_level', '{g}', 'bin', {b}, {data}))")
        if gap_fill:
            lo = _shift_sql(b, g, 1)
            hi = _shift_sql(bin_sql("_next", g, week_mode), g, -1)
            empty = ", ".join(f"'{c}', " + ("CAST(NULL AS DOUBLE)" if c.endswith("__sum") else "CAST(0 AS BIGINT)")
                              for c in moment_cols)
            gaps = (f"CASE WHEN _next IS NOT NULL AND {lo} <= {hi} THEN sequence({lo}, {hi}, {STEP[g]}) "
                    f"ELSE CAST(array() AS ARRAY<DATE>) END")
            parts.append(f"transform({gaps}, x -> named_struct('aggregation_level', '{g}', 'bin', x, {empty}))")
    return f"flatten(array({', '.join(parts)}))"


def rollup_days(days: DataFrame, value_cols: Sequence[str], keys: Sequence[str] = (),
                grains: Sequence[str] = GRAINS, gap_fill: bool = True,
                week_mode: str = "w-mon") -> DataFrame:
    """(keys, aggregation_level, date) -> ``v_mean``, ``v_count`` from day moments.

    Gap bins: each day row also emits the empty bins strictly between its own
    bin and the bin of the next day with data (``lead`` over the day rows of
    its key), so every bin between the first and the last is produced in the
    same single pass; no calendar table and no second scan of the readings.
    The window runs on day-level rows (bounded by the calendar, not by the
    number of readings)."""
    src = days
    if gap_fill:
        src = days.withColumn("_next", F.lead("day").over(Window.partitionBy(*keys).orderBy("day")))
    expanded = (src.select(*keys, F.explode(F.expr(bin_entries_sql(value_cols, grains, gap_fill, week_mode))).alias("b"))
                .select(*keys, "b.*"))
    aggs = []
    for v in value_cols:
        s_, n = F.sum(f"{v}__sum"), F.sum(f"{v}__cnt")
        aggs += [F.when(n > 0, s_ / n).alias(f"{v}_mean"), n.alias(f"{v}_count")]
    return (expanded.groupBy(*keys, "aggregation_level", F.col("bin").alias("date"))
            .agg(*aggs))


def by_series(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Day rows of many series dealt to as many tasks as there are shuffle partitions.

    The window and the bins' group-by of one task hold some 400 bytes a day row; a
    shuffle sized by its compressed bytes would give them tens of megabytes of
    day rows at once, a set number of tasks gives each its share of the series."""
    if not keys:
        return days
    n = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return days.repartition(n, *keys)


def resample(df: DataFrame, ts_col: str, value_cols: Sequence[str],
             keys: Sequence[str] = (), grains: Sequence[str] = GRAINS,
             gap_fill: bool = True, week_mode: str = "w-mon") -> DataFrame:
    """Mean and non-null count of each value column per bin and grain."""
    days = by_series(daily_moments(df, ts_col, value_cols, keys), keys)
    return rollup_days(days, value_cols, keys, grains, gap_fill, week_mode)


def resample_mean_family(daily: DataFrame, date_col: str, value_cols: Sequence[str],
                         grains: Sequence[str] = ("weekly", "monthly"),
                         keys: Sequence[str] = (), gap_fill: bool = True,
                         week_mode: str = "w-mon") -> DataFrame:
    """Mean of a column family from daily observations to coarser grains (gap bins kept)."""
    days = by_series(daily_moments(daily, date_col, value_cols, keys), keys)
    out = rollup_days(days, value_cols, keys, grains, gap_fill, week_mode)
    return out.select(*keys, "aggregation_level", "date",
                      *[F.col(f"{v}_mean").alias(v) for v in value_cols])
