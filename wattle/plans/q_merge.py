"""Queries over merging: outer merges, the six-source chain, pivots, lag fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import consolidate as C
from . import sqlparts as S
from .panel import regressors, target
from .materialize import consolidated_table
from .registry import query
from ..functions import calendar as cal
from ..functions.numeric import iso_date, rnd, round_doubles
from ..operators.merge import consolidate, key_alignment as key_alignment_op, outer_merge as outer_merge_op
from ..sources import standins
from ..sources.tables import table

EL_A, EL_B = standins.ELECTRICITY_ERAS["price_exaa_raw"], standins.ELECTRICITY_ERAS["price_mc_raw"]
BREAK = standins.CARBON_BREAK_DATE
CTES = S.consolidated_ctes(EL_A, EL_B, BREAK)


@query("outer_merge", f"""
WITH {S.sources_ctes(EL_A, EL_B, BREAK)},
{S.outer_chain_ctes(S.SOURCE_LIST[:2], 'merged')}
SELECT {S.rounded_select(['date', 'aggregation_level'] + S.ELEC_COLS + S.CARBON_COLS[5:-1])} FROM merged""")
def outer_merge(spark, sf_dir):
    """Electricity full-outer-joined with carbon on (date, aggregation_level);
    shared calendar columns and completeness taken left-first."""
    m = outer_merge_op(C.electricity_standin(spark, sf_dir), C.carbon_standin(spark, sf_dir))
    return round_doubles(m)


@query("consolidate_sources", f"""
WITH {CTES}
SELECT {S.rounded_select(S.CONSOLIDATED_COLS)} FROM consolidated""")
def consolidate_sources(spark, sf_dir):
    """The wide table: six sources chained by full outer joins on the key,
    written once (partitioned by grain) to the shared folder and read back."""
    c = consolidated_table(spark, sf_dir)
    return round_doubles(c.select(*S.CONSOLIDATED_COLS))


@query("sorted_output", f"""
WITH {CTES}
SELECT date, aggregation_level, {S.r('price_exaa_mean')} AS price_exaa_mean,
       {S.r('carbonprices_primary_market')} AS carbonprices_primary_market
FROM consolidated ORDER BY date, aggregation_level""")
def sorted_output(spark, sf_dir):
    """Sink order: (date, aggregation_level). Sorting happens only at the sink."""
    c = consolidated_table(spark, sf_dir)
    return (c.select("date", "aggregation_level", rnd("price_exaa_mean").alias("price_exaa_mean"),
                     rnd("carbonprices_primary_market").alias("carbonprices_primary_market"))
            .orderBy("date", "aggregation_level"))


@query("merge_geographies", f"""
WITH {S.climate_wide_cte()}
SELECT {S.iso('m')} AS date, {', '.join(S.r(c) + ' AS ' + c for c in S.CLIMATE_COLS)} FROM climate_wide""")
def merge_geographies(spark, sf_dir):
    """Long triples -> one column per (indicator, geography) in one pivot."""
    w = C.climate_wide(standins.climate_long(spark, sf_dir), standins.CLIMATE_INDICATORS, standins.CLIMATE_GEOS)
    return round_doubles(w.select(iso_date("month").alias("date"), *[c for c in w.columns if c != "month"]))


@query("pivot_indicators", f"""
WITH clim AS (SELECT strftime(o_orderdate, '%Y-%m') AS tp, o_orderstatus AS indic, o_orderpriority AS geo,
                     avg(o_totalprice / 1000) AS obs FROM orders GROUP BY ALL),
dups AS (SELECT tp, geo, max(c) AS max_dup FROM (SELECT tp, indic, geo, count(*) AS c FROM clim GROUP BY ALL)
         GROUP BY ALL),
piv AS (SELECT tp, geo, {', '.join(f"max(CASE WHEN indic = '{i}' THEN obs END) AS climate_{i.lower()}" for i in S.CLIMATE_INDICATORS)}
        FROM clim GROUP BY ALL)
SELECT {S.iso("CAST(strptime(tp, '%Y-%m') AS DATE)")} AS date, geo,
       {', '.join(f"{S.r(f'climate_{i.lower()}')} AS climate_{i.lower()}" for i in S.CLIMATE_INDICATORS)},
       CAST(max_dup AS BIGINT) AS max_dup
FROM piv JOIN dups USING (tp, geo)""")
def pivot_indicators(spark, sf_dir):
    """Indicators to columns per (month, geography); ``max_dup`` is 1 when every
    (month, indicator, geography) key is unique (duplicates would be reported)."""
    lng = standins.climate_long(spark, sf_dir)
    inds = standins.CLIMATE_INDICATORS
    # one pivot aggregation gives the value and the key multiplicity per indicator
    piv = (lng.groupBy(F.to_date("TIME_PERIOD", "yyyy-MM").alias("m"), "geo")
           .pivot("indic_nrg", inds).agg(F.first("OBS_VALUE").alias("v"), F.count(F.lit(1)).alias("n")))
    max_dup = F.greatest(*[F.col(f"{i}_n") for i in inds]).cast("long")
    return piv.select(iso_date("m").alias("date"), "geo",
                      *[rnd(f"{i}_v").alias(f"climate_{i.lower()}") for i in inds], max_dup.alias("max_dup"))


@query("seasonal_lag_fill", f"""
WITH {S.PANEL_CTES},
xm AS (SELECT DISTINCT month FROM px),
shifted AS (SELECT series_id, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, y AS y_lag12 FROM py),
j AS (SELECT coalesce(a.series_id, b.series_id) AS series_id, coalesce(a.month, b.month) AS month, a.y, b.y_lag12
      FROM py a FULL OUTER JOIN shifted b ON a.series_id = b.series_id AND a.month = b.month)
SELECT series_id, {S.iso('month')} AS month, {S.r('y')} AS y, {S.r('coalesce(y, y_lag12)')} AS y_filled
FROM j WHERE month IN (SELECT month FROM xm)""")
def seasonal_lag_fill(spark, sf_dir):
    """Months on the regressor calendar without a target take the same month one
    year earlier (equi-join on month + 12, robust to gaps)."""
    from .panel import monthly_panel
    y = monthly_panel(spark, sf_dir).select("series_id", "month", "y")     # written once per session
    xm = regressors(spark, sf_dir).select("month")
    shifted = y.select("series_id", F.add_months("month", 12).alias("month"), F.col("y").alias("y_lag12"))
    j = y.join(shifted, ["series_id", "month"], "full_outer").join(xm, "month", "left_semi")
    return j.select("series_id", iso_date("month").alias("month"), rnd("y").alias("y"),
                    rnd(F.coalesce("y", "y_lag12")).alias("y_filled"))


@query("key_alignment", f"""
WITH a AS (SELECT DISTINCT {S.ms('CAST(o_orderdate AS DATE)')} AS d FROM orders),
b AS (SELECT DISTINCT {S.ms('CAST(l_shipdate AS DATE)')} AS d FROM lineitem)
SELECT {S.iso('d')} AS date, 'left_only' AS side FROM (SELECT d FROM a EXCEPT SELECT d FROM b)
UNION ALL
SELECT {S.iso('d')}, 'right_only' FROM (SELECT d FROM b EXCEPT SELECT d FROM a)""")
def key_alignment(spark, sf_dir):
    """Months present in one source only (order months vs ship months)."""
    a = table(spark, sf_dir, "orders").select(cal.month_start(F.col("o_orderdate").cast("date")).alias("date"))
    b = table(spark, sf_dir, "lineitem").select(cal.month_start(F.col("l_shipdate").cast("date")).alias("date"))
    k = key_alignment_op(a, b, "date")
    return k.select(iso_date("date").alias("date"), "side")
