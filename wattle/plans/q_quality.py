"""Quality report and descriptive statistics over the consolidated table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import consolidate as C
from . import sqlparts as S
from .panel import monthly_panel
from .q_ingest import STANDIN_PERIODS, _period_sql
from .materialize import consolidated_table, reading_hours_table
from .registry import query
from ..functions import calendar as cal
from ..functions.numeric import iso_date, rnd, round_doubles
from ..operators import quality as Q
from ..sources import standins
from ..sources.tables import table

EL_A, EL_B = standins.ELECTRICITY_ERAS["price_exaa_raw"], standins.ELECTRICITY_ERAS["price_mc_raw"]
BREAK = standins.CARBON_BREAK_DATE
CTES = S.consolidated_ctes(EL_A, EL_B, BREAK)
VALUE_COLS = [c for c in S.CONSOLIDATED_COLS if c not in ("date", "aggregation_level")]
MONTHLY_ONLY = S.CLIMATE_COLS + S.PROD_COLS + S.GAS_COLS + S.ECON_COLS
DAILY_CAPABLE = ["price_exaa_mean", "price_mc_auction_mean", "carbonprices_exchange_rate_eur_usd",
                 "carbonprices_primary_market", "carbonprices_secondary_market"]
STAT_COLS = ["price_exaa_mean", "carbonprices_primary_market", "climate_f_1_urgent", "prod_flag_a",
             "oegpi_month", "econ_turnover_total"]
CORR_COLS = ["climate_f_1_urgent", "climate_o_1_urgent"] + S.PROD_COLS + S.GAS_COLS + S.ECON_COLS
NULLITY_COLS = ["price_exaa_mean", "price_mc_auction_mean", "carbonprices_primary_market",
                "climate_f_1_urgent", "prod_flag_a", "oegpi_month", "econ_count_orders"]


def _union(parts):
    return "\nUNION ALL ".join(parts)


def _fam(c):
    return Q.family_of(c)


@query("table_overview", f"""
WITH {CTES}
SELECT count(*) AS n_rows, CAST({len(S.CONSOLIDATED_COLS)} AS BIGINT) AS n_columns, min(date) AS first_date,
       max(date) AS last_date, count_if(aggregation_level = 'daily') AS n_daily,
       count_if(aggregation_level = 'weekly') AS n_weekly, count_if(aggregation_level = 'monthly') AS n_monthly
FROM consolidated""")
def table_overview(spark, sf_dir):
    """Shape, date range and rows per grain."""
    c = consolidated_table(spark, sf_dir)
    lvl = F.col("aggregation_level")
    return c.agg(F.count("*").alias("n_rows"), F.lit(len(c.columns)).cast("long").alias("n_columns"),
                 F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                 F.count_if(lvl == "daily").alias("n_daily"), F.count_if(lvl == "weekly").alias("n_weekly"),
                 F.count_if(lvl == "monthly").alias("n_monthly"))


@query("missing_by_column", f"""
WITH {CTES},
a AS (SELECT count(*) AS n, {', '.join(f'count_if({c} IS NULL) AS {c}' for c in VALUE_COLS)} FROM consolidated)
{_union([f"SELECT '{c}' AS \"column\", '{_fam(c)}' AS family, {c} AS n_null, {S.r(f'{c} / n * 100')} AS pct_null FROM a" for c in VALUE_COLS])}""")
def missing_by_column(spark, sf_dir):
    """NULLs and percent per column with its family (one aggregate pass)."""
    c = consolidated_table(spark, sf_dir)
    return Q.missing_by_column(c, VALUE_COLS).withColumn("pct_null", rnd("pct_null"))


@query("grain_rules", f"""
WITH {CTES}
SELECT aggregation_level, count(*) AS n_rows,
       count_if(coalesce({', '.join(MONTHLY_ONLY)}) IS NOT NULL) AS n_monthly_only_data,
       count_if(coalesce({', '.join(DAILY_CAPABLE)}) IS NOT NULL) AS n_daily_capable_data
FROM consolidated GROUP BY aggregation_level""")
def grain_rules(spark, sf_dir):
    """Architecture rule: daily/weekly rows hold no monthly-only family data."""
    c = consolidated_table(spark, sf_dir)
    return c.groupBy("aggregation_level").agg(
        F.count("*").alias("n_rows"),
        F.count_if(Q.any_not_null(MONTHLY_ONLY)).alias("n_monthly_only_data"),
        F.count_if(Q.any_not_null(DAILY_CAPABLE)).alias("n_daily_capable_data"))


@query("yearly_column_profile", f"""
WITH rd AS ({S.ELEC_READINGS.format(a_lo=EL_A[0], a_hi=EL_A[1], b_lo=EL_B[0], b_hi=EL_B[1])}),
lng AS (SELECT source_year, 'price_exaa_raw' AS "column", timestamp, price_exaa_raw AS v FROM rd
        UNION ALL SELECT source_year, 'price_mc_raw', timestamp, price_mc_raw FROM rd),
cnt AS (SELECT source_year, "column", count(*) AS n_rows, count(v) AS n_non_null FROM lng GROUP BY ALL),
smp AS (SELECT source_year, "column", v, row_number() OVER (PARTITION BY source_year, "column" ORDER BY timestamp, v) AS rn
        FROM lng WHERE v IS NOT NULL QUALIFY rn <= 3)
SELECT CAST(c.source_year AS BIGINT) AS source_year, c."column", c.n_rows, c.n_non_null,
       {S.r('c.n_non_null / c.n_rows * 100')} AS pct_non_null,
       max(CASE WHEN rn = 1 THEN v END) AS sample_1, max(CASE WHEN rn = 2 THEN v END) AS sample_2,
       max(CASE WHEN rn = 3 THEN v END) AS sample_3
FROM cnt c LEFT JOIN smp s USING (source_year, "column") GROUP BY ALL""")
def yearly_column_profile(spark, sf_dir):
    """Per source year and feed: rows, non-null count and share, first three values. Counts come from
    the hourly counts; of the readings only the hours that hold the first values are read."""
    r = C.select_era_columns(standins.electricity_readings(spark, sf_dir), "source_year", standins.ELECTRICITY_ERAS)
    feeds = ["price_exaa_raw", "price_mc_raw"]
    hours = reading_hours_table(spark, sf_dir)
    r = Q.in_hours(r, "timestamp", Q.first_hours(hours, "source_year", [f"n_{f}" for f in feeds], 3))
    lng = r.select("source_year", "timestamp", F.explode(F.array(*[
        F.struct(F.lit(f).alias("column"), F.col(f).alias("v")) for f in feeds])).alias("x")) \
        .select("source_year", "timestamp", "x.column", "x.v")
    cnt = hours.groupBy("source_year").agg(F.sum("n_rows").alias("n_rows"), *[F.sum(f"n_{f}").alias(f) for f in feeds])
    cnt = cnt.unpivot(["source_year", "n_rows"], feeds, "column", "n_non_null")
    smp = Q.first_k_by(lng.filter(F.col("v").isNotNull()), ["source_year", "column"], ["timestamp", "v"], 3)
    smp = smp.groupBy("source_year", "column").agg(
        *[F.max(F.when(F.col("rn") == i, F.col("v"))).alias(f"sample_{i}") for i in (1, 2, 3)])
    return (cnt.join(smp, ["source_year", "column"], "left")
            .select(F.col("source_year").cast("long").alias("source_year"), "column", "n_rows", "n_non_null",
                    rnd(F.col("n_non_null") / F.col("n_rows") * 100).alias("pct_non_null"),
                    "sample_1", "sample_2", "sample_3"))


ZN_COLS = ["price_exaa_mean", "price_mc_auction_mean", "price_count_exaa", "price_count_mc"] + S.PROD_COLS


@query("zero_null_check", f"""
WITH {CTES}
{_union([f"SELECT '{c}' AS \"column\", count_if({c} = 0) AS n_zero, count_if({c} IS NULL) AS n_null FROM consolidated" for c in ZN_COLS])}""")
def zero_null_check(spark, sf_dir):
    """Zeros next to NULLs per column (false-zero validation)."""
    c = consolidated_table(spark, sf_dir)
    return Q.profile(c, ZN_COLS, {"n_zero": lambda x: F.count_if(x == 0), "n_null": lambda x: F.count_if(x.isNull())})


def _nullcorr_sql(a, b):
    ia, ib = f"CAST({a} IS NULL AS DOUBLE)", f"CAST({b} IS NULL AS DOUBLE)"
    return (f"CASE WHEN var_pop({ia}) > 0 AND var_pop({ib}) > 0 THEN "
            f"covar_pop({ia}, {ib}) / sqrt(var_pop({ia}) * var_pop({ib})) END")


@query("nullity_correlation", f"""
WITH {CTES}
{_union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.r(_nullcorr_sql(a, b), 6)} AS r FROM consolidated" for a, b in Q.pairwise(NULLITY_COLS)])}""")
def nullity_correlation(spark, sf_dir):
    """Correlation of missingness indicators for column pairs (NULL if constant)."""
    c = consolidated_table(spark, sf_dir)
    ind = c.select(*[F.col(x).isNull().cast("double").alias(x) for x in NULLITY_COLS])
    pv = Q.pair_values(ind, NULLITY_COLS)
    va, vb = F.var_pop("a"), F.var_pop("b")
    r = F.when((va > 0) & (vb > 0), F.covar_pop("a", "b") / F.sqrt(va * vb))
    return pv.groupBy("col_a", "col_b").agg(rnd(r, 6).alias("r"))


NUMERIC_COLS = [c for c in VALUE_COLS if c != "month_name"]


@query("column_overview", f"""
WITH {CTES}
{_union([f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS n_missing, count(DISTINCT {c}) AS n_distinct, {S.r(f'min({c})')} AS min_value, {S.r(f'max({c})')} AS max_value FROM consolidated" for c in NUMERIC_COLS])}""")
def column_overview(spark, sf_dir):
    """Missing, distinct, min and max per numeric column. Exact distinct counts are
    fine here: the consolidated table is bin-level (rows = dates x grains)."""
    c = consolidated_table(spark, sf_dir)
    out = Q.profile(c, NUMERIC_COLS, {
        "n_missing": lambda x: F.count_if(x.isNull()), "n_distinct": lambda x: F.count_distinct(x),
        "min_value": lambda x: F.min(x).cast("double"), "max_value": lambda x: F.max(x).cast("double")})
    return out.select("column", "n_missing", "n_distinct", rnd("min_value").alias("min_value"),
                      rnd("max_value").alias("max_value"))


RAW_CARBON = [("Exchange rate EUR/USD(<2019)", "xr_before"), ("Exchange rate EUR/USD(>2018)", "xr_after"),
              ("Primary Market(<2019)", "pm_before"), ("Primary Market(>2018)", "pm_after"),
              ("Secondary Market(>2018)", "sm_after")]


@query("break_counts", f"""
WITH raw AS ({S.CARBON_RAW})
{_union([f"SELECT '{n}' AS \"column\", count_if({c} IS NOT NULL AND d < DATE '{BREAK}') AS n_before, count_if({c} IS NOT NULL AND d >= DATE '{BREAK}') AS n_after FROM raw" for n, c in RAW_CARBON])}""")
def break_counts(spark, sf_dir):
    """Non-null observations of each raw carbon column before / after the break."""
    raw = standins.carbon_raw(spark, sf_dir)
    names = [n for n, _ in RAW_CARBON]
    long = raw.select("Date", *[F.col(f"`{n}`") for n in names]).unpivot(["Date"], names, "column", "value")
    before = F.col("Date") < F.to_date(F.lit(BREAK))
    v = F.col("value").isNotNull()
    return long.groupBy("column").agg(F.count_if(v & before).alias("n_before"), F.count_if(v & ~before).alias("n_after"))


@query("grain_distribution", f"""
WITH {CTES}
SELECT aggregation_level, count(*) AS n_rows, {S.r('count(*) / sum(count(*)) OVER () * 100')} AS pct_rows,
       min(date) AS first_date, max(date) AS last_date
FROM consolidated GROUP BY aggregation_level""")
def grain_distribution(spark, sf_dir):
    """Rows per grain, share and date range (share via a window over the 3 group rows)."""
    from pyspark.sql import Window
    c = consolidated_table(spark, sf_dir)
    g = c.groupBy("aggregation_level").agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"),
                                           F.max("date").alias("last_date"))
    tot = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return g.select("aggregation_level", "n_rows", rnd(F.col("n_rows") / tot * 100).alias("pct_rows"),
                    "first_date", "last_date")


@query("distinct_counts", """
WITH clim AS (SELECT strftime(o_orderdate, '%Y-%m') AS tp, o_orderstatus AS indic, o_orderpriority AS geo,
                     avg(o_totalprice / 1000) AS obs FROM orders GROUP BY ALL)
SELECT 'TIME_PERIOD' AS "column", count(DISTINCT tp) AS n_distinct FROM clim
UNION ALL SELECT 'indic_nrg', count(DISTINCT indic) FROM clim
UNION ALL SELECT 'geo', count(DISTINCT geo) FROM clim""")
def distinct_counts(spark, sf_dir):
    """Distinct periods, indicators and geographies of the long climate triples."""
    lng = standins.climate_long(spark, sf_dir)
    return Q.profile(lng, ["TIME_PERIOD", "indic_nrg", "geo"], {"n_distinct": lambda x: F.count_distinct(x)},
                     cast="string")


@query("describe_stats", f"""
WITH {CTES}, m AS (SELECT * FROM consolidated WHERE aggregation_level = 'monthly')
{_union([f"SELECT '{c}' AS \"column\", count({c}) AS count, {S.r(f'avg({c})')} AS mean, {S.r(f'stddev_samp({c})')} AS std, {S.r(f'min({c})')} AS min, {S.r(f'quantile_cont({c}, 0.25)')} AS p25, {S.r(f'quantile_cont({c}, 0.5)')} AS p50, {S.r(f'quantile_cont({c}, 0.75)')} AS p75, {S.r(f'max({c})')} AS max FROM m" for c in STAT_COLS])}""")
def describe_stats(spark, sf_dir):
    """count, mean, sd, min, quartiles (linear interpolation), max of monthly rows."""
    c = consolidated_table(spark, sf_dir).filter(F.col("aggregation_level") == "monthly")
    out = Q.profile(c, STAT_COLS, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": lambda x: F.min(x).cast("double"),
        "p25": lambda x: F.percentile(x, 0.25), "p50": lambda x: F.percentile(x, 0.5),
        "p75": lambda x: F.percentile(x, 0.75), "max": lambda x: F.max(x).cast("double")})
    return round_doubles(out)


def _corr_sql(where=""):
    return _union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.r(f'corr({a}, {b})', 6)} AS r, "
                   f"count_if({a} IS NOT NULL AND {b} IS NOT NULL) AS n_pairs FROM m" for a, b in Q.pairwise(CORR_COLS)])


@query("correlation_matrix", f"""
WITH {CTES}, m AS (SELECT * FROM consolidated WHERE aggregation_level = 'monthly')
{_corr_sql()}""")
def correlation_matrix(spark, sf_dir):
    """Pearson r of every column pair of monthly rows (pairwise complete)."""
    c = consolidated_table(spark, sf_dir).filter(F.col("aggregation_level") == "monthly")
    return Q.correlations(c, CORR_COLS).withColumn("r", rnd("r", 6))


@query("high_correlations", f"""
WITH {CTES}, m AS (SELECT * FROM consolidated WHERE aggregation_level = 'monthly'),
cm AS ({_corr_sql()})
SELECT * FROM cm WHERE abs(r) > 0.7""")
def high_correlations(spark, sf_dir):
    """Pairs with |r| > 0.7 (upper triangle)."""
    c = consolidated_table(spark, sf_dir).filter(F.col("aggregation_level") == "monthly")
    return Q.correlations(c, CORR_COLS).withColumn("r", rnd("r", 6)).filter(F.abs("r") > 0.7)


@query("period_kpis", f"""
WITH {S.PANEL_CTES}, p AS (SELECT {_period_sql('month')} AS period, series_id, y FROM panel)
SELECT period, series_id, count(y) AS n, {S.r('avg(y)')} AS mean, {S.r('stddev_samp(y)')} AS std,
       {S.r('stddev_samp(y) / avg(y)')} AS cv
FROM p GROUP BY ALL""")
def period_kpis(spark, sf_dir):
    """Mean, sd and coefficient of variation of the target per period and series."""
    p = monthly_panel(spark, sf_dir).withColumn("period", cal.period_label("month", STANDIN_PERIODS))
    return p.groupBy("period", "series_id").agg(
        F.count("y").alias("n"), rnd(F.avg("y")).alias("mean"), rnd(F.stddev_samp("y")).alias("std"),
        rnd(F.stddev_samp("y") / F.avg("y")).alias("cv"))


@query("monthly_seasonal_means", f"""
WITH {S.PANEL_CTES}
SELECT series_id, CAST(month(month) AS BIGINT) AS month_of_year, count(*) AS n_years, {S.r('avg(y)')} AS mean_y
FROM panel GROUP BY ALL""")
def monthly_seasonal_means(spark, sf_dir):
    """Month-of-year means of the target per series."""
    p = monthly_panel(spark, sf_dir)
    return p.groupBy("series_id", F.month("month").cast("long").alias("month_of_year")).agg(
        F.count("*").alias("n_years"), rnd(F.avg("y")).alias("mean_y"))


@query("data_availability", f"""
WITH {CTES}
{_union([f"SELECT '{c}' AS \"column\", min(CASE WHEN {c} IS NOT NULL THEN date END) AS first_date, max(CASE WHEN {c} IS NOT NULL THEN date END) AS last_date, count({c}) AS n_values FROM consolidated" for c in VALUE_COLS])}""")
def data_availability(spark, sf_dir):
    """First and last date with data per column."""
    c = consolidated_table(spark, sf_dir)
    d = F.col("date")
    long = c.select("date", *[F.col(x).cast("string").alias(x) for x in VALUE_COLS]) \
        .unpivot(["date"], VALUE_COLS, "column", "value")
    v = F.col("value")
    return long.groupBy("column").agg(F.min(F.when(v.isNotNull(), d)).alias("first_date"),
                                      F.max(F.when(v.isNotNull(), d)).alias("last_date"), F.count(v).alias("n_values"))


@query("sample_per_grain", f"""
WITH {CTES},
f AS (SELECT aggregation_level, date, 'first' AS end_, row_number() OVER (PARTITION BY aggregation_level ORDER BY date) AS rn
      FROM consolidated QUALIFY rn <= 3),
l AS (SELECT aggregation_level, date, 'last' AS end_, row_number() OVER (PARTITION BY aggregation_level ORDER BY date DESC) AS rn
      FROM consolidated QUALIFY rn <= 3)
SELECT aggregation_level, date, end_ AS "end", CAST(rn AS BIGINT) AS rn FROM f
UNION ALL SELECT aggregation_level, date, end_, CAST(rn AS BIGINT) FROM l""")
def sample_per_grain(spark, sf_dir):
    """First and last three rows of each grain (head/tail per group, top-k limited)."""
    c = consolidated_table(spark, sf_dir).select("aggregation_level", "date")
    first = Q.first_k_by(c, ["aggregation_level"], [F.col("date")], 3).withColumn("end", F.lit("first"))
    last = Q.first_k_by(c, ["aggregation_level"], [F.col("date").desc()], 3).withColumn("end", F.lit("last"))
    return first.unionByName(last).select("aggregation_level", "date", "end", F.col("rn").cast("long"))


@query("missing_months", f"""
WITH p AS (SELECT DISTINCT o_custkey, {S.ms('CAST(o_orderdate AS DATE)')} AS m FROM orders),
cal AS (SELECT o_custkey, CAST(unnest(generate_series(CAST(min(m) AS TIMESTAMP), CAST(max(m) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m
        FROM p GROUP BY 1)
SELECT {S.iso('m')} AS month, count(*) AS n_customers
FROM (SELECT * FROM cal EXCEPT SELECT o_custkey, m FROM p) GROUP BY 1""")
def missing_months(spark, sf_dir):
    """Calendar continuity of every customer's monthly orders: per month, the customers with orders
    before and after but none in it."""
    present = table(spark, sf_dir, "orders").select(
        "o_custkey", cal.month_start(F.col("o_orderdate").cast("date")).alias("m")).distinct()
    # months strictly between a customer's consecutive months, in one pass over the distinct months
    nxt = present.withColumn("nx", F.lead("m").over(Window.partitionBy("o_custkey").orderBy("m")))
    lo, hi = F.add_months("m", 1), F.add_months("nx", -1)
    gaps = nxt.filter(F.col("nx").isNotNull() & (lo <= hi)).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return gaps.groupBy(iso_date("m").alias("month")).agg(F.count("*").alias("n_customers"))


RAW_COLUMNS = {"lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "orders": ["o_totalprice"], "events": ["value"]}


def _raw_describe_sql():
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, {S.r(f'avg({c})')} AS mean, {S.r(f'stddev_samp({c})')} AS std, {S.r(f'min({c})')} AS min, "
        + ", ".join(f"{S.r(f'quantile_cont({c}, {q})')} AS p{round(100 * q)}" for q in (0.25, 0.5, 0.75)) + f", {S.r(f'max({c})')} AS max FROM {t}"
        for t, cols in RAW_COLUMNS.items() for c in cols)


@query("raw_describe", _raw_describe_sql())
def raw_describe(spark, sf_dir):
    """Descriptive statistics with exact quartiles of raw columns: distributed selection by refined histograms."""
    from ..operators.quantiles import describe
    parts = [describe(table(spark, sf_dir, t), cols) for t, cols in RAW_COLUMNS.items()]
    return round_doubles(parts[0].unionByName(parts[1]).unionByName(parts[2]))
