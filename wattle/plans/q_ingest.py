"""Queries over the ingestion pipeline: resampling, cleaning, parsing, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import consolidate as C
from . import sqlparts as S
from .panel import monthly_panel, regressors, split_label, target
from .registry import query
from ..functions import calendar as cal
from ..functions import cleaning as cl
from ..functions.numeric import half_even_long, iso_date, rnd
from ..operators.resample import resample
from ..sources import standins
from ..sources.tables import table

EL_A, EL_B = standins.ELECTRICITY_ERAS["price_exaa_raw"], standins.ELECTRICITY_ERAS["price_mc_raw"]
BREAK = standins.CARBON_BREAK_DATE
FEEDS = ["price_exaa_raw", "price_mc_raw"]


def _feed_bins(spark, sf_dir, grains, gap_fill=True):
    r = C.select_era_columns(standins.electricity_readings(spark, sf_dir), "source_year",
                             standins.ELECTRICITY_ERAS)
    out = resample(r, "timestamp", FEEDS, (), grains, gap_fill)
    return out.select("aggregation_level", iso_date("date").alias("date"),
                      rnd("price_exaa_raw_mean").alias("price_exaa_mean"),
                      F.col("price_exaa_raw_count").alias("price_exaa_count"),
                      rnd("price_mc_raw_mean").alias("price_mc_mean"),
                      F.col("price_mc_raw_count").alias("price_mc_count"))


# --- 2.5 resampling --------------------------------------------------------------

@query("three_grain_rollup", S.electricity_long_sql(EL_A, EL_B))
def three_grain_rollup(spark, sf_dir):
    """15-minute two-feed prices -> daily/weekly/monthly long table with completeness."""
    return C.electricity_standin(spark, sf_dir)


@query("resample_daily", S.elec_bins_sql(("daily",), True, EL_A, EL_B))
def resample_daily(spark, sf_dir):
    """Day bins: mean and non-null count of both feeds."""
    return _feed_bins(spark, sf_dir, ("daily",))


@query("resample_weekly", S.elec_bins_sql(("weekly",), True, EL_A, EL_B))
def resample_weekly(spark, sf_dir):
    """W-MON bins (weeks Tue..Mon labelled by the closing Monday)."""
    return _feed_bins(spark, sf_dir, ("weekly",))


@query("resample_monthly", S.elec_bins_sql(("monthly",), True, EL_A, EL_B))
def resample_monthly(spark, sf_dir):
    """Month-start bins."""
    return _feed_bins(spark, sf_dir, ("monthly",))


_GAP_UNION = " UNION ALL ".join(f"SELECT user_id, '{g}' AS aggregation_level, {b} AS bin, value FROM d"
                               for g, b in (("daily", "day"), ("weekly", S.wmon("day"))))


@query("resample_gapfill", f"""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE ts IS NOT NULL),
binned AS ({_GAP_UNION}),
agg AS (SELECT user_id, aggregation_level, bin, avg(value) AS m, count(value) AS c FROM binned GROUP BY ALL),
bounds AS (SELECT user_id, aggregation_level, min(bin) AS lo, max(bin) AS hi FROM agg GROUP BY ALL),
cal AS (SELECT user_id, aggregation_level,
               CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {S.step()})) AS DATE) AS bin FROM bounds)
SELECT aggregation_level, {S.iso('bin')} AS date, count(*) AS n_series, count(*) - count(m) AS n_gaps,
       CAST(coalesce(sum(c), 0) AS BIGINT) AS n_readings, {S.r('avg(m)')} AS mean_of_means
FROM cal LEFT JOIN agg USING (user_id, aggregation_level, bin) GROUP BY ALL""")
def resample_gapfill(spark, sf_dir):
    """Each user's readings as a series of its own: every empty bin between its first and last is
    emitted with NULL mean and count 0; per bin the series that cover it and those with a gap there."""
    r = resample(table(spark, sf_dir, "events").select("user_id", "ts", "value"), "ts", ["value"], ("user_id",),
                 ("daily", "weekly"), True)
    return r.groupBy("aggregation_level", iso_date("date").alias("date")).agg(
        F.count("*").alias("n_series"), (F.count("*") - F.count("value_mean")).alias("n_gaps"),
        F.sum("value_count").alias("n_readings"), rnd(F.avg("value_mean")).alias("mean_of_means"))


@query("interval_completeness", f"""
SELECT date, aggregation_level, price_count_exaa + price_count_mc AS intervals, data_completeness
FROM ({S.electricity_long_sql(EL_A, EL_B)})""")
def interval_completeness(spark, sf_dir):
    """(count_a + count_b) / {96, 672, 2976} x 100, one decimal, half-even."""
    e = C.electricity_standin(spark, sf_dir)
    return e.select("date", "aggregation_level",
                    (F.col("price_count_exaa") + F.col("price_count_mc")).alias("intervals"),
                    "data_completeness")


@query("resample_family", f"""
WITH {S.carbon_long_ctes(BREAK)}
SELECT date, year, month, quarter, week, aggregation_level, month_name,
       {S.r('carbonprices_exchange_rate_eur_usd')} AS carbonprices_exchange_rate_eur_usd,
       carbonprices_primary_market, carbonprices_secondary_market, data_completeness
FROM carbon_long""")
def resample_family(spark, sf_dir):
    """Carbon family: daily raw rows, weekly/monthly means with gap bins; market
    prices rounded half-even, exchange rates kept as double; row completeness."""
    c = C.carbon_standin(spark, sf_dir)
    return c.withColumn("carbonprices_exchange_rate_eur_usd", rnd("carbonprices_exchange_rate_eur_usd"))


# --- 2.3 cleaning and scalar expressions ---------------------------------------------

DIRTY_SQL = """
  SELECT event_id,
         CASE WHEN event_id % 13 = 0 THEN '-' WHEN event_id % 17 = 0 THEN 'n/a'
              WHEN event_id % 19 = 0 THEN 'NULL' WHEN event_id % 23 = 0 THEN ''
              WHEN event_id % 29 = 0 THEN '#N/A' WHEN event_id % 31 = 0 THEN ' NA '
              WHEN event_id % 37 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS value_text,
         CASE WHEN event_type = 'error' THEN 'N/A' ELSE event_type END AS type_text,
         CASE WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%d') || ' 2A:00:00'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text,
         props
  FROM events"""
TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in cl.MISSING_TOKENS)


def _std(c):
    return f"CASE WHEN {c} IN ({TOKENS_SQL}) THEN NULL ELSE {c} END"


@query("standardize_missing", f"""
SELECT event_id, {_std('value_text')} AS value_text, {_std('type_text')} AS type_text
FROM ({DIRTY_SQL})""")
def standardize_missing(spark, sf_dir):
    """The 14 missing tokens become NULL; exact match (' NA ' stays)."""
    d = standins.dirty_event_text(spark, sf_dir)
    return cl.standardize_missing(d.select("event_id", "value_text", "type_text"), ["value_text", "type_text"])


@query("missing_token_report", f"""
WITH d AS ({DIRTY_SQL}),
s AS (
  SELECT 'value_text' AS "column", count_if(value_text IS NULL) AS original_nulls,
         count_if(value_text IN ({TOKENS_SQL})) AS converted_missing FROM d
  UNION ALL SELECT 'type_text', count_if(type_text IS NULL), count_if(type_text IN ({TOKENS_SQL})) FROM d
  UNION ALL SELECT 'ts_text', count_if(ts_text IS NULL), count_if(ts_text IN ({TOKENS_SQL})) FROM d
  UNION ALL SELECT 'props', count_if(props IS NULL), count_if(props IN ({TOKENS_SQL})) FROM d)
SELECT "column", original_nulls, converted_missing, original_nulls + converted_missing AS total_nulls
FROM s WHERE converted_missing > 0""")
def missing_token_report(spark, sf_dir):
    """Per text column: nulls before, tokens converted, nulls after (converted > 0 only)."""
    d = standins.dirty_event_text(spark, sf_dir)
    return cl.missing_token_report(d, ["value_text", "type_text", "ts_text", "props"])


@query("lenient_cast", f"""
SELECT event_id, TRY_CAST({_std('value_text')} AS DOUBLE) AS value FROM ({DIRTY_SQL})""")
def lenient_cast(spark, sf_dir):
    """Text to double; anything unparsable becomes NULL."""
    d = cl.standardize_missing(standins.dirty_event_text(spark, sf_dir), ["value_text"])
    return d.select("event_id", cl.lenient_double("value_text").alias("value"))


@query("lenient_timestamp", f"""
SELECT event_id, strftime(TRY_STRPTIME(ts_text, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts
FROM ({DIRTY_SQL})""")
def lenient_timestamp(spark, sf_dir):
    """Timestamp text to timestamp; DST hours written '2A' become NULL."""
    d = standins.dirty_event_text(spark, sf_dir)
    ts = cl.lenient_timestamp("ts_text", "yyyy-MM-dd HH:mm:ss")
    return d.select("event_id", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts"))


LA, LB = standins.LINEITEM_ERAS["price_a_raw"], standins.LINEITEM_ERAS["price_b_raw"]


@query("era_column_select", f"""
WITH f AS (SELECT year(l_shipdate) AS source_year,
                  CASE WHEN year(l_shipdate) BETWEEN {LA[0]} AND {LA[1]} THEN l_extendedprice END AS a,
                  CASE WHEN year(l_shipdate) BETWEEN {LB[0]} AND {LB[1]}
                       THEN l_extendedprice * (1 - l_discount) END AS b
           FROM lineitem)
SELECT CAST(source_year AS BIGINT) AS source_year, count(*) AS n_rows, count(a) AS n_feed_a, count(b) AS n_feed_b,
       {S.r('avg(a)')} AS mean_feed_a, {S.r('avg(b)')} AS mean_feed_b
FROM f GROUP BY source_year""")
def era_column_select(spark, sf_dir):
    """Year-ruled feed choice (feed A in its years, feed B in its years, else NULL)."""
    f = C.select_era_columns(standins.lineitem_feeds(spark, sf_dir), "source_year", standins.LINEITEM_ERAS)
    return (f.groupBy(F.col("source_year").cast("long").alias("source_year"))
            .agg(F.count("*").alias("n_rows"), F.count("price_a_raw").alias("n_feed_a"),
                 F.count("price_b_raw").alias("n_feed_b"), rnd(F.avg("price_a_raw")).alias("mean_feed_a"),
                 rnd(F.avg("price_b_raw")).alias("mean_feed_b")))


@query("structural_break_merge", f"""
SELECT {S.iso('d')} AS date, {S.r('carbonprices_exchange_rate_eur_usd')} AS carbonprices_exchange_rate_eur_usd,
       {S.r('carbonprices_primary_market')} AS carbonprices_primary_market,
       {S.r('carbonprices_secondary_market')} AS carbonprices_secondary_market
FROM ({S.carbon_clean_sql(BREAK)})""")
def structural_break_merge(spark, sf_dir):
    """Before the break date the old column, else the new one (a NULL side stays NULL)."""
    c = C.carbon_clean(standins.carbon_raw(spark, sf_dir), BREAK)
    return c.select(iso_date("date").alias("date"),
                    *[rnd(x).alias(x) for x in c.columns if x != "date"])


@query("all_null_columns", f"""
WITH raw AS ({S.CARBON_RAW})
SELECT "column", non_null, (non_null = 0 OR "column" LIKE 'Unnamed:%') AS junk FROM (
  SELECT 'Date' AS "column", count(d) AS non_null FROM raw
  UNION ALL SELECT 'Exchange rate EUR/USD(<2019)', count(xr_before) FROM raw
  UNION ALL SELECT 'Exchange rate EUR/USD(>2018)', count(xr_after) FROM raw
  UNION ALL SELECT 'Primary Market(<2019)', count(pm_before) FROM raw
  UNION ALL SELECT 'Primary Market(>2018)', count(pm_after) FROM raw
  UNION ALL SELECT 'Secondary Market(>2018)', count(sm_after) FROM raw
  UNION ALL SELECT 'Exchange rate EUR/EUR', count(*) FROM raw
  UNION ALL SELECT 'Market Currency', count(*) FROM raw
  UNION ALL SELECT 'Unnamed: 9', count(CAST(NULL AS VARCHAR)) FROM raw)""")
def all_null_columns(spark, sf_dir):
    """Junk columns of the raw carbon sheet: blank/'Unnamed' headers or all NULL."""
    raw = standins.carbon_raw(spark, sf_dir)
    nn = cl.all_null_columns(raw)
    junk = (F.col("non_null") == 0) | F.col("column").startswith("Unnamed:")
    return nn.select("column", "non_null", junk.alias("junk"))


@query("half_even_round", """
WITH x AS (SELECT floor(value) / 2 AS x FROM events)
SELECT x, CAST(round_even(x, 0) AS BIGINT) AS half_even, CAST(round(x, 0) AS BIGINT) AS half_up,
       count(*) AS n FROM x GROUP BY x""")
def half_even_round(spark, sf_dir):
    """Integer rounding as numpy does (ties to even) next to SQL's half-up."""
    x = table(spark, sf_dir, "events").select((F.floor("value") / 2).alias("x"))
    return x.groupBy("x").agg(half_even_long("x").alias("half_even"),
                              F.round("x", 0).cast("long").alias("half_up"), F.count("*").alias("n"))


@query("calendar_parts", f"""
SELECT DISTINCT {S.base('CAST(o_orderdate AS DATE)', 'daily')} FROM orders""")
def calendar_parts(spark, sf_dir):
    """year, month, quarter, ISO week, month name of every order day."""
    d = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return d.select(*C.base_columns("d", "daily"))


@query("month_floor", f"""
SELECT {S.iso('CAST(o_orderdate AS DATE)')} AS day, {S.iso(S.ms('CAST(o_orderdate AS DATE)'))} AS month_start,
       count(*) AS n_orders
FROM orders GROUP BY ALL""")
def month_floor(spark, sf_dir):
    """Month floor of a day as an ISO string."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return o.groupBy(iso_date("d").alias("day"), cal.month_floor_iso("d").alias("month_start")) \
        .agg(F.count("*").alias("n_orders"))


GERMAN_SQL = "MAP {" + ", ".join(f"{int(v)}: '{k}'" for k, v in cal.GERMAN_MONTHS.items()) + "}"
AUSTRIAN_FIRST = {}
for _k, _v in cal.AUSTRIAN_MONTHS.items():
    AUSTRIAN_FIRST.setdefault(int(_v), _k)
AUSTRIAN_SQL = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in AUSTRIAN_FIRST.items()) + "}"
GAS_SQL = f"""
  SELECT CAST(year(m) AS VARCHAR) || '-' || {GERMAN_SQL}[month(m)] AS Datum,
         avg(l_extendedprice / 1000) AS Monat, avg(l_discount * 100) AS Quartal,
         avg(l_tax * 100) AS Saison, avg(l_quantity) AS Jahr
  FROM (SELECT *, {S.ms('CAST(l_shipdate AS DATE)')} AS m FROM lineitem) GROUP BY m"""
ECON_SQL = f"""
  SELECT {AUSTRIAN_SQL}[month(m)] || '.' || strftime(m, '%y') AS Berichtszeitraum,
         CAST(count(*) AS DOUBLE) AS Auftraege, sum(o_totalprice / 1e6) AS Umsatz,
         CAST(count(DISTINCT o_custkey) AS DOUBLE) AS Kunden
  FROM (SELECT *, {S.ms('CAST(o_orderdate AS DATE)')} AS m FROM orders) GROUP BY m"""
GERMAN_PARSE_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in cal.GERMAN_MONTHS.items()) + "}"
AUSTRIAN_PARSE_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in cal.AUSTRIAN_MONTHS.items()) + "}"


def german_parse_sql(c):
    p = f"string_split({c}, '-')"
    return (f"CASE WHEN len({p}) = 2 AND {GERMAN_PARSE_MAP}[{p}[2]] IS NOT NULL THEN "
            f"TRY_CAST({p}[1] || '-' || {GERMAN_PARSE_MAP}[{p}[2]] || '-01' AS DATE) END")


def austrian_parse_sql(c):
    p = f"string_split(trim({c}), '.')"
    return (f"CASE WHEN len({p}) = 2 THEN TRY_CAST('20' || {p}[2] || '-' || "
            f"coalesce({AUSTRIAN_PARSE_MAP}[{p}[1]], {p}[1]) || '-01' AS DATE) END")


@query("german_month_parse", f"""
SELECT Datum, {S.iso(german_parse_sql('Datum'))} AS month FROM ({GAS_SQL})""")
def german_month_parse(spark, sf_dir):
    """'1997-Mrz' -> 1997-03-01 (unknown month -> NULL)."""
    g = standins.gas_sheet(spark, sf_dir)
    return g.select("Datum", iso_date(cal.parse_german_month("Datum")).alias("month"))


@query("austrian_month_parse", f"""
SELECT Berichtszeitraum, {S.iso(austrian_parse_sql('Berichtszeitraum'))} AS month FROM ({ECON_SQL})""")
def austrian_month_parse(spark, sf_dir):
    """'Mär.97' -> 1997-03-01 (century fixed at 20 as in the source)."""
    e = standins.economy_sheet(spark, sf_dir)
    return e.select("Berichtszeitraum", iso_date(cal.parse_austrian_month("Berichtszeitraum")).alias("month"))


# Sheet footer lines (fixed boilerplate of the export format): a source line, a
# date stamp, and a unit line that has month shape but no valid month.
SHEET_FOOTER = ["Quelle: Sheet export", "Stand: 16.09.2025", "Wert.ab"]


@query("valid_month_rows", f"""
WITH rows_ AS (SELECT Berichtszeitraum AS label FROM ({ECON_SQL})
               UNION ALL SELECT * FROM (VALUES {', '.join(f"('{t}')" for t in SHEET_FOOTER)}) f(label))
SELECT label, {S.iso(austrian_parse_sql('label'))} AS month FROM rows_
WHERE coalesce(regexp_full_match(trim(label), '[^.]{{0,4}}[.][^.]{{2}}'), false)""")
def valid_month_rows(spark, sf_dir):
    """Sheet rows (month rows from the whole orders table plus the sheet's footer
    lines) kept only when the label has month shape; the shape test keeps a
    unit line like 'Wert.ab', whose month then parses to NULL."""
    sheet = standins.economy_sheet(spark, sf_dir).select(F.col("Berichtszeitraum").alias("label"))
    footer = spark.createDataFrame([(t,) for t in SHEET_FOOTER], "label string")
    rows = sheet.unionByName(footer)
    return (rows.filter(cal.is_month_token("label"))
            .select("label", iso_date(cal.parse_austrian_month("label")).alias("month")))


@query("decimal_comma_cast", f"""
WITH t AS (SELECT {S.ms('CAST(l_shipdate AS DATE)')} AS m,
                  replace(printf('%.2f', l_extendedprice), '.', ',') AS txt FROM lineitem)
SELECT {S.iso('m')} AS month, count(TRY_CAST(replace(txt, ',', '.') AS DOUBLE)) AS n_parsed,
       {S.r("sum(TRY_CAST(replace(txt, ',', '.') AS DOUBLE))", 2)} AS total
FROM t GROUP BY m""")
def decimal_comma_cast(spark, sf_dir):
    """Numbers written with a decimal comma parsed back to double."""
    li = table(spark, sf_dir, "lineitem")
    t = li.select(cal.month_start(F.col("l_shipdate").cast("date")).alias("m"),
                  F.regexp_replace(F.format_string("%.2f", "l_extendedprice"), r"\.", ",").alias("txt"))
    v = cl.decimal_comma_double("txt")
    return t.groupBy("m").agg(F.count(v).alias("n_parsed"), rnd(F.sum(v), 2).alias("total")) \
        .select(iso_date("m").alias("month"), "n_parsed", "total")


@query("combined_price", f"""
SELECT date, aggregation_level,
       {S.r('CASE WHEN price_exaa_mean IS NOT NULL AND price_mc_auction_mean IS NOT NULL THEN (price_exaa_mean + price_mc_auction_mean) / 2 ELSE coalesce(price_exaa_mean, price_mc_auction_mean) END')} AS price_combined
FROM ({S.electricity_long_sql(EL_A, EL_B)})""")
def combined_price(spark, sf_dir):
    """Mean of both feeds where both exist, else the one present."""
    e = C.electricity_standin(spark, sf_dir)
    return e.select("date", "aggregation_level",
                    rnd(cl.combined_mean("price_exaa_mean", "price_mc_auction_mean")).alias("price_combined"))


PROD_SQL = f"""
  SELECT {S.ms('CAST(l_shipdate AS DATE)')} AS m,
         CAST(round_even(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0) AS BIGINT) AS prod_flag_a,
         CAST(round_even(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0) AS BIGINT) AS prod_flag_n,
         CAST(round_even(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS BIGINT) AS prod_flag_r,
         CAST(round_even(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 0) AS BIGINT) AS prod_status_f,
         CAST(round_even(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 0) AS BIGINT) AS prod_status_o
  FROM lineitem GROUP BY 1"""
RENEW = ["prod_flag_a", "prod_flag_r"]
NONRENEW = ["prod_flag_n"]


def _nss_sql(cols):
    return (f"CASE WHEN coalesce({', '.join(cols)}) IS NOT NULL THEN "
            + " + ".join(f"coalesce({c}, 0)" for c in cols) + " END")


def _prod_features(spark, sf_dir):
    p = C.production_long(spark, sf_dir)
    return p.select("date", cl.null_safe_sum(RENEW).alias("prod_renewable"),
                    cl.null_safe_sum(NONRENEW).alias("prod_non_renewable"),
                    cl.null_safe_sum(RENEW + NONRENEW).alias("prod_total"))


@query("null_safe_row_sum", f"""
SELECT {S.iso('m')} AS date, CAST({_nss_sql(RENEW)} AS DOUBLE) AS prod_renewable,
       CAST({_nss_sql(NONRENEW)} AS DOUBLE) AS prod_non_renewable,
       CAST({_nss_sql(RENEW + NONRENEW)} AS DOUBLE) AS prod_total
FROM ({PROD_SQL})""")
def null_safe_row_sum(spark, sf_dir):
    """Row sums that are NULL only when every input is NULL (no false zeros)."""
    return _prod_features(spark, sf_dir)


@query("renewable_share", f"""
SELECT {S.iso('m')} AS date,
       {S.r(f"CASE WHEN ({_nss_sql(RENEW + NONRENEW)}) <> 0 THEN ({_nss_sql(RENEW)}) / ({_nss_sql(RENEW + NONRENEW)}) END * 100")} AS prod_renewables_pct_total
FROM ({PROD_SQL})""")
def renewable_share(spark, sf_dir):
    """renewable / total x 100; zero or NULL total gives NULL."""
    p = _prod_features(spark, sf_dir)
    return p.select("date", rnd(cl.share_pct("prod_renewable", "prod_total")).alias("prod_renewables_pct_total"))


SHOCK, POST = "1998-01-01", "1999-04-01"   # reference regimes 2020-01 / 2023-04, shifted onto the order years


@query("regime_dummies", f"""
SELECT DISTINCT {S.iso(S.ms('CAST(o_orderdate AS DATE)'))} AS date,
       CAST({S.ms('CAST(o_orderdate AS DATE)')} >= DATE '{SHOCK}' AND {S.ms('CAST(o_orderdate AS DATE)')} < DATE '{POST}' AS INTEGER) AS regime_shock,
       CAST({S.ms('CAST(o_orderdate AS DATE)')} >= DATE '{POST}' AS INTEGER) AS regime_post
FROM orders""")
def regime_dummies(spark, sf_dir):
    """Shock and post-shock indicator columns per month."""
    m = table(spark, sf_dir, "orders").select(cal.month_start(F.col("o_orderdate").cast("date")).alias("m")).distinct()
    return m.select(iso_date("m").alias("date"), *cal.regime_dummies("m", SHOCK, POST))


# reference windows shifted by -25 years onto the order years
STANDIN_PERIODS = {"all": ("1975-01-01", "2000-12-31"), "main": ("1995-01-01", "2000-12-31"),
                   "corona": ("1995-03-01", "1996-12-31"), "energy_crisis": ("1997-01-01", "1998-12-31")}


def _period_sql(d):
    whens = " ".join(f"WHEN {d} BETWEEN DATE '{STANDIN_PERIODS[n][0]}' AND DATE '{STANDIN_PERIODS[n][1]}' THEN '{n}'"
                     for n in ["corona", "energy_crisis", "main", "all"])
    return f"CASE {whens} END"


@query("period_label", f"""
WITH m AS (SELECT {S.ms('CAST(o_orderdate AS DATE)')} AS m, count(*) AS n FROM orders GROUP BY 1)
SELECT {S.iso('m')} AS date, {_period_sql('m')} AS period, n AS n_orders FROM m""")
def period_label(spark, sf_dir):
    """Named analysis window of each month (most specific first)."""
    m = table(spark, sf_dir, "orders").groupBy(cal.month_start(F.col("o_orderdate").cast("date")).alias("m")) \
        .agg(F.count("*").alias("n_orders"))
    return m.select(iso_date("m").alias("date"), cal.period_label("m", STANDIN_PERIODS).alias("period"), "n_orders")


@query("row_completeness", f"""
WITH {S.carbon_long_ctes(BREAK)}
SELECT date, aggregation_level, data_completeness FROM carbon_long""")
def row_completeness(spark, sf_dir):
    """Share of non-NULL carbon columns per row, percent, one decimal."""
    return C.carbon_standin(spark, sf_dir).select("date", "aggregation_level", "data_completeness")


@query("degree_days", f"""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) / 10000 AS temp FROM orders GROUP BY 1)
SELECT {S.iso(S.ms('d'))} AS date,
       {S.r('sum(CASE WHEN temp <= 15 THEN 18 - temp ELSE 0 END)')} AS hdd,
       {S.r('sum(CASE WHEN temp >= 24 THEN temp - 21 ELSE 0 END)')} AS cdd,
       count(*) AS n_days
FROM t GROUP BY {S.ms('d')}""")
def degree_days(spark, sf_dir):
    """Heating/cooling degree days from a daily mean 'temperature' (order value / 10^4)."""
    o = table(spark, sf_dir, "orders")
    t = o.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg((F.avg("o_totalprice") / 10000).alias("temp"))
    hdd = F.when(F.col("temp") <= 15, 18 - F.col("temp")).otherwise(0)
    cdd = F.when(F.col("temp") >= 24, F.col("temp") - 21).otherwise(0)
    return (t.groupBy(cal.month_start("d").alias("m"))
            .agg(rnd(F.sum(hdd)).alias("hdd"), rnd(F.sum(cdd)).alias("cdd"), F.count("*").alias("n_days"))
            .select(iso_date("m").alias("date"), "hdd", "cdd", "n_days"))


# --- 2.4 filters -----------------------------------------------------------------------

@query("grain_filter", f"""
SELECT * FROM ({S.electricity_long_sql(EL_A, EL_B)}) WHERE aggregation_level = 'weekly'""")
def grain_filter(spark, sf_dir):
    """Rows of one grain: only that grain's bins are made from the day moments."""
    return C.electricity_standin(spark, sf_dir, grains=("weekly",))


@query("time_window_filter", f"""
WITH {S.PANEL_CTES}
SELECT series_id, {S.iso('month')} AS month, {S.r('y')} AS y FROM py
WHERE month BETWEEN DATE '1997-01-01' AND DATE '1999-12-01'""")
def time_window_filter(spark, sf_dir):
    """Closed month window [1997-01, 1999-12]; applied to the raw timestamp so the
    predicate reaches the parquet scan (row-group skipping)."""
    o = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")))
    y = (o.groupBy(F.col("o_orderpriority").alias("series_id"),
                   cal.month_start(F.col("o_orderdate").cast("date")).alias("month"))
         .agg(F.avg(F.col("o_totalprice") / 1000).alias("y")))
    return y.select("series_id", iso_date("month").alias("month"), rnd("y").alias("y"))


@query("overlap_rows", f"""
SELECT date, aggregation_level, price_exaa_mean, price_mc_auction_mean
FROM ({S.electricity_long_sql(EL_A, EL_B)})
WHERE price_exaa_mean IS NOT NULL AND price_mc_auction_mean IS NOT NULL""")
def overlap_rows(spark, sf_dir):
    """Rows where both feeds are present."""
    e = C.electricity_standin(spark, sf_dir)
    return e.filter(F.col("price_exaa_mean").isNotNull() & F.col("price_mc_auction_mean").isNotNull()) \
        .select("date", "aggregation_level", "price_exaa_mean", "price_mc_auction_mean")


@query("train_test_split", f"""
WITH {S.PANEL_CTES}
SELECT CASE WHEN month <= DATE '1999-12-01' THEN 'train'
            WHEN month BETWEEN DATE '2000-01-01' AND DATE '2001-06-01' THEN 'test' END AS split,
       series_id, count(*) AS n_months, {S.iso('min(month)')} AS first_month, {S.iso('max(month)')} AS last_month
FROM panel GROUP BY ALL""")
def train_test_split(spark, sf_dir):
    """Temporal split: train <= 1999-12, test 2000-01..2001-06 (18 months)."""
    p = monthly_panel(spark, sf_dir).withColumn("split", split_label())
    return p.groupBy("split", "series_id").agg(F.count("*").alias("n_months"),
                                               iso_date(F.min("month")).alias("first_month"),
                                               iso_date(F.max("month")).alias("last_month"))


@query("complete_cases", f"""
WITH {S.PANEL_CTES}
SELECT series_id, count(*) AS n_rows, count_if(y IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL) AS n_complete
FROM panel GROUP BY series_id""")
def complete_cases(spark, sf_dir):
    """Rows with target and every chosen regressor present (x and y share a row)."""
    whole = F.col("y").isNotNull() & F.col("x1").isNotNull() & F.col("x2").isNotNull()
    return monthly_panel(spark, sf_dir).groupBy("series_id").agg(F.count("*").alias("n_rows"),
                                                                 F.count_if(whole).alias("n_complete"))


@query("month_slice_count", """
SELECT CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS n_rows, count(DISTINCT CAST(l_shipdate AS DATE)) AS n_days
FROM lineitem WHERE month(l_shipdate) = 3 GROUP BY 1""")
def month_slice_count(spark, sf_dir):
    """Readings and distinct days in March of each year (delivery-date check)."""
    li = table(spark, sf_dir, "lineitem").filter(F.month("l_shipdate") == 3)
    return li.groupBy(F.year("l_shipdate").cast("long").alias("year")).agg(
        F.count("*").alias("n_rows"), F.countDistinct(F.col("l_shipdate").cast("date")).alias("n_days"))


@query("sampled_scan", f"""
WITH rd AS ({S.ELEC_READINGS.format(a_lo=EL_A[0], a_hi=EL_A[1], b_lo=EL_B[0], b_hi=EL_B[1])})
SELECT CAST(source_year AS BIGINT) AS source_year, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp,
       price_exaa_raw, price_mc_raw,
       CAST(row_number() OVER (PARTITION BY source_year ORDER BY timestamp, price_exaa_raw, price_mc_raw) AS BIGINT) AS rn
FROM rd QUALIFY rn <= 5""")
def sampled_scan(spark, sf_dir):
    """First five readings of each yearly file, for structure profiling: only the hours
    that hold them are read and sorted."""
    r = C.select_era_columns(standins.electricity_readings(spark, sf_dir), "source_year", standins.ELECTRICITY_ERAS)
    from ..operators.quality import first_hours, first_k_by, in_hours
    from .materialize import reading_hours_table
    early = first_hours(reading_hours_table(spark, sf_dir), "source_year", ["n_rows"], 5)
    s = first_k_by(in_hours(r, "timestamp", early), ["source_year"], [F.col("timestamp"), F.col("price_exaa_raw"), F.col("price_mc_raw")], 5)
    return s.select(F.col("source_year").cast("long").alias("source_year"),
                    F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
                    "price_exaa_raw", "price_mc_raw", F.col("rn").cast("long").alias("rn"))
