"""Raw-source stand-ins derived from the driver tables.

The reference ingests six external files (15-minute prices, daily carbon,
monthly climate / production / gas / economy). The driver ships TPC-H-like
tables instead; each function below derives a DataFrame with the *shape* of
one raw source from them, so every pipeline runs over whole tables and its

  electricity  events: feed A (EXAA) = value of 'view', feed B (MC) = 'click'
  carbon       orders per order day; columns before/after a structural break
  climate      orders per month x o_orderstatus (indicator) x o_orderpriority (geo)
  production   lineitem per ship month, quantity by return flag / line status
  gas          lineitem per ship month, German month labels ("1997-Mrz")
  economy      orders per order month, Austrian month labels ("Mär.97")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import austrian_month_label, german_month_label, month_start
from .tables import table

# Stand-in parameters (the reference values are the defaults of the operators).
CARBON_BREAK_DATE = "1998-01-01"   # reference: 2019-01-07
# Events carry 2024 only; both feeds are taken as valid there, as in the
# reference's 2020-2022 overlap years (reference eras: A 2015-2022, B 2020-2025).
ELECTRICITY_ERAS = {"price_exaa_raw": (2015, 2025), "price_mc_raw": (2020, 2025)}
# Year rules of the reference shifted by -20 years onto lineitem ship years.
LINEITEM_ERAS = {"price_a_raw": (1995, 2002), "price_b_raw": (2000, 2005)}
CLIMATE_INDICATORS = ["F", "O", "P"]
CLIMATE_GEOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]


def electricity_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(timestamp, source_year, price_exaa_raw, price_mc_raw) per reading."""
    e = table(spark, sf_dir, "events")   # readings without a price count for the span of bins too
    return e.select(
        F.col("ts").alias("timestamp"),
        F.year("ts").alias("source_year"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("price_exaa_raw"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("price_mc_raw"),
    )


def dirty_event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with text fields carrying missing tokens (raw CSV shape).

    ``value_text`` is the reading as text, replaced by a missing token on a
    fixed arithmetic pattern of ``event_id``; ``type_text`` keeps the type but
    writes 'error' as 'N/A'. Every row of the table is kept."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    value_text = (F.when(k % 13 == 0, F.lit("-")).when(k % 17 == 0, F.lit("n/a"))
                  .when(k % 19 == 0, F.lit("NULL")).when(k % 23 == 0, F.lit(""))
                  .when(k % 29 == 0, F.lit("#N/A")).when(k % 31 == 0, F.lit(" NA "))
                  .when(k % 37 == 0, F.lit("bad"))
                  .otherwise(F.col("value").cast("string")))
    type_text = F.when(F.col("event_type") == "error", F.lit("N/A")).otherwise(F.col("event_type"))
    ts_text = F.when(k % 41 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 2A:00:00"))) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", value_text.alias("value_text"), type_text.alias("type_text"),
                    ts_text.alias("ts_text"), F.col("props"))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and count of order values by day, status and priority: what the carbon and climate sheets
    are made of, in one scan of ``orders``."""
    return (table(spark, sf_dir, "orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus", "o_orderpriority")
            .agg(F.sum("o_totalprice").alias("total"), F.count("o_totalprice").alias("n")))


def _mean(scale: float, when=None):
    total, n = (F.col(c) if when is None else F.when(when, F.col(c)) for c in ("total", "n"))
    return F.sum(total) / scale / F.nullif(F.sum(n), F.lit(0))


def carbon_sheet(days: DataFrame) -> DataFrame:
    """The carbon sheet with the raw header names of the source, from ``order_days``."""
    s, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (days.groupBy(F.col("day").alias("Date"))
            .agg(_mean(100000, s == "F").alias("Exchange rate EUR/USD(<2019)"),
                 _mean(100000, s == "O").alias("Exchange rate EUR/USD(>2018)"),
                 _mean(1000, pr == "1-URGENT").alias("Primary Market(<2019)"),
                 _mean(1000, pr == "2-HIGH").alias("Primary Market(>2018)"),
                 _mean(1000, pr == "3-MEDIUM").alias("Secondary Market(>2018)"),
                 F.lit(1.0).alias("Exchange rate EUR/EUR"),
                 F.lit("EUR").alias("Market Currency"),
                 F.lit(None).cast("string").alias("Unnamed: 9")))


def carbon_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily carbon-market observations with the raw header names of the source."""
    return carbon_sheet(order_days(spark, sf_dir))


def climate_triples(days: DataFrame) -> DataFrame:
    """The climate triples from ``order_days``."""
    return (days.groupBy(F.date_format("day", "yyyy-MM").alias("TIME_PERIOD"),
                         F.col("o_orderstatus").alias("indic_nrg"), F.col("o_orderpriority").alias("geo"))
            .agg(_mean(1000).alias("OBS_VALUE")))


def climate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eurostat-style long triples (TIME_PERIOD 'yyyy-MM', indic_nrg, geo, OBS_VALUE)."""
    return climate_triples(order_days(spark, sf_dir))


def shipped_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every monthly measure of the production and gas sheets, in one scan of ``lineitem``. A sheet made
    from this reads its own columns only, as Catalyst drops the other sheet's measures."""
    q, m = F.col("l_quantity"), month_start("l_shipdate")
    aggs = [F.sum(F.when(F.col("l_returnflag") == f, q)).alias(f"prod_flag_{f.lower()}") for f in RETURN_FLAGS]
    aggs += [F.sum(F.when(F.col("l_linestatus") == s, q)).alias(f"prod_status_{s.lower()}") for s in LINE_STATUSES]
    # The label is built from an aggregate result (min of the month) rather than
    # the grouping key, so a later filter on the parsed label cannot be pushed
    # below the aggregate onto every raw row.
    aggs += [F.min(m).alias("m"), F.avg(F.col("l_extendedprice") / 1000).alias("Monat"),
             F.avg(F.col("l_discount") * 100).alias("Quartal"), F.avg(F.col("l_tax") * 100).alias("Saison"),
             F.avg("l_quantity").alias("Jahr")]
    return table(spark, sf_dir, "lineitem").groupBy(m.alias("month")).agg(*aggs)


def production_sheet(months: DataFrame) -> DataFrame:
    return months.select("month", *[c for c in months.columns if c.startswith("prod_")])


def production_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly generation-mix stand-in: quantity per return flag and line status."""
    return production_sheet(shipped_months(spark, sf_dir))


def gas_labels(months: DataFrame) -> DataFrame:
    return months.select(german_month_label("m").alias("Datum"), "Monat", "Quartal", "Saison", "Jahr")


def gas_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly gas price index stand-in with German month labels in ``Datum``."""
    return gas_labels(shipped_months(spark, sf_dir))


def economy_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly economy stand-in with Austrian month labels in ``Berichtszeitraum``."""
    o = table(spark, sf_dir, "orders")
    m = month_start("o_orderdate")
    agg = (o.groupBy(m.alias("g"))
           .agg(F.min(m).alias("m"),
                F.count("*").cast("double").alias("Auftraege"),
                F.sum(F.col("o_totalprice") / 1e6).alias("Umsatz"),
                F.countDistinct("o_custkey").cast("double").alias("Kunden")))
    return agg.select(austrian_month_label("m").alias("Berichtszeitraum"), "Auftraege", "Umsatz", "Kunden")


def lineitem_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two price feeds per line for the year-ruled column choice."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.year("l_shipdate").alias("source_year"),
                     F.col("l_shipdate").cast("date").alias("day"),
                     F.col("l_extendedprice").alias("price_a_raw"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price_b_raw"))
