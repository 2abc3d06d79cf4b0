"""Source pipelines and the consolidated wide table.

Each pipeline turns one raw source into long format keyed by
(date, aggregation_level): ``date`` is an ISO ``yyyy-MM-dd`` string as in the
reference output, followed by calendar parts of the bin label and the
source's prefixed column family. Everything stays lazy; one write at the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import (EXPECTED_INTERVALS, GRAINS, calendar_parts, parse_austrian_month,
                                  parse_german_month, is_month_token)
from ..functions.cleaning import (columns_with_prefix, combined_mean, normalize_header, null_safe_sum,
                                  row_completeness, share_pct, structural_break)
from ..functions.numeric import half_even_long, iso_date
from ..operators.merge import consolidate
from ..operators.resample import daily_moments, resample_mean_family, rollup_days
from ..sources import standins

# Reference year rules: EXAA feed 2015-2022, MC feed 2020-2025.
REFERENCE_ERAS = {"price_exaa_raw": (2015, 2022), "price_mc_raw": (2020, 2025)}
REFERENCE_CARBON_BREAK = "2019-01-07"


def base_columns(date_col: str = "date", level: str | None = None) -> list:
    """ISO date string, calendar parts of the bin label, grain, English month name."""
    d = f"`{date_col}`"
    lvl = f"'{level}'" if level else "aggregation_level"
    return [F.expr(e) for e in (
        f"date_format({d}, 'yyyy-MM-dd') AS date", f"CAST(year({d}) AS BIGINT) AS year",
        f"CAST(month({d}) AS BIGINT) AS month", f"CAST(quarter({d}) AS BIGINT) AS quarter",
        f"CAST(weekofyear({d}) AS BIGINT) AS week", f"{lvl} AS aggregation_level",
        f"date_format({d}, 'MMMM') AS month_name")]


def select_era_columns(df: DataFrame, year_col: str, eras: Mapping[str, tuple]) -> DataFrame:
    """Year-ruled feed choice: a feed is kept only inside its year range, else NULL."""
    out = []
    for c in df.columns:
        if c in eras:
            lo, hi = eras[c]
            out.append(F.when(F.col(year_col).between(lo, hi), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def electricity_long(readings: DataFrame, eras: Mapping[str, tuple] = REFERENCE_ERAS,
                     merge_years: bool = False, week_mode: str = "w-mon", grains: Sequence[str] = GRAINS) -> DataFrame:
    """15-minute two-feed readings -> daily/weekly/monthly means, counts, completeness.

    Bins are made per ``source_year`` (one file per year in the reference), so
    a week over New Year yields two rows with the same key unless
    ``merge_years``."""
    feeds = ["price_exaa_raw", "price_mc_raw"]
    r = select_era_columns(readings, "source_year", eras)
    keys = () if merge_years else ("source_year",)
    days = daily_moments(r, "timestamp", feeds, keys)
    agg = rollup_days(days, feeds, keys, grains, week_mode=week_mode)
    expected = (F.when(F.col("aggregation_level") == "daily", EXPECTED_INTERVALS["daily"])
                .when(F.col("aggregation_level") == "weekly", EXPECTED_INTERVALS["weekly"])
                .otherwise(EXPECTED_INTERVALS["monthly"]))
    total = F.col("price_exaa_raw_count") + F.col("price_mc_raw_count")
    return agg.select(
        *base_columns(),
        half_even_long("price_exaa_raw_mean").alias("price_exaa_mean"),
        half_even_long("price_mc_raw_mean").alias("price_mc_auction_mean"),
        F.col("price_exaa_raw_count").alias("price_count_exaa"),
        F.col("price_mc_raw_count").alias("price_count_mc"),
        F.bround(total / expected * 100, 1).alias("data_completeness"),
    )


def carbon_clean(raw: DataFrame, break_date: str = REFERENCE_CARBON_BREAK,
                 date_col: str = "Date") -> DataFrame:
    """Structural-break merge, drop constant/junk columns, prefix headers."""
    d = F.col(date_col).cast("date")
    pairs = {"Exchange rate EUR/USD": ("Exchange rate EUR/USD(<2019)", "Exchange rate EUR/USD(>2018)"),
             "Primary Market": ("Primary Market(<2019)", "Primary Market(>2018)")}
    cols = [d.alias("date")]
    for name, (before, after) in pairs.items():
        cols.append(structural_break(d, F.col(f"`{before}`"), F.col(f"`{after}`"), break_date).alias(name))
    cols.append(F.col("`Secondary Market(>2018)`").alias("Secondary Market"))
    out = raw.select(*cols)
    return out.select("date", *[F.col(f"`{c}`").alias(normalize_header(c, "carbonprices_"))
                                for c in out.columns if c != "date"])


def carbon_long(raw: DataFrame, break_date: str = REFERENCE_CARBON_BREAK,
                week_mode: str = "w-mon") -> DataFrame:
    """Daily rows are the raw observations; weekly and monthly are means with gap bins.
    Market prices are rounded half-even to integers, exchange rates stay double."""
    clean = carbon_clean(raw, break_date)
    family = columns_with_prefix(clean, "carbonprices_")
    prices = [c for c in family if "market" in c]
    daily = clean.select("date", F.lit("daily").alias("aggregation_level"), *family)
    coarse = resample_mean_family(clean, "date", family, ("weekly", "monthly"), week_mode=week_mode)
    both = daily.unionByName(coarse)
    fam_out = [half_even_long(c).alias(c) if c in prices else F.col(c) for c in family]
    return both.select(*base_columns(), *fam_out,
                       row_completeness(family).alias("data_completeness"))


def pivot_values(long: DataFrame, key, names: Sequence[str], most: int = 2000) -> list[tuple]:
    """The values that a pivot on ``names`` turns into columns, sorted: found by one aggregate that also
    counts rows a cell, so a cell with two rows fails here instead of losing one. More than ``most``
    columns (or none) is a fault too."""
    cells = long.groupBy(key.alias("_key"), *names).agg(F.count("*").alias("_n"))
    found = cells.groupBy(*names).agg(F.max("_n").alias("_most")).orderBy(*names).limit(most + 1).collect()
    twice = [tuple(r[n] for n in names) for r in found if r["_most"] > 1]
    if twice or not 0 < len(found) <= most:
        raise ValueError(f"two values for one cell of {twice}" if twice else f"{len(found)} columns from {names}")
    return [tuple(r[n] for n in names) for r in found]


def climate_wide(long: DataFrame, indicators: Sequence[str] | None, geos: Sequence[str],
                 prefix: str = "climate_") -> DataFrame:
    """Long (TIME_PERIOD, indic_nrg, geo, OBS_VALUE) -> one column per indicator and geography.

    One group-by (no pivot per geography, no join). Geographies are a choice.
    ``indicators`` None: those that the data hold, found first. Listed ones are a
    contract: an indicator that is not listed fails the job. So do two rows for one
    month, indicator and geography, instead of one being lost."""
    month = F.to_date("TIME_PERIOD", "yyyy-MM")
    here = F.col("geo").isin(list(geos))
    if indicators is None:
        found = pivot_values(long.filter(here & F.col("indic_nrg").isNotNull()), month, ["geo", "indic_nrg"])
        pairs = sorted(((i, g) for g, i in found), key=lambda p: (list(geos).index(p[1]), p[0]))
        indicators = sorted({i for i, _ in pairs})
    else:
        pairs = [(i, g) for g in geos for i in indicators]
    cols, twice = [], F.lit(False)
    for i, g in pairs:
        hit = (F.col("indic_nrg") == i) & (F.col("geo") == g)
        cols.append(F.max(F.when(hit, F.col("OBS_VALUE"))).alias(normalize_header(f"{i}_{g}", prefix)))
        twice = twice | (F.count_if(hit) > 1)
    unlisted = F.max(F.when(here & ~F.col("indic_nrg").isin(list(indicators)), F.col("indic_nrg")))
    wide = long.groupBy(month.alias("month")).agg(*cols, twice.alias("_twice"), unlisted.alias("_unlisted"))
    fault = F.when(F.col("_twice"), F.raise_error(F.lit("two climate values for one month, indicator and geography"))) \
        .when(F.col("_unlisted").isNotNull(), F.raise_error(F.concat(F.lit("unlisted climate indicator "), F.col("_unlisted"))))
    return wide.withColumn("month", F.coalesce(fault.cast("date"), F.col("month"))).drop("_twice", "_unlisted")


def monthly_long(df: DataFrame, month_col: str, family: Sequence[str]) -> DataFrame:
    return df.select(*base_columns(month_col, "monthly"), *family)


def climate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .materialize import order_days_table
    wide = climate_wide(standins.climate_triples(order_days_table(spark, sf_dir)), standins.CLIMATE_INDICATORS,
                        standins.CLIMATE_GEOS)
    return monthly_long(wide, "month", [c for c in wide.columns if c != "month"])


def production_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .materialize import shipped_months_table
    p = standins.production_sheet(shipped_months_table(spark, sf_dir))
    fam = [c for c in p.columns if c.startswith("prod_")]
    return p.select(*base_columns("month", "monthly"), *[half_even_long(c).alias(c) for c in fam])


def gas_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .materialize import shipped_months_table
    g = standins.gas_labels(shipped_months_table(spark, sf_dir))
    ren = {"Monat": "oegpi_month", "Quartal": "oegpi_quarter", "Saison": "oegpi_season", "Jahr": "oegpi_year"}
    g = g.select(parse_german_month("Datum").alias("month"), *[F.col(k).alias(v) for k, v in ren.items()])
    return monthly_long(g.filter(F.col("month").isNotNull()), "month", list(ren.values()))


def economy_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = standins.economy_sheet(spark, sf_dir)
    ren = {"Auftraege": "econ_count_orders", "Umsatz": "econ_turnover_total", "Kunden": "econ_count_customers"}
    e = (e.filter(is_month_token("Berichtszeitraum"))
         .select(parse_austrian_month("Berichtszeitraum").alias("month"),
                 *[F.col(k).alias(v) for k, v in ren.items()]))
    return monthly_long(e, "month", list(ren.values()))


def electricity_standin(spark: SparkSession, sf_dir: str, merge_years: bool = False,
                        grains: Sequence[str] = GRAINS) -> DataFrame:
    return electricity_long(standins.electricity_readings(spark, sf_dir),
                            standins.ELECTRICITY_ERAS, merge_years, grains=grains)


def carbon_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .materialize import carbon_raw_table
    return carbon_long(carbon_raw_table(spark, sf_dir), standins.CARBON_BREAK_DATE)


def all_sources(spark: SparkSession, sf_dir: str, merge_years: bool = False) -> list[DataFrame]:
    return [electricity_standin(spark, sf_dir, merge_years), carbon_standin(spark, sf_dir),
            climate_long(spark, sf_dir), production_long(spark, sf_dir),
            gas_long(spark, sf_dir), economy_long(spark, sf_dir)]


def merge_sources(srcs: Sequence[DataFrame], how: str = "join", n_repeatable: int = 2) -> DataFrame:
    """Merge long source tables (in precedence order) on (date, aggregation_level).

    ``how='join'`` keeps the faithful full-outer-join semantics for the first
    ``n_repeatable`` sources, whose keys can repeat (electricity weeks over New
    Year per yearly file, raw carbon days). The remaining sources are keyed by
    their own group-by, so their keys are unique by construction: they are
    merged join-free (one union + one group-by) into a block that then joins
    like a single source. Left-first precedence is the same as in a plain
    chain of full outer joins. ``how='union'`` merges everything join-free."""
    if how == "union" or len(srcs) <= n_repeatable + 1:
        return consolidate(list(srcs), how=how)
    block = consolidate(list(srcs[n_repeatable:]), how="union")
    return consolidate([*srcs[:n_repeatable], block], how="join")


def consolidated(spark: SparkSession, sf_dir: str, how: str = "join") -> DataFrame:
    """The wide table: six sources merged on (date, aggregation_level)."""
    return merge_sources(all_sources(spark, sf_dir, merge_years=(how == "union")), how)


# Columns that the analysis-ready table leaves out.
ANALYSIS_DROPPED = (
    "price_exaa_mean", "price_mc_auction_mean", "price_count_exaa", "price_count_mc", "data_completeness",
    "carbonprices_secondary_market", "prod_geothermal_total", "econ_turnover_industry", "econ_prod_index_industry",
    "econ_turnover_index_commercial_sales", "econ_prod_index_construction", "econ_turnover_index_construction",
    "econ_count_employees_industry", "econ_count_employees_construction", "econ_turnover_index_wholesale",
    "econ_total_production_construction", "econ_turnover_construction", "econ_turnover_index_retail",
    "econ_count_employees_retail", "econ_turnover_index_car_retail")
# The families that are summed.
RENEWABLE = ("prod_hydropower_production_total", "prod_renewable_bio_production", "prod_renewable_SoBio_production",
             "prod_wind_total", "prod_pv_total")
NON_RENEWABLE = ("prod_fossil_subtotal_production", "prod_other_fuels_production")


def finalised(cons: DataFrame) -> DataFrame:
    """The consolidated table with ``date_dt``, its key as a date."""
    return cons.withColumn("date_dt", F.to_date("date", "yyyy-MM-dd"))


def analysis_ready(cons: DataFrame) -> DataFrame:
    """Rows with a target: combined price, production sums and shares, without the columns that
    other columns cover or that have too few values."""
    out = cons.withColumn("price_combined", combined_mean("price_exaa_mean", "price_mc_auction_mean"))
    out = out.filter(F.col("price_combined").isNotNull())
    out = out.withColumn("prod_renewable", null_safe_sum(RENEWABLE)).withColumn("prod_non_renewable", null_safe_sum(NON_RENEWABLE))
    out = out.withColumn("prod_total", null_safe_sum(("prod_renewable", "prod_non_renewable")))
    return out.withColumn("prod_renewables_pct_total", share_pct("prod_renewable", "prod_total")).drop(*ANALYSIS_DROPPED)
