import datetime as dt

from pyspark.sql import functions as F

from wattle.operators.resample import resample
from wattle.plans.consolidate import REFERENCE_ERAS, carbon_long, electricity_long

TS = "timestamp_ntz"


def _readings(spark, rows):
    df = spark.createDataFrame(rows, "ts string, source_year int, a double, b double")
    return df.select(F.to_timestamp("ts").cast(TS).alias("timestamp"), "source_year",
                     F.col("a").alias("price_exaa_raw"), F.col("b").alias("price_mc_raw"))


def test_wmon_bins_gap_rows_and_completeness(spark):
    rows = [
        ("2020-01-05 10:00:00", 2020, 1.0, 3.0),   # Sunday -> bin Mon 2020-01-06
        ("2020-01-06 00:00:00", 2020, 2.0, None),  # Monday 00:00 -> same bin
        ("2020-01-06 23:45:00", 2020, 3.0, None),  # Monday 23:45 -> same bin
        ("2020-01-07 00:00:00", 2020, 2.5, 2.5),   # Tuesday -> next bin 2020-01-13
        ("2020-01-11 12:00:00", 2020, 0.5, None),  # after a three-day hole (8, 9, 10)
    ]
    out = electricity_long(_readings(spark, rows), REFERENCE_ERAS).collect()
    daily = {r.date: r for r in out if r.aggregation_level == "daily"}
    weekly = {r.date: r for r in out if r.aggregation_level == "weekly"}
    assert sorted(daily) == [f"2020-01-{d:02d}" for d in range(5, 12)]
    for d in ("2020-01-08", "2020-01-09", "2020-01-10"):
        assert daily[d].price_exaa_mean is None and daily[d].price_count_exaa == 0
        assert daily[d].data_completeness == 0.0
    assert sorted(weekly) == ["2020-01-06", "2020-01-13"]
    w = weekly["2020-01-06"]
    assert (w.price_count_exaa, w.price_count_mc, w.price_exaa_mean) == (3, 1, 2)
    # (3 + 1) / 672 * 100 = 0.595... -> 0.6
    assert w.data_completeness == 0.6
    assert daily["2020-01-06"].price_exaa_mean == 2    # mean 2.5 rounds half-even to 2
    assert daily["2020-01-07"].price_exaa_mean == 2 and daily["2020-01-07"].price_mc_auction_mean == 2
    assert daily["2020-01-11"].price_exaa_mean == 0    # 0.5 -> 0


def test_year_rules_choose_feeds(spark):
    rows = [("2019-06-01 00:00:00", 2019, 10.0, 20.0), ("2020-06-01 00:00:00", 2020, 10.0, 20.0),
            ("2023-06-01 00:00:00", 2023, 10.0, 20.0)]
    out = {(r.date, r.aggregation_level): r for r in electricity_long(_readings(spark, rows), REFERENCE_ERAS).collect()}
    assert out[("2019-06-01", "daily")].price_mc_auction_mean is None      # MC only from 2020
    assert out[("2020-06-01", "daily")].data_completeness == round(2 / 96 * 100, 1)
    assert out[("2023-06-01", "daily")].price_exaa_mean is None            # EXAA only to 2022


def test_new_year_week_duplicates_unless_merged(spark):
    rows = [("2019-12-31 00:00:00", 2019, 1.0, 1.0), ("2020-01-02 00:00:00", 2020, 3.0, 3.0)]
    r = _readings(spark, rows)
    weekly = [x for x in electricity_long(r, REFERENCE_ERAS).collect() if x.aggregation_level == "weekly"]
    assert [x.date for x in weekly] == ["2020-01-06", "2020-01-06"]        # one per yearly file
    merged = [x for x in electricity_long(r, REFERENCE_ERAS, merge_years=True).collect() if x.aggregation_level == "weekly"]
    assert len(merged) == 1 and merged[0].price_count_exaa == 2


def test_day_sums_equal_month_sums(spark):
    from wattle.sources.standins import electricity_readings
    from tests.conftest import SF_SMALL
    r = electricity_readings(spark, SF_SMALL)
    out = resample(r, "timestamp", ["price_exaa_raw"], grains=("daily", "monthly"), gap_fill=False)
    tot = {lvl: n for lvl, n in out.groupBy("aggregation_level").agg(F.sum("price_exaa_raw_count")).collect()}
    assert tot["daily"] == tot["monthly"] == r.filter(F.col("price_exaa_raw").isNotNull()).count()


def test_carbon_daily_raw_weekly_mean_with_gap(spark):
    raw = spark.createDataFrame([
        ("2019-01-04", 1.10, None, 10.0, None, None, 1.0, "EUR", None),
        ("2019-01-07", None, 1.20, 99.0, 12.4, 5.0, 1.0, "EUR", None),
        ("2019-01-22", None, 1.30, None, 13.6, None, 1.0, "EUR", None),
    ], "Date string, `Exchange rate EUR/USD(<2019)` double, `Exchange rate EUR/USD(>2018)` double, "
       "`Primary Market(<2019)` double, `Primary Market(>2018)` double, `Secondary Market(>2018)` double, "
       "`Exchange rate EUR/EUR` double, `Market Currency` string, `Unnamed: 9` string")
    out = {(r.date, r.aggregation_level): r for r in carbon_long(raw).collect()}
    d = out[("2019-01-07", "daily")]
    assert (d.carbonprices_exchange_rate_eur_usd, d.carbonprices_primary_market) == (1.2, 12)
    assert d.data_completeness == 100.0
    assert out[("2019-01-04", "daily")].carbonprices_primary_market == 10
    # weekly bins 2019-01-07, 2019-01-14 (empty), 2019-01-21 (empty), 2019-01-28
    wk = sorted(k[0] for k in out if k[1] == "weekly")
    assert wk == ["2019-01-07", "2019-01-14", "2019-01-21", "2019-01-28"]
    assert out[("2019-01-14", "weekly")].carbonprices_primary_market is None
    assert out[("2019-01-07", "weekly")].carbonprices_exchange_rate_eur_usd == (1.10 + 1.20) / 2


def test_many_series_are_dealt_to_all_tasks(spark):
    """Small compressed shuffles hold many day rows: they must not be merged into one task."""
    df = spark.range(2_000).selectExpr("id % 500 AS user", "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id / 500) * 3) AS ts",
                                       "1.0D AS v")
    out = resample(df, "ts", ["v"], ("user",), ("daily", "weekly"))
    tasks = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum("v_count").alias("c")).collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r.n for r in tasks) == 500 * (10 + 3) and sum(r.c for r in tasks) == 2 * 2_000
