import datetime as dt
import math
from statistics import NormalDist

from pyspark.sql import functions as F

from wattle.functions import calendar as cal
from wattle.functions import cleaning as cl
from wattle.functions.numeric import chi2_sf_even, half_even_long, normal_quantile, normal_sf


def test_missing_tokens_exact_match(spark):
    vals = cl.MISSING_TOKENS + [" NA ", "12.5", None, "n.a."]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r.s for r in cl.standardize_missing(df).collect()]
    assert out[:14] == [None] * 14
    assert out[14:] == [" NA ", "12.5", None, "n.a."]
    extra = [r.s for r in cl.standardize_missing(df, extra=["n.a."]).collect()]
    assert extra[-1] is None


def test_missing_token_report_counts(spark):
    df = spark.createDataFrame([("-", None), ("1", "NULL"), (None, "x"), ("NaN", "y")], "a string, b string")
    rep = {r.column: (r.original_nulls, r.converted_missing, r.total_nulls) for r in cl.missing_token_report(df).collect()}
    assert rep == {"a": (1, 2, 3), "b": (1, 1, 2)}


def test_lenient_casts(spark):
    df = spark.createDataFrame([("12.5", "12,5", "2020-03-29 02:00:00"), ("bad", "1.234,5", "2020-10-25 2A:00:00")],
                               "a string, b string, t string")
    r = df.select(cl.lenient_double("a").alias("a"), cl.decimal_comma_double("b").alias("b"),
                  cl.lenient_timestamp("t").alias("t")).collect()
    assert r[0].a == 12.5 and r[0].b == 12.5 and r[0].t is not None
    assert r[1].a is None and r[1].b is None and r[1].t is None


def test_week_ending_monday(spark):
    days = ["2015-01-04", "2015-01-05", "2015-01-06", "2014-12-30"]   # Sun, Mon, Tue, Tue
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    out = [r.w.isoformat() for r in df.select(cal.week_ending_monday("d").alias("w")).collect()]
    assert out == ["2015-01-05", "2015-01-05", "2015-01-12", "2015-01-05"]


def test_half_even_vs_half_up(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (None,)], "x double")
    r = df.select(half_even_long("x").alias("e"), F.round("x").cast("long").alias("u")).collect()
    assert [x.e for x in r] == [0, 2, 2, -2, None]
    assert [x.u for x in r] == [1, 2, 3, -3, None]


def test_structural_break_is_not_coalesce(spark):
    df = spark.createDataFrame([("2019-01-06", None, 2.0), ("2019-01-07", 1.0, None), ("2019-01-08", 1.0, 3.0)],
                               "d string, before double, after double").withColumn("d", F.to_date("d"))
    out = [r.v for r in df.select(cl.structural_break("d", "before", "after", "2019-01-07").alias("v")).collect()]
    assert out == [None, None, 3.0]


def test_null_safe_sum_and_share(spark):
    df = spark.createDataFrame([(None, None), (0.0, None), (2.0, 3.0)], "a double, b double")
    r = df.select(cl.null_safe_sum(["a", "b"]).alias("s"), cl.share_pct("a", "b").alias("p"),
                  cl.combined_mean("a", "b").alias("m")).collect()
    assert [x.s for x in r] == [None, 0.0, 5.0]
    assert r[2].p == 2.0 / 3.0 * 100 and r[0].p is None
    assert [x.m for x in r] == [None, 0.0, 2.5]


def test_row_completeness_one_decimal(spark):
    df = spark.createDataFrame([(1.0, None, None), (1.0, 1.0, None), (None, None, None)], "a double, b double, c double")
    assert [r.c for r in df.select(cl.row_completeness(["a", "b", "c"]).alias("c")).collect()] == [33.3, 66.7, 0.0]


def test_german_month_parse(spark):
    df = spark.createDataFrame([("2020-Mrz",), ("2020-Xyz",), (None,), ("2021-Dez",), ("2020-Mrz-1",)], "s string")
    out = [r.d for r in df.select(cal.parse_german_month("s").alias("d")).collect()]
    assert out == [dt.date(2020, 3, 1), None, None, dt.date(2021, 12, 1), None]


def test_austrian_month_parse_and_shape(spark):
    vals = ["Jän.09", "01.09", "Mär.25", "Sept.25", "Quelle: Statistik", "a.b.cc", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    r = df.select(cal.parse_austrian_month("s").alias("d"), cal.is_month_token("s").alias("ok")).collect()
    assert [x.d for x in r[:3]] == [dt.date(2009, 1, 1), dt.date(2009, 1, 1), dt.date(2025, 3, 1)]
    assert [x.ok for x in r] == [True, True, True, True, False, False, False]   # "Sept.25" has month shape


def test_calendar_parts_iso_week(spark):
    df = spark.createDataFrame([("2024-12-30",), ("2021-01-03",)], "d string").select(F.to_date("d").alias("d"))
    r = df.select(*cal.calendar_parts("d")).collect()
    assert (r[0].year, r[0].week, r[0].quarter, r[0].month_name) == (2024, 1, 4, "December")
    assert r[1].week == 53


def test_regimes_and_periods(spark):
    df = spark.createDataFrame([("2019-12-01",), ("2020-01-01",), ("2023-04-01",), ("2020-06-01",)], "d string") \
        .select(F.to_date("d").alias("d"))
    r = df.select(*cal.regime_dummies("d"), cal.period_label("d").alias("p")).collect()
    assert [(x.regime_shock, x.regime_post) for x in r] == [(0, 0), (1, 0), (0, 1), (1, 0)]
    assert [x.p for x in r] == ["all", "main", "energy_crisis", "corona"]


def test_normal_quantile_and_tails(spark):
    ps = [0.001, 0.02, 0.3, 0.5, 0.8, 0.99]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    r = df.select(normal_quantile("p").alias("q"), normal_sf(F.lit(1.96)).alias("s")).collect()
    for p, x in zip(ps, r):
        assert abs(x.q - NormalDist().inv_cdf(p)) < 1e-8
    assert abs(r[0].s - 0.025) < 1e-4


def test_chi2_even_df_matches_published_ljung_box(spark):
    df = spark.createDataFrame([(21.49, 26.45)], "a double, b double")
    r = df.select(chi2_sf_even("a", 12).alias("p12"), chi2_sf_even("b", 24).alias("p24")).first()
    assert math.isclose(r.p12, 0.044, abs_tol=1e-3)
    assert math.isclose(r.p24, 0.331, abs_tol=1e-3)


def test_header_normaliser():
    assert cl.normalize_header("Exchange rate EUR/USD(>2018)", "carbonprices_") == "carbonprices_exchange_rate_eur_usd2018"
    assert cl.normalize_header("Primary Market", "carbonprices_") == "carbonprices_primary_market"
    assert cl.is_junk_header("Unnamed: 3") and cl.is_junk_header(" ") and not cl.is_junk_header("Date")


def test_output_rounding_range_and_nan(spark):
    from wattle.functions.numeric import rnd
    df = spark.createDataFrame([(1.23456789,), (3e30,), (float("nan"),), (None,), (0.12625,)], "x double")
    assert [r.r for r in df.select(rnd("x").alias("r")).collect()] == [1.2346, 3e30, None, None, 0.1263]


def test_iso_week_mode_labels_monday_start(spark):
    days = [dt.date(2024, 12, 29), dt.date(2024, 12, 30), dt.date(2025, 1, 5), dt.date(2025, 1, 6)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(cal.bin_of("d", "weekly", "iso").alias("w")).collect()]
    assert got == [d - dt.timedelta(days=d.weekday()) for d in days]
    via_sql = [r.w for r in df.selectExpr(f"{cal.bin_sql('d', 'weekly', 'iso')} AS w").collect()]
    assert via_sql == got
