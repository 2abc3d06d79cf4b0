"""Property tests against pandas / numpy, whose semantics the reference relies on."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattle.functions import calendar as cal
from wattle.functions.numeric import half_even_long
from wattle.operators.resample import resample

RULE = {"daily": "D", "weekly": "W-MON", "monthly": "MS"}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 24 * 4 * 120), st.one_of(st.none(), st.floats(-50, 500))),
                min_size=1, max_size=60),
       st.integers(0, 10 ** 6))
def test_resample_equals_pandas(spark, readings, offset_days):
    start = dt.datetime(2015, 1, 1) + dt.timedelta(days=offset_days % 3000)
    rows = [(start + dt.timedelta(minutes=15 * k), v) for k, v in readings]
    pdf = pd.DataFrame(rows, columns=["ts", "v"]).set_index("ts")
    sdf = spark.createDataFrame([(t, v) for t, v in rows], "ts timestamp_ntz, v double")
    got = {(r.aggregation_level, r.date): (r.v_mean, r.v_count) for r in resample(sdf, "ts", ["v"]).collect()}
    for grain, rule in RULE.items():
        ref = pdf.resample(rule)["v"].agg(["mean", "count"])
        mine = {d: got[(grain, d)] for (g, d) in got if g == grain}
        assert sorted(mine) == [ts.date() for ts in ref.index]
        for ts, row in ref.iterrows():
            m, n = mine[ts.date()]
            assert n == row["count"]
            assert (m is None and math.isnan(row["mean"])) or math.isclose(m, row["mean"], rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-2000, 2000), min_size=1, max_size=50))
def test_half_even_equals_numpy(spark, halves):
    xs = [h / 2 for h in halves]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(half_even_long("x").alias("r")).collect()]
    assert got == [int(v) for v in np.round(xs)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_week_label_and_month_labels_round_trip(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    r = df.select("d", cal.week_ending_monday("d").alias("w"),
                  cal.parse_german_month(cal.german_month_label("d")).alias("g"),
                  cal.parse_austrian_month(cal.austrian_month_label("d")).alias("a")).collect()
    for x in r:
        ref = pd.Series([1.0], index=pd.DatetimeIndex([x.d])).resample("W-MON").sum().index[0].date()
        assert x.w == ref
        assert x.g == x.d.replace(day=1)
        if 2000 <= x.d.year <= 2099:          # two-digit years are read as 20yy
            assert x.a == x.d.replace(day=1)
