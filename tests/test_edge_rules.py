"""Inputs that once lost rows, hit a cap or showed old data."""

import datetime as dt
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wattle.functions import cleaning as cl
from wattle.operators import forecast as FC
from wattle.operators.regression import ols
from wattle.operators.resample import resample
from wattle.plans.q_series import kpss


def _months(n):
    return [dt.date(1990 + i // 12, 1 + i % 12, 1) for i in range(n)]


@pytest.mark.parametrize("n", [30, 700, 36_000])
def test_kpss_uses_every_lag(spark, n):
    y = np.cumsum(np.random.default_rng(n).normal(size=n)) * 0.05 + np.random.default_rng(1).normal(size=n)
    days = [dt.date(1900, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    got = kpss(spark.createDataFrame([("a", d, float(v)) for d, v in zip(days, y)],
                                     "series_id string, month date, y double")).first()
    lags = int(4 * (n / 100) ** 0.25)
    e = y - y.mean()
    lrv = e @ e / n + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / n for k in range(1, lags + 1))
    assert got.lags == lags and (n < 33_000 or lags > 16)
    assert got.stat == pytest.approx((np.cumsum(e) ** 2).sum() / (n * n * lrv), rel=1e-8)


def test_seasonal_naive_keeps_every_test_month_once(spark):
    m = _months(60)
    train = [("a", x, float(i)) for i, x in enumerate(m[:42]) if i not in (33, 36) and x.month != 5]
    test = [("a", x, 0.0) for x in m[42:]]
    cols = "series_id string, month date, y double"
    got = {r.month: r.forecast for r in FC.seasonal_naive(spark.createDataFrame(train, cols),
                                                          spark.createDataFrame(test, cols)).collect()}
    assert sorted(got) == m[42:]
    last = {x.month: v for _, x, v in train}
    assert all(got[x] == last.get(x.month) for x in m[42:])


def test_singular_fits_keep_their_row(spark):
    rng = np.random.default_rng(0)
    rows = [("const", float(v), 1.0, float(u)) for v, u in rng.normal(size=(40, 2))]
    rows += [("twice", float(v), float(u), 2 * float(u)) for v, u in rng.normal(size=(40, 2))]
    rows += [("nearly", float(v), float(u), 2 * float(u) + 1e-9 * i) for i, (v, u) in enumerate(rng.normal(size=(40, 2)))]
    rows += [("fine", float(v), float(u), float(w)) for v, u, w in rng.normal(size=(40, 3))]
    got = {r.g: r for r in ols(spark.createDataFrame(rows, "g string, y double, a double, b double"),
                               ["g"], "y", ["a", "b"]).collect()}
    assert {k: r.status for k, r in got.items()} == {"const": "singular", "twice": "singular", "nearly": "singular", "fine": "ok"}
    assert got["const"].coef is None and got["const"].n == 40 and got["fine"].coef is not None


def test_unparsed_times_make_no_bin(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00", 1.0), ("2020-01-01 2A:00:00", 9.0), ("2020-01-03 10:00:00", 3.0)],
                               "t string, v double").withColumn("ts", cl.lenient_timestamp("t"))
    out = resample(df, "ts", ["v"])
    assert out.filter("date IS NULL").count() == 0
    days = {str(r.date): r.v_count for r in out.filter("aggregation_level = 'daily'").collect()}
    assert days == {"2020-01-01": 1, "2020-01-02": 0, "2020-01-03": 1}


def test_headers_with_dots_and_ticks(spark):
    df = spark.createDataFrame([("-", "1,5"), ("x", None)], ["a.b", "c`d"])
    assert cl.standardize_missing(df).collect()[0][0] is None
    assert [(r.column, r.converted_missing) for r in cl.missing_token_report(df).collect()] == [("a.b", 1)]
    assert cl.drop_junk_columns(df.withColumn("e.f", F.lit(None).cast("string"))).columns == ["a.b", "c`d"]


@pytest.mark.parametrize("raw, name", [("Primary Market(>2018)", "primary_market2018"),
                                       (" Exchange rate EUR/USD ", "exchange_rate_eur_usd"), ("A-b", "a_b")])
def test_header_names(raw, name):
    assert cl.normalize_header(raw) == name and cl.normalize_header(raw, "p_") == "p_" + name


def test_appended_files_are_seen(spark, tmp_path):
    sf = tmp_path / "sf"
    shutil.copytree(SF_SMALL, sf, copy_function=shutil.copyfile)
    sf.chmod(0o755)                                     # the given folder may be read-only
    orders = sf / "orders.parquet"
    rows = spark.read.parquet(str(orders)).cache()
    rows.count()
    orders.unlink()
    rows.write.parquet(str(orders))
    q = E.queries()
    names = ("forecast_metrics", "moving_average_deviation", "consolidate_sources")
    before = {n: sorted(map(str, q[n](spark, str(sf)).collect())) for n in names}
    rows.withColumn("o_totalprice", F.col("o_totalprice") * 3).write.mode("append").parquet(str(orders))
    after = {n: sorted(map(str, q[n](spark, str(sf)).collect())) for n in names}
    assert all(before[n] != after[n] for n in names)


def test_a_cluster_needs_a_shared_folder():
    from wattle.session import checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError):
        checkpoint_dir(Session())
