"""The hours that hold each group's first rows, against a plain sort."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattle.operators import quality as Q

SCHEMA = "year int, ts timestamp_ntz, a double, b double"


def _hours(df):
    return df.groupBy("year", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("*").alias("n_rows"), F.count("a").alias("n_a"), F.count("b").alias("n_b"))


def _first(rows, col, k):
    out = {}
    for r in sorted((r for r in rows if r[col] is not None), key=lambda r: (r[1] is not None, r[1] or datetime.min, r[col])):
        out.setdefault(r[0], []).append((r[1], r[col]))
    return {y: v[:k] for y, v in out.items()}


@pytest.mark.parametrize("seed, n", [(1, 0), (2, 1), (3, 40), (4, 400)])
def test_no_first_row_is_lost(spark, seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ts = None if rng.random() < 0.1 else datetime(2020 + rng.randrange(3), 1, 1) + timedelta(minutes=rng.randrange(20000))
        rows.append((ts.year if ts else None, ts, rng.choice([None, float(rng.randrange(9))]),
                     float(rng.randrange(9)) if rng.random() < 0.05 else None))
    df = spark.createDataFrame(rows, SCHEMA)
    early = Q.first_hours(_hours(df), "year", ["n_a", "n_b"], 3)
    kept = [tuple(r) for r in Q.in_hours(df, "ts", early).collect()]
    assert len(early) <= 2 * 3 * 4
    for col in (2, 3):
        assert _first(kept, col, 3) == _first(rows, col, 3)


def test_a_price_that_starts_late_reads_late_hours_only(spark):
    start = datetime(2021, 1, 1)
    rows = [(2021, start + timedelta(hours=h), None if h < 900 else 1.0, 1.0) for h in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    early = Q.first_hours(_hours(df), "year", ["n_a", "n_b"], 2)
    assert Q.in_hours(df, "ts", early).count() == 4
