"""Exact quantiles of raw-size columns by distributed selection.

No sort and no group that holds values: a histogram of each column's range finds the
bucket that holds a wanted rank; only that bucket is divided again, by the least and
largest value found in it, until it holds one value. A round is one scan with a partial
count on every executor; at most ``BUCKETS`` rows for each interval still open reach the
driver. Money-like columns take two or three rounds, any doubles fewer than eight.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c, v): place of the column and its value, for each value that is neither NULL nor NaN."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.nanvl(F.col(f"`{n}`").cast("double"), F.lit(None)).alias("v"))
                      for i, n in enumerate(columns)])
    return df.select(F.explode(cells).alias("x")).select("x.c", "x.v").filter("v IS NOT NULL")


def order_statistics(df: DataFrame, columns: Sequence[str], ranks: Sequence[set[int]], ends: Sequence[tuple]) -> list[dict[int, float]]:
    """The values at the 0-based ``ranks`` of each column, whose least and largest values are ``ends``."""
    found: list[dict[int, float]] = [{} for _ in columns]
    open_ = [(c, a, b, 0, r) for c, (r, (a, b)) in enumerate(zip(ranks, ends)) if r]      # (column, least, largest, values below, ranks)
    while True:
        for c, a, _, _, r in (x for x in open_ if x[1] == x[2]):
            found[c].update(dict.fromkeys(r, a))
        open_ = [x for x in open_ if x[1] < x[2]]
        if not open_:
            return found
        which, at = F.lit(None).cast("int"), F.lit(None).cast("double")
        for i, (c, a, b, _, _) in enumerate(open_):
            here = (F.col("c") == c) & F.col("v").between(a, b)
            which = F.when(here, F.lit(i)).otherwise(which)
            at = F.when(here, (F.col("v") - a) / (b - a)).otherwise(at)
        rows = (_values(df, columns).select(which.alias("i"), F.least(F.floor(at * BUCKETS), F.lit(BUCKETS - 1)).alias("k"), "v")
                .filter("i IS NOT NULL").groupBy("i", "k").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
                .orderBy("i", "k").collect())
        nxt = []
        for i, (c, _, _, below, want) in enumerate(open_):
            for r in (x for x in rows if x["i"] == i):
                mine = {w for w in want if below <= w < below + r["n"]}
                if mine:
                    nxt.append((c, r["a"], r["b"], below, mine))
                below += r["n"]
        open_ = nxt


def describe(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row a column: n, mean, std (sample), min, the exact quantiles (linear interpolation) p25, p50, p75, max.

    NULL and NaN do not count; a column without values keeps its row with n 0."""
    spark = df.sparkSession
    seen = _values(df, columns).groupBy("c").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                                 F.min("v").alias("a"), F.max("v").alias("b"))
    by = {r["c"]: r for r in seen.collect()}                    # a row a column
    spots = [[(by[c]["n"] - 1) * p for p in probabilities] if c in by else [] for c in range(len(columns))]
    ranks = [{f(s) for s in at for f in (math.floor, math.ceil)} for at in spots]
    got = order_statistics(df, columns, ranks, [(by[c]["a"], by[c]["b"]) if c in by else (0.0, 0.0) for c in range(len(columns))])
    rows = []
    for c, name in enumerate(columns):
        r, low = by.get(c), got[c]
        qs = [low[math.floor(s)] + (low[math.ceil(s)] - low[math.floor(s)]) * (s - math.floor(s)) for s in spots[c]]
        rows.append((name, r["n"], r["mean"], r["std"], r["a"], *qs, r["b"]) if r else (name, 0, *[None] * (4 + len(probabilities))))
    names = ", ".join(f"p{round(100 * p)} double" for p in probabilities)
    return spark.createDataFrame(rows, f"column string, n long, mean double, std double, min double, {names}, max double")
