"""Merging sources on the (date, aggregation_level) key.

Full outer equi-joins cannot broadcast (both sides must keep unmatched rows),
so Spark plans a sort-merge or shuffled-hash join on the key. The tables
merged here are *bin-level* (one row per date and grain per source), i.e.
already reduced by orders of magnitude from the raw readings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("date", "aggregation_level")
SHARED = ("year", "month", "quarter", "week", "month_name", "data_completeness")


def outer_merge(left: DataFrame, right: DataFrame, key: Sequence[str] = KEY,
                shared: Sequence[str] = SHARED) -> DataFrame:
    """Full outer join on ``key``; shared columns resolved left-first (``coalesce``).

    Duplicate keys on either side multiply as in any equi-join."""
    key = list(key)
    lcols, rcols = left.columns, right.columns
    both = [c for c in shared if c in lcols and c in rcols]
    out = [f"coalesce(l.`{c}`, r.`{c}`) AS `{c}`" for c in key]
    for c in lcols:
        if c not in key:
            out.append(f"coalesce(l.`{c}`, r.`{c}`) AS `{c}`" if c in both else f"l.`{c}` AS `{c}`")
    for c in rcols:
        if c not in key and c not in both:
            out.append(f"r.`{c}` AS `{c if c not in lcols else c + '_r'}`")
    cond = " AND ".join(f"l.`{c}` <=> r.`{c}`" for c in key)
    return left.alias("l").join(right.alias("r"), F.expr(cond), "full_outer").selectExpr(*out)


def consolidate(sources: Sequence[DataFrame], key: Sequence[str] = KEY,
                shared: Sequence[str] = SHARED, how: str = "join") -> DataFrame:
    """Merge many sources into one wide table.

    ``how='join'``  chain of full outer joins (faithful: duplicate keys multiply).
    ``how='union'`` join-free: ``unionByName`` + one group-by on the key. One
                    shuffle instead of one per source; a key that repeats
                    within a source fails the job (its rows would be lost).
    """
    if how == "join":
        return reduce(lambda a, b: outer_merge(a, b, key, shared), sources)
    if how != "union":
        raise ValueError(how)
    tagged = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    cols = []
    for c in u.columns:
        if c in key or c == "_src":
            continue
        if c in shared:
            # left-most source with a value wins, as in the join chain
            cols.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_src"))).alias(c))
        else:
            cols.append(F.max(c).alias(c))
    cols.append(F.greatest(*[F.count_if(F.col("_src") == i) for i in range(len(sources))], F.lit(0)).alias("_most"))
    merged = u.groupBy(*key).agg(*cols)
    repeats = F.when(F.col("_most") > 1, F.raise_error(F.concat_ws(" ", F.lit("key repeats within a source:"), *key)))
    return merged.withColumn(key[0], F.coalesce(repeats.cast("string"), F.col(key[0]))).drop("_most")


def key_alignment(a: DataFrame, b: DataFrame, key: str = "date") -> DataFrame:
    """Keys present on one side only: one full outer join of the distinct keys with
    presence flags (each input is scanned once)."""
    ka = a.select(key).distinct().withColumn("_in_a", F.lit(True))
    kb = b.select(key).distinct().withColumn("_in_b", F.lit(True))
    j = ka.join(kb, key, "full_outer").filter(F.col("_in_a").isNull() | F.col("_in_b").isNull())
    return j.select(key, F.when(F.col("_in_b").isNull(), F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"))
