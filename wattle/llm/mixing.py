"""Mixing sources to target weights: hash-threshold histograms.

Every document gets a fixed 60-bit hash of its id. Tokens are summed by source
and hash bucket; the running sum of at most 4,096 buckets a source shows in
which bucket the budget ends; only that bucket is split further. Documents
below the final threshold are taken by a filter; nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, read

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CEILING = 2.0
LEVEL_BITS, LEVELS, HASH_BITS = 12, 5, 60
SPACES = "\t\n\u000b\f\r"


def word_count(text: Column) -> Column:
    """Number of words of ``[^\\x20\\x09-\\x0D]+``; null has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES, "     ")
    return F.size(F.filter(F.split(flat, " "), lambda w: w != "")).cast("long")


def doc_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id as text (null: of the empty text)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
                   ceiling: float = CEILING) -> DataFrame:
    """(source, source_size) -> plus ``target``.

    Weights repeat over the sources by code point, null last. A source whose
    share would exceed ``ceiling`` times its size stops there and the excess is
    shared among the others by weight until none is above. The capped sources
    are those with the smallest size/weight ratio, so one running sum over the
    sources in that order finds them all. One row a source: the window is over
    sources, not documents."""
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = totals.withColumn("pos", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("pos") % n + 1).cast("int")))
    order = Window.orderBy((F.col("source_size") / F.col("weight")), "pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    w = (w.withColumn("cap", F.lit(ceiling) * F.col("source_size"))
          .withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
          .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
          .withColumn("all_weight", F.sum("weight").over(every))
          .withColumn("all_budget", F.lit(budget) * F.sum("source_size").over(every)))
    left = F.col("all_weight") - F.col("weight_before")
    # share per weight unit if every source before this one is at its cap
    w = w.withColumn("unit", (F.col("all_budget") - F.col("capped_before")) / left)
    w = w.withColumn("over", F.col("unit") * F.col("weight") >= F.col("cap"))
    # the first source in order that is not above its cap fixes the unit for all after it
    first = F.first(F.when(~F.col("over"), F.col("unit")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return w.select("source", "source_size",
                    F.when(F.col("over") | first.isNull(), F.col("cap"))
                    .otherwise(F.least(first * F.col("weight"), F.col("cap"))).alias("target"))


def source_limits(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING) -> DataFrame:
    """(source, size, _h) -> source, source_size, target, copies, limit.

    Every document of the source is taken ``copies`` times, and once more when
    its hash is below ``limit``: the hash at which the taken words come nearest
    to the target from below or above."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(totals, weights, budget, ceiling)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (plan.withColumn("copies", F.floor(ratio).cast("long"))
            .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")))
    # one row a source: level by level the prefix of the boundary bucket and the words below it
    state = keep(plan.withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long"))
                 .withColumn("upto", F.lit(0).cast("long")), "mix-plan")
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        inside = sized.alias("d").join(state.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        if level > 1:
            inside = inside.filter(F.shiftright("d._h", shift + LEVEL_BITS) == F.col("s.prefix"))
        hist = (inside.groupBy(F.col("s.source").alias("source"), F.shiftright("d._h", shift).alias("b"))
                .agg(F.sum("d.size").alias("w"), F.first("s.rest").alias("rest"), F.first("s.below").alias("below")))
        run = F.sum("w").over(Window.partitionBy("source").orderBy("b"))
        # the boundary bucket: the first whose running sum exceeds the budget
        edge = (hist.withColumn("upto", F.col("below") + run).filter(F.col("upto") > F.col("rest"))
                .groupBy("source").agg(F.min(F.struct("b", "upto", "w")).alias("e")))
        state = keep(state.alias("s").join(edge.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")), "left")
                     .select("s.source", "s.source_size", "s.target", "s.copies", "s.rest",
                             # only a source of no words has no boundary
                             F.coalesce(F.col("e.e.b"), F.lit(0)).cast("long").alias("prefix"),
                             F.coalesce(F.col("e.e.upto") - F.col("e.e.w"), F.lit(0)).cast("long").alias("below"),
                             F.coalesce(F.col("e.e.upto"), F.lit(0)).cast("long").alias("upto")), "mix-plan")
    # the boundary is one hash value now: take it if that comes nearer to the budget
    nearer = (F.col("upto") - F.col("rest")) < (F.col("rest") - F.col("below"))
    return state.select("source", "source_size", "target", "copies",
                        F.when(nearer, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("limit"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", word_count(F.col("text"))).withColumn("_h", doc_hash(F.col("doc_id")))


def _taken(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with their source's plan and ``n_copies``."""
    out = rows.alias("d").join(limits.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    n = F.col("s.copies") + F.when(F.col("d._h") < F.col("s.limit"), 1).otherwise(0)
    return out.select("d.*", "s.source_size", "s.target", n.cast("long").alias("n_copies"))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING) -> DataFrame:
    """``docs`` (doc_id, text, source) -> doc_id, size, source_size, target, taken.

    ``taken`` is the document's words times its number of copies. Null texts
    have size 0, a null source is a source of its own (last), rows that repeat
    an id share its hash and are taken together, an empty table gives no rows;
    extra columns are ignored."""
    sized = keep(_sized(docs.select("doc_id", "text", "source")).drop("text"), "mix-sizes")
    out = _taken(sized, source_limits(sized, weights, budget, ceiling))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("n_copies")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING) -> DataFrame:
    """``docs`` itself after mixing: each row as often as the mix takes it, columns unchanged."""
    sized = keep(_sized(docs.select("doc_id", "text", "source")).drop("text"), "mix-sizes")
    limits = source_limits(sized, weights, budget, ceiling)
    # the row travels as one struct, so its column names cannot clash with those used here
    rows = _taken(docs.select(F.struct("*").alias("row"), "source", doc_hash(F.col("doc_id")).alias("_h")), limits)
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies").cast("int"))))
            .filter(F.col("copy") > 0).select("row.*"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: words, source total, source target and words taken, per document."""
    return mix(read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS pos
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE pos % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS all_budget FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY source_size / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size / weight, pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight FROM w
), u AS (SELECT *, (all_budget - capped) / left_weight AS unit, (all_budget - capped) / left_weight * weight >= cap AS over_cap FROM o),
f AS (SELECT first(unit ORDER BY source_size / weight, pos) AS unit1 FROM u WHERE NOT over_cap),
t AS (
  SELECT source, source_size, CASE WHEN over_cap OR unit1 IS NULL THEN cap ELSE least(unit1 * weight, cap) END AS target
  FROM u LEFT JOIN f ON TRUE
), p AS (
  SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS BIGINT) AS copies,
         target - floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) * source_size AS rest FROM t
), g AS (
  SELECT source, h, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto, sum(size) AS own FROM d GROUP BY source, h
), e AS (
  SELECT p.source, min(h) AS edge, min_by(upto, h) AS upto, min_by(own, h) AS own
  FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source WHERE g.upto > p.rest GROUP BY p.source
), l AS (
  SELECT p.*, CASE WHEN e.upto - p.rest < p.rest - (e.upto - e.own) THEN e.edge + 1 ELSE coalesce(e.edge, 0) END AS lim
  FROM p LEFT JOIN e ON p.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (copies + CASE WHEN h < lim THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source
"""
