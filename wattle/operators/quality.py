"""Data-quality operators on bin-level tables: columns are unpivoted to (column,
value) and aggregated by column in one pass; nothing is looped per column on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Column families by name prefix.
FAMILIES = [("price_", "electricity"), ("carbonprices_", "carbon"), ("climate_", "climate"),
            ("prod_", "production"), ("oegpi_", "gas"), ("econ_", "economy")]


def family_of(name: str) -> str:
    for p, fam in FAMILIES:
        if name.startswith(p):
            return fam
    return "base"


def unpivot_one_row(one: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One aggregate row with ``{col}__{field}`` entries -> one row per column."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields]) for c in cols]))
    return one.select(rows.alias("r")).select("r.*")


def profile(df: DataFrame, cols: Sequence[str], measures: dict, cast: str = "double") -> DataFrame:
    """``measures``: name -> function(value Column) -> aggregate Column.

    The columns are unpivoted to (column, value) and aggregated by column: a
    narrow aggregate per column instead of one very wide row (small generated
    code, partial aggregation per column key)."""
    src = df.select(*[F.col(f"`{c}`").cast(cast).alias(c) for c in cols])
    long = src.unpivot([], list(cols), "column", "value")
    return long.groupBy("column").agg(*[fn(F.col("value")).alias(m) for m, fn in measures.items()])


def missing_by_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    n = F.count(F.lit(1))
    out = profile(df, cols, {"n_null": lambda c: F.count_if(c.isNull()), "n_rows": lambda c: n}, cast="string")
    fam = F.create_map(*[F.lit(x) for c in cols for x in (c, family_of(c))])
    return out.select("column", F.try_element_at(fam, F.col("column")).alias("family"), "n_null",
                      (F.col("n_null") / F.col("n_rows") * 100).alias("pct_null"))


def any_not_null(cols: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in cols]).isNotNull()


from .series import first_k_by  # noqa: E402,F401  (top-k per key, shared)


def pairwise(cols: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def pair_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_a, col_b, a, b) for every column pair of every row (one ``stack``)."""
    pairs = pairwise(cols)
    args = ", ".join(f"'{a}', '{b}', CAST(`{a}` AS DOUBLE), CAST(`{b}` AS DOUBLE)" for a, b in pairs)
    return df.selectExpr(f"stack({len(pairs)}, {args}) AS (col_a, col_b, a, b)")


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair (pairwise complete), aggregated per pair key."""
    pv = pair_values(df, cols)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return pv.groupBy("col_a", "col_b").agg(F.corr("a", "b").alias("r"), F.count_if(both).alias("n_pairs"))


def family_type_check(df: DataFrame, expected: str = "double", integer_ok: bool = True) -> list[tuple]:
    """Schema rule: family columns must be numeric (driver-side, schema only)."""
    out = []
    for f in df.schema.fields:
        fam = family_of(f.name)
        if fam == "base":
            continue
        t = f.dataType.simpleString()
        ok = t == expected or (integer_ok and t in ("bigint", "int"))
        out.append((f.name, fam, t, ok))
    return out


def column_set_difference(actual: Sequence[str], expected: Sequence[str]) -> dict:
    """Expected vs. actual column names (schema only)."""
    a, e = set(actual), set(expected)
    return {"missing": sorted(e - a), "unexpected": sorted(a - e)}


def first_hours(hours: DataFrame, group: str, counts: Sequence[str], k: int) -> list:
    """The hours that hold the first ``k`` rows of each group, for each count column: at most ``k`` a group and
    column, as each has a row. ``hours``: (group, hour, counts). None stands for rows without a time."""
    per = hours.select(group, "hour", F.explode(F.array(*[
        F.struct(F.lit(c).alias("of"), F.col(c).alias("n")) for c in counts])).alias("x")).select(group, "hour", "x.*")
    w = Window.partitionBy(group, "of").orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = per.filter("n > 0").withColumn("before", F.sum("n").over(w) - F.col("n")).filter(F.col("before") < k)
    text = F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("h")
    return sorted((r["h"] for r in first.select(text).distinct().collect()), key=lambda h: (h is None, h))


def in_hours(df: DataFrame, ts_col: str, hours: Sequence) -> DataFrame:
    """Rows whose time lies in one of the hours, as a filter that reaches the scan (None: no time).
    Neighbouring hours become one range."""
    from datetime import datetime, timedelta
    kind = "TIMESTAMP_NTZ" if df.schema[ts_col].dataType.typeName() == "timestamp_ntz" else "TIMESTAMP"
    spans: list[list[datetime]] = []
    for h in (datetime.fromisoformat(h) for h in hours if h is not None):
        if spans and spans[-1][1] == h:
            spans[-1][1] = h + timedelta(hours=1)
        else:
            spans.append([h, h + timedelta(hours=1)])
    hit = [f"(`{ts_col}` >= {kind}'{a}' AND `{ts_col}` < {kind}'{b}')" for a, b in spans]
    hit += [f"`{ts_col}` IS NULL"] if None in hours else []
    return df.filter(" OR ".join(hit) or "false")
