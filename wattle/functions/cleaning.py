"""Cleaning expressions: missing tokens, lenient casts, structural breaks,
null-aware arithmetic. All are plain Column expressions (codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numeric import col_

# The tokens that count as "missing" in raw text fields.
# Matching is exact (no trimming); callers may add more.
MISSING_TOKENS = [
    "N/A", "n/a", "NA", "na",
    "", "-", "--", "---",
    "NULL", "null", "Null",
    "NaN", "nan", "#N/A",
]


def tokens(extra: Sequence[str] | None = None) -> list[str]:
    return MISSING_TOKENS + [t for t in (extra or []) if t not in MISSING_TOKENS]


def is_missing_token(c, extra: Sequence[str] | None = None) -> Column:
    return col_(c).isin(tokens(extra))


def null_if_token(c, extra: Sequence[str] | None = None) -> Column:
    c = col_(c)
    return F.when(c.isin(tokens(extra)), F.lit(None).cast("string")).otherwise(c)


def named(name: str) -> Column:
    """The column of exactly that name (headers may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def standardize_missing(df: DataFrame, columns: Iterable[str] | None = None,
                        extra: Sequence[str] | None = None) -> DataFrame:
    """Turn missing tokens into NULL on every (or the given) string column, one projection."""
    cols = set(columns) if columns is not None else set(string_columns(df))
    return df.select([
        null_if_token(named(c), extra).alias(c) if c in cols else named(c)
        for c in df.columns
    ])


def missing_token_report(df: DataFrame, columns: Iterable[str] | None = None,
                         extra: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls before, tokens converted, nulls after; only columns with
    conversions. One aggregate pass (partial aggregation on every executor)
    followed by an unpivot of a single row."""
    cols = list(columns) if columns is not None else string_columns(df)
    aggs = []
    for c in cols:
        i = len(aggs)
        aggs.append(F.count_if(named(c).isNull()).alias(f"_{i}"))
        aggs.append(F.count_if(is_missing_token(named(c), extra)).alias(f"_{i + 1}"))
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.col(f"_{2 * i}").alias("original_nulls"),
                 F.col(f"_{2 * i + 1}").alias("converted_missing"))
        for i, c in enumerate(cols)]))
    return (one.select(rows.alias("r")).select("r.*")
            .withColumn("total_nulls", F.col("original_nulls") + F.col("converted_missing"))
            .filter(F.col("converted_missing") > 0))


def lenient_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')``: unparsable text becomes NULL."""
    return col_(c).cast("string").try_cast("double")


def decimal_comma_double(c) -> Column:
    """Numbers written with a decimal comma (``12,5``) to double; bad text to NULL."""
    return F.translate(col_(c).cast("string"), ",", ".").try_cast("double")


def lenient_timestamp(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp parse where unparsable text (e.g. DST hours '2A'/'2B') is NULL."""
    return F.try_to_timestamp(col_(c), F.lit(fmt))


def structural_break(date_c, before_c, after_c, break_date: str) -> Column:
    """Take ``before`` strictly before the break date, else ``after``.

    Not a coalesce: a NULL on the chosen side stays NULL."""
    return F.when(col_(date_c) < F.to_date(F.lit(break_date)), col_(before_c)).otherwise(col_(after_c))


def combined_mean(a, b) -> Column:
    """Mean of two feeds when both are present, else the one present."""
    a, b = col_(a), col_(b)
    return F.when(a.isNotNull() & b.isNotNull(), (a + b) / 2).otherwise(F.coalesce(a, b))


def null_safe_sum(cols: Sequence) -> Column:
    """Row sum that is NULL only when every input is NULL (no false zeros)."""
    cs = [col_(c) for c in cols]
    total = F.coalesce(cs[0], F.lit(0.0))
    for c in cs[1:]:
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(F.coalesce(*cs).isNotNull(), total)


def share_pct(part, whole) -> Column:
    """part / whole * 100; a zero or NULL denominator gives NULL."""
    return F.try_divide(col_(part), col_(whole)) * 100


def row_completeness(cols: Sequence, digits: int = 1) -> Column:
    """Share of non-NULL members of a column family, in percent, half-even rounded."""
    n = len(cols)
    present = sum((col_(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return F.bround(present / F.lit(float(n)) * 100, digits)


# Characters of a header that become an underscore, that vanish,
# and the names of columns without a header of their own.
HEADER_SEPARATORS, HEADER_BRACKETS = " /-", "()>"
JUNK_HEADERS, JUNK_PREFIX = ("", ".1", "1", "Unnamed"), "Unnamed:"


def normalize_header(name: str, prefix: str = "") -> str:
    """Column name of a source header: trimmed, lower case, mapped character by character."""
    return prefix + "".join("_" if ch in HEADER_SEPARATORS else ch
                            for ch in str(name).strip().lower() if ch not in HEADER_BRACKETS)


def is_junk_header(name: str) -> bool:
    bare = str(name).strip()
    return bare in JUNK_HEADERS or bare.startswith(JUNK_PREFIX)


def all_null_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Columns whose every value is NULL, found with one aggregate pass."""
    cols = list(columns) if columns is not None else df.columns
    one = df.agg(*[F.count(named(c)).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").cast("long").alias("non_null")) for i, c in enumerate(cols)]))
    return one.select(rows.alias("r")).select("r.*")


def drop_junk_columns(df: DataFrame) -> DataFrame:
    """Drop blank/'Unnamed' headers and all-NULL columns (one aggregate pass)."""
    junk = [c for c in df.columns if is_junk_header(c)]
    rest = [c for c in df.columns if c not in junk]
    empty = [r["column"] for r in all_null_columns(df, rest).filter("non_null = 0").collect()]
    return df.drop(*(named(c) for c in [*junk, *empty]))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """A column family: true prefix match (``econ_prod_*`` is not ``prod_``)."""
    return [c for c in df.columns if c.startswith(prefix)]
