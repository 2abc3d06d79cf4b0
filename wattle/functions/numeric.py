"""Numeric Column helpers shared by operators and query outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int = 4) -> Column:
    """Round a double for stable output: via DECIMAL(38,10), then half-up.

    Going through the decimal form makes the result independent of how an
    engine rounds binary near-ties (the DuckDB oracle does the same)."""
    x = col_(c).cast("double")
    via_decimal = F.round(x.try_cast("decimal(38,10)"), digits).cast("double")
    # beyond DECIMAL(38,10) range (|x| >= 1e28) fall back to plain rounding; NaN -> NULL
    return F.when(~F.isnan(x), F.coalesce(via_decimal, F.round(x, digits)))


def half_even(c, digits: int = 0) -> Column:
    """numpy/pandas ``round``: ties to even (``bround``); plain ``round`` is half-up."""
    return F.bround(col_(c), digits)


def half_even_long(c) -> Column:
    """Round to a nullable integer the way ``round().astype('Int64')`` does."""
    return F.bround(col_(c), 0).cast("long")


def iso_date(c) -> Column:
    """ISO ``yyyy-MM-dd`` string, the key form of every output table."""
    return F.date_format(col_(c), "yyyy-MM-dd")


# Fixed coefficients of Acklam's rational approximation of the inverse normal CDF
# (relative error < 1.2e-9).
_QA = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
       1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_QB = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
       6.680131188771972e+01, -1.328068155288572e+01]
_QC = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
       -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_QD = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]


def _horner(coefs, x: str) -> str:
    acc = repr(coefs[0])
    for k in coefs[1:]:
        acc = f"(({acc}) * {x} + {k!r})"
    return acc


def normal_quantile_sql(p: str) -> str:
    """SQL text of the inverse standard normal CDF of the SQL expression ``p``
    (valid in Spark SQL and DuckDB alike)."""
    p = f"CAST({p} AS DOUBLE)"
    qlo, qhi = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    lo = f"({_horner(_QC, qlo)}) / (({_horner(_QD, qlo)}) * {qlo} + 1)"
    hi = f"-({_horner(_QC, qhi)}) / (({_horner(_QD, qhi)}) * {qhi} + 1)"
    mid = f"({_horner(_QA, r)}) * {q} / (({_horner(_QB, r)}) * {r} + 1)"
    return f"(CASE WHEN {p} < 0.02425 THEN {lo} WHEN {p} > 1 - 0.02425 THEN {hi} ELSE {mid} END)"


def normal_quantile(p: str) -> Column:
    """Inverse standard normal CDF of a SQL expression / column name, as one
    built-in expression (stays inside whole-stage codegen)."""
    return F.expr(normal_quantile_sql(p))


def chi2_sf_even_sql(x: str, df: int) -> str:
    """P(X > x) for chi-square with even ``df``: exp(-x/2) * sum_{j < df/2} (x/2)^j / j!."""
    if df % 2:
        raise ValueError("closed form needs even degrees of freedom")
    h = f"(CAST({x} AS DOUBLE) / 2.0)"
    terms, fact = ["1.0"], 1
    for j in range(1, df // 2):
        fact *= j
        terms.append(f"power({h}, {j}) / {fact}.0")
    return f"(exp(-{h}) * ({' + '.join(terms)}))"


def chi2_sf_even(x: str, df: int) -> Column:
    """Upper tail of a chi-square with an even number of degrees of freedom (exact)."""
    return F.expr(chi2_sf_even_sql(x, df))


def normal_sf(z) -> Column:
    """Upper tail of the standard normal via erfc (Abramowitz-Stegun 7.1.26)."""
    z = col_(z).cast("double")
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erfc = poly * F.exp(-x * x)
    upper = erfc / 2
    return F.when(z >= 0, upper).otherwise(1 - upper)


def round_doubles(df, digits: int = 4):
    """Round every double column of a result (stable comparison across engines)."""
    from pyspark.sql import types as T
    return df.select([rnd(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                      else F.col(f"`{f.name}`") for f in df.schema.fields])
