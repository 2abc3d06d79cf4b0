"""Calendar expressions: bins, calendar parts, local month formats, regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_

# German month abbreviations of the gas price sheet ("2020-Mrz").
GERMAN_MONTHS = {
    "Jan": "01", "Feb": "02", "Mrz": "03", "Apr": "04",
    "Mai": "05", "Jun": "06", "Jul": "07", "Aug": "08",
    "Sep": "09", "Okt": "10", "Nov": "11", "Dez": "12",
}

# Austrian month abbreviations of the economy sheet ("Jän.09").
AUSTRIAN_MONTHS = {
    "Jän": "01", "Jan": "01", "Feb": "02", "Mär": "03", "Mrz": "03",
    "Apr": "04", "Mai": "05", "Jun": "06", "Jul": "07",
    "Aug": "08", "Sep": "09", "Okt": "10", "Nov": "11", "Dez": "12",
}

# Analysis windows and regime boundaries.
PERIODS = {
    "all": ("2000-01-01", "2025-12-31"),
    "main": ("2020-01-01", "2025-12-31"),
    "corona": ("2020-03-01", "2021-12-31"),
    "energy_crisis": ("2022-01-01", "2023-12-31"),
}
REGIME_SHOCK_START = "2020-01-01"
REGIME_POST_START = "2023-04-01"

# Intervals a complete bin holds for 15-minute data (month divisor is 31 days).
EXPECTED_INTERVALS = {"daily": 96, "weekly": 672, "monthly": 2976}

GRAINS = ("daily", "weekly", "monthly")


def _sql_lit(x) -> str:
    return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def _map_expr(m: dict) -> Column:
    """Literal map as one SQL expression."""
    return F.expr("map(" + ", ".join(_sql_lit(x) for kv in m.items() for x in kv) + ")")


def week_ending_monday(d) -> Column:
    """Bin label of pandas ``W-MON``: the Monday on or after the day (Tue..Mon weeks)."""
    return F.next_day(F.date_sub(col_(d), 1), "Mon")


def iso_week_start(d) -> Column:
    """Monday that starts the ISO week of the day (optional ``week_mode='iso'``)."""
    return F.date_trunc("week", col_(d)).cast("date")


def month_start(d) -> Column:
    return F.trunc(col_(d), "MM")


def bin_of(d, grain: str, week_mode: str = "w-mon") -> Column:
    if grain == "daily":
        return col_(d).cast("date")
    if grain == "weekly":
        return week_ending_monday(d) if week_mode == "w-mon" else iso_week_start(d)
    if grain == "monthly":
        return month_start(d)
    raise ValueError(grain)


def bin_sql(d: str, grain: str, week_mode: str = "w-mon") -> str:
    """SQL text of :func:`bin_of` (for expressions built as one SQL snippet)."""
    if grain == "daily":
        return f"CAST({d} AS DATE)"
    if grain == "weekly":
        return f"next_day(date_sub({d}, 1), 'Mon')" if week_mode == "w-mon" else f"CAST(date_trunc('week', {d}) AS DATE)"
    if grain == "monthly":
        return f"trunc({d}, 'MM')"
    raise ValueError(grain)


def calendar_parts(d) -> list[Column]:
    """year, month, quarter, ISO week and English month name of a bin label."""
    d = col_(d)
    return [F.year(d).alias("year"), F.month(d).alias("month"),
            F.quarter(d).alias("quarter"), F.weekofyear(d).alias("week"),
            F.date_format(d, "MMMM").alias("month_name")]


def month_floor_iso(d) -> Column:
    return F.date_format(F.trunc(col_(d), "MM"), "yyyy-MM-dd")


def parse_german_month(s) -> Column:
    """``2020-Mrz`` -> 2020-03-01; unknown month or bad shape -> NULL."""
    parts = F.split(col_(s).cast("string"), "-")
    mm = F.try_element_at(_map_expr(GERMAN_MONTHS), F.try_element_at(parts, F.lit(2)))
    ok = (F.size(parts) == 2) & mm.isNotNull()
    return F.when(ok, F.try_to_date(F.concat_ws("-", F.try_element_at(parts, F.lit(1)), mm, F.lit("01")),
                                    "yyyy-M-d"))


def parse_austrian_month(s) -> Column:
    """``Jän.09`` -> 2009-01-01 (century 20); unlisted month text is used as is."""
    parts = F.split(F.trim(col_(s).cast("string")), r"\.")
    m = F.try_element_at(parts, F.lit(1))
    mm = F.coalesce(F.try_element_at(_map_expr(AUSTRIAN_MONTHS), m), m)
    txt = F.concat(F.lit("20"), F.try_element_at(parts, F.lit(2)), F.lit("-"), mm, F.lit("-01"))
    return F.when(F.size(parts) == 2, F.try_to_date(txt, "yyyy-M-d"))


def is_month_token(s) -> Column:
    """Shape test of an economy row label: one dot, <= 4 chars before, exactly 2 after."""
    return F.coalesce(F.trim(col_(s).cast("string")).rlike(r"^[^.]{0,4}[.][^.]{2}$"), F.lit(False))


def german_month_label(d) -> Column:
    """Inverse of :func:`parse_german_month` (used to build raw-form fixtures)."""
    inv = {int(v): k for k, v in GERMAN_MONTHS.items()}
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.try_element_at(_map_expr(inv), F.month(d)))


def austrian_month_label(d) -> Column:
    """``Jän.09`` form of a date (first listed abbreviation per month)."""
    inv = {}
    for k, v in AUSTRIAN_MONTHS.items():
        inv.setdefault(int(v), k)
    return F.concat(F.try_element_at(_map_expr(inv), F.month(d)), F.lit("."), F.date_format(d, "yy"))


def regime_dummies(d, shock_start: str = REGIME_SHOCK_START,
                   post_start: str = REGIME_POST_START) -> list[Column]:
    d = col_(d)
    s, p = F.to_date(F.lit(shock_start)), F.to_date(F.lit(post_start))
    return [((d >= s) & (d < p)).cast("int").alias("regime_shock"),
            (d >= p).cast("int").alias("regime_post")]


def period_label(d, periods: dict | None = None, order: Sequence[str] | None = None) -> Column:
    """First matching named window (most specific first), else NULL."""
    periods = periods or PERIODS
    order = order or ["corona", "energy_crisis", "main", "all"]
    d = col_(d)
    expr = None
    for name in order:
        lo, hi = periods[name]
        cond = d.between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr
