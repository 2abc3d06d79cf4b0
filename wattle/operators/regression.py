"""Least squares as a distributed aggregate.

The heavy part is one group-by that accumulates centred second moments
(``covar_pop`` / ``var_pop``, numerically stable merges of partial aggregates)
per (series, model). Only those moment rows -- k x k numbers per group --
cross into Python, where ``mapInPandas`` solves the tiny normal equations.
The raw or monthly rows never leave the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ols_moments(df: DataFrame, group_cols: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("m_y"), F.var_pop(y).alias("v_yy")]
    for i, a in enumerate(xs):
        aggs.append(F.avg(a).alias(f"m_{i}"))
        aggs.append(F.covar_pop(a, y).alias(f"c_{i}_y"))
        for j in range(i, len(xs)):
            aggs.append(F.covar_pop(a, xs[j]).alias(f"c_{i}_{j}"))
    return df.groupBy(*group_cols).agg(*aggs)


# --- small numeric helpers (run inside tasks on moment rows only) ---------------------

def _betacf(a, b, x, iters=200, eps=3e-16):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc_reg(a, b, x):
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_two_sided_p(t, df):
    """Two-sided p-value of Student's t."""
    if t is None or not np.isfinite(t) or df <= 0:
        return float("nan")
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


SOLVE_FIELDS = [
    T.StructField("n", T.LongType()), T.StructField("k", T.IntegerType()), T.StructField("status", T.StringType()),
    T.StructField("intercept", T.DoubleType()), T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("se", T.ArrayType(T.DoubleType())), T.StructField("t", T.ArrayType(T.DoubleType())),
    T.StructField("p", T.ArrayType(T.DoubleType())), T.StructField("beta", T.ArrayType(T.DoubleType())),
    T.StructField("ssr", T.DoubleType()), T.StructField("sigma2", T.DoubleType()),
    T.StructField("r2", T.DoubleType()), T.StructField("adj_r2", T.DoubleType()),
    T.StructField("aic", T.DoubleType()), T.StructField("bic", T.DoubleType()),
    T.StructField("dropped", T.ArrayType(T.IntegerType())),
]


def _independent(S, tol=1e-10):
    """Columns of the moment matrix that are neither constant nor (nearly) a combination of
    the ones kept before them: those whose pivot of the correlation matrix stays above ``tol``."""
    d = np.diag(S)
    if not np.isfinite(S).all():
        return []
    c = S / np.sqrt(np.outer(np.where(d > 0, d, 1), np.where(d > 0, d, 1)))
    kept = []
    for i in range(len(d)):
        if c[i, i] >= tol:
            kept.append(i)
            c[i + 1:, i + 1:] -= np.outer(c[i + 1:, i], c[i, i + 1:]) / c[i, i]
    return kept


def _solve_row(row, k_all, active, reduce=False):
    n = int(row["n"])
    idx = [i for i in range(k_all) if active[i]]
    k = len(idx)
    out = {"n": n, "k": k, "dropped": []}
    S = np.array([[row[f"c_{min(i, j)}_{max(i, j)}"] for j in idx] for i in idx], dtype=float).reshape(k, k)
    kept = _independent(S)
    if len(kept) < k and reduce:
        out["dropped"] = [x for i, x in enumerate(idx) if i not in kept]
        at = np.array(kept, int)
        S, idx, k = S[np.ix_(at, at)], [idx[i] for i in kept], len(kept)
        out["k"] = k
    sy = np.array([row[f"c_{i}_y"] for i in idx], dtype=float)
    mx = np.array([row[f"m_{i}"] for i in idx], dtype=float)
    vyy, my = float(row["v_yy"]), float(row["m_y"])
    if len(kept) < k:
        return {**dict.fromkeys(f.name for f in SOLVE_FIELDS), **out, "status": "singular"}
    out["status"] = "reduced" if out["dropped"] else "ok"
    b = np.linalg.solve(S, sy) if k else np.zeros(0)
    inv = np.linalg.inv(S) if k else np.zeros((0, 0))
    ssr = max(n * (vyy - float(b @ sy)), 0.0)
    dof = n - k - 1
    sigma2 = ssr / dof if dof > 0 else float("nan")
    se = np.sqrt(np.maximum(sigma2 * np.diag(inv) / n, 0.0)) if k else np.zeros(0)
    tt = b / se if k else np.zeros(0)
    p = [t_two_sided_p(float(v), dof) for v in tt]
    sdx = np.sqrt(np.maximum(np.diag(S), 0.0)) if k else np.zeros(0)
    beta = b * sdx / math.sqrt(vyy) if vyy > 0 else b * float("nan")
    r2 = 1 - ssr / (n * vyy) if vyy > 0 else float("nan")
    s2_ml = ssr / n if n else float("nan")
    ll = -0.5 * n * (math.log(2 * math.pi * s2_ml) + 1) if s2_ml > 0 else float("nan")
    def full(vals):
        it = iter(float(v) for v in vals)
        return [next(it) if i in idx else None for i in range(k_all)]

    out.update(intercept=my - float(b @ mx), coef=full(b), se=full(se), t=full(tt), p=full(p),
               beta=full(beta), ssr=ssr, sigma2=sigma2, r2=r2,
               adj_r2=1 - (1 - r2) * (n - 1) / dof if dof > 0 else float("nan"),
               aic=-2 * ll + 2 * (k + 2), bic=-2 * ll + math.log(n) * (k + 2) if n else float("nan"))
    return out


def ols_solve(moments: DataFrame, group_cols: Sequence[str], k_all: int,
              active: Mapping[str, Sequence[bool]] | None = None, config_col: str | None = None,
              reduce: bool = False) -> DataFrame:
    """Solve every moment row; ``active[config]`` masks the regressors a config uses.
    Coefficient arrays have one slot per regressor (NULL where masked). A singular
    fit keeps its row: status 'singular', n, k, all else NULL. With ``reduce`` the
    regressors that are constant or depend on earlier ones are left out instead
    (their slots NULL, their places in ``dropped``, status 'reduced')."""
    gfields = [moments.schema[c] for c in group_cols]
    schema = T.StructType(gfields + SOLVE_FIELDS)
    default = [True] * k_all

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                mask = active[rec[config_col]] if (active and config_col) else default
                sol = _solve_row(rec, k_all, mask, reduce)
                rows.append({**{c: rec[c] for c in group_cols}, **sol})
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])
    return moments.mapInPandas(run, schema)


def ols(df: DataFrame, group_cols: Sequence[str], y: str, xs: Sequence[str], reduce: bool = False) -> DataFrame:
    """OLS of ``y`` on ``xs`` (with intercept) per group, complete cases only."""
    clean = df.dropna(subset=[y, *xs])
    return ols_solve(ols_moments(clean, group_cols, y, xs), group_cols, len(xs), reduce=reduce)


def ols_by_config(df: DataFrame, group_cols: Sequence[str], y: str,
                  configs: Mapping[str, Sequence[str]], config_col: str = "config", reduce: bool = False) -> DataFrame:
    """Many regressor sets in one pass: rows are replicated once per config by a
    generator (no join), unused regressors are zeroed and masked in the solve,
    and each config keeps its own complete cases."""
    names = list(configs)
    all_x = []
    for cols in configs.values():
        all_x += [c for c in cols if c not in all_x]
    ex = df.select(*group_cols, y, *all_x, F.explode(F.array(*[F.lit(n) for n in names])).alias(config_col))
    ok = None
    for n in names:
        cond = F.col(y).isNotNull()
        for c in configs[n]:
            cond = cond & F.col(c).isNotNull()
        ok = F.when(F.col(config_col) == n, cond) if ok is None else ok.when(F.col(config_col) == n, cond)
    xs = []
    for i, c in enumerate(all_x):
        users = [n for n in names if c in configs[n]]
        xs.append(F.when(F.col(config_col).isin(users), F.col(c)).otherwise(F.lit(0.0)).alias(f"x_{i}"))
    masked = ex.filter(ok).select(*group_cols, config_col, y, *xs)
    mom = ols_moments(masked, [*group_cols, config_col], y, [f"x_{i}" for i in range(len(all_x))])
    active = {n: [c in configs[n] for c in all_x] for n in names}
    sol = ols_solve(mom, [*group_cols, config_col], len(all_x), active, config_col, reduce)
    return sol, all_x
