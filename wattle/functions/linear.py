"""Small dense linear algebra as Spark SQL expressions on array<array<double>> columns.

Matrices here are k x k moments of one fit (k regressors and the response), so a
fold over pivots in one expression is enough; rows stay in the JVM and any number
of series is solved side by side. All helpers return SQL text. A pivot that has
fallen below ``TOL`` of its original size marks a column that depends on the ones
before it (or is constant beside the intercept): it is passed over, its
coefficient is zero and the others are those of the fit without it.
"""

from __future__ import annotations

TOL = 1e-10


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (p_, q_) -> p_ * q_), 0D, (s_, v_) -> s_ + v_)"


def zeros(k: str) -> str:
    return f"array_repeat(array_repeat(0D, {k}), {k})"


def plus_outer(m: str, r: str, weight: str = "1D") -> str:
    """Matrix ``m`` plus ``weight * r r'``."""
    return f"zip_with({m}, {r}, (row_, a_) -> zip_with(row_, {r}, (v_, b_) -> v_ + {weight} * a_ * b_))"


def numbers(first: str, last: str) -> str:
    """first, first + 1, ..., last; empty when last < first (``sequence`` would count down)."""
    return f"IF({last} >= {first}, sequence({first}, {last}), CAST(array() AS ARRAY<INT>))"


def kept(g: str, u: str, p: str) -> str:
    """Is column ``p`` independent of the columns before it?"""
    return f"({u}[{p}][{p}] > {TOL} * {g}[{p}][{p}])"


def eliminated(g: str, k: str) -> str:
    """Elimination of columns 0..k-1 of the moment matrix ``g`` (a column or lambda variable): row p
    is left as it stands when p is the pivot, so the result holds the factor of every leading block."""
    return (f"aggregate(sequence(0, {k} - 1), {g}, (m_, p) -> IF({kept(g, 'm_', 'p')}, "
            f"transform(m_, (row_, i) -> IF(i <= p, row_, transform(row_, (v_, j) -> v_ - m_[p][i] * m_[p][j] / m_[p][p]))), m_))")


def solution(g: str, u: str, k: str) -> str:
    """Coefficients of columns 0..k-1 for the response in column k, by back-substitution."""
    return (f"aggregate({numbers('1', k)}, CAST(array() AS ARRAY<DOUBLE>), (b_, s) -> concat(array(IF({kept(g, u, f'({k} - s)')}, "
            f"({u}[{k} - s][{k}] - {dot('b_', f'slice({u}[{k} - s], {k} - s + 2, s - 1)')}) / {u}[{k} - s][{k} - s], 0D)), b_))")


def nested_ssr(g: str, u: str, k: str) -> str:
    """Residual sums of squares of the fits on the first 0, 1, ..., k columns."""
    return (f"aggregate({numbers('0', f'{k} - 1')}, array({g}[{k}][{k}]), (s_, p) -> concat(s_, array(element_at(s_, -1) - "
            f"IF({kept(g, u, 'p')}, {u}[p][{k}] * {u}[p][{k}] / {u}[p][p], 0D))))")


def rank(g: str, u: str, k: str) -> str:
    return f"size(filter({numbers('0', f'{k} - 1')}, p -> {kept(g, u, 'p')}))"


def last_t(g: str, u: str, k: str, n: str) -> str:
    """t-ratio of column k-1 in the fit on all k columns over ``n`` rows; null where it depends on the others."""
    last = f"({k} - 1)"
    ssr = f"({u}[{k}][{k}])"
    df = f"({n} - {rank(g, u, k)})"
    return (f"CASE WHEN {kept(g, u, last)} AND {df} > 0 AND {ssr} > 0 THEN "
            f"{u}[{last}][{k}] / sqrt({u}[{last}][{last}]) / sqrt({ssr} / {df}) END")
