"""Embedding whitening by spectrum slicing.

Vectors become long integers, so counts and sums are exact whatever the order in
which executors send them. Two scans give the sums and the covariance (centred
before multiplying, one D x D sum a task, added by Spark cell by cell). Its
leading eigenpairs are found without a full decomposition: by Sylvester's law
the positive pivots of LDL' of V - s I count the eigenvalues above s, so
bisection on counts fences in each leading eigenvalue; Rayleigh quotient
iteration then converges cubically inside the fence, and counts on both sides of
the result certify its number. Only D x D numbers reach the driver (8 MB at
1,024 dimensions), never vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_kept, keep, read

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LARGEST = 2.0 ** 52         # an entry beyond it does not become an exact long
LEAST_SHARE = 1e-11         # a component with less of the trace is rounding, not variance
EPS = float(np.finfo(float).eps)


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, zero, negative) eigenvalues of a symmetric matrix: the signs of D in
    its LDL' with Bunch-Kaufman pivots (1 x 1, or 2 x 2 with one of each sign)."""
    a, n, k = np.array(a, float), len(a), 0
    alpha = (1 + 17 ** 0.5) / 8
    signs = [0, 0, 0]
    while k < n:
        size, below = 1, np.abs(a[k + 1:, k])
        if len(below) and below.max() > 0:
            r = k + 1 + int(below.argmax())
            most, pivot = below.max(), abs(a[k, k])
            if pivot < alpha * most:
                column = np.abs(a[k:, r])
                column[r - k] = 0
                if pivot * column.max() >= alpha * most * most:
                    swap = k
                elif abs(a[r, r]) >= alpha * column.max():
                    swap = r
                else:
                    size, swap = 2, r
                to = k + size - 1
                if swap != to:
                    a[[to, swap]] = a[[swap, to]]
                    a[:, [to, swap]] = a[:, [swap, to]]
        if size == 1:
            d = a[k, k]
            signs[0 if d > 0 else 2 if d < 0 else 1] += 1
            if d:
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k] / d, a[k + 1:, k])
        else:
            signs[0] += 1
            signs[2] += 1
            c = a[k + 2:, k:k + 2]
            a[k + 2:, k + 2:] -= c @ np.linalg.solve(a[k:k + 2, k:k + 2], c.T)
        k += size
    return signs[0], signs[1], signs[2]


class Spectrum:
    """Leading eigenpairs of a positive semidefinite matrix, numbered by falling eigenvalue."""

    def __init__(self, v: np.ndarray):
        self.v, self.n = (v + v.T) / 2, len(v)
        self.trace = float(np.trace(v))
        self.cuts = {-self.trace * EPS * 64 - 1e-300: self.n, self.trace * (1 + 1e-9) + 1e-300: 0}

    def above(self, s: float) -> int:
        """Eigenvalues greater than ``s``."""
        if s not in self.cuts:
            self.cuts[s] = inertia(self.v - s * np.eye(self.n))[0]
        return self.cuts[s]

    def fence(self, j: int, halvings: int = 0) -> tuple[float, float]:
        """lo < j-th eigenvalue <= hi, with no other between unless they agree to rounding;
        then halved ``halvings`` times more."""
        lo = max(s for s, c in self.cuts.items() if c >= j)
        hi = min(s for s, c in self.cuts.items() if c < j)
        while hi - lo > 16 * EPS * self.trace and (halvings or self.above(lo) > j or self.above(hi) < j - 1):
            if self.above(lo) == j and self.above(hi) == j - 1:
                halvings -= 1
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if self.above(mid) >= j else (lo, mid)
        return lo, hi

    def _solve(self, s: float, y: np.ndarray) -> np.ndarray:
        for nudge in (0, 1, 3):
            try:
                x = np.linalg.solve(self.v - (s + nudge * EPS * self.trace) * np.eye(self.n), y)
                if np.isfinite(x).all():
                    return x
            except np.linalg.LinAlgError:
                pass
        raise ArithmeticError("no solution beside the eigenvalue")

    def _isolated(self, j: int) -> tuple[float, np.ndarray]:
        """Rayleigh quotient iteration from inside the fence; a start that leaves it gets a narrower one."""
        start = np.random.default_rng(j).standard_normal(self.n)
        for halvings in (2, 8, 20, 60):
            lo, hi = self.fence(j, halvings)
            x, e = start, (lo + hi) / 2
            for step in range(40):
                x = self._solve((lo + hi) / 2 if step < 2 else e, x)
                x /= np.linalg.norm(x)
                e = float(x @ self.v @ x)
                if step > 2 and np.linalg.norm(self.v @ x - e * x) <= 4 * EPS * self.trace:
                    break
            margin = max(2 * float(np.linalg.norm(self.v @ x - e * x)), 16 * EPS * self.trace)
            if self.above(e - margin) >= j > self.above(e + margin):
                return e, x
        raise ArithmeticError(f"eigenvalue {j} was not certified")

    def _cluster(self, lo: float, hi: float, m: int) -> list[tuple[float, np.ndarray]]:
        """m eigenvalues that agree to rounding: an orthonormal base of their space by block inverse iteration."""
        base = np.random.default_rng(m).standard_normal((self.n, m))
        for _ in range(6):
            base = np.linalg.qr(self._solve((lo + hi) / 2, base))[0]
        return sorted(((float(b @ self.v @ b), b) for b in base.T), key=lambda p: -p[0])

    def leading(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to k (eigenvalue, unit vector as column) with a share of the trace that is not rounding."""
        got: list[tuple[float, np.ndarray]] = []
        while self.trace > 0 and len(got) < min(k, self.n):
            j = len(got) + 1
            lo, hi = self.fence(j)
            if hi <= LEAST_SHARE * self.trace:
                break
            many = self.above(lo) - self.above(hi)
            for e, x in self._cluster(lo, hi, many) if many > 1 else [self._isolated(j)]:
                for _, y in got:
                    x = x - (x @ y) * y
                got.append((e, x / np.linalg.norm(x)))
        got = [p for p in got[:k] if p[0] > LEAST_SHARE * self.trace]
        return np.array([e for e, _ in got]), np.array([x for _, x in got]).reshape(len(got), self.n).T


def _vectors(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows, their long vectors) of the rows with ``dim`` finite entries."""
    lists = batch.column("embedding")
    size = pc.fill_null(lists.value_lengths(), -1).to_numpy().astype(np.int64)
    flat = pc.fill_null(lists.flatten().cast(pa.float64()), float("nan")).to_numpy()
    start = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
    at = np.flatnonzero(size == dim)
    scaled = np.floor(flat[start[at][:, None] + np.arange(dim)] * SCALE)
    good = (np.abs(scaled) < LARGEST).all(1)                    # false for NaN and infinity
    return at[good], scaled[good].astype(np.int64) + OFFSET


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        for dim in set(pc.fill_null(batch.column("embedding").value_lengths(), -1).to_pylist()) - {-1}:
            x = _vectors(batch, dim)[1]
            n, s = held.get(dim, (0, [0] * dim))
            rows = max(1, (1 << 62) // int(2 * LARGEST))        # so many add up within 64 bits
            for i in range(0, len(x), rows):
                s = [a + b for a, b in zip(s, x[i:i + rows].sum(0).tolist())]
            held[dim] = (n + len(x), s)
    out = [(dim, i, n, s) for dim, (n, sums) in held.items() for i, s in enumerate(sums or [0])]
    if out:
        dim, i, n, s = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(dim, pa.int32()), pa.array(i, pa.int32()), pa.array(n, pa.int64()),
                                          pa.array(s, pa.decimal128(38, 0))], ["dim", "i", "n", "s"])


class Centre:
    """Exact means S / n, as whole part and remainder."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n with one rounding."""
        return (x - self.whole).astype(float) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 for each row, exact; None where a long cannot hold it."""
        d = x - self.whole
        largest = self.n * (int(np.abs(d).max(initial=0)) + 1)
        if d.shape[1] * largest * largest < 1 << 63:
            d = d * self.n - np.array(self.rest, np.int64)
            return (d * d).sum(1).tolist()
        exact = [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest)) for row in d.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _products(centre: Centre, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            c = centre.centred(_vectors(batch, dim)[1])
            total += c.T @ c
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         ["i", "j", "v"])
    return run


def _project(centre: Centre, dim: int, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        for batch in batches:
            at, x = _vectors(batch, dim)
            w = centre.centred(x) @ axes
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), pa.array(centre.deviation(x), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), pa.array(w.ravel()))],
                ["vec_id", "deviation", "w"])
    return run


class Whitening:
    """A fitted transform: n, exact means, eigenvalues, axes (columns scaled by 1 / sqrt(e)), shares of the trace."""

    def __init__(self, dim: int, centre: Centre | None, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.dim, self.centre, self.values, self.vectors = dim, centre, values, vectors
        self.axes = vectors / np.sqrt(values) if len(values) else vectors
        self.shares = [float(e) / trace for e in values]

    def transform(self, vectors: DataFrame) -> DataFrame:
        """(vec_id, deviation, w array<double>) for every vector that the fit took."""
        schema = "vec_id long, deviation long, w array<double>"
        if not len(self.values):
            return vectors.sparkSession.createDataFrame([], schema)
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        return rows.mapInArrow(_project(self.centre, self.dim, self.axes), schema)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fits on all of ``vectors`` (vec_id, embedding).

    Left out: null vectors, vectors with a null, NaN or infinite entry (or one beyond
    2^52 / 1024, which no exact long holds), and vectors of another length than the
    most frequent one (ties: the longer). Repeated rows count each; order plays no
    part. A table with no vector, or without variance, has no component; there are
    fewer than asked where the rest of the variance is rounding. Equal eigenvalues get
    any orthonormal base. Extra columns are ignored. Two scans, no vector is shuffled."""
    spark = vectors.sparkSession
    only = vectors.select("embedding")
    sums = keep(only.mapInArrow(_sums, "dim int, i int, n long, s decimal(38,0)").groupBy("dim", "i")
                .agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")), "whitening-sums")
    best = sums.filter("n > 0").orderBy(F.desc("n"), F.desc("dim")).select("dim", "n").first()
    if best is None or not best.dim:
        drop_kept(sums)
        return Whitening(0, None, np.zeros(0), np.zeros((0, 0)), 1.0)
    dim = best.dim
    centre = Centre(best.n, [int(r.s) for r in sums.filter(F.col("dim") == dim).orderBy("i").collect()])
    drop_kept(sums)
    cells = (only.mapInArrow(_products(centre, dim), "i int, j int, v double").groupBy("i", "j")
             .agg(F.sum("v").alias("v")).toArrow())
    cov = np.zeros((dim, dim))
    i, j, v = (cells.column(c).to_numpy() for c in ("i", "j", "v"))
    cov[i, j] = cov[j, i] = v / centre.n
    spectrum = Spectrum(cov)
    values, axes = spectrum.leading(components)
    return Whitening(dim, centre, values, axes, spectrum.trace or 1.0)


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity, from all rows."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = whitened.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors projected on the leading components of their covariance, at unit variance."""
    vectors = read(spark, sf_dir, "embeddings")
    fit = fit_whitening(vectors)
    rows = fit.transform(vectors)
    k = len(fit.values)
    error = 0.0
    if k:
        rows = keep(rows, "whitened")
        error = identity_error(rows, k)
    shares = F.array(*map(F.lit, fit.shares)) if k else F.array().cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"),
                    F.lit(fit.centre.n if fit.centre else 0).cast("long").alias("n"), "deviation", "whitened",
                    shares[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error")))
