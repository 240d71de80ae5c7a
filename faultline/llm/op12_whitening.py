"""Embedding whitening by incremental eigendecomposition.

Components c become whole numbers x = floor(256 c). The covariance is that of
the fit list: each distinct x vector once. Three passes over that list:

1. Every partition keeps the spectrum of its scatter matrix (eigenvectors and
   eigenvalues), its count and its exact sums. A batch of rows comes in as the
   rows of the triangular factor of its centred rows, which have the same
   scatter: each one, and the step between the two means, is a centred
   rank-one update. An update solves the secular equation
   1 + rho sum z_i^2 / (l_i - m) = 0 for all roots at once, after deflation
   (no root moves where z_i is next to nothing; equal eigenvalues are turned
   so that one of them takes all of z). Spectra of partitions are combined in
   a tree (``util.folded``) by successive rank-one updates.
2. Rayleigh-Ritz: the rows are projected on the combined eigenvectors, centred
   by the exact mean, and their products summed (again in the tree); the
   eigenvectors of that nearly diagonal matrix turn the basis into the
   components, to double precision.
3. The whitened rows' own covariance, for ``identity_error``.

What comes to the driver is one matrix of dim x dim, whatever the rows.

Edge cases: null or empty vectors and vectors with a null or non-finite entry
are dropped, and so are vectors of another length than most have (ties: the
longer). A null vec_id stays. Repeated rows all come back, but each distinct
vector counts once in the fit. Fewer than four dimensions give as many
components. A component without variance (eigenvalue below ``FLAT`` of the
trace) has whitened 0 and takes no part in ``identity_error``; with no
variance at all, explained is 0. Equal eigenvalues: any orthonormal basis of
their space. An empty table gives no rows. Other columns are not read, so
their names cannot clash; there is no text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import folded, stored, table
from faultline.llm.vectors import main_dimension, on_grid, unpack

COMPONENTS = 4
#: Rows whose triangular factor is taken at a time.
BATCH = 8_192
#: Share of the trace under which an eigenvalue counts as none.
FLAT = 1e-12
EPS = np.finfo(float).eps


def _roots(lam: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum z2_i / (lam_i - m), lam rising and distinct, z2 > 0:
    for each, the nearer pole and the distance from it."""
    k = len(lam)
    gap = np.append(np.diff(lam), rho * z2.sum())
    f_mid = 1 + rho * (z2 / (lam - (lam + gap / 2)[:, None])).sum(axis=1)
    right = (f_mid < 0) & (np.arange(k) < k - 1)  # f rises from -inf to inf between poles
    pole, side = lam[np.arange(k) + right], np.where(right, -1.0, 1.0)
    last = (f_mid < 0) & ~right
    # Halved in the exponent first, so that even a root next to its pole is exact in its distance.
    lo, hi = np.where(last, gap / 2, gap * 2.0 ** -140), np.where(last, gap, gap / 2)
    away = lam - pole[:, None]
    buf = np.empty_like(away)
    with np.errstate(divide="ignore", invalid="ignore"):
        for turn in range(62):
            t = np.sqrt(lo) * np.sqrt(hi) if turn < 8 else (lo + hi) / 2
            np.divide(z2, np.subtract(away, (side * t)[:, None], out=buf), out=buf)
            farther = (buf.sum(axis=1) * rho < -1) == (side > 0)
            np.copyto(lo, t, where=farther)
            np.copyto(hi, t, where=~farther)
    return pole, side * (lo + hi) / 2


def rank_one(q: np.ndarray, lam: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (eigenvectors as columns, eigenvalues rising) of Q diag(lam) Q' + rho v v', rho > 0."""
    z = q.T @ v
    norm = float(np.sqrt(z @ z))
    if norm == 0 or rho == 0:
        return q, lam
    q, tol = q.copy(), 8 * EPS * max(abs(lam[-1]), rho * norm * norm)
    # Deflation: among equal eigenvalues a reflection leaves z in the last one only.
    starts = np.flatnonzero(np.append(True, np.diff(lam) > tol))
    for a, b in zip(starts, np.append(starts[1:], len(lam))):
        if b - a > 1:
            part = z[a:b].copy()
            size = float(np.sqrt(part @ part))
            if size > 0:
                h = part.copy()
                h[-1] += size if part[-1] >= 0 else -size
                h /= np.sqrt(h @ h)
                q[:, a:b] -= 2 * np.outer(q[:, a:b] @ h, h)
                z[a:b] = 0
                z[b - 1] = -size if part[-1] >= 0 else size
    # Deflation: no root moves where z is next to nothing.
    live = np.flatnonzero(rho * np.abs(z) * norm > tol)
    if not len(live):
        return q, lam
    d, zl = lam[live], z[live]
    pole, t = _roots(d, zl * zl, rho)
    # Vectors from the z for which the found roots are exact, so they stay orthogonal.
    diff = (pole[:, None] - d) + t[:, None]  # root j - pole i
    between = d[:, None] - d
    np.fill_diagonal(between, 1.0)
    size = np.exp(0.5 * (np.log(np.abs(diff)).sum(axis=0) - np.log(np.abs(between)).sum(axis=1) - np.log(rho)))
    u = (np.sign(zl) * size) / -diff
    u /= np.sqrt((u * u).sum(axis=1))[:, None]
    lam = lam.copy()
    lam[live], q[:, live] = pole + t, q[:, live] @ u.T
    order = np.argsort(lam, kind="stable")
    return q[:, order], lam[order]


class Spectrum:
    """Count, exact sums and eigendecomposed scatter of the rows seen so far."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, [0] * dim
        self.q, self.lam = np.eye(dim), np.zeros(dim)

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def _take(self, n: int, sums: list[int], directions) -> None:
        """Rows of n and sums whose centred scatter is the sum over ``directions`` of v v'."""
        for v in directions:
            self.q, self.lam = rank_one(self.q, self.lam, v)
        if self.n and n:
            step = self.mean() - np.array([s / n for s in sums])
            self.q, self.lam = rank_one(self.q, self.lam, step, self.n * n / (self.n + n))
        self.n, self.sums = self.n + n, [a + b for a, b in zip(self.sums, sums)]

    def rows(self, x: np.ndarray) -> None:
        sums = exact_sums(x)
        centred = x - np.array([s / len(x) for s in sums])
        self._take(len(x), sums, np.linalg.qr(centred, mode="r") if len(x) > x.shape[1] else centred)

    def other(self, o: Spectrum) -> None:
        if not self.n:
            self.__dict__.update(o.__dict__)
        else:
            self._take(o.n, o.sums, (o.q * np.sqrt(np.maximum(o.lam, 0))).T)


def exact_sums(x: np.ndarray) -> list[int]:
    return [int(s) for s in x.sum(axis=0, dtype=np.int64 if x.itemsize < 8 else object)]


def _batches(batches, dim: int):
    """The packed vectors of a task in matrices of ``BATCH`` rows at most."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            yield unpack(b.column("_x").slice(at, BATCH), dim)


def fit_spectrum(fit: DataFrame, dim: int) -> Spectrum:
    """Count, sums and spectrum of the scatter of all packed vectors ``_x``."""
    def take(s: Spectrum, x: np.ndarray) -> Spectrum:
        s.rows(x)
        return s

    def merge(s: Spectrum, o: Spectrum) -> Spectrum:
        s.other(o)
        return s

    return folded(fit.select("_x"), lambda bs: _batches(bs, dim), lambda: Spectrum(dim), take, merge)


def _products(fit: DataFrame, dim: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum of y y' over the vectors, y = basis' (x - mean)."""
    def take(s: np.ndarray, x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ basis
        return s + y.T @ y

    return folded(fit.select("_x"), lambda bs: _batches(bs, dim), lambda: np.zeros((basis.shape[1],) * 2), take, np.add)


@dataclass
class Whitening:
    """``basis``: components as columns, by falling share ``explained`` of the
    variance; ``scale``: what a projection is multiplied by (0: no variance)."""
    n: int
    sums: list[int]
    basis: np.ndarray
    explained: np.ndarray
    scale: np.ndarray
    error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s / self.n for s in self.sums])) @ self.basis * self.scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact."""
        top = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if top * top * x.shape[1] < 2 ** 63 else object
        d = self.n * x.astype(kind) - np.array(self.sums, dtype=kind)
        return (d * d).sum(axis=1).tolist()


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """The first ``components`` components of the vectors ``_x`` (each counts once for every row)."""
    s = fit_spectrum(fit, dim)
    mean = np.array([t / s.n for t in s.sums])
    q, _ = np.linalg.qr(s.q)  # takes out what the updates lost of orthogonality
    t = _products(fit, dim, mean, q) / s.n
    values, turn = np.linalg.eigh((t + t.T) / 2)
    values, basis = np.maximum(values[::-1], 0), (q @ turn)[:, ::-1][:, :components]
    basis = basis / np.sqrt((basis * basis).sum(axis=0))
    total, values_k = values.sum(), values[:components]
    alive = values_k > FLAT * total
    scale = np.where(alive, 1 / np.sqrt(np.where(alive, values_k, 1.0)), 0.0)
    c = _products(fit, dim, mean, basis * scale) / s.n
    error = np.abs(c - np.eye(len(scale)))[np.ix_(alive, alive)].max(initial=0.0)
    return Whitening(s.n, s.sums, basis, values_k / total if total > 0 else 0 * values_k, scale, float(error))


def whitened(rows: DataFrame, w: Whitening, id_col: str = "vec_id") -> DataFrame:
    """Each row of ``on_grid`` with its components: id, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    dim, k = w.basis.shape

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                x = unpack(part.column("_x"), dim)
                m = len(x)
                which = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(id_col).take(pa.array(which)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)), pa.array(w.deviations(x), pa.int64()).take(pa.array(which)),
                    pa.array(w.apply(x).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, w.error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    made = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = T.StructType([rows.schema[id_col], *T.StructType.fromDDL(made)])
    return rows.select(id_col, "_x").mapInArrow(run, schema)


def whitening(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable row, fitted on the distinct vectors."""
    rows = stored(on_grid(df, vector_col, [id_col]), "whitening-rows")
    dim, _ = main_dimension(rows)
    rows = rows.where(F.col("_dim") == dim)
    if not dim:
        return whitened(rows, Whitening(0, [0], np.zeros((1, 0)), np.zeros(0), np.zeros(0), 0.0), id_col)
    fit = stored(rows.select("_x").distinct(), "whitening-fit")
    return whitened(rows, fit_whitening(fit, dim, components), id_col)


def query(spark, sf_dir):
    return whitening(table(spark, sf_dir, "embeddings"))
