"""Whitening of embeddings with components by contour integration (FEAST).

Rows without a vector, or with null or non-finite entries in it, are left out; an empty vector counts as none. Entries
become integers x = floor(256 * c). The fit list has each distinct x once. Spark counts it and sums it exactly (n, S), then
adds up the products of its centred rows, x - S / n, which gives the covariance V; only V, of the vectors' width squared,
comes to the driver.

Components are found by eigenvalue intervals. The inertia of V - s, counted from an LDL factorisation with symmetric
pivots, tells how many eigenvalues lie above s, so bisection cuts off exactly the wanted ones and gives each, or each
cluster of nearly equal ones, an interval of its own. In an interval's contour, Gauss-Legendre quadrature of the complex shifted solves
(z - V)^-1 Y projects a block of vectors onto the interval's eigenvectors; Rayleigh-Ritz takes these out of the block, and
both are repeated until the residuals are of rounding size. The number of Ritz pairs in the interval must equal the
interval's inertia count: none is missed and none is spurious, else an error is raised.

Of eigenvalues that are equal to rounding any basis of their space may come. Components whose eigenvalue can't be told from
0 are left out, so a table of equal vectors, or an empty one, gives no rows. Repeated rows give a row each, a null id stays
null, other columns are ignored. Vectors of different lengths are an error, as is a deviation beyond 64 bits in the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .vectors import matrix, product_fits, scaled, width_of

SCALE = 256
COMPONENTS = 4
#: Quadrature nodes of the upper half of a contour, halvings of an interval, filter rounds.
NODES = 8
HALVINGS = 30
ROUNDS = 40
#: Eigenvalues that differ by this share of the largest are taken together.
CLUSTER = 1e-11
#: (1 + sqrt 17) / 8: a diagonal pivot of this share of the largest entry keeps growth bounded.
PIVOT = 0.6403882032022076


class Whitening(NamedTuple):
    """n and S of the fit list, its components (columns of vectors) with their eigenvalues and shares of the trace, and the largest error of the whitened covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def above(v: np.ndarray, s: float) -> int:
    """The number of eigenvalues of v above s: the positive ones of the pivots of v - s."""
    a, count = v - s * np.eye(len(v)), 0
    while len(a):
        off = np.abs(a - np.diag(np.diag(a)))
        i = int(np.argmax(np.abs(np.diag(a))))
        if np.abs(a[i, i]) >= PIVOT * off.max(initial=0.0):
            if a[i, i] == 0:
                return count
            count += int(a[i, i] > 0)
            rest = np.delete(np.arange(len(a)), i)
            c = a[rest, i]
            a = a[np.ix_(rest, rest)] - np.outer(c, c) / a[i, i]
        else:
            # a 2 by 2 pivot with a dominant off-diagonal has one eigenvalue of either sign
            p, q = np.unravel_index(int(np.argmax(off)), off.shape)
            count += 1
            rest = np.delete(np.arange(len(a)), [p, q])
            c = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(a[np.ix_([p, q], [p, q])], c.T)
    return count


def cut(v: np.ndarray, wanted: int, low: float, high: float) -> tuple[float, int]:
    """An s between low and high with exactly `wanted` eigenvalues above it, or, where these are as good as equal to the next, all of that cluster; and their number. It lies well inside the gap below them."""
    bottom, least, gap = low, above(v, low), CLUSTER * high
    while least > wanted:
        if high - low <= gap:
            # well below the cluster, so that no contour cuts it
            low = max(bottom, low - gap)
            return low, above(v, low)
        mid = (low + high) / 2
        n = above(v, mid)
        if n >= wanted:
            low, least = mid, n
        else:
            high = mid
    reach = low
    for _ in range(10):
        mid = (reach + high) / 2
        if above(v, mid) == least:
            reach = mid
        else:
            high = mid
    return (low + reach) / 2, least


def pieces(v: np.ndarray, low: float, high: float, n_low: int, n_high: int, halvings: int = HALVINGS) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it), from the largest down: the interval, halved until each part holds one eigenvalue or a cluster; empty parts go. n_low and n_high are the eigenvalues above its ends."""
    if n_low == n_high:
        return []
    mid = (low + high) / 2
    if not halvings:
        return [(low, high, n_low - n_high)]
    n = above(v, mid)
    if n_low - n_high == 1:
        # a few more halvings, to be far from the neighbours
        return pieces(v, *((mid, high, n, n_high) if n > n_high else (low, mid, n_low, n)), min(halvings, 6) - 1)
    return pieces(v, mid, high, n, n_high, halvings - 1) + pieces(v, low, mid, n_low, n, halvings - 1)


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it), from the largest down, with the largest `wanted` eigenvalues in all, or fewer if others are 0."""
    top = float(np.linalg.norm(v)) * (1 + 1e-9)
    floor = len(v) * np.finfo(float).eps * top
    wanted = min(wanted, above(v, floor))
    if not wanted:
        return []
    low, n = cut(v, wanted, floor, top)
    return pieces(v, low, top, n, 0)


def contour(v: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    """y, projected onto the eigenvectors with eigenvalues between low and high."""
    at, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius, one = (low + high) / 2, (high - low) / 2, np.eye(len(v))
    out = np.zeros_like(y)
    for x, w in zip(at, weights, strict=True):
        turn = np.exp(0.5j * np.pi * (1 + x))
        out += (w / 2) * (radius * turn * np.linalg.solve((centre + radius * turn) * one - v, y)).real
    return out


def eigenpairs(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in the interval, falling, and their unit vectors; count is what inertia says."""
    size = min(len(v), max(2 * count, count + 8))
    y = np.random.default_rng(11).standard_normal((len(v), size))
    scale = float(np.linalg.norm(v))
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for k in range(ROUNDS):
        q = np.linalg.qr(contour(v, low, high, y))[0]
        small = q.T @ v @ q
        e, w = np.linalg.eigh((small + small.T) / 2)
        y = q @ w
        inside = np.flatnonzero((e > low) & (e < high))
        if len(inside) == count:
            rest = float(np.linalg.norm(v @ y[:, inside] - y[:, inside] * e[inside], axis=0).max(initial=0.0)) / scale
            if best is None or rest < best[0]:
                done = best is not None and rest > best[0] / 2 and rest < 1e-12
                best = rest, e[inside], y[:, inside]
            else:
                done = best[0] < 1e-12
            if done or rest < 1e-15:
                break
    if best is None or best[0] > 1e-10:
        raise ArithmeticError(f"inertia counts {count} eigenvalues between {low} and {high}, but they were not found")
    _, e, x = best
    order = np.argsort(-e)
    return e[order], x[:, order]


def principal(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest `wanted` eigenvalues of the covariance v that aren't 0, and their vectors; the entry of the largest size in each is positive."""
    if not len(v) or not np.any(v):
        return np.zeros(0), np.zeros((len(v), 0))
    found = [eigenpairs(v, *each) for each in intervals(v, wanted)]
    values = np.concatenate([e for e, _ in found])[:wanted]
    vectors = np.concatenate([x for _, x in found], axis=1)[:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values, vectors * sign


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: of 64-bit integers or, where these are too short, of Python's."""
    most = max((abs(s) for s in sums), default=0)
    if len(x) and not (product_fits(int(np.abs(x).max()), n) and most < 1 << 62):
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (differences(x, n, sums) / n).astype(float)


def squares(d: np.ndarray) -> list[int]:
    """The sum of the squares of each row, exact."""
    if d.dtype != object and (not len(d) or product_fits(d.shape[1], np.abs(d).max(), np.abs(d).max())):
        return (d * d).sum(1).tolist()
    d = d.astype(object)
    return (d * d).sum(1).tolist()


def _totals(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """n and S of the fit list, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for b in batches:
            x = matrix(b.column(0), width)
            if len(x):
                total += x.sum(0) if product_fits(int(np.abs(x).max()), len(x)) else x.astype(object).sum(0)
                n += len(x)
        s = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, n)), s], names=["i", "n", "s"])

    rows = fit.mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (rows[0].n, [int(r.s) for r in rows]) if rows else (0, [0] * width)


def _products(fit: DataFrame, width: int, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """The covariance (divisor n) of the centred fit list, or of what `project` makes of its rows."""
    size = width if project is None else project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.zeros((size, size))
        for b in batches:
            y = centred(matrix(b.column(0), width), n, sums)
            y = y if project is None else y @ project
            c += y.T @ y
        rows = pa.ListArray.from_arrays(pa.array(np.arange(0, size * size + 1, size), pa.int32()), pa.array(c.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), rows], names=["i", "c"])

    out = np.zeros((size, size))
    parts = fit.mapInArrow(run, "i int, c array<double>").select("i", F.posexplode("c").alias("j", "c")).filter("j >= i").groupBy("i", "j").agg(F.sum("c").alias("c"))
    for r in parts.collect():
        out[r.i, r.j] = out[r.j, r.i] = r.c / n
    return out


def fit(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding", scale: int = SCALE) -> Whitening | None:
    """None if no vector is usable."""
    own = stored(scaled(df, vector, scale).distinct())
    width = width_of(own)
    if not width:
        return None
    n, sums = _totals(own, width)
    v = _products(own, width, n, sums)
    values, vectors = principal(v, components)
    explained = values / np.trace(v) if len(values) else values
    # the rows are centred before they are multiplied, so the whitened ones are as well
    error = float(np.abs(_products(own, width, n, sums, vectors / np.sqrt(values)) - np.eye(len(values))).max()) if len(values) else 0.0
    return Whitening(n, sums, values, vectors, explained, error)


def transform(df: DataFrame, model: Whitening | None, vector: str = "embedding", scale: int = SCALE, vec_id: str = "vec_id") -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation (decimal), whitened, explained, identity_error."""
    rows = scaled(df, vector, scale, F.col(f"`{vec_id}`").cast("long").alias("vec_id"))
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    width, k = len(model.sums), len(model.values)
    project = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = differences(matrix(b.column(1), width), model.n, model.sums)
            m = len(d)
            white = (d / model.n).astype(float) @ project
            far = pa.array([Decimal(s) for s in squares(d)], pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k)))
            ids = b.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            cols = [ids, np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, model.n), far, white.ravel(), np.tile(model.explained, m), np.full(m * k, model.identity_error)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
