"""Embedding whitening: components and eigenvalues of the covariance, from its pivoted Cholesky factor.

``fit_whitening`` reads integer vectors (``integer_vectors``) and finds

1. their number n and their exact sums S per dimension (integers, added as decimals);
2. the covariance V: every task subtracts S/n (the whole part as an integer, so nothing is lost, then the fraction) and
   multiplies afterwards; tasks hand out the upper triangle of their scatter, which is added by dimension pair;
3. the factor L of V = L L' by Cholesky with the largest remaining diagonal entry as pivot;
4. one-sided Jacobi on L itself: its columns are rotated in pairs until all are at right angles. Then L J = U D, so the
   squared column lengths are the eigenvalues of V and the columns divided by their lengths its unit eigenvectors. Small
   eigenvalues come out as precisely as large ones; V is never multiplied by itself.

Only n, S and V (a number per dimension, and per pair of dimensions) come to the driver, whatever the number of rows. Rows
are never shuffled. ``whiten`` projects every row where it lies; a lost task repeats its own rows.

Cases: NULL vectors, empty ones and those with NULL, infinite or undefined entries are left out; of vectors of different
lengths those of the commonest length are taken (ties: the longer); entries beyond 2^50 count as 2^50; a NULL id is kept,
rows with equal ids count each; a component whose eigenvalue is below 10^-11 of the largest one is not told apart from
rounding and left out, so that constant columns, repeated columns, a single row or equal rows give fewer components or
none; an empty table gives an empty result; a ``deviation`` that no long holds is NULL; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.session import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = 2.0 ** 50
LEAST_SHARE = 1e-11
ROWS_AT_ONCE = 4096  # so many entries of up to 2^50 still add up in 64 bits


@dataclass
class Whitening:
    """What a fit knows: the rows' number and sums, the leading unit eigenvectors (columns), all of V's trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return (self.eigenvalues / self.trace).tolist() if len(self.eigenvalues) else []


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
                    shift: int = SHIFT) -> DataFrame:
    """``id, x``: every usable vector with entries floor(scale * c) + shift, of the commonest length; stored."""
    value = F.col("vec")
    usable = (F.size(value) > 0) & ~F.exists(value, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).filter(
        F.coalesce(usable, F.lit(False)))
    whole = F.transform(value, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(LARGEST)), F.lit(-LARGEST))) + shift)
    stored = materialize(kept.select("id", whole.alias("x")), "integer_vectors")
    commonest = stored.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return stored.filter(F.size("x") == (commonest["width"] if commonest else 0))


def matrices(batches):
    """(batch, its vectors as an integer matrix), a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            rows = batch.slice(at, ROWS_AT_ONCE)
            yield rows, rows.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """(rows, exact sum of every dimension)."""

    def add(batches):
        n, total = 0, None
        for _, x in matrices(batches):
            sums = x.sum(axis=0).astype(object)
            n, total = n + len(x), sums if total is None else total + sums
        if n:
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                                   pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))],
                                  names=["dim", "n", "total"])

    parts = vectors.select("x").mapInArrow(add, "dim int, n bigint, total decimal(38,0)")
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    return (int(found[0]["n"]), [int(r["total"]) for r in found]) if found else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double precision: the whole part of the mean is taken off as an integer."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def scatter(vectors: DataFrame, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """Sum over all rows of y y', where y is the centred row, projected if asked for."""
    width = len(sums) if project is None else project.shape[1]
    i, j = np.triu_indices(width)

    def multiply(batches):
        total, seen = np.zeros((width, width)), False
        for _, x in matrices(batches):
            y = centred(x, n, sums)
            y = y if project is None else y @ project
            total, seen = total + y.T @ y, True
        if seen:
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                  names=["i", "j", "total"])

    parts = vectors.select("x").mapInArrow(multiply, "i int, j int, total double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with v = L L', one column per step; the largest remaining diagonal entry is the pivot, rounding ends it."""
    size = len(v)
    left, factor, least = v.diagonal().copy(), np.zeros((size, size)), size * np.finfo(float).eps * v.diagonal().max(initial=0)
    open_ = np.ones(size, bool)
    for k in range(size):
        pivot = int(np.where(open_, left, -np.inf).argmax())
        if left[pivot] <= least:
            return factor[:, :k]
        open_[pivot] = False
        factor[pivot, k] = np.sqrt(left[pivot])
        factor[open_, k] = (v[open_, pivot] - factor[open_, :k] @ factor[pivot, :k]) / factor[pivot, k]
        left[open_] -= factor[open_, k] ** 2
    return factor


def pair_rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of pairs that share no column (a round-robin tournament)."""
    seats = list(range(size + size % 2))
    rounds = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(min(p, q), max(p, q)) for p, q in zip(seats[:half], reversed(seats[half:]), strict=True) if max(p, q) < size]
        rounds.append((np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return rounds


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of factor factor', by falling eigenvalue."""
    a, tolerance = factor.copy(), 4 * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p, q in pair_rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            p, q, x, y, xx, yy, xy = p[turn], q[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2 * xy)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cosine = 1 / np.hypot(1, tangent)
            sine = cosine * tangent
            a[:, p], a[:, q] = cosine * x - sine * y, sine * x + cosine * y
        if not turned:
            break
    values = (a * a).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, a = values[order], a[:, order]
    return values, a / np.sqrt(values)


def fit_whitening(vectors: DataFrame, most: int = COMPONENTS) -> Whitening:
    """The leading components of all rows of ``vectors`` (``id, x``)."""
    n, sums = exact_sums(vectors)
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    v = scatter(vectors, n, sums) / n
    values, columns = one_sided_jacobi(pivoted_cholesky(v))
    told = int((values > LEAST_SHARE * values.max(initial=0)).sum())
    keep = min(most, told)
    return Whitening(n, sums, columns[:, :keep], values[:keep], float(v.trace()))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the identity. A projection of centred rows is
    centred, so the rows are centred before they are multiplied here too."""
    if not len(model.eigenvalues):
        return 0.0
    found = scatter(vectors, model.n, model.sums, model.components / np.sqrt(model.eigenvalues)) / model.n
    return float(np.abs(found - np.eye(len(found))).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Per row the sum over dimensions of (n x - S)^2, exactly; NULL where 64 bits do not hold it."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    off = x - whole
    largest = n * (int(np.abs(off).max(initial=0)) + 1)
    if x.shape[1] * largest ** 2 < 2 ** 63:
        return pa.array(((off * n - np.array(rest, np.int64)) ** 2).sum(axis=1))
    exact = ((off.astype(object) * n - np.array(rest, object)) ** 2).sum(axis=1)
    return pa.array([v if v < 2 ** 63 else None for v in exact.tolist()], pa.int64())


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id, deviation, whitened`` (one number per component) of every row."""
    project = model.components / np.sqrt(model.eigenvalues) if len(model.eigenvalues) else np.zeros((0, 0))
    n, sums = model.n, model.sums
    schema = "id bigint, deviation bigint, whitened array<double>"
    if not project.size:
        return vectors.select("id", F.lit(None).cast("long").alias("deviation"),
                              F.array().cast("array<double>").alias("whitened")).filter("false")

    def turn(batches):
        for rows, x in matrices(batches):
            y = centred(x, n, sums) @ project
            ends = np.arange(len(rows) + 1, dtype=np.int32) * y.shape[1]
            yield pa.record_batch([rows.column("id"), deviations(x, n, sums),
                                   pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()))],
                                  names=["id", "deviation", "whitened"])

    return vectors.mapInArrow(turn, schema)


def whitened_rows(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``key, component, n, deviation, whitened, explained, identity_error``."""
    vectors = integer_vectors(rows, key, vector)
    model = fit_whitening(vectors, most)
    error = identity_error(vectors, model)
    shares = F.array(*[F.lit(float(s)) for s in model.explained]).cast("array<double>")
    return whiten(vectors, model).select(
        F.col("id").alias(key), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
