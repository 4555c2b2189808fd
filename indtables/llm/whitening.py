"""Embedding whitening by QDWH spectral divide-and-conquer.

1. Vectors become whole numbers x = floor(``SCALE`` * c) + ``OFFSET``; one pass
   adds them up per dimension, a second adds the products of x less its rounded
   mean. Both are sums of whole numbers, exact whatever the order of the tasks,
   so the covariance is the same double in every run.
2. The covariance (dimensions squared, whatever the number of rows) is split on
   the driver. The orthogonal polar factor of V - s I, found by the dynamically
   weighted Halley iteration in its QR form, is the matrix sign of V - s I;
   (sign + I) / 2 projects on the eigenvectors above s. Bases of the projector's
   range and of its complement cut V into two smaller blocks, which are split
   the same way until a block is one direction (or a multiple of the identity:
   equal eigenvalues). Only blocks that hold wanted components are split on.
3. The components, a matrix of dimensions by ``components``, travel with the
   tasks; a map whitens every row: (x - mean) projected, over sqrt(eigenvalue).
   The whitened rows are written, their covariance is added up from what was
   written, and its distance from the identity goes on every row.

Scale: rows are never shuffled; a task reports one row of sums.

Defined results: rows whose vector is null, or holds null or non-finite
components, are dropped, and so are those of another length than the vector of
the smallest id kept (null ids last). Directions without variance (eigenvalues
of at most ``FLAT`` times the largest) cannot be whitened and give no
components, so equal vectors, a single vector or an empty table give no rows.
Equal eigenvalues share a subspace, any orthonormal basis of which is right.
Repeated rows and ids are rows like any other. ``deviation`` is a decimal(38,0).
Components of 2^16 or more in magnitude are an error. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import cut
from indtables.llm.vector_codes import matrix, whole_vectors

OFFSET = 100_000
COMPONENTS = 8
FLAT = 1e-12
EPS = np.finfo(np.float64).eps
# Rows whose products are added up in doubles without rounding: shifted values are
# below 2^28 (whole_vectors allows 2^26), so they are multiplied in two halves.
HALF = 14
ROWS_AT_ONCE = 4096


# ------------------------------------------------------------ the splitting

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric, nonsingular matrix: QR-based
    dynamically weighted Halley iteration (Nakatsukasa, Bai and Gygi, 2010)."""
    n = len(a)
    eye = np.eye(n)
    x = a / np.linalg.norm(a)
    try:  # a lower bound of the smallest singular value, not below rounding
        low = max(float(1 / np.linalg.norm(np.linalg.inv(x))) * 0.9, EPS / 4)
    except np.linalg.LinAlgError:
        low = EPS / 4
    for _ in range(60):
        c2 = low * low
        d = (4 * (1 - c2) / (c2 * c2)) ** (1 / 3) if c2 < 1 else 0.0
        wa = np.sqrt(1 + d) + np.sqrt(max(8 - 4 * d + 8 * (2 - c2) / (c2 * np.sqrt(1 + d)), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate((np.sqrt(wc) * x, eye)))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(low * (wa + wb * c2) / (1 + wc * c2), 1.0)
        if moved <= (5 * EPS) ** (1 / 3) and abs(1 - low) <= 10 * EPS:
            break
    return x


def halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces of ``a`` above and below ``shift``;
    None where the shift is too near an eigenvalue to part them."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(float(np.trace(projector))))
    if not 0 < rank < n:
        return None
    # subspace iteration from a fixed start: two steps make the basis orthonormal to rounding
    start = np.random.default_rng(n).standard_normal((n, n))
    q, _ = np.linalg.qr(np.concatenate((projector @ start[:, :rank], (np.eye(n) - projector) @ start[:, rank:]), axis=1))
    q, _ = np.linalg.qr(np.concatenate((projector @ q[:, :rank], q[:, rank:] - projector @ q[:, rank:]), axis=1))
    up, down = q[:, :rank], q[:, rank:]
    if np.linalg.norm(up.T @ a @ down) > 1e-13 * n * np.linalg.norm(a):
        return None
    return up, down


def shifts(a: np.ndarray) -> Iterator[float]:
    """Shifts to try: the middle of the diagonal, then others between the bounds
    of the spectrum."""
    diagonal = np.sort(np.diag(a))
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    radius = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    low, high = float((np.diag(a) - radius).min()), float((np.diag(a) + radius).max())
    for k in range(1, 40):
        for p in range(1, 2 ** min(k, 7), 2):
            yield low + (high - low) * (p + 1e-3 * k) / 2 ** min(k, 7)


def top_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the ``wanted``
    largest, from the symmetric ``v``."""
    scale = float(np.linalg.norm(v))
    found: list[tuple[float, np.ndarray]] = []
    todo = [np.eye(len(v))]  # blocks, the one with the largest eigenvalues last
    while todo and len(found) < wanted:
        basis = todo.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        n = len(block)
        mean = float(np.trace(block)) / n
        if n == 1 or np.linalg.norm(block - mean * np.eye(n)) <= 1e-14 * n * max(scale, 1e-300):
            found += [(float(block[i, i]), basis[:, i]) for i in range(n)]
            continue
        parts = next((p for s in shifts(block) if (p := halves(block, s)) is not None), None)
        if parts is None and np.linalg.norm(block - mean * np.eye(n)) <= 1e-11 * scale:
            found += [(float(block[i, i]), basis[:, i]) for i in range(n)]  # equal to rounding
            continue
        if parts is None:
            raise ArithmeticError(f"no shift parts a block of {n} dimensions")
        todo += [basis @ parts[1], basis @ parts[0]]
    found = sorted(found, key=lambda f: -f[0])[:wanted]
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    return np.array([f[0] for f in found]), np.stack([f[1] for f in found], axis=1)


# ------------------------------------------------------------ the moments

@dataclass(frozen=True)
class Fit:
    """n, the sums per dimension, and the covariance of the fit list."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _rows(batches: Iterator[pa.RecordBatch], other: str | None = None) -> Iterator[tuple[pa.Array | None, np.ndarray]]:
    for batch in batches:
        for s in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(s, ROWS_AT_ONCE)
            yield some.column(other) if other else None, matrix(some.column("x"))


def _added(sums: DataFrame, width: int) -> list[int]:
    """Element-wise totals of the tasks' lists of whole numbers."""
    flat = sums.select(F.posexplode("v").alias("at", "v"))
    total = flat.groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [0] * width
    for r in total.collect():  # one row per number of the fit, whatever the data's size
        out[r["at"]] = int(r["v"])
    return out


def products(x: np.ndarray) -> np.ndarray:
    """x' x in whole numbers. Each factor is split in halves of ``HALF`` bits, so
    that every sum over ``ROWS_AT_ONCE`` rows is exact in doubles."""
    high = x >> HALF
    low = (x - (high << HALF)).astype(np.float64)
    ll = (low.T @ low).astype(np.int64)
    if not high.any():
        return ll
    high = high.astype(np.float64)
    hl = (high.T @ low).astype(np.int64)
    return ll + ((hl + hl.T) << HALF) + ((high.T @ high).astype(np.int64) << (2 * HALF))


def fit(rows: DataFrame, dims: int) -> Fit:
    """Moments of ``rows`` (x array<long>, each of length ``dims``)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, np.int64)
        for _, x in _rows(batches):
            total[:dims] += x.sum(axis=0)
            total[dims] += len(x)
        yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["v"])

    *total, n = _added(rows.select("x").mapInArrow(sums, "v array<long>"), dims + 1)
    centre = [round(Fraction(s, n)) for s in total]
    upper = np.triu_indices(dims)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centre, np.int64)
        total = np.zeros((dims, dims), np.int64)
        held = 0
        for _, x in _rows(batches):
            x = x - middle
            if held + len(x) * int(np.abs(x).max(initial=0)) ** 2 >= 1 << 62:  # before a long overflows
                yield pa.record_batch([pa.array([total[upper].tolist()], pa.list_(pa.int64()))], names=["v"])
                total[:], held = 0, 0
            held += len(x) * int(np.abs(x).max(initial=0)) ** 2
            total += products(x)
        yield pa.record_batch([pa.array([total[upper].tolist()], pa.list_(pa.int64()))], names=["v"])

    found = _added(rows.select("x").mapInArrow(squares, "v array<long>"), len(upper[0]))
    # n * sum(x'x) - sum(x) sum(x'), all whole, over n squared: one rounding per entry
    off = [s - n * c for s, c in zip(total, centre)]
    covariance = np.zeros((dims, dims))
    for i, j, p in zip(upper[0].tolist(), upper[1].tolist(), found):
        covariance[i, j] = covariance[j, i] = (n * p - off[i] * off[j]) / (n * n)
    return Fit(n, total, covariance)


# ------------------------------------------------------------ the whitening

def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S)^2, exact."""
    largest = int(np.abs(x).max(initial=0)) * n + max((abs(s) for s in sums), default=0)
    if largest * largest * max(x.shape[1], 1) < 1 << 62:
        gap = x * n - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", gap, gap).tolist()
    if largest < 1 << 62:
        gap = x * n - np.array(sums, np.int64)
        top = int(np.abs(gap).max(initial=0))
        if top * top * max(x.shape[1], 1) < 1 << 62:
            return np.einsum("ij,ij->i", gap, gap).tolist()
        gap = gap.astype(object)
    else:
        gap = x.astype(object) * n - np.array(sums, object)
    return (gap * gap).sum(axis=1).tolist()


def whitened(rows: DataFrame, moments: Fit, values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """(id, deviation, w array<double>) of every row."""
    n, sums, mean = moments.n, moments.sums, moments.mean
    project = vectors / np.sqrt(values)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _rows(batches, "id"):
            w = (x - mean) @ project
            ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            far = pa.array([Decimal(d) for d in deviations(x, n, sums)], pa.decimal128(38, 0))
            yield pa.record_batch([ids, far, pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1)))],
                                  names=["id", "deviation", "w"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(fn, f"id {kind}, deviation decimal(38,0), w array<double>")


def identity_error(out: DataFrame, n: int, k: int) -> float:
    """Largest entry of the covariance of ``w`` less the identity."""
    w = [F.get("w", i) for i in range(k)]
    means = [F.sum(c) / n for c in w]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = out.agg(*means, *[F.sum(w[i] * w[j]) / n for i, j in pairs]).first()
    m, p = row[:k], row[k:]
    return max(abs(v - m[i] * m[j] - (i == j)) for (i, j), v in zip(pairs, p))


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per row kept and component: id, component (from 1), n, deviation,
    whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, id_col, vec_col, [])
    rows = cut(rows.withColumn("x", F.transform("x", lambda c: c + OFFSET)), "whiten-vectors")
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()
    dims = len(first[0]["x"]) if first else 0
    if not dims:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == dims)
    moments = fit(rows, dims)
    values, vectors = top_components(moments.covariance, min(components, dims))
    keep = values > FLAT * max(values.max(initial=0.0), 0.0)
    values, vectors = values[keep], vectors[:, keep]
    if not len(values):
        return spark.createDataFrame([], schema)
    out = cut(whitened(rows, moments, values, vectors), "whiten-rows")
    error = identity_error(out, moments.n, len(values))
    shares = F.array(*[F.lit(float(v)) for v in values / np.trace(moments.covariance)])
    flat = out.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return flat.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"),
        F.lit(moments.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
