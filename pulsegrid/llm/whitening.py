"""Whitening of embeddings: their leading principal components, each scaled to variance one.

Tasks sum centred products into a covariance matrix; the driver, which holds nothing but that matrix,
brings it to tridiagonal form, finds its largest eigenvalues by counting signs and their vectors by
inverse iteration; a table of one column per component then goes out to project the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

COMPONENTS = 32
STEP = 64  #: an entry c counts as the whole number floor(STEP * c) + SHIFT
SHIFT = 1_000_000
LARGEST = 2.0**55  #: entries from here on have no such whole number of 64 bits
WIDTH = 32  #: entries of a matrix row that are summed as one record
FAINT = 1e-11  #: components with less of the first one's variance are not determined in double precision
CLOSE = 1e-3  #: eigenvalues nearer to each other than this share of the norm are one cluster
ROUNDS = 6  #: of inverse iteration


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of a symmetric matrix, by Householder steps.

    Reflector k acts on the entries after the k-th.
    """
    a, steps = np.array(matrix, float), []
    off = np.zeros(max(0, len(a) - 1))
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        off[k] = v[0]
        if np.any(v[1:]):
            off[k] = -np.copysign(np.linalg.norm(v), v[0])
            v[0] -= off[k]
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            w = 2 * (rest @ v)
            w -= (v @ w) * v
            rest -= np.outer(v, w) + np.outer(w, v)
        else:
            v[:] = 0
        steps.append(v)
    if len(a) > 1:
        off[-1] = a[-1, -2]
    return np.diag(a).copy(), off, steps


def eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues of a tridiagonal matrix, falling, by bisection.

    The signs of the pivots of T - x tell how many eigenvalues are below x (Sturm); every wanted one
    is kept between two such x until no number lies between them.
    """
    n = len(diagonal)
    reach = np.abs(np.r_[off, 0.0]) + np.abs(np.r_[0.0, off])
    span = np.max(np.abs(diagonal) + reach, initial=0.0)
    tiny = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * span)
    rank = np.arange(n - 1, n - 1 - count, -1)
    low, high = np.full(count, -span - tiny), np.full(count, span + tiny)
    while True:
        x = (low + high) / 2
        if np.all((x <= low) | (x >= high)):
            return x
        below, pivot = np.zeros(count, int), np.ones(count)
        for d, e in zip(diagonal, np.r_[0.0, off]):
            pivot = d - x - e * e / pivot
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            below += pivot < 0
        low, high = np.where(below <= rank, x, low), np.where(below <= rank, high, x)


class Shifted:
    """T - x for several x at once, factored with row exchanges."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, x: np.ndarray, tiny: float) -> None:
        n = len(diagonal)
        self.pivot, self.next, self.after, self.factor = np.zeros((4, n, len(x)))
        self.swap = np.zeros((n, len(x)), bool)
        solid = lambda p: np.where(np.abs(p) < tiny, np.where(p < 0, -tiny, tiny), p)
        p, q = diagonal[0] - x, np.full(len(x), off[0] if n > 1 else 0.0)
        for i in range(n - 1):
            r, s, t = off[i], diagonal[i + 1] - x, off[i + 1] if i + 2 < n else 0.0
            swap = np.abs(r) > np.abs(p)
            pivot = solid(np.where(swap, r, p))
            factor = np.where(swap, p, r) / pivot
            self.pivot[i], self.factor[i], self.swap[i] = pivot, factor, swap
            self.next[i], self.after[i] = np.where(swap, s, q), np.where(swap, t, 0.0)
            p, q = np.where(swap, q - factor * s, s - factor * q), np.where(swap, -factor * t, t)
        self.pivot[n - 1] = solid(p)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y, n = right.copy(), len(right)
        for i in range(n - 1):
            top, low = np.where(self.swap[i], y[i + 1], y[i]), np.where(self.swap[i], y[i], y[i + 1])
            y[i], y[i + 1] = top, low - self.factor[i] * top
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                y[i] -= self.next[i] * y[i + 1]
            if i + 2 < n:
                y[i] -= self.after[i] * y[i + 2]
            y[i] /= self.pivot[i]
        return y


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one column per value, by inverse iteration from fixed starts.

    Those of a cluster of close values are made orthogonal to each other in every round.
    """
    n = len(diagonal)
    norm = np.max(np.abs(diagonal) + np.abs(np.r_[off, 0.0]) + np.abs(np.r_[0.0, off]), initial=0.0)
    shifted = Shifted(diagonal, off, values, max(np.finfo(float).tiny, np.finfo(float).eps * norm))
    cluster = np.cumsum(np.r_[0, values[:-1] - values[1:] > CLOSE * norm])
    y = np.random.default_rng(11).uniform(0.5, 1.0, (n, len(values)))
    for _ in range(ROUNDS):
        y = shifted.solve(y / np.abs(y).max(axis=0))
        y /= np.linalg.norm(y, axis=0)
        for j in range(len(values)):
            before = y[:, :j][:, cluster[:j] == cluster[j]]
            for _ in range(2):
                y[:, j] -= before @ (before.T @ y[:, j])
                y[:, j] /= np.linalg.norm(y[:, j])
    return y


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and a column for each."""
    count = min(count, len(matrix))
    scale = float(np.abs(matrix).max(initial=0.0))
    if not scale:
        return np.zeros(count), np.eye(len(matrix))[:, :count]
    diagonal, off, steps = tridiagonal(matrix / scale)
    values = eigenvalues(diagonal, off, count)
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(steps) - 1, -1, -1):
        vectors[k + 1 :] -= 2 * np.outer(steps[k], steps[k] @ vectors[k + 1 :])
    return values * scale, vectors


@dataclass(frozen=True)
class Whitening:
    """What a vector needs to be whitened; ``middle`` is the mean's whole part, ``rest`` / n its remainder."""

    n: int
    middle: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _usable(vector: Column) -> Column:
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as whole numbers; all have one length."""
    flat = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(float)
    return (np.floor(STEP * flat).astype(np.int64) + SHIFT).reshape(batch.num_rows, -1)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are of the commonest length (or the longest such), and their exact sums."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            lengths = batch["vector"].value_lengths().to_numpy()
            for dim in np.unique(lengths).tolist():
                x = _whole(batch.filter(pa.array(lengths == dim)))
                small = np.abs(x).max() < 1 << 40
                total = x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)
                n, so_far = found.get(dim, (0, 0))
                found[dim] = n + len(x), so_far + total
        for dim, (n, total) in found.items():
            numbers = [pa.array(x, pa.int64()) for x in ([dim] * dim, range(dim), [n] * dim)]
            sums = pa.array([str(int(x)) for x in total])
            yield pa.RecordBatch.from_arrays([*numbers, sums], ["dim", "place", "n", "total"])

    found = vectors.select("vector").mapInArrow(of, "dim long, place long, n long, total string")
    sums = found.groupBy("dim", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    most = sums.filter("place = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return 0, []
    rows = {r["place"]: int(r["total"]) for r in sums.filter(F.col("dim") == most["dim"]).collect()}
    return most["n"], [rows[i] for i in range(most["dim"])]


def _centred(batch: pa.RecordBatch, n: int, middle: list[int], rest: list[int]) -> np.ndarray:
    """x - S / n, in double precision but for one rounding."""
    return (_whole(batch) - np.array(middle)).astype(float) - np.array(rest, float) / n


def _covariance(
    vectors: DataFrame, n: int, middle: list[int], rest: list[int], projection: np.ndarray | None = None
) -> np.ndarray:
    """Covariance of the centred vectors, or of their projections, whose mean is zero as well."""
    dim = len(middle) if projection is None else projection.shape[1]
    blocks = -(-dim // WIDTH)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, blocks * WIDTH))
        for batch in batches:
            rows = _centred(batch, n, middle, rest)
            rows = rows if projection is None else rows @ projection
            total[:, :dim] += rows.T @ rows
        at = np.arange(dim * blocks)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total.reshape(-1)), WIDTH).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(at // blocks), pa.array(at % blocks), sums], ["row", "block", "sums"])

    parts = vectors.select("vector").mapInArrow(of, "row long, block long, sums array<double>")
    columns = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(WIDTH)]
    out = np.zeros((dim, blocks * WIDTH))
    for row in parts.groupBy("row", "block").agg(*columns).collect():
        start = row["block"] * WIDTH
        out[row["row"], start : start + WIDTH] = row[2:]
    out = out[:, :dim] / n
    return (out + out.T) / 2


def _deviations(x: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Sums of (n x - rest)^2 over a row, exact; None where they do not fit 64 bits."""
    if np.abs(x).max(initial=0) >= 1 << 24 or n >= 1 << 32 or x.shape[1] > 1 << 6:
        x = x.astype(object)
    r = np.array(rest, x.dtype)
    squares, crossed = (x * x).sum(axis=1).astype(object), (x * r).sum(axis=1).astype(object)
    out = n * n * squares - 2 * n * crossed + sum(i * i for i in rest)
    return [y if y < 1 << 63 else None for y in out.tolist()]


def whiten(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Rows ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    One per usable vector and component, components by falling variance from 1. A vector that is null,
    empty, or holds a null, an entry that is not finite or one of 2^55 or more is left out, as are
    vectors of another length than most. The others are the n vectors that all figures are over.
    Entries become whole numbers x; ``deviation`` is n^2 times the squared distance from their mean,
    exact, null if beyond 64 bits. ``whitened`` is the centred vector along the component over its
    standard deviation, ``explained`` the component's share of all variance, ``identity_error`` how
    far the covariance of ``whitened`` is from the identity at most. Components without variance
    (below FAINT of the first) do not exist: equal vectors, or a single one, give no rows, and neither
    does an empty table. Repeated rows and null ids count and come back like any other.

    Each task holds one matrix of the vectors' length squared, and so does the driver.
    """
    column = F.col(vector)
    usable = vectors.filter(_usable(column)).select(F.col(id).alias("vec_id"), column.alias("vector"))
    n, sums = _sums(usable)
    kind = usable.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    middle, rest = [s // n for s in sums], [s % n for s in sums]
    usable = usable.filter(F.size("vector") == len(sums))
    matrix = _covariance(usable, n, middle, rest)
    values, basis = leading(matrix, components)
    held = int((values > max(values[0], 0.0) * FAINT).sum())
    if not held:
        return vectors.sparkSession.createDataFrame([], schema)
    model = Whitening(n, middle, rest, values[:held], basis[:, :held], float(np.trace(matrix)))
    again = _covariance(usable, n, middle, rest, model.projection)
    error = float(np.abs(again - np.eye(held)).max())
    explained = model.values / model.trace

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            whitened = _centred(batch, n, middle, rest) @ model.projection
            apart = _deviations(_whole(batch) - np.array(middle), n, rest)
            at = pa.array(np.repeat(np.arange(size), held))
            every = [
                batch["vec_id"].take(at),
                pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), size)),
                pa.array(np.full(size * held, n)),
                pa.array(apart, pa.int64()).take(at),
                pa.array(whitened.reshape(-1)),
                pa.array(np.tile(explained, size)),
                pa.array(np.full(size * held, error)),
            ]
            yield pa.RecordBatch.from_arrays(every, schema_names)

    schema_names = [part.split()[0] for part in schema.split(", ")]
    return usable.mapInArrow(of, schema)
