"""Whitening of embeddings: principal components of all distinct vectors, scaled to unit variance.

The covariance is summed over all tasks. Its eigenvectors come from FEAST: an eigenvalue interval is projected out by a
contour integral, that is by solves with the covariance at complex shifts around the interval, and Rayleigh-Ritz extracts
the components from the projected space. Counts of inertia (how many eigenvalues lie above a shift) place the intervals,
and verify that none is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import stored

# An entry c becomes floor(64 c) + 1,000,000.
SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 16
#: Entries whose scaled value has no exact whole number take their row out, like infinite ones.
LARGEST = 2.0**52

#: Nodes on the half circle (the other half is conjugate), eigenvalues per interval, and rounds of filtering.
NODES, PER_INTERVAL, ROUNDS = 8, 6, 40
#: Residuals aimed at and accepted, and the least variance that counts as such, as shares of the covariance's norm.
RESIDUAL, ACCEPTED, NO_VARIANCE = 1e-13, 1e-10, 1e-12
#: An interval this narrow is not cut; cuts keep this share of an interval's width from eigenvalues.
NARROW, CLEARANCE, BISECTIONS = 1e-6, 1e-3, 60
LONGEST = (1 << 63) - 1


# ---- the eigenvalue problem -------------------------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues, by Householder's reflections."""
    a = np.array(matrix, dtype=float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size:
            v = x / size
            p = a[k + 1 :, k + 1 :] @ v
            w = p - (v @ p) * v
            a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1 :, k] = a[k, k + 1 :] = a[k + 1 :, k] - 2 * v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray) -> Callable[[float], int]:
    """How many eigenvalues lie above a shift: the positive pivots of the shifted matrix, by Sylvester's law."""
    squares = [0.0, *(off * off)]
    tiny = np.finfo(float).tiny * max(1.0, max(squares))

    def above(shift: float) -> int:
        count, pivot = 0, 1.0
        for d, square in zip(diagonal, squares, strict=True):
            pivot = d - shift - square / pivot
            if abs(pivot) < tiny:
                pivot = -tiny
            count += pivot > 0
        return count

    return above


def cut(above: Callable[[float], int], low: float, high: float) -> float:
    """A shift near the middle of an interval with no eigenvalue close to it; the middle where there is none."""
    margin = CLEARANCE * (high - low)
    for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
        shift = low + share * (high - low)
        if above(shift - margin) == above(shift + margin):
            return shift
    return (low + high) / 2


def eigenvalue(above: Callable[[float], int], number: int, low: float, high: float) -> float:
    """The eigenvalue of that number, counted from the greatest as 1, by bisection."""
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) >= number else (low, middle)
    return (low + high) / 2


def floor_below(above: Callable[[float], int], wanted: int, n: int, high: float) -> float:
    """A shift in a gap below the ``wanted`` greatest eigenvalues; where they have close neighbours, below those too."""
    least = eigenvalue(above, wanted, 0.0, high)
    for number in range(wanted + 1, n + 1):
        after = eigenvalue(above, number, -high, high)
        if least - after > CLEARANCE * least:
            return (least + max(after, 0.0)) / 2
        least = after
    return least / 2


def intervals(above: Callable[[float], int], low: float, high: float) -> list[tuple[float, float, int]]:
    """Intervals that share out (low, high), as (low, high, eigenvalues), with few eigenvalues each.

    Those are cut that have more than ``PER_INTERVAL``, until they are too narrow to be told apart.
    """
    found, open_ones = [], [(low, high, above(low), 0)]
    while open_ones:
        low, high, n_low, n_high = open_ones.pop()
        inside = n_low - n_high
        if inside > PER_INTERVAL and high - low > NARROW:
            middle = cut(above, low, high)
            n_middle = above(middle)
            open_ones += [(low, middle, n_low, n_middle), (middle, high, n_middle, n_high)]
        elif inside:
            found.append((low, high, inside))
    return found


def projected(matrix: np.ndarray, start: np.ndarray, low: float, high: float) -> np.ndarray:
    """The contour integral of the resolvent around the interval, applied to ``start``.

    By Gauss-Legendre quadrature on a circle; the conjugate half of a real symmetric matrix is the real part's double.
    """
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    total = np.zeros_like(start)
    for node, weight in zip(nodes, weights, strict=True):
        turn = np.exp(1j * np.pi * (1 - node) / 2)
        shifted = (centre + radius * turn) * np.eye(len(matrix)) - matrix
        total += weight / 2 * np.real(radius * turn * np.linalg.solve(shifted, start.astype(complex)))
    return total


def feast(matrix: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenvalues within an interval, and their eigenvectors, of a matrix with norm about 1.

    The space is half as large again as what it must hold. Filtering and Rayleigh-Ritz alternate until the residuals
    are at rounding's level. What the filter left of other directions is noise, whose Ritz values may fall anywhere, so
    of those in the interval the ones with least residuals count. Inertia has said how many there are: a missed one is
    an error.
    """
    n = len(matrix)
    space = np.random.default_rng(7).standard_normal((n, min(n, inside + inside // 2 + 6)))
    best, best_worst, idle = None, np.inf, 0
    for _ in range(ROUNDS):
        space = np.linalg.qr(projected(matrix, space, low, high))[0]
        values, turns = np.linalg.eigh(space.T @ matrix @ space)
        space = space @ turns
        residuals = np.linalg.norm(matrix @ space - space * values, axis=0)
        within = (values > low - RESIDUAL) & (values < high + RESIDUAL)
        if within.sum() < inside:
            continue
        kept = np.lexsort([residuals, ~within])[:inside]
        worst = float(residuals[kept].max())
        idle = 0 if worst < best_worst / 2 else idle + 1
        if worst < best_worst:
            best, best_worst = (values[kept], space[:, kept]), worst
        if best_worst < RESIDUAL and idle > 1:
            break
    if best is None or best_worst > ACCEPTED:
        raise ArithmeticError(f"{inside} eigenvalues lie in ({low}, {high}), the projection did not find them: {best_worst}")
    return best


def principal(covariance: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors as columns; fewer where variance ends before.

    The entry of greatest size of each vector is positive.
    """
    n = len(covariance)
    top = float(np.abs(covariance).sum(axis=1).max()) if n else 0.0
    if not top:
        return np.zeros(0), np.zeros((n, 0))
    above = inertia(*tridiagonal(covariance / top))
    if above(NO_VARIANCE) == 0:
        return np.zeros(0), np.zeros((n, 0))
    high = 1.0 + CLEARANCE
    low = floor_below(above, min(wanted, above(NO_VARIANCE)), n, high)
    found = intervals(above, low, high)
    parts = [feast(covariance / top, low, high, inside) for low, high, inside in found]
    # One more Rayleigh-Ritz over all of them makes components of neighbouring intervals orthogonal.
    space = np.linalg.qr(np.column_stack([vectors for _, vectors in parts]))[0]
    values, turns = np.linalg.eigh(space.T @ covariance @ space)
    order = np.argsort(-values, kind="stable")[:wanted]
    order = order[values[order] > NO_VARIANCE * top]
    vectors = space @ turns[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[order], vectors * signs


# ---- sums over all vectors ------------------------------------------------------------------------------------------------


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the vector in whole numbers, of rows that take part.

    Rows take part whose vector is not null or empty, has no null, NaN, infinite or out-of-range entry (``LARGEST``), and
    has the most common length (of equally common ones the greatest). Repeated rows and null ids each stay a row.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            # Offsets of a slice start anywhere; null lists are empty here.
            entries = flat.to_numpy(zero_copy_only=False).astype(float)
            owner = np.repeat(np.arange(len(lists)), lengths) if lists.null_count == 0 else None
            if owner is None:
                lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
                owner = np.repeat(np.arange(len(lists)), lengths)
            scaled = SCALE * entries
            sound = np.isfinite(scaled) & (np.abs(scaled) < LARGEST)
            taken = (lengths > 0) & (np.bincount(owner[~sound], minlength=len(lists)) == 0)
            values = np.floor(scaled[taken[owner]]).astype(np.int64) + OFFSET
            offsets = np.concatenate([[0], np.cumsum(lengths[taken])]).astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(taken)), kept], ["vec_id", "x"])

    own = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    found = own.where(F.col("v").isNotNull()).mapInArrow(whole, "vec_id long, x array<long>")
    lengths = found.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    return found.where(F.size("x") == (most["d"] if most else 0))


def matrix(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def summed_rows(parts: DataFrame) -> list[np.ndarray]:
    """Rows of a matrix (``i``, ``row``), one per task and number, added up in Spark; the driver gets the sums.

    They are added entry by entry in the shuffle, with partial sums before it.
    """
    entries = parts.select("i", F.posexplode("row").alias("j", "y"))
    sums = entries.groupBy("i", "j").agg(F.sum("y").alias("y"))
    rows = sums.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "y"))).alias("row"))
    return [np.array([entry["y"] for entry in r["row"]]) for r in rows.orderBy("i").collect()]


def products(frame: DataFrame, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of y'y over all rows, of vectors y that ``centred`` makes of the column ``x``: d rows a task are shuffled."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            if batch.num_rows:
                y = centred(matrix(batch))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            rows = pa.array(list(total), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), rows], ["i", "row"])

    return np.array(summed_rows(frame.select("x").mapInArrow(partial, "i int, row array<double>")))


def column_sums(frame: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """Sums over all rows of the columns of the matrix that ``of`` makes of ``x``, in ``kind`` (whole sums are exact)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            if batch.num_rows:
                own = of(matrix(batch)).sum(axis=0)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "y"])

    parts = frame.select("x").mapInArrow(partial, f"i int, y {kind}")
    return [r["y"] for r in parts.groupBy("i").agg(F.sum("y").alias("y")).orderBy("i").collect()]


@dataclass(frozen=True)
class Whitening:
    """What the distinct vectors gave: their number, sums, eigenvalues, components, trace, and how white they become."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, with one rounding: n x - S is whole, and exact where it fits."""
        if self.n * float(np.abs(x).max(initial=1)) * 2 < 2.0**62:
            return (self.n * x - np.array(self.sums, dtype=np.int64)) / self.n
        whole, rest = np.divmod(np.array(self.sums, dtype=object), self.n)
        return (x - whole.astype(np.int64)) - (rest / self.n).astype(float)

    def white(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of each row; null where a long cannot hold it."""
        far = self.n * float(np.abs(x).max(initial=1)) * 2
        if far < 2.0**62:
            moved = self.n * x - np.array(self.sums, dtype=np.int64)
            if float(np.abs(moved).max(initial=1)) ** 2 * x.shape[1] < 2.0**62:
                return (moved * moved).sum(axis=1).tolist()
        sums = self.sums
        found = [sum((self.n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
        return [value if value <= LONGEST else None for value in found]


def fit(distinct: DataFrame, wanted: int = COMPONENTS) -> Whitening:
    """Fit on distinct vectors (column ``x``), in four passes: counts and sums, covariance, and the check of both.

    The driver gets d sums and d x d products (d is the length of a vector), never vectors.
    """
    n = distinct.count()
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    sums = tuple(column_sums(distinct, lambda x: x, "long"))
    bare = Whitening(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    covariance = products(distinct, bare.centred) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = principal(covariance, wanted)
    fitted = Whitening(n, sums, values, vectors, float(np.trace(covariance)), 0.0)
    if not len(values):
        return fitted
    mean = np.array(column_sums(distinct, fitted.white)) / n
    spread = products(distinct, lambda x: fitted.white(x) - mean) / n
    return Whitening(n, sums, values, vectors, fitted.trace, float(np.abs(spread - np.eye(len(values))).max()))


#: The rows of ``whiten``.
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part (see ``whole_vectors``) and each component, numbered from 1 by variance.

    Components without variance are left out, so equal vectors, a single one and an empty table give no rows. The fit is
    over distinct vectors, each once; repeated rows are each transformed. Other columns are left out.
    """
    whole = stored(whole_vectors(vectors, id_column, vector_column))
    fitted = fit(stored(whole.select("x").distinct()), wanted)
    k, names = len(fitted.values), [field.split()[0] for field in WHITENED.split(", ")]
    explained = fitted.values / fitted.trace if k else np.zeros(0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = matrix(batch, 1)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            deviations = pa.array(fitted.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, fitted.n, dtype=np.int64)),
                deviations,
                pa.array(fitted.white(x).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, fitted.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return whole.select("vec_id", "x").mapInArrow(rows, WHITENED)
