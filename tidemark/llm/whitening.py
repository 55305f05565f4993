"""Whitening of embeddings by the singular values of their centred rows.

Covariances are never formed. Tasks reduce blocks of centred rows to triangular factors, and these pair by pair to one (a
matrix as wide as a vector is long). That factor is made bidiagonal by Householder reflections; the dqds algorithm then
finds all singular values to high relative accuracy, from the smallest up, and a twisted factorisation per value gives its
right singular vector: the direction onto which rows are projected.

Rows are the work of tasks; the driver handles matrices of the vectors' length only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, shipped, slices, stored

shipped(__name__)

EPS = np.finfo(float).eps
#: The grid to which entries are rounded down, and what is added so that they are positive.
SCALE, SHIFT = 64, 1_000_000
#: Rows in a block, and matrices that one task joins into one.
BLOCK = 4096
JOINED = 32
#: Singular values nearer than this (relative) get their vectors by inverse iteration against each other.
NEAR = 1e-5


# --- Dense parts: matrices as wide as a vector is long -------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right factor ``v`` with ``r = u b v'`` for some orthogonal ``u``."""
    a = r.copy()
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        reflect(a[k:, k:])
        if k < n - 2:
            w = mirror(a[k, k + 1 :])
            a[:, k + 1 :] -= np.outer(a[:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def mirror(x: np.ndarray) -> np.ndarray:
    """``w`` for which ``x - (x.w) w`` has nothing but a first entry; nought where that holds already."""
    w = x.copy()
    size = np.linalg.norm(w)
    if size == 0 or not w[1:].any():
        return np.zeros_like(w)
    w[0] += np.copysign(size, w[0])
    return w * (np.sqrt(2) / np.linalg.norm(w))


def reflect(a: np.ndarray) -> None:
    """Clear the first column below its head, from the left."""
    w = mirror(a[:, 0])
    a -= np.outer(w, w @ a)


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One step: the next ``q`` and ``e`` and the least pivot, or None where the shift was too large."""
    n = len(q)
    nq, ne = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        nq[i] = d + e[i]
        if d < 0 or nq[i] <= 0:
            return None
        t = q[i + 1] / nq[i]
        ne[i] = e[i] * t
        d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    nq[-1] = d
    return nq, ne, least


def squares(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of an unreduced bidiagonal matrix, largest first, by dqds with shifts.

    A shift is taken below the least value left and halved until a step with it succeeds, last of all none, which
    always does; what the steps shift away is summed up and added to each value found.
    """
    q, e = (diagonal**2).tolist(), (upper**2).tolist()
    found, total, shift = [], 0.0, 0.0
    while q:
        n = len(q)
        if n == 1:
            found.append(q[0] + total)
            break
        if e[-1] <= EPS * EPS * (total + q[-1]) or e[-1] <= EPS * EPS * q[-1]:
            found.append(q.pop() + total)
            e.pop()
            continue
        # The least eigenvalue of the last two rows bounds all from above; a part of it is mostly below all.
        a, b, c = q[-2] + e[-1], q[-1], q[-1] * e[-1]
        middle, half = (a + b) / 2, (a - b) / 2
        low = (a * b - c) / (middle + np.sqrt(half * half + c)) if middle > 0 else 0.0
        step = None
        shift = max(min(low, q[-1]), 0.0) * (1 - 1e-3) if e[-1] > 1e-8 * q[-1] else max(low, 0.0) * (1 - 1e-12)
        for _ in range(6):
            step = dqds(q, e, shift)
            if step is not None:
                break
            shift *= 0.25
        if step is None:
            shift = 0.0
            step = dqds(q, e, 0.0)
        q, e, _ = step
        total += shift
        # Where the matrix has fallen apart, its parts are worked on alone.
        cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (total + min(q[i], q[i + 1]))), None)
        if cut is not None and cut < len(e) - 1:
            lower = squares(np.sqrt(np.maximum(q[cut + 1 :], 0)), np.sqrt(np.maximum(e[cut + 1 :], 0)))
            found += (lower + total).tolist()
            q, e = q[: cut + 1], e[:cut]
    return np.sort(np.array(found))[::-1]


def twisted(q: np.ndarray, e: np.ndarray, value: float, starts: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of ``b'b`` for one eigenvalue, by the twisted factorisation with the least twist.

    ``q`` and ``e`` are squares of the diagonals of ``b``; signs come in by the caller. ``starts`` are vectors of eigenvalues
    too near to be told apart; the result is made orthogonal to them and improved by solving again.
    """
    n = len(q)
    if n == 1:
        return np.ones(1)
    tiny = np.finfo(float).tiny / EPS
    # Stationary transform from the top (L D L') and progressive one from the bottom (U D U'), both of b'b - value.
    low, up = np.empty(n - 1), np.empty(n - 1)
    s, p = np.empty(n), np.empty(n)
    pivots, tails = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivots[i] = s[i] + q[i]
        if pivots[i] == 0:
            pivots[i] = -tiny
        low[i] = np.sqrt(q[i] * e[i]) / pivots[i]
        s[i + 1] = s[i] * (e[i] / pivots[i]) - value
    pivots[-1] = s[-1] + q[-1]
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        tails[i + 1] = e[i] + p[i + 1]
        if tails[i + 1] == 0:
            tails[i + 1] = -tiny
        up[i] = np.sqrt(q[i] * e[i]) / tails[i + 1]
        p[i] = p[i + 1] * (q[i] / tails[i + 1]) - value
    tails[0] = p[0]
    twists = s + p + value
    order = np.argsort(np.abs(twists), kind="stable")
    k = order[min(len(starts), n - 1)]
    gamma = twists[k] or tiny

    def solved(r: np.ndarray) -> np.ndarray:
        y = r.copy()
        for i in range(k):
            y[i + 1] -= low[i] * y[i]
        for i in range(n - 2, k - 1, -1):
            y[i] -= up[i] * y[i + 1]
        y[:k] /= pivots[:k]
        y[k + 1 :] /= tails[k + 1 :]
        y[k] /= gamma
        for i in range(k - 1, -1, -1):
            y[i] -= low[i] * y[i + 1]
        for i in range(k, n - 1):
            y[i + 1] -= up[i] * y[i]
        return y

    z = np.zeros(n)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    z /= np.abs(z).max()
    z /= np.linalg.norm(z)
    for _ in range(3 if starts else 0):
        z = apart(z, starts)
        with np.errstate(all="ignore"):
            y = solved(z)
            y /= np.abs(y).max()
            size = np.linalg.norm(y)
        if not np.isfinite(size) or size == 0:
            break
        z = apart(y / size, starts)
    return z


def apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``z`` made orthogonal to ``others``, to unit length; where nothing is left, a unit vector that is orthogonal."""
    for _ in range(2):
        for o in others:
            z = z - (z @ o) * o
    size = np.linalg.norm(z)
    if size > 1e-8:
        return z / size
    return apart(np.eye(len(z))[np.argmin(sum(o * o for o in others))], others)


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a square matrix, largest first, and its right singular vectors as columns."""
    n = len(r)
    size = np.linalg.norm(r)
    if size == 0:
        return np.zeros(n), np.eye(n)
    a, b, v = bidiagonal(r / size)
    # Entries lost in rounding are nought; a nought on the diagonal is made as small as rounding, so values stay apart.
    b[np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]))] = 0
    a[np.abs(a) < EPS * EPS] = EPS * EPS
    values, vectors = [], []
    for part in np.split(np.arange(n), np.flatnonzero(b == 0) + 1):
        q, e = a[part], b[part[:-1]]
        found = squares(q, e)
        # Eigenvectors for positive off-diagonals; a sign runs through where a product of neighbours is negative.
        signs = np.cumprod(np.concatenate([[1.0], np.where(q[:-1] * e < 0, -1.0, 1.0)]))
        near: list[np.ndarray] = []
        for i, value in enumerate(found):
            if i and found[i - 1] - value > NEAR * found[i - 1]:
                near = []
            z = twisted(q * q, e * e, value, near)
            near.append(z)
            whole = np.zeros(n)
            whole[part] = z * signs
            values.append(np.sqrt(max(value, 0.0)) * size)
            vectors.append(v @ whole)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T


# --- Tables ---------------------------------------------------------------------------------------------------


def packed(matrix: np.ndarray) -> bytes:
    return np.ascontiguousarray(matrix, float).tobytes()


def numbers(column: pa.Array, width: int) -> np.ndarray:
    """A column of whole-number vectors as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def joined(parts: DataFrame, join: Callable[[list[bytes]], bytes]) -> bytes | None:
    """All ``part`` values as one: up to ``JOINED`` per task and round, until one is left."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.append(value)
                if len(held) == JOINED:
                    held = [join(held)]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([join(held)], pa.binary())], names=["part"])

    parts = stored(parts)
    left = parts.count()
    while left > 1:
        tasks = -(-left // JOINED)
        parts = stored(parts.repartition(tasks).mapInArrow(work, "part BINARY"))
        left = parts.count()
    row = parts.first()
    return row and bytes(row.part)


def triangle(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(blocks), mode="r")


def cells(vector: Column) -> Column:
    """Entries rounded down to the grid, as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(SHIFT).cast("bigint"))


def whole(vector: Column) -> Column:
    """Whether a vector is there, not empty, and has only finite entries."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whitened(rows: DataFrame, vector: str = "embedding", components: int = 16) -> DataFrame:
    """``rows`` with a usable vector, once per component, with ``component``, ``n``, ``deviation``, ``whitened``, ``explained``
    and ``identity_error``; columns of these names are replaced, all others kept.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are those of another length
    than the most frequent one (of equally frequent ones the longest). The fit takes each distinct vector of grid cells
    once; every kept row, repeats included, is projected. Directions without any spread (a value below rounding) give no
    component, so fewer than ``components`` may come out: none from an empty table or one distinct vector. Ties between
    directions are broken in any way, the same for all rows. ``deviation`` beyond 64 bits stops with an OverflowError.
    """
    names = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    rows = rows.drop(*names)
    cell = free_name(rows, "_cells")
    usable = rows.filter(whole(F.col(vector)))
    sizes = usable.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = sizes["size"] if sizes else 1
    kept = usable.filter(F.size(vector) == width).withColumn(cell, cells(F.col(vector)))
    fit = stored(kept.select(F.col(cell).alias("x")).distinct())
    n, sums = totals(fit, width)
    values, vectors = directions(fit, n, sums, width)
    # A direction counts if its spread is beyond what rounding of the whole leaves.
    spread = values > values[:1].max(initial=0) * width * EPS * 4 if n > 1 else values > np.inf
    chosen = np.flatnonzero(spread)[:components]
    matrix = vectors[:, chosen] / (values[chosen] / np.sqrt(max(n, 1)))
    error = identity_error(fit, n, sums, width, matrix)
    total = float((values**2).sum())
    explained = (values[chosen] ** 2 / total).tolist() if total else []
    return projected(kept, cell, n, sums, width, matrix, explained, error, names)


def totals(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Rows of the fit list and the exact sum per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, np.int64)
        for batch in batches:
            n += batch.num_rows
            sums += numbers(batch.column(0), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array([n, *sums.tolist()], pa.int64())],
                                         names=["at", "value"])

    found = fit.mapInArrow(add, "at INT, value BIGINT").groupBy("at").agg(F.sum("value").alias("value")).collect()
    by = {r["at"]: r["value"] for r in found}
    return by.get(-1, 0), np.array([by.get(i, 0) for i in range(width)], np.int64)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less the mean: the exact difference times n, divided by n."""
    return scaled(x, n, sums) / n


def scaled(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - sums``, exactly; the values are near the mean, so only the difference to its floor is multiplied."""
    floor = sums // n
    return (x - floor) * n - (sums - floor * n)


def directions(fit: DataFrame, n: int, sums: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors of the centred fit list."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for part in slices(batches, BLOCK):
            held = triangle([held, centred(numbers(part.column(0), width), n, sums)])
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([packed(held)], pa.binary())], names=["part"])

    def join(parts: list[bytes]) -> bytes:
        return packed(triangle([np.frombuffer(p).reshape(-1, width) for p in parts]))

    found = joined(fit.mapInArrow(reduce, "part BINARY"), join)
    r = np.zeros((width, width))
    if found:
        got = np.frombuffer(found).reshape(-1, width)
        r[: len(got)] = got
    return right_singular(r)


def identity_error(fit: DataFrame, n: int, sums: np.ndarray, width: int, matrix: np.ndarray) -> float:
    """The largest absolute entry of the covariance of the projected fit list, less the identity.

    Tasks keep count, mean and centred products of their rows; two such are joined by the difference of their means.
    """
    k = matrix.shape[1]

    def merged(a, b):
        if a is None:
            return b
        size = a[0] + b[0]
        gap = b[1] - a[1]
        return size, a[1] + gap * (b[0] / size), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / size)

    def pack(state) -> bytes:
        return packed(np.concatenate([[state[0]], state[1], state[2].ravel()]))

    def unpack(data: bytes):
        flat = np.frombuffer(data)
        return flat[0], flat[1 : k + 1], flat[k + 1 :].reshape(k, k)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for part in slices(batches, BLOCK):
            y = centred(numbers(part.column(0), width), n, sums) @ matrix
            mean = y.mean(axis=0)
            state = merged(state, (len(y), mean, (y - mean).T @ (y - mean)))
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pack(state)], pa.binary())], names=["part"])

    def join(parts: list[bytes]) -> bytes:
        state = None
        for p in parts:
            state = merged(state, unpack(p))
        return pack(state)

    if not k:
        return 0.0
    state = unpack(joined(fit.mapInArrow(gather, "part BINARY"), join))
    return float(np.abs(state[2] / n - np.eye(k)).max())


def projected(kept: DataFrame, cell: str, n: int, sums: np.ndarray, width: int, matrix: np.ndarray, explained: list[float],
              error: float, names: tuple[str, ...]) -> DataFrame:
    """A row per kept row and component."""
    at = kept.columns.index(cell)
    k = matrix.shape[1]
    others = [c for c in kept.columns if c != cell]
    places = [i for i in range(len(kept.columns)) if i != at]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, BLOCK):
            x = scaled(numbers(part.column(at), width), n, sums)
            if (x.astype(float) ** 2).sum(axis=1).max(initial=0) >= 2.0**63:
                raise OverflowError("a deviation is beyond 64 bits")
            y = (x / n) @ matrix
            rows = np.repeat(np.arange(len(x)), k)
            columns = [part.column(i).take(pa.array(rows)) for i in places]
            new = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(rows), n)),
                pa.array((x * x).sum(axis=1)[rows]), pa.array(y.ravel()), pa.array(np.tile(np.array(explained, float), len(x))),
                pa.array(np.full(len(rows), error)),
            ]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*others, *names])

    kinds = ("int", "bigint", "bigint", "double", "double", "double")
    schema = kept.select(*others, *[F.lit(None).cast(t).alias(c) for c, t in zip(names, kinds)]).schema
    return kept.mapInArrow(project, schema)
