"""Embedding whitening by a bidiagonal qd solver.

Entries become whole numbers x, so that counts, sums and deviations are exact. The tasks centre their rows and reduce them,
block under block, to one triangle each by QR; triangles meet in two steps, and what is left is one triangle R with
R'R = n V, without V ever being formed. From there on everything has the size of R: Householder reflections from both sides
make it bidiagonal, the differential qd algorithm with shifts finds all singular values to high relative accuracy, and
each one's direction comes from the twisted factorisation of the bidiagonal's square minus that eigenvalue, at the place
where the stationary and the progressive transform meet with the least rest. Directions of eigenvalues too close to be
told apart are made orthogonal within their cluster. Another pass projects the rows, and one before it sums the
covariance of the projections (partial means and moments, merged pairwise) for the stated error.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are those that
don't have the most frequent length (of equally frequent ones the smallest). Components stop at the rank of the data
(eigenvalues below 1e-22 of the largest count as none); no rows give no rows. Each component's largest entry is positive.
Null and repeated ids are carried, other columns ignored. Entries beyond 2**40 are taken as that (the sums stay exact for 4 million rows of such, or 2**60 / the largest otherwise);
a deviation that 64 bits can't hold is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, broadcast_rows, materialize, partitions_for

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
MOST_ENTRY = 1 << 40
#: Rows of a block that is reduced to a triangle at once (at least the number of dimensions).
BLOCK_ROWS = 4096
MOST_LENGTHS, MOST_DIMS = 1000, 4096
#: Eigenvalues below this part of the largest count as none.
LEAST = 1e-22
#: Eigenvalues closer than this part of the larger one form a cluster.
CLUSTER = 1e-6
EPS = float(np.finfo(float).eps)


def whole_numbers(column: pa.Array, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) by length, of the rows that are not dropped; only those of ``dims`` entries if given."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist() if dims is None else [dims]:
        rows = np.flatnonzero(sizes == size)
        c = flat[starts[rows][:, None] + np.arange(size)]
        good = np.isfinite(c).all(axis=1)
        x = np.floor(np.clip(c[good], -MOST_ENTRY / SCALE, MOST_ENTRY / SCALE) * SCALE).astype(np.int64) + OFFSET
        yield rows[good], x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vector): one row (dims, n, sums) for each length that the task has."""
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for _, x in whole_numbers(batch.column(0)):
            n, total = held.get(x.shape[1], (0, 0))
            held[x.shape[1]] = n + len(x), total + x.sum(axis=0)
    for dims, (n, total) in held.items():
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([dims]), pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["dims", "n", "sums"])


@dataclass
class Centre:
    """The fit list: its number of rows and the sum of each dimension."""

    n: int
    sums: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x - self.sums


def centre_of(rows: DataFrame) -> Centre | None:
    """Of a table with one column of vectors; written, so later passes fit together."""
    parts = materialize(rows.mapInArrow(_sums, "dims long, n long, sums array<long>"), "sums")
    lengths = broadcast_rows(parts.groupBy("dims").agg(F.sum("n").alias("n")), MOST_LENGTHS, "lengths of vectors")
    if not lengths:
        return None
    dims, n = min(((r["dims"], r["n"]) for r in lengths), key=lambda x: (-x[1], x[0]))
    each = parts.filter(F.col("dims") == dims).select(F.posexplode("sums").alias("d", "s")).groupBy("d").agg(F.sum("s").alias("s"))
    sums = np.zeros(dims, np.int64)
    for r in broadcast_rows(each, MOST_DIMS, "dimensions"):
        sums[r["d"]] = r["s"]
    return Centre(n, sums)


def triangle(block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block, mode="r")


def reducer(centre: Centre):
    """Rows (vector): the triangle of the task's centred rows."""
    dims = len(centre.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, held, size = np.zeros((0, dims)), [], 0
        for batch in batches:
            for _, x in whole_numbers(batch.column(0), dims):
                held.append(centre.centred(x) / centre.n)
                size += len(x)
                if size >= max(BLOCK_ROWS, dims):
                    r, held, size = triangle(np.concatenate([r, *held])), [], 0
        r = triangle(np.concatenate([r, *held])) if size else r
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    return run


def stacker(dims: int):
    """Rows (triangle): one triangle for all of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dims))
        for batch in batches:
            for one in batch.column(0):
                r = triangle(np.concatenate([r, np.frombuffer(one.as_py(), np.float64).reshape(-1, dims)]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    return run


def reduced(rows: DataFrame, centre: Centre) -> np.ndarray:
    """The triangle (dims x dims) of all centred rows."""
    dims = len(centre.sums)
    r = materialize(rows.mapInArrow(reducer(centre), "r binary"), "triangles")
    some = max(1, math.isqrt(partitions_for(rows.sparkSession)))
    for parts in (some, 1):
        r = r.repartition(parts).mapInArrow(stacker(dims), "r binary")
    found = broadcast_rows(r, 1, "triangles")
    out = np.zeros((dims, dims))
    got = np.frombuffer(found[0]["r"], np.float64).reshape(-1, dims)
    out[: len(got)] = got
    return out


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, e, Q): the upper bidiagonal B (diagonal d, above it e) of U R Q, and Q, by Householder reflections."""
    a, m = r.copy(), len(r)
    q = np.eye(m)
    for k in range(m):
        v = reflection(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(v, 2 * (v @ a[k:, k:]))
        if k < m - 2:
            v = reflection(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ v), v)
                q[:, k + 1 :] -= np.outer(2 * (q[:, k + 1 :] @ v), v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def reflection(x: np.ndarray) -> np.ndarray | None:
    """The unit v for which x - 2 v (v'x) has only its first entry; none if that holds already."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.abs(x[1:]).max(initial=0.0):
        return None
    v = x / scale
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def qd_eigenvalues(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The eigenvalues of B'B, falling, by differential quotient-difference steps with shifts (dqds) and deflation."""
    q, off, found = (d * d).tolist(), (e * e).tolist(), []
    stack = [(q, off, 0.0)]
    while stack:  # unconnected parts of the array, each with what has been shifted off
        q, off, shifted = stack.pop()
        fails = 0
        while q:
            n, norm = len(q), max(q)
            if norm + shifted == 0.0 or norm <= EPS * EPS * shifted:
                found += [shifted] * n
                break
            if n == 1:
                found.append(q[0] + shifted)
                break
            if off[-1] <= (EPS * EPS) * (shifted + q[-1]):  # the last one has converged
                found.append(q.pop() + shifted)
                off.pop()
                continue
            cut = next((i for i in range(n - 2, -1, -1) if off[i] <= (EPS * EPS) * (shifted + q[i])), None)
            if cut is not None:
                stack.append((q[: cut + 1], off[:cut], shifted))
                q, off = q[cut + 1 :], off[cut + 1 :]
                continue
            if q[0] < q[-1]:  # read from its other end it is the array of the transposed: small ones last
                q, off = q[::-1], off[::-1]
            shift = 0.0 if fails > 3 else least_of_two(q, off) * (1 - 4 * EPS) * 0.25**fails
            step = qd_step(q, off, shift)
            if step is None:  # the shift was too large
                fails += 1
                continue
            q, off = step
            shifted, fails = shifted + shift, 0
    return np.sort(np.maximum(np.array(found), 0.0))[::-1]


def least_of_two(q: list[float], off: list[float]) -> float:
    """The smaller eigenvalue of the last two rows: near the least of all, and made smaller where it is too large."""
    a, b, c = q[-2], off[-1], q[-1]
    half = (a + b + c) / 2
    return a * c / (half + math.sqrt(max(half * half - a * c, 0.0))) if half > 0 else 0.0


def qd_step(q: list[float], off: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential step, or none if the array less ``shift`` isn't positive any more."""
    new, rest, at = [], [], q[0] - shift
    for i in range(len(q) - 1):
        if at < 0:
            return None
        value = at + off[i]
        ratio = q[i + 1] / value if value else 0.0
        new.append(value)
        rest.append(off[i] * ratio)
        at = at * ratio - shift
    return None if at < 0 else ([*new, at], rest)


def twisted(d: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """A unit vector of B'B for the eigenvalue ``value``: the factorisation is twisted where the rest is least."""
    n = len(d)
    q, off = d * d, np.append(e * e, 0.0)
    tiny = 1e-100
    product = d[:-1] * e  # beside the diagonal of B'B
    s, low = np.zeros(n), np.zeros(n)  # stationary: L+ from the top
    s[0] = -value
    for i in range(n - 1):
        pivot = q[i] + s[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        low[i] = product[i] / pivot
        s[i + 1] = off[i] / pivot * s[i] - value
    p, up = np.zeros(n), np.zeros(n)  # progressive: U- from the bottom
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = off[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        up[i] = product[i] / pivot
        p[i] = q[i] / pivot * p[i + 1] - value
    at = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
    size = np.abs(z).max()
    return z / size / np.linalg.norm(z / size) if np.isfinite(size) else np.zeros(n)


def directions(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Columns: unit eigenvectors of B'B for its ``values``, falling; those of close ones made orthogonal."""
    n, out = len(d), np.zeros((len(d), len(values)))
    rng, first = np.random.default_rng(12), 0
    square = np.diag(d * d + np.append(0.0, e * e)) + np.diag(d[:-1] * e, 1) + np.diag(d[:-1] * e, -1)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * values[k - 1]:
            first = k
        z, near = twisted(d, e, float(value)), out[:, first:k]
        for _ in range(2):
            z = z - near @ (near.T @ z)
        for _ in range(8):  # a repeated eigenvalue: another start, the same operator
            if np.linalg.norm(z) > 0.1 and np.linalg.norm(square @ z - value * z) <= 1e-8 * values[0] * np.linalg.norm(z):
                break
            z = rng.standard_normal(n)
            for _ in range(4):
                z -= near @ (near.T @ z)
                z = np.linalg.solve(square - (value * (1 + 8 * EPS) + values[0] * EPS) * np.eye(n), z / np.linalg.norm(z))
                z /= np.linalg.norm(z)
            for _ in range(2):
                z = z - near @ (near.T @ z)
        out[:, k] = z / np.linalg.norm(z)
    return out


@dataclass
class Whitening:
    """Unit eigenvectors of the covariance as columns, their eigenvalues, and each one's share of the trace."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.centred(x) / self.centre.n) @ (self.vectors / np.sqrt(self.values))


def whitening(r: np.ndarray, centre: Centre, components: int = COMPONENTS) -> Whitening:
    """From the triangle of the centred rows."""
    trace = float((r * r).sum())
    scale = math.sqrt(trace) or 1.0
    d, e, q = bidiagonal(r / scale)
    values = qd_eigenvalues(d, e)
    kept = values[values > values[0] * LEAST][:components]
    v = q @ directions(d, e, kept)
    v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return Whitening(centre, v, kept * trace / centre.n, kept / float(values.sum() or 1.0))


def moments(white: Whitening):
    """Rows (vector): count, mean and centred moments of the task's projections."""
    dims = len(white.centre.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for _, x in whole_numbers(batch.column(0), dims):
                if len(x):
                    w = white.apply(x)
                    mean = w.mean(axis=0)
                    state = merged(state, (len(w), mean, (w - mean).T @ (w - mean)))
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([state[0]]), *(pa.array([x.tobytes()], pa.binary()) for x in state[1:])], ["n", "mean", "m2"])

    return run


def merged(a, b):
    """Of two (count, mean, centred moments) that of both together."""
    if a is None or b is None:
        return a or b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def merger(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for n, mean, m2 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state = merged(state, (n, np.frombuffer(mean), np.frombuffer(m2).reshape(k, k)))
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([state[0]]), *(pa.array([x.tobytes()], pa.binary()) for x in state[1:])], ["n", "mean", "m2"])

    return run


def identity_error(rows: DataFrame, white: Whitening) -> float:
    """The largest entry of the projections' covariance minus the identity."""
    k, schema = len(white.values), "n long, mean binary, m2 binary"
    parts = materialize(rows.mapInArrow(moments(white), schema), "moments")
    for some in (max(1, math.isqrt(partitions_for(rows.sparkSession))), 1):
        parts = parts.repartition(some).mapInArrow(merger(k), schema)
    r = broadcast_rows(parts, 1, "moments")[0]
    return float(np.abs(np.frombuffer(r["m2"]).reshape(k, k) / r["n"] - np.eye(k)).max())


def deviations(centred: np.ndarray) -> pa.Array:
    """Exact sums of squares; null where 64 bits don't hold them."""
    most = int(np.abs(centred).max(initial=0))
    if most * most * centred.shape[1] < 1 << 63:
        return pa.array((centred * centred).sum(axis=1))
    exact = [sum(v * v for v in row) for row in centred.tolist()]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitener(white: Whitening, error: float):
    """Rows (vec_id, vector): a row for each component."""
    dims, k = len(white.centre.sums), len(white.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                for rows, x in whole_numbers(part.column(1), dims):
                    m = len(rows)
                    each = pa.array(np.repeat(np.arange(m), k))
                    columns = [
                        part.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, white.centre.n)),
                        deviations(white.centre.centred(x)).take(each), pa.array(white.apply(x).ravel()), pa.array(np.tile(white.explained, m)), pa.array(np.full(m * k, error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    only = rows.select("embedding")
    centre = centre_of(only)
    if centre is None:
        return spark.createDataFrame([], SCHEMA)
    white = whitening(reduced(only, centre), centre, components)
    if not len(white.values):
        return spark.createDataFrame([], SCHEMA)
    return rows.mapInArrow(whitener(white, identity_error(only, white)), SCHEMA)
