"""Embedding whitening: distributed covariance, leading eigenvectors by bisection and inverse iteration, projection.

* **Covariance.**  Entries become integers ``x = floor(scale * c) + shift``.  One pass adds up rows and entries
  exactly (two halves of 31 bits, so no sum overflows), a second one the products of the centred vectors
  ``x - S / n``.  Every task adds up its own rows and the tables of the tasks are added up in rounds of bounded fan-in;
  of the data only ``dim`` sums and the ``dim x dim`` matrix, whose size does not depend on the rows, reach the driver.
* **Components.**  Householder reflections make the matrix tridiagonal, Sturm counts bisect the ``k`` largest
  eigenvalues, inverse iteration gives the vectors, those of close eigenvalues are made orthogonal to each
  other, and the reflections carry them back.
* **Projection.**  The mean and the scaled components (``dim x k`` numbers) go to the tasks, which project every row.

Rows whose vector is null or has null or non-finite entries, or entries of ``2**61`` and more after scaling, are
dropped.  The dimension is the length that most remaining rows have (ties: the longer); vectors of another length, empty
ones too, are dropped.  Components are the eigenvectors with eigenvalues above rounding (``dim * 2**-52`` of the largest),
at most ``components``: a single row, or rows that are all equal, have none and give no rows.  The entry of largest
size of a component (ties: the first) is positive.  Ids may be null or repeat: every row is projected by itself.  Other columns
are ignored.  ``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import binary_column, release_memory

ROUNDS = (4096, 64, 1)  # tables left after each round of adding up
BLOCK_BYTES = 1 << 20  # of a matrix in one row
LOW = 31  # bits of the lower half of an exact sum
TINY = np.finfo(np.float64).eps


def in_rounds(tables: DataFrame, dtype: str) -> DataFrame:
    """``(block, part, total)`` rows added up by block; a group has at most the tasks / 4096, then 64 rows.

    The groups are sorted by ``part``, so that sums of doubles do not depend on the order of arrival.
    """

    def add(key, table):
        order = np.argsort(table.column("part").to_numpy(), kind="stable")
        rows = table.column("total")
        total = None
        for i in order.tolist():
            x = np.frombuffer(rows[i].as_buffer(), dtype=dtype)
            total = x.copy() if total is None else np.add(total, x, out=total)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()),
                         "total": binary_column([total.tobytes()])})

    for left in ROUNDS:
        tables = tables.groupBy("block", (F.col("part") % left).alias("_to")).applyInArrow(add, "block int, part long, total binary")
    return tables


def _table_rows(total: np.ndarray) -> pa.RecordBatch:
    """A flat table of a task cut into blocks."""
    step = BLOCK_BYTES // 8
    parts = [total[i:i + step].tobytes() for i in range(0, len(total), step)]
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([task] * len(parts), pa.int64()), binary_column(parts)],
                                      names=["block", "part", "total"])


def _collected(tables: DataFrame, dtype: str) -> np.ndarray:
    rows = sorted(in_rounds(tables, dtype).collect(), key=lambda r: r["block"])
    return np.concatenate([np.frombuffer(r["total"], dtype=dtype) for r in rows]) if rows else np.zeros(0, dtype=dtype)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, v)`` of the vectors whose entries are all finite and small enough to be scaled to integers."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bound = float(1 << 61) / scale
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(bound)))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & good)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _integers(c: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.floor(c * float(scale)).astype(np.int64) + shift


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, pa.Array]:
    """(x - S / n as doubles, the exact sums of (n * x - S) ** 2)."""
    top = max(int(np.abs(x).max(initial=0)), 1)
    s_top = max(map(abs, sums), default=0)
    if top * n + s_top < 1 << 62:
        d = x * n - np.array(sums, dtype=np.int64)
    else:
        d = x.astype(object) * n - np.array(sums, dtype=object)
    far = max((abs(int(v)) for v in (d.min(axis=0), d.max(axis=0)) for v in v), default=0) if len(d) else 0
    if far * far * d.shape[1] < 1 << 63:
        d = d.astype(np.int64)
        exact = pa.array((d * d).sum(axis=1))
    else:
        big = [sum(int(v) * int(v) for v in row) for row in d]
        exact = pa.array([v if v < 1 << 63 else None for v in big], pa.int64())
    return d.astype(np.float64) / float(n), exact


@dataclass
class Whitening:
    """What the projection needs; ``sums`` are exact."""

    dim: int
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # one a column
    trace: float
    identity_error: float


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix: A = H1 H2 ... T ... H2 H1."""
    a = a.copy()
    m = len(a)
    reflections = []
    for k in range(m - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0.0 or np.linalg.norm(x[1:]) == 0.0:
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        sub = a[k + 1:, k + 1:]
        p = sub @ x
        p -= (x @ p) * x
        sub -= 2.0 * (np.outer(x, p) + np.outer(p, x))
        tail = a[k + 1:, k].copy()
        tail -= 2.0 * (x @ tail) * x
        a[k + 1:, k] = a[k, k + 1:] = tail
        reflections.append((k + 1, x))
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def counts_below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix below each of the points: signs of the Sturm sequence."""
    least = TINY * max(float(np.abs(d).max(initial=0)), float(np.abs(e).max(initial=0)), np.finfo(np.float64).tiny) * TINY
    q = d[0] - at
    q = np.where(np.abs(q) < least, -least, q)
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = d[i] - at - e[i - 1] ** 2 / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval no longer shrinks."""
    reach = np.zeros(len(d))
    reach[:-1] += np.abs(e)
    reach[1:] += np.abs(e)
    lo = np.full(k, float((d - reach).min()))
    hi = np.full(k, float((d + reach).max()))
    pad = TINY * max(abs(float(lo[0])), abs(float(hi[0]))) * len(d)
    lo, hi = lo - pad, hi + pad
    want = len(d) - np.arange(k)  # the j-th largest has at least this many eigenvalues at or below it
    for _ in range(2200):
        mid = 0.5 * (lo + hi)
        if not np.any((mid > lo) & (mid < hi)):
            break
        low = counts_below(d, e, mid) < want
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    return 0.5 * (lo + hi)


class _Shifted:
    """The tridiagonal matrix less a shift, factored with row exchanges."""

    def __init__(self, d: np.ndarray, e: np.ndarray, shift: float):
        m = len(d)
        size = max(float(np.abs(d).max()), float(np.abs(e).max(initial=0)), np.finfo(np.float64).tiny)
        u0, u1, u2 = (d - shift).tolist(), [*e.tolist(), 0.0], [0.0] * m
        self.factor, self.swap = [0.0] * m, [False] * m
        for i in range(m - 1):
            below, nxt, nxt1 = float(e[i]), u0[i + 1], u1[i + 1]
            if abs(below) > abs(u0[i]):
                self.swap[i] = True
                f = u0[i] / below
                u0[i], u1[i], u2[i], u0[i + 1], u1[i + 1] = below, nxt, nxt1, u1[i] - f * nxt, -f * nxt1
            else:
                f = below / u0[i] if u0[i] else 0.0
                u0[i + 1] = nxt - f * u1[i]
            self.factor[i] = f
        self.u0 = [v if abs(v) > TINY * size else TINY * size for v in u0]
        self.u1, self.u2 = u1, u2

    def solve(self, b: np.ndarray) -> np.ndarray:
        y, m = b.tolist(), len(b)
        for i in range(m - 1):
            if self.swap[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= self.factor[i] * y[i]
        for i in range(m - 1, -1, -1):
            s = y[i]
            if i + 1 < m:
                s -= self.u1[i] * y[i + 1]
            if i + 2 < m:
                s -= self.u2[i] * y[i + 2]
            y[i] = s / self.u0[i]
            if abs(y[i]) > 1e150:  # only the direction counts
                y = [v * 1e-150 for v in y]
        return np.array(y)


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, iterations: int = 6) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; within a cluster orthogonal to the earlier ones at every step."""
    m, size = len(d), max(float(np.abs(d).max()), float(np.abs(e).max(initial=0)), np.finfo(np.float64).tiny)
    out = np.zeros((m, len(values)))
    first, used = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            first = j
        shift = min(value, used - 4 * TINY * size) if j > first else value  # equal shifts would give equal directions
        used = shift
        lu = _Shifted(d, e, shift)
        v = np.random.default_rng(j + 1).normal(size=m)
        for _ in range(iterations):
            v /= np.abs(v).max()
            v = lu.solve(v)
            v /= np.abs(v).max()
            for _twice in range(2):
                v -= out[:, first:j] @ (out[:, first:j].T @ v)
        out[:, j] = v / np.linalg.norm(v)
    return out


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues above rounding, at most ``k``, falling; their unit eigenvectors as columns)."""
    m = len(v)
    if m == 0 or not np.any(v):
        return np.zeros(0), np.zeros((m, 0))
    size = float(np.abs(v).max())
    d, e, reflections = tridiagonal(v / size)
    values = leading_eigenvalues(d, e, min(k, m))
    values = values[values > m * TINY * values[0]]
    q = eigenvectors(d, e, values)
    for at, x in reversed(reflections):
        q[at:] -= 2.0 * np.outer(x, x @ q[at:])
    q *= np.where(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])] < 0, -1.0, 1.0)
    return values * size, q


def fit(whole: DataFrame, scale: int, shift: int, components: int) -> Whitening:
    """Exact sums, covariance and components of all vectors."""
    lengths = whole.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    common = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not common:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    dim, n = common[0]["d"], common[0]["n"]
    same = whole.where(F.size("v") == dim).select("v")

    def sums(batches):
        total = np.zeros(2 * dim, dtype=np.int64)
        for b in batches:
            x = _integers(_matrix(b.column(0), dim), scale, shift)
            total[:dim] += (x & ((1 << LOW) - 1)).sum(axis=0)
            total[dim:] += (x >> LOW).sum(axis=0)
        yield _table_rows(total)
        release_memory()

    schema = "block int, part long, total binary"
    halves = _collected(same.mapInArrow(sums, schema), "<i8")
    exact = [int(lo) + (int(hi) << LOW) for lo, hi in zip(halves[:dim], halves[dim:])]

    def products(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            z = _deviations(_integers(_matrix(b.column(0), dim), scale, shift), n, exact)[0]
            total += z.T @ z
        yield _table_rows(total.reshape(-1))
        release_memory()

    v = _collected(same.mapInArrow(products, schema), "<f8").reshape(dim, dim) / n
    v = 0.5 * (v + v.T)
    values, q = principal(v, components)
    w = q / np.sqrt(values)
    error = float(np.abs(w.T @ v @ w - np.eye(len(values))).max(initial=0.0))
    return Whitening(dim, n, exact, values, q, float(np.trace(v)), error)


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    whole = whole_vectors(vectors, id_col, vector_col, scale)
    model = fit(whole, scale, shift, components)
    k = len(model.eigenvalues)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dim, n, sums, error = model.dim, model.n, model.sums, model.identity_error
    w = model.components / np.sqrt(model.eigenvalues) if k else model.components
    share = model.eigenvalues / model.trace if k else model.eigenvalues

    def project(batches):
        for b in batches:
            m = b.num_rows
            z, deviation = _deviations(_integers(_matrix(b.column(1), dim), scale, shift), n, sums)
            row = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 deviation.take(pa.array(row)), pa.array((z @ w).reshape(-1)), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
        release_memory()

    if k == 0:
        return whole.where(F.lit(False)).select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    return whole.where(F.size("v") == dim).mapInArrow(project, schema)
