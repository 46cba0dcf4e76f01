"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries are put on an integer grid, so counts and sums are exact and rows are
centred before anything is multiplied.  A block of ``k + extra`` directions
is improved in sweeps: a scaled Chebyshev recurrence, each step one
distributed pass ``Z = X'X Q / n`` over the centred rows, damps the spectrum
that isn't wanted, then QR and one more pass for Rayleigh-Ritz.  The interval
that is damped reaches from below the smallest eigenvalue (estimated by a
Lanczos vector that rides along in the first sweep) to the block's smallest
Ritz value.  Sweeps end when the residual of every wanted pair certifies it;
where the spectrum is too flat for that the block is widened, at the utmost to
all dimensions.

A pass moves ``dimensions x block`` numbers a task, summed by Spark; the
driver holds matrices of that size only, never rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.llm.common import materialise

LIMIT = 1 << 52  # grid values are exact in a double below it
CERTIFIED = 2e-13  # residual over the largest eigenvalue
SETTLED = 1e-11  # enough once a sweep brings nothing more
ZERO = 1e-12  # eigenvalues below this share of the largest count as zero


class Grid:
    """The rows that take part, as integers: a table (id, x: packed integers),
    their number n, length dim, exact sums."""

    def __init__(self, vectors: DataFrame, id_col: str, vec_col: str, scale: int, shift: int):
        v = F.transform(F.col(f"`{vec_col}`"), lambda x: F.floor(x.cast("double") * scale))
        finite = F.forall(F.col(f"`{vec_col}`"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * scale < LIMIT))
        rows = vectors.where(F.col(f"`{vec_col}`").isNotNull() & finite).select(F.col(f"`{id_col}`").alias("id"), v.alias("v"))
        size = F.size("v")
        seen = rows.where(size > 0).groupBy(size.alias("dim")).agg(
            F.count("*").alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most"))
        best = seen.orderBy(F.desc("n"), F.desc("dim")).first()
        self.schema = rows.schema["id"]
        self.n, self.dim, most = (best["n"], best["dim"], best["most"]) if best else (0, 0, 0)
        self.shift = shift
        self.type = np.dtype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")
        if not self.n:
            return
        kind = self.type

        def pack(batches):
            for b in batches:
                if b.num_rows:
                    x = b.column(1).flatten().to_numpy().astype(kind).reshape(b.num_rows, -1)
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "x"])

        packed = rows.where(size == self.dim).select("id", "v")
        self.rows = materialise(packed.mapInArrow(pack, packed.select("id", F.lit(b"").alias("x")).schema), "whitening-grid")
        self.sums = self._sums()
        #: the integer part of each mean and what is left of the sum beyond it
        self.mean = [s // self.n for s in self.sums]
        self.rest = [s - self.n * m for s, m in zip(self.sums, self.mean)]

    def _sums(self) -> list[int]:
        """Exact sums of the grid values, without the shift."""
        kind, dim = self.type, self.dim

        def run(batches):
            total = [0] * dim
            for b in batches:
                if b.num_rows:
                    for part in np.array_split(unpack(b, kind), -(-b.num_rows // 1024)):
                        total = [t + s for t, s in zip(total, part.sum(axis=0, dtype=np.int64).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["at", "s"])

        got = self.rows.select("x").mapInArrow(run, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").cast("string").alias("s")).collect()
        return [int(s) for _, s in sorted((r["at"], r["s"]) for r in got)]

    def centred(self):
        """A function from a batch of packed rows to centred doubles; the
        subtraction of the mean's integer part is exact."""
        kind, mean, rest = self.type, np.array(self.mean, np.int64), np.array(self.rest, np.float64) / self.n

        def of(batch, column: int = 0):
            return (unpack(batch, kind, column) - mean).astype(np.float64) - rest
        return of

    def passed(self, step, size: int) -> np.ndarray:
        """Sum over all batches of ``step(centred rows)``, an array of ``size``."""
        centred = self.centred()

        def run(batches):
            total = np.zeros(size)
            for b in batches:
                for at in range(0, b.num_rows, 4096):
                    total += step(centred(b.slice(at, 4096))).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "v"])

        got = self.rows.select("x").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
        out = np.zeros(size)
        out[got["at"].to_numpy()] = got["v"].to_numpy()
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q: one pass over the centred rows."""
        return self.passed(lambda y: y.T @ (y @ q), q.size).reshape(q.shape) / self.n


def unpack(batch, kind: np.dtype, column: int = 0) -> np.ndarray:
    """The packed rows of a batch as an integer matrix."""
    col = batch.column(column)
    at = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind).reshape(len(col), -1).astype(np.int64)


def _lanczos(dim: int, rng) -> tuple:
    """A Lanczos run that is fed with one product a pass: (the vector whose
    product is wanted next, a function that takes it, one that gives a lower
    estimate of the smallest eigenvalue)."""
    state = {"q": [], "a": [], "b": [], "w": rng.standard_normal(dim)}
    state["q"].append(state["w"] / np.linalg.norm(state["w"]))

    def take(z):
        q, a, b = state["q"], state["a"], state["b"]
        a.append(float(q[-1] @ z))
        for p in q:
            z = z - (p @ z) * p
        for p in q:  # twice is enough
            z = z - (p @ z) * p
        b.append(float(np.linalg.norm(z)))
        q.append(z / b[-1] if b[-1] > 0 else z)

    def low():
        a, b = state["a"], state["b"]
        if not a:
            return 0.0
        e, u = np.linalg.eigh(np.diag(a) + np.diag(b[:-1], 1) + np.diag(b[:-1], -1))
        return max(0.0, 0.9 * (e[0] - b[-1] * abs(u[-1, 0])))

    return (lambda: state["q"][-1]), take, low


def leading(grid: Grid, k: int, extra: int, degree: int, sweeps: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues of the grid's covariance, unit
    eigenvectors in columns, and the largest residual over the largest one."""
    rng = np.random.default_rng(seed)
    k, width = min(k, grid.dim), min(grid.dim, k + extra)
    q = np.linalg.qr(rng.standard_normal((grid.dim, width)))[0]
    want, take, low = _lanczos(grid.dim, rng)
    riding, last, done = True, np.inf, 0
    while True:
        # Rayleigh-Ritz
        z = grid.times(q)
        e, u = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, z = q @ u, z @ u
        top = e[0]
        if top <= 0:
            return np.zeros(k), q[:, :k], 0.0
        wrong = np.linalg.norm(z - q * e, axis=0)[:k].max() / top
        if wrong <= CERTIFIED or (wrong <= SETTLED and wrong > last / 4) or (width == grid.dim and done):
            return e[:k], q[:, :k], wrong
        last = wrong
        if done and done % sweeps == 0 and width < grid.dim:  # too flat: more directions
            more = rng.standard_normal((grid.dim, min(width, grid.dim - width)))
            q = np.linalg.qr(np.concatenate([q, more], axis=1))[0]
            width = q.shape[1]
            z = grid.times(q)
            e = np.linalg.eigvalsh((q.T @ z + z.T @ q) / 2)[::-1]
            q = q if width < grid.dim else np.linalg.qr(z)[0]
        done += 1
        if width == grid.dim:
            continue  # nothing is left to damp
        a, b = (0.0 if riding else low()), e[-1]
        if b - a <= 1e-9 * top:
            a = 0.0
        half, mid = max((b - a) / 2, 1e-12 * top), (b + a) / 2

        def product(x):
            if not riding:
                return grid.times(x)
            z = grid.times(np.concatenate([x, want()[:, None]], axis=1))
            take(z[:, -1])
            return z[:, :-1]

        sigma = first = half / (top - mid)
        before, now = q, (product(q) - mid * q) * (sigma / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - sigma)
            before, now = now, (product(now) - mid * now) * (2 * after / half) - (sigma * after) * before
            sigma = after
        riding = False
        q = np.linalg.qr(now)[0]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 32, scale: int = 64, shift: int = 1_000_000,
           extra: int = 16, degree: int = 10, sweeps: int = 6, seed: int = 7) -> DataFrame:
    """One row per row of ``vectors`` that takes part and component: id,
    component (from 1, by falling eigenvalue), n, deviation, whitened,
    explained, identity_error.

    An entry c becomes the integer floor(scale * c) + shift.  deviation: sum
    over dimensions of (n * x - sum of x)^2, exact (null if it doesn't fit a
    long).  whitened: the centred row on the component's unit eigenvector
    (its largest entry positive), over the root of the eigenvalue.  explained:
    eigenvalue over the trace.  identity_error: largest absolute entry of the
    covariance of the whitened rows less the identity, measured by a pass.

    Null and empty vectors, those with a null or non-finite entry or one too
    large for exact doubles (2**52 on the grid), and those of another length
    than the commonest (of several, the longest) take no part and have no
    rows.  Rows that repeat count and are returned as often as they are there;
    null ids are carried.  Components whose eigenvalue is zero (constant
    dimensions, few rows) can't be whitened and have no rows, so one row, or
    rows that are all equal, give none.  Other columns are not read; an empty
    table gives no rows.
    """
    grid = Grid(vectors, id_col, vec_col, scale, shift)
    schema = (f"`{id_col}` {grid.schema.dataType.simpleString()}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    none = vectors.sparkSession.createDataFrame([], schema)
    if not grid.n:
        return none
    e, q, _ = leading(grid, k, extra, degree, sweeps, seed)
    q, e = q[:, e > ZERO * e[0]], e[e > ZERO * e[0]]
    if not len(e):
        return none
    q = q * np.where(q[np.abs(q).argmax(axis=0), np.arange(len(e))] < 0, -1.0, 1.0)
    w, m = q / np.sqrt(e), len(e)

    def measured(y):
        z = y @ w
        return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0), [np.square(y).sum()]])

    got = grid.passed(measured, m * m + m + 1) / grid.n
    mean = got[m * m:-1]
    error = float(np.abs(got[:m * m].reshape(m, m) - np.outer(mean, mean) - np.eye(m)).max())
    explained = e / got[-1]
    centred, kind, n = grid.centred(), grid.type, grid.n
    whole, rest = np.array(grid.mean, np.int64), grid.rest

    def deviations(x):
        """Exact sums of squares of n * x - S, as Python integers only where longs might not hold them."""
        d = x - whole
        if (int(np.abs(d).max(initial=0)) + 1) ** 2 * n * n * d.shape[1] < 1 << 63:
            return pa.array(np.square(n * d - np.array(rest, np.int64)).sum(axis=1))
        exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest)) for row in d.tolist()]
        return pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                rows = part.num_rows
                of = pa.array(np.repeat(np.arange(rows), m))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(of), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)), pa.array(np.full(rows * m, n)),
                    deviations(unpack(part, kind, 1)).take(of), pa.array((centred(part, 1) @ w).ravel()),
                    pa.array(np.tile(explained, rows)), pa.array(np.full(rows * m, error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return grid.rows.mapInArrow(run, schema)
