"""Embedding whitening by a matrix-free Jacobi-Davidson eigensolver.

Vectors become integers, x = floor(256 c), and the *fit list* holds each distinct one once. Its
covariance matrix V is never formed: the solver only multiplies a few vectors by it, and each such
product is one pass of Spark tasks over the fit list, sum of (x - mean) ((x - mean) . w) / n, with
one packed partial sum a task. The driver holds vectors of the table's dimension only, at most
``BASIS`` of them and as many products.

Solver, for the k largest eigenpairs at once:

1. Rayleigh-Ritz in a search space gives approximate pairs (t, u) and residuals r = V u - t u.
2. Leading pairs whose residual, computed from a new product, is at the level of rounding are
   locked; the rest of the space stays orthogonal to them.
3. For every pair still open the correction equation (I - QQ')(V - t I)(I - QQ') s = -r, Q being
   the locked and the open approximations, is solved by a few steps of MINRES. The equations of
   all open pairs share one distributed product a step.
4. The corrections, orthogonalised twice, extend the space; a full one is restarted from its best
   Ritz vectors. Without new directions the space is extended by random ones.

Edge cases. Rows whose vector is null, or holds a null or non-finite entry, are dropped. The
dimension is the most frequent length (ties: the longer); rows of another length are dropped, since
no inner product with them is defined. Directions without variance (eigenvalue at most rounding of
the largest) can't be whitened and have no row, so equal vectors, one vector, empty vectors and empty
tables give no rows. Of equal eigenvalues any orthonormal choice is right; the sign makes the entry
of largest size positive. ``deviation`` is null where the exact value needs more than 64 bits.
Null and repeated ids are returned as they are, row by row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import forget, map_arrow, new_path, stored

#: Vectors of a packed row, and sizes of the search space: largest, and kept at a restart, in multiples of k.
ROWS = 4096
BASIS, KEPT = 10, 6
MINRES_STEPS, OUTER_STEPS = 4, 300


@dataclass(frozen=True)
class Model:
    """Means and unit components (columns) of the fit list."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


# ---- rows -----------------------------------------------------------------------------------

def integers(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows that take part, as arrays of longs."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & finite)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * 256.0)).alias("x"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """The rows of a non-empty array of equally long lists."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _packed(rows: DataFrame) -> DataFrame:
    """(n, kind, data): blocks of vectors in the smallest integer type that holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                x = _matrix(b.column(0).slice(at, ROWS))
                kind = np.result_type(np.min_scalar_type(x.min()), np.min_scalar_type(x.max())) if x.size else np.dtype("i1")
                kind = kind if kind.kind == "i" else np.dtype(f"i{min(2 * kind.itemsize, 8)}")
                yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([kind.str]), pa.array([x.astype(kind).tobytes()], pa.binary())], names=["n", "kind", "data"])
    return map_arrow(rows.select("x"), run, "n long, kind string, data binary")


class FitList:
    """The distinct vectors as a table of the shared folder, and sums over it."""

    def __init__(self, rows: DataFrame, dimension: int):
        self.spark, self.dimension = rows.sparkSession, dimension
        self.path = new_path(self.spark, "fit-list")
        _packed(rows.select("x").distinct()).write.parquet(self.path)
        self.blocks = self.spark.read.parquet(self.path)
        self.n = self.blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def total(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum over all blocks of ``of(vectors as longs)``, whose shape does not depend on the data."""
        size = int(np.prod(shape))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for b in batches:
                for n, kind, data in zip(*b.columns, strict=True):
                    total += of(np.frombuffer(data.as_buffer(), kind.as_py()).reshape(n.as_py(), -1).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total.ravel())], names=["cell", "value"])

        out = np.zeros(size)
        for r in map_arrow(self.blocks, run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():  # `size` rows
            out[r["cell"]] = r["value"]
        return out.reshape(shape)

    def sums(self) -> list[int]:
        """Exact sums by dimension: high and low halves of the longs are summed apart."""
        d = self.dimension

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, d), np.int64)
            for b in batches:
                for n, kind, data in zip(*b.columns, strict=True):
                    x = np.frombuffer(data.as_buffer(), kind.as_py()).reshape(n.as_py(), -1).astype(np.int64)
                    total += np.array([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total[0]), pa.array(total[1])], names=["cell", "high", "low"])

        found = map_arrow(self.blocks, run, "cell long, high long, low long").groupBy("cell").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
        out = {r["cell"]: (r["high"] << 32) + r["low"] for r in found.collect()}  # a row per dimension
        return [out[k] for k in range(d)]


def _blas(x: np.ndarray, mean: np.ndarray, w: np.ndarray) -> np.ndarray:
    c = x - mean
    return c.T @ (c @ w)


# ---- solver ---------------------------------------------------------------------------------

def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of product(x) = b for every column of b by itself; ``product`` is
    symmetric and linear in each column, and called once a step for all of them."""
    beta = np.linalg.norm(b, axis=0)
    unit = lambda z, size: z / np.where(size > 0, size, 1.0)
    x, v, v_old = np.zeros_like(b), unit(b, beta), np.zeros_like(b)
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    rest, link = beta.copy(), np.zeros_like(beta)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = product(v) - link * v_old
        alpha = (v * p).sum(axis=0)
        p -= alpha * v
        beta = np.linalg.norm(p, axis=0)
        # the new column of the tridiagonal matrix under the two last rotations, and the rotation that ends it
        over, mid = s_old * link, c * (c_old * link) + s * alpha
        low = c * alpha - s * (c_old * link)
        size = np.hypot(low, beta)
        c_old, s_old = c, s
        c, s = np.where(size > 0, unit(low, size), 1.0), unit(beta, size)
        w, w_old = unit(v - mid * w - over * w_old, size), w
        x += np.where(size > 0, c * rest, 0.0) * w
        rest = -s * rest
        v_old, v, link = v, unit(p, beta), beta
    return x


def _against(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``new`` adds to the orthonormal ``basis``."""
    out = np.empty((len(new), 0))
    for t in new.T:
        size = np.linalg.norm(t)
        for _ in range(2):
            t = t - basis @ (basis.T @ t)
            t = t - out @ (out.T @ t)
        left = np.linalg.norm(t)
        if size > 0 and left > 1e-10 * size:
            t = t / left
            both = np.c_[basis, out]
            t = t - both @ (both.T @ t)
            out = np.c_[out, t / np.linalg.norm(t)]
    return out


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dimension: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric positive semidefinite matrix, and unit eigenvectors."""
    k = min(k, dimension)
    rng = np.random.default_rng(13)
    locked, values = np.empty((dimension, 0)), []
    space = np.linalg.qr(rng.standard_normal((dimension, min(dimension, 4 * k))))[0]
    image = product(space)
    last, stalled = np.inf, 0
    for _ in range(OUTER_STEPS):
        h = space.T @ image
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        open_ = k - len(values)
        u, au, theta = space @ s[:, :open_], image @ s[:, :open_], e[:open_]
        scale = max([*values, float(abs(e[0])), np.finfo(float).tiny])
        limit = 16 * np.finfo(float).eps * np.sqrt(dimension) * scale
        complete = space.shape[1] + locked.shape[1] == dimension
        project = lambda z, q=locked: z - q @ (q.T @ z)
        residual = project(au - u * theta)
        lead = float(np.linalg.norm(residual[:, 0]))
        last, stalled = (lead, 0) if lead < last / 2 else (last, stalled + 1)
        if stalled > 2:  # sums of very many rows may round more coarsely: where the residual no longer falls
            limit *= 64
        done = 0
        while done < open_ and np.linalg.norm(residual[:, done]) <= limit:
            done += 1
        if done or complete:
            # Ritz pairs are locked on the residual of a new product, not of a sum of old ones
            image = product(space := _against(locked, space @ s)) if complete else image @ s
            space = space if complete else space @ s
            if complete:
                h = space.T @ image
                e, s = np.linalg.eigh((h + h.T) / 2)
                space, image, theta = space @ s[:, ::-1], image @ s[:, ::-1], e[::-1][:open_]
                done = open_
            else:
                fresh = product(space[:, :done])
                image[:, :done] = fresh
                theta = (space[:, :done] * fresh).sum(axis=0)
                bad = np.linalg.norm(project(fresh - space[:, :done] * theta), axis=0) > limit
                done = int(bad.argmax()) if bad.any() else done
            locked, values = np.c_[locked, space[:, :done]], [*values, *(float(t) for t in theta[:done])]
            space, image = space[:, done:], image[:, done:]
            last, stalled = np.inf, 0
            if len(values) == k:
                order = np.argsort(values)[::-1]
                return np.array(values)[order], locked[:, order]
            if done:
                if not space.shape[1]:
                    space = _against(locked, rng.standard_normal((dimension, k)))
                    image = product(space)
                continue
            h, s = np.diag(e), np.eye(space.shape[1])
        if space.shape[1] + open_ > BASIS * k:
            space, image = space @ s[:, :KEPT * k], image @ s[:, :KEPT * k]
        q = np.c_[locked, u]
        outside = lambda z, q=q: z - q @ (q.T @ z)
        steps = minres(lambda z: outside(product(z) - z * theta), -outside(residual), MINRES_STEPS)  # noqa: B023
        basis = np.c_[locked, space]
        new = _against(basis, outside(steps))
        if not new.shape[1]:
            new = _against(basis, rng.standard_normal((dimension, open_)))
        space, image = np.c_[space, new], np.c_[image, product(new)]
    raise RuntimeError("Jacobi-Davidson did not converge")


# ---- model ----------------------------------------------------------------------------------

def fit(rows: DataFrame, k: int = 4) -> Model | None:
    """Whitening of the distinct vectors of ``integers``; None if no direction has any variance."""
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None or not lengths["d"]:
        return None
    dimension = lengths["d"]
    fits = FitList(rows.where(F.size("x") == dimension), dimension)
    n, sums = fits.n, fits.sums()
    mean = np.array([s / n for s in sums])
    trace = float(fits.total(lambda x: np.array([((x - mean) ** 2).sum()]), (1,))[0]) / n
    if trace == 0:
        forget(fits.spark, fits.path)
        return None
    sent = lambda w: fits.total(lambda x: _blas(x, mean, w), w.shape) / n
    values, vectors = jacobi_davidson(sent, dimension, k)
    live = values > 64 * np.finfo(float).eps * values[0] * dimension
    values, vectors = values[live], vectors[:, live]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    scaled = vectors / np.sqrt(values)
    centre = fits.total(lambda x: ((x - mean) @ scaled).sum(axis=0), (len(values),)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ scaled - centre
        return z.T @ z
    error = np.abs(fits.total(spread, (len(values),) * 2) / n - np.eye(len(values))).max()
    forget(fits.spark, fits.path)
    return Model(n, sums, values, vectors, trace, float(error))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2 by row; None beyond 64 bits."""
    most = n * max(abs(int(x.max())), abs(int(x.min())), 1) + max(map(abs, sums))
    if most < 1 << 31 and x.shape[1] * most * most < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per remaining
    row of the table and component."""
    spark = table.sparkSession
    rows = stored(integers(table, id_col, vector_col), "vectors")
    model = fit(rows, k)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {RESULT}"
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)  # k + 1 vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mean, scaled, c = m.mean, m.components / np.sqrt(m.values), len(m.values)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                x = _matrix(part.column(1))
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(rows), c))), pa.array(np.tile(np.arange(1, c + 1), rows).astype(np.int32)),
                     pa.array(np.full(rows * c, m.n)), pa.array([v for v in _deviation(x, m.n, m.sums) for _ in range(c)], pa.int64()),
                     pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(m.values / m.trace, rows)), pa.array(np.full(rows * c, m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(rows.where(F.size("x") == len(model.sums)).select("vec_id", "x"), run, schema)
