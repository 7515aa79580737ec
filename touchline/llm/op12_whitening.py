"""Whitening of embeddings by a block Jacobi-Davidson method without a covariance matrix.

Entries become integers (``SCALE`` times the entry, rounded down, plus ``SHIFT``), so counts, sums and deviations
are exact. The covariance is only ever applied to blocks of vectors: each product is one pass over the rows,
centred before multiplying, summed within partitions and then over them in a fixed order. The driver holds
blocks of d x (a few times ``components``) numbers, whatever the number of rows.

Each outer step takes the Ritz pairs of the search space, locks the leading ones whose residuals reach double
precision, solves the projected correction equations of the others by some steps of MINRES (all of them share
the products), adds the solutions to the search space and restarts it where it has grown too wide.

Rows whose vector is null, or holds null, non-finite or huge entries (over ``LARGEST``), are dropped; so are
vectors of another length than most (of lengths as frequent, the larger counts). Null vec_ids and repeated rows
stay. Components whose variance is zero to double precision, as where all vectors are equal, are none: they
give no rows. A deviation beyond the range of long is null. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shipped
from touchline.session import checkpointed, delete_paths, recorded

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 32
#: Steps of MINRES for a correction; width of the search space at a restart, in components.
INNER_STEPS, WIDEST = 8, 4
MOST_STEPS = 200
#: Partial sums that reach the driver at once.
SUMS_AT_ONCE = 256
EPSILON = np.finfo(float).eps


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the integers ``x`` of every vector that counts."""
    good = F.coalesce(F.forall("v", lambda e: F.coalesce(F.abs(e) <= LARGEST, F.lit(False))), F.lit(False))
    kept = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(good)
    kept = kept.filter(F.size("v") > 0)
    usual = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kept = kept.filter(F.size("v") == (usual["d"] if usual else 0))
    return kept.select("vec_id", F.transform("v", lambda e: F.floor(SCALE * e) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(len(column), -1)


def summed(rows: DataFrame, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum over all rows of ``add(x)`` (an array of fixed size): partition sums, added in their order.

    Where there are more than ``SUMS_AT_ONCE`` of them, groups of partitions are added up first.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = np.asarray(add(_matrix(batch.slice(start, 4096))), float)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]),
                                              pa.array([total.tobytes()], pa.binary())], names=["part", "sum"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, None
        for batch in batches:
            for part, own in zip(batch.column("part").to_pylist(), batch.column("sum").to_pylist()):
                own = np.frombuffer(own)
                total, first = (own, part) if total is None else (total + own, first)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([total.tobytes()], pa.binary())],
                                             names=["part", "sum"])

    sums = shipped(rows.select("x")).mapInArrow(partial, "part long, sum binary")
    parts = rows.rdd.getNumPartitions()
    if parts > SUMS_AT_ONCE:
        sums = sums.repartitionByRange(SUMS_AT_ONCE, "part").sortWithinPartitions("part").mapInArrow(
            together, "part long, sum binary")
    found = sorted((r["part"], bytes(r["sum"])) for r in sums.collect())
    return np.sum([np.frombuffer(s) for _, s in found], axis=0) if found else None


@dataclass
class Centre:
    """Number of vectors, exact sums by dimension, and the range of the entries."""

    n: int
    sums: np.ndarray        # of Python integers
    low: int
    high: int

    @property
    def small(self) -> bool:
        """Whether n x - S and its squared length fit into 64 bits."""
        most = self.n * (self.high - self.low)
        return len(self.sums) * most * most < 1 << 62 and self.n * max(abs(self.high), abs(self.low)) < 1 << 62

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        return (x * np.int64(self.n) - self.sums.astype(np.int64)) if self.small else x.astype(object) * self.n - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(float) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Squared length of n x - S."""
        z = self.spread(x)
        return [d if d < 1 << 63 else None for d in (z * z).sum(axis=1).tolist()]


def centre(rows: DataFrame) -> Centre | None:
    """Exact sums: upper and lower halves of the entries are added apart, as numbers below 2^53."""
    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)])

    total = summed(rows, halves)
    if total is None:
        return None
    n, d = int(total[0]), (len(total) - 1) // 2
    sums = np.array([(int(a) << 20) + int(b) for a, b in zip(total[1:d + 1], total[d + 1:])], object)
    ends = rows.agg(F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high")).first()
    return Centre(n, sums, ends["low"], ends["high"])


def covariance_product(rows: DataFrame, about: Centre) -> Callable[[np.ndarray], np.ndarray]:
    """The covariance (divisor n) applied to the columns of a block, in one pass."""
    def product(block: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            y = about.centred(x)
            return (y.T @ (y @ block)).ravel()

        return summed(rows, add).reshape(block.shape) / about.n

    return product


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span ``block`` outside the span of ``against``; dependent ones are left out."""
    kept = against
    for column in block.T:
        length = np.linalg.norm(column)
        if not length > 0:
            continue
        column = column / length
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            kept = np.hstack([kept, column[:, None]])
    return kept[:, against.shape[1]:]


def minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, right: np.ndarray, fixed: np.ndarray,
           steps: int) -> np.ndarray:
    """Approximate solutions, outside the span of ``fixed``, of (A - shift) t = right for each column.

    The columns are systems of their own that share the products; a step costs one pass over the rows.
    """
    def project(z: np.ndarray) -> np.ndarray:
        return z - fixed @ (fixed.T @ z)

    v = project(right)
    beta = np.linalg.norm(v, axis=0)
    eta = beta.copy()
    start = np.maximum(beta, np.finfo(float).tiny)
    v_old, w_old, w_older = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c_old = c = np.ones_like(beta)
    s_old = s = np.zeros_like(beta)
    t = np.zeros_like(v)
    v = v / start
    beta_in = np.zeros_like(beta)
    for _ in range(steps):
        z = project(product(v) - v * shifts)
        alpha = (v * z).sum(axis=0)
        z = project(z - alpha * v - beta_in * v_old)
        beta = np.linalg.norm(z, axis=0)
        # the column of the tridiagonal matrix, turned by the last two rotations
        low = c * alpha - c_old * s * beta_in
        mid = s * alpha + c_old * c * beta_in
        far = s_old * beta_in
        top = np.hypot(low, beta)
        safe = np.where(top > 0, top, 1)
        c_old, s_old = c, s
        c, s = low / safe, beta / safe
        w = (v - far * w_older - mid * w_old) / safe
        t = t + np.where(top > 0, c * eta, 0) * w
        eta = -s * eta
        w_older, w_old = w_old, w
        v_old, v = v, np.where(beta > 0, z / np.where(beta > 0, beta, 1), 0)
        beta_in = beta
        if np.all(np.abs(eta) <= 1e-3 * start):
            break
    return t


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors (columns)."""
    random = np.random.default_rng(7)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    space = _orthonormal(random.normal(size=(d, min(d, k + 2))), locked)
    images = product(space)
    best, still = np.inf, 0
    for _ in range(MOST_STEPS):
        h = space.T @ images
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        wanted = min(k - len(values), space.shape[1])
        u, au = space[:, :wanted], images[:, :wanted]
        residuals = au - u * theta[:wanted]
        residuals -= locked @ (locked.T @ residuals)
        norms = np.linalg.norm(residuals, axis=0)
        size = max([abs(theta[0]), *np.abs(values)])
        whole = space.shape[1] + locked.shape[1] >= d
        # rounding of the products keeps residuals at a few units in the last place
        still = still + 1 if norms.max() > best / 2 else 0
        best = min(best, norms.max())
        enough = 8 * EPSILON * np.sqrt(d) * size
        if still >= 3 or whole:
            enough = max(enough, 1e-12 * size)
        done = norms <= enough
        lead = wanted if done.all() else int(np.argmin(done))
        if lead:
            locked = np.hstack([locked, u[:, :lead]])
            values = np.r_[values, theta[:lead]]
            space, images = space[:, lead:], images[:, lead:]
            best, still = np.inf, 0
        if len(values) >= k:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        u, residuals, theta = u[:, lead:], residuals[:, lead:], theta[lead:wanted]
        if space.shape[1] > WIDEST * k:
            space, images = space[:, :2 * k], images[:, :2 * k]
        fixed = np.hstack([locked, u])
        if fixed.shape[1] + 1 >= d or whole:       # the whole space is searched: only rounding is left
            new = random.normal(size=(d, 1))
        else:
            new = minres(product, theta, -residuals, fixed, INNER_STEPS)
        new = _orthonormal(new, np.hstack([locked, space]))
        if new.shape[1]:
            space, images = np.hstack([space, new]), np.hstack([images, product(new)])
        else:       # nothing new: exact images once more, against rounding
            space = _orthonormal(space, locked)
            images = product(space)
    raise RuntimeError(f"eigenvectors did not settle in {MOST_STEPS} steps")


@dataclass
class Whitening:
    centre: Centre
    values: np.ndarray      # variances, falling
    vectors: np.ndarray     # unit columns
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.values))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on integer vectors (column x); None if there are none."""
    about = centre(rows)
    if about is None:
        return None
    d = len(about.sums)
    trace = float(summed(rows, lambda x: np.array([(about.centred(x) ** 2).sum()]))[0]) / about.n
    if not trace > 0:
        return Whitening(about, np.zeros(0), np.zeros((d, 0)), trace)
    values, vectors = jacobi_davidson(covariance_product(rows, about), d, min(components, d))
    real = values > d * EPSILON * trace
    return Whitening(about, values[real], vectors[:, real], trace)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened covariance less the identity."""
    k = len(model.values)

    def add(x: np.ndarray) -> np.ndarray:
        w = model.apply(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    total = summed(rows, add) / model.centre.n
    mean = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """A row for each vector and component."""
    out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    k, explained = len(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                x, m = _matrix(batch), batch.num_rows
                again = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, model.centre.n)),
                     pa.array(model.centre.deviation(x), pa.int64()).take(again),
                     pa.array(model.apply(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    schema=out)

    ready = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x")
    return shipped(ready).mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, "
                                          "explained double, identity_error double")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every vector that counts."""
    spark = embeddings.sparkSession
    passing: list[str] = []
    with recorded(passing):
        rows = checkpointed(integer_vectors(embeddings), "op12-integers")
        model = fit(rows, components)
        if model is None or not len(model.values):
            found = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                              "explained double, identity_error double")
            delete_paths(spark, passing)
            return found
        done = checkpointed(whitened(rows, model, identity_error(rows, model)), "op12-whitened")
    passing.pop()
    delete_paths(spark, passing)
    return done
