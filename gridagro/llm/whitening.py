"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed. All that is asked of the data is its product with a few vectors: each
task multiplies its blocks of centred rows twice, and Spark adds up what the tasks return. On the
driver there are only the small basis and its projections (dimensions x basis).

Each outer step takes the Ritz pairs of the basis (Rayleigh-Ritz), locks those whose residual has
reached double precision, and extends the basis by approximate solutions of the correction equations
of the others, projected to the complement of all locked and Ritz vectors. These are solved by MINRES,
for all vectors in the same steps, so that a step is one product over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridagro.llm.common import read, stored

#: Vectors of a stored block.
BLOCK_ROWS = 4096
#: Vectors beyond the wanted ones that are carried along, MINRES steps of a correction, and columns of the basis before it is cut to its Ritz vectors.
GUARDS, INNER, BASIS = 2, 10, 40
#: Residual, relative to the largest eigenvalue, below which a pair is locked.
PRECISION = 64 * np.finfo(float).eps
#: Outer steps after which the residuals that double precision allows are taken to be reached, if none has halved.
PATIENCE = 3

_LARGE = 2.0**62

Product = Callable[[np.ndarray], np.ndarray]
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Components(NamedTuple):
    """Unit eigenvectors as columns, eigenvalues by falling size, relative residuals, products over the data."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    products: int


def _orthonormal(x: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns of ``x`` made orthonormal, also to ``against``; columns that vanish are left out."""
    out = against
    for column in x.T:
        norm = np.linalg.norm(column)
        for _ in range(3):
            column = column - out @ (out.T @ column)
        rest = np.linalg.norm(column)
        if norm > 0 and rest > 1e-10 * norm:
            column = column / rest
            column = column - out @ (out.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out[:, against.shape[1] :]


def minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of product(x) = right for all columns, by the same number of MINRES steps each."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    scale = np.where(beta > 0, beta, 1)
    v, v_old = right / scale, np.zeros_like(right)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    eta, gamma, gamma_old, sigma, sigma_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    open_ = eta > 0
    for _ in range(steps):
        y = product(v)
        alpha = np.sum(v * y, axis=0)
        y = y - alpha * v - beta * v_old
        following = np.linalg.norm(y, axis=0)
        delta = gamma * alpha - gamma_old * sigma * beta
        one = np.hypot(delta, following)
        two = sigma * alpha + gamma_old * gamma * beta
        three = sigma_old * beta
        open_ = open_ & (one > 0)
        one = np.where(open_, one, 1)
        gamma_old, sigma_old, gamma, sigma = gamma, sigma, delta / one, following / one
        w_old, w = w, (v - three * w_old - two * w) / one
        x = x + np.where(open_, gamma * eta, 0) * w
        eta = -sigma * eta
        open_ = open_ & (following > 1e-14 * scale)
        v_old, v = v, y / np.where(following > 0, following, 1)
        beta = following
        if not open_.any():
            break
    return x


def jacobi_davidson(product: Product, d: int, wanted: int, precision: float = PRECISION) -> Components:
    """The ``wanted`` leading eigenpairs of the symmetric matrix of order ``d`` behind ``product``."""
    calls = 0

    def counted(x: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return product(x)

    wanted = min(wanted, d)
    width = min(d, wanted + GUARDS)
    locked = image = np.zeros((d, 0))
    values, residuals = [], []
    basis = _orthonormal(np.random.default_rng(7).standard_normal((d, width)), locked)
    images = counted(basis)
    best, waited = np.inf, 0
    while True:
        small = basis.T @ images
        theta, s = np.linalg.eigh((small + small.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, ritz_images = basis @ s, images @ s
        rest = ritz_images - theta * ritz
        rest = rest - locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        largest = max([*values, *theta[:1], 0.0])
        whole = basis.shape[1] + locked.shape[1] == d  # nothing is left to extend the basis with
        best, waited = (size[0], 0) if size[0] < best / 2 else (best, waited + 1)
        take = 0
        while take < min(wanted - len(values), len(theta)) and (size[take] <= precision * largest or whole or take == 0 and waited >= PATIENCE and size[0] <= 1e3 * precision * largest):
            take += 1
        if take:
            values += theta[:take].tolist()
            residuals += (size[:take] / (largest or 1)).tolist()
            locked, image = np.column_stack([locked, ritz[:, :take]]), np.column_stack([image, ritz_images[:, :take]])
            basis, images, theta, rest = ritz[:, take:], ritz_images[:, take:], theta[take:], rest[:, take:]
            best, waited = np.inf, 0
            ritz, ritz_images = basis, images
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return Components(locked[:, order], np.array(values)[order], np.array(residuals)[order], calls)
        if basis.shape[1] > max(BASIS, 2 * width) - width:
            basis, images = ritz[:, : 2 * width], ritz_images[:, : 2 * width]
        k = min(width, basis.shape[1])
        known = np.column_stack([locked, ritz[:, :k]])
        shift = theta[:k]

        def projected(x: np.ndarray) -> np.ndarray:
            x = x - known @ (known.T @ x)
            y = counted(x) - shift * x
            return y - known @ (known.T @ y)

        right = -(rest[:, :k] - known @ (known.T @ rest[:, :k]))
        more = minres(projected, right, INNER)
        more = _orthonormal(more, np.column_stack([locked, basis]))
        if not more.shape[1]:  # the corrections vanished: any new direction will do
            more = _orthonormal(np.random.default_rng(calls).standard_normal((d, 1)), np.column_stack([locked, basis]))
        basis, images = np.column_stack([basis, more]), np.column_stack([images, counted(more)])


def grid_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector is whole, with it as ``x``: 256 times each entry, rounded down, as long.

    Rows go whose vector is null or has a null, NaN or infinite entry, and those of another length
    than most such vectors have (of equally common lengths the greater).
    """
    entries = F.transform(F.col(column), lambda c: c.cast("double"))
    sound = F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    whole = vectors.filter(F.col(column).isNotNull() & sound)
    lengths = whole.groupBy(F.size(column).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return whole.filter(F.size(column) == (lengths["length"] if lengths else 0)).withColumn("x", F.transform(entries, lambda c: F.floor(c * 256).cast("long")))


def _packed(sums: list[int], n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                away = _away(batch.column(0).slice(at, BLOCK_ROWS), n, sums)
                yield pa.record_batch([pa.array([(away / n).astype(np.float64).tobytes()], pa.binary())], ["block"])

    return run


def _away(column: pa.Array, n: int, sums: list[int]) -> np.ndarray:
    """n times each vector less the sums, exactly: as longs, or as Python numbers where longs might not do."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if 2 * n * np.abs(x.astype(np.float64)).max(initial=0) < _LARGE and max(map(abs, sums)) < _LARGE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(away: np.ndarray) -> list[int]:
    """The sum of squares of each row, exactly; what a long cannot hold becomes the greatest long."""
    if away.dtype == np.int64 and np.abs(away).max(initial=0).astype(np.float64) ** 2 * away.shape[1] < _LARGE:
        return np.sum(away * away, axis=1).tolist()
    return [min(sum(int(v) ** 2 for v in row), np.iinfo(np.int64).max) for row in away]


class Cloud:
    """The distinct grid vectors, centred and stored in blocks, and products with their covariance."""

    def __init__(self, grid: DataFrame):
        distinct = stored(grid.select("x").distinct(), "vectors")
        sums = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("i").collect()
        self.d, self.n = len(sums), sums[0]["n"] if sums else 0
        self.sums = [int(r["s"]) for r in sums]
        if self.d:
            self.blocks = stored(distinct.mapInArrow(_packed(self.sums, self.n), "block binary"), "blocks")
            self.trace = float(self._summed(lambda x: np.sum(x * x, keepdims=True), (1, 1))[0, 0]) / self.n

    def _summed(self, task: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        """The sum of a small matrix that ``task`` makes of each block; tasks add up their blocks, Spark the tasks."""
        d = self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for block in batch.column(0):
                    total += task(np.frombuffer(block.as_buffer(), np.float64).reshape(-1, d))
            yield pa.record_batch([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["i", "v"])

        total = np.zeros(shape[0] * shape[1])
        for row in self.blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            total[row["i"]] = row["v"]
        return total.reshape(shape)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``vectors``."""
        return self._summed(lambda x: x.T @ (x @ vectors), vectors.shape) / self.n


def _rows(cloud: Cloud, vectors: np.ndarray, values: np.ndarray, error: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    n, sums, k = cloud.n, cloud.sums, len(values)
    scaled = vectors / np.sqrt(values)
    explained = values / cloud.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = _away(batch.column(1), n, sums)
            white = (away / n).astype(np.float64) @ scaled
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))), pa.array(np.full(len(batch) * k, n, np.int64)),
                pa.array(np.repeat(np.array(_squares(away), np.int64), k)), pa.array(white.ravel()), pa.array(np.tile(explained, len(batch))), pa.array(np.full(len(batch) * k, error)),
            ]
            yield pa.record_batch(columns, [c.split(" ")[0] for c in WHITENED.split(", ")])

    return run


def whiten(vectors: DataFrame, column: str = "embedding", components: int = 4) -> DataFrame:
    """One row per whole vector and leading component: its projection, scaled to variance one, and what all vectors share.

    Entries are floor(256 c) as long. The covariance is that of the distinct vectors, divided by their
    number n; components are its unit eigenvectors by falling eigenvalue, with the largest entry
    positive. Rows with a null vector, or a null, NaN or infinite entry, are left out, as are those of
    another length than most (``grid_vectors``). Components without variance (fewer distinct vectors or
    dimensions than components) have no rows; so an empty table, or one vector only, gives none.
    A deviation beyond a long is given as the greatest long. Repeated rows are returned each; a null vec_id stays null; other columns are left out.
    """
    grid = grid_vectors(vectors, column)
    cloud = Cloud(grid)
    if cloud.n < 2 or cloud.trace == 0:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    found = jacobi_davidson(cloud.product, cloud.d, components)
    real = found.values > 1e-12 * found.values[0]
    u, e = found.vectors[:, real], found.values[real]
    u = u * np.sign(u[np.argmax(np.abs(u), axis=0), np.arange(u.shape[1])])
    covariance = u.T @ cloud.product(u) / np.sqrt(np.outer(e, e))
    error = float(np.abs(covariance - np.eye(len(e))).max())
    return grid.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(_rows(cloud, u, e, error), WHITENED)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
