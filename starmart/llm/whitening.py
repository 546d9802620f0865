"""Whitening of embeddings: leading eigenvectors of their covariance by a block Jacobi-Davidson method.

The covariance is never formed. Each product with a block of vectors is one pass over the distributed fit list; the
driver holds a search space of a few dozen vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import tables

#: Components returned; vectors searched for besides them.
COMPONENTS, GUARD = 16, 4
#: Steps of an inner solution, and rounds of the search.
INNER, ROUNDS = 8, 200
SEED = 11

Product = Callable[[np.ndarray], np.ndarray]


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id and x, as whole numbers, of the rows to be looked at: see `whitened`."""
    c = rows.select(F.col("vec_id").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    reach = F.lit(float(1 << 56))  # beyond, 64 c is no long
    c = c.where("size(embedding) > 0").where(F.forall("embedding", lambda v: F.coalesce(F.abs(v) < reach, F.lit(False)) & ~F.isnan(v)))
    sizes = c.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("rows"))
    most = sizes.orderBy(F.desc("rows"), F.desc("size")).first()
    x = F.transform("embedding", lambda v: F.floor(v * 64).cast("long") + F.lit(1_000_000).cast("long"))
    return c.where(F.size("embedding") == (most["size"] if most else 0)).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch["x"]
    return x.flatten().to_numpy().reshape(len(x), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and dimension: rows, sums of the upper and lower halves of x (no overflow), least and greatest."""
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            d = x.shape[1]
            yield pa.RecordBatch.from_pydict(
                {
                    "dimension": np.arange(d, dtype=np.int32), "n": np.full(d, len(x)), "upper": (x >> 32).sum(axis=0),
                    "lower": (x & 0xFFFFFFFF).sum(axis=0), "least": x.min(axis=0), "most": x.max(axis=0),
                }
            )


@dataclass
class Fit:
    """The fit list as a table, its size, and exact sums per dimension. Centres are kept as whole and broken part."""

    table: DataFrame
    n: int
    sums: list[int]
    reach: int  # no entry is farther from its mean, n times

    @classmethod
    def of(cls, x: DataFrame) -> Fit:
        table = tables.written(x.select("x").distinct(), "fit")
        parts = table.mapInArrow(_sums, "dimension int, n long, upper long, lower long, least long, most long")
        whole = parts.groupBy("dimension").agg(
            *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "upper", "lower")), F.min("least").alias("least"), F.max("most").alias("most")
        )
        found = sorted(whole.collect(), key=lambda r: r.dimension)
        n = int(found[0].n) if found else 0
        sums = [(int(r.upper) << 32) + int(r.lower) for r in found]
        reach = max((max(n * r.most - s, s - n * r.least) for r, s in zip(found, sums)), default=0)
        return cls(table, n, sums, reach)

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole)])

    def summed(self, value: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum, over the fit list, of what `value` makes of a block of centred rows (always of one shape)."""
        whole, broken = self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                if batch.num_rows:
                    total = total + value((_matrix(batch) - whole).astype(np.float64) - broken).ravel()
            if np.ndim(total):
                yield pa.RecordBatch.from_pydict({"cell": np.arange(len(total), dtype=np.int32), "value": total})

        cells = self.table.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        found = cells.toPandas().sort_values("cell")
        return found["value"].to_numpy()

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block of vectors: one pass over the fit list."""
        return self.summed(lambda y: y.T @ (y @ block)).reshape(block.shape) / self.n


def orthonormal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """A basis of what the block adds to the others."""
    for _ in range(2):  # once more for full precision
        for other in against:
            block = block - other @ (other.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        left, held, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, held > 1e-10]
    for other in against:
        block = block - other @ (other.T @ block)
    return np.linalg.qr(block)[0] if block.shape[1] else block


def minres(apply: Product, right: np.ndarray, steps: int, part: float) -> np.ndarray:
    """Least-residual solutions of symmetric systems, one per column; all of them share the passes.

    Stops when every residual has come down to this part of the right side, or after so many steps.
    """
    tiny = np.finfo(float).tiny
    first = np.linalg.norm(right, axis=0)
    v, before = right / np.maximum(first, tiny), np.zeros_like(right)
    x, w, w_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    beta, left = np.zeros_like(first), first.copy()
    cosine, sine, bar, over = -np.ones_like(first), np.zeros_like(first), np.zeros_like(first), np.zeros_like(first)
    for _ in range(steps):
        y = apply(v) - before * beta
        alpha = (v * y).sum(axis=0)
        y = y - v * alpha
        before, beta = v, np.linalg.norm(y, axis=0)
        over_before, delta = over, cosine * bar + sine * alpha
        gamma_bar, over, bar = sine * bar - cosine * alpha, sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), tiny)
        cosine, sine = gamma_bar / gamma, beta / gamma
        move, left = cosine * left, sine * left
        w_before, w = w, (before - over_before * w_before - delta * w) / gamma
        x = x + move * w
        v = y / np.maximum(beta, tiny)
        if np.all(left <= part * first):
            break
    return np.where(np.isfinite(x), x, 0.0)


def jacobi_davidson(product: Product, size: int, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` greatest eigenvalues of a symmetric operator, falling, and their unit vectors (columns).

    Rayleigh-Ritz over the search space gives pairs and residuals. Leading pairs whose residual is down to rounding are
    locked: the search goes on at right angles to them. For the others, MINRES solves the correction equation
    (1 - QQ')(A - theta)(1 - QQ') t = -r, with Q the locked vectors and the pair's own, and the corrections widen the
    search space. A space that grows too wide starts again from its leading vectors.
    """
    wanted = min(wanted, size)
    wide, widest = min(wanted + GUARD, size), 6 * (wanted + GUARD)
    locked, values = np.zeros((size, 0)), []
    basis = orthonormal(np.random.default_rng(seed).standard_normal((size, wide)), [])
    image, scale = product(basis), 0.0
    for turn in range(ROUNDS):
        inner = basis.T @ image
        theta, turned = np.linalg.eigh((inner + inner.T) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned
        scale = max(scale, abs(theta[0]) if len(theta) else 0.0)
        rest = image - basis * theta
        rest = rest - locked @ (locked.T @ rest)
        small = np.linalg.norm(rest, axis=0) <= 4 * np.finfo(float).eps * size * scale
        done = min(int(np.argmin(small)) if not small.all() else len(small), wanted - len(values))
        locked = np.hstack([locked, basis[:, :done]])
        values += list(theta[:done])
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        basis, image, theta, rest = basis[:, done:], image[:, done:], theta[done:], rest[:, done:]
        open_ = np.flatnonzero(~small[done:])[: wanted - len(values) + GUARD]
        if basis.shape[1] + len(open_) > widest:
            keep = 2 * (wanted + GUARD)
            basis, image, open_ = basis[:, :keep], image[:, :keep], open_[open_ < keep]
        own, shift, right = basis[:, open_], theta[open_], -rest[:, open_]

        def across(block: np.ndarray) -> np.ndarray:
            block = block - locked @ (locked.T @ block)  # noqa: B023
            return block - own * (own * block).sum(axis=0)  # noqa: B023

        found = minres(lambda t: across(product(across(t)) - across(t) * shift), across(right), INNER, 2.0 ** -(turn + 1))  # noqa: B023
        fresh = orthonormal(across(found), [locked, basis])
        if not fresh.shape[1]:  # nothing new in the corrections
            fresh = orthonormal(np.random.default_rng([seed, turn]).standard_normal((size, wide)), [locked, basis])
        if fresh.shape[1]:
            basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
        elif basis.shape[1] + locked.shape[1] >= size and not np.any(np.isfinite(rest) & (np.abs(rest) > 1e-10 * scale)):
            image = product(basis)  # the space is whole: only rounding is left to be renewed
    raise RuntimeError(f"{wanted - len(values)} of {wanted} components have not converged")


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row and component.

    Rows whose vector is null, empty or holds null or non-finite entries are left out; so are rows with an entry of 2^56
    or more (64 times it is no long) and rows whose vector has another length than most have (of equally frequent
    lengths, the greater counts). x is floor(64 * entry) + 1000000. Each distinct x is once in the fit list, however
    many rows have it: n vectors, sums S. Components are eigenvectors of their covariance by falling eigenvalue;
    of equal eigenvalues any basis. Eigenvalues not above rounding (1e-12 of the greatest) have no component, so fewer
    than `components` come if the vectors span less; a single vector has none, and neither has an empty table.

    `whitened` is x - S / n projected on the component, divided by the root of its eigenvalue. `deviation` is the exact
    sum of (n x - S)^2, null where it is no long. `explained` is the eigenvalue's part of the trace. `identity_error` is
    the greatest absolute entry of the whitened fit list's covariance minus the identity. Rows with equal or null ids
    stand for themselves; other columns are not looked at.
    """
    spark = rows.sparkSession
    x = vectors(rows)
    fit = Fit.of(x)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    size = len(fit.sums)
    trace = float(fit.summed(lambda y: (y * y).sum(axis=0)).sum()) / fit.n if size else 0.0
    if trace <= 0:
        return spark.createDataFrame([], schema)
    values, axes = jacobi_davidson(fit.product, size, components)
    axes = axes[:, values > 1e-12 * values[0]]
    values = values[: axes.shape[1]]
    map_ = axes / np.sqrt(values)
    k = len(values)
    covariance = fit.summed(lambda y: (y @ map_).T @ (y @ map_)).reshape(k, k) / fit.n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained, n, (whole, broken) = values / trace, fit.n, fit.centre
    sums, fits = fit.sums, size * fit.reach**2 < 1 << 63 and n * max(abs(int(w)) for w in whole) + fit.reach < 1 << 62

    def deviations(block: np.ndarray) -> pa.Array:
        if fits:
            off = block * n - np.array(sums, np.int64)
            return pa.array((off * off).sum(axis=1))
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in block]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _matrix(batch)
            m = len(block)
            values = ((block - whole).astype(np.float64) - broken) @ map_
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)), deviations(block).take(pa.array(each)), pa.array(values.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.mapInArrow(run, schema)
