"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of whole-number vectors x are found without forming
V. A *pass* multiplies V with a thin block Q: every task centres its rows exactly (n*x - S in whole
numbers, S the sums per dimension), multiplies X'(XQ), and the small products are added up by Spark.

1. Sums: n and S, exact.
2. A few Lanczos steps on one vector bound the spectrum from below.
3. Rounds: orthonormalise the block by QR, one pass, Rayleigh-Ritz; then a Chebyshev polynomial of V,
   by its three-term recurrence of one pass per degree, damps all of the spectrum between the
   lower bound and the block's smallest Ritz value, and so lifts the wanted part.
4. The result is certified by the residuals |Vq - eq| of all wanted components against the rounding
   error of a pass; an uncertified result is an error, never returned.

The degree follows the residual and the growth that the last Ritz values promise, up to ``DEGREE``. The
block has ``EXTRA`` columns more than components are wanted. If it spans all dimensions, the first
Rayleigh-Ritz step is already exact and certified at once.

Scale: a pass reads the stored rows once and shuffles ``dimensions`` rows per task, whatever the number
of vectors; the driver holds blocks of dimensions x (components + EXTRA). No vector is shuffled.

Defined results: vectors that are NULL or hold NULL or non-finite entries are dropped, and so are empty
ones and those of another length than the most frequent one (ties: the longer). Repeated rows
count as often as they occur; a NULL id is kept. Components without variance (up to rounding) can't be
whitened and are not returned, so equal vectors, a single vector or an empty table give none.
Entries beyond 2**40 / 64 are refused with an error. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored
from tillflow.llm.vectors import from_binary, packed, usable

SCALE, PLUS = 64, 1_000_000
COMPONENTS = 32
#: Columns of the block beyond the wanted ones, largest degree of a polynomial, steps of the lower bound.
EXTRA, DEGREE, LANCZOS = 24, 12, 6
MOST_ROUNDS = 40
#: Residuals, as a share of the largest eigenvalue, that count as rounding error: at once, or if
#: further rounds don't lower them.
CERTIFIED, STALLED = 1e-14, 1e-12
#: Components with a smaller share of the largest eigenvalue have no variance.
NO_VARIANCE = 1e-10


@dataclass
class Model:
    """``n`` vectors with sums ``sums`` per dimension; eigenvalues, unit eigenvectors (columns), trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    passes: int = 0
    residual: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S/n``, rounded once."""
    return (n * x - sums) / n


def added_up(rows: DataFrame, size: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all stored rows of ``part(x)``, a matrix of some rows and ``width`` columns.

    Each task adds up its batches; Spark adds up the tasks' matrices, row by row.
    """
    names = [f"c{k}" for k in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            more = part(from_binary(batch.column(0), size))
            total = more if total is None else total + more
        if total is not None:
            arrays = [pa.array(np.arange(len(total), dtype=np.int32)), *[pa.array(c) for c in total.T]]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", *names])

    kind = "bigint" if part(np.zeros((0, size), np.int64)).dtype == np.int64 else "double"
    parts = rows.select("x").mapInArrow(add, ", ".join(["i int", *[f"{c} {kind}" for c in names]]))
    found = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect()
    return np.array([r[1:] for r in sorted(found)], np.int64 if kind == "bigint" else np.float64)


def counted(rows: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sums per dimension."""
    part = lambda x: np.stack([np.full(size, len(x), np.int64), x.sum(0)], 1)
    found = added_up(rows, size, 2, part)
    return (int(found[0, 0]), found[:, 1]) if len(found) else (0, np.zeros(size, np.int64))


class Covariance:
    """Products with the covariance, counted."""

    def __init__(self, rows: DataFrame, size: int, n: int, sums: np.ndarray):
        self.rows, self.size, self.n, self.sums, self.passes = rows, size, n, sums, 0

    def times(self, block: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums

        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return c.T @ (c @ block)

        self.passes += 1
        return added_up(self.rows, self.size, block.shape[1], part) / n

    def trace(self) -> float:
        n, sums = self.n, self.sums
        part = lambda x: (centred(x, n, sums) ** 2).sum(0)[:, None]
        return float(added_up(self.rows, self.size, 1, part).sum() / n)


def lower_bound(cov: Covariance, steps: int, rng: np.random.Generator) -> float:
    """A bound of the spectrum from below: the smallest Lanczos value less the last residual."""
    q = rng.standard_normal((cov.size, 1))
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(steps):
        w = cov.times(basis[-1])
        alphas.append(float((basis[-1].T @ w)[0, 0]))
        known = np.hstack(basis)
        for _ in range(2):
            w = w - known @ (known.T @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-10 * max(abs(a) for a in alphas):
            return 0.0  # the rest of the spectrum was not seen
        basis.append(w / betas[-1])
    tri = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(tri)[0]) - betas[-1])


def filtered(cov: Covariance, q: np.ndarray, vq: np.ndarray, low: float, cut: float, top: float, degree: int):
    """A scaled Chebyshev polynomial of V times ``q`` (with ``vq`` = Vq), small between low and cut."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    scale = half / (top - centre)
    first = scale
    before, now = q, (vq - centre * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (cov.times(now) - centre * now) * (2 * after / half) - (scale * after) * before
        scale = after
    return now


def degree_for(value: float, low: float, cut: float, residual: float, most: int) -> int:
    """The degree that brings a component with this Ritz value from ``residual`` to rounding error."""
    place = (2 * value - cut - low) / (cut - low)
    if place <= 1:
        return most
    growth = np.log(place + np.sqrt(place * place - 1))
    return int(np.clip(np.ceil(np.log(residual / 1e-16) / growth), 3, most))


def leading(
    cov: Covariance, components: int, extra: int = EXTRA, degree: int = DEGREE, seed: int = 11
) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, eigenvectors and the largest residual of the leading part, certified."""
    rng = np.random.default_rng(seed)
    width = min(cov.size, components + extra)
    wanted = min(components, cov.size)
    low = lower_bound(cov, min(LANCZOS, cov.size - 1), rng) if width < cov.size else 0.0
    block, best = rng.standard_normal((cov.size, width)), np.inf
    for _ in range(MOST_ROUNDS):
        q, _ = np.linalg.qr(block)
        vq = cov.times(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        if values[0] <= 0:
            return values[:0], q[:, :0], 0.0
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / values[0])
        if residual <= CERTIFIED or (residual <= STALLED and (residual > best / 2 or width == cov.size)):
            real = values[:wanted] > NO_VARIANCE * values[0]
            return values[:wanted][real], q[:, :wanted][:, real], residual
        best = min(best, residual)
        cut = max(float(values[-1]), NO_VARIANCE * 1e-2 * float(values[0]))
        bottom = min(low, 0.99 * cut)
        steps = degree_for(float(values[wanted - 1]), bottom, cut, residual, degree)
        block = filtered(cov, q, vq, bottom, cut, float(values[0]), steps)
    raise ArithmeticError(f"not certified: residual {best:.2e} of the largest eigenvalue")


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Model:
    """The leading components of stored ``id, x`` rows."""
    n, sums = counted(rows, size) if size else (0, np.zeros(0, np.int64))
    if not n:
        return Model(0, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    cov = Covariance(rows, size, n, sums)
    values, vectors, residual = leading(cov, components)
    return Model(n, sums, values, vectors, cov.trace(), cov.passes, residual)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[Decimal] | np.ndarray:
    """Per row the exact sum of (n*x - S)**2."""
    gaps = n * x - sums
    largest = int(np.abs(gaps).max(initial=0))
    if x.shape[1] * largest * largest < 1 << 63:
        return (gaps * gaps).sum(1)
    return [Decimal(sum(int(g) ** 2 for g in row)) for row in gaps]


def transformed(rows: DataFrame, size: int, model: Model) -> DataFrame:
    """``id, deviation decimal(38,0), whitened array<double>`` of every stored row."""
    n, sums = model.n, model.sums
    turn = model.components / np.sqrt(model.values) if n else model.components
    width = turn.shape[1]

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = from_binary(batch.column(1), size)
            flat = pa.array((centred(x, n, sums) @ turn).reshape(-1))
            places = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            exact = pa.array(deviations(x, n, sums)).cast(pa.decimal128(38, 0))
            white = pa.ListArray.from_arrays(places, flat)
            names = ["id", "deviation", "whitened"]
            yield pa.RecordBatch.from_arrays([batch.column(0), exact, white], names=names)

    kinds = "id bigint, deviation decimal(38,0), whitened array<double>"
    if not n:
        return rows.select("id", F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    return rows.mapInArrow(turned, kinds)


def identity_error(rows: DataFrame, size: int, model: Model) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, over all rows."""
    n, sums, width = model.n, model.sums, len(model.values)
    if not width:
        return 0.0
    turn = model.components / np.sqrt(model.values)
    whole = added_up(rows, size, width, lambda x: (centred(x, n, sums) @ turn).sum(0)[None, :])[0] / n

    def part(x: np.ndarray) -> np.ndarray:
        white = centred(x, n, sums) @ turn - whole
        return white.T @ white

    return float(np.abs(added_up(rows, size, width, part) / n - np.eye(width)).max())


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    size: int | None = None,
) -> tuple[DataFrame, Model, float]:
    """``id, deviation, whitened`` of every usable vector, the model, and the identity's error."""
    kept, size = usable(vectors, id_column, vector_column, size)
    rows = stored(packed(kept, size, SCALE, PLUS), "whole-vectors")
    model = fit(rows, size, components)
    return transformed(rows, size, model), model, identity_error(rows, size, model)


def whitened_components(vectors: DataFrame) -> DataFrame:
    """One row per vector and component, as the query returns them."""
    white, model, error = whiten(vectors)
    shares = F.array(*[F.lit(float(s)) for s in model.explained]).cast("array<double>")
    spread = white.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return spread.select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        F.col("deviation").cast("bigint").alias("deviation"),
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
