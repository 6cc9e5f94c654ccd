"""Whitening of embeddings by polarisation: covariances from variances of dimensions and of sums of two dimensions.

Each component c counts as the whole number x = floor(256 c). The fit list is each distinct x vector once. With n of them
and sums S, the centred values n x - S are whole numbers, so the sums of their squares, for every dimension and for every
sum of two, are exact; cov(a, b) = (var(a + b) - var(a) - var(b)) / 2. What a task sends on is one row a dimension pair.

Rows whose vector is null, or holds null or numbers that are not finite, are dropped; so are vectors of another length
than the most frequent one (of equally frequent ones, the shorter). Values beyond 64 bits count as the nearest that fits.
Repeated rows count once in the fit and are all whitened; an empty table gives no rows. A component whose variance is zero
(to rounding) can't be whitened: its values are null. Columns of the input named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import free_names, materialize
from .textbatch import give_back_memory
from .vectors import is_finite, matrix

SCALE = 256
#: Whole numbers of any size pass through sums as high * 2^64 + low.
LOW_BITS = 64
WIDE = T.DecimalType(38, 0)
RESULTS = ("deviation", "whitened")


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: bounded by the dimension, not by the rows."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues of the first components
    axes: np.ndarray  # unit eigenvectors, one a column
    explained: tuple[float | None, ...]
    identity_error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: in 64 bits where that is sure, as Python integers else."""
        return centred(x, self.n, self.sums)

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of centred rows; not a number where a component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (y.astype(np.float64) / self.n) @ self.axes / np.sqrt(self.values), np.nan)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    most = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0), *sums)), default=0)
    wide = n * most * 2 >= 1 << 61
    return (x.astype(object) if wide else x) * n - np.array(sums, dtype=object if wide else np.int64)


def square_sums(z: np.ndarray, axis: int) -> list[int]:
    """Exact sums of squares along an axis. Numbers of up to 42 bits are squared in two halves, longer ones as Python integers."""
    if z.dtype == object or max(abs(int(z.min(initial=0))), abs(int(z.max(initial=0)))) >= 1 << 42:
        return [int(v) for v in (z.astype(object) ** 2).sum(axis=axis)]
    high, low = z >> 21, z & (1 << 21) - 1
    parts = ((high * high).sum(axis=axis), (high * low).sum(axis=axis), (low * low).sum(axis=axis))
    return [(int(a) << 42) + (int(b) << 22) + int(c) for a, b, c in zip(*parts)]


def split(total: int) -> tuple[Decimal, Decimal]:
    return Decimal(total >> LOW_BITS), Decimal(total & (1 << LOW_BITS) - 1)


TOTALS = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("high", WIDE), T.StructField("low", WIDE)])


def totals(fit: DataFrame, width: int, of_batch) -> dict[tuple[int, int], int]:
    """Exact totals by (a, b) of what ``of_batch`` gives for each batch's matrix; one row a task and key is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], int] = {}
        for batch in batches:
            for key, value in of_batch(matrix(batch.column("x"), pa.int64(), width)):
                found[key] = found.get(key, 0) + value
            give_back_memory()
        if found:
            halves = [split(v) for v in found.values()]
            sides = [pa.array([k[i] for k in found], pa.int32()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*sides, *(pa.array([h[i] for h in halves], pa.decimal128(38, 0)) for i in (0, 1))], names=TOTALS.names)

    rows = fit.mapInArrow(run, TOTALS).groupBy("a", "b").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # by dimensions, not rows
    return {(r["a"], r["b"]): (int(r["high"]) << LOW_BITS) + int(r["low"]) for r in rows}


def plain_sums(x: np.ndarray) -> Iterator[tuple[tuple[int, int], int]]:
    wide = len(x) * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) >= 1 << 62
    for d, total in enumerate((x.astype(object) if wide else x).sum(axis=0)):
        yield (d, d), int(total)
    yield (-1, -1), len(x)


def polarised(n: int, sums: tuple[int, ...]):
    """Sums of squared centred values: key (a, a) for a dimension, (a, b) for the sum of two."""

    def of_batch(x: np.ndarray) -> Iterator[tuple[tuple[int, int], int]]:
        y = centred(x, n, sums)
        yield from (((a, a), v) for a, v in enumerate(square_sums(y, 0)))
        for a in range(len(sums) - 1):
            pairs = square_sums(y[:, a : a + 1] + y[:, a + 1 :], 0)
            yield from (((a, b), v) for b, v in enumerate(pairs, a + 1))

    return of_batch


def quantised(rows: DataFrame, vector: str, kept: list[str], name: str = "x") -> DataFrame:
    """``kept`` columns and the whole numbers (as ``name``) of the rows that have a sound vector."""
    sound = rows.where(is_finite(F.col(vector)))
    return sound.select(*kept, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(0).cast("bigint")).alias(name))


def fit(rows: DataFrame, vector: str = "embedding", components: int = 4) -> Whitening | None:
    """Fit on the distinct quantised vectors of all rows; None where there is none."""
    x = quantised(rows, f"`{vector}`", [])
    common = x.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return None
    width = common["size"]
    listed = materialize(x.where(F.size("x") == width).distinct(), "fit")
    found = totals(listed, width, plain_sums)
    n = found.pop((-1, -1))
    sums = tuple(found[d, d] for d in range(width))
    if not width:
        return Whitening(n, (), np.zeros(0), np.zeros((0, 0)), (), None)
    squares = totals(listed, width, polarised(n, sums))
    variance = np.zeros((width, width))
    for (a, b), total in squares.items():
        if a == b:
            variance[a, a] = total / n**3
        else:
            variance[a, b] = variance[b, a] = (total - squares[a, a] - squares[b, b]) / (2 * n**3)
    values, axes = np.linalg.eigh(variance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    values = np.where(values > width * np.finfo(float).eps * max(values[0], 0.0), values, 0.0)
    trace = float(np.trace(variance))
    model = Whitening(n, sums, values, axes, tuple(float(v) / trace if trace > 0 else None for v in values), None)
    return Whitening(n, sums, values, axes, model.explained, identity_error(listed, model))


def identity_error(listed: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity; null without components."""
    live, width = np.flatnonzero(model.values > 0), len(model.sums)
    if not len(live):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live) + 1, len(live)))
        for batch in batches:
            w = model.project(model.centred(matrix(batch.column("x"), pa.int64(), width)))[:, live]
            total[:-1] += w.T @ w
            total[-1] += w.sum(axis=0)
            give_back_memory()
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "total"])

    rows = listed.mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()  # by components
    total = np.zeros((len(live) + 1) * len(live))
    total[[r["at"] for r in rows]] = [r["total"] for r in rows]
    total = total.reshape(len(live) + 1, len(live)) / model.n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(live))).max())


def whiten(rows: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """The rows with a sound vector of the model's length, with ``deviation`` (sum over dimensions of (n x - S)^2, exact, null
    beyond 38 digits) and ``whitened`` (one value a component)."""
    kept = [f"`{c}`" for c in rows.columns if c.lower() not in RESULTS]
    if not kept or model is None:
        return rows.select(*kept, F.lit(None).cast(WIDE).alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")).limit(0)
    (own,) = free_names(rows.columns, "x")
    sound = quantised(rows, f"`{vector}`", kept, own).where(F.size(own) == len(model.sums))
    schema = T.StructType([*(f for f in sound.schema.fields if f.name != own), T.StructField("deviation", WIDE), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    exact = Context(prec=38)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(own)
            y = model.centred(matrix(batch.column(at), pa.int64(), len(model.sums)))
            w = model.project(y)
            spread = [exact.create_decimal(v) if v < 10**38 else None for v in square_sums(y, 1)]
            offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            white = pa.ListArray.from_arrays(offsets, pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel())))
            others = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(spread, pa.decimal128(38, 0)), white], names=schema.names)
            give_back_memory()

    return sound.mapInArrow(run, schema)


def component_rows(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per remaining row and component: key, component, n, deviation, whitened, explained, identity_error."""
    done = whiten(rows.select(F.col(f"`{key}`"), F.col(f"`{vector}`")), model, vector)
    explained = F.array(*(F.lit(v).cast("double") for v in model.explained)) if model and model.explained else F.array().cast("array<double>")
    each = done.select(F.col(f"`{key}`"), F.col("deviation"), F.posexplode("whitened").alias("at", "white"))
    return each.select(
        F.col(f"`{key}`"),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else None).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),  # null where 64 bits don't hold it; whiten() has it exact
        F.col("white").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )
