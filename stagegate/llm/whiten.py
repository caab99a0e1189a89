"""Whitening of embeddings over their distinct integer vectors.

Vectors become integers, ``floor(256 * entry)``, and equal ones are one *fit vector*
with the number of rows that hold it.  Counts and per-dimension sums are exact integers.
The covariance is a weighted, centred matrix product: a task multiplies the centred
blocks of its fit vectors and adds up d x d numbers; only their sums reach the driver,
which takes the eigenvectors.  Every fit vector is projected once, and the rows get the
result by a join.  A vector that very many rows share is one fit vector, counted before the
shuffle; its rows are spread over sub-keys in that join.

Cases: rows whose vector is NULL or holds a NULL, NaN or infinite entry are dropped; repeated rows stay,
and count once in the fit unless it is weighted.  Vectors of different lengths are populations of their own, each with its own
count, sums and components; an empty vector has no component.  A component along which nothing varies (fewer
distinct vectors than components, say) has a NULL ``whitened``; ``explained`` is NULL where the
trace is 0.  Equal eigenvalues leave axes and order to the solver, the same for all rows.  Other columns are
ignored, whatever their names.  An entry that does not fit a long after scaling fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import skew
from .common import Scratch

_FLAT = 1e-12  # an eigenvalue under this share of the greatest is rounding


@dataclass(frozen=True)
class Axes:
    """What the fit vectors of one length give: total weight, exact sums, and the leading components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a unit eigenvector a column
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace > 0 else None for e in self.values]


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, x array<long>) of the rows whose vector is whole."""
    q = lambda name: F.col("`" + name.replace("`", "``") + "`")
    v = rows.select(q(id_col).alias("id"), F.transform(q(vector_col), lambda c: c.cast("double")).alias("v"))
    broken = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    too_large = F.raise_error(F.lit("an embedding entry does not fit a long")).cast("long")
    x = F.transform("v", lambda c: F.when(F.abs(c * scale) < float(1 << 63), F.floor(c * scale)).otherwise(too_large))
    return v.where(F.col("v").isNotNull() & ~broken).select("id", x.alias("x"))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Each x once, with the number of rows that hold it (``copies``)."""
    return vectors.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, places, matrix) of the batch's vectors of one length; blocks of some megabytes."""
    for b in batches:
        x = b.column("x")
        offsets = x.offsets.to_numpy()
        first, size, flat = offsets[:-1], np.diff(offsets), x.values.to_numpy()
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            step = max(1, (1 << 20) // max(int(d), 1))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                yield b, part, flat[first[part][:, None] + np.arange(d)]


def _weights(b: pa.RecordBatch, at: np.ndarray, weighted: bool) -> np.ndarray:
    return b.column("copies").to_numpy()[at] if weighted else np.ones(len(at), np.int64)


def _exact_sums(distinct: DataFrame, weighted: bool) -> dict[int, list[int]]:
    """Vector length -> [total weight, weighted sum of each dimension], as exact integers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for b, at, x in _blocks(batches):
            w, mine = _weights(b, at, weighted), total.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
            small = not x.size or float(np.abs(x).max()) * float(w.max()) * len(x) < 2.0**62
            products = (x if small else x.astype(object)) * w[:, None]
            for j, s in enumerate((w.sum(), *products.sum(0))):
                mine[j] += int(s)
        for d, mine in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([list(map(str, mine))])], ["d", "part"])

    made = distinct.mapInArrow(task, "d int, part array<string>")
    cells = made.select("d", F.posexplode("part").alias("j", "s")).groupBy("d", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, dict[int, int]] = {}
    for r in cells.collect():  # one number per dimension
        out.setdefault(r["d"], {})[r["j"]] = int(r["s"])
    return {d: [s[j] for j in range(d + 1)] for d, s in out.items()}


def _covariances(distinct: DataFrame, sums: dict[int, list[int]], weighted: bool) -> dict[int, np.ndarray]:
    """Vector length -> covariance matrix, from the centred products of each task's blocks."""
    means = {d: np.array([v / s[0] for v in s[1:]]) for d, s in sums.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b, at, x in _blocks(batches):
            d = x.shape[1]
            y = x - means[d]
            total[d] = total.get(d, 0.0) + y.T @ (y * _weights(b, at, weighted)[:, None])
        for d, c in total.items():
            if d:
                cols = [np.full(d, d, np.int32), np.arange(d, dtype=np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(list(c))], ["d", "i", "part"])

    made = distinct.mapInArrow(task, "d int, i int, part array<double>")
    cells = made.select("d", "i", F.posexplode("part").alias("j", "c")).groupBy("d", "i", "j").agg(F.sum("c").alias("c"))
    out = {d: np.zeros((d, d)) for d in sums}
    for r in cells.groupBy("d", "i").agg(F.collect_list(F.struct("j", "c")).alias("row")).collect():  # d rows of d numbers
        for j, c in r["row"]:
            out[r["d"]][r["i"], j] = c
    return {d: (c + c.T) / (2 * sums[d][0]) for d, c in out.items()}


def fit(distinct: DataFrame, components: int = 4, weighted: bool = False, most_dimensions: int = 4096) -> dict[int, Axes]:
    """The axes of ``distinct_vectors`` for each vector length; a vector weighs one, or its copies.

    The driver holds d x d sums, never vectors; vectors longer than ``most_dimensions`` are refused.
    """
    sums = _exact_sums(distinct, weighted)
    if max(sums, default=0) > most_dimensions:
        raise ValueError(f"vectors of {max(sums)} dimensions; most_dimensions is {most_dimensions}")
    axes = {}
    for d, v in _covariances(distinct, sums, weighted).items():
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        if d:  # of the two signs the one that makes the largest entry positive
            vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
        axes[d] = Axes(sums[d][0], tuple(sums[d][1:]), np.maximum(values, 0.0), vectors, float(np.trace(v)))
    return axes


def project(distinct: DataFrame, axes: dict[int, Axes]) -> DataFrame:
    """(x, copies, deviation, whitened) of each fit vector; ``deviation`` is the exact sum of (n * x - sums)^2."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, at, x in _blocks(batches):
            a = axes[x.shape[1]]
            largest = max([abs(int(v)) * a.n for v in (x.min(), x.max())] + [abs(s) for s in a.sums]) if x.size else 0
            fits = 4 * largest * largest * max(x.shape[1], 1) < 1 << 62
            off = x * a.n - np.array(a.sums, np.int64) if fits else x.astype(object) * a.n - np.array(a.sums, object)
            varies = a.values > _FLAT * (a.values[0] if len(a.values) else 0)
            w = (x - a.mean) @ (a.vectors / np.sqrt(np.where(varies, a.values, 1.0)))
            cells = pa.array(w.ravel(), mask=np.tile(~varies, len(w)))
            whitened = pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], cells)
            cols = [b.column(c).take(pa.array(at)) for c in ("x", "copies")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([str(s) for s in (off * off).sum(1)]), whitened], ["x", "copies", "deviation", "whitened"])

    made = distinct.select("x", "copies").mapInArrow(task, "x array<bigint>, copies bigint, deviation string, whitened array<double>")
    return made.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_errors(projected: DataFrame, components: int = 4, weighted: bool = False) -> dict[int, float | None]:
    """Vector length -> largest distance of the whitened vectors' covariance from the identity; by centred sums."""
    w = F.col("copies") if weighted else F.lit(1)
    cell = [F.get("whitened", F.lit(i)) for i in range(components)]
    by_length = projected.groupBy(F.size("x").alias("d"))
    means = by_length.agg(*[(F.sum(w * c) / F.sum(w)).alias(f"m{i}") for i, c in enumerate(cell)])
    off = projected.withColumn("d", F.size("x")).join(F.broadcast(means), "d")  # one row per vector length
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    products = {(i, j): F.sum(w * (cell[i] - F.col(f"m{i}")) * (cell[j] - F.col(f"m{j}"))) / F.sum(w) for i, j in pairs}
    worst = off.groupBy("d").agg(F.array_max(F.array(*[F.abs(c - float(i == j)) for (i, j), c in products.items()])).alias("error"))
    return {r["d"]: r["error"] for r in worst.collect()}


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256, weighted: bool = False
) -> DataFrame:
    """A row per whole vector: id, n, deviation, whitened and explained (arrays by component), identity_error.

    ``n`` is the fit's total weight: the number of fit vectors, or of rows if ``weighted``.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "whiten")
    vectors = integer_vectors(embeddings, id_col, vector_col, scale)
    distinct = scratch.table(distinct_vectors(vectors))
    axes = fit(distinct, components, weighted)
    projected = scratch.table(project(distinct, axes))
    errors = identity_errors(projected, components, weighted)
    about = spark.createDataFrame(
        [(d, a.n, a.explained, errors.get(d)) for d, a in axes.items()], "d int, n long, explained array<double>, identity_error double"
    )
    rows = skew.salted_stats_join(vectors, projected, ["x"], "copies").withColumn("d", F.size("x"))
    rows = rows.join(F.broadcast(about), "d")  # one row per vector length
    return rows.select(F.col("id").alias(id_col), "n", "deviation", "whitened", "explained", "identity_error")
