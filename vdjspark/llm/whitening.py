"""Whitening of embeddings: covariance by polarisation from exact integer sums, then principal components.

Entries are whole numbers x. Around a whole number near each dimension's mean, the squares of every
dimension and of every sum of two dimensions are added up exactly; what the true mean differs from that
number is taken off exactly too. With var(i + j) = var(i) + var(j) + 2 cov(i, j), differences of these
variances give all covariances as fractions, of which each is rounded to double once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjspark.llm.vectors import matrix, usable
from vdjspark.runtime import stage

SCALE, SHIFT = 1024, 100_000
#: Rows of an embedding batch that are worked on at once: bounds a task's memory whatever the batch.
STEP = 1024
DIGITS = "decimal(38,0)"


def whole(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Entries as whole numbers floor(scale * entry) + shift; one that isn't finite is null, one too large for a long raises."""

    def entry(c: Column) -> Column:
        scaled = c.cast("double") * scale
        large = F.when(F.isnan(scaled) | (F.abs(scaled) == float("inf")), None).otherwise(F.raise_error(F.lit("an entry is too large for a long")))
        return F.when(F.abs(scaled) < 2.0**62, F.floor(scaled)).when(scaled.isNotNull(), large) + shift

    return F.transform(vector, entry)


def _safe(y: np.ndarray, rows: int) -> np.ndarray:
    """``y`` where the squares of sums of two entries add up within 63 bits, else as Python integers."""
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    return y if (2 * most) ** 2 * max(rows, 1) < 1 << 63 else y.astype(object)


def square_sums(vectors: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums over rows (x: whole numbers), with y = x - centre: of y_i at (i, -1), of y_i^2 at (i, i), of (y_i + y_j)^2 at (i, j), i < j.

    Each task adds up its own rows; a row of partial sums a task and pair is all that is shuffled.
    """
    d = len(centre)
    at = np.array(centre, dtype=object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1), dtype=object)
        for batch in batches:
            x = matrix(batch, "x", d, np.int64)
            for begin in range(0, len(x), STEP):
                part = x[begin : begin + STEP]
                y = part - at.astype(np.int64) if np.abs(part).max(initial=0) < 1 << 62 else part.astype(object) - at
                y = _safe(y, len(y))
                total[:, d] += y.sum(axis=0).astype(object)
                for i in range(d):
                    both = y[:, i:] + y[:, i : i + 1]
                    both[:, 0] = y[:, i]
                    total[i, i:d] += (both * both).sum(axis=0).astype(object)
        i, j = np.triu_indices(d, 0, d + 1)
        j_ = np.where(j == d, -1, j)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j_, pa.int32()), "s": pa.array([str(total[a, b]) for a, b in zip(i, j, strict=True)])})

    sums = vectors.select("x").mapInArrow(work, "i int, j int, s string").groupBy("i", "j").agg(F.sum(F.col("s").cast(DIGITS)).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in sums.collect()}  # a number for each pair of dimensions


@dataclass(frozen=True)
class Fit:
    """What whitening needs of the fit list: number of vectors, sums by dimension, falling eigenvalues and their vectors in columns."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def usable(self) -> int:
        """Components whose variance is more than rounding."""
        return int((self.values > self.values.max(initial=0) * len(self.values) * np.finfo(float).eps).sum())


def covariance(sums: dict[tuple[int, int], int], n: int, d: int) -> list[list[Fraction]]:
    """Covariances (divisor n) from square_sums(), as exact fractions."""

    def variance(squares: int, plain: int) -> int:  # n^2 times it
        return n * squares - plain * plain

    one = [variance(sums[i, i], sums[i, -1]) for i in range(d)]
    out = [[Fraction(0)] * d for _ in range(d)]
    for i in range(d):
        out[i][i] = Fraction(one[i], n * n)
        for j in range(i + 1, d):
            both = variance(sums[i, j], sums[i, -1] + sums[j, -1])
            out[i][j] = out[j][i] = Fraction(both - one[i] - one[j], 2 * n * n)
    return out


def fit(vectors: DataFrame) -> Fit:
    """Fit to all rows (x: whole numbers, all of one length). The driver gets d sums and d * (d + 1) / 2 square sums of d dimensions."""
    firsts = vectors.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum(F.col("c").cast(DIGITS)).alias("s"), F.count("*").alias("n")).collect()
    if not firsts:
        return Fit(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    n, d = firsts[0]["n"], len(firsts)
    plain = [s for _, s in sorted((r["i"], int(r["s"])) for r in firsts)]
    exact = covariance(square_sums(vectors, [s // n for s in plain]), n, d)
    values, components = np.linalg.eigh(np.array([[float(c) for c in row] for row in exact]))
    trace = float(sum(exact[i][i] for i in range(d)))
    return Fit(n, plain, trace, np.maximum(values[::-1], 0.0), components[:, ::-1])


def project(vectors: DataFrame, key: str, fitted: Fit, most: int = 8) -> DataFrame:
    """Rows (key, x) -> key, deviation (exact), whitened (list of up to ``most`` numbers).

    A component without variance has no whitened number (null). A deviation beyond a long raises.
    """
    n, d, k = fitted.n, len(fitted.sums), min(most, len(fitted.sums))
    centre = np.array([s // n for s in fitted.sums], np.int64)
    rest = np.array([s % n for s in fitted.sums], dtype=object)
    live = min(k, fitted.usable)
    basis = fitted.vectors[:, :live] / np.sqrt(fitted.values[:live])
    off = np.array([float(Fraction(int(r), n)) for r in rest])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = matrix(batch, "x", d, np.int64) - centre
            most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))) + 1
            wide = y if (most * n) ** 2 * d < 1 << 63 else y.astype(object)
            z = wide * n - (rest if wide.dtype == object else rest.astype(np.int64))
            deviation = pa.array((z * z).sum(axis=1).tolist(), pa.int64())
            made = np.full((len(y), k), np.nan)
            # dimensions are added up one by one, so that equal rows get equal numbers
            made[:, :live] = 0.0
            for i in range(d):
                made[:, :live] += (y[:, i] - off[i])[:, None] * basis[i]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, k * (len(y) + 1), k), pa.int32()) if k else pa.array([0] * (len(y) + 1), pa.int32()), pa.array(made.ravel(), from_pandas=True))
            yield pa.RecordBatch.from_pydict({key: batch.column(key), "deviation": deviation, "whitened": lists})

    return vectors.select(key, "x").mapInArrow(work, f"{key} long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, k: int) -> float | None:
    """Largest absolute entry of the covariance of ``whitened`` (lists of k numbers), less the identity; None without rows or numbers."""
    w = [F.get("whitened", i) for i in range(k)]
    entries = [F.abs(F.covar_pop(w[i], w[j]) - float(i == j)) for i in range(k) for j in range(i, k)]
    return whitened.agg(F.greatest(*entries, F.lit(None).cast("double")).alias("e")).head()[0] if entries else None


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 8) -> DataFrame:
    """Rows (key, vector) -> key, component (from 1), n, deviation, whitened, explained, identity_error, for each of the first ``most`` components.

    Vectors that are null, empty, or hold a null or a number that isn't finite are dropped; so are, where
    lengths differ, vectors of another length than the most frequent (of equals the longest). All others
    are the fit list; equal rows count each. A null key stays. A component without variance has null
    ``whitened``, and without any variance ``explained`` is null. An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    spark = rows.sparkSession
    good, d = usable(rows, key, vector)
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return spark.createDataFrame([], schema)
    vectors = good.select(key, whole(F.col("v")).alias("x"))
    fitted = fit(vectors)
    made = stage(project(vectors, key, fitted, most), "whitened")
    error = identity_error(made, min(most, fitted.usable))
    explained = F.array(*[F.lit(float(e / fitted.trace) if fitted.trace else None).cast("double") for e in fitted.values[:most]])
    each = made.select(key, "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return each.select(key, (F.col("i") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("i")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
