"""Operator 11: whitening of embeddings, with a covariance recovered by polarisation.

Entries become whole numbers ``x = floor(1024 * c) + 100000``. Spark tasks sum them, and then
the squares of the centred values of every dimension and of every sum of two dimensions; all
of it in whole numbers, so neither the order of the rows nor a repeated task changes a bit.
``(Var(a + b) - Var(a) - Var(b)) / 2`` gives every covariance, ``eigh`` the components. What
reaches the driver has as many numbers as the covariance matrix, whatever the number of rows.

The mean ``S / n`` is not whole. Values are centred at its floor ``q``; with the remainder
``r = S - n * q`` the squares about the mean itself are ``sum((x - q) ** 2) - r * r / n``.

Defined cases: rows with a NULL vector or a NULL or non-finite entry are dropped, and so are
entries too large for 62 bits and vectors of another length than the commonest (the longer of
two equally common); a NULL key keeps its row; repeated rows count and come back each; a component without variance
has NULL ``whitened`` and takes no part in ``identity_error``; ``deviation`` is NULL where it
does not fit a long and ``deviation_exact`` holds it; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMB, LIMBS = 42, 4  # exact sums travel as four long columns of 42 bits each, the last one signed
ROWS = 4096  # rows a task holds at once


@dataclasses.dataclass
class Whitening:
    """A fit: ``n`` vectors with per-dimension sums ``total``, eigenvalues falling, one component a column."""

    n: int
    total: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace > 0 else np.zeros(len(self.eigenvalues))

    def varying(self) -> np.ndarray:
        """Which components have a variance beyond the rounding of the largest."""
        e = self.eigenvalues
        return e > 16 * len(self.total) * np.finfo(float).eps * max(e.max(initial=0.0), 0.0)


def usable(vector: str) -> Column:
    """Whether a vector has entries, and only finite ones that fit."""
    small = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < 2.0 ** 62)
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, small)


def integers(column: pa.Array, d: int) -> np.ndarray:
    """The whole numbers of a batch of vectors of ``d`` entries, one row each."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.floor(c * SCALE).astype(np.int64) + SHIFT


def _limbs(value: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        value, low = divmod(value, 1 << LIMB)
        out.append(low)
    return [*out, value]


def _summed(rows: DataFrame, task) -> dict[tuple[int, int], int]:
    """Exact sums per (i, j) of what ``task`` returns for each partition as an object array."""
    def limbs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = task(b.column(0).slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS))
        if found:
            table = np.array([[i, j, *_limbs(v)] for (i, j), v in found.items()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T], names)

    names = ["i", "j", *[f"l{k}" for k in range(LIMBS)]]
    parts = rows.mapInArrow(limbs, ", ".join(f"{c} long" for c in names))
    sums = parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])
    return {(r["i"], r["j"]): sum(r[f"l{k}"] << LIMB * k for k in range(LIMBS)) for r in sums.collect()}


def _totals(columns: Iterable[pa.Array], d: int) -> dict[tuple[int, int], int]:
    out = None
    for c in columns:
        x = integers(c, d)
        high, low = x >> 31, x & (1 << 31) - 1  # the halves of at most ROWS rows cannot overflow
        part = high.sum(axis=0).astype(object) * (1 << 31) + low.sum(axis=0).astype(object)
        out = part if out is None else out + part
    return {} if out is None else {(i, i): int(v) for i, v in enumerate(out)}


def _squares(columns: Iterable[pa.Array], center: list[int]) -> dict[tuple[int, int], int]:
    """Sums of the squared centred values of dimension i at (i, i), of dimensions i + j at (i, j)."""
    d = len(center)
    out = None
    for c in columns:
        x = integers(c, d)
        y = np.ascontiguousarray((x.astype(object) - np.array(center, object)).T)
        top = int(abs(y).max())
        y = y.astype(np.int64) if 4 * top * top * len(x) < 1 << 63 else y
        part = []
        for i in range(d):
            z = y[i:] + y[i]
            z[0] = y[i]
            part.append((z * z).sum(axis=1).astype(object))
        part = np.concatenate(part)
        out = part if out is None else out + part
    pairs = ((i, j) for i in range(d) for j in range(i, d))
    return {} if out is None else {p: int(v) for p, v in zip(pairs, out)}


def covariance(n: int, total: list[int], squares: dict[tuple[int, int], int]) -> list[list[Fraction]]:
    """Exact covariances (divisor n) from the squared centred sums, by polarisation."""
    d = len(total)
    rest = [s % n for s in total]
    variance = {}
    for (i, j), q in squares.items():
        r = rest[i] if i == j else rest[i] + rest[j]
        variance[i, j] = Fraction(n * q - r * r, n * n)
    out = [[variance[i, i]] * d for i in range(d)]
    for i in range(d):
        for j in range(i + 1, d):
            out[i][j] = out[j][i] = (variance[i, j] - variance[i, i] - variance[j, j]) / 2
    for i in range(d):
        out[i][i] = variance[i, i]
    return out


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Mean and leading components of all usable vectors; None when there are none."""
    rows = vectors.where(usable(vector)).select(F.col(vector).alias("v"))
    commonest = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if commonest is None:
        return None
    d, n = commonest["d"], commonest["n"]
    rows = rows.where(F.size("v") == d)
    sums = _summed(rows, lambda columns: _totals(columns, d))
    total = [sums[i, i] for i in range(d)]
    center = [s // n for s in total]
    exact = covariance(n, total, _summed(rows, lambda columns: _squares(columns, center)))
    values, basis = np.linalg.eigh(np.array([[float(v) for v in row] for row in exact]))
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    sign = np.sign(basis[abs(basis).argmax(axis=0), np.arange(basis.shape[1])])  # the largest entry is positive
    return Whitening(n, total, np.maximum(values, 0.0), basis * sign, float(sum(exact[i][i] for i in range(d))))


def project(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, large, whitened) of every usable vector: ``large`` is the deviation as text where it does not
    fit a long, ``whitened`` an array over the components."""
    d, n = len(model.total), model.n
    center, rest = [s // n for s in model.total], [s % n for s in model.total]
    varying = model.varying()
    scaled = model.components / np.sqrt(np.where(varying, model.eigenvalues, 1.0))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                y = integers(b.column(1), d).astype(object) - np.array(center, object)
                top = int(abs(y).max(initial=0)) * n + n
                y = y.astype(np.int64) if d * top * top < 1 << 63 else y
                w = y * n - np.array(rest, dtype=y.dtype)
                far = (w * w).sum(axis=1)
                fits = [v if v < 1 << 63 else None for v in far.tolist()]
                values = (y.astype(np.float64) - np.array(rest, np.float64) / n) @ scaled
                found = pa.array([[v if ok else None for v, ok in zip(row, varying)] for row in values.tolist()], pa.list_(pa.float64()))
                large = [None if f is not None else str(v) for f, v in zip(fits, far.tolist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fits, pa.int64()), pa.array(large, pa.string()), found], names)

    names = [key, "deviation", "large", "whitened"]
    rows = vectors.where(usable(vector)).where(F.size(vector) == d).select(key, vector)
    schema = T.StructType([rows.schema[key], T.StructField("deviation", T.LongType()), T.StructField("large", T.StringType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(task, schema)


def identity_error(projected: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    use = [int(k) for k in np.flatnonzero(model.varying())]
    w = lambda k: F.get("whitened", F.lit(k))
    entries = [F.abs(F.covar_pop(w(a), w(b)) - (1.0 if a == b else 0.0)) for a in use for b in use if a <= b]
    if not entries:
        return 0.0
    return projected.select(F.greatest(*entries, F.lit(0.0))).first()[0]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error, deviation_exact) for every usable row and component."""
    model = fit(vectors, vector, components)
    if model is None:
        return vectors.limit(0).select(
            key, F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")], F.lit(0).cast("decimal(38,0)").alias("deviation_exact"))
    rows = materialize(project(vectors, model, key, vector), "whitened")
    error = identity_error(rows, model)
    explained = F.array(*[F.lit(float(e)) for e in model.explained()])
    out = rows.select(key, "deviation", "large", F.posexplode("whitened").alias("place", "value"))
    return out.select(
        key, (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", F.col("value").alias("whitened"),
        F.get(explained, "place").alias("explained"), F.lit(float(error)).alias("identity_error"),
        F.coalesce(F.col("deviation").cast("decimal(38,0)"), F.col("large").cast("decimal(38,0)")).alias("deviation_exact"))
