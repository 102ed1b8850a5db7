"""Whitened principal components of embeddings; the covariance is found from variances alone, by polarisation.

An entry c becomes the whole number floor(1024 c) + 100000. For every dimension i and every sum of two dimensions i + j
the tasks add up exact squares of whole numbers that are centred first: u = x - floor(mean), whose sum is the remainder r
of the mean's division, so that the squared deviations (u - r / n)^2 add up to sum(u^2) - r^2 / n without an error. Then
cov(i, j) = (var(i + j) - var(i) - var(j)) / 2, with exact numerators, and `eigh` of that matrix gives the components.

Only sums leave a task: one row for each dimension or pair, however many vectors it read. The matrix and the components
are as large as the dimension's square and are the only things that reach the driver or are sent to the tasks.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped; of vectors of different
lengths those of the commonest length count (the longest of equally common ones) and the rest are dropped too; entries beyond
2^50 / 1024 are taken as that bound; null ids and repeated rows stay; a component without variance has null `whitened` and
no part in `identity_error`; a `deviation` beyond 64 bits is null; an empty table gives no rows. Columns other than the id
and the vector are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from tickloom.llm.common import parts

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries are whole numbers below this in size, so that they and their pair sums are exact doubles too.
_LARGEST = float(1 << 50)
#: A component whose share of the whole variance is below this has none.
NO_VARIANCE = 1e-13
#: Squares of pair sums of numbers below this, 2048 at a time, add up within 64 bits.
_SMALL = 1 << 20


@dataclass(frozen=True)
class Model:
    n: int
    sums: list[int]
    #: Rows are components: unit eigenvectors by falling eigenvalue.
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def floor_mean(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def remainder(self) -> list[int]:
        return [s % self.n for s in self.sums]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(row, component); NaN where a component has no variance."""
        centred = (x - self.floor_mean) - np.array(self.remainder, np.float64) / self.n
        some = self.values > NO_VARIANCE * self.trace
        return np.where(some, centred @ self.axes.T / np.sqrt(np.where(some, self.values, 1.0)), np.nan)


def _usable(table: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that count, and their dimension."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    clean = table.select(vec_id, F.col(vector).cast("array<double>").alias(vector)).where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    common = clean.groupBy(F.size(vector).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    dimension = int(common["length"]) if common else 0
    return clean.where(F.size(vector) == dimension), dimension


def whole(column: pa.Array, dimension: int) -> np.ndarray:
    """(row, dimension) of the entries as whole numbers."""
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    return np.clip(np.floor(SCALE * entries) + SHIFT, -_LARGEST, _LARGEST).astype(np.int64)


def _summed(table: DataFrame, vector: str, dimension: int, size: int, add) -> list[int]:
    """`size` exact sums over all rows of what `add` makes of a batch of whole vectors (a list of Python integers)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * size
        for batch in (p for b in batches for p in parts(b)):
            if batch.num_rows:
                total = [a + b for a, b in zip(total, add(whole(batch.column(0), dimension)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([str(t) for t in total])], names=["at", "part"])

    # Partial sums come as text: a task's may already be wider than 64 bits.
    rows = table.select(vector).mapInArrow(over, "at int, part string").groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = [0] * size
    for row in rows.collect():
        out[row["at"]] = int(row["total"])
    return out


def _squares(u: np.ndarray) -> list[int]:
    """Sums of squares of every dimension, then of every sum of two dimensions i < j."""
    if np.abs(u).max(initial=0) >= _SMALL:
        u = u.astype(object)
    out = (u * u).sum(0).tolist()
    for i in range(u.shape[1] - 1):
        both = u[:, i : i + 1] + u[:, i + 1 :]
        out += (both * both).sum(0).tolist()
    return out


def covariance(n: int, remainder: list[int], squares: list[int]) -> np.ndarray:
    """From sums of squares of u and of u_i + u_j (in the order of `_squares`), where the sum of u is the remainder."""
    d = len(remainder)
    own = [n * s - r * r for s, r in zip(squares[:d], remainder, strict=True)]
    out = np.zeros((d, d))
    at = d
    for i in range(d):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, d):
            both = n * squares[at] - (remainder[i] + remainder[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n * n)
            at += 1
    return out


def fit(table: DataFrame, vector: str = "embedding", dimension: int = 0, components: int = COMPONENTS) -> Model:
    """Components of all rows of `table`, whose vectors have `dimension` finite entries each."""
    # A batch's sums are below 2^50 times its 2048 rows, hence within 64 bits.
    *sums, n = _summed(table, vector, dimension, dimension + 1, lambda x: [*x.sum(0).tolist(), len(x)])
    if not n:
        return Model(0, sums, np.zeros((0, dimension)), np.zeros(0), 0.0)
    floor_mean = np.array([s // n for s in sums], np.int64)
    remainder = [s % n for s in sums]
    pairs = dimension * (dimension - 1) // 2
    squares = _summed(table, vector, dimension, dimension + pairs, lambda x: _squares(x - floor_mean))
    matrix = covariance(n, remainder, squares)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    return Model(n, sums, vectors[:, order].T.copy(), values[order], float(np.trace(matrix)))


def identity_error(table: DataFrame, model: Model, vector: str, dimension: int) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, from a pass over all of them."""
    k = len(model.values)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in (p for b in batches for p in parts(b)):
            w = np.nan_to_num(model.whitened(whole(batch.column(0), dimension)))
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "part"])

    rows = table.select(vector).mapInArrow(over, "at int, part double").groupBy("at").agg(F.sum("part").alias("total"))
    total = np.zeros((k + 1) * k)
    for row in rows.collect():
        total[row["at"]] = row["total"]
    total = total.reshape(k + 1, k) / model.n
    some = model.values > NO_VARIANCE * model.trace
    off = np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k))[np.ix_(some, some)]
    return float(off.max()) if off.size else 0.0


def _deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2 of each row, exact; null beyond 64 bits."""
    u = x - model.floor_mean
    largest = (int(np.abs(u).max(initial=0)) + 1) * model.n
    if largest * largest * u.shape[1] < 1 << 62:
        y = u * model.n - np.array(model.remainder, np.int64)
        return [int(v) for v in (y * y).sum(1)]
    y = u.astype(object) * model.n - np.array(model.remainder, object)
    return [int(v) if v < 1 << 63 else None for v in (y * y).sum(1)]


def report(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The registered query's rows: each vector's whitened components with the fit's figures."""
    rows, dimension = _usable(table, vec_id, vector)
    model = fit(rows, vector, dimension, components)
    error = identity_error(rows, model, vector, dimension) if model.n else 0.0
    k = len(model.values)
    explained = model.values / model.trace if model.trace else np.zeros(k)
    id_type = table.schema[vec_id].dataType
    out = StructType([StructField(vec_id, id_type), StructField("component", IntegerType())])
    for name, kind in (("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        out = out.add(name, kind)
    arrow_id = to_arrow_type(id_type)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in parts(b)):
            if not batch.num_rows or not k:
                continue
            x = whole(batch.column(1), dimension)
            again = pa.array(np.repeat(np.arange(len(x)), k))
            number = np.tile(np.arange(k), len(x))
            columns = [
                batch.column(0).take(again).cast(arrow_id), pa.array((number + 1).astype(np.int32)), pa.array(np.full(len(number), model.n, np.int64)),
                pa.array(_deviations(x, model), pa.int64()).take(again), pa.array(model.whitened(x).ravel(), from_pandas=True),
                pa.array(explained[number]), pa.array(np.full(len(number), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return rows.mapInArrow(over, out)
