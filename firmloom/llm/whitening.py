"""Whitening of embeddings: components of the covariance of scaled integer vectors.

Entries become integers, so that counts, sums and products are exact: one pass adds up the
vectors, a second the products of what is left after the integer next to the mean is taken off.
Tasks add up their own rows and hand on one row for each pair of dimensions; the covariance, as
wide as a vector, is all that reaches the driver. Its largest eigenpairs come from contour
integration (`feast`). A third pass projects the rows and adds up the products of the results,
which tells how far their covariance is from the identity; a fourth gives the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.llm.feast import top_eigenpairs

#: Larger scaled entries are not whole numbers of a double any more.
MOST = 1 << 52
#: Rows worked on at a time.
STEP = 4096


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, vec array<double>): the rows whose vector has entries, all of them finite numbers."""
    vec = F.col(vec_col).cast("array<double>")
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.coalesce(sound, F.lit(False)) & (F.size("vec") > 0)
    )


def _scaled(column: pa.Array, scale: float, shift: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a column of vectors as (first row, integer matrix)."""
    for at in range(0, len(column), STEP):
        part = column.slice(at, STEP)
        rows = np.floor(part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1) * scale)
        if np.abs(rows).max(initial=0) > MOST:
            raise ValueError("scaled entries above 2 ** 52")
        yield at, rows.astype(np.int64) + shift


@dataclass(frozen=True)
class Whitening:
    """What is fitted to the vectors: everything as wide as a vector."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: float
    shift: int

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows. The integer next to the mean goes first, so the
        difference is exact; what is left of the mean is below one."""
        near = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([float(Fraction(s, self.n) - s // self.n) for s in self.sums])
        return ((rows - near).astype(np.float64) - rest) @ (self.components / np.sqrt(self.values))


def _exact_product(y: np.ndarray) -> np.ndarray:
    """y' y of integers, exact: in doubles where all sums fit, else in Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    y = y.astype(object)
    return y.T @ y


def fit(vectors: DataFrame, k: int = 8, scale: float = 1024.0, shift: int = 100_000, tiny: float = 1e-13) -> Whitening | None:
    """Sums, covariance and the `k` first components of `vectors` (vec_id, vec); None without rows.

    Entry c counts as floor(scale * c) + shift. Components whose eigenvalue is below `tiny` of the
    trace are rounding (constant or dependent dimensions) and left out, so there may be fewer.
    Vectors of different lengths raise an error, as do entries above 2 ** 52 after scaling.
    """
    shape = vectors.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b")).first()
    if not shape["n"]:
        return None
    n, width = shape["n"], shape["b"]
    if shape["a"] != width:
        raise ValueError(f"vectors of {shape['a']} to {width} entries")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            for _, rows in _scaled(batch.column(0), scale, shift):
                part = rows.sum(axis=0) if len(rows) * int(np.abs(rows).max()) < 1 << 62 else rows.astype(object).sum(axis=0)
                total = [a + int(b) for a, b in zip(total, part)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["i", "v"]
        )

    narrow = vectors.select("vec")
    found = narrow.mapInArrow(sums, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = tuple(int(r["v"]) for r in sorted(found))
    near = np.array([s // n for s in total], dtype=np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((width, width), dtype=object)
        for batch in batches:
            for _, rows in _scaled(batch.column(0), scale, shift):
                held += _exact_product(rows - near)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(v) for v in held[i, j]], pa.decimal128(38, 0))],
            names=["i", "j", "v"],
        )

    cells = narrow.mapInArrow(products, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    # what is left of the mean, below one a dimension, is taken off the products exactly
    left = [s - n * int(c) for s, c in zip(total, near)]
    matrix = np.zeros((width, width))
    for i, j, v in zip(*(cells.column(c).to_pylist() for c in ("i", "j", "v"))):
        matrix[i, j] = matrix[j, i] = float(Fraction(int(v) * n - left[i] * left[j], n * n))
    trace = float(np.trace(matrix))
    values, components = top_eigenpairs(matrix, k, tiny * trace)
    return Whitening(n, total, values, components, trace, scale, shift)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity; 0.0 without components."""
    k = len(model.values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for _, rows in _scaled(batch.column(0), model.scale, model.shift):
                done = model.project(rows)
                held += done.T @ done
                total += done.sum(axis=0)
        table = np.column_stack([total, held])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), k + 1), pa.int32()), pa.array(np.tile(np.arange(k + 1), k), pa.int32()),
             pa.array(table.ravel())], names=["i", "j", "v"],
        )

    cells = vectors.select("vec").mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    table = np.zeros((k, k + 1))
    for i, j, v in cells:
        table[i, j] = v
    mean = table[:, 0] / model.n
    return float(np.abs(table[:, 1:] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation decimal(38,0), whitened array<double>) for every row.

    `deviation` is the sum over dimensions of (n * x - S) ** 2, exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = model.n, np.array(model.sums, dtype=object)
        fits = max(map(abs, model.sums)) < 1 << 62
        for batch in batches:
            far, out = [], []
            for _, rows in _scaled(batch.column(1), model.scale, model.shift):
                most = int(np.abs(rows).max(initial=0))
                if fits and n * most < 1 << 62:
                    off = n * rows - sums.astype(np.int64)
                else:
                    off = n * rows.astype(object) - sums
                largest = max(int(off.max(initial=0)), -int(off.min(initial=0)))
                if largest * largest * off.shape[1] >= 1 << 63:
                    off = off.astype(object)
                far += [int(v) for v in (off * off).sum(axis=1)]
                out += model.project(rows).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(far, pa.decimal128(38, 0)), pa.array(out, pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"],
            )

    return vectors.select("vec_id", "vec").mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def whiten(df: DataFrame, k: int = 8, scale: float = 1024.0, shift: int = 100_000, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component from 1, n, deviation, whitened, explained, identity_error): one row for
    each usable vector (repeated ones each) and component.

    Rows with a null vector or entry, an entry that is no finite number, or no entry at all are
    left out; a null id stays as it is. Other columns are left out. Without usable rows, or where
    all rows are equal, there are no components and no rows.
    """
    vectors = usable_vectors(df, id_col, vec_col)
    model = fit(vectors, k, scale, shift)
    if model is None:
        layout = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], layout)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    error = identity_error(vectors, model)
    return apply(vectors, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
