"""Vectors as rows of integers, shared by the search and the whitening."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries are held within this range, so that they fit a long whatever is added to them.
MOST = float(1 << 60)


def is_whole(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers. An empty one is whole."""
    infinite = F.lit(float("inf"))

    def broken(entry: Column) -> Column:
        number = entry.cast("double")
        return entry.isNull() | F.isnan(number) | (F.abs(number) == infinite)

    return vector.isNotNull() & ~F.exists(vector, broken)


def integer_entries(vector: Column, scale: int, shift: int = 0) -> Column:
    """``floor(scale * entry) + shift`` of every entry, taken as double; beyond 2**60 it stays there."""

    def whole(entry: Column) -> Column:
        scaled = F.lit(float(scale)) * entry.cast("double")
        return F.floor(F.least(F.greatest(scaled, F.lit(-MOST)), F.lit(MOST))) + F.lit(shift)

    return F.transform(vector, whole)


def widest(rows: DataFrame, vector: str) -> tuple[int, int]:
    """Number of rows and the greatest width among them."""
    found = rows.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("width")).first()
    return found["n"], found["width"] or 0


def padded(vectors: pa.Array, width: int, fill: int = 0) -> np.ndarray:
    """A list column as a matrix of longs; a shorter vector is carried on with ``fill``."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.asarray(vectors.value_lengths()).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width).astype(np.int64, copy=False)
    out = np.full((len(lengths), width), fill, dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def list_column(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    offsets = (np.arange(len(matrix) + 1) * matrix.shape[1]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def moment_matrix(rows: DataFrame, width: int, batch_products) -> np.ndarray:
    """The sum over all rows of a symmetric matrix, ``batch_products`` giving the sum of a batch.

    Each task adds up its own batches and hands on the upper half cell by cell; Spark adds the tasks'
    cells, so the driver gets ``width * (width + 1) / 2`` numbers however many rows there are.
    """
    above = np.triu_indices(width)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            total += batch_products(batch)
        cells = (above[0] * width + above[1]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(total[above])], names=["cell", "amount"]
        )

    parts = rows.mapInArrow(totals, "cell long, amount double")
    out = np.zeros((width, width))
    for row in parts.groupBy("cell").agg(F.sum("amount").alias("amount")).collect():
        i, j = divmod(row["cell"], width)
        out[i, j] = out[j, i] = row["amount"]
    return out
