"""Cells of vectors around centres, and vectors as bytes, which shuffles and tables hold without a copy of each number."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors that centres are fitted on, at most; those of smallest hash.
SAMPLE = 20_000
#: Vectors in a cell that are wished for, and centres at most.
CELL, CENTRES = 1000, 1024
#: Rows and columns of a matrix product, which bound a task's memory beside its vectors.
ROWS, COLUMNS = 1024, 1024


def doubles(column: str) -> Column:
    return F.col(column).cast("array<double>")


def usable(column: str) -> Column:
    """True for arrays of finite numbers without nulls; never null."""
    finite = F.forall(doubles(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & (F.size(column) > 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """Rows of an array column, all of one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def packed(column: pa.Array, kind=None) -> pa.Array:
    """The numbers of each row of an array column as bytes, of its own type or another; nulls stay."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    numbers = column.flatten().to_numpy(zero_copy_only=False)
    numbers = np.ascontiguousarray(numbers, kind or numbers.dtype)
    ends = np.concatenate([[0], np.cumsum(sizes)]) * numbers.itemsize
    rows = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(numbers)])
    return pc.if_else(column.is_valid(), rows, None).cast(pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, kind) -> np.ndarray:
    """Rows that `packed` made, all of one length and without nulls, as a matrix."""
    if not len(column):
        return np.zeros((0, 0), kind)
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for c in chunks:
        if len(c):
            ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(c), -1))
    return np.concatenate(parts).view(kind)


def places(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`nonzero` of a matrix, many times faster where little is marked."""
    return np.divmod(np.flatnonzero(marked), marked.shape[1])


def sampled(vectors: DataFrame, column: str, kind) -> np.ndarray:
    """A bounded sample of packed vectors: the `SAMPLE` ones of smallest hash."""
    return unpacked(vectors.select(column).orderBy(F.xxhash64(column)).limit(SAMPLE).toArrow().column(0), kind).astype(np.float64)


def fitted(sample: np.ndarray, rows: int, spherical: bool, rounds: int = 8) -> np.ndarray:
    """Centres of `rows` vectors by k-means on a sample of them."""
    sample = np.unique(sample, axis=0)
    k = int(min(CENTRES, len(sample), max(1, rows // CELL)))
    centres = sample[np.random.default_rng(7).permutation(len(sample))[:k]].copy()
    for _ in range(rounds):
        near = nearest(sample, centres, spherical)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        sizes = np.bincount(near, minlength=k)
        if spherical:
            length = np.linalg.norm(sums, axis=1)
            centres[length > 0] = sums[length > 0] / length[length > 0, None]
        else:
            centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray, spherical: bool) -> np.ndarray:
    """Index of the closest centre: by angle, or by distance."""
    product = rows @ centres.T
    if not spherical:
        product -= 0.5 * (centres * centres).sum(axis=1)
    return product.argmax(axis=1)


def mapped(df: DataFrame, schema: str, names: list[str], run) -> DataFrame:
    """`df.mapInArrow` with a function of a batch that gives the columns `names`."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays(run(batch), names)

    return df.mapInArrow(over, schema)
