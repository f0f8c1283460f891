"""Centroid clustering with an incremental distance matrix.

Vectors are whole numbers, so every product is exact. The inner products of each vector with all centroids are kept in a
table. After a round only the components of a centroid that changed are multiplied again, products are
corrected by the difference, and the nearest centroid is read off |x|^2 - 2 x.c + |c|^2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, staged
from .cells import doubles, matrix, usable
from .common import give_back

#: Whole components beyond this end the job: a squared distance of 64 of them may not fit a long.
LARGEST = 1 << 27
#: Rows that a product is made for at once.
ROWS = 4096


def product(x: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Exact x @ changes: in doubles where every partial sum is a whole number below 2**53, else in longs."""
    if not x.size or not changes.size:
        return np.zeros((len(x), changes.shape[1]), np.int64)
    if int(np.abs(x).max()) * int(np.abs(changes).max()) * x.shape[1] < 1 << 53:
        return (x.astype(np.float64) @ changes.astype(np.float64)).astype(np.int64)
    return x @ changes


def corrected(x: np.ndarray, dots: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Products after centroids moved by `changes` (dimension x centroids): only their nonzero components count."""
    out = dots.copy()
    moved = np.flatnonzero(changes.any(axis=0))
    if not len(moved):
        return out
    touched = np.flatnonzero(changes[:, moved].any(axis=1))
    if 2 * len(touched) > len(changes) and len(moved) > 1:
        # most components change somewhere: one product, whose zero changes add nothing
        out[:, moved] += product(x[:, touched], changes[np.ix_(touched, moved)])
        return out
    for c in moved:
        at = np.flatnonzero(changes[:, c])
        out[:, c] += product(x[:, at], changes[at, c][:, None])[:, 0]
    return out


def whole(vectors: DataFrame, vec_id: str, embedding: str, dim: int, scale: int) -> DataFrame:
    """`vec_id, x`: floor(scale * component) of the vectors that take part."""
    def rounded(v):
        large = F.raise_error(F.concat(F.lit("component too large for exact distances: "), v.cast("string")))
        return F.when(F.abs(v * scale) <= LARGEST, F.floor(v * scale).cast("int")).otherwise(large.cast("int"))

    kept = vectors.where(usable(embedding) & (F.size(embedding) == dim))
    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(doubles(embedding), rounded).alias("x"))


def seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first centroids: the k vectors of smallest sha256 of seed and id; repeated ids by their components, null ids last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("x", name.alias("name")).orderBy(F.asc_nulls_last("name"), "x").limit(k).collect()
    return np.array([r.x for r in first], np.int64)


def _assigned(table: DataFrame, centres: np.ndarray, changes: np.ndarray | None, schema: T.StructType) -> DataFrame:
    """The distance matrix for these centroids: made anew, or from the one before by what changed."""
    norms = (centres * centres).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
            x = matrix(part.column("x"), np.int64)
            if changes is None:
                dots, norm = product(x, centres.T), (x * x).sum(axis=1)
            else:
                dots, norm = corrected(x, matrix(part.column("dots"), np.int64), changes), part.column("norm").to_numpy()
            gaps = norms[None, :] - 2 * dots
            cluster = gaps.argmin(axis=1)
            distance = norm + gaps[np.arange(len(x)), cluster]
            lists = pa.ListArray.from_arrays(np.arange(0, dots.size + 1, dots.shape[1], dtype=np.int32), dots.ravel())
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), part.column("x"), pa.array(norm), lists, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                schema.names)
        give_back()

    return table.mapInArrow(run, schema)


def _sums(table: DataFrame) -> DataFrame:
    """`cluster, part, total`: sums of each component, and at part -1 the rows, of a cluster; added up in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, cluster = matrix(batch.column("x"), np.int64), batch.column("cluster").to_numpy()
            for c in np.unique(cluster):
                mine = x[cluster == c]
                total[int(c)] = total.get(int(c), 0) + np.append(len(mine), mine.sum(axis=0))
        for c, sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sums), c, np.int32)), pa.array(np.arange(-1, len(sums) - 1, dtype=np.int32)), pa.array(sums)],
                ["cluster", "part", "total"])

    parts = table.select("x", "cluster").mapInArrow(run, "cluster int, part int, total bigint")
    return parts.groupBy("cluster", "part").agg(F.sum("total").alias("total"))


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
            vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid` (an array) for each vector that takes part.

    Vectors with another number of components than `dim`, null ones and those with null or non-finite components are left
    out. Components become floor(scale * component), distances are squared and exact; equal ones go to the smaller
    cluster. Centroids become floor(sum / count) after each round; one without vectors stays. Fewer vectors than k make fewer
    clusters. Rows that repeat, also with equal or null ids, count each for itself; a null id names no first
    centroid while there are others. An empty table, or one without usable vectors, gives no rows; columns other than the two
    named are not kept. A component beyond 2**27 after scaling ends the job with an error, for its distances
    may not fit a long; a sum that doesn't fit one ends it too, by Spark's own check.

    The driver holds k centroids and k sums. Each round writes the matrix anew in the shared folder and deletes the one
    before, so a lost executor costs the tasks it ran. Rounds that change nothing write nothing.
    """
    spark = vectors.sparkSession
    key = vectors.schema[vec_id].dataType
    schema = T.StructType([
        T.StructField("vec_id", key), T.StructField("x", T.ArrayType(T.IntegerType())), T.StructField("norm", T.LongType()),
        T.StructField("dots", T.ArrayType(T.LongType())), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    rows = whole(vectors, vec_id, embedding, dim, scale)
    centres = seeds(rows, k, seed)
    result = T.StructType([schema["vec_id"], schema["cluster"], schema["distance"], T.StructField("cluster_inertia", T.LongType()),
                           T.StructField("inertia", T.LongType()), T.StructField("centroid", T.ArrayType(T.LongType()))])
    if not len(centres):
        return spark.createDataFrame([], result)
    table, path = staged(_assigned(rows, centres, None, schema))
    for _ in range(rounds):
        moved = centres.copy()
        sums: dict[int, dict[int, int]] = {}
        for r in _sums(table).collect():  # at most k * (dim + 1) rows
            sums.setdefault(r.cluster, {})[r.part] = r.total
        for c, found in sums.items():
            moved[c] = [found[i] // found[-1] for i in range(dim)]
        if (moved == centres).all():
            break
        before = path
        table, path = staged(_assigned(table, moved, (moved - centres).T, schema))
        discard(spark, before)
        centres = moved
    inertia = {r.cluster: r.total for r in table.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    by_cluster = F.array(*[F.lit(int(inertia.get(c, 0))).cast("long") for c in range(len(centres))])
    centroid = F.array(*[F.array(*[F.lit(int(v)).cast("long") for v in row]) for row in centres])
    at = F.col("cluster") + 1
    return table.select("vec_id", "cluster", "distance", F.element_at(by_cluster, at).alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.element_at(centroid, at).alias("centroid"))
