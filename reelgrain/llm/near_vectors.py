"""Near-duplicate vectors: blocks that meet once, spherical k-means cells inside them, one vector kept of each group."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from ..session import cut_lineage
from .cells import COLUMNS, ROWS, doubles, fitted, mapped, nearest, packed, places, sampled, unpacked, usable

#: Bytes of vectors in a block at most, about: a task holds two. The vectors move as often as there are blocks.
BLOCK_BYTES = 48 << 20
#: Blocks that smaller tables have too, of this many vectors at least, so that several tasks share the work.
FEW_BLOCKS, LEAST_ROWS = 5, 4096
#: Links that a task collects before it merges what they connect, and the share of pairs from which a whole product is cheaper than single ones.
PENDING, DENSE = 500_000, 0.02


def _forest(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links (left[a], right[b]) connect, at most one for each vector."""
    nodes, at = np.unique(np.concatenate([left[a], right[b]]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    least: float = 0.9) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row: vectors linked by a cosine of `least` or more.

    Blocks of vectors meet two by two, each pair once. In a task a vector has its home in the cell of its closest
    centre, and meets those of its own cell and of every one whose boundary is so near that a link could lie across it: for unit vectors
    at a cosine of `least` the distance is at most d = sqrt(2 - 2 least), so one beyond the bisector of centres a and b
    lies within d of it. The leading coordinates and the length of the rest bound a cosine from above; what the bound
    leaves is computed in full. No link is lost. Equal vectors are compared once and counted as often as they occur.
    Products of bounded size give counts and a spanning forest of the links, not pairs.

    Vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing, nor do
    those of different dimensions with each other; rows with a null id have no component and aren't kept.
    Rows that repeat an id are vectors of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    single = vectors.schema[embedding].dataType.elementType == T.FloatType()
    kind = np.dtype(np.float32 if single else np.float64)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(usable(embedding), F.col(embedding) if single else doubles(embedding)).alias("x"))
    rows = rows.withColumn("x", F.when(F.col("vec_id").isNotNull() & F.exists("x", lambda v: v != 0), F.col("x")))
    # + 0 makes negative zeros equal to others
    rows = rows.withColumn("x", F.transform("x", lambda v: v + F.lit(0).cast("float" if single else "double")))
    rows = cut_lineage(mapped(rows, f"vec_id {vectors.schema[vec_id].dataType.simpleString()}, x binary", ["vec_id", "x"],
                              lambda batch: [batch.column("vec_id"), packed(batch.column("x"))]))
    rows = rows.withColumn("sig", F.unhex(F.sha2("x", 256)))
    # of vectors only those that repeat move here
    copied = rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    copied = cut_lineage(copied.where("copies > 1"))
    single_ones = rows.where("sig IS NOT NULL").join(copied.select("sig"), "sig", "left_anti")
    first = rows.join(copied, "sig").where(F.col("vec_id") == F.col("rep")).groupBy("sig", "rep", "copies").agg(F.first("x").alias("x"))
    distinct = single_ones.select(F.col("vec_id").alias("rep"), "x", F.lit(1).cast("long").alias("copies")).unionByName(
        first.select("rep", "x", "copies"))
    counts, edges = [], []
    size = F.octet_length("x")
    for bytes_, n in [(r.size, r.n) for r in distinct.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()]:
        found = cut_lineage(_links(distinct.where(size == bytes_), n, bytes_, kind, least))
        counts.append(found.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links")))
        edges.append(found.where("other IS NOT NULL").select("rep", "other"))
    linked = spark.createDataFrame([], "rep bigint, links bigint")
    groups = spark.createDataFrame([], "node bigint, component bigint")
    for c in counts:
        linked = linked.unionByName(c)
    if edges:
        joined = edges[0]
        for e in edges[1:]:
            joined = joined.unionByName(e)
        groups = components(joined, "rep", "other")
    known = rows.select("vec_id", "sig").join(copied, "sig", "left").select(
        "vec_id", F.when(F.col("sig").isNotNull(), F.coalesce("rep", "vec_id")).alias("rep"), (F.coalesce("copies", F.lit(1)) - 1).alias("others"))
    out = known.join(linked, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("others")).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _units(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in doubles; scaled before the norm is taken, so that neither overflows."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _links(distinct: DataFrame, n: int, size: int, kind: np.dtype, least: float) -> DataFrame:
    """Rows (rep, links, null) to be summed, and rows (rep, null, other) that connect vectors."""
    sample = _units(sampled(distinct, "x", kind))
    centres = fitted(sample, n, spherical=True)
    # rounded up, as a larger gap only lets more vectors meet
    square = (centres * centres).sum(axis=1)
    gaps = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * centres @ centres.T, 0)) + 1e-6
    reach = math.sqrt(2 - 2 * least)
    # coordinates along the sample's axes, those in which it extends most first
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    few = min(axes.shape[1], max(16, 3 * axes.shape[1] // 8))
    blocks = max(math.ceil(n * size / BLOCK_BYTES), min(FEW_BLOCKS, math.ceil(n / LEAST_ROWS)))

    def homed(batch: pa.RecordBatch) -> list[pa.Array]:
        home = [nearest(_units(unpacked(batch.column("x").slice(i, ROWS), kind)), centres, True) for i in range(0, len(batch), ROWS)]
        return [batch.column("rep"), batch.column("x"), batch.column("copies"), pa.array(np.concatenate(home).astype(np.int32))]

    names = ["rep", "x", "copies", "home"]
    placed = mapped(distinct.select("rep", "x", "copies"), "rep bigint, x binary, copies bigint, home int", names, homed)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
    placed = placed.withColumn("meets", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    placed = placed.select(*names, "block", F.least("block", "meets").alias("a"), F.greatest("block", "meets").alias("b"))

    def leading(units: np.ndarray) -> np.ndarray:
        """Numbers whose product is no less than the cosine: the first coordinates and the length of the others."""
        turned = units @ axes
        rest = np.sqrt(np.maximum((turned[:, few:] ** 2).sum(axis=1, keepdims=True), 0))
        return np.concatenate([turned[:, :few], rest], axis=1).astype(np.float32)

    def compared(table: pa.Table) -> pa.Table:
        home, block = table.column("home").to_numpy(), table.column("block").to_numpy()
        order = np.lexsort((home, block))
        home, block = home[order], block[order]
        x = unpacked(table.column("x"), kind)[order]
        ids, copies = table.column("rep").to_numpy()[order], table.column("copies").to_numpy()[order]
        del table
        cut = int(np.searchsorted(block, block[0], "right"))
        # one block meets itself: each vector those behind it
        own = cut == len(ids)
        front = np.concatenate([leading(_units(x[i:i + ROWS])) for i in range(0, len(x), ROWS)])
        number, label, pending = np.zeros(len(ids), np.int64), np.arange(len(ids)), []

        def merged() -> np.ndarray:
            one, two = _forest(label, label, *(np.concatenate(c) for c in zip(*pending, strict=True)))
            to = np.arange(len(ids))
            to[one] = two
            pending.clear()
            return to[label]

        for start in range(0, cut, ROWS):
            mine = np.arange(start, min(start + ROWS, cut))
            near = _units(x[mine]) @ centres.T
            near = near[np.arange(len(mine)), home[mine]][:, None] - near <= reach * gaps[home[mine]] + 1e-9
            begin = start if own else cut
            while begin < len(ids):
                end = min(begin + COLUMNS, len(ids))
                meet = near[:, home[begin]:home[end - 1] + 1].any(axis=1)
                rows = mine if meet.all() else mine[meet]
                if len(rows):
                    i, j = places(front[rows] @ front[begin:end].T >= np.float32(least - 1e-4))
                    if len(i) > DENSE * len(rows) * (end - begin):
                        cosine = _units(x[rows]) @ _units(x[begin:end]).T
                        i, j = places(cosine >= least - 1e-12)
                        cosine = cosine[i, j]
                        i, j = rows[i], j + begin
                    else:
                        i, j = rows[i], j + begin
                        cosine = np.einsum("ij,ij->i", _units(x[i]), _units(x[j])) if len(i) else np.zeros(0)
                    close = np.flatnonzero(np.abs(cosine - least) < 1e-12)
                    if len(close):  # the order of addition decides: as both sides would add it
                        cosine[close] = [math.fsum(p * q) for p, q in zip(_units(x[i[close]]), _units(x[j[close]]), strict=True)]
                    linked = (cosine >= least) & (ids[i] != ids[j])
                    if own:
                        linked &= i < j
                    i, j = i[linked], j[linked]
                    if len(i):
                        number[start:start + ROWS] += np.bincount(i - start, copies[j], len(number[start:start + ROWS])).astype(np.int64)
                        number[begin:end] += np.bincount(j - begin, copies[i], end - begin).astype(np.int64)
                        new = label[i] != label[j]
                        if new.any():
                            pending.append((i[new], j[new]))
                        if sum(len(p[0]) for p in pending) > PENDING:
                            label = merged()
                begin = end
        if pending:
            label = merged()
        hit, moved = np.flatnonzero(number), np.flatnonzero(ids != ids[label])
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.table({
            "rep": pa.concat_arrays([pa.array(ids[hit]), pa.array(ids[moved])]),
            "links": pa.concat_arrays([pa.array(number[hit]), none(len(moved))]),
            "other": pa.concat_arrays([none(len(hit)), pa.array(ids[label[moved]])]),
        })

    # more partitions than pairs of blocks, so that few share a task
    pairs = blocks * (blocks + 1) // 2
    return placed.repartition(4 * pairs, "a", "b").groupBy("a", "b").applyInArrow(compared, "rep bigint, links bigint, other bigint")
