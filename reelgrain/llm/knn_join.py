"""Exact top-k search by inner product: a Voronoi kNN join.

Data are grouped by their closest pivot. Summaries of a group, its largest and its k smallest
distances to the pivot, bound the scores that a query can reach in it from above and below; blocks of whole
groups, or of parts of a large one, meet the blocks of queries that may have a partner there, and are solved locally, group by group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .cells import ROWS, fitted, mapped, nearest, packed, places, sampled, unpacked, usable

#: Larger whole numbers take no part: their products would not fit a long.
LARGEST = 1 << 27
#: Bytes of data and of queries in a block at most, about: a task holds one of each.
DATA_BYTES, QUERY_BYTES = 16 << 20, 1 << 20
#: Blocks of data that smaller tables have too, of this many vectors at least, and queries that are searched at once.
FEW_BLOCKS, LEAST_ROWS, AT_ONCE = 6, 8192, 256
#: Vectors of data in a product, and a score that nothing has.
COLUMNS, NONE = 4096, -(1 << 63)


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """`vec_id, x`: floor(scale * component); rows without an id or with unusable vectors are left out."""
    scaled = F.transform(F.col(embedding).cast("array<double>"), lambda v: F.floor(F.least(F.greatest(
        v * scale, F.lit(-2.0 * LARGEST)), F.lit(2.0 * LARGEST))).cast("double") + F.lit(0.0))
    kept = vectors.where(usable(embedding) & F.col(vec_id).isNotNull())
    whole = kept.select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("x"))
    return whole.where(F.forall("x", lambda v: F.abs(v) <= LARGEST))


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """`query_id, rank, vec_id, score`: the k best partners of each row whose id is divisible by `every`.

    Scores are inner products of the whole numbers floor(scale * component); equal scores go to the smaller id;
    fewer than k rows where there are fewer candidates. Rows with a null id, a null vector or null or
    non-finite components take no part, nor do components beyond LARGEST. Vectors of different dimensions
    are not compared. A row that repeats the id of a query counts as the query's own; queries of one
    id and vector give one result. An empty table gives no rows.
    """
    rows = quantised(vectors, vec_id, embedding, scale)
    bound = rows.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] or 0
    # whole numbers as the smallest type that holds all of them
    kind = np.dtype(next(t for t in ("int8", "int16", "int32") if bound <= np.iinfo(t).max))
    rows = cut_lineage(mapped(rows, "vec_id bigint, x binary", ["vec_id", "x"], lambda batch: [batch.column("vec_id"), packed(batch.column("x"), kind)]))
    spark, found = vectors.sparkSession, None
    for dim, n in [(r.dim, r.n) for r in rows.groupBy((F.octet_length("x") / kind.itemsize).cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()]:
        part = _solved(rows.where(F.octet_length("x") == dim * kind.itemsize), n, k, every, kind, dim * bound * bound, dim)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _take(best: np.ndarray, which: np.ndarray, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray, repeated: bool) -> None:
    """Put what is among the k best into those rows of `best` and `which`: scores, the highest first, and their ids."""
    k = best.shape[1]
    open_ = np.ones(scores.shape, bool)
    if np.isin(own, ids).any():
        open_ = ids[None, :] != own[:, None]
        scores[~open_] = -np.inf if scores.dtype.kind == "f" else NONE
    last = best[rows, -1]
    floor, empty = last.astype(scores.dtype), last == NONE
    if empty.any() and len(ids) > k and not repeated:
        floor[empty] = np.partition(scores[empty], len(ids) - k, axis=1)[:, len(ids) - k]
    open_ &= scores >= floor[:, None]
    i, j = places(open_)
    if not len(i):
        return
    found = np.unique(i)
    at = np.concatenate([i, np.repeat(found, k)])
    score = np.concatenate([scores[i, j].astype(np.int64), best[rows[found]].ravel()])
    who = np.concatenate([ids[j], which[rows[found]].ravel()])
    filled = score != NONE
    at, score, who = at[filled], score[filled], who[filled]
    if repeated:  # an id counts with its best vector
        order = np.lexsort((-score, who, at))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(at[order]) != 0) | (np.diff(who[order]) != 0)
        at, score, who = (c[order[new]] for c in (at, score, who))
    order = np.lexsort((who, -score, at))
    at, score, who = at[order], score[order], who[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    at, score, who, rank = (c[rank < k] for c in (at, score, who, rank))
    best[rows[found]] = which[rows[found]] = NONE
    best[rows[at], rank], which[rows[at], rank] = score, who


def _solved(rows: DataFrame, n: int, k: int, every: int, kind: np.dtype, highest: float, dim: int) -> DataFrame:
    # of equal vectors only the k + 1 smallest ids can be among the k best of any query
    same = Window.partitionBy("x").orderBy("vec_id")
    distinct = rows.distinct()
    useful = distinct.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).select("vec_id", "x")
    pivots = fitted(sampled(rows, "x", kind), n, spherical=False)
    m = len(pivots)

    def pieces(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [unpacked(batch.column("x").slice(i, ROWS), kind).astype(np.float64) for i in range(0, len(batch), ROWS)]

    def homed(batch: pa.RecordBatch) -> list[pa.Array]:
        home, far = [], []
        for x in pieces(batch):
            home.append(nearest(x, pivots, False))
            far.append(np.linalg.norm(x - pivots[home[-1]], axis=1) * (1 + 1e-12))
        return [batch.column("vec_id"), batch.column("x"), pa.array(np.concatenate(home).astype(np.int32)), pa.array(np.concatenate(far))]

    data = cut_lineage(mapped(useful, "vec_id bigint, x binary, home int, far double", ["vec_id", "x", "home", "far"], homed))
    # summaries, one row for each of at most CENTRES pivots
    closest = data.withColumn("nth", F.row_number().over(Window.partitionBy("home").orderBy("far"))).where(F.col("nth") <= k + 1)
    closest = {r.home: sorted(r.far) for r in closest.groupBy("home").agg(F.collect_list("far").alias("far")).collect()}
    radius, sizes = np.full(m, -np.inf), np.zeros(m, int)
    for r in data.groupBy("home").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():
        radius[r.home], sizes[r.home] = r.far, r.n
    near = np.full((m, k + 1), np.inf)
    for home, far in closest.items():
        near[home, :len(far)] = far
    # groups one after the other along the blocks, so that a block has few groups, and a large group has several blocks
    size = dim * kind.itemsize
    per_block = max(1, min(DATA_BYTES // size, max(LEAST_ROWS, -(-int(sizes.sum()) // FEW_BLOCKS))))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // per_block
    last = np.maximum(first, (np.cumsum(sizes) - 1) // per_block)
    wanted = distinct.where(F.col("vec_id") % every == 0)
    crowds = max(1, math.ceil(wanted.count() * size / QUERY_BYTES))

    def hopeful(x: np.ndarray) -> np.ndarray:
        """Whether a query may have one of its k best in a group."""
        to_pivot, length = x @ pivots.T, np.linalg.norm(x, axis=1) * (1 + 1e-9)
        # k partners and the query itself are sure to score this much at least
        sure = np.concatenate([to_pivot - length[:, None] * near[None, :, i] for i in range(k + 1)], axis=1)
        sure[~np.isfinite(sure)] = -np.inf
        at = min(k, sure.shape[1] - 1)
        floor = -np.partition(-sure, at, axis=1)[:, at] if sure.shape[1] > k else np.full(len(x), -np.inf)
        return (to_pivot + length[:, None] * radius[None, :] >= floor[:, None] - 1e-6) & (sizes > 0)[None, :]

    def visited(batch: pa.RecordBatch) -> list[pa.Array]:
        who, block = [], []
        for start in range(0, len(batch), AT_ONCE):
            may = hopeful(unpacked(batch.column("x").slice(start, AT_ONCE), kind).astype(np.float64))
            go = np.zeros((len(may), int(last[-1]) + 1), bool)
            for c in np.flatnonzero(sizes):
                go[:, first[c]:last[c] + 1] |= may[:, c:c + 1]
            at, to = np.nonzero(go)
            who.append(at + start)
            block.append(to)
        who, block = np.concatenate(who), np.concatenate(block).astype(np.int32)
        return [batch.column("vec_id").take(pa.array(who)), batch.column("x").take(pa.array(who)), batch.column("crowd").take(pa.array(who)), pa.array(block)]

    queries = cut_lineage(mapped(wanted.withColumn("crowd", F.pmod(F.xxhash64("vec_id"), F.lit(crowds)).cast("int")),
                     "query_id bigint, x binary, crowd int, block int", ["query_id", "x", "crowd", "block"], visited))
    spread = F.array(*[F.struct(F.lit(int(a)).alias("first"), F.lit(int(b - a + 1)).alias("n")) for a, b in zip(first, last, strict=True)])
    shelf = F.element_at(spread, F.col("home") + 1)
    blocks = data.withColumn("block", (shelf["first"] + F.pmod(F.xxhash64("vec_id"), shelf["n"])).cast("int"))
    keys = ["crowd", "block"]
    offered = blocks.join(queries.select(*keys).distinct(), "block").select("vec_id", "x", "home", *[F.col(c).alias(c) for c in keys])
    # sums that a type holds without rounding
    number = np.float32 if highest < 2**24 else np.float64 if highest < 2**53 else np.int64

    def solved(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())),
                             "scores": pa.array([], pa.list_(pa.int64()))})
        query, x = left.column("query_id").to_numpy(), unpacked(left.column("x"), kind)
        ids, home = right.column("vec_id").to_numpy(), right.column("home").to_numpy()
        order = np.argsort(home, kind="stable")
        ids, home, y = ids[order], home[order], unpacked(right.column("x"), kind)[order]
        repeated = len(np.unique(ids)) < len(ids)
        picked, scores = [], []
        for start in range(0, len(query), AT_ONCE):
            mine, own = x[start:start + AT_ONCE], query[start:start + AT_ONCE]
            may, mine = hopeful(mine.astype(np.float64)), mine.astype(number)
            best, which = np.full((len(own), k), NONE), np.full((len(own), k), NONE)
            for begin in range(0, len(ids), COLUMNS):
                end = min(begin + COLUMNS, len(ids))
                go = np.flatnonzero(may[:, home[begin]:home[end - 1] + 1].any(axis=1))
                if len(go):
                    _take(best, which, go, mine[go] @ y[begin:end].astype(number).T, ids[begin:end], own[go], repeated)
            picked += [row[row_best != NONE] for row, row_best in zip(which, best, strict=True)]
            scores += [row[row != NONE] for row in best]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in picked])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, np.concatenate(c)) for c in (picked, scores)]
        return pa.table({"query_id": pa.array(query), "ids": lists[0], "scores": lists[1]})

    best = queries.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(
        solved, "query_id bigint, ids array<bigint>, scores array<bigint>")
    pairs = best.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("p"))
    # equal ids with several vectors: the best of them
    return pairs.groupBy("query_id", F.col("p.ids").alias("vec_id")).agg(F.max("p.scores").alias("score"))
