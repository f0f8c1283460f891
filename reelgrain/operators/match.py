"""Feature matching: exact nearest neighbours within a scene, ratio test, mutual check.

All images of a scene are compared, but pairs never become rows. Tasks hold a block of queries and one of targets,
both of bounded size, and keep `k` rows per query. In a task targets are grouped around pivot vectors, and a query meets
another group only when its centre and radius leave room for something closer than what it has; matrix products
in single precision pick what may be among the best, which is then scored in full, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .ordered import top_n

#: Vectors in a block at most, and their bytes.
BLOCK_ROWS, BLOCK_BYTES = 1 << 17, 32 << 20
#: Blocks of queries that a whole table has at least, and the queries that make another one worth it.
FEW_BLOCKS, LEAST_QUERIES = 12, 4096
DIGITS = 12
#: Rows of a piece of a block, queries that meet it at once, and the share of pairs from which a whole product is cheaper than single ones.
PIECE_ROWS, AT_ONCE, DENSE = 1024, 256, 0.02
#: Images that a bucket of the approximate search should hold, projections and tables at most.
BUCKET_ROWS, MAX_BITS, MAX_TABLES = 512, 24, 8
#: Boundaries that probes may cross, sampled queries per number of bits, and bits of a key that are told apart inside a task at most.
FLIPPED, SAMPLED, MAX_SHIFT = 12, 256, 14


def pair_counts(frames: DataFrame, scene: str) -> DataFrame:
    """Images and image pairs per scene: the work an exhaustive comparison covers."""
    counts = frames.groupBy(scene).agg(F.count(F.lit(1)).alias("images"))
    n = F.col("images")
    return counts.withColumn("pairs", F.call_function("div", n * (n - 1), F.lit(2).cast("long")))


def _unit(values: pd.Series) -> np.ndarray:
    rows = np.asarray(values.tolist(), dtype=np.float64)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1.0, norms)


def _units(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    norms = np.linalg.norm(flat, axis=1, keepdims=True)
    flat /= np.where(norms == 0, 1.0, norms)
    return flat


def _merge(best: np.ndarray, who: np.ndarray, rows: np.ndarray, at: np.ndarray, score: np.ndarray, code: np.ndarray) -> None:
    """Put what is among the k best into those rows of `best` and `who`: the highest scores first, equal ones by code."""
    k, found = best.shape[1], np.unique(at)
    at = np.concatenate([at, np.repeat(found, k)])
    score, code = np.concatenate([score, best[rows[found]].ravel()]), np.concatenate([code, who[rows[found]].ravel()])
    filled = np.isfinite(score)
    at, score, code = at[filled], score[filled], code[filled]
    order = np.lexsort((code, -score, at))
    at, score, code = at[order], score[order], code[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    at, score, code, rank = (c[rank < k] for c in (at, score, code, rank))
    best[rows[found]], who[rows[found]] = -np.inf, -1
    best[rows[at], rank], who[rows[at], rank] = score, code


def _searched(q: np.ndarray, own: np.ndarray, t: np.ndarray, code: np.ndarray, k: int, pivots: int | None,
              met: Callable[[slice], np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and codes of the `k` best targets of each query; `met` tells which targets a slice of queries meets."""
    some = t[np.random.default_rng(11).permutation(len(t))[:pivots or -(-len(t) // PIECE_ROWS)]]
    home = np.concatenate([(t[i:i + PIECE_ROWS] @ some.T).argmax(axis=1) for i in range(0, len(t), PIECE_ROWS)])
    order = np.argsort(home, kind="stable")
    t, code = t[order], code[order]
    quick = t.astype(np.float32)
    pieces = [slice(i, min(i + PIECE_ROWS, len(t))) for i in range(0, len(t), PIECE_ROWS)]
    centres = np.stack([t[p].mean(axis=0) for p in pieces])
    radius = np.array([np.sqrt(((t[p] - c) ** 2).sum(axis=1)).max() for p, c in zip(pieces, centres, strict=True)])
    slack = 2 * (1e-6 + 1.2e-7 * t.shape[1])  # of single precision
    scores, found = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
    for start in range(0, len(q), AT_ONCE):
        part = slice(start, min(start + AT_ONCE, len(q)))
        mine, best, who = q[part], scores[part], found[part]
        small, allowed = mine.astype(np.float32), met(part)[:, order] if met else None
        # no product with a target of a piece is larger
        most = np.nan_to_num(mine @ centres.T + np.linalg.norm(mine, axis=1, keepdims=True) * radius, nan=np.inf)
        for n in np.argsort(-most.max(axis=0), kind="stable"):
            rows, p = np.flatnonzero(most[:, n] >= best[:, -1] - slack), pieces[n]
            if not len(rows):
                continue
            near = small[rows] @ quick[p].T
            near[np.isnan(near)] = -np.inf
            near[own[part][rows, None] == code[None, p]] = -np.inf
            if allowed is not None:
                near[~allowed[rows, p]] = -np.inf
            floor = best[rows, -1] - slack
            empty = np.flatnonzero(best[rows, -1] == -np.inf)
            if len(empty) and near.shape[1] > k:
                floor[empty] = np.partition(near[empty], near.shape[1] - k, axis=1)[:, near.shape[1] - k] - slack
            i, j = np.divmod(np.flatnonzero((near >= floor[:, None].astype(np.float32)) & (near > -np.inf)), near.shape[1])
            if not len(i):
                continue
            if len(i) > DENSE * near.size:
                exact = (mine[rows] @ t[p].T)[i, j]
            else:
                exact = np.einsum("ij,ij->i", mine[rows[i]], t[p][j])
            _merge(best, who, rows, i, np.round(exact, DIGITS), code[p][j])
    return scores, found


def _best(k: int, pivots: int | None, shift: int | None):
    """Task body: the best `k` targets of a block for every query of a block; with `shift`, of the buckets that it probes."""

    def compare(queries: pa.Table, targets: pa.Table) -> pa.Table:
        names = ["scene", "sig", "src", "dst", "score"]
        ids = targets.column("id")
        if not len(queries) or not len(targets):
            parts = [*[queries.column(c).slice(0, 0) for c in ("scene", "sig", "src")], ids.slice(0, 0), pa.array([], pa.float64())]
            return pa.table(dict(zip(names, parts, strict=True)))
        known, code = np.unique(ids.to_numpy(), return_inverse=True)
        src = queries.column("src").combine_chunks()
        asks = src.drop_null().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(known, asks), len(known) - 1)
        own = np.full(len(src), -1)
        own[src.is_valid().to_numpy(zero_copy_only=False)] = np.where(known[at] == asks, at, -1)
        met = None
        if shift is not None:
            spots, width = queries.column("at").to_pylist(), 1 << shift
            probes, key = queries.column("probes").to_numpy(), targets.column("key").to_numpy()
            base = int(key[0]) >> shift << shift
            spots = np.frombuffer(b"".join(spots)).reshape(len(spots), len(spots[0]) // 8)

            def met(part: slice) -> np.ndarray:
                keys = _probes(spots[part], int(probes[0])) - base
                marked = np.zeros((len(keys), width + 1), bool)
                # what lies on other shelves is marked in a column of its own
                marked[np.arange(len(keys))[:, None], np.where((keys >= 0) & (keys < width), keys, width)] = True
                return marked[:, key - base]

        scores, who = _searched(_units(queries.column("vec")), own, _units(targets.column("vec")), code, k, pivots, met)
        row, place = np.nonzero(who >= 0)
        first = np.unique(code, return_index=True)[1]
        took = queries.select(["scene", "sig", "src"]).take(pa.array(row))
        return took.append_column("dst", ids.take(pa.array(first[who[row, place]]))).append_column("score", pa.array(scores[row, place]))

    return compare


def _compare(queries: DataFrame, targets: DataFrame, k: int, size: int, schema: str, pivots: int | None = None, shift: int | None = None) -> DataFrame:
    """Queries against the targets of the same scene and cell, block by block."""
    keys = ["scene", "cell"]
    counts = queries.groupBy(*keys).agg(F.count(F.lit(1)).alias("_q")).join(targets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_t")), keys)
    counts = cut_lineage(counts)
    total = counts.agg(F.sum("_q")).first()[0] or 1
    # a share of the table has its share of the blocks, so that one scene is not one task
    parts = F.greatest(F.ceil(F.col("_q") / size), F.least(F.ceil(F.col("_q") / LEAST_QUERIES), F.ceil(F.col("_q") * FEW_BLOCKS / total)))
    # read with a known size, so that Spark broadcasts it if it is small and no vector moves for it
    counts = counts.select(*keys, parts.cast("int").alias("qn"), F.ceil(F.col("_t") / size).cast("int").alias("tn"))

    def dealt(rows: DataFrame, who: str, mine: str, own: str, other: str, others: str) -> DataFrame:
        rows = rows.join(counts, keys).withColumn(mine, F.pmod(F.xxhash64(who, F.lit(7)), F.col(own)).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("qn", "tn")

    at = [*keys, "qb", "tb"]
    q, t = dealt(queries, "sig", "qb", "qn", "tb", "tn"), dealt(targets, "id", "tb", "tn", "qb", "qn")
    # fresh columns: both sides may come from one table
    t = t.select(*[F.col(c).alias(c) for c in t.columns])
    return q.groupBy(*at).cogroup(t.groupBy(*at)).applyInArrow(_best(k, pivots, shift), schema)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut so that a matrix of products stays small."""
    for batch in batches:
        for start in range(0, len(batch), PIECE_ROWS):
            yield batch.iloc[start:start + PIECE_ROWS]


def _fitting(rows: DataFrame, block_rows: int) -> int:
    """Vectors of a block: as many as asked for and as BLOCK_BYTES hold, by the size of one of them."""
    first = rows.select(F.size("vec")).first()
    return max(1, min(block_rows, BLOCK_BYTES // (4 * first[0] if first else 1)))


def _found_schema(features: DataFrame, id: str, scene: str) -> str:
    kind, label = features.schema[id].dataType.simpleString(), features.schema[scene].dataType.simpleString()
    return f"scene {label}, sig binary, src {kind}, dst {kind}, score double"


def _signed(features: DataFrame, id: str, scene: str, vec: str) -> DataFrame:
    """`scene, id, vec, sig`: images with a scene, and one signature per distinct vector."""
    rows = features.where(F.col(scene).isNotNull() & (F.size(vec) > 0)).select(F.col(scene).alias("scene"), F.col(id).alias("id"), F.col(vec).alias("vec"))
    return cut_lineage(rows.withColumn("sig", F.unhex(F.sha2(F.to_json(F.struct("vec")), 256))))


def _reduced(rows: DataFrame, k: int, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images that can be in a list, k + 1 for each vector, one query for each of them and for all other copies together, and what has so many copies."""
    crowded = cut_lineage(rows.groupBy("scene", "sig").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > k + 1).select("scene", "sig"))
    # vectors only move where they have many copies
    crowd = rows.join(crowded, ["scene", "sig"], "left_semi")
    columns = ["scene", "id", "vec", "sig"]
    targets = rows.join(crowded, ["scene", "sig"], "left_anti").select(*columns).unionByName(
        top_n(crowd, ["scene", "sig"], [F.asc("id")], k + 1).select(*columns))
    # copies that are not targets search as one query without an id
    spare = crowd.groupBy("scene", "sig").agg(F.min_by("vec", "id").alias("vec"))
    spare = spare.select("scene", F.lit(None).cast(kind).alias("src"), "vec", "sig")
    return targets, targets.select("scene", F.col("id").alias("src"), "vec", "sig").unionByName(spare), crowd


def _spread(found: DataFrame, rows: DataFrame, targets: DataFrame, k: int, scene: str, kind: str) -> DataFrame:
    """Lists of all images: a target takes its own, a further copy that of the search without an id."""
    ranked = top_n(found, ["scene", "sig", "src"], [F.desc("score"), F.asc("dst")], k, "rank")
    own = targets.select("scene", "sig", "id", F.col("id").alias("src"))
    copies = rows.select("scene", "sig", "id").join(own.select("scene", "id"), ["scene", "id"], "left_anti")
    members = own.unionByName(copies.withColumn("src", F.lit(None).cast(kind)))
    same = (F.col("m.scene").eqNullSafe(F.col("r.scene")) & (F.col("m.sig") == F.col("r.sig"))
            & F.col("m.src").eqNullSafe(F.col("r.src")))
    lists = members.alias("m").join(ranked.alias("r"), same)
    return lists.select(F.col("m.scene").alias(scene), F.col("m.id").alias("src"), "r.dst", "r.score", "r.rank")


def nearest(features: DataFrame, id: str, scene: str, vec: str, k: int = 2, block_rows: int = BLOCK_ROWS,
            pivots: int | None = None) -> DataFrame:
    """The `k` most similar images of the same scene for every image: (scene, src, dst, score, rank).

    Similarity is the cosine; equal scores go to the smaller id; images without a scene or a vector match
    nothing. Exact copies of a vector beyond the first k + 1 cannot enter anyone's list and share
    one search, so a large group of copies costs no more than a single image. Blocks have `block_rows` vectors at most, or
    BLOCK_BYTES of them, and `pivots` groups inside a task, or one for PIECE_ROWS targets.
    """
    rows = _signed(features, id, scene, vec)
    kind = features.schema[id].dataType.simpleString()
    targets, queries, crowd = _reduced(rows, k, kind)
    whole = F.lit(0).alias("cell")
    found = _compare(queries.select("*", whole), targets.select("*", whole), k, _fitting(rows, block_rows),
                     _found_schema(features, id, scene), pivots)
    return _spread(cut_lineage(found), crowd, targets, k, scene, kind)


def match(features: DataFrame, id: str, scene: str, vec: str, ratio: float | None = 0.8, mutual: bool = True,
          **options) -> DataFrame:
    """Accepted matches: the best partner of each image, as edges (src, dst, score).

    The ratio test compares the distances to the best and the second-best partner (Lowe 2004); the
    mutual check keeps a pair when each is the other's best. `options` go to `nearest`.
    """
    two = nearest(features, id, scene, vec, 2, **options)
    gap = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("score")))
    best = two.groupBy(scene, "src").agg(
        F.max(F.when(F.col("rank") == 1, F.col("dst"))).alias("dst"),
        F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("score"),
        F.max(F.when(F.col("rank") == 1, gap)).alias("_d1"),
        F.max(F.when(F.col("rank") == 2, gap)).alias("_d2"))
    passed = F.lit(True) if ratio is None else F.col("_d2").isNull() | (F.col("_d1") < ratio * F.col("_d2"))
    judged = best.withColumn("_ok", passed)
    if not mutual:
        return judged.where("_ok").select(scene, "src", "dst", "score")
    # both directions of a mutual pair meet in one group of two rows
    ends = judged.groupBy(scene, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("score").alias("score"), F.bool_or(F.col("_ok") & (F.col("src") < F.col("dst"))).alias("_ok"))
    return ends.where("_n = 2 AND _ok").select(scene, F.col("a").alias("src"), F.col("b").alias("dst"), "score")


def _planes(dim: int, seed: int, tables: int) -> np.ndarray:
    """Random directions of every table: the first ones of a table make its key, as many as a scene needs."""
    return np.random.default_rng(seed).normal(size=(tables, dim, MAX_BITS))


def _masks(bits: int) -> np.ndarray:
    """All choices of the bits that are nearest to their boundary, as rows of 0 and 1; the empty one first."""
    few = min(bits, FLIPPED)
    return (np.arange(1 << few)[:, None] >> np.arange(few)) & 1


def _probes(places: np.ndarray, probes: int) -> np.ndarray:
    """Keys of the buckets that a query visits: its own, then those across the boundaries that are nearest to it together."""
    bits = places.shape[1]
    own = (places > 0) @ (1 << np.arange(bits, dtype=np.int64))
    if probes == 1 or not bits:
        return own[:, None]
    masks = _masks(bits)
    near = np.argsort(np.abs(places), axis=1)[:, :masks.shape[1]]
    cost = np.take_along_axis(places, near, axis=1) ** 2 @ masks.T
    order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    flips = (1 << near) @ masks.T
    return own[:, None] ^ np.take_along_axis(flips, order, axis=1)


def _calibrated(queries: DataFrame, targets: DataFrame, k: int, planes: np.ndarray, recall: float) -> dict[int, tuple[int, int]]:
    """Tables and probes for each number of bits: the least work that finds `recall` of the partners of a sample.

    The sample is SAMPLED queries for each number of bits, at most MAX_BITS of those; its true partners come from one
    pass over all images of scenes with buckets.
    """
    sample = top_n(queries.where("bits > 0 AND src IS NOT NULL"), ["bits"], [F.xxhash64("src", "scene")], SAMPLED).collect()
    if not sample:
        return {}
    spots = np.array([r.place for r in sample])
    unit = _unit(pd.Series([r.vec for r in sample]))
    by_scene: dict = {}
    for i, r in enumerate(sample):
        by_scene.setdefault(r.scene, []).append(i)
    ids = [r.src for r in sample]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list] = {}
        for piece in _pieces(batches):
            for scene, part in piece.groupby("scene"):
                mine = by_scene.get(scene)
                if mine is None:
                    continue
                scores = np.round(unit[mine] @ _unit(part["vec"]).T, DIGITS)
                dst, place = part["id"].tolist(), part["place"].tolist()
                for row, i in zip(scores, mine, strict=True):
                    for j in np.argsort(-row, kind="stable")[:k + 1]:
                        if dst[j] != ids[i]:
                            best.setdefault(i, []).append((-row[j], dst[j], place[j]))
                    best[i] = sorted(best.get(i, []), key=lambda b: b[:2])[:k]
        rows = [(i, -b[0], b[2]) for i, found in best.items() for b in found]
        if rows:
            yield pd.DataFrame({"i": [r[0] for r in rows], "score": [r[1] for r in rows], "place": [r[2] for r in rows]}).astype({"i": "int32", "score": float})

    scored = targets.where("bits > 0").select("scene", "id", "vec", "place").mapInPandas(task, "i int, score double, place array<double>")
    pairs = top_n(scored, ["i"], [F.desc("score")], k).collect()
    plan: dict[int, tuple[int, int]] = {}
    for bits in sorted({r.bits for r in sample}):
        mine = [p for p in pairs if sample[p.i].bits == bits]
        if not mine:
            plan[bits] = (1, 1)
            continue
        a, b = spots[[p.i for p in mine]], np.array([p.place for p in mine])
        first = np.full((len(planes), len(mine)), 1 << bits)
        for t, plane in enumerate(planes):
            keys = (b @ plane[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
            seen = _probes(a @ plane[:, :bits], 1 << min(bits, FLIPPED)) == keys[:, None]
            first[t] = np.where(seen.any(axis=1), seen.argmax(axis=1), 1 << bits)
        options = []
        for tables in range(1, len(planes) + 1):
            needed = int(np.quantile(first[:tables].min(axis=0), recall, method="higher")) + 1
            options.append((tables * min(needed, 1 << min(bits, FLIPPED)), tables, min(needed, 1 << min(bits, FLIPPED))))
        _, tables, probes = min(options)
        plan[bits] = (tables, probes)
    return plan


def approx_nearest(features: DataFrame, id: str, scene: str, vec: str, k: int = 2, bucket_rows: int = BUCKET_ROWS,
                   recall: float = 0.97, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Like `nearest`, but an image meets only those in the buckets that it probes, so it may miss partners.

    Vectors are measured from the mean of their scene. Random projections joined into one key deal a scene into buckets of
    about `bucket_rows` images, so the number of projections follows from its size; a query visits its own bucket and those across
    the nearest boundaries (the multi-probe scheme of Lv et al. 2007). How many tables and probes it takes is
    measured on a bounded sample of queries against all images, as the cheapest way to `recall` of their partners. Where
    vectors have clusters, that is a few buckets whatever the size; where they have no structure at all it
    goes up to all buckets of one table, which is the exact search. Scenes of one bucket are compared
    whole. Equal vectors share a search, and big buckets are cut into blocks, as in `nearest`. Images without a vector have no list.
    """
    kind, schema = features.schema[id].dataType.simpleString(), _found_schema(features, id, scene)
    rows = _signed(features.where(F.size(vec) > 0), id, scene, vec)
    targets, queries, crowd = _reduced(rows, k, kind)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    unit = F.transform("vec", lambda x: x.cast("double") / F.when(norm > 0, norm).otherwise(F.lit(1.0)))
    means = targets.groupBy("scene").agg(F.count(F.lit(1)).alias("_n"), Summarizer.mean(array_to_vector(unit)).alias("_m"))
    bits = F.least(F.greatest(F.floor(F.log2(F.col("_n") / F.lit(float(bucket_rows)))), F.lit(0)), F.lit(MAX_BITS)).cast("int")
    means = cut_lineage(means.select(F.col("scene").alias("_of"), vector_to_array("_m").alias("_mean"), bits.alias("bits")))

    def placed(part: DataFrame) -> DataFrame:
        # one row per scene; broadcast by Spark's own check of its size
        return part.join(means, F.col("scene") == F.col("_of")).withColumn(
            "place", F.zip_with(unit, "_mean", lambda x, m: x - m)).drop("_of", "_mean")

    # placed anew each time it is read: a table of places would be larger than that of the vectors
    alike = targets
    targets, queries = placed(targets), placed(queries)
    first = rows.select(F.size("vec")).first()
    planes = _planes(first[0] if first else 1, seed, MAX_TABLES)
    plan = _calibrated(queries, targets, k, planes, recall)
    size = _fitting(rows, block_rows)
    # so many bits of a key are told apart inside a task: buckets that lie together make a block
    shift = max(0, min(MAX_SHIFT, int(math.log2(max(1, size // (2 * bucket_rows))))))

    def bucketed(asks: bool):
        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for piece in _pieces(batches):
                for b, part in piece.groupby("bits"):
                    tables, probes = plan.get(int(b), (1, 1))
                    place, flat = np.array(part["place"].tolist(), dtype=np.float64), part.drop(columns=["bits", "place"])
                    for t in range(tables if b else 1):
                        spots = place @ planes[t][:, :int(b)]
                        if not asks:
                            key = _probes(spots, 1)[:, 0]
                            yield flat.assign(cell=(t << MAX_BITS) + (key >> shift), key=key)
                            continue
                        for start in range(0, len(flat), AT_ONCE):
                            shelves = np.sort(_probes(spots[start:start + AT_ONCE], probes) >> shift, axis=1)
                            new = np.ones(shelves.shape, bool)
                            new[:, 1:] = np.diff(shelves, axis=1) != 0
                            who, which = np.nonzero(new)
                            out = flat.iloc[start + who]
                            yield out.assign(cell=(t << MAX_BITS) + shelves[who, which], at=[r.tobytes() for r in spots[start + who]], probes=np.int32(probes))
        return task

    def spots(part: DataFrame, asks: bool) -> DataFrame:
        fields = [f for f in part.schema.fields if f.name not in ("bits", "place")]
        fields += [T.StructField("cell", T.LongType())]
        fields += [T.StructField("at", T.BinaryType()), T.StructField("probes", T.IntegerType())] if asks else [T.StructField("key", T.LongType())]
        return part.mapInPandas(bucketed(asks), T.StructType(fields))

    found = _compare(spots(queries, True), spots(targets, False), k, size, schema, shift=shift)
    return _spread(cut_lineage(found.distinct()), crowd, alike, k, scene, kind)
