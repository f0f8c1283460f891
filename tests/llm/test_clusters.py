"""Clustering by corrected products beside the plain definition."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgrain.llm import clusters, queries

SCHEMA = "vec_id bigint, embedding array<float>, dots string, cluster int"


def brute(rows, k, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * float(np.float32(v))) for v in e]) for i, e in rows
            if e is not None and len(e) == dim and all(v is not None and math.isfinite(v) for v in e)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [x for _, x in sorted(kept, key=name)[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        for n, xs in groups.items():
            centres[n] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    found = [(i, *near(x)[::-1]) for i, x in kept]
    each = {}
    for _, c, d in found:
        each[c] = each.get(c, 0) + d
    return sorted(((i, c, d, each[c], sum(each.values()), centres[c]) for i, c, d in found), key=repr)


def rows_of(dim, n, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, list(rows[4][1])) for i in range(n // 3)]
    rows += [(900, None), (901, [None] + [0.1] * (dim - 1)), (902, [math.nan] + [0.1] * (dim - 1)), (903, [math.inf] * dim), (904, [0.5] * (dim + 1)),
             (905, []), (906, [0.0] * dim), (907, [300.0] * dim), (None, [0.25] * dim), (5, list(rows[5][1])), (5, list(rows[6][1]))]
    return rows


@pytest.mark.parametrize("k, dim, n", [(5, 4, 60), (40, 8, 30), (200, 3, 20)])
def test_equals_the_definition(spark, k, dim, n):
    rows = rows_of(dim, n)
    df = spark.createDataFrame([(i, e, "x", 3) for i, e in rows], SCHEMA).repartition(5)
    out = clusters.cluster(df, k=k, rounds=4, dim=dim)
    assert sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in out.collect()), key=repr) \
        == brute(rows, k, 4, dim, 256, 2)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None, "x", 3), (2, [1.0], "x", 3)], SCHEMA)
    assert clusters.cluster(df, dim=4).count() == 0
    assert clusters.cluster(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_a_component_too_large_ends_the_job(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], "x", 3), (2, [1.0, 1.0], "x", 3)], SCHEMA)
    with pytest.raises(Exception, match="component too large"):
        clusters.cluster(df, dim=2).collect()


def test_corrections_are_exact():
    rng = np.random.default_rng(4)
    for high in (5, 1 << 26):
        x = rng.integers(-high, high, (50, 8))
        before, after = rng.integers(-high, high, (6, 8)), rng.integers(-high, high, (6, 8))
        after[0] = before[0]
        after[1, 1:] = before[1, 1:]
        changes = (after - before).T
        want = (x.astype(object) @ after.T.astype(object)).tolist()
        assert clusters.corrected(x, clusters.product(x, before.T), changes).tolist() == want
        few = np.zeros_like(changes)
        few[2, 3] = changes[2, 3]
        want = (x.astype(object) @ (before.T + few).astype(object)).tolist()
        assert clusters.corrected(x, clusters.product(x, before.T), few).tolist() == want


def test_query(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.select("vec_id", F.col("embedding")).collect()], 40, 5, 64, 256, 2)
    want = {r[0]: (*r[1:5], hashlib.sha256(",".join(map(str, r[5])).encode()).hexdigest()) for r in want}
    got = {r.vec_id: (r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in queries.QUERIES["op12_clusters"](spark, folder).collect()}
    assert got == want
