"""Exact matching against brute force, with blocks and pivots forced and many copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgrain.operators import match as m
from reelgrain.operators.components import components


def features(spark, seed=5):
    """A hot scene with near copies and 40 exact copies, a small scene, and a scene of one."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(120):
        rows.append((i, 0, (centres[i % 6] + 0.05 * rng.normal(size=8)).tolist()))
    rows += [(200 + i, 0, centres[0].tolist()) for i in range(40)]
    rows += [(300 + i, 1, rng.normal(size=8).tolist()) for i in range(9)]
    rows.append((400, 2, centres[1].tolist()))
    rows += [(500 + i, None, centres[2].tolist()) for i in range(3)]
    return spark.createDataFrame(rows, "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>")


def brute(df, k):
    rows = df.collect()
    unit = {r.vec_id: np.array(r.embedding, dtype=np.float64) / np.linalg.norm(np.array(r.embedding, dtype=np.float64)) for r in rows}
    out = []
    for a in rows:
        scored = sorted((-round(float(unit[a.vec_id] @ unit[b.vec_id]), 9), b.vec_id) for b in rows
                        if a.label is not None and b.label == a.label and b.vec_id != a.vec_id)
        out += [(a.label, a.vec_id, dst, i + 1) for i, (_, dst) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "pivots"), [(1000, None), (16, 1), (16, 7), (50, None)])
def test_nearest_is_exact(spark, block_rows, pivots):
    df = features(spark)
    got = m.nearest(df, "vec_id", "label", "embedding", 2, block_rows=block_rows, pivots=pivots)
    assert sorted(tuple(r) for r in got.select("label", "src", "dst", "rank").collect()) == brute(df, 2)


def test_copies_do_not_multiply(spark):
    """All copies beyond k + 1 share one search: the compared rows stay few."""
    df = spark.range(3000).select("id", F.lit(1).alias("scene"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    got = m.nearest(df, "id", "scene", "v", 2, block_rows=100)
    assert got.count() == 6000
    assert got.where("src > 2").select("dst").distinct().count() == 2


def test_ratio_and_mutual(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [0.99, 0.05]), (3, 0, [0.0, 1.0]), (4, 0, [0.3, 1.0])],
                               "id BIGINT, scene INT, v ARRAY<DOUBLE>")
    pairs = sorted((r.src, r.dst) for r in m.match(df, "id", "scene", "v", 0.8).collect())
    assert pairs == [(1, 2), (3, 4)]
    assert m.match(df, "id", "scene", "v", 0.01).count() == 0


def test_approximate_finds_copies(spark):
    got = m.approx_nearest(features(spark), "vec_id", "label", "embedding", 2)
    assert got.where("src >= 200 AND src < 240 AND rank = 1 AND score > 0.999").count() == 40


def test_approximate_is_exact_in_small_scenes(spark):
    rows = features(spark).where("label IS NOT NULL")
    lists = [{tuple(r) for r in f(rows, "vec_id", "label", "embedding", 2).select("src", "dst", "rank").collect()} for f in (m.nearest, m.approx_nearest)]
    assert lists[0] == lists[1]


def test_pair_counts(spark):
    got = {r.label: (r.images, r.pairs) for r in m.pair_counts(features(spark), "label").collect()}
    assert got == {0: (160, 160 * 159 // 2), 1: (9, 36), 2: (1, 0), None: (3, 3)}


def test_components(spark):
    path = [(i, i + 1) for i in range(64)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    extra = [(500, 500), (90, 80), (81, 90), (80, 81)]
    edges = spark.createDataFrame(path + star + extra, "a BIGINT, b BIGINT")
    got = {r.node: r.component for r in components(edges, "a", "b").collect()}
    assert all(got[i] == 0 for i in range(65))
    assert all(got[1000 + i] == 1000 for i in range(300))
    assert (got[500], got[80], got[81], got[90]) == (500, 80, 80, 80)
    with pytest.raises(RuntimeError):
        components(edges, "a", "b", max_rounds=1)


def test_components_of_text_ids(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "y")], "s STRING, d STRING")
    got = {r.node: r.component for r in components(edges, "s", "d").collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}


def unstructured(spark):
    """Vectors without clusters, of two scenes, some of them copies."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 16))
    x[350:] = x[:50]
    return spark.createDataFrame([(i, i % 5 == 0, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, label BOOLEAN, embedding ARRAY<FLOAT>")


@pytest.mark.parametrize("rows", [30, 400])
def test_nearest_across_blocks(spark, monkeypatch, rows):
    monkeypatch.setattr(m, "BLOCK_BYTES", rows * 16 * 4)
    monkeypatch.setattr(m, "LEAST_QUERIES", 50)
    monkeypatch.setattr(m, "PIECE_ROWS", 32)
    df = unstructured(spark)
    got = m.nearest(df, "vec_id", "label", "embedding", 3)
    assert sorted(tuple(r) for r in got.select("label", "src", "dst", "rank").collect()) == brute(df, 3)


@pytest.mark.parametrize("shift", [0, 2, 14])
def test_shelves_of_buckets_give_the_same_lists(spark, monkeypatch, shift):
    df = unstructured(spark)
    want = {tuple(r) for r in m.approx_nearest(df, "vec_id", "label", "embedding", 2, bucket_rows=8, recall=0.6).collect()}
    monkeypatch.setattr(m, "MAX_SHIFT", shift)
    monkeypatch.setattr(m, "BLOCK_BYTES", 1 << 20)
    assert {tuple(r) for r in m.approx_nearest(df, "vec_id", "label", "embedding", 2, bucket_rows=8, recall=0.6).collect()} == want


def test_images_without_a_vector_match_nothing(spark):
    df = features(spark).union(spark.createDataFrame([(900, 0, None), (901, 0, [])], "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>"))
    got = m.nearest(df, "vec_id", "label", "embedding", 2)
    assert sorted(tuple(r) for r in got.select("label", "src", "dst", "rank").collect()) == brute(features(spark), 2)
