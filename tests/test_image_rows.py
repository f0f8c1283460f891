"""Statistics of images that are rows, and volumes of points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgrain.operators import geometry as g


def test_entropy_of_rows(spark):
    rng = np.random.default_rng(3)
    images = [(i, rng.integers(0, 1 << k, 64).astype(np.uint8).tobytes()) for i, k in enumerate((1, 3, 8))] + [(5, b""), (6, None), (7, b"\x07" * 9)]
    got = {r.id: r.entropy for r in g.image_entropy(spark.createDataFrame(images, "id INT, d BINARY"), "id", "d").collect()}
    for i, raw in images:
        if not raw:
            assert got[i] is None
            continue
        p = np.bincount(np.frombuffer(raw, np.uint8)) / len(raw)
        assert got[i] == pytest.approx(-sum(x * np.log2(x) for x in p if x))


@pytest.mark.parametrize(("block", "step"), [(4, 4), (4, 1), (3, 2), (8, 8)])
def test_similarity(block, step):
    rng = np.random.default_rng(block + step)
    a = rng.integers(0, 256, (8, 10)).astype(float)
    b = np.clip(a + rng.normal(0, 30, a.shape), 0, 255)
    c1, c2, scores = 2.55**2, 7.65**2, []
    for y in range(0, 8 - block + 1, step):
        for x in range(0, 10 - block + 1, step):
            p, q = a[y:y + block, x:x + block], b[y:y + block, x:x + block]
            cov = ((p - p.mean()) * (q - q.mean())).mean()
            scores.append((2 * p.mean() * q.mean() + c1) * (2 * cov + c2) / ((p.mean()**2 + q.mean()**2 + c1) * (p.var() + q.var() + c2)))
    assert g.similarity(a, b, block, step, 255.0) == pytest.approx(np.mean(scores))


def test_ssim_of_rows(spark):
    flat, ramp = bytes([9] * 64), bytes(range(64))
    a = spark.createDataFrame([(1, ramp, 8), (2, flat, 8), (3, ramp, 8), (4, ramp, 7), (5, ramp, 8), (6, b"ab", 2), (7, None, 8)], "id INT, d BINARY, w INT")
    b = spark.createDataFrame([(1, ramp, 8), (2, ramp, 8), (3, ramp, 16), (4, ramp, 7), (6, b"ab", 2), (7, ramp, 8)], "id INT, d BINARY, w INT")
    got = {r.id: (r.ssim, r.accepted) for r in g.image_ssim(a, b, "id", "d", "w").collect()}
    assert got.keys() == {1, 2, 3, 4, 6, 7} and got[1] == (pytest.approx(1.0), True) and got[2][0] < 0.1 and not got[2][1]
    assert all(got[i] == (None, None) for i in (3, 4, 6, 7))


def test_rows_agree_with_pixels(spark):
    rows = spark.range(6).select("id", F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("d"), F.lit(16).alias("w"))
    other = rows.withColumn("d", F.sha2(F.concat("id", F.lit("x")), 512).cast("binary"))

    def pixels(df):
        return df.select("id", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(128)), lambda i: F.ascii(F.col("d").substr(i, F.lit(1)).cast("string")))).alias("at", "v")).select(
            "id", (F.col("at") % 16).alias("x"), F.floor(F.col("at") / 16).alias("y"), "v")

    for mine, theirs in ((g.image_entropy(rows, "id", "d"), g.entropy(pixels(rows), "id", "v")),
                         (g.image_ssim(rows, other, "id", "d", "w"), g.ssim(pixels(rows), pixels(other), "id", "x", "y", "v"))):
        a, b = [{r[0]: r[1] for r in df.collect()} for df in (mine, theirs)]
        assert a == {k: pytest.approx(v) for k, v in b.items()} and len(a) == 6


def test_vertex_density(spark):
    points = [("cube", x / 4, y / 4, z / 4) for x in range(8) for y in range(8) for z in range(8)] + [("flat", x / 4, 1.0, x / 8) for x in range(9)]
    points += [("one", 1.0, 1.0, 1.0)] * 5 + [("two", 0.1, 0.1, 0.1), ("two", -0.1, -0.1, -0.1), ("two", None, 0.0, 0.0), (None, 0.0, 0.0, 0.0), (None, 2.0, 2.0, 2.0)]
    got = {r.m: tuple(r)[1:] for r in g.vertex_density(spark.createDataFrame(points, "m STRING, x DOUBLE, y DOUBLE, z DOUBLE"), ["m"], 0.5).collect()}
    assert got == {"cube": (512, 8.0, 64.0), "flat": (9, None, None), "one": (5, None, None), "two": (2, 0.25, 8.0), None: (2, 0.25, 8.0)}
