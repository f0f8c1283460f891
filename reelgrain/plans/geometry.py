"""Pixel, pose and point queries: vector elements as pixels and coordinates."""

from pyspark.sql import functions as F

from ..operators import geometry as g
from .registry import ORACLES, Tables, cents, query


def pixels(t: Tables, levels: int, out: str = "value"):
    """Vector elements as an 8-wide image with `levels` grey values per unit."""
    cells = t.embeddings.select(F.col("vec_id").alias("image"), F.posexplode("embedding").alias("pos", "v"))
    value = F.floor((F.col("v").cast("double") + 1) * levels).cast("long")
    return cells.select("image", (F.col("pos") % 8).alias("x"), F.floor(F.col("pos") / 8).alias("y"), value.alias(out))


PIXELS = """
WITH c AS (SELECT vec_id AS image, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS v
           FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))
"""


@query("e17_texture_entropy", PIXELS + """
, n AS (SELECT image, CAST(floor((v + 1) * 32) AS BIGINT) AS value, count(*) AS n FROM c GROUP BY 1, 2),
p AS (SELECT image, n / sum(n) OVER (PARTITION BY image) AS p FROM n)
SELECT image, round(-sum(p * log2(p)), 6) AS entropy, -sum(p * log2(p)) < 3.0 AS alert FROM p GROUP BY image
""")
def e17(t: Tables):
    return g.entropy(pixels(t, 32), "image", "value", 3.0).withColumn("entropy", F.round("entropy", 6))


@query("e20_ssim", PIXELS + """
, p AS (SELECT image, pos % 8 AS x, pos // 8 AS y, floor((v + 1) * 128) AS a, floor((v + 1) * 8) * 16 AS b FROM c),
s AS (SELECT image, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS cov
      FROM p GROUP BY image, x // 4, y // 4)
SELECT image, round(avg((2 * ma * mb + 6.5025) * (2 * cov + 58.5225) / ((ma * ma + mb * mb + 6.5025) * (va + vb + 58.5225))), 6) AS ssim,
       avg((2 * ma * mb + 6.5025) * (2 * cov + 58.5225) / ((ma * ma + mb * mb + 6.5025) * (va + vb + 58.5225))) > 0.92 AS accepted
FROM s GROUP BY image
""")
def e20(t: Tables):
    coarse = pixels(t, 8).withColumn("value", F.col("value") * 16)
    return g.ssim(pixels(t, 128), coarse, "image", "x", "y", "value", block=4).withColumn("ssim", F.round("ssim", 6))


def images(t: Tables, scale: int, times: int = 1):
    """Vectors as grey images of 8 x 8 pixels, one byte each."""
    byte = F.transform("embedding", lambda v: F.lpad(F.hex((F.floor((v.cast("double") + 1) * scale) * times).cast("long")), 2, "0"))
    return t.embeddings.select(F.col("vec_id").alias("image"), F.unhex(F.array_join(byte, "")).alias("data"), F.lit(8).alias("width"))


@query("e17_entropy_of_images", ORACLES["e17_texture_entropy"])
def e17_images(t: Tables):
    return g.image_entropy(images(t, 32), "image", "data", 3.0).withColumn("entropy", F.round("entropy", 6))


@query("e20_ssim_of_images", ORACLES["e20_ssim"])
def e20_images(t: Tables):
    return g.image_ssim(images(t, 128), images(t, 8, 16), "image", "data", "width", block=4).withColumn("ssim", F.round("ssim", 6))


@query("e16_density_by_volume", """
WITH p AS (SELECT label, embedding[64] < 0 AS old, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
d AS (SELECT label, old, count(*) AS n, count(DISTINCT (floor(x / 0.125), floor(y / 0.125), floor(z / 0.125))) * CAST(0.125 AS DOUBLE) * 0.125 * 0.125 AS volume,
             min(x) = max(x) OR min(y) = max(y) OR min(z) = max(z) AS flat FROM p GROUP BY label, old)
SELECT label, old, n AS vertices, CASE WHEN NOT flat THEN round(volume, 6) END AS volume, CASE WHEN NOT flat THEN round(n / volume, 4) END AS density FROM d
""")
def e16_volume(t: Tables):
    axes = [F.col("embedding")[i].alias(c) for i, c in enumerate("xyz")]
    found = g.vertex_density(t.embeddings.select("label", (F.col("embedding")[63] < 0).alias("old"), *axes), ["label", "old"], 0.125)
    return found.withColumns({"volume": F.round("volume", 6), "density": F.round("density", 4)})


def poses(t: Tables, digits: int | None = None):
    """First three elements as a position; with `digits`, as surveyed on a grid."""
    axes = [F.col("embedding")[i].cast("double") for i in range(3)]
    if digits is not None:
        axes = [F.floor(a * 10**digits + 0.5) / 10**digits for a in axes]
    return t.embeddings.select("vec_id", "label", *[a.alias(n) for a, n in zip(axes, "xyz")])


POSES = """
WITH p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
d AS (SELECT vec_id, label, sqrt((x - floor(x * 10 + 0.5) / 10)**2 + (y - floor(y * 10 + 0.5) / 10)**2
             + (z - floor(z * 10 + 0.5) / 10)**2) AS error FROM p)
"""


@query("j10_pose_errors", POSES + "SELECT vec_id, round(error, 6) AS error FROM d")
def j10(t: Tables):
    return g.pose_errors(poses(t), poses(t, 1), "vec_id").withColumn("error", F.round("error", 6))


@query("e18_pose_mae", POSES + "SELECT label, round(avg(error), 6) AS mae, avg(error) > 0.05 AS recalibrate FROM d GROUP BY label")
def e18(t: Tables):
    return g.pose_mae(poses(t), poses(t, 1), "vec_id", ["label"], limit=0.05).withColumn("mae", F.round("mae", 6))


@query("e19_point_rmse", POSES + "SELECT round(sqrt(avg(error * error)), 6) AS rmse, sqrt(avg(error * error)) < 0.005 AS accepted FROM d")
def e19(t: Tables):
    return g.rmse(poses(t), poses(t, 1), "vec_id").withColumn("rmse", F.round("rmse", 6))


@query("e22_voxel_fusion", """
WITH p AS (SELECT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)
SELECT label, CAST(floor(x / 0.125) AS BIGINT) AS vx, CAST(floor(y / 0.125) AS BIGINT) AS vy, CAST(floor(z / 0.125) AS BIGINT) AS vz,
       round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, count(*) AS merged
FROM p GROUP BY 1, 2, 3, 4
""")
def e22(t: Tables):
    fused = g.voxel_fuse(poses(t), 0.125, "label")
    return fused.withColumns({c: F.round(c, 6) for c in "xyz"})


@query("e23_quality_heatmap", """
WITH b AS (SELECT min(o_totalprice) AS x0, max(o_totalprice) AS x1, min(o_custkey) AS y0, max(o_custkey) AS y1 FROM orders),
c AS (SELECT CAST(least(floor((o_totalprice - x0) / (x1 - x0) * 16), 15) AS BIGINT) AS bin_x,
             CAST(least(floor((o_custkey - y0)::DOUBLE / (y1 - y0) * 16), 15) AS BIGINT) AS bin_y,
             CAST(round(o_totalprice * 100) AS BIGINT) AS v FROM orders, b)
SELECT bin_x, bin_y, round(avg(v), 4) AS avg_value, count(*) AS n FROM c GROUP BY bin_x, bin_y
""")
def e23(t: Tables):
    cells = g.heatmap(t.orders.withColumn("cost", cents("o_totalprice")), "o_totalprice", "o_custkey", 16, "cost")
    return cells.withColumn("avg_value", F.round("avg_value", 4))
