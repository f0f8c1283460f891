"""Image kernel queries on 8 x 8 grey images made from `embeddings`."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import images as im
from .registry import Tables, query


def grey_images(t: Tables):
    """Image rows as the image source gives them, with elements quantised to bytes."""
    level = F.transform("embedding", lambda v: F.lpad(F.hex(F.floor((v.cast("double") + 1) * 127).cast("long")), 2, "0"))
    data = F.unhex(F.array_join(level, "")).alias("data")
    return t.embeddings.select("vec_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), data)


def bytes_as_rows(df):
    """One row per byte of the image data."""
    at = F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1))
    rows = df.select("vec_id", "width", "data", at.alias("pos"))
    value = F.conv(F.hex(F.expr("substring(data, pos + 1, 1)")), 16, 10).cast("int")
    return rows.select("vec_id", (F.col("pos") % F.col("width")).alias("x"), F.floor(F.col("pos") / F.col("width")).alias("y"), value.alias("value"))


GREY = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor((CAST(v AS DOUBLE) + 1) * 127) AS INTEGER)) AS px FROM embeddings)
"""


@query("p7_resize_nearest", GREY + """
SELECT vec_id, x, y, px[(y * 8 // 6) * 8 + (x * 8 // 12) + 1] AS value
FROM (SELECT vec_id, px, unnest(range(0, 12)) AS x FROM c) a, (SELECT unnest(range(0, 6)) AS y) b
""")
def p7(t: Tables):
    return bytes_as_rows(im.resize(grey_images(t), 12, 6, "nearest"))


@query("x1_resize_column", GREY + """
SELECT vec_id, x, y, px[y * 2 * 8 + x * 2 + 1] AS value
FROM (SELECT vec_id, px, unnest(range(0, 4)) AS x FROM c) a, (SELECT unnest(range(0, 4)) AS y) b
""")
def x1(t: Tables):
    small = im.resize_udf(4, 4, "nearest")("data", "height", "width", "nChannels")
    sized = grey_images(t).select("vec_id", small.alias("data"), F.lit(4).alias("height"), F.lit(4).alias("width"))
    return bytes_as_rows(sized)


@query("p8_normalise_pixels", GREY + """
SELECT vec_id, y * 6 + x AS position, round((px[(y + 1) * 8 + (x + 1) + 1] / 255.0 - 0.5) / 0.25, 4) AS value
FROM (SELECT vec_id, px, unnest(range(0, 6)) AS x FROM c) a, (SELECT unnest(range(0, 6)) AS y) b
""")
def p8(t: Tables):
    tensors = im.normalise_pixels(grey_images(t), 8, 6, (0.5,), (0.25,))
    rows = tensors.select("vec_id", F.posexplode("tensor").alias("position", "v"))
    return rows.select("vec_id", "position", F.round(F.col("v").cast("double"), 4).alias("value"))


def norm_model():
    """A deterministic stand-in for a feature model: norm and strongest element."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        rows = np.asarray(batch["embedding"].tolist(), dtype=np.float64)
        return pd.DataFrame({"vec_id": batch["vec_id"], "norm": np.sqrt((rows * rows).sum(axis=1)), "strongest": rows.argmax(axis=1)})

    return run


@query("x2_x5_feature_model", """
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT vec_id, round(sqrt(list_inner_product(v, v)), 6) AS norm, list_position(v, list_max(v)) - 1 AS strongest FROM u
""")
def x2(t: Tables):
    rows = im.infer(t.embeddings.select("vec_id", "embedding"), norm_model, "vec_id BIGINT, norm DOUBLE, strongest BIGINT")
    return rows.withColumn("norm", F.round("norm", 6))


def bright_spots(limit: float):
    """A deterministic stand-in for a detector: one unit box per element above a limit."""

    def factory():
        def run(batch: pd.DataFrame) -> pd.DataFrame:
            found = []
            for row in batch["embedding"]:
                spots = np.flatnonzero(row > np.float32(limit))
                found.append([
                    {"bbox": [float(p % 8), float(p // 8), float(p % 8 + 1), float(p // 8 + 1)], "confidence": float(row[p]), "class_id": int(p % 3)}
                    for p in spots])
            return pd.DataFrame({"vec_id": batch["vec_id"], "detections": found})

        return run

    return factory


@query("x3_detector", """
WITH s AS (SELECT vec_id, i - 1 AS p, embedding[i] AS v FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)),
d AS (SELECT * FROM s WHERE v > CAST(0.25 AS FLOAT))
SELECT e.vec_id, (p % 8)::DOUBLE AS x1, (p // 8)::DOUBLE AS y1, v::DOUBLE AS confidence, (p % 3)::INTEGER AS class_id
FROM embeddings e LEFT JOIN d ON d.vec_id = e.vec_id
""")
def x3(t: Tables):
    schema = "vec_id BIGINT, detections ARRAY<STRUCT<bbox: ARRAY<FLOAT>, confidence: FLOAT, class_id: INT>>"
    rows = im.infer(t.embeddings.select("vec_id", "embedding"), bright_spots(0.25), schema)
    flat = im.explode_detections(rows, "detections", ["vec_id"])
    return flat.select("vec_id", F.col("bbox")[0].cast("double").alias("x1"), F.col("bbox")[1].cast("double").alias("y1"),
                       F.col("confidence").cast("double").alias("confidence"), "class_id")
