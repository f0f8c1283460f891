"""Pixel statistics, pose and point errors, point fusion and heatmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MAX_POSE_ERROR_M, MAX_RMSE_M, MIN_ENTROPY_BITS, MIN_SSIM


def entropy(pixels: DataFrame, image: str, value: str, least: float = MIN_ENTROPY_BITS) -> DataFrame:
    """Bits per pixel of each image's value distribution, from value counts."""
    counts = pixels.groupBy(image, value).agg(F.count(F.lit(1)).alias("_n"))
    total, weighted = F.sum("_n"), F.sum(F.col("_n") * F.log2("_n"))
    bits = counts.groupBy(image).agg((F.log2(total) - weighted / total).alias("entropy"))
    return bits.withColumn("alert", F.col("entropy") < F.lit(least))


def ssim(a: DataFrame, b: DataFrame, image: str, x: str, y: str, value: str, block: int = 8, peak: float = 255.0,
         least: float = MIN_SSIM) -> DataFrame:
    """Mean structural similarity per image over square blocks (Wang et al. 2004)."""
    c1, c2 = F.lit((0.01 * peak) ** 2), F.lit((0.03 * peak) ** 2)
    at = [image, x, y]
    paired = a.select(*at, F.col(value).cast("double").alias("_a")).join(
        b.select(*at, F.col(value).cast("double").alias("_b")), at)
    cell = [F.floor(F.col(x) / block).alias("_bx"), F.floor(F.col(y) / block).alias("_by")]
    stats = paired.groupBy(image, *cell).agg(
        F.avg("_a").alias("ma"), F.avg("_b").alias("mb"), F.var_pop("_a").alias("va"), F.var_pop("_b").alias("vb"),
        F.covar_pop("_a", "_b").alias("cov"))
    ma, mb, va, vb, cov = (F.col(c) for c in ("ma", "mb", "va", "vb", "cov"))
    score = ((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    return stats.groupBy(image).agg(F.avg(score).alias("ssim")).withColumn("accepted", F.col("ssim") > F.lit(least))


def image_entropy(images: DataFrame, image: str, data: str, least: float = MIN_ENTROPY_BITS) -> DataFrame:
    """`entropy` of images that are rows: `data` holds one byte per pixel. One row per image, in its task; null for no pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for raw in batch.column("data"):
                n = np.bincount(np.frombuffer(raw.as_py() or b"", np.uint8))
                n = n[n > 0]
                bits.append(float(np.log2(n.sum()) - (n * np.log2(n)).sum() / n.sum()) if len(n) else None)
            yield pa.RecordBatch.from_arrays([batch.column("image"), pa.array(bits, pa.float64())], ["image", "entropy"])

    rows = images.select(F.col(image).alias("image"), F.col(data).alias("data"))
    bits = rows.mapInArrow(run, T.StructType([T.StructField("image", images.schema[image].dataType), T.StructField("entropy", T.DoubleType())]))
    return bits.select(F.col("image").alias(image), "entropy", (F.col("entropy") < F.lit(least)).alias("alert"))


def _sums(pixels: np.ndarray, block: int, step: int) -> np.ndarray:
    """Sums over all blocks, from a summed-area table: four corners each, whatever the size of a block."""
    table = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1))
    table[1:, 1:] = pixels.cumsum(axis=0).cumsum(axis=1)
    return (table[block::step, block::step] - table[:-block:step, block::step] - table[block::step, :-block:step] + table[:-block:step, :-block:step])


def similarity(a: np.ndarray, b: np.ndarray, block: int, step: int, peak: float) -> float | None:
    """Mean structural similarity of two grey images over blocks at every `step` pixels; None where no block fits."""
    if min(a.shape) < block:
        return None
    c1, c2, n = (0.01 * peak) ** 2, (0.03 * peak) ** 2, block * block
    ma, mb = _sums(a, block, step) / n, _sums(b, block, step) / n
    va, vb = _sums(a * a, block, step) / n - ma * ma, _sums(b * b, block, step) / n - mb * mb
    cov = _sums(a * b, block, step) / n - ma * mb
    return float((((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))).mean())


def image_ssim(a: DataFrame, b: DataFrame, image: str, data: str, width: str, block: int = 8, step: int | None = None, peak: float = 255.0,
               least: float = MIN_SSIM) -> DataFrame:
    """`ssim` of images that are rows, with one byte per pixel in `data` and their `width`; images of one side are left out.

    Blocks lie `step` pixels apart, by default side by side; what is left at the edges counts in no block. The result is null where
    sizes differ or no block fits. Rows of images are joined, never pixels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for one, two, wide, other in zip(*(batch.column(c) for c in ("one", "two", "w1", "w2")), strict=True):
                x, y, wide = one.as_py() or b"", two.as_py() or b"", wide.as_py()
                fits = wide and wide == other.as_py() and len(x) == len(y) and len(x) % wide == 0
                scores.append(similarity(*[np.frombuffer(p, np.uint8).astype(float).reshape(-1, wide) for p in (x, y)], block, step or block, peak) if fits else None)
            yield pa.RecordBatch.from_arrays([batch.column("image"), pa.array(scores, pa.float64())], ["image", "ssim"])

    sides = [d.select(F.col(image).alias("image"), F.col(data).alias(n), F.col(width).alias(w)) for d, n, w in ((a, "one", "w1"), (b, "two", "w2"))]
    schema = T.StructType([T.StructField("image", a.schema[image].dataType), T.StructField("ssim", T.DoubleType())])
    found = sides[0].join(sides[1], "image").mapInArrow(run, schema)
    return found.select(F.col("image").alias(image), "ssim", (F.col("ssim") > F.lit(least)).alias("accepted"))


def vertex_density(points: DataFrame, keys: list[str], size: float, axes: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """`*keys, vertices, volume, density`: vertices by the volume of the cubes of side `size` that hold any.

    Points are counted by cube before the shuffle, so a model is as many rows as it has cubes. Points with a null coordinate
    are left out; a model without extent along an axis has no volume, and no density.
    """
    clean = points.dropna(subset=list(axes)).select(*keys, *[F.col(c).cast("double").alias(c) for c in axes])
    cube = [F.floor(F.col(c) / F.lit(float(size))).alias(f"_{c}") for c in axes]
    ends = [f(c).alias(f"_{n}_{c}") for c in axes for n, f in (("low", F.min), ("high", F.max))]
    cubes = clean.groupBy(*keys, *cube).agg(F.count(F.lit(1)).alias("_n"), *ends)
    flat = F.lit(False)
    for c in axes:
        flat = flat | (F.min(f"_low_{c}") == F.max(f"_high_{c}"))
    volume = F.when(~flat, F.count(F.lit(1)) * F.lit(float(size) ** len(axes)))
    found = cubes.groupBy(*keys).agg(F.sum("_n").alias("vertices"), volume.alias("volume"))
    return found.withColumn("density", F.col("vertices") / F.col("volume"))


def _squared_distance(axes: tuple[str, ...]) -> Column:
    total = F.lit(0.0)
    for c in axes:
        gap = F.col(f"p_{c}") - F.col(f"t_{c}")
        total = total + gap * gap
    return total


def _paired(pred: DataFrame, truth: DataFrame, key: str, axes: tuple[str, ...], keep: list[str]) -> DataFrame:
    p = pred.select(key, *keep, *[F.col(c).cast("double").alias(f"p_{c}") for c in axes])
    t = truth.select(key, *[F.col(c).cast("double").alias(f"t_{c}") for c in axes])
    return p.join(t, key)


def pose_errors(pred: DataFrame, truth: DataFrame, key: str, axes: tuple[str, ...] = ("x", "y", "z"),
                keep: list[str] | None = None) -> DataFrame:
    """Distance between each predicted and surveyed position."""
    keep = keep or []
    return _paired(pred, truth, key, axes, keep).select(
        key, *keep, F.sqrt(_squared_distance(axes)).alias("error"))


def pose_mae(pred: DataFrame, truth: DataFrame, key: str, keys: list[str] | None = None,
             axes: tuple[str, ...] = ("x", "y", "z"), limit: float = MAX_POSE_ERROR_M) -> DataFrame:
    """Mean position error per group (or overall) and whether it calls for recalibration."""
    keys = keys or []
    errors = pose_errors(pred, truth, key, axes, keys)
    return errors.groupBy(*keys).agg(F.avg("error").alias("mae")).withColumn("recalibrate", F.col("mae") > F.lit(limit))


def rmse(pred: DataFrame, truth: DataFrame, key: str, keys: list[str] | None = None,
         axes: tuple[str, ...] = ("x", "y", "z"), limit: float = MAX_RMSE_M) -> DataFrame:
    """Root mean square point error per group (or overall) and whether it is accepted."""
    keys = keys or []
    errors = pose_errors(pred, truth, key, axes, keys)
    value = F.sqrt(F.avg(F.col("error") * F.col("error")))
    return errors.groupBy(*keys).agg(value.alias("rmse")).withColumn("accepted", F.col("rmse") < F.lit(limit))


def voxel_fuse(points: DataFrame, size: float, scene: str, axes: tuple[str, ...] = ("x", "y", "z"),
               colours: tuple[str, ...] = ()) -> DataFrame:
    """Merge the points of each voxel to their mean, with the number merged."""
    cell = [F.floor(F.col(c) / F.lit(float(size))).cast("long").alias(f"v{c}") for c in axes]
    means = [F.avg(c).alias(c) for c in (*axes, *colours)]
    return points.groupBy(scene, *cell).agg(*means, F.count(F.lit(1)).alias("merged"))


def heatmap(df: DataFrame, x: str, y: str, bins: int, value: str) -> DataFrame:
    """Mean value in each cell of a `bins` x `bins` grid over the data's extent."""
    span = df.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))).scalar()

    def cell(c: str, lo: str, hi: str) -> Column:
        width = span[hi] - span[lo]
        raw = F.when(width > 0, F.floor((F.col(c) - span[lo]) / width * bins)).otherwise(F.lit(0))
        return F.least(raw, F.lit(bins - 1)).cast("long")

    placed = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        cell(x, "x0", "x1").alias("bin_x"), cell(y, "y0", "y1").alias("bin_y"), F.col(value).alias("_v"))
    return placed.groupBy("bin_x", "bin_y").agg(F.avg("_v").alias("avg_value"), F.count("_v").alias("n"))
