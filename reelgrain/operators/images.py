"""Frame preprocessing and model hooks, on Arrow batches of image rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import PandasUDFType

from ..constants import CHANNEL_MEAN, CHANNEL_STD, FRAME_SIZE, INPUT_CROP, INPUT_RESIZE
from ..sources.objects import read_images

IMAGE_BATCH = 64


def _taps(size: int, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two source positions and a weight per target position, on pixel centres."""
    at = np.clip((np.arange(target) + 0.5) * size / target - 0.5, 0, size - 1)
    low = np.floor(at).astype(np.int64)
    return low, np.minimum(low + 1, size - 1), at - low


def scale_image(pixels: np.ndarray, width: int, height: int, method: str) -> np.ndarray:
    """Height x width x channels array at a new size."""
    rows, cols = pixels.shape[:2]
    if method == "nearest":
        y = (np.arange(height) * rows) // height
        x = (np.arange(width) * cols) // width
        return pixels[y][:, x]
    if method != "bilinear":
        raise ValueError(f"unknown method {method!r}")
    y0, y1, wy = _taps(rows, height)
    x0, x1, wx = _taps(cols, width)
    source = pixels.astype(np.float64)
    across = source[:, x0] * (1 - wx)[None, :, None] + source[:, x1] * wx[None, :, None]
    return across[y0] * (1 - wy)[:, None, None] + across[y1] * wy[:, None, None]


def _pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)


def resize(df: DataFrame, width: int = FRAME_SIZE[0], height: int = FRAME_SIZE[1], method: str = "bilinear") -> DataFrame:
    """Image rows (height, width, nChannels, data) at one size; other columns stay."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sized = []
            for data, rows, cols, channels in zip(batch["data"], batch["height"], batch["width"], batch["nChannels"]):
                scaled = scale_image(_pixels(data, rows, cols, channels), width, height, method)
                sized.append(np.rint(scaled).astype(np.uint8).tobytes())
            yield batch.assign(data=sized, width=np.int32(width), height=np.int32(height))

    return df.mapInPandas(task, df.schema)


def resize_udf(width: int = FRAME_SIZE[0], height: int = FRAME_SIZE[1], method: str = "bilinear"):
    """The same as a column function of (data, height, width, nChannels), for use inside a select."""

    def scaled(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for data, rows, cols, channels in parts:
            yield pd.Series([
                np.rint(scale_image(_pixels(d, r, c, n), width, height, method)).astype(np.uint8).tobytes()
                for d, r, c, n in zip(data, rows, cols, channels)], dtype=object)

    return F.pandas_udf(scaled, T.BinaryType(), functionType=PandasUDFType.SCALAR_ITER)


def normalise_pixels(df: DataFrame, resize: int = INPUT_RESIZE, crop: int = INPUT_CROP,
                     mean: tuple[float, ...] = CHANNEL_MEAN, std: tuple[float, ...] = CHANNEL_STD,
                     out: str = "tensor") -> DataFrame:
    """Model input per image: shorter side to `resize`, centre crop, [0, 1], (x - mean) / std.

    Source pixels are BGR as in Spark's image rows; the result is channel-first RGB.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != "data"] + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre, spread = np.asarray(mean)[:, None, None], np.asarray(std)[:, None, None]
        for batch in batches:
            tensors = []
            for data, rows, cols, channels in zip(batch["data"], batch["height"], batch["width"], batch["nChannels"]):
                pixels = _pixels(data, rows, cols, channels)
                pixels = pixels[:, :, :3][:, :, ::-1] if channels >= 3 else pixels
                short = min(rows, cols)
                width, height = int(cols * resize / short), int(rows * resize / short)
                scaled = np.rint(scale_image(pixels, width, height, "bilinear"))
                top, left = round((height - crop) / 2), round((width - crop) / 2)
                tensor = scaled[top:top + crop, left:left + crop].transpose(2, 0, 1) / 255.0
                tensors.append(((tensor - centre) / spread).astype(np.float32).ravel())
            yield batch.drop(columns="data").assign(**{out: tensors})

    return df.mapInPandas(task, schema)


def infer(df: DataFrame, model_factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str | T.StructType) -> DataFrame:
    """Run a model over Arrow batches; the factory is called once per task.

    A detector returns an array column and is followed by `explode_detections`.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for batch in batches:
            yield model(batch)

    return df.mapInPandas(task, schema)


def explode_detections(df: DataFrame, detections: str, keep: list[str]) -> DataFrame:
    """One row per detection; frames without any keep one row of nulls."""
    return df.select(*keep, F.explode_outer(detections).alias("_d")).select(*keep, "_d.*")


def process_frames(spark: SparkSession, source: str, target: str, width: int = FRAME_SIZE[0], height: int = FRAME_SIZE[1],
                   method: str = "bilinear", run_id: str | None = None) -> str:
    """Read a frame folder, bring every frame to one size, write a Parquet table; returns its path."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # decoded frames are large, so a batch holds few of them
    spark.conf.set(name, str(min(int(before), IMAGE_BATCH)))
    try:
        frames = resize(read_images(spark, source), width, height, method)
        writer = frames.withColumn("run_id", F.lit(run_id)).write if run_id else frames.write
        writer = writer.partitionBy("run_id") if run_id else writer
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").parquet(target)
    finally:
        spark.conf.set(name, before)
    return target
