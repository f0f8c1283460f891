"""Object listings and object contents through Spark's binary file source."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import below_root, has_suffix, located

LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT"
LISTING_ORDER = "path STRING, length BIGINT, modificationTime TIMESTAMP"


def _glob(exts: tuple[str, ...]) -> str:
    names = [e.lstrip(".") for e in exts]
    return "*." + (names[0] if len(names) == 1 else "{" + ",".join(names) + "}")


def list_objects(spark: SparkSession, root: str | list[str], prefix: str = "", exts: tuple[str, ...] | None = None,
                 recursive: bool = False, with_content: bool = False, ignore_case: bool = False) -> DataFrame:
    """Objects under `root`: path, length, modificationTime; bytes only on request.

    The suffix test runs while listing, so unmatched files never become rows; without
    `with_content` no file is opened.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if exts and not ignore_case:
        reader = reader.option("pathGlobFilter", _glob(exts))
    columns = ["path", "length", "modificationTime"] + (["content"] if with_content else [])
    found = reader.load(root).select(*columns)
    if exts and ignore_case:
        found = found.where(has_suffix(F.col("path"), exts, ignore_case=True))
    if not prefix:
        return found
    fits = F.lit(False)
    for one in [root] if isinstance(root, str) else root:
        fits = fits | F.coalesce(below_root(F.col("path"), one).startswith(prefix), F.lit(False))
    return found.where(fits)


def where_key(df: DataFrame, prefix: str = "", exts: tuple[str, ...] | None = None, path: str = "path",
              root: str | None = None) -> DataFrame:
    """Rows whose key starts with `prefix` and ends with one of `exts`."""
    if prefix:
        if root is None:
            df = df.where(F.col(path).startswith(prefix))
        else:
            df = df.where(below_root(F.col(path), root).startswith(prefix))
    if exts:
        df = df.where(has_suffix(F.col(path), exts))
    return df


def read_objects(spark: SparkSession, keys: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Contents of the objects below `root` whose paths are in `keys`; no other object is opened."""
    wanted = list_objects(spark, root, recursive=True).join(keys.select(F.col(path).alias("path")), "path", "left_semi")
    return wanted.select("path", "length", "modificationTime").mapInArrow(_contents, f"{LISTING_ORDER}, content BINARY")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # an object at a time, so that a batch never holds several large ones
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            store, key = located(row.column("path")[0].as_py())
            with store.open_input_stream(key) as reader:
                content = pa.array([reader.read()], pa.binary())
            yield pa.RecordBatch.from_arrays([*row.columns, content], [*row.schema.names, "content"])


def read_images(spark: SparkSession, root: str, exts: tuple[str, ...] = (".png", ".jpg")) -> DataFrame:
    """Decoded images as rows of origin, height, width, nChannels, mode, data (BGR bytes)."""
    reader = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", _glob(exts)).load(root).select("image.*")


def frame_listing(spark: SparkSession, root: str, exts: tuple[str, ...] = (".png", ".jpg")) -> DataFrame:
    """Frames below `root`, with the folder that holds them as `video_id`."""
    found = list_objects(spark, root, exts=exts, recursive=True)
    return found.withColumn("video_id", F.element_at(F.split("path", "/"), -2))
