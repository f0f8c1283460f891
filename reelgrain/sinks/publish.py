"""Publishing objects and models."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MODEL_EXTENSIONS
from ..functions.paths import basename, below_root, has_suffix, join_path, located
from ..sources.discovery import latest

COPY_BYTES = 8 << 20
MANIFEST = "src STRING, dst STRING, bytes BIGINT"
#: Folders that the versions of a model are dealt into.
VERSION_PARTS = 8


def publish_manifest(objects: DataFrame, source_root: str, target_root: str, exts: tuple[str, ...] = MODEL_EXTENSIONS,
                     run_id: str | None = None, path: str = "path") -> DataFrame:
    """Source and target of every object that ends with one of `exts`; keys stay relative to the root."""
    key = below_root(F.col(path), source_root)
    levels: list[Column] = [F.lit(target_root.rstrip("/"))]
    if run_id is not None:
        levels.append(F.lit(f"run_id={run_id}"))
    kept = objects.where(has_suffix(F.col(path), exts))
    return kept.select(F.col(path).alias("src"), join_path(*levels, key).alias("dst"), F.col("length").alias("bytes"))


def single_manifest(objects: DataFrame, target_root: str, name: str | None = None, path: str = "path") -> DataFrame:
    """Targets for single objects: the given name, or each object's own."""
    leaf = F.lit(name) if name else basename(F.col(path))
    return objects.select(F.col(path).alias("src"), join_path(F.lit(target_root.rstrip("/")), leaf).alias("dst"),
                          F.col("length").alias("bytes"))


def _copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        sizes = []
        for src, dst in zip(batch["src"], batch["dst"]):
            source, origin = located(src)
            sink, target = located(dst)
            if isinstance(sink, fs.LocalFileSystem):
                sink.create_dir(posixpath.dirname(target), recursive=True)
            size = 0
            # copied in chunks: an object never has to fit in a task's memory
            with source.open_input_stream(origin) as reader, sink.open_output_stream(target) as writer:
                while chunk := reader.read(COPY_BYTES):
                    writer.write(chunk)
                    size += len(chunk)
            sizes.append(size)
        yield batch[["src", "dst"]].assign(bytes=sizes)


def copy_objects(manifest: DataFrame, tasks: int | None = None) -> DataFrame:
    """Copy every manifest row in parallel and return what was written.

    A retried task writes the same targets again, so losing an executor does no harm. The result
    is lazy: write it out or count it once.
    """
    spread = manifest.repartition(tasks) if tasks else manifest
    return spread.select("src", "dst", "bytes").mapInPandas(_copy, MANIFEST)


def _put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            sink, target = located(path)
            if isinstance(sink, fs.LocalFileSystem):
                sink.create_dir(posixpath.dirname(target), recursive=True)
            with sink.open_output_stream(target) as writer:
                writer.write(content)
        yield pd.DataFrame({"path": batch["path"], "bytes": [len(c) for c in batch["content"]]})


def put_objects(rows: DataFrame, root: str, key: Column, content: Column) -> DataFrame:
    """Write one object per row below `root` and return paths and sizes; rows with a null key or content write nothing.

    Lazy and safe to retry, as `copy_objects`; of rows with one key any may be the last.
    """
    named = rows.where(key.isNotNull() & content.isNotNull()).select(join_path(F.lit(root.rstrip("/")), key).alias("path"), content.cast("binary").alias("content"))
    return named.mapInPandas(_put, "path STRING, bytes BIGINT")


def publish_latest(df: DataFrame, root: str, model_key: str, version: str, tie: str) -> tuple[str, str]:
    """Write every version of the models in `df` under `versions/`, and the newest published one of each under `latest/`.

    A version published again replaces the one before it; other versions stay, and an older version that
    arrives late never becomes the latest. Versions lie in VERSION_PARTS folders a model by a hash, not in one each, so files
    stay few however many versions there are; the folders that `df` has versions of are written anew.
    """
    spark = df.sparkSession
    versions, newest = f"{root.rstrip('/')}/versions", f"{root.rstrip('/')}/latest"
    text = F.col(version).cast("string")
    stored = df.withColumn("_version", F.when(text != "", text))
    stored = stored.withColumn("_part", F.pmod(F.xxhash64("_version"), F.lit(VERSION_PARTS)).cast("int"))
    every = stored
    if _exists(spark, versions):
        old = spark.read.schema(stored.schema).parquet(versions)
        folders = stored.select(model_key, "_part").distinct().alias("n")
        old = old.alias("o").join(folders, _same("o", "n", [model_key, "_part"]), "left_semi")
        again = stored.select(model_key, "_version").distinct().alias("n")
        every = stored.unionByName(old.alias("o").join(again, _same("o", "n", [model_key, "_version"]), "left_anti").select(*stored.columns))
    # the folders are only replaced when all rows are written beside them
    _overwrite_parts(every, versions, [model_key, "_part"])
    # what lies there now, versions of earlier calls included, of the models given only
    published = spark.read.schema(stored.schema).parquet(versions).select(*df.columns)
    published = published.join(df.select(model_key).distinct(), model_key, "left_semi")
    _overwrite_parts(latest(published, version, [model_key], tie), newest, [model_key])
    return versions, newest


def _same(left: str, right: str, columns: list[str]) -> Column:
    """Equal columns of two aliased tables, nulls included; an empty text is a null, as in names of folders."""
    pairs = [[F.col(f"{t}.{c}") for t in (left, right)] for c in columns]
    return reduce(Column.__and__, [F.when(a.cast("string") != "", a).eqNullSafe(F.when(b.cast("string") != "", b)) for a, b in pairs])


def _exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()).exists(target)


def _overwrite_parts(rows: DataFrame, target: str, parts: list[str]) -> None:
    """Replace the partitions that `rows` has and leave the others."""
    (rows.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(target))
