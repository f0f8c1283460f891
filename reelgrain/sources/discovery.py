"""Choosing inputs from listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import micros


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenation that keeps duplicates."""
    return reduce(DataFrame.unionByName, dfs)


def first_nonempty(objects: DataFrame, roots: list[str], path: str = "path") -> DataFrame:
    """Objects of the first root, in the given order, that has any; a root without a scheme fits under every one."""
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    rank = F.lit(None).cast("int")
    for i, root in reversed(list(enumerate(roots))):
        full = F.col(path) if ":" in root else bare
        rank = F.when(full.startswith(root.rstrip("/") + "/"), F.lit(i)).otherwise(rank)
    ranked = objects.withColumn("_rank", rank)
    best = ranked.agg(F.min("_rank").alias("_best"))
    return ranked.where(F.col("_rank") == best.scalar()).drop("_rank")


def latest(df: DataFrame, by: str, keys: list[str] | None = None, tie: str = "path") -> DataFrame:
    """The newest row per key (or overall); equal times go to the smallest `tie`, rows without a time come last.

    One aggregate instead of a window: each input partition sends one row per key. Text and other types
    without an opposite are first reduced to one row per key and value.
    """
    keys = keys or []
    others = [c for c in df.columns if c not in keys]
    kind = df.schema[by].dataType
    row = F.struct(*others)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)):
        stamp = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
        number = micros(F.col(by)) if stamp else F.unix_date(by) if isinstance(kind, T.DateType) else F.col(by)
        picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(F.col(by).isNull(), -number, tie)).alias("_r"))
    else:
        first = df.groupBy(*keys, F.col(by).alias("_by")).agg(F.min_by(row, F.struct(F.col(tie).isNull(), tie)).alias("_r"))
        picked = first.groupBy(*keys).agg(F.max_by("_r", F.struct(F.col("_by").isNotNull(), "_by")).alias("_r"))
    return picked.where(F.col("_r").isNotNull()).select(*keys, "_r.*")


def first_by(df: DataFrame, order: str | list[str]) -> DataFrame:
    """The first row in `order`."""
    return df.orderBy(order).limit(1)


def existing(df: DataFrame, objects: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose path is in the listing."""
    return df.join(objects.select(path), path, "left_semi")


def select_or_latest(objects: DataFrame, requests: DataFrame, by: str = "modificationTime", path: str = "path",
                     requested: str = "requested_path") -> DataFrame:
    """Each request's own path where it exists, else the newest object."""
    newest = latest(objects, by, tie=path).select(path)
    present = objects.select(F.col(path).alias("_present")).distinct()
    found = requests.join(present, F.col(requested) == F.col("_present"), "left")
    chosen: Column = F.coalesce(F.col("_present"), newest.scalar())
    return found.withColumn("selected_path", chosen).drop("_present")
