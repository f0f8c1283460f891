"""Partitioned artifact tables and namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Artifact kinds and the folder levels below each.
LAYOUT = {
    "raw-videos": ("venue_id", "event_id"),
    "frames": ("venue_id", "event_id", "camera_id"),
    "annotations": ("venue_id", "event_id", "model_type", "camera_id"),
    "processed-frames": ("venue_id", "event_id", "process_type", "camera_id"),
    "features": ("venue_id", "event_id", "feature_extractor", "camera_id"),
    "models": ("model_kind", "venue_id", "event_id"),
    "training-data": ("dataset_name", "split"),
}


def ensure_namespace(spark: SparkSession, name: str) -> str:
    """Create a database unless it is there; returns `exists` or `created`."""
    if spark.catalog.databaseExists(name):
        return "exists"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return "created"


def write_artifacts(df: DataFrame, root: str, kind: str, fmt: str = "parquet", mode: str = "append",
                    partition_by: tuple[str, ...] | None = None) -> str:
    """Write a table below `root/kind`, with the kind's folder levels as partition columns.

    The rebalance groups rows by folder, so that each gets few files; a big folder is split.
    """
    levels = partition_by if partition_by is not None else tuple(c for c in LAYOUT[kind] if c in df.columns)
    target = f"{root.rstrip('/')}/{kind}"
    out = df
    if levels:
        out = df.hint("rebalance", *levels)
    writer = out.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if levels:
        writer = writer.partitionBy(*levels)
    writer.save(target)
    return target


def write_results(df: DataFrame, root: str, kind: str, partition_by: tuple[str, ...] = (), fmt: str = "json") -> str:
    """Analysis rows stamped with the time of writing."""
    return write_artifacts(df.withColumn("timestamp", F.current_timestamp()), root, kind, fmt, "append", partition_by)
