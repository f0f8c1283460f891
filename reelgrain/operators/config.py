"""Projections of nested configuration and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_config(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Nested fields as top-level columns; the scan reads those fields only."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def project_json(df: DataFrame, column: str, paths: dict[str, tuple[str, str]], keep: list[str]) -> DataFrame:
    """Fields of free-form JSON text as typed columns: `{name: (json path, type)}`; null where absent."""
    parsed = df.withColumn("_v", F.try_parse_json(column))
    picks = [F.try_variant_get("_v", path, kind).alias(name) for name, (path, kind) in paths.items()]
    return parsed.select(*keep, *picks)
