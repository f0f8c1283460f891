"""Relational joins of the capture jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Add the columns of a dimension.

    No broadcast is forced: Spark broadcasts the dimension when its measured size is below
    `spark.sql.autoBroadcastJoinThreshold`, and otherwise sort-merges with skewed keys split.
    """
    return df.join(dim, on, how)


def class_names(df: DataFrame, names: DataFrame, class_id: str, name: str, default: str | None = None) -> DataFrame:
    """Attach class names; unknown ids get `default`."""
    joined = df.join(names.select(class_id, F.col(name).alias("class_name")), class_id, "left")
    return joined.withColumn("class_name", F.coalesce("class_name", F.lit(default))) if default else joined


def unprocessed(raw: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return raw.join(done.select(key), key, "left_anti")


def missing(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Distinct keys expected but not there."""
    return expected.select(key).subtract(actual.select(key))
