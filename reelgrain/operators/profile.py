"""Missing values and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import ROWS_PER_SLICE, quantiles
from .sketches import read, sketch


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count and share per column, from one aggregate over the table."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *nulls)
    long = one.unpivot("_rows", columns, "column", "nulls")
    share = F.col("nulls") / F.nullif(F.col("_rows"), F.lit(0))
    return long.select("column", "nulls", share.alias("share"))


def to_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns as rows of column and value."""
    return df.select([F.col(c).cast("double") for c in columns]).unpivot([], columns, "column", "value")


def _moments(value: Column) -> dict[str, Column]:
    return {
        "n": F.count(value), "nulls": F.count_if(value.isNull()), "min": F.min(value), "max": F.max(value),
        "mean": F.avg(value), "std": F.stddev_samp(value),
    }


def profile(df: DataFrame, columns: list[str], exact: bool = False, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Count, nulls, distinct values, range, mean, deviation and quartiles of numeric columns.

    By default distinct counts and quartiles are read from mergeable sketches of a single pass (`sketches`); `exact`
    counts every value.
    """
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    if not exact:
        return read(sketch(df, columns), marks)
    long = to_long(df, columns)
    basic = quantiles(long, "value", marks, ["column"], _moments(F.col("value")), per_slice)
    # distinct first, so that no task holds a column's values
    values = long.where(F.col("value").isNotNull()).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    return basic.join(values, "column", "left").withColumn("distinct", F.coalesce("distinct", F.lit(0).cast("long")))
