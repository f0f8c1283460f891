"""Windowed metrics, lag alerts and sampling on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LAG_SECONDS
from ..functions.times import seconds_between

WATERMARK = "15 minutes"


def window_metrics(stream: DataFrame, ts: str, every: str, keys: list[str], value: str, delay: str = WATERMARK) -> DataFrame:
    """Count, mean and range per key and tumbling window; same plan on a table and on a stream."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    stats = timed.groupBy(F.window("_ts", every).alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_value"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"))
    return stats.select(*keys, F.col("_w.start").alias("window_start"), "n", "avg_value", "min_value", "max_value")


def lag_alerts(stream: DataFrame, ts: str, done: str | None = None, limit: float = LAG_SECONDS) -> DataFrame:
    """Rows whose processing time (or `done`) is more than `limit` seconds after their event time."""
    end = F.col(done) if done else F.current_timestamp()
    lag = seconds_between(F.col(ts), end)
    return stream.withColumn("lag_seconds", lag).where(F.col("lag_seconds") > F.lit(float(limit)))


def sample_stream(stream: DataFrame, video: str, ts: str, tie: str, every: str, delay: str = WATERMARK) -> DataFrame:
    """First frame per video and window of `every`."""
    columns = [c for c in stream.columns if c != video]
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    first = F.min_by(F.struct(*columns), F.struct("_ts", tie)).alias("_f")
    picked = timed.groupBy(F.window("_ts", every).alias("_w"), video).agg(first)
    return picked.select(video, F.col("_w.start").alias("window_start"), "_f.*")
