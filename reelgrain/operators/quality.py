"""Job quality, service levels, storage use and control limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import LAG_SECONDS, POLYGON_DRIFT, SLA_SECONDS, SLOW_RUN_FACTOR, STORAGE_ALERT
from ..functions.times import micros, seconds_between
from ..sources.discovery import latest
from .ordered import ROWS_PER_SLICE, quantiles, rolling
from .sketches import QUANTILE_K


def interval_seconds(interval: Column) -> Column:
    """A day-time interval as seconds."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return micros(epoch + interval) / F.lit(1e6)


def quality_metrics(jobs: DataFrame, polygons: str = "polygon_count", time: str = "processing_time", p: float = 0.9,
                    keys: list[str] | None = None, exact: bool = True, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Mean polygon count and a quantile of the processing time, overall or per key.

    The quantile is interpolated and exact; `exact=False` takes a KLL sketch in the same pass.
    Interval columns give an interval.
    """
    keys = keys or []
    spans = isinstance(jobs.schema[time].dataType, T.DayTimeIntervalType)
    timed = jobs.withColumn("_time", interval_seconds(F.col(time)) if spans else F.col(time).cast("double"))
    name = f"p{round(p * 100)}_processing_time"
    if exact:
        stats = quantiles(timed, "_time", {name: p}, keys, {"avg_polygons": F.avg(polygons)}, per_slice)
        stats = stats.select(*keys, "avg_polygons", name)
    else:
        stats = timed.groupBy(*keys).agg(F.avg(polygons).alias("avg_polygons"), F.kll_sketch_agg_double("_time", F.lit(QUANTILE_K)).alias("_sketch"), F.count("_time").alias("_n"))
        value = F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))))
        stats = stats.select(*keys, "avg_polygons", value.alias(name))
    if spans:
        stats = stats.withColumn(name, F.make_dt_interval(secs=F.col(name).cast("decimal(18,6)")))
    return stats


def success_rate(runs: DataFrame, keys: list[str], state: str, ok: str, least: float | None = None) -> DataFrame:
    """Runs, successes and their share per group, and whether it is under `least`."""
    good = F.coalesce(F.col(state) == F.lit(ok), F.lit(False))
    rates = runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(good).alias("succeeded"), F.avg(good.cast("double")).alias("rate"))
    return rates.withColumn("alert", F.col("rate") < F.lit(least)) if least is not None else rates


def utilisation(objects: DataFrame, quotas: DataFrame, bucket: str, length: str, quota: str,
                alert: float = STORAGE_ALERT) -> DataFrame:
    """Bytes used per bucket against its quota; buckets without objects use 0, a quota of 0 has no share."""
    used = objects.groupBy(bucket).agg(F.sum(length).alias("used_bytes"))
    joined = quotas.join(used, bucket, "left")
    joined = joined.withColumn("used_bytes", F.coalesce("used_bytes", F.lit(0).cast("long")))
    share = F.try_divide("used_bytes", quota)
    return joined.withColumn("utilisation", share).withColumn("alert", share > F.lit(alert))


def efficiency(raw: DataFrame, processed: DataFrame, keys: list[str], length: str) -> DataFrame:
    """Share of the raw bytes saved by processing, per key; null without raw bytes."""
    a = raw.groupBy(*keys).agg(F.sum(length).alias("raw_bytes"))
    b = processed.groupBy(*keys).agg(F.sum(length).alias("processed_bytes"))
    joined = a.join(b, keys, "left")
    kept = F.coalesce(F.col("processed_bytes"), F.lit(0))
    return joined.withColumn("processed_bytes", kept.cast("long")).withColumn(
        "saved", 1 - F.try_divide("processed_bytes", "raw_bytes"))


def throughput(df: DataFrame, ts: str, keys: list[str]) -> DataFrame:
    """Rows per second between the first and last row of each group."""
    span = (F.max(micros(F.col(ts))) - F.min(micros(F.col(ts)))) / F.lit(1e6)
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), span.alias("seconds"))
    return stats.withColumn("per_second", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")))


def lag_report(df: DataFrame, lag: Column, keys: list[str], limit: float = LAG_SECONDS, p: float = 0.9,
               per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Largest and quantile lag in seconds per group, and how many rows are over the limit."""
    lagged = df.select(*keys, lag.cast("double").alias("_lag"))
    counts = {"rows": F.count("_lag"), "late": F.count_if(F.col("_lag") > limit), "max_lag": F.max("_lag")}
    return quantiles(lagged, "_lag", {"quantile_lag": p}, keys, counts, per_slice)


def sla_report(runs: DataFrame, start: str, end: str, keys: list[str], sla: float = SLA_SECONDS) -> DataFrame:
    """Runs per group that took longer than the agreed time, or have not ended."""
    took = seconds_between(F.col(start), F.col(end))
    late = F.coalesce(took > F.lit(float(sla)), F.lit(False))
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(late).alias("missed"),
        F.count_if(F.col(end).isNull()).alias("open"), F.max(took).alias("longest_seconds"))


def slow_runs(runs: DataFrame, keys: list[str], order: list[str], duration: str, n: int = 10,
              factor: float = SLOW_RUN_FACTOR, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Each run against the mean of the `n` before it; `slow` above `factor` times that."""
    based = rolling(runs, keys, order, n, {"baseline": F.avg(duration)}, per_slice)
    slow = F.coalesce(F.col(duration) > F.lit(factor) * F.col("baseline"), F.lit(False))
    return based.withColumn("slow", slow)


def last_attempt(runs: DataFrame, keys: list[str], attempt: str, tie: str) -> DataFrame:
    return latest(runs, attempt, keys, tie)


def metric_drift(ref: DataFrame, cur: DataFrame, keys: list[str], metric: Column, limit: float = POLYGON_DRIFT) -> DataFrame:
    """Relative change of an aggregate between two tables, per key; keys on one side only stay with nulls."""
    a = ref.groupBy(*keys).agg(metric.alias("reference"))
    b = cur.groupBy(*keys).agg(metric.alias("current"))
    joined = a.join(b, keys, "full_outer")
    change = F.abs(F.col("current") - F.col("reference")) / F.nullif(F.col("reference"), F.lit(0.0))
    return joined.withColumn("change", change).withColumn("drifted", change > F.lit(limit))


def control_limits(baseline: DataFrame, current: DataFrame, keys: list[str], value: str, k: float = 3.0) -> DataFrame:
    """Current rows with their key's limits mean +- k sigma, and whether they are outside."""
    limits = baseline.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    limits = limits.select(*keys, (F.col("_m") - k * F.col("_s")).alias("lower"), (F.col("_m") + k * F.col("_s")).alias("upper"))
    outside = (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))
    return current.join(limits, keys, "left").withColumn("outside", F.coalesce(outside, F.lit(False)))
