"""Per-frame anomaly flags on streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "n BIGINT, mean DOUBLE, m2 DOUBLE"


def flag_threshold(stream: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Stateless flag: outside a fixed range."""
    return stream.withColumn("anomaly", ~F.col(value).between(low, high))


def judge_stream(stream: DataFrame, key: str, value: str, keep: list[str], target: str, state: str, checkpoint: str,
                 k: float = 3.0, warm_up: int = 10, every: str | None = None) -> StreamingQuery:
    """Flag values more than `k` deviations from the mean of all batches before their own.

    Per batch, each key's count, mean and squared deviation are aggregated before the shuffle and
    added to the table in `state`; rows only meet the small table of the batch before. So a camera
    with most of the rows is not one task. Both tables are partitioned by batch, and a replayed
    batch replaces its own rows.
    """
    kind = stream.schema[key].dataType.simpleString()

    def put(rows: DataFrame, path: str, batch_id: int) -> None:
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(key, *keep, value).persist()
        schema = f"`{key}` {kind}, n BIGINT, mean DOUBLE, m2 DOUBLE"
        if batch_id == 0:
            seen = spark.createDataFrame([], schema)
        else:
            seen = spark.read.schema(f"{schema}, batch_id INT").parquet(state)
            seen = seen.where(F.col("batch_id") == batch_id - 1).drop("batch_id")
        sigma = F.sqrt(F.col("m2") / (F.col("n") - 1))
        odd = (F.col("n") >= warm_up) & (F.abs(F.col(value) - F.col("mean")) > F.lit(k) * sigma)
        judged = batch.join(seen, key, "left")
        put(judged.select(key, *keep, value, F.coalesce(odd, F.lit(False)).alias("anomaly")), target, batch_id)
        count = F.count(value)
        added = batch.groupBy(key).agg(count.alias("bn"), F.avg(value).alias("bm"), (F.var_pop(value) * count).alias("b2"))
        both = seen.join(added, key, "full_outer").na.fill(0)
        n, gap = F.col("n") + F.col("bn"), F.col("bm") - F.col("mean")
        # two summaries into one (Chan et al. 1983)
        mean = F.col("mean") + gap * F.col("bn") / n
        m2 = F.col("m2") + F.col("b2") + gap * gap * F.col("n") * F.col("bn") / n
        known = [F.when(n > 0, c).otherwise(F.lit(0.0)).alias(name) for name, c in (("mean", mean), ("m2", m2))]
        put(both.select(key, n.alias("n"), *known), state, batch_id)
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _fold(state: tuple[int, float, float], values: np.ndarray) -> tuple[int, float, float]:
    """Add a batch to count, mean and squared deviation (Chan et al. 1983)."""
    n, mean, m2 = state
    if not len(values):
        return state
    size, centre = len(values), float(values.mean())
    spread = float(((values - centre) ** 2).sum())
    total, gap = n + size, centre - mean
    return total, mean + gap * size / total, m2 + spread + gap * gap * n * size / total


def anomalies(stream: DataFrame, key: str, value: str, keep: list[str], k: float = 3.0, warm_up: int = 10,
              timeout_ms: int | None = None) -> DataFrame:
    """The same with the three numbers per key in the stream's own state, for keys of even size.

    A value is judged by the batches seen before its own, and a batch is handled as arrays. With
    `timeout_ms` a key that stays silent emits one row with `timed_out` set and its state is dropped.
    """
    names = [key, *keep, value]
    schema = ", ".join(f"`{c}` {stream.schema[c].dataType.simpleString()}" for c in names)
    out = f"{schema}, anomaly boolean, timed_out boolean"

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            row = {c: [None] for c in names}
            row[key] = [group[0]]
            yield pd.DataFrame({**row, "anomaly": [False], "timed_out": [True]})
            return
        seen = state.get if state.exists else (0, 0.0, 0.0)
        n, mean, m2 = seen
        sigma = (m2 / (n - 1)) ** 0.5 if n > 1 else 0.0
        for batch in batches:
            values = batch[value].to_numpy(dtype=float)
            odd = np.abs(values - mean) > k * sigma if n >= warm_up else np.zeros(len(values), dtype=bool)
            seen = _fold(seen, values[~np.isnan(values)])
            yield batch[names].assign(anomaly=odd, timed_out=False)
        state.update(seen)
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)

    limit = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return stream.groupBy(key).applyInPandasWithState(update, out, STATE, "append", limit)


def window_sums(rows: DataFrame, key: str, ts: str, value: str, width: str, digits: int = 6, delay: str | None = None) -> DataFrame:
    """`key, window_start, n, s1, s2`: values, their sum and sum of squares by event-time window, of a table or a stream.

    Values are rounded to `digits` decimals and summed exactly, so the sums don't depend on the order, or on the batches, in which rows
    come. Tasks add up first, so a camera with most of the rows is a few rows a window in the shuffle. A stream waits `delay` for
    late rows; read it with `ingest_updates` and `current_rows`.
    """
    units = F.round(F.col(value).cast("double") * 10.0 ** digits).cast("decimal(19,0)")
    kept = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(ts).isNotNull())
    kept = kept.select(key, F.col(ts).cast("timestamp").alias("_ts"), units.alias("_u"))
    if delay:
        kept = kept.withWatermark("_ts", delay)
    sums = kept.groupBy(key, F.window("_ts", width).alias("_w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_u").cast("decimal(38,0)").alias("s1"), F.sum(F.col("_u") * F.col("_u")).cast("decimal(38,0)").alias("s2"))
    return sums.select(key, F.col("_w.start").alias("window_start"), "n", "s1", "s2")


def judge_windows(rows: DataFrame, sums: DataFrame, key: str, ts: str, value: str, width: str, digits: int = 6, k: float = 3.0,
                  warm_up: int = 10) -> DataFrame:
    """`rows` with `anomaly`: more than `k` deviations from the mean of all earlier windows of the key, `warm_up` values at least.

    `sums` are the rows of `window_sums`. A flag depends on times and values alone, not on how rows arrived. The running sums are over one row for each
    window of a key, however many rows it has. Nulls are no anomaly.
    """
    earlier = Window.partitionBy(key).orderBy("window_start").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col(key).alias("_key"), F.col("window_start").alias("_start"), *[F.sum(c).over(earlier).cast("double").alias(f"_{c}") for c in ("n", "s1", "s2")])
    start = F.window(F.col(ts).cast("timestamp"), width)["start"]
    joined = rows.withColumn("_at", start).join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_start")), "left")
    mean, one = F.col("_s1") / F.col("_n"), F.lit(10.0 ** digits)
    spread = F.sqrt(F.greatest((F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("_n")) / (F.col("_n") - 1), F.lit(0.0)))
    odd = F.when(F.col("_n") >= max(2, warm_up), F.abs(F.round(F.col(value).cast("double") * one) - mean) > F.lit(k) * spread)
    return joined.withColumn("anomaly", F.coalesce(odd, F.lit(False))).drop("_at", "_key", "_start", "_n", "_s1", "_s2")
