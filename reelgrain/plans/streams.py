"""Streaming queries: a table is read as a stream of what is there, written to a table, and read back."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..streaming import anomalies as an
from ..streaming import ingest as ing
from ..streaming import windows as win
from ..streaming.arrivals import give_up
from .registry import Tables, cents, query, us
from .validation import rules


def as_stream(t: Tables, name: str) -> DataFrame:
    """A table as a stream; the pattern lets the path be one file as well as a folder."""
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.folder}/{name}.parque[t]")


def run_stream(t: Tables, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run `build` over a table as a stream until all of it is read; results come from a Parquet sink."""
    base = scratch_path(t.spark, "stream")
    out = build(as_stream(t, name))
    ing.ingest(out, f"{base}/data", f"{base}/log").awaitTermination()
    return t.spark.read.schema(out.schema).parquet(f"{base}/data")


def run_windows(t: Tables, name: str, build: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """As `run_stream` for windowed groups: the table ends, so windows after the last watermark belong to the result."""
    base = scratch_path(t.spark, "stream")
    out = build(as_stream(t, name))
    ing.ingest_updates(out, f"{base}/data", f"{base}/log").awaitTermination()
    schema = T.StructType([*out.schema.fields, T.StructField("batch_id", T.LongType())])
    updates = t.spark.read.schema(schema).parquet(f"{base}/data")
    return ing.current_rows(updates, keys)


@query("k1_incremental_ingest", "SELECT event_id, user_id, value FROM events")
def k1(t: Tables):
    return run_stream(t, "events", lambda s: s.select("event_id", "user_id", "value"))


@query("k2_streaming_validation", """
SELECT doc_id, n_chars BETWEEN 100 AND 5000 AS passed FROM documents
""")
def k2(t: Tables):
    base = scratch_path(t.spark, "stream")
    bounds = rules(t.spark).where("rule = 'file_size'")
    stream = as_stream(t, "documents").select("doc_id", "n_chars")
    job = ing.validate_stream(stream, bounds, f"{base}/good", f"{base}/bad", f"{base}/log")
    job.awaitTermination()
    good, bad = t.spark.read.parquet(f"{base}/good"), t.spark.read.parquet(f"{base}/bad")
    return good.select("doc_id", F.lit(True).alias("passed")).unionByName(bad.select("doc_id", F.lit(False).alias("passed")))


@query("k3_threshold_anomalies", "SELECT event_id, NOT (value BETWEEN 1 AND 100) AS anomaly FROM events")
def k3_threshold(t: Tables):
    return run_stream(t, "events", lambda s: an.flag_threshold(s.select("event_id", "value"), "value", 1.0, 100.0).drop("value"))


@query("k3_running_anomalies", """
WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-02' AS old FROM events),
s AS (SELECT event_type, count(*) AS n, avg(value) AS m, stddev_samp(value) AS s FROM e WHERE old GROUP BY event_type)
SELECT e.event_id, e.event_type, NOT old AND n >= 10 AND abs(value - m) > 3 * s AS anomaly FROM e JOIN s ON s.event_type = e.event_type
""")
def k3(t: Tables):
    base = scratch_path(t.spark, "stream")
    rows = t.events.select("event_type", "event_id", "value", "ts")
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    # two arrivals, judged one after the other
    for part in (rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)):
        part.write.mode("append").parquet(f"{base}/arrivals")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{base}/arrivals")
        an.judge_stream(stream, "event_type", "value", ["event_id"], f"{base}/judged", f"{base}/state", f"{base}/log").awaitTermination()
    return t.spark.read.parquet(f"{base}/judged").select("event_id", "event_type", "anomaly")


@query("k3_event_time_anomalies", """
WITH e AS (SELECT event_id, event_type, round(value * 100) AS u, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events),
s AS (SELECT event_type, w, count(*) AS n, sum(u) AS s1, sum(u * u) AS s2 FROM e GROUP BY event_type, w),
b AS (SELECT event_type, w, sum(n) OVER v AS n, sum(s1) OVER v AS s1, sum(s2) OVER v AS s2 FROM s
      WINDOW v AS (PARTITION BY event_type ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, e.event_type, coalesce(n >= 10 AND abs(u - s1 / n) > CAST(1.5 AS DOUBLE) * sqrt((s2 - s1 * s1 / n) / (n - 1)), false) AS anomaly
FROM e JOIN b ON b.event_type = e.event_type AND b.w = e.w
""")
def k3_event_time(t: Tables):
    # two arrivals that overlap in time: rows are kept, window sums grow, and flags come from the sums of earlier windows
    base = scratch_path(t.spark, "stream")
    rows = t.events.select("event_type", "event_id", "value", "ts")
    schema = T.StructType([*an.window_sums(rows, "event_type", "ts", "value", "6 hours", 2).schema.fields, T.StructField("batch_id", T.LongType())])
    for part in (0, 1):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).write.mode("append").parquet(f"{base}/arrivals")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{base}/arrivals")
        ing.ingest(stream, f"{base}/rows", f"{base}/log_rows").awaitTermination()
        sums = an.window_sums(stream, "event_type", "ts", "value", "6 hours", 2, delay="3650 days")
        ing.ingest_updates(sums, f"{base}/sums", f"{base}/log_sums").awaitTermination()
    current = ing.current_rows(t.spark.read.schema(schema).parquet(f"{base}/sums"), ["event_type", "window_start"])
    judged = an.judge_windows(t.spark.read.schema(rows.schema).parquet(f"{base}/rows"), current, "event_type", "ts", "value", "6 hours", 2, k=1.5)
    return judged.select("event_id", "event_type", "anomaly")


@query("k3_stateful_anomalies", """
SELECT event_type, event_id, value, false AS anomaly, false AS timed_out FROM events
""")
def k3_stateful(t: Tables):
    return run_stream(t, "events", lambda s: an.anomalies(s, "event_type", "value", ["event_id"]))


@query("k4_window_metrics", """
WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS ws, CAST(round(value * 100) AS BIGINT) AS value FROM events)
SELECT event_type, epoch_us(ws) AS window_us, count(*) AS n, round(avg(value), 6) AS avg_value, min(value) AS min_value, max(value) AS max_value
FROM w GROUP BY event_type, ws
""")
def k4(t: Tables):
    rows = run_windows(t, "events", lambda s: win.window_metrics(s.withColumn("value", cents("value")), "ts", "1 hour", ["event_type"], "value"),
                       ["event_type", "window_start"])
    return rows.select("event_type", us("window_start").alias("window_us"), "n", F.round("avg_value", 6).alias("avg_value"), "min_value", "max_value")


@query("k5_lag_alerts", """
SELECT l_orderkey, l_linenumber, (epoch_us(TIMESTAMP '1999-01-01') - epoch_us(l_shipdate)) / 1000000 AS lag_seconds
FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' - INTERVAL 15 MINUTE
""")
def k5(t: Tables):
    def build(s: DataFrame) -> DataFrame:
        done = F.lit("1999-01-01").cast("timestamp_ntz")
        alerts = win.lag_alerts(s.withColumn("done", done), "l_shipdate", "done")
        return alerts.select("l_orderkey", "l_linenumber", "lag_seconds")

    return run_stream(t, "lineitem", build)


@query("k6_stream_sample", """
WITH w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS ws FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ws ORDER BY ts, event_id) AS rn FROM w)
SELECT user_id, epoch_us(ws) AS window_us, event_id FROM r
WHERE rn = 1
""")
def k6(t: Tables):
    rows = run_windows(t, "events", lambda s: win.sample_stream(s.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", "1 hour"),
                       ["user_id", "window_start"])
    return rows.select("user_id", us("window_start").alias("window_us"), "event_id")


@query("k7_drop_repeats", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def k7(t: Tables):
    def build(s: DataFrame) -> DataFrame:
        twice = s.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
        return ing.dedupe(twice, "event_id", "ts", "15 minutes")

    return run_stream(t, "events", build).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("k8_overdue_arrivals", """
SELECT o_orderkey FROM orders WHERE o_orderdate + INTERVAL 2 HOUR < TIMESTAMP '1999-01-01'
AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def k8(t: Tables):
    now = F.lit("1999-01-01").cast("timestamp_ntz")
    arrived = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return ing.overdue(t.orders.select("o_orderkey", "o_orderdate"), arrived, now, "o_orderkey", "o_orderdate").select("o_orderkey")


@query("k8_give_up_timers", """
WITH came AS (SELECT l_orderkey, min(l_shipdate) AS first FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, epoch_us(o_orderdate) AS expected_us, epoch_us(o_orderdate + INTERVAL 20 DAY) AS gave_up_us
FROM orders LEFT JOIN came ON l_orderkey = o_orderkey WHERE first IS NULL OR first > o_orderdate + INTERVAL 20 DAY
""")
def k8_timers(t: Tables):
    # the first item of an order is expected within 20 days; both tables arrive in two parts, then time passes and the timers run out
    base, keys = scratch_path(t.spark, "stream"), F.pmod(F.col("o_orderkey"), F.lit(2))
    ordered = t.orders.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    shipped = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    later = t.spark.range(1).select(F.lit(-1).cast(ordered.schema["o_orderkey"].dataType).alias("o_orderkey"), F.lit("2100-01-01").cast("timestamp").alias("ts"))
    beats = [later, later.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))]
    for part in (0, 1, beats[0], beats[1]):
        for rows, name in ((ordered, "expected"), (shipped, "came")):
            (part if isinstance(part, DataFrame) else rows.where(keys == part)).write.mode("append").parquet(f"{base}/{name}")
        expected, came = (t.spark.readStream.schema(ordered.schema).parquet(f"{base}/{name}") for name in ("expected", "came"))
        late = give_up(expected, came, "o_orderkey", "ts", "ts", timeout=20 * 86_400, delay="3650 days")
        ing.ingest(late, f"{base}/late", f"{base}/log").awaitTermination()
    found = t.spark.read.schema(late.schema).parquet(f"{base}/late").where("o_orderkey >= 0")
    return found.select("o_orderkey", us("expected_at").alias("expected_us"), us("gave_up_at").alias("gave_up_us"))
