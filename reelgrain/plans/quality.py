"""Job history queries: `orders` as jobs and runs, `documents` as stored objects."""

from pyspark.sql import functions as F

from ..operators import quality as q
from .registry import Tables, cents, query


def jobs(t: Tables):
    """Orders as jobs: line count as polygons, price as seconds."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("polygon_count"))
    return t.orders.join(lines, "o_orderkey", "left").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", F.coalesce("polygon_count", F.lit(0).cast("long")).alias("polygon_count"),
        F.col("o_totalprice").alias("processing_time"))


JOBS_SQL = """
WITH jobs AS (
  SELECT o_orderkey, o_orderpriority, o_orderdate, coalesce(n, 0) AS polygon_count, o_totalprice AS processing_time
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)
"""


@query("e4_quality_metrics", JOBS_SQL + """
SELECT round(avg(polygon_count), 6) AS avg_polygons, round(quantile_cont(processing_time, 0.9), 6) AS p90_processing_time FROM jobs
""")
def e4(t: Tables):
    stats = q.quality_metrics(jobs(t))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@query("e4_quality_metrics_per_group", JOBS_SQL + """
SELECT o_orderpriority, round(avg(polygon_count), 6) AS avg_polygons,
       round(quantile_cont(processing_time, 0.9), 6) AS p90_processing_time
FROM jobs GROUP BY o_orderpriority
""")
def e4_keys(t: Tables):
    stats = q.quality_metrics(jobs(t), keys=["o_orderpriority"])
    return stats.select("o_orderpriority", *[F.round(c, 6).alias(c) for c in stats.columns[1:]])


@query("e4_quality_metrics_interval", """
SELECT round(quantile_cont(o_totalprice, 0.9), 6) AS p90_seconds FROM orders
""")
def e4_interval(t: Tables):
    timed = t.orders.select(F.lit(1).alias("polygon_count"), F.make_dt_interval(
        secs=F.col("o_totalprice").cast("decimal(18,6)")).alias("processing_time"))
    stats = q.quality_metrics(timed)
    return stats.select(F.round(q.interval_seconds(F.col("p90_processing_time")), 6).alias("p90_seconds"))


@query("e5_success_rate", """
SELECT o_orderpriority, count(*) AS runs, count(*) FILTER (o_orderstatus = 'F') AS succeeded,
       round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS rate,
       avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) < 0.85 AS alert
FROM orders GROUP BY o_orderpriority
""")
def e5(t: Tables):
    rates = q.success_rate(t.orders, ["o_orderpriority"], "o_orderstatus", "F", 0.85)
    return rates.withColumn("rate", F.round("rate", 6))


@query("e6_storage_utilisation", """
SELECT source, 150000 AS quota, sum(n_chars)::BIGINT AS used_bytes, round(sum(n_chars) / 150000, 6) AS utilisation,
       sum(n_chars) / 150000 > 0.75 AS alert
FROM documents GROUP BY source
""")
def e6(t: Tables):
    quotas = t.documents.select("source").distinct().withColumn("quota", F.lit(150_000))
    used = q.utilisation(t.documents, quotas, "source", "n_chars", "quota")
    return used.withColumn("utilisation", F.round("utilisation", 6))


@query("e7_storage_efficiency", """
WITH p AS (SELECT source, sum(n_chars) AS b FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source)
SELECT d.source, sum(n_chars)::BIGINT AS raw_bytes, coalesce(any_value(p.b), 0)::BIGINT AS processed_bytes,
       round(1 - coalesce(any_value(p.b), 0) / sum(n_chars), 6) AS saved
FROM documents d LEFT JOIN p ON p.source = d.source GROUP BY d.source
""")
def e7(t: Tables):
    done = t.documents.join(t.labels, "doc_id", "left_semi")
    return q.efficiency(t.documents, done, ["source"], "n_chars").withColumn("saved", F.round("saved", 6))


@query("e8_throughput", """
SELECT event_type, count(*) AS "rows", round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS seconds,
       round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS per_second
FROM events GROUP BY event_type
""")
def e8(t: Tables):
    stats = q.throughput(t.events, "ts", ["event_type"])
    return stats.select("event_type", "rows", F.round("seconds", 6).alias("seconds"), F.round("per_second", 6).alias("per_second"))


@query("e9_lag_report", """
WITH l AS (SELECT o_orderpriority, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1e6 AS lag
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderpriority, count(*) AS "rows", count(*) FILTER (lag > 900) AS late, round(max(lag), 3) AS max_lag,
       round(quantile_cont(lag, 0.9), 3) AS quantile_lag
FROM l GROUP BY o_orderpriority
""")
def e9(t: Tables):
    moved = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate"), "o_orderkey")
    lag = q.seconds_between(F.col("o_orderdate"), F.col("l_shipdate"))
    stats = q.lag_report(moved, lag, ["o_orderpriority"])
    return stats.withColumns({c: F.round(c, 3) for c in ("max_lag", "quantile_lag")})


@query("e10_sla_report", """
WITH e AS (SELECT l_orderkey, max(l_shipdate) AS end_ts FROM lineitem GROUP BY l_orderkey),
r AS (SELECT o_orderpriority, end_ts, (epoch_us(end_ts) - epoch_us(o_orderdate)) / 1e6 AS took
      FROM orders LEFT JOIN e ON l_orderkey = o_orderkey)
SELECT o_orderpriority, count(*) AS runs, count(*) FILTER (took > 1800) AS missed, count(*) FILTER (end_ts IS NULL) AS "open",
       round(max(took), 3) AS longest_seconds
FROM r GROUP BY o_orderpriority
""")
def e10(t: Tables):
    ends = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("end_ts"))
    runs = t.orders.join(ends, "o_orderkey", "left")
    report = q.sla_report(runs, "o_orderdate", "end_ts", ["o_orderpriority"])
    return report.withColumn("longest_seconds", F.round("longest_seconds", 3))


@query("e15_polygon_drift", JOBS_SQL + """
, h AS (SELECT *, o_orderdate < TIMESTAMP '1998-07-01' AS old FROM jobs)
SELECT o_orderpriority, round(avg(polygon_count) FILTER (old), 6) AS reference,
       round(avg(polygon_count) FILTER (NOT old), 6) AS current,
       round(abs(avg(polygon_count) FILTER (NOT old) - avg(polygon_count) FILTER (old)) / avg(polygon_count) FILTER (old), 6) AS change,
       abs(avg(polygon_count) FILTER (NOT old) - avg(polygon_count) FILTER (old)) / avg(polygon_count) FILTER (old) > 0.15 AS drifted
FROM h GROUP BY o_orderpriority
""")
def e15(t: Tables):
    old = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    rows = q.metric_drift(jobs(t).where(old), jobs(t).where(~old), ["o_orderpriority"], F.avg("polygon_count"))
    return rows.withColumns({c: F.round(c, 6) for c in ("reference", "current", "change")})


@query("e21_control_limits", """
WITH b AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events
           WHERE ts < TIMESTAMP '2024-01-16' GROUP BY event_type)
SELECT e.event_id, e.event_type, e.value, round(m - 3 * s, 6) AS lower, round(m + 3 * s, 6) AS upper,
       coalesce(value < m - 3 * s OR value > m + 3 * s, false) AS outside
FROM events e LEFT JOIN b ON b.event_type = e.event_type WHERE ts >= TIMESTAMP '2024-01-16'
""")
def e21(t: Tables):
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    rows = t.events.select("event_id", "event_type", "value", "ts")
    flagged = q.control_limits(rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut).drop("ts"), ["event_type"], "value")
    return flagged.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("w4_j9_rolling_baseline", """
WITH c AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cost FROM orders),
w AS (SELECT o_orderpriority, o_orderkey, cost, avg(cost) OVER (
        PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS b FROM c)
SELECT o_orderpriority, o_orderkey, cost, round(b, 4) AS baseline, coalesce(cost > 2.0 * b, false) AS slow FROM w
""")
def w4(t: Tables):
    runs = t.orders.select("o_orderpriority", "o_orderkey", "o_orderdate", cents("o_totalprice").alias("cost"))
    rows = q.slow_runs(runs, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "cost")
    return rows.select("o_orderpriority", "o_orderkey", "cost", F.round("baseline", 4).alias("baseline"), "slow")


@query("w5_last_attempt", """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1
""")
def w5(t: Tables):
    runs = t.events.select("user_id", "event_type", "event_id", "ts")
    return q.last_attempt(runs, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")
