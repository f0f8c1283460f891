"""Frame queries: `events` as frames, one video per user."""

from pyspark.sql import functions as F

from ..functions.paths import frame_name
from ..functions.values import stride, stride_from_fps, target_fps
from ..operators import frames as fr
from ..operators import sync
from ..operators.validate import require_nonempty
from ..sources.discovery import first_by, latest
from .registry import Tables, query, us

ORDER = ["ts", "event_id"]


@query("w1_sample_frames", """
WITH r AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events),
s AS (SELECT *, greatest(1, n // 30) AS step FROM r)
SELECT user_id, event_id, frame_idx, step, frame_idx // step AS seq FROM s WHERE frame_idx % step = 0
""")
def w1(t: Tables):
    rows = fr.sample_frames(t.events.select("user_id", "event_id", "ts"), "user_id", ORDER, 30)
    return rows.select("user_id", "event_id", "frame_idx", "step", "seq")


@query("w1_sample_frames_bounded", """
WITH r AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events),
s AS (SELECT *, greatest(1, (n + 29) // 30) AS step FROM r)
SELECT user_id, event_id, frame_idx, step, frame_idx // step AS seq FROM s WHERE frame_idx % step = 0
""")
def w1_bounded(t: Tables):
    rows = fr.sample_frames(t.events.select("user_id", "event_id", "ts"), "user_id", ORDER, 30, "ceil")
    return rows.select("user_id", "event_id", "frame_idx", "step", "seq")


@query("w2_index_frames", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx FROM events
""")
def w2(t: Tables):
    rows = fr.index_frames(t.events.select("user_id", "event_id", "ts"), "user_id", ORDER)
    return rows.select("user_id", "event_id", "frame_idx")


@query("w3_latest_per_video", """
SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1
""")
def w3(t: Tables):
    rows = t.events.select("user_id", "event_id", "ts", "value")
    return latest(rows, "ts", ["user_id"], "event_id").select("user_id", "event_id", "value")


@query("w6_best_frames", """
SELECT event_type, event_id, value, rn AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 20
""")
def w6(t: Tables):
    rows = t.events.select("event_type", "event_id", "value")
    return fr.best_frames(rows, "event_type", "value", 20, "event_id")


@query("w7_frame_gaps", """
WITH g AS (
  SELECT user_id, event_id,
         (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / CAST(1000000 AS DOUBLE) AS gap
  FROM events)
SELECT user_id, event_id, round(gap, 6) AS gap_seconds, coalesce(gap > 6144, false) AS dropped,
       CASE WHEN gap > 6144 THEN CAST(greatest(0, round(gap / 4096) - 1) AS BIGINT) ELSE 0 END AS missing_frames
FROM g
""")
def w7(t: Tables):
    rows = fr.gaps(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", 1 / 4096)
    return rows.select("user_id", "event_id", F.round("gap_seconds", 6).alias("gap_seconds"), "dropped", "missing_frames")


@query("w9_resample_fps", """
WITH s AS (
  SELECT *, CAST(floor((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / CAST(1000000 AS DOUBLE) / 4096) AS BIGINT) AS slot
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY ts, event_id) AS rn FROM s)
SELECT user_id, slot, event_id, value FROM r WHERE rn = 1
""")
def w9(t: Tables):
    rows = fr.resample_fps(t.events.select("user_id", "event_id", "ts", "value"), "user_id", "ts", "event_id", 1 / 4096)
    return rows.select("user_id", "slot", "event_id", "value")


@query("w9_resample_fps_filled", """
WITH s AS (
  SELECT *, CAST(floor((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / CAST(1000000 AS DOUBLE) / 65536) AS BIGINT) AS slot
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY ts, event_id) AS rn FROM s),
p AS (SELECT user_id, slot, event_id FROM r WHERE rn = 1),
g AS (SELECT user_id, unnest(range(0, max(slot) + 1)) AS slot FROM p GROUP BY user_id)
SELECT g.user_id, g.slot, p.event_id FROM g ASOF JOIN p ON g.user_id = p.user_id AND g.slot >= p.slot
""")
def w9_filled(t: Tables):
    rows = fr.resample_fps(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", 1 / 65536, fill=True)
    return rows.select("user_id", "slot", "event_id")


@query("e1_frame_count", "SELECT user_id, count(*) AS frame_count FROM events GROUP BY user_id")
def e1(t: Tables):
    return fr.frame_count(t.events, "user_id")


@query("f10_nonempty_gate", """
SELECT c_custkey, count(o_orderkey) AS frame_count, count(o_orderkey) = 0 AS "empty"
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
""")
def f10(t: Tables):
    frames = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return require_nonempty(t.customer.select("c_custkey"), frames, "c_custkey")


@query("x4_frame_plan", """
WITH v AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
s AS (SELECT *, greatest(1, n // 30) AS step FROM v),
u AS (SELECT user_id, step, unnest(range(0, n, step)) AS frame_idx FROM s)
SELECT user_id, frame_idx // step AS seq, frame_idx, printf('frame_%06d.png', frame_idx // step) AS frame_name FROM u
""")
def x4(t: Tables):
    plan = fr.frame_plan(fr.frame_count(t.events, "user_id"), "user_id", "frame_count", 30)
    return plan.select("user_id", "seq", "frame_idx", "frame_name")


@query("p1_p3_sampling_columns", """
SELECT o_orderkey, least(2.0, CAST(o_custkey AS DOUBLE) / 100) AS target_fps, greatest(1, o_orderkey // 300) AS step_floor,
       greatest(1, (o_orderkey + 299) // 300) AS step_ceil,
       CAST(floor(o_orderkey / least(2.0, (CAST(o_custkey AS DOUBLE) + 1) / 100)) AS BIGINT) AS step_fps
FROM orders
""")
def p1_p3(t: Tables):
    fps, total = F.col("o_custkey").cast("double") / 100, F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", target_fps(fps).alias("target_fps"), stride(total).alias("step_floor"),
        stride(total, mode="ceil").alias("step_ceil"),
        stride_from_fps(total, (F.col("o_custkey").cast("double") + 1) / 100).alias("step_fps"))


@query("s7_frame_names", """
SELECT event_id, printf('frame_%06d.png', event_id) AS png, printf('frame_%04d.jpg', event_id + 1) AS jpg FROM events
""")
def s7(t: Tables):
    i = F.col("event_id")
    return t.events.select("event_id", frame_name(i).alias("png"), frame_name(i, 4, "jpg", 1).alias("jpg"))


def _clicks_views(t: Tables):
    clicks = t.events.where("event_type = 'click'").select("user_id", "event_id", "ts")
    views = t.events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return clicks, views


@query("j7_asof_backward", """
WITH l AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'),
r AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view')
SELECT l.user_id, l.event_id, r.view_id, epoch_us(r.view_ts) AS view_us
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.view_ts
""")
def j7_backward(t: Tables):
    clicks, views = _clicks_views(t)
    rows = sync.asof(clicks, views, ["user_id"], "ts", "view_ts", ["view_id", "view_ts"], "view_id")
    return rows.select("user_id", "event_id", "view_id", us("view_ts").alias("view_us"))


@query("j7_asof_forward", """
WITH l AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'),
r AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view')
SELECT l.user_id, l.event_id, r.view_id
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.view_ts
""")
def j7_forward(t: Tables):
    clicks, views = _clicks_views(t)
    rows = sync.asof(clicks, views, ["user_id"], "ts", "view_ts", ["view_id"], "view_id", direction="forward")
    return rows.select("user_id", "event_id", "view_id")


@query("j7_asof_nearest", """
WITH l AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'),
r AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view'),
p AS (SELECT l.user_id, l.event_id, r.view_id, row_number() OVER (PARTITION BY l.event_id ORDER BY
        abs(epoch_us(r.view_ts) - epoch_us(l.ts)), r.view_ts, r.view_id DESC) AS rn
      FROM l JOIN r ON l.user_id = r.user_id AND abs(epoch_us(r.view_ts) - epoch_us(l.ts)) <= 7200000000)
SELECT l.user_id, l.event_id, p.view_id FROM l LEFT JOIN p ON p.event_id = l.event_id AND p.rn = 1
""")
def j7_nearest(t: Tables):
    clicks, views = _clicks_views(t)
    rows = sync.asof(clicks, views, ["user_id"], "ts", "view_ts", ["view_id"], "view_id", tolerance=7_200_000_000,
                     direction="nearest")
    return rows.select("user_id", "event_id", "view_id")


@query("j7_interval_counts", """
WITH l AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'),
r AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view')
SELECT l.event_id, count(r.view_id) AS matches
FROM l LEFT JOIN r ON l.user_id = r.user_id AND abs(epoch_us(r.view_ts) - epoch_us(l.ts)) <= 86400000000
GROUP BY l.event_id
""")
def j7_interval(t: Tables):
    clicks, views = _clicks_views(t)
    return sync.interval_counts(clicks, views, ["user_id"], "event_id", "ts", "view_ts", 86_400_000_000)


@query("l1_latest_object", """
SELECT event_id, epoch_us(ts) AS ts_us FROM events ORDER BY ts DESC, event_id LIMIT 1
""")
def l1(t: Tables):
    return latest(t.events.select("event_id", "ts"), "ts", tie="event_id").select("event_id", us("ts").alias("ts_us"))


@query("l3_first_match", "SELECT url, page_id FROM pages ORDER BY url, page_id LIMIT 1")
def l3(t: Tables):
    return first_by(t.pages.select("url", "page_id"), ["url", "page_id"])
