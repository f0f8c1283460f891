"""The ordered operators with limits so low that keys of the smallest tables are cut: all tables, the same SQL."""

from pyspark.sql import functions as F

from ..operators import drift as d
from ..operators import frames as fr
from ..operators import quality as q
from ..operators import sync
from .frames import ORDER, _clicks_views
from .quality import jobs
from .registry import ORACLES, Tables, cents, query, us

#: Rows of a user, and of a larger group, that stay in one slice.
FEW, MANY = 4, 200


@query("w1_sample_frames_sliced", ORACLES["w1_sample_frames"])
def w1(t: Tables):
    rows = fr.sample_frames(t.events.select("user_id", "event_id", "ts"), "user_id", ORDER, 30, per_slice=FEW)
    return rows.select("user_id", "event_id", "frame_idx", "step", "seq")


@query("w2_index_by_name_sliced", """
SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name, c_custkey) - 1 AS frame_idx FROM customer
""")
def w2(t: Tables):
    # names share a long beginning
    rows = fr.index_frames(t.customer.select("c_mktsegment", "c_custkey", "c_name"), "c_mktsegment", ["c_name", "c_custkey"], per_slice=FEW)
    return rows.select("c_custkey", "frame_idx")


@query("w4_rolling_baseline_sliced", ORACLES["w4_j9_rolling_baseline"])
def w4(t: Tables):
    runs = t.orders.select("o_orderpriority", "o_orderkey", "o_orderdate", cents("o_totalprice").alias("cost"))
    rows = q.slow_runs(runs, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "cost", per_slice=MANY)
    return rows.select("o_orderpriority", "o_orderkey", "cost", F.round("baseline", 4).alias("baseline"), "slow")


@query("w7_frame_gaps_sliced", ORACLES["w7_frame_gaps"])
def w7(t: Tables):
    rows = fr.gaps(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", 1 / 4096, per_slice=FEW)
    return rows.select("user_id", "event_id", F.round("gap_seconds", 6).alias("gap_seconds"), "dropped", "missing_frames")


@query("w8_empirical_cdf_sliced", ORACLES["w8_empirical_cdf"])
def w8(t: Tables):
    return d.ecdf(t.events, ["value"], per_slice=MANY).withColumn("cdf", F.round("cdf", 6))


@query("e4_quality_metrics_sliced", ORACLES["e4_quality_metrics_per_group"])
def e4(t: Tables):
    stats = q.quality_metrics(jobs(t), keys=["o_orderpriority"], per_slice=MANY)
    return stats.select("o_orderpriority", *[F.round(c, 6).alias(c) for c in stats.columns[1:]])


@query("j7_asof_backward_sliced", ORACLES["j7_asof_backward"])
def j7_backward(t: Tables):
    clicks, views = _clicks_views(t)
    rows = sync.asof(clicks, views, ["user_id"], "ts", "view_ts", ["view_id", "view_ts"], "view_id", per_slice=FEW)
    return rows.select("user_id", "event_id", "view_id", us("view_ts").alias("view_us"))


@query("j7_interval_counts_sliced", ORACLES["j7_interval_counts"])
def j7_interval(t: Tables):
    clicks, views = _clicks_views(t)
    return sync.interval_counts(clicks, views, ["user_id"], "event_id", "ts", "view_ts", 86_400_000_000, per_slice=FEW)
