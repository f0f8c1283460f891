"""Registered queries on skewed tables, with slices forced: one key has a third of the rows, vectors have many copies."""

import inspect

import pytest
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelgrain.operators import drift, frames, ordered, profile, quality, sync

SOURCE = "/root/testdata/sf0.001"
NAMES = [
    "w1_sample_frames", "w2_index_frames", "w4_j9_rolling_baseline", "w7_frame_gaps", "w8_empirical_cdf", "w9_resample_fps_filled",
    "e4_quality_metrics_per_group", "e9_lag_report", "e12_profile_exact", "e13_drift_ks", "j7_asof_backward", "j7_asof_nearest",
    "j7_interval_counts", "j5_nearest_in_scene", "j5_mutual_matches", "j11_components", "k3_running_anomalies",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    for name in ("events", "orders", "lineitem", "embeddings", "documents", "labels"):
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        if name == "events":
            df = df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
        if name == "orders":
            df = df.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, F.lit("2-HIGH")).otherwise(F.col("o_orderpriority")))
        if name == "embeddings":
            first = df.orderBy("vec_id").select("embedding").first()[0]
            copy = F.array(*[F.lit(x).cast("float") for x in first])
            df = df.withColumn("embedding", F.when(F.col("vec_id") % 3 == 0, copy).otherwise(F.col("embedding")))
            df = df.withColumn("label", F.when(F.col("vec_id") % 3 == 0, F.lit(0)).otherwise(F.col("label")))
        df.coalesce(1).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


@pytest.fixture()
def forced(monkeypatch):
    for module in (ordered, frames, sync, drift, profile, quality):
        for f in vars(module).values():
            if inspect.isfunction(f) and f.__defaults__ and ordered.ROWS_PER_SLICE in f.__defaults__:
                monkeypatch.setattr(f, "__defaults__", tuple(100 if d == ordered.ROWS_PER_SLICE else d for d in f.__defaults__))
    from reelgrain.operators import match
    monkeypatch.setattr(match.nearest, "__defaults__", tuple(64 if d == match.BLOCK_ROWS else d for d in match.nearest.__defaults__))


class Folder:
    """DuckDB reads the folders that Spark writes."""

    def __init__(self, root):
        import duckdb

        self.con = duckdb.connect()
        for name in ("events", "orders", "lineitem", "embeddings", "documents", "labels"):
            self.con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")

    def execute(self, sql):
        return self.con.execute(sql)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, forced, name):
    assert compare(spark, Folder(skewed), entry.queries()[name], entry.oracle_sql()[name], skewed) is None
