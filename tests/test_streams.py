"""Streaming jobs with `availableNow` triggers."""

import random

import pytest
from pyspark.sql import functions as F

from reelgrain.operators.validate import RULES
from reelgrain.session import scratch_path
from reelgrain.streaming import anomalies as an
from reelgrain.streaming import ingest as ing
from reelgrain.streaming import windows as win


def test_each_object_is_taken_once(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.mp4").write_bytes(b"1")
    (root / "n.txt").write_bytes(b"1")
    target, log = str(tmp_path / "out"), str(tmp_path / "log")

    def run():
        ing.ingest(ing.watch_objects(spark, str(root)), target, log).awaitTermination()
        return sorted(r.path.rsplit("/", 1)[-1] for r in spark.read.parquet(target).collect())

    assert run() == ["a.mp4"]
    assert run() == ["a.mp4"]
    (root / "b.mov").write_bytes(b"22")
    assert run() == ["a.mp4", "b.mov"]
    (root / "ab.mov").write_bytes(b"333")
    one = ing.watch_path(spark, str(root), "b.mov")
    ing.ingest(one, str(tmp_path / "one"), str(tmp_path / "log1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "one")).count() == 1


def test_validated_stream_is_split(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for name, size in (("a.mp4", 5), ("b.mp4", 500)):
        (root / name).write_bytes(b"x" * size)
    rules = spark.createDataFrame([("file_size", "length", 10.0, 1000.0, None)], RULES)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    ing.validate_stream(ing.watch_objects(spark, str(root)), rules, good, bad, str(tmp_path / "log")).awaitTermination()
    assert spark.read.parquet(good).first().path.endswith("b.mp4")
    assert spark.read.parquet(bad).first().validation_results == {"file_size": False}


def _frames(spark, path, rows):
    spark.createDataFrame(rows, "cam STRING, id INT, s BIGINT, v DOUBLE").select(
        "cam", "id", F.timestamp_seconds("s").alias("ts"), "v").coalesce(1).write.mode("append").parquet(path)


def _run(spark, stream, tmp_path, name):
    target = str(tmp_path / name)
    ing.ingest(stream, target, str(tmp_path / f"{name}-log")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def test_windows_on_a_stream_match_the_table(spark, tmp_path):
    src = str(tmp_path / "src")
    _frames(spark, src, [("a", i, i * 20, float(i)) for i in range(300)])
    stream = spark.readStream.schema("cam STRING, id INT, ts TIMESTAMP, v DOUBLE").parquet(src)
    got = _run(spark, win.window_metrics(stream, "ts", "1 minute", ["cam"], "v"), tmp_path, "w")
    table = win.window_metrics(spark.read.parquet(src), "ts", "1 minute", ["cam"], "v")
    closed = F.lit(299 * 20 - 15 * 60)
    want = table.where(F.unix_timestamp("window_start") + 60 <= closed)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert 0 < got.count() < table.count()
    # the other way to read it holds the open windows as well
    target = str(tmp_path / "updates")
    ing.ingest_updates(win.window_metrics(stream, "ts", "1 minute", ["cam"], "v"), target, str(tmp_path / "log_u")).awaitTermination()
    every = ing.current_rows(spark.read.parquet(target), ["cam", "window_start"])
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, table.collect()))
    picked = _run(spark, win.sample_stream(stream, "cam", "ts", "id", "1 minute"), tmp_path, "s")
    assert [r.id for r in picked.orderBy("id").limit(3).collect()] == [0, 3, 6]


def test_repeats_are_dropped(spark, tmp_path):
    src = str(tmp_path / "src")
    _frames(spark, src, [("a", 1, 0, 1.0), ("a", 1, 5, 1.0), ("a", 2, 9, 1.0)])
    stream = spark.readStream.schema("cam STRING, id INT, ts TIMESTAMP, v DOUBLE").parquet(src)
    assert _run(spark, ing.dedupe(stream, "id", "ts", "1 minute"), tmp_path, "d").count() == 2


def test_lag_alerts(spark):
    rows = spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-01 00:00:00' AS ts, TIMESTAMP'2024-01-01 00:16:00' AS done UNION ALL "
                     "SELECT 2, TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-01 00:15:00'")
    assert [(r.id, r.lag_seconds) for r in win.lag_alerts(rows, "ts", "done").collect()] == [(1, 960.0)]


def test_running_anomalies_use_earlier_batches(spark, tmp_path):
    src = tmp_path / "src"
    schema = "cam STRING, id INT, ts TIMESTAMP, v DOUBLE"
    _frames(spark, str(src), [("a", i, i, 10.0 + (i % 3)) for i in range(60)])
    stream = spark.readStream.schema(schema).parquet(str(src))
    flagged = an.anomalies(stream, "cam", "v", ["id"])
    assert _run(spark, flagged, tmp_path, "x").where("anomaly").count() == 0
    _frames(spark, str(src), [("a", 100, 100, 11.0), ("a", 101, 101, 99.0)])
    stream = spark.readStream.schema(schema).parquet(str(src))
    rows = _run(spark, an.anomalies(stream, "cam", "v", ["id"]), tmp_path, "x")
    assert [r.id for r in rows.where("anomaly").collect()] == [101]


def test_judged_stream_agrees_with_the_stateful_one(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "j")
    schema = "cam STRING, id INT, ts TIMESTAMP, v DOUBLE"
    batches = [[("a", i, i, 10.0 + (i % 3)) for i in range(60)], [("a", 100, 100, 11.0), ("a", 101, 101, 99.0), ("b", 102, 102, 99.0)],
               [("a", 103, 103, 40.0), ("b", 104, 104, 1.0)]]
    for rows in batches:
        _frames(spark, src, rows)
        stream = spark.readStream.schema(schema).parquet(src)
        judged = an.judge_stream(stream, "cam", "v", ["id"], f"{base}/out", f"{base}/state", f"{base}/log")
        judged.awaitTermination()
        both = _run(spark, an.anomalies(spark.readStream.schema(schema).parquet(src), "cam", "v", ["id"]), tmp_path, "y")
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == 65
    assert sorted(r.id for r in got.where("anomaly").collect()) == sorted(r.id for r in both.where("anomaly").collect()) == [101]
    state = {r.cam: r for r in spark.read.parquet(f"{base}/state").where("batch_id = 2").collect()}
    values = [10.0 + (i % 3) for i in range(60)] + [11.0, 99.0, 40.0]
    assert state["a"].n == 63 and state["a"].mean == pytest.approx(sum(values) / 63)
    assert state["a"].m2 == pytest.approx(sum((v - sum(values) / 63) ** 2 for v in values))


@pytest.mark.parametrize("cuts", [1, 3])
def test_window_anomalies_do_not_depend_on_arrivals(spark, tmp_path, cuts):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), i, rng.randrange(40) * 600, rng.gauss(10, 1) + 9 * (i % 37 == 0)) for i in range(400)] + [("a", 900, 100, None), ("c", 901, 5, 1.0)]
    src, base = str(tmp_path / "src"), str(tmp_path / "out")
    for part in range(cuts):
        _frames(spark, src, rows[part::cuts])
        stream = spark.readStream.schema("cam STRING, id INT, ts TIMESTAMP, v DOUBLE").parquet(src)
        sums = an.window_sums(stream, "cam", "ts", "v", "1 hour", delay="2 days")
        ing.ingest_updates(sums, f"{base}/sums", f"{base}/log").awaitTermination()
    current = ing.current_rows(spark.read.parquet(f"{base}/sums"), ["cam", "window_start"])
    judged = an.judge_windows(spark.read.parquet(src), current, "cam", "ts", "v", "1 hour")
    want = {}
    for cam, i, at, v in rows:
        before = [w for c, _, t, w in rows if c == cam and w is not None and t // 3600 < at // 3600]
        mean = sum(before) / len(before) if before else 0
        spread = (sum((w - mean) ** 2 for w in before) / (len(before) - 1)) ** 0.5 if len(before) > 1 else 0
        want[i] = v is not None and len(before) >= 10 and abs(v - mean) > 3 * spread
    assert {r.id: r.anomaly for r in judged.collect()} == want and sum(want.values()) > 3


def test_threshold_flags(spark):
    rows = spark.createDataFrame([(1.0,), (5.0,)], "v DOUBLE")
    assert [r.anomaly for r in an.flag_threshold(rows, "v", 0.0, 2.0).collect()] == [False, True]


def test_fold_matches_numpy():
    import numpy as np

    values = np.random.default_rng(0).normal(size=500)
    state = (0, 0.0, 0.0)
    for part in np.split(values, [3, 50, 51, 400]):
        state = an._fold(state, part)
    assert state[0] == 500 and state[1] == pytest.approx(values.mean())
    assert state[2] / 499 == pytest.approx(values.var(ddof=1))


def test_overdue(spark):
    expected = spark.sql("SELECT 'a' AS path, TIMESTAMP'2024-01-01 00:00:00' AS expected_at UNION ALL "
                         "SELECT 'b', TIMESTAMP'2024-01-01 00:00:00' UNION ALL SELECT 'c', TIMESTAMP'2024-01-01 02:00:00'")
    objects = spark.createDataFrame([("b",)], "path STRING")
    late = ing.overdue(expected, objects, F.lit("2024-01-01 02:30:00").cast("timestamp"))
    assert [r.path for r in late.collect()] == ["a"]


def test_scratch_is_under_the_given_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
