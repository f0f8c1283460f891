"""Hand-made cases of the validation, lifecycle, quality, annotation and geometry operators."""

import math

import pytest
from pyspark.sql import functions as F

from reelgrain.constants import DURATION_SECONDS, FILE_BYTES, RESOLUTION_PATTERN
from reelgrain.operators import annotate as an
from reelgrain.operators import config, drift, profile, quality, sync
from reelgrain.operators import geometry as g
from reelgrain.operators import joins as j
from reelgrain.operators import lifecycle as lc
from reelgrain.operators import validate as vd
from reelgrain.sources.discovery import latest


@pytest.fixture()
def rules(spark):
    return spark.createDataFrame([
        ("file_size", "length", *map(float, FILE_BYTES), None), ("duration", "duration", *map(float, DURATION_SECONDS), None),
        ("resolution", "resolution", None, None, RESOLUTION_PATTERN)], vd.RULES)


def videos(spark):
    return spark.createDataFrame(
        [("bad", 999_999, 9, [1280, 720]), ("good", 1_000_000, 600, [3840, 2160]), ("unknown", None, 10, [1920, 1080])],
        "id STRING, length BIGINT, duration INT, resolution ARRAY<INT>")


def test_validation(spark, rules):
    rows = {r.id: r for r in vd.validate(videos(spark), rules).collect()}
    assert rows["bad"].validation_results == {"file_size": False, "duration": False, "resolution": False}
    assert rows["good"].validation_passed and all(rows["good"].validation_results.values())
    assert rows["unknown"].validation_results == {"file_size": False, "duration": True, "resolution": True}
    assert not rows["unknown"].validation_passed


def test_gate(spark, rules):
    good, bad = vd.gate(vd.validate(videos(spark), rules))
    assert [r.id for r in good.collect()] == ["good"] and bad.count() == 2
    with pytest.raises(ValueError, match="validation failed"):
        vd.gate(vd.validate(videos(spark), rules), strict=True)
    assert vd.validate(videos(spark), rules.limit(0)).where("validation_passed").count() == 3


def test_gates_on_missing_things(spark):
    videos_, frames = spark.createDataFrame([("a",), ("b",)], "v STRING"), spark.createDataFrame([("a",)], "v STRING")
    assert {r.v: (r.frame_count, r.empty) for r in vd.require_nonempty(videos_, frames, "v").collect()} == {"a": (1, False), "b": (0, True)}
    assert [r.v for r in vd.require_artifacts(videos_, frames, "v").collect()] == ["b"]
    with pytest.raises(FileNotFoundError):
        vd.require_artifacts(videos_, frames, "v", strict=True)


def test_routing(spark):
    runs = spark.createDataFrame([(1, ["nerf", "object_detection"]), (2, ["nerf"]), (3, [])], "id INT, use_cases ARRAY<STRING>")
    routes = vd.route(runs, "use_cases", ["nerf", "object_detection"])
    assert {b: sorted(r.id for r in d.collect()) for b, d in routes.items()} == {"nerf": [1, 2], "object_detection": [1]}
    assert vd.routed(runs, "use_cases", ["nerf", "object_detection"]).count() == 3


def test_confidence_in_arrays(spark):
    df = spark.sql("SELECT array(named_struct('confidence', 0.25D), named_struct('confidence', 0.2D)) AS d")
    assert len(vd.confident(df, "d").first().d) == 1


def test_retention(spark):
    objects = spark.sql("""SELECT path, TIMESTAMP'2024-03-31' - make_interval(0, 0, 0, age) AS modificationTime FROM VALUES
      ('temp/a', 29), ('temp/b', 30), ('temp/c', 31), ('keep/d', 400), ('temp/x/e', 6) AS t(path, age)""")
    rules = spark.createDataFrame([("temp/", 30), ("temp/x/", 5), ("te", 90)], "prefix STRING, days INT")
    judged = lc.retention(objects, rules, F.lit("2024-03-31").cast("timestamp"))
    assert {r.path: (r.retention_days, r.expired) for r in judged.collect()} == {
        "temp/a": (30, False), "temp/b": (30, False), "temp/c": (30, True), "keep/d": (None, False), "temp/x/e": (5, True)}
    gone, kept = lc.expire(objects, rules, F.lit("2024-03-31").cast("timestamp"))
    assert gone.count() == 2 and kept.count() == 3 and kept.columns == objects.columns


def test_retention_with_many_rules(spark):
    objects = spark.sql("SELECT repeat('k', CAST(id + 1 AS INT)) || '/x' AS path, TIMESTAMP'2024-01-01' AS modificationTime FROM range(1100)"
                        " UNION ALL SELECT NULL, NULL UNION ALL SELECT 'other', NULL")
    rules = spark.sql("SELECT repeat('k', CAST(id + 1 AS INT)) || '/' AS prefix, CAST(id AS INT) AS days FROM range(1100)")
    judged = lc.retention(objects, rules, F.lit("2030-01-01").cast("timestamp")).collect()
    assert len(judged) == 1102
    assert {len(r.path) - 3: r.retention_days for r in judged if r.retention_days is not None} == {i: i for i in range(1100)}
    assert lc.retention(objects, rules.limit(0), F.lit("2030-01-01").cast("timestamp")).where("expired").count() == 0


def test_rules_of_one_name_hold_together(spark):
    rows = "('r', 'v', 1D, NULL, NULL), ('r', 'v', NULL, 5D, NULL)" + "".join(f", ('n{i}', 'v', 0D, NULL, NULL)" for i in range(1050))
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS t(rule, column, lo, hi, regex)")
    got = vd.validate(spark.sql("SELECT * FROM VALUES (0D), (3D), (9D), (NULL) AS t(v)"), rules).collect()
    assert {r.v: r.validation_results["r"] for r in got} == {0.0: False, 3.0: True, 9.0: False, None: False}


def test_nulls_and_zeros_have_a_result(spark):
    empty, full = spark.sql("SELECT CAST(NULL AS DOUBLE) AS v FROM range(3)"), spark.sql("SELECT CAST(id AS DOUBLE) AS v FROM range(3)")
    for method in ("psi", "ks"):
        assert drift.drift(full, empty, ["v"], 0.1, method).first().statistic is None
        assert drift.drift(empty, empty, ["v"], 0.1, method).count() == 0
    quotas = spark.createDataFrame([("a", 0)], "bucket STRING, quota BIGINT")
    sizes = spark.createDataFrame([("a", 0)], "bucket STRING, length BIGINT")
    assert quality.utilisation(sizes, quotas, "bucket", "length", "quota").first().utilisation is None
    assert quality.efficiency(sizes, sizes, ["bucket"], "length").first().saved is None


def test_asof_with_null_keys_and_text_ties(spark):
    left = spark.createDataFrame([("a", 5), (None, 5)], "k STRING, t BIGINT")
    right = spark.createDataFrame([("a", 3, "x"), ("a", 3, "y"), ("a", 7, "p"), ("a", 7, "q"), (None, 5, "z")], "k STRING, s BIGINT, id STRING")
    for per_slice in (500_000, 1):
        for direction, hit in (("backward", "y"), ("forward", "p"), ("nearest", "y")):
            got = sync.asof(left, right, ["k"], "t", "s", ["id"], "id", direction=direction, per_slice=per_slice)
            assert {r.k: r.id for r in got.collect()} == {"a": hit, None: None}
    asked = left.withColumn("n", F.monotonically_increasing_id())
    counts = sync.interval_counts(asked, right, ["k"], "n", "t", "s", 2).join(asked, "n")
    assert {r.k: r.matches for r in counts.collect()} == {"a": 4, None: 0}


def test_latest_of_text_dates_and_nulls(spark):
    rows = spark.sql("""SELECT * FROM VALUES ('a', 'v1', DATE'2024-01-01', 'p'), ('a', 'v2', DATE'2024-02-01', 'r'),
      ('a', 'v2', DATE'2024-02-01', 'q'), ('b', NULL, NULL, 's'), ('a', NULL, NULL, 'o') AS t(k, version, day, path)""")
    for by in ("version", "day"):
        assert {r.k: r.path for r in latest(rows, by, ["k"]).collect()} == {"a": "q", "b": "s"}


def test_versions(spark):
    old = spark.createDataFrame([("a", b"1"), ("b", b"1"), ("c", b"1")], "path STRING, content BINARY")
    new = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("d", b"1")], "path STRING, content BINARY")
    changes = lc.diff(lc.snapshot(old), lc.snapshot(new), "path")
    assert {r.path: r.change for r in changes.collect()} == {"b": "changed", "c": "removed", "d": "added"}
    assert lc.only_in(old.select("content"), new.select("content")).count() == 1
    assert [r.path for r in j.missing(old, new, "path").orderBy("path").collect()] == ["c"]


def test_quality_metrics_keep_intervals(spark):
    jobs = spark.sql("SELECT id AS polygon_count, make_dt_interval(0, 0, 0, id) AS processing_time FROM range(11)")
    row = quality.quality_metrics(jobs).first()
    assert row.avg_polygons == 5.0 and row.p90_processing_time.total_seconds() == 9.0
    rough = quality.quality_metrics(jobs, exact=False).first()
    assert rough.p90_processing_time.total_seconds() in (9.0, 10.0)


def test_utilisation(spark):
    objects = spark.createDataFrame([("models", 80), ("frames", 10)], "bucket STRING, length BIGINT")
    quotas = spark.createDataFrame([("models", 100), ("frames", 100), ("empty", 5)], "bucket STRING, quota BIGINT")
    got = {r.bucket: (r.used_bytes, r.alert) for r in quality.utilisation(objects, quotas, "bucket", "length", "quota").collect()}
    assert got == {"models": (80, True), "frames": (10, False), "empty": (0, False)}


def test_sla_counts_open_runs(spark):
    runs = spark.sql("""SELECT 'd' AS dag, TIMESTAMP'2024-01-01 00:00:00' AS s, e FROM VALUES
      (TIMESTAMP'2024-01-01 00:30:00'), (TIMESTAMP'2024-01-01 00:30:01'), (CAST(NULL AS TIMESTAMP)) AS t(e)""")
    row = quality.sla_report(runs, "s", "e", ["dag"]).first()
    assert (row.runs, row.missed, row.open, row.longest_seconds) == (3, 1, 1, 1801.0)


def test_last_attempt(spark):
    runs = spark.createDataFrame([("r", "t", 1, "failed"), ("r", "t", 3, "success"), ("r", "t", 2, "failed")],
                                 "run STRING, task STRING, try_number INT, state STRING")
    assert quality.last_attempt(runs, ["run", "task"], "try_number", "state").first().state == "success"


def test_efficiency_and_throughput(spark):
    raw, done = spark.createDataFrame([("v", 100)], "k STRING, n BIGINT"), spark.createDataFrame([("v", 27)], "k STRING, n BIGINT")
    assert quality.efficiency(raw, done, ["k"], "n").first().saved == pytest.approx(0.73)
    one = spark.sql("SELECT 'a' AS k, TIMESTAMP'2024-01-01' AS ts")
    assert quality.throughput(one, "ts", ["k"]).first().per_second is None


def test_detections(spark):
    df = spark.sql("SELECT 'f1' AS f, array(1, 2) AS d UNION ALL SELECT 'f2', array() UNION ALL SELECT 'f3', NULL")
    assert {r.f: r.detections_count for r in an.detections_per_frame(df, "f", "d").collect()} == {"f1": 2, "f2": 0, "f3": 0}
    frames, found = spark.createDataFrame([("f1",), ("f2",)], "f STRING"), spark.createDataFrame([("f1",), ("f1",)], "f STRING")
    assert {r.f: r.detections_count for r in an.count_detections(frames, found, "f").collect()} == {"f1": 2, "f2": 0}


def test_samples_and_splits_repeat(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("cam"), "id")
    first = an.sample_n(df, ["cam"], "id", 5, 1).collect()
    assert sorted(first) == sorted(an.sample_n(df.repartition(7), ["cam"], "id", 5, 1).collect()) and len(first) == 15
    assert sorted(first) != sorted(an.sample_n(df, ["cam"], "id", 5, 2).collect())
    sizes = {r.split: r["count"] for r in an.hash_split(df, "id", {"train": 80, "val": 10, "test": 10}).groupBy("split").count().collect()}
    assert sum(sizes.values()) == 1000 and 760 < sizes["train"] < 840
    with pytest.raises(ValueError):
        an.hash_split(df, "id", {"train": 80})


def test_prompt(spark):
    df = spark.createDataFrame([("c1", i, 0.5) for i in range(9)] + [("c2", 1, 0.25)], "cam STRING, frame INT, conf DOUBLE")
    rows = {r.cam: r for r in an.build_prompt(df, ["cam"], "frame", ["conf"], "camera %s: %s").collect()}
    assert rows["c2"].prompt == 'camera c2: [{"frame":1,"conf":0.25}]' and rows["c1"].samples == 5


def test_free_form_settings(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 5}, "c": "x"}'), (2, "not json")], "id INT, settings STRING")
    got = config.project_json(df, "settings", {"b": ("$.a.b", "int"), "c": ("$.c", "string")}, ["id"])
    assert {r.id: (r.b, r.c) for r in got.collect()} == {1: (5, "x"), 2: (None, None)}


def test_nested_columns_are_pruned(spark, tmp_path):
    spark.sql("SELECT 1 AS id, named_struct('iso', 100, 'focal_length', 2.0) AS exif").write.parquet(str(tmp_path / "f"))
    plan = config.project_config(spark.read.parquet(str(tmp_path / "f")), {"iso": "exif.iso"})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<exif:struct<iso:int>>" in plan


def test_entropy(spark):
    flat = spark.sql("SELECT 'flat' AS img, 7 AS v FROM range(16) UNION ALL SELECT 'full', id FROM range(16)")
    assert {r.img: r.entropy for r in g.entropy(flat, "img", "v").collect()} == {"flat": 0.0, "full": 4.0}


def test_ssim_of_equal_images_is_one(spark):
    img = spark.sql("SELECT 1 AS i, id % 16 AS x, id DIV 16 AS y, pmod(hash(id), 256) AS v FROM range(256)")
    row = g.ssim(img, img, "i", "x", "y", "v").first()
    assert row.ssim == pytest.approx(1.0) and row.accepted


def test_pose_and_point_errors(spark):
    pred = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("b", 1.0, 1.0, 1.0)], "c STRING, x DOUBLE, y DOUBLE, z DOUBLE")
    truth = spark.createDataFrame([("a", 3.0, 4.0, 0.0), ("b", 1.0, 1.0, 1.0)], "c STRING, x DOUBLE, y DOUBLE, z DOUBLE")
    mae, rms = g.pose_mae(pred, truth, "c").first(), g.rmse(pred, truth, "c").first()
    assert (mae.mae, mae.recalibrate) == (2.5, True) and rms.rmse == pytest.approx(math.sqrt(12.5))


def test_voxels(spark):
    points = spark.createDataFrame([("s", 0.1, 0.1, 0.1, 10), ("s", 0.3, 0.3, 0.3, 30), ("s", -0.1, 0.1, 0.1, 50)],
                                   "scene STRING, x DOUBLE, y DOUBLE, z DOUBLE, r INT")
    rows = {(r.vx, r.vy, r.vz): r for r in g.voxel_fuse(points, 1.0, "scene", colours=("r",)).collect()}
    assert rows[0, 0, 0].merged == 2 and rows[0, 0, 0].x == pytest.approx(0.2) and rows[0, 0, 0].r == 20 and rows[-1, 0, 0].merged == 1


def test_heatmap_of_one_point(spark):
    row = g.heatmap(spark.sql("SELECT 1.0D AS x, 2.0D AS y, 3.0D AS v"), "x", "y", 4, "v").first()
    assert (row.bin_x, row.bin_y, row.avg_value, row.n) == (0, 0, 3.0, 1)


@pytest.mark.parametrize("per_slice", [50, 10_000])
def test_drift(spark, per_slice):
    same = spark.range(600).select((F.col("id") % 100).cast("double").alias("v"))
    moved = same.select((F.col("v") + 50).alias("v"))
    assert drift.drift(same, same, ["v"], 0.1, "psi").first().statistic == pytest.approx(0.0)
    assert drift.drift(same, moved, ["v"], 0.1, "psi").first().drifted
    assert drift.drift(same, same, ["v"], 0.1, "ks", per_slice=per_slice).first().statistic == pytest.approx(0.0)
    assert drift.drift(same, moved, ["v"], 0.1, "ks", per_slice=per_slice).first().statistic == pytest.approx(0.5)
    steps = drift.ecdf(same, ["v"], per_slice).orderBy("value").collect()
    assert len(steps) == 100 and steps[49].cdf == pytest.approx(0.5) and steps[-1].cdf == 1.0


def test_profiles_agree(spark):
    df = spark.range(500).select((F.col("id") % 20).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("b"))
    for r in profile.profile(df, ["a", "b"], exact=True).collect():
        rough = profile.profile(df, ["a", "b"]).where(F.col("column") == r.column).first()
        assert (r.n, r.nulls, r.min, r.max, r.mean) == (rough.n, rough.nulls, rough.min, rough.max, rough.mean)
        assert r.distinct == (20 if r.column == "a" else 400)
    assert {r.column: (r.nulls, r.share) for r in profile.missing_values(df, ["a", "b"]).collect()} == {"a": (0, 0.0), "b": (100, 0.2)}
