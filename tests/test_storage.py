"""Listings, discovery, sidecars, sinks and publishing on temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from reelgrain.sinks import artifacts as art
from reelgrain.sinks import publish as pub
from reelgrain.sources import discovery as dis
from reelgrain.sources import objects as obj
from reelgrain.sources import tables as tab
from reelgrain.sources import tree


@pytest.fixture()
def videos(tmp_path):
    root = tmp_path / "videos"
    (root / "deep" / "er").mkdir(parents=True)
    for i, name in enumerate(("x.mp4", "y.mov", "z.MP4", "n.txt", "deep/er/w.avi")):
        path = root / name
        path.write_bytes(b"a" * (i + 1))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return root


def names(df, column="path"):
    return sorted(r[0].rsplit("/", 1)[-1] for r in df.select(column).collect())


VIDEO = (".mp4", ".mov", ".avi")


def test_listing(spark, videos):
    root = str(videos)
    assert names(obj.list_objects(spark, root, exts=VIDEO)) == ["x.mp4", "y.mov"]
    assert names(obj.list_objects(spark, root, exts=VIDEO, recursive=True)) == ["w.avi", "x.mp4", "y.mov"]
    assert names(obj.list_objects(spark, root, exts=VIDEO, ignore_case=True)) == ["x.mp4", "y.mov", "z.MP4"]
    assert names(obj.list_objects(spark, root, prefix="deep/", recursive=True)) == ["w.avi"]
    assert obj.list_objects(spark, root).columns == ["path", "length", "modificationTime"]


def test_listing_reads_no_content(spark, videos):
    plan = obj.list_objects(spark, str(videos))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_length_filter_reaches_the_source(spark, videos):
    plan = obj.list_objects(spark, str(videos)).where("length > 2")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length,2)" in plan


def test_read_objects(spark, videos):
    keys = obj.list_objects(spark, str(videos), exts=(".mov",)).select("path")
    read = obj.read_objects(spark, keys, str(videos))
    assert [bytes(r.content) for r in read.collect()] == [b"aa"]
    assert "content:binary" not in read._jdf.queryExecution().executedPlan().toString()


def test_discovery(spark, videos):
    found = obj.list_objects(spark, str(videos), exts=VIDEO, recursive=True)
    roots = [f"file:{videos}/none", f"file:{videos}/deep", f"file:{videos}"]
    assert names(dis.first_nonempty(found, roots)) == ["w.avi"]
    assert names(dis.first_nonempty(found, [f"{videos}/none", f"{videos}/deep"])) == ["w.avi"]
    assert names(dis.latest(found, "modificationTime")) == ["w.avi"]
    assert names(dis.first_by(found, "path")) == ["w.avi"]
    mp4 = found.where("path LIKE '%x.mp4'").first().path
    requests = spark.createDataFrame([(1, mp4), (2, "file:/gone.mp4"), (3, None)], "id INT, requested_path STRING")
    chosen = {r.id: r.selected_path.rsplit("/", 1)[-1] for r in dis.select_or_latest(found, requests).collect()}
    assert chosen == {1: "x.mp4", 2: "w.avi", 3: "w.avi"}


def test_latest_ties_go_to_the_smallest_path(spark):
    rows = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "path STRING, t INT")
    assert dis.latest(rows, "t").first().path == "a"
    assert dis.latest(rows.limit(0), "t").count() == 0


def _sidecar(folder, name, value):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(value))


def test_sidecars(spark, tmp_path):
    place = dict(zip(("lat", "lon", "elevation"), (-12.5, 130.25, 7)))
    _sidecar(tmp_path / "meta", "dock.json", {
        "camera_id": "dock-north", "timestamp": "2019-02-03T04:05:06Z", "duration": 95, "resolution": [640, 360], "fps": 12, "codec": "vp8", "position": place})
    row = tab.read_sidecars(spark, str(tmp_path / "meta"), tab.VIDEO_METADATA).first()
    assert row.resolution == [640, 360] and row.position.elevation == 7.0
    stages = {"frame_extraction": {"fps": 2, "quality": 40}, "object_detection": {"enabled": False, "model": "tiny", "confidence": 0.75}, "nerf": {"enabled": True},
              "3d_reconstruction": {"enabled": False, "method": "none", "settings": {"detail_level": "draft"}}}
    _sidecar(tmp_path / "event", "race.json", {"event_id": "race-7", "venue_id": "harbour", "date": "2019-02-03", "pipeline_config": stages})
    config = tab.read_sidecars(spark, str(tmp_path / "event"), tab.EVENT_CONFIG)
    row = config.select("pipeline_config.frame_extraction.fps", F.col("pipeline_config.`3d_reconstruction`.settings.detail_level")).first()
    assert tuple(row) == (2, "draft")
    boxes = [{"bbox": [n, n, 10 * n, 20 * n], "confidence": n / 8, "class_id": n, "class_name": f"kind{n}"} for n in (1, 5)]
    _sidecar(tmp_path / "ann", "f1.json", boxes)
    _sidecar(tmp_path / "ann", "f2.json", [])
    assert tab.read_sidecars(spark, str(tmp_path / "ann"), tab.DETECTIONS).count() == 2


def test_tree(spark, videos, tmp_path):
    root = str(videos)
    (videos / "deep" / ".hidden.mp4").write_bytes(b"1")
    (videos / "deeper.mp4").write_bytes(b"")
    assert names(tree.list_tree(spark, root)) == ["deeper.mp4", "n.txt", "w.avi", "x.mp4", "y.mov", "z.MP4"]
    assert names(tree.list_tree(spark, root, recursive=False, exts=VIDEO)) == ["deeper.mp4", "x.mp4", "y.mov"]
    assert names(tree.list_tree(spark, root, prefix="deep")) == ["deeper.mp4", "w.avi"]
    assert names(tree.list_tree(spark, root, prefix="deep/")) == names(tree.list_tree(spark, [root + "/deep", root + "/gone"])) == ["w.avi"]
    assert names(tree.list_tree(spark, root, prefix="deep/er/w")) == ["w.avi"] and tree.list_tree(spark, root, prefix="none/").count() == 0
    mine, theirs = tree.list_tree(spark, root, exts=VIDEO), obj.list_objects(spark, root, exts=VIDEO, recursive=True)
    times = lambda df: sorted((r[0].rsplit("/", 1)[-1], r[1], r[2]) for r in df.select("path", "length", F.unix_seconds("modificationTime")).collect())
    assert times(mine.where("length > 0")) == times(theirs)


def test_ranges(spark, tmp_path):
    contents = {"a": bytes(range(256)) * 5, "b": b"", "c": b"x" * 100, "d": b"y" * 101}
    rows = spark.createDataFrame([(k, v) for k, v in contents.items()] + [("none", None), (None, b"1")], "k STRING, c BINARY")
    assert sorted(r.bytes for r in pub.put_objects(rows, str(tmp_path / "o"), F.concat(F.lit("in/"), "k"), F.col("c")).collect()) == [0, 100, 101, 1280]
    listed = tree.list_tree(spark, str(tmp_path / "o"))
    ranges = tree.read_ranges(listed, 100)
    assert sorted((r.path[-1], r.start, r.bytes) for r in ranges.collect()) == sorted(
        (k, s, min(100, len(v) - s)) for k, v in contents.items() for s in range(0, max(1, len(v)), 100))
    assert {r.path[-1]: bytes(r.content) for r in tree.join_ranges(ranges).collect()} == contents


def test_catalog_and_features(spark, tmp_path):
    spark.sql("SELECT 'f' AS frame_id, 'x' AS extractor, array(cast(1 AS FLOAT)) AS embedding").write.parquet(str(tmp_path / "f"))
    assert tab.read_features(spark, str(tmp_path / "f")).first().embedding == [1.0]
    assert tab.read_catalog(spark, path=str(tmp_path / "f")).count() == 1
    topic = tab.read_topic(spark, {"path": str(tmp_path / "f")}, tab.FEATURES, "parquet")
    assert topic.isStreaming


def test_namespace(spark):
    assert art.ensure_namespace(spark, "captures") == "created"
    assert art.ensure_namespace(spark, "captures") == "exists"


def test_artifact_layout(spark, tmp_path):
    df = spark.range(100).select(F.lit("v").alias("venue_id"), F.concat(F.lit("e"), (F.col("id") % 2).cast("string")).alias("event_id"),
                                 F.lit("yolo").alias("model_type"), F.lit("c1").alias("camera_id"), F.col("id").alias("frame_id"))
    target = art.write_artifacts(df, str(tmp_path), "annotations", "json")
    assert os.path.isdir(f"{target}/venue_id=v/event_id=e1/model_type=yolo/camera_id=c1")
    back = spark.read.json(target)
    assert back.count() == 100
    plan = back.where("event_id = 'e1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_id" in plan
    art.write_artifacts(df.where("event_id = 'e1'").limit(3), str(tmp_path), "annotations", "json", "overwrite")
    assert spark.read.json(target).count() == 53
    results = art.write_results(df.limit(2), str(tmp_path), "analysis", ("camera_id",))
    assert "timestamp" in spark.read.json(results).columns


def test_frame_sink_is_snappy(spark, tmp_path):
    target = art.write_artifacts(spark.range(3).withColumn("image_data", F.lit(b"x")), str(tmp_path), "processed-frames")
    assert all(f.endswith(".snappy.parquet") for f in os.listdir(target) if f.endswith(".parquet"))


def test_publish_tree(spark, tmp_path):
    model = tmp_path / "model"
    (model / "tex").mkdir(parents=True)
    for name in ("a.obj", "a.mtl", "tex/t.png", "tex/t.jpg", "a.ply", "big.obj"):
        (model / name).write_bytes(name.encode() * (3_000_000 if name == "big.obj" else 1))
    found = obj.list_objects(spark, str(model), recursive=True)
    manifest = pub.publish_manifest(found, str(model), str(tmp_path / "bucket"), run_id="r7")
    done = pub.copy_objects(manifest, 4).collect()
    assert sum(r.bytes for r in done) == sum(r.bytes for r in manifest.collect())
    base = tmp_path / "bucket" / "run_id=r7"
    assert sorted(os.path.relpath(os.path.join(d, f), base) for d, _, fs in os.walk(base) for f in fs) == [
        "a.mtl", "a.obj", "big.obj", "tex/t.jpg", "tex/t.png"]
    assert (base / "tex/t.png").read_bytes() == b"tex/t.png"
    twice = spark.createDataFrame([("file:/m/x/m/a.obj", 1)], "path STRING, length BIGINT")
    assert pub.publish_manifest(twice, "/m", "/out").first().dst == "/out/x/m/a.obj"
    single = pub.single_manifest(found.where("path LIKE '%a.ply'"), str(tmp_path / "one"), "mesh.ply")
    assert pub.copy_objects(single).first().dst.endswith("one/mesh.ply")
    assert (tmp_path / "one" / "mesh.ply").exists()


def test_publish_latest(spark, tmp_path):
    first = spark.createDataFrame([("m1", 1, "a"), ("m1", 2, "b"), ("m2", 1, "c")], "model STRING, version INT, path STRING")
    pub.publish_latest(first, str(tmp_path), "model", "version", "path")
    _, latest = pub.publish_latest(spark.createDataFrame([("m1", 3, "d")], first.schema), str(tmp_path), "model", "version", "path")
    assert {(r.model, r.version) for r in spark.read.parquet(latest).collect()} == {("m1", 3), ("m2", 1)}
    late = spark.createDataFrame([("m1", 2, "again"), ("m2", 2, "e")], first.schema)
    versions, latest = pub.publish_latest(late, str(tmp_path), "model", "version", "path")
    assert {tuple(r) for r in spark.read.parquet(latest).select(*first.columns).collect()} == {("m1", 3, "d"), ("m2", 2, "e")}
    assert {tuple(r) for r in spark.read.parquet(versions).select(*first.columns).collect()} == {
        ("m1", 1, "a"), ("m1", 2, "again"), ("m1", 3, "d"), ("m2", 1, "c"), ("m2", 2, "e")}


def test_many_versions_lie_in_few_files(spark, tmp_path):
    rows = spark.range(400).select(F.concat(F.lit("m"), F.pmod("id", F.lit(2))).alias("model"), F.col("id").cast("int").alias("version"), F.lit("a").alias("path"))
    odd = spark.createDataFrame([("m0", None, "none"), (None, 1, "nobody")], "model STRING, version INT, path STRING")
    pub.publish_latest(rows.union(odd), str(tmp_path), "model", "version", "path")
    again = spark.createDataFrame([("m0", 10, "b"), ("m0", None, "other"), (None, 1, "b"), ("m1", 1000, "c")], odd.schema)
    versions, latest = pub.publish_latest(again, str(tmp_path), "model", "version", "path")
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(versions) for f in fs) <= 3 * pub.VERSION_PARTS
    got = sorted(map(str, spark.read.parquet(versions).select(*rows.columns).collect()))
    assert got == sorted(map(str, [*[r for r in rows.collect() if r.version != 10], *again.collect()]))
    assert {tuple(r) for r in spark.read.parquet(latest).select(*rows.columns).collect()} == {("m0", 398, "a"), ("m1", 1000, "c")}
