"""Sink and source queries: a table is written to the shared folder in its layout and read back."""

from pyspark.sql import functions as F

from ..operators import annotate as an
from ..operators.quality import success_rate
from ..functions.paths import below_root
from ..session import cut_lineage, scratch_path
from ..sinks import artifacts as art
from ..sinks import publish as pub
from ..sources import tables as tab
from ..sources import tree
from .registry import Tables, cents, query


@query("a9_sidecar_scan", """
SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def a9(t: Tables):
    root = scratch_path(t.spark, "sidecars")
    docs = t.events.select("event_id", F.col("event_type").alias("kind"), F.from_json("props", "k BIGINT").alias("p"))
    target = art.write_artifacts(docs, root, "sidecars", "json", partition_by=())
    rows = tab.read_sidecars(t.spark, target, "event_id BIGINT, kind STRING, p STRUCT<k: BIGINT>", multi_line=False)
    return rows.select("event_id", "kind", "p.k")


@query("a10_b8_metric_append", """
SELECT event_type, count(*) AS n, round(avg(CAST(round(value * 100) AS BIGINT)), 6) AS utilisation FROM events GROUP BY event_type
""")
def a10_b8(t: Tables):
    root = scratch_path(t.spark, "metrics")
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    metrics = t.events.select("event_type", "ts", "value")
    art.write_artifacts(metrics.where(F.col("ts") < cut), root, "gpu_metrics", partition_by=())
    target = art.write_artifacts(metrics.where(F.col("ts") >= cut), root, "gpu_metrics", partition_by=())
    table = tab.read_catalog(t.spark, path=target)
    return table.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(cents("value")), 6).alias("utilisation"))


@query("a12_feature_scan", """
SELECT vec_id::VARCHAR AS frame_id, 'grid' AS extractor, len(embedding) AS dims, round(embedding[1]::DOUBLE, 6) AS head FROM embeddings
""")
def a12(t: Tables):
    root = scratch_path(t.spark, "features")
    rows = t.embeddings.select(F.col("vec_id").cast("string").alias("frame_id"), F.lit("grid").alias("extractor"), "embedding")
    table = tab.read_features(t.spark, art.write_artifacts(rows, root, "features", partition_by=()))
    return table.select("frame_id", "extractor", F.size("embedding").alias("dims"),
                        F.round(F.col("embedding")[0].cast("double"), 6).alias("head"))


@query("b4_processed_frames", """
SELECT doc_id AS frame_id, octet_length(encode(text)) AS bytes, n_chars AS iso FROM documents
""")
def b4(t: Tables):
    root = scratch_path(t.spark, "frames")
    frames = t.documents.select(F.col("doc_id").alias("frame_id"), F.encode("text", "UTF-8").alias("image_data"),
                                F.struct(F.col("n_chars").alias("iso"), F.col("lang").alias("make")).alias("exif"))
    target = art.write_artifacts(frames, root, "processed-frames")
    return t.spark.read.parquet(target).select("frame_id", F.octet_length("image_data").alias("bytes"), "exif.iso")


def annotations(t: Tables):
    """Strong vector elements as the detections of a frame."""
    found = F.filter(
        F.transform("embedding", lambda v, i: F.struct(F.array(i.cast("float"), v).alias("bbox"), v.alias("confidence"), i.alias("class_id"))),
        lambda d: d["confidence"] > F.lit(0.2).cast("float"))
    return t.embeddings.select(F.col("vec_id").alias("frame_id"), F.concat(F.lit("cam_"), F.col("label").cast("string")).alias("camera_id"),
                               found.alias("detections"))


DETECTIONS = "frame_id BIGINT, camera_id STRING, detections ARRAY<STRUCT<bbox: ARRAY<FLOAT>, confidence: FLOAT, class_id: INT>>"


@query("b5_b7_annotation_layout", """
SELECT 'cam_' || label AS camera_id, count(*) AS frames,
       sum(len(list_filter(embedding, lambda v: v > CAST(0.2 AS FLOAT))))::BIGINT AS detections
FROM embeddings GROUP BY label
""")
def b5_b7(t: Tables):
    root = scratch_path(t.spark, "annotations")
    target = art.write_artifacts(annotations(t), root, "annotations", "json")
    table = tab.read_sidecars(t.spark, target, DETECTIONS, multi_line=False)
    return table.groupBy("camera_id").agg(F.count(F.lit(1)).alias("frames"), F.sum(F.size("detections")).alias("detections"))


@query("b6_summary_sink", """
SELECT 'cam_' || label AS camera_id, vec_id AS frame_id, len(list_filter(embedding, lambda v: v > CAST(0.2 AS FLOAT))) AS detections_count
FROM embeddings
""")
def b6(t: Tables):
    root = scratch_path(t.spark, "summary")
    found = annotations(t)
    counts = found.select("camera_id", "frame_id", F.size("detections").alias("detections_count"))
    target = art.write_artifacts(counts, root, "summary", "json", partition_by=("camera_id",))
    return tab.read_sidecars(t.spark, target, "camera_id STRING, frame_id BIGINT, detections_count INT", multi_line=False)


@query("b9_publish_latest", """
SELECT 'versions' AS part, p_brand, p_partkey AS version, p_name AS name FROM part
UNION ALL SELECT 'latest', p_brand, max(p_partkey), arg_max(p_name, p_partkey) FROM part GROUP BY p_brand
""")
def b9(t: Tables):
    root = scratch_path(t.spark, "models")
    models = t.part.select("p_brand", F.col("p_partkey").alias("version"), F.col("p_name").alias("name"))
    every, newest = pub.publish_latest(models, root, "p_brand", "version", "name")
    parts = [t.spark.read.parquet(path).select(F.lit(name).alias("part"), "p_brand", "version", "name") for name, path in (("versions", every), ("latest", newest))]
    return parts[0].unionByName(parts[1])


@query("b12_run_scoped_output", """
SELECT o_orderkey, o_totalprice, o_orderpriority AS run_id FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def b12(t: Tables):
    root = scratch_path(t.spark, "runs")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("run_id"))
    target = art.write_artifacts(rows, root, "models", partition_by=("run_id",))
    return t.spark.read.parquet(target).where("run_id <> '5-LOW'")


@query("b14_b15_result_sink", """
SELECT o_orderpriority, count(*) AS runs, count(*) FILTER (o_orderstatus = 'F') AS succeeded, true AS stamped
FROM orders GROUP BY o_orderpriority
""")
def b15(t: Tables):
    root = scratch_path(t.spark, "results")
    target = art.write_results(success_rate(t.orders, ["o_orderpriority"], "o_orderstatus", "F"), root, "analysis")
    table = t.spark.read.schema("o_orderpriority STRING, runs BIGINT, succeeded BIGINT, timestamp TIMESTAMP").json(target)
    return table.select("o_orderpriority", "runs", "succeeded", F.col("timestamp").isNotNull().alias("stamped"))


def _text_objects(t: Tables, root: str):
    """Documents as objects `<language>/<source>/<id>.txt`; how many bytes were written."""
    key = F.concat_ws("/", F.coalesce("lang", F.lit("none")), F.coalesce("source", F.lit("none")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return pub.put_objects(t.documents, root, key, F.encode("text", "UTF-8")).agg(F.sum("bytes")).first()[0]


@query("a1_a4_a8_list_tree", """
SELECT lang || '/' || coalesce(source, 'none') || '/' || doc_id || '.txt' AS key, octet_length(encode(text)) AS length
FROM documents WHERE lang LIKE 'e%' AND text IS NOT NULL
""")
def a1(t: Tables):
    root = scratch_path(t.spark, "objects")
    _text_objects(t, root)
    found = tree.list_tree(t.spark, root, prefix="e", exts=(".txt",))
    return found.select(below_root(F.col("path"), root).alias("key"), "length")


@query("a7_a11_contents_by_ranges", """
SELECT doc_id || '.txt' AS name, sha256(text) AS sha256, octet_length(encode(text)) AS bytes, greatest(1, (octet_length(encode(text)) + 999) // 1000) AS ranges
FROM documents WHERE lang = 'de' AND text IS NOT NULL
""")
def a11(t: Tables):
    root = scratch_path(t.spark, "objects")
    _text_objects(t, root)
    wanted = t.documents.where("lang = 'de'").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    listed = tree.list_tree(t.spark, root).withColumn("name", F.element_at(F.split("path", "/"), -1)).join(wanted, "name", "left_semi")
    ranges = cut_lineage(tree.read_ranges(listed, 1000))
    counted = ranges.groupBy("path").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("ranges"))
    whole = tree.join_ranges(ranges).join(counted, "path")
    return whole.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), "bytes", "ranges")


@query("b1_b2_publish_tree", """
SELECT 'run_id=r1/' || coalesce(lang, 'none') || '/' || coalesce(source, 'none') || '/' || doc_id || '.txt' AS key, sha256(text) AS sha256
FROM documents WHERE text IS NOT NULL
""")
def b2(t: Tables):
    root, target = scratch_path(t.spark, "objects"), scratch_path(t.spark, "published")
    _text_objects(t, root)
    manifest = pub.publish_manifest(tree.list_tree(t.spark, root), root, target, (".txt",), run_id="r1")
    copied = cut_lineage(pub.copy_objects(manifest))
    read = tree.join_ranges(tree.read_ranges(copied.select(F.col("dst").alias("path"), F.col("bytes").alias("length"))))
    return read.select(below_root(F.col("path"), target).alias("key"), F.sha2("content", 256).alias("sha256"))
