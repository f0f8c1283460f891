"""Annotation queries: line items as detections, conversations as samples."""

from pyspark.sql import functions as F

from ..operators import annotate as an
from ..operators import config
from .registry import Tables, cents, query


@query("p6_normalise_detections", """
SELECT l_orderkey, l_linenumber AS class_id, l_discount::FLOAT::DOUBLE AS confidence, n_name AS class_name,
       l_quantity::FLOAT::DOUBLE AS x1, l_extendedprice::FLOAT::DOUBLE AS y1, l_tax::FLOAT::DOUBLE AS x2
FROM lineitem LEFT JOIN nation ON n_nationkey = l_linenumber
""")
def p6(t: Tables):
    names = t.nation.select(F.col("n_nationkey").alias("l_linenumber"), "n_name")
    box = ["l_quantity", "l_extendedprice", "l_tax", "l_discount"]
    rows = an.normalise_detections(t.lineitem, box, "l_discount", "l_linenumber", names, "n_name", ["l_orderkey"])
    d = F.col("detection")
    return rows.select(
        "l_orderkey", d["class_id"].alias("class_id"), d["confidence"].cast("double").alias("confidence"),
        d["class_name"].alias("class_name"),
        *[d["bbox"][i].cast("double").alias(n) for i, n in enumerate(("x1", "y1", "x2"))])


@query("e2_detections_per_frame", """
SELECT o_orderkey, count(l_orderkey) AS detections_count FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def e2(t: Tables):
    return an.count_detections(t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("e2_detections_in_arrays", """
SELECT vec_id, len(list_filter(embedding, lambda x: x > CAST(0.2 AS FLOAT))) AS detections_count FROM embeddings
""")
def e2_arrays(t: Tables):
    found = t.embeddings.select("vec_id", F.filter("embedding", lambda x: x > F.lit(0.2).cast("float")).alias("detections"))
    return an.detections_per_frame(found, "vec_id", "detections")


@query("e3_rollup_detections", """
SELECT l_returnflag, l_linenumber, count(*) AS detections, count(DISTINCT l_orderkey) AS frames,
       round(avg(c), 6) AS avg_confidence, max(c) AS max_confidence
FROM (SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS c FROM lineitem) GROUP BY l_returnflag, l_linenumber
""")
def e3(t: Tables):
    scored = t.lineitem.select("l_returnflag", "l_linenumber", "l_orderkey", cents("l_discount").alias("c"))
    rows = an.rollup_detections(scored, ["l_returnflag", "l_linenumber"], "l_orderkey", "c")
    return rows.withColumn("avg_confidence", F.round("avg_confidence", 6))


@query("l2_sample_per_camera", """
SELECT label, vec_id FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('7:' || vec_id), vec_id) AS rn FROM embeddings) WHERE rn <= 5
""")
def l2(t: Tables):
    return an.sample_n(t.embeddings.select("label", "vec_id"), ["label"], "vec_id", 5, 7)


@query("e24_hash_split", """
WITH h AS (SELECT doc_id, ('0x' || substr(md5('0:' || doc_id), 1, 8))::BIGINT % 100 AS b FROM documents)
SELECT doc_id, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'val' ELSE 'test' END AS split FROM h
""")
def e24(t: Tables):
    return an.hash_split(t.documents.select("doc_id"), "doc_id", {"train": 80, "val": 10, "test": 10})


@query("p10_prompt_assembly", """
WITH s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY md5('0:' || turn), turn) AS rn FROM conversations)
SELECT conv_id, count(*) AS samples, 'Describe these detections of camera ' || conv_id || ': [' ||
       string_agg('{"turn":' || turn || ',"role":"' || role || '"}', ',' ORDER BY turn) || ']' AS prompt
FROM s WHERE rn <= 5 GROUP BY conv_id
""")
def p10(t: Tables):
    return an.build_prompt(t.conversations, ["conv_id"], "turn", ["role"], "Describe these detections of camera %d: %s")


@query("p4_config_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events
""")
def p4(t: Tables):
    return config.project_json(t.events, "props", {"k": ("$.k", "bigint"), "missing": ("$.missing", "string")}, ["event_id"])


@query("p5_nested_fields", """
SELECT p_partkey, p_size AS iso, p_retailprice AS focal_length FROM part
""")
def p5(t: Tables):
    nested = t.part.select("p_partkey", F.struct(F.col("p_size").alias("iso"), F.col("p_retailprice").alias("focal_length"),
                                                 F.col("p_name").alias("make")).alias("exif"))
    return config.project_config(nested, {"p_partkey": "p_partkey", "iso": "exif.iso", "focal_length": "exif.focal_length"})


@query("s16_s18_json_round_trip", """
SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def s16_s18(t: Tables):
    document = F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k BIGINT").alias("p"))
    packed = t.events.select("event_id", F.to_json(document).alias("j"))
    back = packed.select("event_id", F.from_json("j", "kind STRING, p STRUCT<k: BIGINT>").alias("j"))
    return back.select("event_id", "j.kind", "j.p.k")


@query("s17_explode_arrays", """
SELECT vec_id, i - 1 AS position, CAST(embedding[i] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
""")
def s17(t: Tables):
    rows = t.embeddings.select("vec_id", F.posexplode_outer("embedding").alias("position", "value"))
    return rows.withColumn("value", F.col("value").cast("double"))
