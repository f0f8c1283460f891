"""Validation and routing queries."""

from pyspark.sql import functions as F

from ..constants import DURATION_SECONDS, RESOLUTION_PATTERN
from ..operators import validate as vd
from ..operators.frames import split_unread
from .registry import Tables, query

BYTES = (100.0, 5000.0)


def rules(spark):
    """Validation bounds as rule rows."""
    return spark.sql(f"""
      SELECT * FROM VALUES ('file_size', 'n_chars', {BYTES[0]}D, {BYTES[1]}D, NULL),
        ('duration', 'duration', {DURATION_SECONDS[0]}D, {DURATION_SECONDS[1]}D, NULL),
        ('resolution', 'resolution', NULL, NULL, '{RESOLUTION_PATTERN}') AS r(rule, column, lo, hi, regex)""")


def videos(t: Tables):
    """Documents as videos: characters as bytes, and a duration and resolution from the key."""
    wide = F.array(F.lit(1920), F.lit(1080))
    return t.documents.select("doc_id", "n_chars", (F.col("doc_id") % 700).alias("duration"),
                              F.when(F.col("lang") == "en", wide).otherwise(F.array(F.lit(1280), F.lit(720))).alias("resolution"))


CHECKS = """
WITH c AS (SELECT doc_id, n_chars BETWEEN 100 AND 5000 AS file_size, doc_id % 700 BETWEEN 10 AND 600 AS duration,
                  lang = 'en' AS resolution FROM documents)
"""


@query("f5_f8_validation_suite", CHECKS + """
SELECT doc_id, file_size, duration, resolution, file_size AND duration AND resolution AS validation_passed FROM c
""")
def f8(t: Tables):
    checked = vd.validate(videos(t), rules(t.spark))
    names = ("file_size", "duration", "resolution")
    return checked.select("doc_id", *[F.col("validation_results")[n].alias(n) for n in names], "validation_passed")


@query("f9_fail_gate", CHECKS + """
SELECT CASE WHEN file_size AND duration AND resolution THEN 'good' ELSE 'quarantine' END AS outcome, doc_id FROM c
""")
def f9(t: Tables):
    good, bad = vd.gate(vd.validate(videos(t), rules(t.spark)))
    return good.select(F.lit("good").alias("outcome"), "doc_id").unionByName(
        bad.select(F.lit("quarantine").alias("outcome"), "doc_id"))


@query("f3_unreadable_split", """
SELECT d.doc_id, l.quality IS NOT NULL AS readable FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def f3(t: Tables):
    frames = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    good, rejects = split_unread(frames, "quality")
    return good.select("doc_id", F.lit(True).alias("readable")).unionByName(
        rejects.select("doc_id", F.lit(False).alias("readable")))


@query("f4_confidence", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.05
""")
def f4(t: Tables):
    return vd.confident(t.lineitem, "l_discount", 0.05).select("l_orderkey", "l_linenumber", "l_discount")


@query("f11_required_artifacts", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def f11(t: Tables):
    return vd.require_artifacts(t.documents.select("doc_id"), t.labels, "doc_id")


@query("f13_small_textures", "SELECT p_partkey FROM part WHERE p_size * 100 < 2048 OR p_retailprice * 2 < 2048")
def f13(t: Tables):
    textures = t.part.select("p_partkey", (F.col("p_size") * 100).alias("w"), (F.col("p_retailprice") * 2).alias("h"))
    return vd.small_textures(textures, "w", "h").select("p_partkey")


@query("f14_use_case_routing", """
SELECT event_id, 'click' AS branch FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'review' FROM events WHERE value > 50
""")
def f14(t: Tables):
    cases = F.when(F.col("value") > 50, F.array("event_type", F.lit("review"))).otherwise(F.array("event_type"))
    return vd.routed(t.events.select("event_id", cases.alias("use_cases")), "use_cases", ["click", "review"]).select("event_id", "branch")


@query("f15_enabled_stages", "SELECT event_id FROM events WHERE event_type = 'click' AND value > 20")
def f15(t: Tables):
    switch = F.when(F.col("event_type") == "click", F.col("value") > 20)
    return vd.enabled(t.events.select("event_id", F.struct(switch.alias("enabled")).alias("stage")), "stage.enabled").select("event_id")
