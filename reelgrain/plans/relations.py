"""Join queries."""

from pyspark.sql import functions as F

from ..operators import joins as j
from ..operators.quality import metric_drift
from .registry import Tables, cents, query


@query("j1_frame_metadata", """
SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def j1(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return j.attach(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), part, ["l_partkey"])


@query("j2_event_config", """
SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def j2(t: Tables):
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return j.attach(t.customer.select("c_custkey", "c_nationkey"), nation, ["c_nationkey"], "inner").drop("c_nationkey")


@query("j3_unprocessed", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j3(t: Tables):
    return j.unprocessed(t.documents.select("doc_id", "source"), t.labels, "doc_id")


@query("j6_class_names", """
SELECT l_orderkey, l_linenumber, coalesce(n_name, 'unknown') AS class_name
FROM lineitem LEFT JOIN nation ON n_nationkey = l_linenumber * 4
""")
def j6(t: Tables):
    names = t.nation.select(F.col("n_nationkey").alias("class_id"), "n_name")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 4).alias("class_id"))
    return j.class_names(rows, names, "class_id", "n_name", "unknown").drop("class_id")


@query("j8_reference_current", """
WITH r AS (SELECT user_id, avg(CAST(round(value * 100) AS BIGINT)) AS reference FROM events WHERE ts < TIMESTAMP '2024-01-02' GROUP BY user_id),
c AS (SELECT user_id, avg(CAST(round(value * 100) AS BIGINT)) AS current FROM events WHERE ts >= TIMESTAMP '2024-01-02' GROUP BY user_id)
SELECT coalesce(r.user_id, c.user_id) AS user_id, round(reference, 6) AS reference, round(current, 6) AS current,
       round(abs(current - reference) / nullif(reference, 0), 6) AS change,
       abs(current - reference) / nullif(reference, 0) > 0.15 AS drifted
FROM r FULL JOIN c ON r.user_id = c.user_id
""")
def j8(t: Tables):
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    rows = metric_drift(t.events.where(F.col("ts") < cut), t.events.where(F.col("ts") >= cut), ["user_id"], F.avg(cents("value")))
    return rows.withColumns({c: F.round(c, 6) for c in ("reference", "current", "change")})
