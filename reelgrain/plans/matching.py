"""Matching queries: `embeddings` as image features, labels as scenes."""

from pyspark.sql import functions as F

from ..operators import match as m
from ..operators.components import components
from ..session import cut_lineage
from .registry import Tables, query

#: Share of the exact partners of a scene that the approximate search has to find.
RECALL = 0.9
#: Images in a bucket there.
SMALL_BUCKET = 8

NEIGHBOURS = """
WITH u AS (SELECT label, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT a.label, a.vec_id AS src, b.vec_id AS dst, list_cosine_similarity(a.v, b.v) AS score
      FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(score, 12) DESC, dst) AS rank FROM s),
t AS (SELECT label, src, max(dst) FILTER (rank = 1) AS dst, max(score) FILTER (rank = 1) AS score,
             sqrt(2 - 2 * max(score) FILTER (rank = 1)) AS d1, sqrt(2 - 2 * max(score) FILTER (rank = 2)) AS d2
      FROM r WHERE rank <= 2 GROUP BY label, src)
"""


@query("j4_pair_counts", """
SELECT label, count(*) AS images, count(*) * (count(*) - 1) // 2 AS pairs FROM embeddings GROUP BY label
""")
def j4(t: Tables):
    return m.pair_counts(t.embeddings, "label")


@query("j5_nearest_in_scene", NEIGHBOURS + "SELECT label, src, dst, round(score, 6) AS score, rank FROM r WHERE rank <= 2")
def j5_nearest(t: Tables):
    return m.nearest(t.embeddings, "vec_id", "label", "embedding", 2).withColumn("score", F.round("score", 6))


@query("j5_ratio_test", NEIGHBOURS + """
SELECT label, src, dst, round(score, 6) AS score FROM t WHERE d2 IS NULL OR d1 < CAST('0.95' AS DOUBLE) * d2
""")
def j5_ratio(t: Tables):
    return m.match(t.embeddings, "vec_id", "label", "embedding", 0.95, mutual=False).withColumn("score", F.round("score", 6))


@query("j5_mutual_matches", NEIGHBOURS + """
SELECT a.label, a.src, a.dst, round(a.score, 6) AS score FROM t a JOIN t b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst
""")
def j5_mutual(t: Tables):
    return m.match(t.embeddings, "vec_id", "label", "embedding", None).withColumn("score", F.round("score", 6))


@query("j11_components", NEIGHBOURS.replace("WITH u", "WITH RECURSIVE u") + """
, e AS (SELECT src AS a, dst AS b FROM t UNION SELECT dst, src FROM t),
w AS (SELECT a AS node, a AS low FROM e UNION SELECT e.b, w.low FROM w JOIN e ON e.a = w.node AND w.low < e.b)
SELECT node, min(low) AS component FROM w GROUP BY node
""")
def j11(t: Tables):
    edges = m.match(t.embeddings, "vec_id", "label", "embedding", None, mutual=False)
    return components(edges, "src", "dst")


@query("j12_approximate_neighbours")
def j12(t: Tables):
    return m.approx_nearest(t.embeddings, "vec_id", "label", "embedding", 2)


@query("j12_recall", f"""
WITH e AS (SELECT label, vec_id FROM embeddings WHERE label IS NOT NULL), n AS (SELECT label, count(*) AS images FROM e GROUP BY label)
SELECT label, images, CAST(floor(log2(images / {SMALL_BUCKET}.0)) AS INTEGER) AS bits, images * least(images - 1, 2) AS partners, true AS sound, true AS enough
FROM n
""")
def j12_recall(t: Tables):
    # buckets so small that all scenes of the given tables have several
    exact = m.nearest(t.embeddings, "vec_id", "label", "embedding", 2).select("src", "dst", "rank", F.col("score").alias("top"))
    found = cut_lineage(m.approx_nearest(t.embeddings, "vec_id", "label", "embedding", 2, bucket_rows=SMALL_BUCKET).select("src", "dst", "rank", "score"))
    rows = t.embeddings.where("label IS NOT NULL").select("label", F.col("vec_id").alias("src")).join(exact, "src", "left")
    rows = rows.join(found.select("src", "dst", F.lit(1).alias("hit")), ["src", "dst"], "left").join(found.select("src", "rank", "score"), ["src", "rank"], "left")
    images = F.countDistinct("src")
    return rows.groupBy("label").agg(
        images.alias("images"), F.floor(F.log2(images / SMALL_BUCKET)).cast("int").alias("bits"), F.count("dst").alias("partners"),
        F.bool_and(F.coalesce(F.col("score") <= F.col("top") + 1e-9, F.lit(True))).alias("sound"),
        F.coalesce(F.sum(F.coalesce("hit", F.lit(0))) >= RECALL * F.count("dst"), F.lit(True)).alias("enough"))
