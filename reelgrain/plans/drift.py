"""Profile and drift queries."""

from pyspark.sql import functions as F

from ..operators import drift as d
from ..operators import profile as pr
from ..operators import sketches as sk
from ..operators.quality import metric_drift
from ..session import cut_lineage
from .registry import Tables, query


@query("e11_missing_values", """
WITH j AS (SELECT lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
u AS (SELECT 'lang' AS "column", count(*) - count(lang) AS nulls, count(*) AS n FROM j
      UNION ALL SELECT 'n_chars', count(*) - count(n_chars), count(*) FROM j
      UNION ALL SELECT 'quality', count(*) - count(quality), count(*) FROM j
      UNION ALL SELECT 'toxic', count(*) - count(toxic), count(*) FROM j)
SELECT "column", nulls, round(nulls / n, 6) AS share FROM u
""")
def e11(t: Tables):
    joined = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    rows = pr.missing_values(joined, ["lang", "n_chars", "quality", "toxic"])
    return rows.withColumn("share", F.round("share", 6))


@query("e12_profile_exact", """
WITH j AS (SELECT n_chars, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
u AS (SELECT 'n_chars' AS "column", CAST(n_chars AS DOUBLE) AS v FROM j UNION ALL SELECT 'quality', CAST(quality AS DOUBLE) FROM j)
SELECT "column", count(v) AS n, count(*) - count(v) AS nulls, min(v) AS "min", max(v) AS "max", round(avg(v), 6) AS mean,
       round(stddev_samp(v), 6) AS std, count(DISTINCT v) AS "distinct", round(quantile_cont(v, 0.25), 6) AS q25,
       round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75
FROM u GROUP BY "column"
""")
def e12(t: Tables):
    joined = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    rows = pr.profile(joined, ["n_chars", "quality"], exact=True)
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
SKETCHED = """
WITH u AS (SELECT {keys}unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS "column",
                  unnest([CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE), CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE)]) AS v FROM lineitem)
SELECT {keys}"column", count(v) AS n, count(*) - count(v) AS nulls, min(v) AS "min", max(v) AS "max", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       true AS q25_held, true AS q50_held, true AS q75_held, true AS distinct_held
FROM u GROUP BY {keys}"column"
"""


def held(rows, keys=()):
    """What a sketch gives exactly, and whether its estimates kept their bounds on all rows."""
    flags = [c for c in rows.columns if c.endswith("_held")]
    return rows.select(*keys, "column", "n", "nulls", "min", "max", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), *flags)


@query("e12_profile_sketched", SKETCHED.format(keys=""))
def e12_fast(t: Tables):
    return held(sk.judged(sk.sketch(t.lineitem, MEASURES), t.lineitem, MEASURES, QUARTILES))


@query("e12_sketches_by_key", SKETCHED.format(keys="l_returnflag, "))
def e12_by_key(t: Tables):
    found = sk.sketch(t.lineitem, MEASURES, ["l_returnflag"])
    return held(sk.judged(found, t.lineitem, MEASURES, QUARTILES, ["l_returnflag"]), ["l_returnflag"])


@query("e12_sketches_merged", SKETCHED.format(keys="l_returnflag, "))
def e12_merged(t: Tables):
    # a stored table of daily sketches, merged to one profile of each flag
    daily = cut_lineage(sk.sketch(t.lineitem, MEASURES, ["l_returnflag", "l_shipdate"]))
    return held(sk.judged(sk.merge(daily, ["l_returnflag"]), t.lineitem, MEASURES, QUARTILES, ["l_returnflag"]), ["l_returnflag"])


@query("e12_sketch_accuracy", """
SELECT c AS "column", true AS counts_equal, true AS distinct_close, true AS quartiles_close
FROM (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS c)
""")
def e12_accuracy(t: Tables):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    exact = pr.profile(t.lineitem, columns, exact=True)
    found = pr.profile(t.lineitem, columns)
    # a sketch bounds the ranks of its quartiles, not their distances: of few different values the next one may be a tenth of the range away
    values = pr.to_long(t.lineitem, columns).where("value IS NOT NULL AND NOT isnan(value)")
    near = [(F.count_if(F.col("value") < F.col(q)) <= (p + 0.03) * F.count("value")) & (F.count_if(F.col("value") <= F.col(q)) >= (p - 0.03) * F.count("value"))
            for q, p in QUARTILES.items()]
    ranks = values.join(F.broadcast(found.select("column", *QUARTILES)), "column").groupBy("column").agg((near[0] & near[1] & near[2]).alias("near"))
    both = found.alias("s").join(exact.alias("e"), "column").join(ranks, "column", "left")
    same = [F.col(f"s.{c}") == F.col(f"e.{c}") for c in ("n", "nulls", "min", "max")]
    return both.select("column", (same[0] & same[1] & same[2] & same[3]).alias("counts_equal"),
                       (F.abs(F.col("s.distinct") - F.col("e.distinct")) <= F.col("e.distinct") * 0.15).alias("distinct_close"),
                       F.coalesce("near", F.lit(True)).alias("quartiles_close"))


HALVES = """
WITH e AS (SELECT value AS v, ts < TIMESTAMP '2024-01-02' AS old FROM events),
m AS (SELECT min(v) AS lo, max(v) AS hi, count(*) FILTER (old) AS nr, count(*) FILTER (NOT old) AS nc FROM e)
"""


def halves(t: Tables, columns: list[str]):
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    return t.events.where(F.col("ts") < cut).select(*columns), t.events.where(F.col("ts") >= cut).select(*columns)


@query("e13_drift_psi", HALVES + """
, b AS (SELECT least(floor((v - lo) / (hi - lo) * 10), 9) AS bin, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c
        FROM e, m GROUP BY 1),
g AS (SELECT greatest(coalesce(r, 0) / nr, CAST('1e-6' AS DOUBLE)) AS p, greatest(coalesce(c, 0) / nc, CAST('1e-6' AS DOUBLE)) AS q
      FROM (SELECT unnest(range(0, 10)) AS bin) x LEFT JOIN b ON b.bin = x.bin, m)
SELECT 'value' AS "column", round(sum((q - p) * ln(q / p)), 6) AS statistic, sum((q - p) * ln(q / p)) > 0.1 AS drifted FROM g
""")
def e13_psi(t: Tables):
    return d.drift(*halves(t, ["value"]), ["value"], 0.1).withColumn("statistic", F.round("statistic", 6))


@query("e13_drift_ks", HALVES + """
, c AS (SELECT v, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c FROM e GROUP BY v),
s AS (SELECT abs(sum(r) OVER (ORDER BY v) / nr - sum(c) OVER (ORDER BY v) / nc) AS gap FROM c, m)
SELECT 'value' AS "column", round(max(gap), 6) AS statistic, max(gap) > 0.1 AS drifted FROM s
""")
def e13_ks(t: Tables):
    return d.drift(*halves(t, ["value"]), ["value"], 0.1, "ks").withColumn("statistic", F.round("statistic", 6))


@query("e14_prediction_drift", """
WITH e AS (SELECT l_discount AS v, l_shipdate < TIMESTAMP '1998-07-01' AS old FROM lineitem),
m AS (SELECT count(*) FILTER (old) AS nr, count(*) FILTER (NOT old) AS nc FROM e),
c AS (SELECT v, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c FROM e GROUP BY v),
s AS (SELECT abs(sum(r) OVER (ORDER BY v) / nr - sum(c) OVER (ORDER BY v) / nc) AS gap FROM c, m)
SELECT 1 AS "columns", CAST(max(gap) > 0.001 AS INTEGER) AS drifted, CASE WHEN max(gap) > 0.001 THEN 1.0 ELSE 0.0 END AS share FROM s
""")
def e14(t: Tables):
    old = F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    checked = d.drift(t.lineitem.where(old).select("l_discount"), t.lineitem.where(~old).select("l_discount"), ["l_discount"],
                      0.001, "ks")
    return d.drift_share(checked)


@query("e16_vertex_density", """
WITH p AS (SELECT label, embedding[64] < 0 AS old, embedding[1] AS x FROM embeddings),
s AS (SELECT label, count(*) FILTER (old) / ((max(x) FILTER (old) - min(x) FILTER (old))::DOUBLE) AS r,
             count(*) FILTER (NOT old) / ((max(x) FILTER (NOT old) - min(x) FILTER (NOT old))::DOUBLE) AS c FROM p GROUP BY label)
SELECT label, round(r, 4) AS reference, round(c, 4) AS current, round(abs(c - r) / r, 4) AS change, abs(c - r) / r > 0.2 AS drifted FROM s
""")
def e16(t: Tables):
    points = t.embeddings.select("label", (F.col("embedding")[63] < 0).alias("old"), F.col("embedding")[0].alias("x"))
    density = F.try_divide(F.count(F.lit(1)), (F.max("x") - F.min("x")).cast("double"))
    rows = metric_drift(points.where("old"), points.where("NOT old"), ["label"], density, 0.2)
    return rows.withColumns({c: F.round(c, 4) for c in ("reference", "current", "change")})


@query("w8_empirical_cdf", """
WITH c AS (SELECT value, count(*) AS n FROM events GROUP BY value)
SELECT 'value' AS "column", value, n, round(sum(n) OVER (ORDER BY value) / sum(n) OVER (), 6) AS cdf FROM c
""")
def w8(t: Tables):
    return d.ecdf(t.events, ["value"]).withColumn("cdf", F.round("cdf", 6))
