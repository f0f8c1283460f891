"""Catalogue queries: page URLs and document keys as object keys."""

from pyspark.sql import functions as F

from ..constants import COLD_AFTER_DAYS
from ..functions import paths as p
from ..functions import times as tm
from ..functions import values as v
from ..operators import lifecycle as lc
from ..operators.joins import missing
from ..sources.discovery import existing, first_nonempty, select_or_latest, union_all
from ..session import scratch_path
from ..sinks import versions as ver
from ..sources.objects import where_key
from .registry import Tables, query


@query("s1_s6_paths", r"""
WITH k AS (SELECT page_id, url, string_split(url, '/') AS parts, regexp_replace(url, '^https?://', '') AS bare FROM pages)
SELECT page_id, 'raw/' || bare AS joined, parts[-1] AS base, regexp_replace(parts[-1], '\.[^.]*$', '') AS stem_last,
       string_split(bare, '.')[1] AS stem_first, regexp_replace(url, '/[^/]*$', '') AS dir,
       CASE WHEN starts_with(url, 'https://') THEN substr(url, 8) END AS relative, bare
FROM k
""")
def s1_s6(t: Tables):
    url = F.col("url")
    bare = p.strip_scheme(url)
    return t.pages.select(
        "page_id", p.join_path(F.lit("raw"), bare).alias("joined"), p.basename(url).alias("base"),
        p.stem_last(p.basename(url)).alias("stem_last"), p.stem_first(bare).alias("stem_first"), p.dirname(url).alias("dir"),
        p.relative_path(url, "https:/").alias("relative"), bare.alias("bare"))


@query("s8_s10_times", """
SELECT event_id, epoch_us(date_trunc('second', ts)) AS iso_us, epoch_us(date_trunc('second', ts)) AS compact_us,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, true AS bad_is_null,
       round((event_id % 24) * 3600 + (event_id % 60) * 60 + (event_id % 59) + (event_id % 100) / 100.0, 2)::DOUBLE AS seconds
FROM events
""")
def s8_s10(t: Tables):
    i, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    clock = F.format_string("%02d:%02d:%02d.%02d", i % 24, i % 60, i % 59, i % 100)
    return t.events.select(
        "event_id",
        F.unix_micros(tm.parse_timestamp(F.concat(tm.format_iso(ts), F.lit("Z")))).alias("iso_us"),
        F.unix_micros(tm.parse_timestamp(F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))).alias("compact_us"),
        tm.format_iso(ts).alias("iso"), tm.parse_timestamp(F.col("event_type")).isNull().alias("bad_is_null"),
        F.round(tm.clock_seconds(clock), 2).alias("seconds"))


@query("s11_s12_keys", """
SELECT event_id, 'stadium_' || user_id AS venue_id, 'game_' || event_type AS game_id, 'cam_0' || (user_id % 3) AS camera_id,
       epoch_us(date_trunc('second', ts)) AS stamp_us
FROM events
""")
def s11_s12(t: Tables):
    name = F.concat(F.lit("cam_0"), (F.col("user_id") % 3).cast("string"), F.lit("_"),
                    F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'"), F.lit(".mp4"))
    key = p.build_key("raw-videos", F.concat(F.lit("stadium_"), F.col("user_id").cast("string")),
                      F.concat(F.lit("game_"), F.col("event_type")), name)
    parsed = t.events.select("event_id", p.parse_key(key).alias("k"))
    return parsed.select("event_id", "k.venue_id", F.col("k.event_id").alias("game_id"), "k.camera_id",
                         F.unix_micros("k.timestamp").alias("stamp_us"))


@query("s14_s15_s21_s22_values", """
SELECT o_orderkey, o_orderstatus = 'F' AS on_flag, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, 'none') AS state,
       o_orderkey // 7 AS seventh, epoch_us(o_orderdate + INTERVAL 30 MINUTE) AS due_us,
       o_orderdate < TIMESTAMP '2000-01-01' - INTERVAL 30 DAY AS over_age
FROM orders
""")
def s14_s22(t: Tables):
    status = F.col("o_orderstatus")
    text = F.when(status == "F", F.lit("true")).otherwise(F.lit("0"))
    return t.orders.select(
        "o_orderkey", v.flag(text).alias("on_flag"),
        v.default_text(F.when(status == "P", F.lit("")).otherwise(status), "none").alias("state"),
        F.call_function("div", F.col("o_orderkey"), F.lit(7).cast("long")).alias("seventh"),
        tm.micros(F.col("o_orderdate") + F.make_dt_interval(mins=F.lit(30))).alias("due_us"),
        tm.older_than(F.col("o_orderdate"), F.lit("2000-01-01").cast("timestamp_ntz"), F.lit(30)).alias("over_age"))


@query("s19_array_scaling", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: (CAST(x AS DOUBLE) - 0.485) / 0.229)), 6) AS total,
       round((CAST(embedding[1] AS DOUBLE) - 0.485) / 0.229, 6) AS head
FROM embeddings
""")
def s19(t: Tables):
    scaled = v.scale_array(F.col("embedding"), 0.485, 0.229)
    return t.embeddings.select("vec_id", F.round(F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
                               F.round(scaled[0], 6).alias("head"))


@query("s20_resolution_match", """
SELECT p_partkey, regexp_full_match((p_size * 40)::VARCHAR || 'x1080', '1920x1080|3840x2160') AS fits FROM part
""")
def s20(t: Tables):
    text = v.resolution_text(F.array(F.col("p_size") * 40, F.lit(1080)))
    return t.part.select("p_partkey", text.rlike("^(1920x1080|3840x2160)$").alias("fits"))


@query("a1_f1_prefix_listing", """
SELECT url, length(html) AS n FROM pages WHERE starts_with(url, 'https://')
""")
def f1(t: Tables):
    return where_key(t.pages, prefix="https://", path="url").select("url", F.length("html").cast("long").alias("n"))


@query("a2_f2_suffix_filter", """
SELECT page_id, url FROM pages WHERE url LIKE '%ref=x' OR url LIKE '%#top'
""")
def f2(t: Tables):
    return where_key(t.pages, exts=("ref=x", "#top"), path="url").select("page_id", "url")


@query("a3_first_nonempty_root", """
SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')
""")
def a3(t: Tables):
    return first_nonempty(t.pages, ["ftp://", "https://", "http://"], "url").select("page_id", "url")


@query("a13_manual_or_latest", """
SELECT d.doc_id, coalesce(l.doc_id, (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1)) AS selected
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def a13(t: Tables):
    labelled = t.documents.join(t.labels, "doc_id", "left_semi").select("doc_id")
    longest = t.documents.agg(F.min_by("doc_id", F.struct(-F.col("n_chars"), "doc_id"))).scalar()
    listed = labelled.unionByName(t.documents.where(F.col("doc_id") == longest).select("doc_id")).join(
        t.documents.select("doc_id", "n_chars"), "doc_id")
    requests = t.documents.select("doc_id", F.col("doc_id").alias("requested_path"))
    chosen = select_or_latest(listed.distinct(), requests, "n_chars", "doc_id")
    return chosen.select("doc_id", F.col("selected_path").alias("selected"))


@query("a11_f12_existing_keys", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def f12(t: Tables):
    return existing(t.documents.select("doc_id"), t.labels, "doc_id")


@query("u1_union_all", """
SELECT doc_id AS id, 'doc' AS kind FROM documents UNION ALL SELECT doc_id, 'label' FROM labels
UNION ALL SELECT item_id, 'item' FROM benchmark
""")
def u1(t: Tables):
    return union_all(
        t.documents.select(F.col("doc_id").alias("id"), F.lit("doc").alias("kind")),
        t.labels.select(F.col("doc_id").alias("id"), F.lit("label").alias("kind")),
        t.benchmark.select(F.col("item_id").alias("id"), F.lit("item").alias("kind")))


@query("u2_snapshot_difference", """
SELECT lang, source FROM documents EXCEPT ALL SELECT lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
""")
def u2(t: Tables):
    done = t.documents.join(t.labels, "doc_id", "left_semi").select("lang", "source")
    return lc.only_in(t.documents.select("lang", "source"), done)


@query("u3_missing_names", """
SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
""")
def u3(t: Tables):
    return missing(t.customer.select(F.col("c_nationkey").alias("nation")),
                   t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation")), "nation")


@query("b10_retention", """
WITH o AS (SELECT o_orderkey, o_orderpriority || '/' || o_orderkey AS path, o_orderdate FROM orders),
r AS (SELECT DISTINCT o_orderpriority || '/' AS prefix, 200 * length(o_orderpriority) AS days FROM orders
      UNION ALL SELECT DISTINCT substr(o_orderpriority, 1, 1), 1500 FROM orders),
j AS (SELECT o_orderkey, o_orderdate, min(days) AS days FROM o LEFT JOIN r ON starts_with(path, prefix) GROUP BY 1, 2)
SELECT o_orderkey, days AS retention_days,
       coalesce(o_orderdate < TIMESTAMP '2002-01-01' - to_days(CAST(days AS INTEGER)), false) AS expired FROM j
""")
def b10(t: Tables):
    name = F.col("o_orderpriority")
    objects = t.orders.select("o_orderkey", F.concat_ws("/", name, F.col("o_orderkey").cast("string")).alias("path"), "o_orderdate")
    rules = t.orders.select(F.concat(name, F.lit("/")).alias("prefix"), (F.length(name) * 200).alias("days")).unionByName(
        t.orders.select(F.substring(name, 1, 1).alias("prefix"), F.lit(1500).alias("days"))).distinct()
    now = F.lit("2002-01-01").cast("timestamp_ntz")
    judged = lc.retention(objects, rules, now, modified="o_orderdate")
    return judged.select("o_orderkey", "retention_days", "expired")


@query("b11_cold_tier", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 30 DAY THEN 'cold' ELSE 'hot' END AS tier FROM orders
""")
def b11(t: Tables):
    now = F.lit("1999-01-01").cast("timestamp_ntz")
    return lc.tier(t.orders.select("o_orderkey", "o_orderdate"), now, "o_orderdate", COLD_AFTER_DAYS).select("o_orderkey", "tier")


def _objects(t: Tables):
    name = F.col("o_orderpriority")
    return t.orders.select("o_orderkey", F.concat_ws("/", name, F.col("o_orderkey").cast("string")).alias("path"), "o_orderdate")


@query("b10_retention_applied", """
WITH r AS (SELECT DISTINCT o_orderpriority, 200 * length(o_orderpriority) AS days FROM orders)
SELECT o_orderkey, o.o_orderpriority || '/' || o_orderkey AS path, o_orderdate, 2 AS version FROM orders o JOIN r ON r.o_orderpriority = o.o_orderpriority
WHERE o_orderdate >= TIMESTAMP '2002-01-01' - to_days(CAST(days AS INTEGER))
""")
def b10_applied(t: Tables):
    # the table after the job is what the labels let survive
    root, name = scratch_path(t.spark, "versions"), F.col("o_orderpriority")
    ver.publish_version(_objects(t), root, 0)
    rules = t.orders.select(F.concat(name, F.lit("/")).alias("prefix"), (F.length(name) * 200).alias("days")).distinct()
    number = ver.apply_retention(t.spark, root, rules, F.lit("2002-01-01").cast("timestamp_ntz"), modified="o_orderdate")
    return ver.read_version(t.spark, root).withColumn("version", F.lit(number))


@query("b11_tiers_applied", """
SELECT o_orderkey, o_orderpriority || '/' || o_orderkey AS path, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' - INTERVAL 30 DAY THEN 'cold' ELSE 'hot' END AS tier FROM orders
""")
def b11_applied(t: Tables):
    root = scratch_path(t.spark, "versions")
    ver.publish_version(_objects(t), root, 0)
    ver.apply_tiers(t.spark, root, F.lit("1996-01-01").cast("timestamp_ntz"), "o_orderdate")
    return ver.read_version(t.spark, root, "tier")


@query("b13_snapshot_diff", """
WITH o AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
n AS (SELECT d.doc_id, sha256(CASE WHEN l.toxic = 1 THEN text || '.' ELSE text END) AS h
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL OR lang <> 'en')
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.h AS old_hash, n.h AS new_hash,
       CASE WHEN o.h IS NULL THEN 'added' WHEN n.h IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM o FULL JOIN n ON o.doc_id = n.doc_id WHERE o.h IS NULL OR n.h IS NULL OR o.h <> n.h
""")
def b13(t: Tables):
    poor = t.labels.where("quality = 0")
    old = t.documents.join(poor, "doc_id", "left_anti")
    joined = t.documents.join(t.labels, "doc_id", "left").where("quality IS NOT NULL OR lang <> 'en'")
    text = F.when(F.col("toxic") == 1, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    new = joined.withColumn("text", text)
    return lc.diff(lc.snapshot(old, "doc_id", "text"), lc.snapshot(new, "doc_id", "text"), "doc_id")
