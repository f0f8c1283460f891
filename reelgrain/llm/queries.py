"""One registered query for each operator: the whole table, production parameters, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, clusters, ctw, html_text, knn_join, language, minhash, near_vectors, packing, resample, sentencepieces, substrings, toxicity
from .common import part

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies, here and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(table: str | tuple[str, ...], sql: str | None = None):
    """Register a function of these tables as the query of its name."""
    tables = (table,) if isinstance(table, str) else table

    def add(build: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(*[spark.read.parquet(f"{folder.rstrip('/')}/{t}.parquet") for t in tables])

        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return add


@query(("documents", "labels"))
def op1_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = toxicity.train(docs, labels, ~part("doc_id", 4, 2))
    scored = toxicity.score(docs, model, least=0.3)
    return scored.select("doc_id", part("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@query("embeddings")
def op2_near_vectors(vectors: DataFrame) -> DataFrame:
    return near_vectors.near_duplicates(vectors, least=0.9)


@query("documents")
def op3_substring_dedup(docs: DataFrame) -> DataFrame:
    found = substrings.without_repeats(docs, words=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("documents")
def op4_packing(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=2, longest=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("documents")
def op5_sentencepiece(docs: DataFrame) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    pieces = sentencepieces.encode(docs, model)
    decoded = sentencepieces.decoder(model)
    return pieces.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decoded("ids"), 256).alias("decoded_sha256"),
        F.element_at("ends", -1).alias("source_bytes"))


@query("documents")
def op6_minhash(docs: DataFrame) -> DataFrame:
    return minhash.near_duplicates(docs, words=2, percent=80)


@query("documents")
def op7_context_tree(docs: DataFrame) -> DataFrame:
    return ctw.score(docs, part("doc_id", 7, 2))


@query("documents")
def op8_language(docs: DataFrame) -> DataFrame:
    model = language.train(docs, ~part("doc_id", 5, 0))
    found = language.predict(docs, model)
    return found.select("doc_id", part("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", F.size("words").alias("n_runs"))


@query("pages")
def op9_main_text(pages: DataFrame) -> DataFrame:
    return html_text.extract(pages)


_TOP_K = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(embedding) > 0
), p AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("embeddings", _TOP_K)
def op10_top_k(vectors: DataFrame) -> DataFrame:
    return knn_join.top_k(vectors, k=20, every=20, scale=64)


@query("documents")
def op11_bpe(docs: DataFrame) -> DataFrame:
    coded = bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _clusters_sql(k: int, rounds: int, dim: int, scale: int, seed: int) -> str:
    """The rounds of op12, one after the other."""
    parts = [f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
)""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS c, x FROM v ORDER BY c LIMIT {k}
)"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v.x, min({{'d': CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'c': c.c}}) AS m
  FROM v, c{r} c GROUP BY vec_id, v.x
)""")
        if r < rounds:
            parts.append(f"""s{r} AS (
  SELECT m.c AS c, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) t(i) GROUP BY ALL
), n{r} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY c
), c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(n.x, c.x) AS x FROM c{r} c LEFT JOIN n{r} n ON n.c = c.c
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.m.c"""


@query("embeddings", _clusters_sql(40, 5, 64, 256, 2))
def op12_clusters(vectors: DataFrame) -> DataFrame:
    found = clusters.cluster(vectors, k=40, rounds=5, dim=64, scale=256, seed=2)
    name = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", name).drop("centroid")


@query(("documents", "benchmark"))
def op13_resampling(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    drawn = resample.resample(docs, benchmark, percent=5, least_words=20, buckets=10_000, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
