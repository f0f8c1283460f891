"""From documents to training sequences: toxicity, language, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgrain.llm import language, minhash, packing, substrings, toxicity
from reelgrain.llm.queries import tokenizer_path
from reelgrain.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words of a passage that is taken out of all documents but the first.
PASSAGE = 50
#: Bytes of text that a worker compares at once there: small, for workers of a chain of stages share an executor with a heap in full use.
PACK = 5 << 19
#: Documents without an id are told apart by numbers from here on.
NAMELESS = 1 << 62
#: A document stays if its language has more than an even share among three.
SURE = 1 / 3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3; learned from all labels of documents here."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    return docs.select(*COLUMNS).where(toxicity.scorer(docs, model)("text") < 0.3)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have; a missing `lang` becomes the one found. Without any label all stay."""
    model = language.train(docs, F.lit(True))
    if not model.languages:
        return docs.select(*COLUMNS)
    found = docs.select(*COLUMNS, language.identifier(docs, model, filtered=True)(F.col("text")).alias("_found"))
    kept = found.where((F.col("_found.lang") != language.UNKNOWN) & (F.col("_found.score") > SURE))
    return kept.select("doc_id", "text", F.coalesce("lang", "_found.lang").alias("lang"), "source", "n_chars")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of those that repeat an id and a text. Only ids that repeat, null among them, move with their texts."""
    again = cut_lineage(docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id")))
    if again.isEmpty():
        return docs
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    several = docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(again, same, "left_anti").unionByName(several)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, on five-word shingles at 0.8, the document with the smallest id.

    Rows of one id and text count once. A document without an id takes part behind all others. Several texts of one id share its fate.
    """
    rows = one_of_each(docs.select(*COLUMNS))
    # ids that no document has: the upper half of the longs by a hash of the text
    named = F.coalesce(F.col("doc_id").cast("long"), F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(NAMELESS))
    found = minhash.near_duplicates(rows.select(named.alias("doc_id"), "text"), words=5, percent=80)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return rows.join(gone, named == F.col("_gone"), "left_anti").select(*COLUMNS)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one with a smaller id has; texts without any stay as they are."""
    found = substrings.without_repeats(docs, words=PASSAGE, carry=("lang", "source", "n_chars"), as_it_was=True, pack_bytes=PACK)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select("doc_id", "text", F.col("carried_0").alias("lang"), F.col("carried_1").alias("source"),
                        F.when(F.col("n_removed") > 0, length).otherwise(F.col("carried_2")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences of the documents' tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("passages", drop_passages),
    ("packing", pack),
]
#: Models, tokenizers and components of links are beyond SQL. Tests hold near_duplicates, passages and packing against brute force, and
#: toxicity and language against the scores of their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each one written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
