"""Retention, tiering and dataset versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COLD_AFTER_DAYS
from ..functions.times import older_than


def retention(objects: DataFrame, rules: DataFrame, now: Column, path: str = "path", modified: str = "modificationTime") -> DataFrame:
    """Add the shortest retention of the rules whose prefix fits, and whether it is over.

    Rules of any number: each distinct key is cut at the prefix lengths that occur and joined on
    the prefix. Keys without a fitting rule, and null keys, have no retention and never expire.
    """
    short = rules.groupBy(F.col("prefix").alias("_prefix")).agg(F.min("days").cast("int").alias("_days"))
    # as many lengths as the longest prefix has characters, in one row
    lengths = rules.agg(F.collect_set(F.length("prefix")).alias("_lengths")).scalar()
    keyed = objects.select(F.col(path).alias("_key")).where(F.col(path).isNotNull()).distinct().withColumn("_lengths", lengths)
    fitting = F.filter("_lengths", lambda n: n <= F.length("_key"))
    heads = keyed.select("_key", F.explode(F.transform(fitting, lambda n: F.substring("_key", 1, n))).alias("_prefix"))
    shortest = heads.join(short, "_prefix").groupBy("_key").agg(F.min("_days").alias("retention_days"))
    found = objects.join(shortest, F.col(path) == F.col("_key"), "left").drop("_key")
    over = older_than(F.col(modified), now, F.col("retention_days"))
    return found.withColumn("expired", F.coalesce(over, F.lit(False)))


def expire(objects: DataFrame, rules: DataFrame, now: Column, path: str = "path",
           modified: str = "modificationTime") -> tuple[DataFrame, DataFrame]:
    """The expiry manifest and the surviving rows."""
    judged = retention(objects, rules, now, path, modified)
    return judged.where("expired").drop("expired"), judged.where("NOT expired").drop("expired", "retention_days")


def tier(objects: DataFrame, now: Column, modified: str = "modificationTime", days: int = COLD_AFTER_DAYS) -> DataFrame:
    cold = older_than(F.col(modified), now, F.lit(days))
    return objects.withColumn("tier", F.when(cold, F.lit("cold")).otherwise(F.lit("hot")))


def snapshot(objects: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """Manifest of keys with size and content hash."""
    body = F.col(content).cast("binary")
    return objects.select(key, F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("hash"))


def diff(old: DataFrame, new: DataFrame, key: str, hash: str = "hash") -> DataFrame:
    """Keys added, removed or changed between two manifests."""
    a = old.select(key, F.col(hash).alias("old_hash"))
    b = new.select(key, F.col(hash).alias("new_hash"))
    joined = a.join(b, key, "full_outer")
    change = (F.when(F.col("old_hash").isNull(), "added").when(F.col("new_hash").isNull(), "removed")
              .when(F.col("old_hash") != F.col("new_hash"), "changed"))
    return joined.withColumn("change", change).where(F.col("change").isNotNull())


def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of `a` not in `b`, counting duplicates."""
    return a.exceptAll(b)
