"""Tables in versions: data is written beside the old one, and one small file makes it the table."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import COLD_AFTER_DAYS
from ..operators.lifecycle import expire, tier

MANIFESTS = "_manifests"
#: How each tier is compressed: cold data is read seldom.
CODECS = {"hot": "snappy", "cold": "zstd"}


class Conflict(RuntimeError):
    """Another job has published the version that this one would have."""


def _store(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MANIFESTS}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def manifest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number and folders by tier of the newest version; 0 and none of a table that isn't there."""
    store, path, jvm = _store(spark, root)
    if not store.exists(path):
        return 0, {}
    names = [s.getPath().getName() for s in store.listStatus(path)]
    newest = max((int(n) for n in names if n.isdigit()), default=0)
    if not newest:
        return 0, {}
    file = store.open(jvm.org.apache.hadoop.fs.Path(path, str(newest)))
    try:
        return newest, json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(file)).decode())
    finally:
        file.close()


def publish_version(df: DataFrame, root: str, after: int, tiers: str | None = None) -> int:
    """Write `df` as the version behind number `after`; rows go to a folder per value of the column `tiers`, if named.

    The data lies in fresh folders until the manifest, written under a name of its own and renamed in one step, makes it the
    table. A job that dies before leaves the old version as it was, and may run again. If another job has published meanwhile this one
    ends with `Conflict`.
    """
    spark, run, folders = df.sparkSession, uuid.uuid4().hex, {}
    for name, codec in CODECS.items() if tiers else [("hot", CODECS["hot"])]:
        folders[name] = f"{root.rstrip('/')}/data/{run}/{name}"
        part = df.where(F.col(tiers) == name).drop(tiers) if tiers else df
        part.write.option("compression", codec).parquet(folders[name])
    store, path, jvm = _store(spark, root)
    store.mkdirs(path)
    draft, target = (jvm.org.apache.hadoop.fs.Path(path, n) for n in (f".draft-{run}", str(after + 1)))
    out = store.create(draft, False)
    out.write(bytearray(json.dumps(folders).encode()))
    out.close()
    if store.exists(target) or not store.rename(draft, target):
        store.delete(draft, False)
        raise Conflict(f"version {after + 1} of {root} is there already")
    return after + 1


def read_version(spark: SparkSession, root: str, tiers: str | None = None) -> DataFrame:
    """The newest version of a table, with the tier of each row in the column `tiers`, if named."""
    number, folders = manifest(spark, root)
    if not number:
        raise FileNotFoundError(f"no version of a table in {root}")
    parts = [spark.read.parquet(path) for path in folders.values()]
    if tiers:
        parts = [p.withColumn(tiers, F.lit(name)) for p, name in zip(parts, folders, strict=True)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def apply_retention(spark: SparkSession, root: str, rules: DataFrame, now: Column, path: str = "path", modified: str = "modificationTime") -> int:
    """A version without the rows whose retention is over."""
    number, _ = manifest(spark, root)
    _, kept = expire(read_version(spark, root), rules, now, path, modified)
    return publish_version(kept, root, number)


def apply_tiers(spark: SparkSession, root: str, now: Column, modified: str = "modificationTime", days: int = COLD_AFTER_DAYS) -> int:
    """A version whose rows lie in the folder, and the compression, of their tier."""
    number, _ = manifest(spark, root)
    return publish_version(tier(read_version(spark, root), now, modified, days).withColumnRenamed("tier", "_tier"), root, number, "_tier")
