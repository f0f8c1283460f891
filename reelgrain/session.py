"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # streaming state on local disk instead of the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
#: Shuffle files go when the query that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "reelgrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `master` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for an input of a known size: shuffle partitions near 200 MB, at least two per core.

    AQE merges those that turn out small, so the number may be generous.
    """
    partitions = max(2 * cores, -(-input_bytes // (200 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m" if input_bytes > 1 << 40 else "128m",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions without it."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(folder)
        return folder
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="reelgrain-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame) -> tuple[DataFrame, str]:
    """Write `df` as a table in the shared folder and read it back; also its path.

    Losing executors then costs no recomputation, and unlike a checkpoint the rows are computed
    once and the planner knows their size. What the write shuffled is deleted with its end, as nothing else reads it.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, "stage"), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """`staged` without the path."""
    return staged(df)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
