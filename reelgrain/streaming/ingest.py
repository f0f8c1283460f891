"""Arrival of new objects: watching, ingesting once, validating, overdue arrivals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import ARRIVAL_TIMEOUT_SECONDS, VIDEO_EXTENSIONS
from ..functions.paths import below_root
from ..functions.times import micros
from ..operators.validate import gate, validate
from ..sources.objects import LISTING, _glob

BINARY_FILE = f"{LISTING}, content BINARY"


def watch_objects(spark: SparkSession, root: str, exts: tuple[str, ...] = VIDEO_EXTENSIONS, recursive: bool = True,
                  max_files: int | None = None) -> DataFrame:
    """Stream of objects as they appear; the source's log gives each object once."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", _glob(exts))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(root).select("path", "length", "modificationTime")


def watch_path(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Arrival of the file whose key below `root` is `path`."""
    suffix = "." + path.rsplit(".", 1)[-1]
    return watch_objects(spark, root, (suffix,)).where(below_root(F.col("path"), root) == path.lstrip("/"))


def ingest(stream: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append each arrival to a table once; without `every` it takes what is there and stops."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def ingest_updates(stream: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the groups that each batch changed, windows that are still open included.

    The table is partitioned by batch, so a batch that is replayed replaces its own rows. Read it with
    `current_rows`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target))

    writer = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def current_rows(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of every group in a table of `ingest_updates`."""
    others = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")


def validate_stream(stream: DataFrame, rules: DataFrame, good: str, quarantine: str, checkpoint: str,
                    every: str | None = None) -> StreamingQuery:
    """Split a stream by validation rules into two tables.

    Both tables are partitioned by batch, so a batch that is replayed after a failure replaces its
    own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate(batch, rules).persist()
        passed, failed = gate(checked)
        for rows, target in ((passed, good), (failed, quarantine)):
            (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target))
        checked.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def dedupe(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def overdue(expected: DataFrame, objects: DataFrame, now: Column, key: str = "path", since: str = "expected_at",
            timeout: int = ARRIVAL_TIMEOUT_SECONDS) -> DataFrame:
    """Expected objects that have not come within the time limit."""
    late = expected.where(micros(F.col(since)) + F.lit(timeout * 1_000_000) < micros(now))
    return late.join(objects.select(key), key, "left_anti")
