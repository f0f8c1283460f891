"""Listing a store by its folders in tasks, and reading chosen objects by ranges of bytes."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import has_suffix, located
from ..session import staged

FOUND = "path STRING, length BIGINT, modificationTime TIMESTAMP, folder BOOLEAN"
#: Entries of a folder that become rows at once, and bytes of an object that one row holds.
BATCH, RANGE_BYTES = 10_000, 8 << 20


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder and begins with its `start`; a folder that isn't there has nothing."""
    from pyarrow import fs

    names = ["path", "length", "modificationTime", "folder"]
    for batch in batches:
        for root, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            store, key = located(root)
            rows = []
            for info in store.get_file_info(fs.FileSelector(key, allow_not_found=True)):
                if info.base_name.startswith(start) and not info.base_name.startswith((".", "_")):
                    changed = info.mtime or datetime.fromtimestamp(0, timezone.utc)
                    folder = info.type == fs.FileType.Directory
                    rows.append((posixpath.join(root, info.base_name), None if folder else info.size, changed, folder))
            for at in range(0, len(rows), BATCH):
                part = list(zip(*rows[at:at + BATCH], strict=True))
                kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds, strict=True)], names)


def list_tree(spark: SparkSession, root: str | list[str], prefix: str = "", exts: tuple[str, ...] | None = None,
              recursive: bool = True) -> DataFrame:
    """Objects below `root` whose keys begin with `prefix`: path, length, modificationTime.

    Folders are listed by tasks, level by level, so the driver holds the roots and counts, never names. The prefix goes to the
    store: the listing starts in the deepest folder that it names, and only entries that begin with the rest of it are followed.
    One folder is one task's work, as a store lists it page by page. Names that begin with a dot or an underscore are left
    out, as Spark's own listing does; a root that isn't there gives no rows.
    """
    inside, _, start = prefix.rpartition("/")
    roots = [posixpath.join(r.rstrip("/"), inside) if inside else r.rstrip("/") for r in ([root] if isinstance(root, str) else root)]
    level, levels = spark.createDataFrame([(r, start) for r in dict.fromkeys(roots)], "path STRING, start STRING"), []
    while True:
        count = Observation()
        # dealt out, for a level may come from few files
        found = level.repartition("path").mapInArrow(_children, FOUND).observe(count, F.count_if("folder").alias("folders"))
        table, _ = staged(found)
        levels.append(table)
        if not recursive or not count.get["folders"]:
            break
        level = table.where("folder").select("path", F.lit("").alias("start"))
    objects = levels[0]
    for table in levels[1:]:
        objects = objects.unionByName(table)
    objects = objects.where("NOT folder").drop("folder")
    return objects.where(has_suffix(F.col("path"), exts)) if exts else objects


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            store, key = located(row.column("path")[0].as_py())
            with store.open_input_file(key) as file:
                content = file.read_at(row.column("bytes")[0].as_py(), row.column("start")[0].as_py())
            yield pa.RecordBatch.from_arrays([*row.columns, pa.array([content], pa.binary())], [*row.schema.names, "content"])


def read_ranges(objects: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """Contents of listed objects (`path, length`) as rows of at most `size` bytes: path, start, bytes, content.

    A large object is read by several tasks at once and never has to fit one; an empty one is a row of no bytes. `join_ranges` puts
    objects of bounded size together again. Without `content` in what is selected of a listing no object is opened at all.
    """
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))
    rows = objects.select("path", "length", F.explode(cuts).alias("start"))
    rows = rows.select("path", "start", F.least(F.lit(size).cast("long"), F.col("length") - F.col("start")).alias("bytes"))
    return rows.repartition("path", "start").mapInArrow(_ranges, "path STRING, start BIGINT, bytes BIGINT, content BINARY")


def join_ranges(ranges: DataFrame) -> DataFrame:
    """Whole objects, each of which fits a row: path, content."""
    parts = ranges.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "content"))).alias("_parts"))
    return parts.select("path", F.aggregate("_parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["content"])).alias("content"))
