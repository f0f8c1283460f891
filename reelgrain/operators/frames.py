"""Frame plans, sampling, indexing, resampling and gap detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MAX_FRAMES
from ..functions.paths import frame_name
from ..functions.times import micros
from ..functions.values import stride
from .ordered import ROWS_PER_SLICE, previous_value, top_n, with_position
from .sync import asof

FILL_CHUNK = 10_000


def frame_count(df: DataFrame, video: str) -> DataFrame:
    return df.groupBy(video).agg(F.count(F.lit(1)).alias("frame_count"))


def frame_plan(videos: DataFrame, video: str, total: str, max_frames: int = MAX_FRAMES, mode: str = "floor",
               width: int = 6, ext: str = "png") -> DataFrame:
    """Frames to read per video from its frame count alone, before any pixel is decoded."""
    step = stride(F.col(total), max_frames, mode)
    # the step bounds each sequence to fewer than 2 * max_frames entries
    planned = videos.where(F.col(total) > 0).withColumn("step", step)
    picks = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col(total).cast("long") - 1, F.col("step")))
    rows = planned.select("*", picks.alias("seq", "frame_idx"))
    return rows.withColumn("frame_name", frame_name(F.col("seq"), width, ext))


def index_frames(frames: DataFrame, video: str, order: list[str], out: str = "frame_idx",
                 per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    return with_position(frames, [video], order, out, per_slice=per_slice)


def sample_frames(frames: DataFrame, video: str, order: list[str], max_frames: int = MAX_FRAMES,
                  mode: str = "floor", per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Every `step`-th frame of a video, `step` set by its frame count.

    Keeps the source index (`frame_idx`) and the output index (`seq`).
    """
    placed = with_position(frames, [video], order, "frame_idx", "_total", per_slice)
    placed = placed.withColumn("step", stride(F.col("_total"), max_frames, mode))
    kept = placed.where(F.col("frame_idx") % F.col("step") == 0)
    return kept.withColumn("seq", F.call_function("div", F.col("frame_idx"), F.col("step"))).drop("_total")


def split_unread(frames: DataFrame, content: str) -> tuple[DataFrame, DataFrame]:
    """Frames that could be read, and the rest for a reject table."""
    return frames.where(F.col(content).isNotNull()), frames.where(F.col(content).isNull())


def resample_fps(frames: DataFrame, video: str, ts: str, tie: str, fps: float = 1.0, fill: bool = False) -> DataFrame:
    """First frame in each 1/fps second since the video's start; `fill` repeats the last one over gaps."""
    timed = frames.withColumn("_us", micros(F.col(ts)))
    start = timed.groupBy(video).agg(F.min("_us").alias("_start"))
    rate = F.lit(float(fps))
    slotted = timed.join(start, video).withColumn(
        "slot", F.floor((F.col("_us") - F.col("_start")) / F.lit(1e6) * rate).cast("long"))
    others = [c for c in frames.columns if c != video]
    # partial aggregation: one row per slot and input partition reaches the shuffle
    first = slotted.groupBy(video, "slot").agg(
        F.min_by(F.struct(*others), F.struct("_us", tie)).alias("_f"))
    sampled = first.select(video, "slot", *[F.col("_f")[c].alias(c) for c in others])
    if not fill:
        return sampled
    spans = sampled.groupBy(video).agg(F.max("slot").alias("_last"))
    # two explode steps with a shuffle between, so that a long video is not one huge array
    chunks = spans.select(video, "_last", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(FILL_CHUNK).cast("long"))).alias("_from"))
    chunks = chunks.repartition(F.col(video), F.col("_from"))
    slots = chunks.select(video, F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_last"), F.col("_from") + FILL_CHUNK - 1))).alias("slot"))
    held = asof(slots, sampled, [video], "slot", "slot", others, tie="slot", left_tie="slot")
    return held.select(video, "slot", *others)


def gaps(frames: DataFrame, video: str, ts: str, tie: str, fps: float, tolerance: float = 1.5,
         per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Time since the frame before, and how many frames of an `fps` stream are missing in it."""
    rows = previous_value(frames, [video], [ts, tie], "previous_ts", per_slice)
    gap = (micros(F.col(ts)) - micros(F.col("previous_ts"))) / F.lit(1e6)
    rows = rows.withColumn("gap_seconds", gap)
    missing = F.greatest(F.lit(0), F.round(F.col("gap_seconds") * F.lit(float(fps))) - 1).cast("long")
    dropped = F.col("gap_seconds") > F.lit(tolerance / fps)
    return rows.withColumn("dropped", F.coalesce(dropped, F.lit(False))).withColumn(
        "missing_frames", F.when(F.col("dropped"), missing).otherwise(F.lit(0).cast("long")))


def best_frames(frames: DataFrame, camera: str, score: str, n: int, tie: str) -> DataFrame:
    return top_n(frames, [camera], [F.desc(score), F.asc(tie)], n, "rank")
