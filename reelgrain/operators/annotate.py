"""Detections, roll-ups, sampled prompts and training splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PROMPT_SAMPLE
from .joins import class_names
from .ordered import top_n


def normalise_detections(df: DataFrame, box: list[str], confidence: str, class_id: str, names: DataFrame,
                         name: str, keep: list[str]) -> DataFrame:
    """One detection struct per row from box corners, confidence and class."""
    named = class_names(df, names, class_id, name)
    detection = F.struct(
        F.array(*[F.col(c).cast("float") for c in box]).alias("bbox"),
        F.col(confidence).cast("float").alias("confidence"),
        F.col(class_id).cast("int").alias("class_id"),
        F.col("class_name"),
    )
    return named.select(*keep, detection.alias("detection"))


def detections_per_frame(df: DataFrame, frame: str, detections: str) -> DataFrame:
    """Detections in each frame's array; a frame without any counts 0."""
    size = F.coalesce(F.size(detections), F.lit(0))
    return df.select(frame, F.greatest(size, F.lit(0)).alias("detections_count"))


def count_detections(frames: DataFrame, detections: DataFrame, frame: str) -> DataFrame:
    """The same from a table with one row per detection."""
    counts = detections.groupBy(frame).agg(F.count(F.lit(1)).alias("_n"))
    joined = frames.select(frame).join(counts, frame, "left")
    return joined.select(frame, F.coalesce("_n", F.lit(0).cast("long")).alias("detections_count"))


def rollup_detections(df: DataFrame, keys: list[str], frame: str, confidence: str) -> DataFrame:
    """Detections, frames and confidence per group."""
    per_frame = df.groupBy(*keys, frame).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(confidence).alias("_s"), F.max(confidence).alias("_m"))
    return per_frame.groupBy(*keys).agg(
        F.sum("_n").alias("detections"),
        F.count(F.lit(1)).alias("frames"),
        (F.sum("_s") / F.sum("_n")).alias("avg_confidence"),
        F.max("_m").alias("max_confidence"),
    )


def seeded_order(key: Column, seed: int) -> Column:
    """A reproducible shuffle order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def sample_n(df: DataFrame, keys: list[str], item: str, n: int = PROMPT_SAMPLE, seed: int = 0) -> DataFrame:
    """Up to `n` rows per group, the same ones on every run."""
    return top_n(df, keys, [seeded_order(F.col(item), seed), F.asc(item)], n)


def hash_split(df: DataFrame, item: str, weights: dict[str, int], seed: int = 0) -> DataFrame:
    """Assign splits by a hash of the id; `weights` are percentages in order."""
    if sum(weights.values()) != 100:
        raise ValueError("weights must add up to 100")
    digest = seeded_order(F.col(item), seed)
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    split, upto = F.lit(None).cast("string"), 100
    # built from the last split inwards, so that the lowest bound is tested first
    for name, share in reversed(list(weights.items())):
        split = F.when(bucket < upto, F.lit(name)).otherwise(split)
        upto -= share
    return df.withColumn("split", split)


def build_prompt(df: DataFrame, keys: list[str], item: str, fields: list[str], template: str, n: int = PROMPT_SAMPLE,
                 seed: int = 0) -> DataFrame:
    """One text per group: `template` filled with the keys and the JSON of up to `n` sampled rows."""
    sampled = sample_n(df, keys, item, n, seed)
    # at most n rows per group are collected
    rows = F.array_sort(F.collect_list(F.struct(item, *[f for f in fields if f != item])))
    grouped = sampled.groupBy(*keys).agg(rows.alias("_rows"))
    return grouped.select(*keys, F.size("_rows").alias("samples"),
                          F.format_string(template, *[F.col(k) for k in keys], F.to_json("_rows")).alias("prompt"))
