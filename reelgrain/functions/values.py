"""Number, flag, default and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import FPS_CAP, MAX_FRAMES


def target_fps(fps: Column, cap: float = FPS_CAP) -> Column:
    return F.least(F.lit(float(cap)), fps.cast("double"))


def stride(total: Column, max_frames: int = MAX_FRAMES, mode: str = "floor") -> Column:
    """Step between sampled frames.

    `floor` may leave up to twice `max_frames` rows; `ceil` makes it an upper bound.
    """
    if mode not in ("floor", "ceil"):
        raise ValueError(f"unknown mode {mode!r}")
    whole = total.cast("long")
    if mode == "ceil":
        whole = whole + F.lit(max_frames - 1)
    quotient = F.call_function("div", whole, F.lit(max_frames).cast("long"))
    return F.greatest(F.lit(1).cast("long"), quotient)


def stride_from_fps(total: Column, fps: Column, cap: float = FPS_CAP) -> Column:
    return F.floor(total / target_fps(fps, cap)).cast("long")


def flag(text: Column) -> Column:
    """`1` or `true` is on, everything else off."""
    return F.coalesce(F.lower(text).isin("1", "true"), F.lit(False))


def default_text(text: Column, default: str) -> Column:
    """Replace null and empty text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def scale_array(values: Column, mean: float, std: float) -> Column:
    return F.transform(values, lambda x: (x.cast("double") - F.lit(float(mean))) / F.lit(float(std)))


def resolution_text(resolution: Column) -> Column:
    """`[1920, 1080]` to `1920x1080`."""
    return F.concat_ws("x", resolution.cast("array<string>"))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two numeric arrays, in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
