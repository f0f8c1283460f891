"""Path, key and file name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import COMPACT_PATTERN, parse_timestamp


def join_path(*parts: Column) -> Column:
    """Parts joined by `/`; nulls are skipped."""
    return F.concat_ws("/", *parts)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    cut = F.regexp_replace(path, "/[^/]*$", "")
    return (
        F.when(F.instr(path, "/") == 0, F.lit(""))
        .when(F.instr(path, "/") == 1, F.when(cut == "", F.lit("/")).otherwise(cut))
        .otherwise(cut)
    )


def stem_last(name: Column) -> Column:
    """File name without its last suffix: `a.tar.mp4` gives `a.tar`."""
    return F.regexp_replace(name, "\\.[^.]*$", "")


def stem_first(name: Column) -> Column:
    """File name up to its first dot: `a.tar.mp4` gives `a`."""
    return F.substring_index(name, ".", 1)


def relative_path(path: Column, root: str) -> Column:
    """`path` below `root`; null for a path outside of it."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30))


def below_root(path: Column, root: str) -> Column:
    """The part of a listed path after its root; a listing may add a scheme in front of the root."""
    base = root.rstrip("/") + "/"
    at = F.instr(path, base)
    return F.when(at > 0, F.substr(path, at + F.lit(len(base))))


def located(uri: str):
    """The store of a listed path and its key there, inside tasks."""
    from pyarrow import fs

    # Spark lists local files as file:/x, and its S3 connector has a scheme of its own
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


def frame_name(index: Column, width: int = 6, ext: str = "png", start: int = 0) -> Column:
    """Zero-padded frame name; `start` is the number of the first frame."""
    return F.format_string(f"frame_%0{width}d.{ext}", index + F.lit(start))


def parse_key(key: Column) -> Column:
    """`<venue>/<event>/<camera>_<timestamp>.mp4` as a struct; camera ids may contain `_`."""
    parts = F.split(key, "/")
    name = basename(key)
    pattern = f"^(.*)_({COMPACT_PATTERN})\\.mp4$"
    stamp = F.regexp_extract(name, pattern, 2)
    return F.struct(
        F.try_element_at(parts, F.lit(-3)).alias("venue_id"),
        F.try_element_at(parts, F.lit(-2)).alias("event_id"),
        F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).alias("camera_id"),
        parse_timestamp(F.nullif(stamp, F.lit(""))).alias("timestamp"),
    )


def build_key(*parts: Column | str) -> Column:
    """Object key from columns and fixed segments."""
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def strip_scheme(url: Column) -> Column:
    return F.regexp_replace(url, "^https?://", "")


def has_suffix(name: Column, suffixes: tuple[str, ...], ignore_case: bool = False) -> Column:
    """True where the name ends with one of the suffixes (case counts by default)."""
    target = F.lower(name) if ignore_case else name
    hit = F.lit(False)
    for suffix in suffixes:
        hit = hit | target.endswith(suffix.lower() if ignore_case else suffix)
    return hit
