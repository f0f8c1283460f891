"""Rule validation and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_CONFIDENCE, MIN_TEXTURE
from ..functions.values import resolution_text

RULES = "rule STRING, column STRING, lo DOUBLE, hi DOUBLE, regex STRING"


def rule_rows(rules: DataFrame) -> list:
    """Rules are configuration, read to build the row expression: rows of one table's columns, not data."""
    return rules.select("rule", "column", "lo", "hi", "regex").distinct().orderBy("rule").collect()


def _check(df: DataFrame, rule) -> Column:
    column = F.col(rule["column"])
    if df.schema[rule["column"]].dataType.typeName() == "array":
        column = resolution_text(column)
    ok = F.lit(True)
    if rule["lo"] is not None:
        ok = ok & (column >= F.lit(rule["lo"]))
    if rule["hi"] is not None:
        ok = ok & (column <= F.lit(rule["hi"]))
    if rule["regex"] is not None:
        ok = ok & column.rlike(f"^(?:{rule['regex']})$")
    return F.coalesce(ok, F.lit(False))


def validate(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Add the outcome of every rule and whether all hold; a null value fails its rule.

    Rules of one name are one rule that holds where all of them do.
    """
    checks: dict[str, Column] = {}
    for r in rule_rows(rules):
        ok = _check(df, r)
        checks[r["rule"]] = checks[r["rule"]] & ok if r["rule"] in checks else ok
    if not checks:
        empty = F.create_map().cast("map<string,boolean>")
        return df.withColumn("validation_passed", F.lit(True)).withColumn("validation_results", empty)
    # flat, so that any number of rules makes an expression of the same depth
    passed = F.forall(F.array(*checks.values()), lambda ok: ok)
    pairs = [column for name, ok in checks.items() for column in (F.lit(name), ok)]
    return df.withColumn("validation_passed", passed).withColumn("validation_results", F.create_map(*pairs))


def gate(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Passed rows and quarantined rows; `strict` raises if there are any of the latter."""
    good, bad = df.where("validation_passed"), df.where(~F.col("validation_passed"))
    if strict and not bad.isEmpty():
        first = bad.select("validation_results").first()[0]
        raise ValueError(f"validation failed: {first}")
    return good, bad


def require_nonempty(videos: DataFrame, frames: DataFrame, key: str) -> DataFrame:
    """Videos with their frame count and whether it is zero."""
    counts = frames.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    joined = videos.join(counts, key, "left")
    return joined.withColumn("frame_count", F.coalesce("_n", F.lit(0).cast("long"))).drop("_n").withColumn(
        "empty", F.col("frame_count") == 0)


def require_artifacts(expected: DataFrame, objects: DataFrame, key: str = "path", strict: bool = False) -> DataFrame:
    """Expected keys that no object has."""
    missing = expected.join(objects.select(key), key, "left_anti")
    if strict and not missing.isEmpty():
        raise FileNotFoundError(missing.select(key).first()[0])
    return missing


def confident(df: DataFrame, column: str, min_conf: float = MIN_CONFIDENCE) -> DataFrame:
    """Detections at or above a confidence; for an array column, the arrays keep only those."""
    if df.schema[column].dataType.typeName() == "array":
        return df.withColumn(column, F.filter(column, lambda d: d["confidence"] >= F.lit(min_conf)))
    return df.where(F.col(column) >= F.lit(min_conf))


def small_textures(df: DataFrame, width: str, height: str, least: tuple[int, int] = MIN_TEXTURE) -> DataFrame:
    return df.where((F.col(width) < least[0]) | (F.col(height) < least[1]))


def route(df: DataFrame, use_cases: str, branches: list[str]) -> dict[str, DataFrame]:
    """One table per branch with the rows that list it among their use cases."""
    return {b: df.where(F.array_contains(use_cases, b)) for b in branches}


def routed(df: DataFrame, use_cases: str, branches: list[str]) -> DataFrame:
    """One row per row and branch it goes to."""
    wanted = F.array(*[F.lit(b) for b in branches])
    return df.withColumn("branch", F.explode(F.array_intersect(use_cases, wanted)))


def enabled(df: DataFrame, switch: str) -> DataFrame:
    """Rows whose stage switch is on; a missing switch is off."""
    return df.where(F.coalesce(F.col(switch).cast("boolean"), F.lit(False)))
