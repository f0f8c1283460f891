"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import ROWS_PER_SLICE, running_total
from .profile import to_long

SHARE_FLOOR = 1e-6


def ecdf(df: DataFrame, columns: list[str], per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Cumulative share at each distinct value of each column."""
    long = to_long(df, columns).where(F.col("value").isNotNull())
    # counted once, then read for the sizes, the slices and the sums
    counts = cut_lineage(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    steps = running_total(counts, ["column"], ["value"], F.col("n"), "_upto", "_all", per_slice)
    return steps.select("column", "value", "n", (F.col("_upto") / F.col("_all")).alias("cdf"))


def _sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    ref = to_long(reference, columns).select("column", "value", F.lit(1).alias("r"), F.lit(0).alias("c"))
    cur = to_long(current, columns).select("column", "value", F.lit(0).alias("r"), F.lit(1).alias("c"))
    return ref.unionByName(cur).where(F.col("value").isNotNull())


def psi(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, floor: float = SHARE_FLOOR) -> DataFrame:
    """Population stability index over equal-width bins that both sides share; null where a side has no values."""
    long = _sides(reference, current, columns)
    # one row per listed column, so the broadcast is bounded
    spans = F.broadcast(long.groupBy("column").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("r").alias("nr"), F.sum("c").alias("nc")))
    width = F.col("hi") - F.col("lo")
    raw = F.when(width > 0, F.floor((F.col("value") - F.col("lo")) / width * bins)).otherwise(F.lit(0))
    binned = long.join(spans, "column").withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("int"))
    counts = binned.groupBy("column", "bin").agg(F.sum("r").alias("br"), F.sum("c").alias("bc"))
    grid = spans.select("column", "nr", "nc", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    cells = grid.join(counts, ["column", "bin"], "left")
    p = F.greatest(F.try_divide(F.coalesce("br", F.lit(0)), F.col("nr")), F.lit(floor))
    q = F.greatest(F.try_divide(F.coalesce("bc", F.lit(0)), F.col("nc")), F.lit(floor))
    index = F.when(F.min(F.least("nr", "nc")) > 0, F.sum((q - p) * F.log(q / p)))
    return cells.groupBy("column").agg(index.alias("statistic"))


def ks(reference: DataFrame, current: DataFrame, columns: list[str], per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Largest distance between the two empirical distributions.

    Values are counted first; the running sum of the difference in share is the distance. It is null
    where a side has no values.
    """
    long = _sides(reference, current, columns)
    # counted once, then read for the sizes, the slices and the sums
    counts = cut_lineage(long.groupBy("column", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c")))
    # one row per listed column, so the broadcast is bounded
    sizes = F.broadcast(counts.groupBy("column").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc")))
    shares = counts.join(sizes, "column").select(
        "column", "value", (F.try_divide("r", "nr") - F.try_divide("c", "nc")).alias("_d"))
    steps = running_total(shares, ["column"], ["value"], F.col("_d"), "_gap", None, per_slice)
    return steps.groupBy("column").agg(F.max(F.abs("_gap")).alias("statistic"))


def drift(reference: DataFrame, current: DataFrame, columns: list[str], threshold: float, method: str = "psi",
          bins: int = 10, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Drift statistic per column and whether it is over the threshold."""
    if method == "psi":
        stats = psi(reference, current, columns, bins)
    elif method == "ks":
        stats = ks(reference, current, columns, per_slice)
    else:
        raise ValueError(f"unknown method {method!r}")
    return stats.withColumn("drifted", F.col("statistic") > F.lit(threshold))


def drift_share(drifted: DataFrame) -> DataFrame:
    return drifted.agg(F.count(F.lit(1)).alias("columns"), F.count_if("drifted").alias("drifted"),
                       F.avg(F.col("drifted").cast("double")).alias("share"))
