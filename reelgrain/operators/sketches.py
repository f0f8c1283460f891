"""Column profiles as mergeable sketches: kept as table rows, added up over partitions, days or tables.

One pass makes, for each key and column, counts and moments, a KLL quantile sketch and a HyperLogLog sketch. All parts of a row
can be merged with those of another, so a profile of a month is the merge of its days and no value is read twice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of quantile sketches, and log2 of the registers of distinct sketches.
QUANTILE_K, DISTINCT_LG = 1024, 13


def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of a KLL sketch, kept by single quantiles with 99 % confidence (Karnin, Lang, Liberty 2016, as fitted by DataSketches)."""
    return 2.296 / k ** 0.9723


def distinct_error(lg: int = DISTINCT_LG, deviations: int = 3) -> float:
    """Relative error of a distinct count, for a number of standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg)


def _same(keys: Sequence[str], a: str, b: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return same


def sketch(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), k: int = QUANTILE_K, lg: int = DISTINCT_LG) -> DataFrame:
    """`*keys, column, rows, n, low, high, mean, m2, quantile_sketch, distinct_sketch`: one row per key and numeric column.

    One aggregate over the table whatever the number of columns; tasks send sketches of fixed size, so a big key is no big
    task. Nulls and NaN are left out of all but `rows`; a column without values has null moments and empty sketches. An empty
    table has no keys, and without keys one row per column.
    """
    parts = []
    for c in columns:
        # sketches take no -0.0 for another value than 0.0
        value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
        parts.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
            F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"),
            F.kll_sketch_agg_double(value, F.lit(k)).alias("quantile_sketch"), F.hll_sketch_agg(value.cast("string"), F.lit(lg)).alias("distinct_sketch")))
    found = df.groupBy(*keys).agg(F.array(*parts).alias("_all"))
    return found.select(*keys, F.explode("_all").alias("_p")).select(*keys, "_p.*")


def merge(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketch rows merged over all but `keys` and the column: of partitions, of days, or of a union of several tables."""
    at = [*keys, "column"]
    # moments are taken from a value amid the parts' means, so that large values with little spread lose no digits
    near = sketches.groupBy(*at).agg(F.avg("mean").alias("_near"))
    gap = F.col("mean") - F.col("_near")
    parts = sketches.alias("p").join(near.alias("m"), _same(at, "p", "m")).select("p.*", (F.col("n") * gap).alias("_first"), (F.col("n") * gap * gap).alias("_second"), "_near")
    merged = parts.groupBy(*at).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("m2").alias("_within"),
        F.sum("_first").alias("_first"), F.sum("_second").alias("_second"), F.max("_near").alias("_near"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))
    some = F.nullif(F.col("n"), F.lit(0))
    return merged.select(
        *at, "rows", "n", "low", "high", (F.col("_near") + F.col("_first") / some).alias("mean"),
        (F.col("_within") + F.col("_second") - F.col("_first") * F.col("_first") / some).alias("m2"), "quantile_sketch", "distinct_sketch")


def quantile(p: float) -> Column:
    """A quantile of sketch rows, null where there are no values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(p))))


def read(sketches: DataFrame, probs: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """`*keys, column, n, nulls, min, max, mean, std, distinct` and the named quantiles of sketch rows."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return sketches.select(
        *keys, "column", "n", (F.col("rows") - F.col("n")).alias("nulls"), F.col("low").alias("min"), F.col("high").alias("max"), "mean",
        deviation.alias("std"), F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *[quantile(p).alias(name) for name, p in probs.items()])


def judged(sketches: DataFrame, df: DataFrame, columns: Sequence[str], probs: dict[str, float], keys: Sequence[str] = (),
           k: int = QUANTILE_K, lg: int = DISTINCT_LG) -> DataFrame:
    """`read` with `<name>_held` for each quantile and `distinct_held`: whether the sketch kept its error bound on the table it stands for."""
    found = read(sketches, probs, keys)
    values = df.select(*keys, *[F.col(c).cast("double") for c in columns]).unpivot(list(keys), list(columns), "column", "_v").where("_v IS NOT NULL AND NOT isnan(_v)")
    # sketch rows are few; which side is broadcast is left to Spark
    both = values.alias("v").join(found.alias("s"), _same([*keys, "column"], "v", "s"))
    ranks = both.groupBy(*[F.col(f"s.{c}") for c in (*keys, "column")]).agg(
        *[F.count_if(F.col("_v") < F.col(f"s.{n}")).alias(f"_{n}_below") for n in probs],
        *[F.count_if(F.col("_v") <= F.col(f"s.{n}")).alias(f"_{n}_upto") for n in probs])
    counted = values.distinct().groupBy(*keys, "column").agg(F.count(F.lit(1)).alias("_true"))
    every = found.alias("s").join(ranks.alias("r"), _same([*keys, "column"], "s", "r"), "left").join(counted.alias("c"), _same([*keys, "column"], "s", "c"), "left")
    error, slack = rank_error(k), F.lit(distinct_error(lg)) * F.col("_true")
    held = [((F.col(f"_{n}_below") <= F.lit(p + error) * F.col("s.n")) & (F.col(f"_{n}_upto") >= F.lit(p - error) * F.col("s.n"))).alias(f"{n}_held")
            for n, p in probs.items()]
    return every.select("s.*", *held, (F.abs(F.col("s.distinct") - F.col("_true")) <= F.greatest(slack, F.lit(1.0))).alias("distinct_held"))
