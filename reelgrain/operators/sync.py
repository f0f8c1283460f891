"""Time alignment of several cameras."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import micros
from .ordered import CARRY, MARK, ROWS_PER_SLICE, SLICE, running_total, slice_rows, with_carry


def _axis(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(column)
    return column.cast("long")


def asof(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str],
         tie: str, left_tie: str | None = None, tolerance: int | None = None, direction: str = "backward",
         prefix: str = "", per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """For each left row the closest right row in time within `on`; null where there is none.

    `direction` is `backward` (at or before), `forward` (at or after) or `nearest` (backward wins
    a draw). Times are timestamps or whole numbers; `tolerance` is in microseconds or in that
    number's unit. Right rows at the same time: the largest `tie` looking back, the smallest looking
    ahead, of any type that sorts. A null in `on` or in a time matches nothing. One pass over the union
    of both sides; every left row gives one row.
    """
    if direction == "nearest":
        held = [right_ts, *[v for v in values if v != right_ts]]
        back = asof(left, right, on, left_ts, right_ts, held, tie, left_tie, tolerance, "backward",
                    "_b_", per_slice)
        both = asof(back, right, on, left_ts, right_ts, held, tie, left_tie, tolerance, "forward",
                    "_f_", per_slice)
        here = _axis(left, left_ts)
        far = F.col(f"_f_{right_ts}").isNotNull() & (
            F.col(f"_b_{right_ts}").isNull()
            | (_axis(both, f"_f_{right_ts}") - here < here - _axis(both, f"_b_{right_ts}")))
        picks = [F.when(far, F.col(f"_f_{v}")).otherwise(F.col(f"_b_{v}")).alias(prefix + v) for v in values]
        return both.select(*left.columns, *picks)
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    sign = 1 if direction == "backward" else -1
    lrows = left.select(*on, (_axis(left, left_ts) * sign).alias("_t"), F.lit(1).alias("_side"),
                        F.struct(*left.columns).alias("_left"))
    held = F.struct((_axis(right, right_ts) * sign).alias("_at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    rrows = right.select(*on, (_axis(right, right_ts) * sign).alias("_t"), F.lit(0).alias("_side"),
                         F.col(tie).alias("_tie"), held.alias("_right"))
    rrows = rrows.where(F.col("_t").isNotNull()).dropna(subset=list(on))
    both = lrows.unionByName(rrows, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_side"), F.col("_tie").asc() if sign == 1 else F.col("_tie").desc_nulls_first()]
    here = F.col("_right").isNotNull()
    latest = (F.max_by("_right", F.when(here, F.struct("_t", "_tie"))) if sign == 1 else
              F.min_by("_right", F.when(here, F.struct(-F.col("_t"), F.col("_tie").isNull(), "_tie"))))
    rows = with_carry(slice_rows(both, on, ["_t"], per_slice), on, latest, lambda part: F.last(part, ignorenulls=True))
    rows = rows.withColumn("_right", F.when(F.col(MARK), F.col(CARRY)).otherwise(F.col("_right")))
    order = [F.desc(MARK), *order]
    seen = Window.partitionBy(*on, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_hit", F.last("_right", ignorenulls=True).over(seen)).where(F.col("_left").isNotNull())
    hit = F.col("_hit")
    if tolerance is not None:
        hit = F.when(F.col("_t") - F.col("_hit._at") <= tolerance, hit)
    rows = rows.withColumn("_hit", hit)
    return rows.select("_left.*", *[F.col(f"_hit.v{i}").alias(prefix + v) for i, v in enumerate(values)])


def interval_counts(left: DataFrame, right: DataFrame, on: Sequence[str], left_id: str, left_ts: str, right_ts: str,
                    tolerance: int, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """How many right rows lie within `tolerance` of each left row, as (left_id, matches).

    Each left row asks twice how many right rows there are up to a time, at the interval's end and
    just before its start, so dense moments do not multiply into pairs. A null in `on` matches nothing.
    """
    zero = F.lit(0).cast("long")
    asked = F.explode(F.array(
        F.struct((_axis(left, left_ts) + tolerance).alias("_t"), F.lit(1).alias("_sign")),
        F.struct((_axis(left, left_ts) - tolerance - 1).alias("_t"), F.lit(-1).alias("_sign")))).alias("_ask")
    probes = left.select(*on, left_id, asked).select(
        *on, left_id, "_ask._t", "_ask._sign", zero.alias("_one"), F.lit(1).alias("_side"))
    seen = right.select(*on, _axis(right, right_ts).alias("_t"), F.lit(1).cast("long").alias("_one"), F.lit(0).alias("_side"))
    both = probes.unionByName(seen.where(F.col("_t").isNotNull()).dropna(subset=list(on)), allowMissingColumns=True)
    counted = running_total(both, on, ["_t", "_side"], F.col("_one"), "_upto", per_slice=per_slice)
    answers = counted.where("_side = 1").groupBy(left_id).agg(F.sum(F.col("_upto") * F.col("_sign")).alias("matches"))
    return answers.withColumn("matches", F.coalesce("matches", zero))
