"""Ordered computations within a key, whatever number of keys is too big for one task.

A window sorts all rows of a key in one task. Here every group of more than `per_slice` rows, of any key, is cut along its
order at quantiles of its own; a slice that is still too big is cut again, by the next order column where all
its rows are equal in the one before. What a slice needs from earlier ones (a running sum, a last row) is
aggregated before the shuffle and enters the slice's window as one extra leading row, so the rows move once. Keys below the
limit have one slice and no extra row: the same plan, from which Catalyst drops the empty branch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import micros
from ..session import staged

ROWS_PER_SLICE = 500_000
#: Cuts of a group at one level, and how many lie between two that are looked at first.
CUTS, STRIDE = 256, 16
#: A level multiplies the slice number by BASE; six fit a long.
LEVELS, BASE = 6, 1024
SKETCH_ACCURACY = 10_000
GROUP_LIMIT = 1000
#: Bytes of a text that a double can hold, and bytes of two texts compared at once.
TEXT_BYTES, TEXT_BLOCK = 6, 256
SLICE, MARK, CARRY = "_slice", "_mark", "_carry"


def _whole(df: DataFrame, name: str) -> Column | None:
    """The column as a whole number that keeps its order; None if it isn't of such a type."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("long")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.col(name).cast("long")
    return None


def _common_bytes(a: Column, b: Column) -> Column:
    """Length of the common beginning of two binaries: the first block that differs, then the first byte in it."""
    def first(start: Column, step: int) -> Column:
        # `start` and the places after it, until the shorter one ends
        places = F.transform(F.sequence(F.lit(0), F.lit(TEXT_BLOCK - 1)), lambda i: start + i) if step == 1 else (
            F.transform(F.sequence(F.lit(0), F.call_function("div", F.least(F.octet_length(a), F.octet_length(b)), F.lit(step)).cast("int")),
                        lambda i: i * step))
        return F.array_min(F.filter(places, lambda i: ~a.substr(i + 1, F.lit(step)).eqNullSafe(b.substr(i + 1, F.lit(step)))))

    block = F.coalesce(first(F.lit(0), TEXT_BLOCK), F.least(F.octet_length(a), F.octet_length(b)))
    return F.coalesce(first(block, 1), block)


def _axes(df: DataFrame, order: Sequence[str]) -> list[tuple[Column, Column, Column, Column] | None]:
    """For each order column: lowest and highest value of a group, what its axis starts from, and the axis itself.

    An axis is a double that never falls along the order. It is measured from the group's own start, so that a group
    which looks equal on it really is, except for decimals closer than a double can tell.
    """
    out: list = []
    for i, name in enumerate(order):
        kind, start = df.schema[name].dataType, F.col(f"_s{i}")
        value = _whole(df, name)
        if value is not None:
            low, high, begin = F.min(value), F.max(value), F.col(f"_lo{i}")
            axis = (value.cast("decimal(20,0)") - start.cast("decimal(20,0)")).cast("double")
        elif isinstance(kind, T.NumericType):
            value = F.col(name)
            low, high, begin, axis = F.min(value), F.max(value), F.lit(0).cast("long"), value.cast("double")
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            value = F.col(name).cast("binary")
            low, high = F.min(value), F.max(value)
            begin = _common_bytes(F.col(f"_lo{i}"), F.col(f"_hi{i}")).cast("long")
            axis = F.conv(F.rpad(F.hex(value.substr(start.cast("int") + 1, F.lit(TEXT_BYTES))), 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
        else:
            out.append(None)
            continue
        out.append((low, high, begin, axis))
    return out


def _same(keys: Sequence[str]) -> Column:
    """Rows of a table with keys `_k0, _k1, ...` and `_ks` for the slice that belong to a row's group; nulls are equal."""
    same = F.col(SLICE) == F.col("_ks")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return same


def _too_big(rows: DataFrame, keys: Sequence[str], order: Sequence[str], per_slice: int) -> DataFrame | None:
    """Groups above the limit that can be cut, and by which column; None if there are none."""
    largest = rows.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if largest <= per_slice:
        return None
    axes, marks, varied, known = _axes(rows, order), [], [], []
    for i, (name, axis) in enumerate(zip(order, axes, strict=True)):
        if axis is None:
            # what sorts behind a column that has no axis stays as it is
            break
        marks += [axis[0].alias(f"_lo{i}"), axis[1].alias(f"_hi{i}"), F.count(F.col(name)).alias(f"_f{i}")]
        filled = F.col(f"_f{i}")
        varied.append((~F.col(f"_lo{i}").eqNullSafe(F.col(f"_hi{i}"))) | ((filled > 0) & (filled < F.col("_n"))))
        known.append(axis)
    if not known:
        return None
    groups = rows.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"), *marks).where(F.col("_n") > per_slice)
    by = F.coalesce(*[F.when(v, F.lit(i)) for i, v in enumerate(varied)], F.lit(None).cast("int"))
    starts = [F.when(F.col("_by") == i, axis[2]).alias(f"_s{i}") for i, axis in enumerate(known)]
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    table, _ = staged(groups.withColumn("_by", by).where("_by IS NOT NULL").select(*named, F.col(SLICE).alias("_ks"), "_n", "_by", *starts))
    return None if table.isEmpty() else table


def _cut(rows: DataFrame, keys: Sequence[str], order: Sequence[str], big: DataFrame, per_slice: int) -> DataFrame:
    """One level of slices: each group of `big` is cut at its own quantiles, and every value that is a cut has a slice of its own."""
    axes = _axes(rows, order)
    starts = [c for c in big.columns if c.startswith("_s")]
    names = [c for c in big.columns if c.startswith("_k")]
    axis = F.coalesce(*[F.when(F.col("_by") == int(s[2:]), axes[int(s[2:])][3]) for s in starts], F.lit(None).cast("double"))
    inside = rows.select(*dict.fromkeys([*keys, *order, SLICE])).join(big, _same(keys)).select(*names, "_n", "_by", *starts, axis.alias("_axis_v"))
    shares = [(i + 1) / CUTS for i in range(CUTS - 1)]
    found = inside.where("_axis_v IS NOT NULL AND NOT isnan(_axis_v)").groupBy(*names).agg(
        F.percentile_approx("_axis_v", shares, SKETCH_ACCURACY).alias("_all"), *[F.max(c).alias(c) for c in ("_n", "_by", *starts)])
    # about two slices for each `per_slice` rows
    step = F.greatest(F.lit(1), F.floor(F.col("_n").cast("double") ** -1 * F.lit(float(CUTS * per_slice) / 2))).cast("int")
    thin = F.array_distinct(F.filter(F.col("_all"), lambda x, i: (i + 1) % F.col("_step") == 0))
    found = found.withColumn("_step", F.least(step, F.lit(CUTS // 2))).withColumn("_cuts", thin)
    found = found.withColumn("_few", F.filter("_cuts", lambda x, i: (i + 1) % STRIDE == 0)).drop("_all", "_n", "_step")
    cuts, _ = staged(found)
    # small tables are broadcast by Spark's own check of their size
    joined = rows.join(cuts, _same(keys), "left").withColumn("_axis_v", axis)
    reached = lambda c: c <= F.col("_axis_v")
    before = F.size(F.filter("_few", reached)) * STRIDE
    joined = joined.withColumn("_axis_at", before).withColumn("_axis_at", F.col("_axis_at") + F.size(F.filter(F.slice("_cuts", F.col("_axis_at") + 1, STRIDE), reached)))
    on_cut = F.coalesce(F.get("_cuts", F.col("_axis_at") - 1) == F.col("_axis_v"), F.lit(False)).cast("int")
    part = F.when(F.col("_axis_v").isNull(), F.lit(0)).otherwise(2 * F.col("_axis_at") - on_cut) + 1
    number = F.col(SLICE) * BASE + F.when(F.col("_cuts").isNotNull(), part).otherwise(F.lit(0))
    return joined.withColumn(SLICE, number.cast("long")).drop(*names, "_by", *starts, "_cuts", "_few", "_axis_v", "_axis_at")


def slice_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add a slice number that never falls along `order` within a key; 0 for all rows of keys that aren't cut.

    Order columns are numbers, times, booleans, texts or binaries, nulls first; others are not cut, nor is what sorts
    behind them. Rows equal in all of them stay together. One aggregate over the input tells whether there is anything to cut; each
    further level reads it three times. Groups and cuts are tables, so their number has no limit.
    """
    rows = df.withColumn(SLICE, F.lit(0).cast("long"))
    for _ in range(LEVELS):
        big = _too_big(rows, keys, order, per_slice)
        if big is None:
            break
        rows = _cut(rows, keys, order, big, per_slice)
    return rows


def with_carry(sliced: DataFrame, keys: Sequence[str], part: Column, fold: Callable[[Column], Column],
               extra: dict[str, Column] | None = None) -> DataFrame:
    """Add one marked row per slice of a key that was cut, holding `fold` of `part` over the earlier slices.

    Windows over (key, slice) that sort marked rows first can then start from that value. `extra`
    names further aggregates over the whole key, given as functions of the slice parts.
    """
    parts = sliced.where(F.col(SLICE) > 0).groupBy(*keys, SLICE).agg(part.alias("_part"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    marks = parts.withColumn(CARRY, fold(F.col("_part")).over(before))
    for name, value in (extra or {}).items():
        marks = marks.withColumn(name, value.over(Window.partitionBy(*keys)))
    marks = marks.drop("_part").withColumn(MARK, F.lit(True))
    return sliced.withColumn(MARK, F.lit(False)).unionByName(marks, allowMissingColumns=True)


def _running(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, out: str, total: str | None) -> DataFrame:
    base = sliced.withColumn("_amount", amount)
    carried = with_carry(base, keys, F.sum("_amount"), F.sum, {"_sum_all": F.sum("_part")} if total else {})
    inside = Window.partitionBy(*keys, SLICE)
    ahead = inside.orderBy(F.desc(MARK), *order).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col(MARK), F.col(CARRY)).otherwise(F.col("_amount"))
    carried = carried.withColumn(out, F.sum(step).over(ahead))
    if total:
        # a slice of a key that was cut has the key's total in its marked row
        carried = carried.withColumn(total, F.coalesce(F.max("_sum_all").over(inside), F.sum("_amount").over(inside)))
    return carried.where(~F.col(MARK)).drop(MARK, CARRY, "_amount", "_sum_all")


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, out: str,
                  total: str | None = None, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Inclusive running sum of `amount` along `order` within `keys`, and the key's total."""
    return _running(slice_rows(df, keys, order, per_slice), keys, order, amount, out, total).drop(SLICE)


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
                  total: str | None = None, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """0-based position of each row along `order` within `keys`; `order` must be unique per key."""
    ranked = running_total(df, keys, order, F.lit(1).cast("long"), out, total, per_slice)
    return ranked.withColumn(out, F.col(out) - 1)


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                   per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Value of the first order column in the row before; null in a key's first row."""
    first = order[0]
    rows = with_carry(slice_rows(df, keys, order, per_slice), keys, F.max(first), F.max)
    ahead = Window.partitionBy(*keys, SLICE).orderBy(F.desc(MARK), *order)
    value = F.when(F.col(MARK), F.col(CARRY)).otherwise(F.col(first))
    rows = rows.withColumn("_value", value).withColumn(out, F.lag("_value").over(ahead))
    return rows.where(~F.col(MARK)).drop(SLICE, MARK, CARRY, "_value")


def rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, columns: dict[str, Column],
            per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Aggregates over the `n` rows before each row.

    Keys that are cut are dealt by position into blocks of equal length; each block also gets the last `n`
    rows of the block before it, which is all that its frames can reach.
    """
    length = max(per_slice, n)
    placed = _running(slice_rows(df, keys, order, per_slice), keys, order, F.lit(1).cast("long"), "_pos", None)
    was_cut, at = F.col(SLICE) > 0, F.col("_pos") - 1
    placed = placed.withColumn("_block", F.when(was_cut, F.call_function("div", at, F.lit(length))).otherwise(F.lit(-1)))
    lead = placed.where(was_cut & (at % length >= length - n)).withColumn("_block", F.col("_block") + 1)
    rows = placed.withColumn("_lead", F.lit(False)).unionByName(lead.withColumn("_lead", F.lit(True)))
    frame = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(-n, -1)
    rows = rows.withColumns({name: agg.over(frame) for name, agg in columns.items()})
    return rows.where(~F.col("_lead")).drop(SLICE, "_pos", "_block", "_lead")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """First `n` rows per key in `order`.

    Up to GROUP_LIMIT, Spark keeps at most `n` rows per key and input partition before the shuffle,
    so a big key arrives already reduced. Beyond, keys are first cut by a hash of the row into as many parts as a
    shuffle has.
    """
    out = rank or "_rank"
    if n > GROUP_LIMIT:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        within = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn(out, F.row_number().over(within)).where(F.col(out) <= n).drop("_salt", out)
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(out) <= n)
    return kept if rank else kept.drop(out)


def quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = (),
              extra: dict[str, Column] | None = None, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Exact interpolated quantiles per key, with further aggregates in `extra`.

    Equal values are counted before the shuffle, and the counts added up along the values; each quantile is read off where its
    ranks are reached. No task holds the values of a key. Sketches that need one pass are in `sketches`.
    """
    extra = extra or {}
    counts, _ = staged(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    steps = running_total(counts, keys, ["_v"], F.col("_n"), "_upto", "_all", per_slice)
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_all") - 1)
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.min(F.when(F.col("_upto") > rank, F.col("_v"))).alias(f"{name}_{end}"))
        picks.append(F.max(at - F.floor(at)).alias(f"{name}_w"))
    found = steps.groupBy(*keys).agg(*picks)
    marks = found.select(*keys, *[
        (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_w")).alias(n) for n in probs])
    totals = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in extra.items()]) if extra else df.select(*keys).distinct()
    if not keys:
        # one row on each side
        return marks if not extra else totals.select(*[marks.select(n).scalar().alias(n) for n in probs], *extra)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"m.{k}"))
    return totals.alias("t").join(marks.alias("m"), same, "left").select(*[F.col(f"t.{k}") for k in keys], *probs, *extra)
