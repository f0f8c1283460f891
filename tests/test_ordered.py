"""Ordered operators against plain windows, with slices forced and one key holding most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelgrain.operators import frames as fr
from reelgrain.operators import ordered as o
from reelgrain.operators.sync import asof, interval_counts

SMALL = 40


def skewed(spark, n=1200):
    """Two thirds of the rows under one key, a third of them at one moment, and null keys and times."""
    base = spark.range(n).withColumn("h", F.xxhash64("id", F.lit(3)))
    return base.select(
        "id",
        F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 50 == 2, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("key"),
        F.when(F.col("id") % 3 == 1, F.lit(500)).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.pmod("h", F.lit(1000))).cast("long").alias("t"),
        (F.pmod("h", F.lit(13)) + 1).alias("v"),
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("order", [["t", "id"], ["name", "id"], ["day", "name"], ["flag", "x", "id"], ["price", "id"], ["raw"]])
def test_slices_are_bounded_and_follow_the_order(spark, order):
    df = skewed(spark).select(
        "*", F.xxhash64("id", F.lit(9)).alias("h")).select(
        "*", F.concat(F.lit("s3://media/2024/" * 40), F.when(F.col("id") % 5 > 0, F.lit("é/" * o.TEXT_BLOCK)).otherwise(F.lit("")),
                      F.lpad("v", 3, "0"), F.lpad("id", 5, "0")).alias("name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("h", F.lit(3)).cast("int")).alias("day"), (F.col("id") % 2 == 0).alias("flag"),
        F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).otherwise(F.pmod("h", F.lit(4)).cast("double")).alias("x"),
        (F.pmod("h", F.lit(7)) / 3).cast("decimal(12,4)").alias("price"), F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("raw"))
    sliced = o.slice_rows(df, ["key"], order, SMALL).cache()
    sizes = {(r["key"], r[o.SLICE]): r["count"] for r in sliced.groupBy("key", o.SLICE).count().collect()}
    assert sum(sizes.values()) == 1200 and max(sizes.values()) <= SMALL
    w = Window.partitionBy("key").orderBy(*order)
    steps = sliced.withColumn("back", F.col(o.SLICE) < F.lag(o.SLICE).over(w))
    assert steps.where("back").count() == 0


def test_any_number_of_big_keys_is_cut(spark):
    """1,500 keys of 200 rows each above a limit of 100, with unlike ranges of their own."""
    df = spark.range(300_000).select(F.pmod("id", F.lit(1500)).alias("key"), (F.hash("id") + F.pmod("id", F.lit(1500)) * 10_000_000_000).alias("t"), "id")
    sliced = o.slice_rows(df, ["key"], ["t", "id"], 100)
    sizes = sliced.groupBy("key", o.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    assert sizes.groupBy("key").count().where("count < 2").count() == 0


def test_close_values_of_a_far_range(spark):
    """Whole numbers that a double can't tell apart are told apart from their own start."""
    df = spark.range(500).select(F.lit(1).alias("key"), (F.col("id") + F.lit(2**62)).alias("t"))
    df = df.unionByName(spark.range(5).select(F.lit(1).alias("key"), (-F.col("id") - F.lit(2**62)).alias("t")))
    sizes = o.slice_rows(df, ["key"], ["t"], SMALL).groupBy(o.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= SMALL


def test_without_big_keys_the_plan_has_one_branch(spark):
    got = o.running_total(skewed(spark), ["key"], ["t", "id"], F.col("v"), "r", "all", 10_000)
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("per_slice", [SMALL, 10_000])
def test_running_total(spark, per_slice):
    df = skewed(spark)
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("r", F.sum("v").over(w)).withColumn("all", F.sum("v").over(Window.partitionBy("key")))
    got = o.running_total(df, ["key"], ["t", "id"], F.col("v"), "r", "all", per_slice)
    assert got.columns == want.columns
    assert rows(got, "key", "id", "r", "all") == rows(want, "key", "id", "r", "all")


def test_position_without_key(spark):
    df = skewed(spark)
    got = o.with_position(df, [], ["t", "id"], per_slice=SMALL)
    want = df.withColumn("position", F.row_number().over(Window.orderBy("t", "id")) - 1)
    assert rows(got, "id", "position") == rows(want, "id", "position")


def test_previous_value(spark):
    df = skewed(spark).where("t IS NOT NULL")
    want = df.withColumn("p", F.lag("t").over(Window.partitionBy("key").orderBy("t", "id")))
    assert rows(o.previous_value(df, ["key"], ["t", "id"], "p", SMALL), "id", "p") == rows(want, "id", "p")


@pytest.mark.parametrize("n", [3, 60])
def test_rolling(spark, n):
    df = skewed(spark)
    frame = Window.partitionBy("key").orderBy("t", "id").rowsBetween(-n, -1)
    want = df.withColumn("s", F.sum("v").over(frame))
    got = o.rolling(df, ["key"], ["t", "id"], n, {"s": F.sum("v")}, SMALL)
    assert rows(got, "id", "s") == rows(want, "id", "s")


@pytest.mark.parametrize("per_slice", [SMALL, 10_000])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_quantiles(spark, keys, per_slice):
    df = skewed(spark)
    marks = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q100": 1.0}
    want = df.groupBy(*keys).agg(*[F.percentile("t", p).alias(n) for n, p in marks.items()], F.sum("v").alias("s"))
    got = o.quantiles(df, "t", marks, keys, {"s": F.sum("v")}, per_slice)
    for a, b in zip(rows(got, *keys, *marks, "s"), rows(want, *keys, *marks, "s"), strict=True):
        assert a[: len(keys)] == b[: len(keys)]
        assert a[len(keys):] == pytest.approx(b[len(keys):])


def test_quantiles_of_a_big_key(spark):
    """Past the sketch's margin only values near the quantiles stay apart; small keys stay whole."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 50 == 0, F.lit("small")).otherwise(F.lit("big")).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.hash("id").cast("double")).alias("x"))
    marks = {"q25": 0.25, "q50": 0.5, "q99": 0.99}
    got = o.quantiles(df, "x", marks, ["key"], per_slice=1000)
    want = df.groupBy("key").agg(*[F.percentile("x", p).alias(n) for n, p in marks.items()])
    assert rows(got, "key", *marks) == rows(want, "key", *marks)


def test_top_n_beyond_the_group_limit(spark, monkeypatch):
    monkeypatch.setattr(o, "GROUP_LIMIT", 10)
    w = Window.partitionBy("key").orderBy(F.desc("v"), F.asc("id"))
    want = skewed(spark).withColumn("r", F.row_number().over(w)).where("r <= 100")
    got = o.top_n(skewed(spark), ["key"], [F.desc("v"), F.asc("id")], 100, "r")
    assert rows(got, "key", "id", "r") == rows(want, "key", "id", "r")


def test_top_n(spark):
    got = o.top_n(skewed(spark), ["key"], [F.desc("v"), F.asc("id")], 5)
    assert got.groupBy("key").count().agg(F.max("count")).first()[0] == 5


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof(spark, direction, tolerance):
    df = skewed(spark).where("t IS NOT NULL AND key IS NOT NULL")
    left = df.where("id % 2 = 0").select("key", F.col("id").alias("lid"), F.col("t").alias("lt"))
    right = df.where("id % 2 = 1 AND t % 3 = 0").select("key", F.col("id").alias("rid"), F.col("t").alias("rt"))
    got = asof(left, right, ["key"], "lt", "rt", ["rid", "rt"], "rid", tolerance=tolerance, direction=direction, per_slice=SMALL)
    lrows, rrows = left.collect(), right.collect()
    want = []
    for a in lrows:
        fits = [b for b in rrows if b.key == a.key and (tolerance is None or abs(b.rt - a.lt) <= tolerance)]
        back = max(((b.rt, b.rid) for b in fits if b.rt <= a.lt), default=None)
        ahead = min(((b.rt, b.rid) for b in fits if b.rt >= a.lt), default=None)
        if direction == "nearest":
            best = ahead if ahead and (not back or ahead[0] - a.lt < a.lt - back[0]) else back
        else:
            best = back if direction == "backward" else ahead
        want.append((a.lid, best[1] if best else None))
    assert rows(got, "lid", "rid") == sorted(want, key=repr)


def test_interval_counts(spark):
    df = skewed(spark, 400).where("t IS NOT NULL AND key IS NOT NULL")
    left = df.where("id % 2 = 0").select("key", F.col("id").alias("lid"), F.col("t").alias("lt"))
    right = df.where("id % 2 = 1").select("key", F.col("id").alias("rid"), F.col("t").alias("rt"))
    got = interval_counts(left, right, ["key"], "lid", "lt", "rt", 20, SMALL)
    rrows = right.collect()
    want = [(a.lid, sum(b.key == a.key and abs(b.rt - a.lt) <= 20 for b in rrows)) for a in left.collect()]
    assert rows(got, "lid", "matches") == sorted(want, key=repr)


@pytest.mark.parametrize(("total", "mode", "step", "kept"), [
    (599, "floor", 1, 599), (599, "ceil", 2, 300), (600, "floor", 2, 300), (1, "floor", 1, 1), (0, "floor", None, 0)])
def test_stride_cases(spark, total, mode, step, kept):
    frames = spark.range(total).select(F.lit("v").alias("video"), "id")
    got = fr.sample_frames(frames, "video", ["id"], 300, mode).collect()
    assert len(got) == kept
    assert {r.step for r in got} == ({step} if step else set())
    assert [r.seq for r in sorted(got, key=lambda r: r.frame_idx)] == list(range(kept))
    plan = fr.frame_plan(spark.createDataFrame([("v", total)], "video STRING, n BIGINT"), "video", "n", 300, mode)
    assert plan.count() == kept


def test_sampling_with_slices_equals_without(spark):
    df = skewed(spark)
    a = fr.sample_frames(df, "key", ["t", "id"], 10, per_slice=SMALL)
    b = fr.sample_frames(df, "key", ["t", "id"], 10)
    assert rows(a, "key", "id", "frame_idx", "seq") == rows(b, "key", "id", "frame_idx", "seq")


def test_resample_fill_holds_the_last_frame(spark):
    frames = spark.createDataFrame([("v", 0, 0), ("v", 1, 100_000), ("v", 2, 3_000_000)], "video STRING, id INT, us BIGINT")
    frames = frames.select("video", "id", F.timestamp_micros("us").alias("ts"))
    plain = fr.resample_fps(frames, "video", "ts", "id", 1.0)
    assert rows(plain, "slot", "id") == [(0, 0), (3, 2)]
    filled = fr.resample_fps(frames, "video", "ts", "id", 1.0, fill=True)
    assert rows(filled, "slot", "id") == [(0, 0), (1, 0), (2, 0), (3, 2)]


def test_gap_counts_missing_frames(spark):
    frames = spark.createDataFrame([("v", i, us) for i, us in enumerate((0, 500_000, 2_500_000))], "video STRING, id INT, us BIGINT")
    got = fr.gaps(frames.select("video", "id", F.timestamp_micros("us").alias("ts")), "video", "ts", "id", 2.0)
    assert rows(got, "id", "gap_seconds", "dropped", "missing_frames") == [
        (0, None, False, 0), (1, 0.5, False, 0), (2, 2.0, True, 3)]
