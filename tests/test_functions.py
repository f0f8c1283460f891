"""Column functions on hand-made cases."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from reelgrain.functions import paths as p
from reelgrain.functions import times as tm
from reelgrain.functions import values as v


@pytest.mark.parametrize(("column", "want"), [
    (lambda: p.stem_last(F.lit("a.tar.mp4")), "a.tar"), (lambda: p.stem_first(F.lit("a.tar.mp4")), "a"), (lambda: p.stem_last(F.lit("plain")), "plain"),
    (lambda: p.basename(F.lit("/x/y/z.mp4")), "z.mp4"), (lambda: p.basename(F.lit("z.mp4")), "z.mp4"),
    (lambda: p.dirname(F.lit("/x/y/z.mp4")), "/x/y"), (lambda: p.dirname(F.lit("z.mp4")), ""), (lambda: p.dirname(F.lit("/z.mp4")), "/"),
    (lambda: p.relative_path(F.lit("/m/run/tex/a.png"), "/m/run"), "tex/a.png"), (lambda: p.relative_path(F.lit("/other/a.png"), "/m/run"), None),
    (lambda: p.frame_name(F.lit(3)), "frame_000003.png"), (lambda: p.frame_name(F.lit(3), 4, "jpg"), "frame_0003.jpg"),
    (lambda: p.frame_name(F.lit(0), 4, "jpg", 1), "frame_0001.jpg"), (lambda: p.strip_scheme(F.lit("https://h:9/x")), "h:9/x"),
    (lambda: p.join_path(F.lit("a"), F.lit("b")), "a/b"), (lambda: p.build_key("models", F.lit("v1"), "mesh.ply"), "models/v1/mesh.ply"),
    (lambda: tm.clock_seconds(F.lit("00:01:02.50")), 62.5), (lambda: tm.clock_seconds(F.lit("N/A")), None),
    (lambda: v.target_fps(F.lit(30)), 2.0), (lambda: v.target_fps(F.lit(1.5)), 1.5), (lambda: v.stride_from_fps(F.lit(300), F.lit(30)), 150),
    (lambda: v.stride(F.lit(599)), 1), (lambda: v.stride(F.lit(600)), 2), (lambda: v.stride(F.lit(599), mode="ceil"), 2), (lambda: v.stride(F.lit(0)), 1),
    (lambda: v.flag(F.lit("1")), True), (lambda: v.flag(F.lit("0")), False), (lambda: v.flag(F.lit("TRUE")), True), (lambda: v.flag(F.lit(None).cast("string")), False),
    (lambda: v.default_text(F.lit(""), "x"), "x"), (lambda: v.default_text(F.lit("y"), "x"), "y"),
    (lambda: v.resolution_text(F.array(F.lit(1920), F.lit(1080))), "1920x1080"),
    (lambda: p.has_suffix(F.lit("a.MP4"), (".mp4",)), False), (lambda: p.has_suffix(F.lit("a.MP4"), (".mp4",), True), True),
    (lambda: tm.format_iso(F.lit("2023-10-15 14:00:00").cast("timestamp")), "2023-10-15T14:00:00"),
])
def test_scalar(spark, column, want):
    assert spark.range(1).select(column()).first()[0] == want


def test_both_time_formats_agree(spark):
    got = spark.range(1).select(tm.parse_timestamp(F.lit("20231015T140000Z")), tm.parse_timestamp(F.lit("2023-10-15T14:00:00Z"))).first()
    assert got[0] == got[1] is not None


def test_key_with_underscores_in_the_camera(spark):
    key = spark.range(1).select(p.parse_key(F.lit("stadium_01/game_20231015/cam_01_20231015T140000Z.mp4")).alias("k"))
    row = key.select("k.venue_id", "k.event_id", "k.camera_id", F.unix_timestamp("k.timestamp").alias("s")).first()
    seconds = int(dt.datetime(2023, 10, 15, 14, tzinfo=dt.timezone.utc).timestamp())
    assert tuple(row) == ("stadium_01", "game_20231015", "cam_01", seconds)


def test_key_that_does_not_fit(spark):
    row = spark.range(1).select(p.parse_key(F.lit("notes.txt")).alias("k")).select("k.*").first()
    assert row.camera_id is None and row.timestamp is None and row.venue_id is None


def test_age_is_strict(spark):
    now = F.lit("2024-03-31").cast("timestamp_ntz")
    ages = spark.createDataFrame([(29,), (30,), (31,)], "age INT").select(
        "age", tm.older_than(F.expr("TIMESTAMP_NTZ'2024-03-31' - make_interval(0, 0, 0, age)"), now, F.lit(30)).alias("old"))
    assert {r.age: r.old for r in ages.collect()} == {29: False, 30: False, 31: True}


def test_paths_agree_with_the_standard_library(spark):
    rng = random.Random(4)
    made = ["/".join("".join(rng.choice("ab._- é") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    made += ["/" + m for m in made[:100]] + [m + "/" for m in made[100:150]]
    df = spark.createDataFrame([(m,) for m in made], "p STRING")
    for row in df.select("p", p.basename(F.col("p")).alias("b"), p.dirname(F.col("p")).alias("d")).collect():
        assert row.b == os.path.basename(row.p), row.p
        assert row.d == os.path.dirname(row.p), row.p
