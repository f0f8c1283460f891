"""Tables in versions: retention and tiers that are acted on, half-finished and competing jobs."""

import os

import pytest
from pyspark.sql import functions as F

from reelgrain.sinks import versions as ver

NOW = "2024-06-01"


def objects(spark):
    return spark.range(40).select(
        F.concat(F.when(F.col("id") % 2 == 0, F.lit("raw/")).otherwise(F.lit("keep/")), F.col("id").cast("string")).alias("path"),
        F.date_sub(F.lit(NOW).cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("modificationTime"))


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_retention_and_tiers(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        ver.read_version(spark, root)
    assert ver.publish_version(objects(spark), root, 0) == 1
    rules = spark.createDataFrame([("raw/", 10)], "prefix STRING, days INT")
    assert ver.apply_retention(spark, root, rules, now()) == 2
    assert sorted(r.path for r in ver.read_version(spark, root).collect()) == sorted(
        f"{'raw' if i % 2 == 0 else 'keep'}/{i}" for i in range(40) if i % 2 or i <= 10)
    assert ver.apply_tiers(spark, root, now(), days=20) == 3
    rows = {r.path: r.tier for r in ver.read_version(spark, root, "tier").collect()}
    assert len(rows) == 26 and all((t == "cold") == (int(p.split("/")[1]) > 20) for p, t in rows.items())
    _, folders = ver.manifest(spark, root)
    assert any(".zstd." in n for n in os.listdir(folders["cold"])) and any(".snappy." in n for n in os.listdir(folders["hot"]))


def test_a_job_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    ver.publish_version(objects(spark), root, 0)
    with monkeypatch.context() as m:
        m.setattr(ver.json, "dumps", lambda folders: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ver.apply_tiers(spark, root, now())
    assert ver.manifest(spark, root)[0] == 1 and ver.read_version(spark, root).count() == 40
    assert ver.apply_tiers(spark, root, now()) == 2


def test_of_two_jobs_one_publishes(spark, tmp_path):
    root = str(tmp_path / "t")
    ver.publish_version(objects(spark), root, 0)
    ver.publish_version(objects(spark).limit(3), root, 1)
    with pytest.raises(ver.Conflict):
        ver.publish_version(objects(spark).limit(5), root, 1)
    assert ver.read_version(spark, root).count() == 3 and len(os.listdir(tmp_path / "t" / ver.MANIFESTS)) == 4  # two, and their checksums


def test_empty_survivors(spark, tmp_path):
    root = str(tmp_path / "t")
    ver.publish_version(objects(spark), root, 0)
    ver.apply_retention(spark, root, spark.createDataFrame([("", 0)], "prefix STRING, days INT"), F.lit("2030-01-01").cast("timestamp_ntz"))
    assert ver.read_version(spark, root).count() == 0
