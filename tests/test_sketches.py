"""Mergeable profiles against exact ones."""

import math

import pytest
from pyspark.sql import functions as F

from reelgrain.operators import profile as pr
from reelgrain.operators import sketches as sk
from reelgrain.plans import drift
from reelgrain.plans.registry import Tables

PROBS = {"q10": 0.1, "q50": 0.5, "q99": 0.99}


@pytest.fixture(scope="module")
def table(spark):
    """A key with two thirds of the rows, a null key, values with ties, NaN, nulls, both zeros and a far offset."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 50 == 2, F.lit(None)).otherwise(F.lit("cold")).alias("key"),
        F.pmod(F.hash("id"), F.lit(7)).cast("int").alias("day"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)).cast("double")).alias("a"),
        (F.lit(1e9) + F.pmod(F.hash("id"), F.lit(3))).alias("b"), F.when(F.col("id") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("z"),
        F.lit(None).cast("int").alias("none"), (F.col("id") % 4).cast("decimal(10,2)").alias("d"))


COLUMNS = ["a", "b", "z", "none", "d"]


def by_column(rows):
    return {r["column"]: r.asDict() for r in rows.collect()}


@pytest.mark.parametrize("merged", [False, True])
def test_profile(spark, table, merged):
    found = sk.merge(sk.sketch(table, COLUMNS, ["key", "day"])) if merged else sk.sketch(table, COLUMNS)
    got = by_column(sk.judged(found, table, COLUMNS, PROBS))
    clean = table.withColumn("a", F.nanvl("a", F.lit(None).cast("double")))
    want = by_column(pr.profile(clean, COLUMNS, exact=True))
    for c in COLUMNS:
        for name in ("n", "nulls", "min", "max"):
            assert got[c][name] == want[c][name], (c, name)
        for name in ("mean", "std"):
            assert got[c][name] == (pytest.approx(want[c][name], rel=1e-7) if want[c][name] is not None else None), (c, name)
        assert c == "none" or all(got[c][f"{n}_held"] for n in (*PROBS, "distinct")), c
    assert got["z"]["distinct"] == 1 and got["none"]["q50"] is None and got["none"]["distinct"] == 0


def test_keys_and_merges_agree(spark, table):
    direct = sk.sketch(table, COLUMNS, ["key"])
    again = sk.merge(sk.sketch(table.where("day < 3"), COLUMNS, ["key"]).unionByName(sk.sketch(table.where("day >= 3"), COLUMNS, ["key"])), ["key"])
    a, b = [{(r.key, r["column"]): r for r in sk.judged(x, table, COLUMNS, PROBS, ["key"]).collect()} for x in (direct, again)]
    assert len(a) == 15 and a.keys() == b.keys()
    for k in a:
        assert (a[k].n, a[k].nulls, a[k].min, a[k].max) == (b[k].n, b[k].nulls, b[k].min, b[k].max)
        assert k[1] == "none" or all(r[f"{n}_held"] for r in (a[k], b[k]) for n in PROBS)


def test_sketches_survive_a_table(spark, table, tmp_path):
    sk.sketch(table, ["a"], ["day"]).write.parquet(str(tmp_path / "s"))
    stored = sk.merge(spark.read.parquet(str(tmp_path / "s")))
    assert sk.judged(stored, table, ["a"], PROBS).select("q50_held", "distinct_held").first() == (True, True)


def test_empty_tables(spark, table):
    none = table.limit(0)
    assert sk.sketch(none, ["a"], ["key"]).count() == 0
    row = sk.read(sk.sketch(none, ["a"]), PROBS).first()
    assert (row.n, row.nulls, row.q50, row.distinct) == (0, 0, None, 0)
    assert sk.merge(sk.sketch(none, ["a"], ["key"])).count() == 0


def test_quartiles_are_judged_by_rank(spark, tmp_path):
    """At a jump between two values either of them is a quartile."""
    row = [(F.col("id") % 2).cast("double").alias(c) for c in ("l_quantity", "l_discount", "l_tax")]
    spark.range(10_000).select(*row, F.col("id").cast("double").alias("l_extendedprice")).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = drift.e12_accuracy(Tables(spark, str(tmp_path))).collect()
    assert len(rows) == 4 and all(r.counts_equal and r.distinct_close and r.quartiles_close for r in rows)


def test_bounds():
    assert sk.rank_error(200) == pytest.approx(0.0133, abs=2e-4)
    assert sk.distinct_error(12, 1) == pytest.approx(1.04 / math.sqrt(4096))
