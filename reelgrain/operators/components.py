"""Connected components of a match graph."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage, discard, staged


def _written(links: DataFrame) -> tuple[DataFrame, str, tuple]:
    """Links as a table, its path, and their number and sum of hashes, observed while they are written."""
    seen = Observation()
    table, path = staged(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")))
    return table, path, (seen.get["n"], seen.get["hashes"])


def components(edges: DataFrame, src: str, dst: str, max_rounds: int | None = None) -> DataFrame:
    """Smallest node id of the component of every node in `edges`.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): the number of rounds
    grows with the logarithm of the graph, and a step needs one minimum per node (aggregated
    before the shuffle) and one join. Each round is one job, which writes the links to the shared folder, in place of those
    before, and observes what tells whether they changed. With `max_rounds` it raises if the graph needs more.
    """
    # written once: the edges may be costly, and are read again for the nodes
    pairs = cut_lineage(edges.select(F.least(src, dst).alias("b"), F.greatest(src, dst).alias("a")).distinct())
    links = pairs.where("a <> b")
    seen, last = None, None
    for done in count():
        if done == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        # large star: neighbours above a node move to the smallest id around it
        both = links.unionByName(links.select(F.col("a").alias("b"), F.col("b").alias("a")))
        lows = both.groupBy("b").agg(F.least("b", F.min("a")).alias("low"))
        large = both.where("a > b").join(lows, "b").select(F.col("low").alias("b"), "a")
        # small star: the smaller neighbours of a node, and the node, move to the smallest of them
        lows = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(lows, "a").where("b <> low").select(F.col("low").alias("b"), F.col("b").alias("a"))
        small = moved.unionByName(lows.select(F.col("low").alias("b"), "a")).where("a <> b").distinct()
        links, path, now = _written(small)
        if last:
            discard(edges.sparkSession, last)
        last = path
        if now == seen:
            break
        seen = now
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(links.select(F.col("a").alias("node"), F.col("b").alias("_low")), "node", "left").select(
        "node", F.coalesce("_low", "node").alias("component"))
