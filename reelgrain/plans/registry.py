"""Query registration and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read as needed: `t.events`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    """Register a query, with its SQL where one can be written."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def cents(column: str):
    """Amounts as whole hundredths, so that sums do not depend on the order of addition."""
    return F.round(F.col(column) * 100).cast("long")


def us(column: str):
    """Epoch microseconds of a timestamp column."""
    return F.unix_micros(F.col(column).cast("timestamp"))
