"""Registration of queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaspan.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Lazy access to the Parquet tables of one scale factor: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register ``f(tables)`` under its own name, with its SQL if it has one."""

    def register(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = lambda spark, folder: f(Tables(prepare(spark), folder))
        if sql is not None:
            SQL[key] = sql
        return f

    return register


def r6(*names: str) -> list[Column]:
    """Columns rounded to 6 places, for comparison."""
    return [F.round(F.col(n), 6).alias(n) for n in names]


def rounded(df: DataFrame) -> DataFrame:
    """All doubles rounded to 6 places."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c, t in df.dtypes if t == "double"})


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})
