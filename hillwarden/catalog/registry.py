"""Registry of named queries with their independent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import frame, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


class Inputs:
    """Attribute access to tables and views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = frame(self.spark, self.sf_dir, name)
        return self._cache[name]


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(inputs)``; ``covers`` lists survey ids."""

    def deco(fn):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return deco
