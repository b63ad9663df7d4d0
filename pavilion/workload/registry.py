"""Registry of queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession

from pavilion.operators.reshape import flatten_weather
from pavilion.plans import conform, marts, staging
from pavilion.workload import inputs
from pavilion.workload.rules import ROLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_ROWS_PER_TASK = 20_000  # of a table that is dealt out; parsing a page takes up to a millisecond


class Source:
    """The test tables in one folder and the frames derived from them.

    The frames are plans, built once per session; every query computes them anew.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._spread: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    def spread(self, name: str) -> DataFrame:
        """The table dealt out by its first column, since one small file is one task.

        The number of tasks follows the rows. Left to choose, Spark would merge them by the bytes shuffled,
        which are a few per row where documents or pages are made from a key.
        """
        if name not in self._spread:
            table = self[name]
            tasks = max(math.ceil(table.count() / _ROWS_PER_TASK), self.spark.sparkContext.defaultParallelism)
            self._spread[name] = table.repartition(tasks, table.columns[0])
        return self._spread[name]

    @cached_property
    def bat_raw(self) -> DataFrame:
        return inputs.bat_raw(self["customer"], self["nation"], self["orders"])

    @cached_property
    def bowl_raw(self) -> DataFrame:
        return inputs.bowl_raw(self["lineitem"])

    @cached_property
    def matches(self) -> DataFrame:
        return inputs.matches(self["orders"])

    @cached_property
    def balls(self) -> DataFrame:
        return inputs.balls(self["lineitem"])

    @cached_property
    def docs(self) -> DataFrame:
        return inputs.match_docs(self.spread("orders"))

    @cached_property
    def weather_docs(self) -> DataFrame:
        return inputs.weather_docs(self["orders"])

    @cached_property
    def html_pages(self) -> DataFrame:
        return inputs.html_pages(self.spread("pages"))

    @cached_property
    def typed_batting(self) -> DataFrame:
        return conform.type_batting(self.bat_raw)

    @cached_property
    def silver_batting(self) -> DataFrame:
        return conform.conform_batting(self.bat_raw)

    @cached_property
    def silver_bowling(self) -> DataFrame:
        return conform.conform_bowling(self.bowl_raw)

    @cached_property
    def stg_batting(self) -> DataFrame:
        return staging.stg_batting(self.silver_batting)

    @cached_property
    def stg_bowling(self) -> DataFrame:
        return staging.stg_bowling(self.silver_bowling)

    @cached_property
    def dim_player(self) -> DataFrame:
        return marts.dim_player(self.stg_batting, self.stg_bowling, ROLES)

    @cached_property
    def fact_long(self) -> DataFrame:
        return marts.fact_career_stats(self.stg_batting, self.stg_bowling)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stg_weather(flatten_weather(self.weather_docs))

    @cached_property
    def dim_weather(self) -> DataFrame:
        return marts.dim_weather(self.stg_weather)

    @cached_property
    def fact_ball(self) -> DataFrame:
        return marts.fact_ball_by_ball(self.balls, self.matches, self.stg_weather)


@lru_cache(maxsize=8)
def source(spark: SparkSession, folder: str) -> Source:
    return Source(spark, folder)


def query(name: str, sql: str | None = None):
    """Register a function of a ``Source``; ``sql`` is the equivalent query."""

    def register(build: Callable[[Source], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(source(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
