"""Named queries: a DataFrame builder over the domain tables and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.domain import Domain
from .oracle_tables import with_tables

Builder = Callable[[Domain], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build

    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Domain(configure(spark), folder))
