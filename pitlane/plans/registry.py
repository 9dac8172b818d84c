"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitlane.sources.fixtures import Tables, duckdb_with

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register `fn(T) -> DataFrame` (T = the fixture/table accessor) as query `name`."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the operators' date/time semantics are written against UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn

    return deco


def all_queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: duckdb_with(v[1]) for k, v in REGISTRY.items() if v[1]}


def _load():
    # importing the plan modules fills REGISTRY
    from pitlane.plans import catalog  # noqa: F401
