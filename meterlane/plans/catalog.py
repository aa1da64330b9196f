"""Registry of named queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from meterlane.plans.stand_ins import Data
from meterlane.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = ("cleaning", "functions", "joins", "reports", "windows", "quality", "models",
           "sources", "writes", "streams")


def query(name: str, sql: str | None = None):
    """Register a function from ``Data`` to a DataFrame, with the SQL it must agree with."""
    def register(build: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Data(prepare(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def load_all() -> None:
    for module in MODULES:
        import_module(f"meterlane.plans.q_{module}")
