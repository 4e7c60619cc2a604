"""Registry of the named queries over the given tables and of their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, data_dir) -> DataFrame`` under ``name``; ``sql`` is the
    DuckDB statement over the same tables that must give the same rows."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # Importing the plan modules fills the registry.
    from clipforge.plans import (  # noqa: F401
        classify,
        entities,
        filters,
        keywords,
        outputs,
        parsing,
        published,
        reports,
        units,
    )
