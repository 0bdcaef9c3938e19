"""Registry of named queries and their DuckDB oracle SQL.

Each entry is ``key -> (fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
``None`` marks operators with no exact SQL twin (streams, file sinks); those
are checked by pytest against brute force on small fixtures instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills REGISTRY
    import importlib

    from . import summary_queries  # noqa: F401

    for mod in ("clean_queries", "validate_queries", "entity_queries", "store_queries", "derive_queries",
                "metric_queries", "source_queries", "stream_queries", "conversion"):
        importlib.import_module(f"{__package__}.{mod}")


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
