"""Registered queries: name -> (Spark callable (spark, sf_dir) -> DataFrame, DuckDB SQL).

Every query reads the provided tables (through ``sources.driver``) and runs over whole
tables. Ids, counts and sizes are BIGINT, ratios DOUBLE rounded to 6 digits, id sets
sorted comma-joined text, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


MODULES = ("q_sessions", "q_split", "q_labels", "q_eval", "q_catalog", "q_profile", "q_io")


def _load():
    # Importing the modules fills REGISTRY.
    import importlib
    for mod in MODULES:
        importlib.import_module(f"{__package__}.{mod}")


def queries() -> dict[str, QueryFn]:
    if not REGISTRY:
        _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    if not REGISTRY:
        _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
