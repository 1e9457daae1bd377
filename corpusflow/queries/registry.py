"""Registry of named queries: a Spark callable and, when SQL can state it, a DuckDB oracle.

Each query takes ``(spark, sf_dir)`` and reads the fixture tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    group: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, group: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under an operator name of SURVEY section 2."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, group, fn, sql.strip() if sql else None)
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    """Import every query module so that its decorators run."""
    import importlib
    import pkgutil

    import corpusflow.queries as pkg

    for mod in pkgutil.iter_modules(pkg.__path__):
        if mod.name.startswith("q_"):
            importlib.import_module(f"corpusflow.queries.{mod.name}")
    return REGISTRY
