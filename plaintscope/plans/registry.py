"""Registry of named queries and their independent DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the driver's test
tables; its oracle is a DuckDB statement over the same tables (registered as
views by name). Keys without an oracle are checked on rows only.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_required

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required(spark)  # the caller's session may not be in UTC
            return fn(spark, sf_dir)

        _QUERIES[key] = run
        if oracle is not None:
            _ORACLES[key] = oracle.strip()
        return fn
    return deco


def _load_all() -> None:
    # Importing the plan modules fills the registry.
    from . import volume, cleaning, themes, answers, classifier, brief  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
