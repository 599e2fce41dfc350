"""Registry of named queries: Spark builder + equivalent DuckDB SQL.

Every registered builder takes ``(spark, sf_dir)`` and returns a DataFrame over
the driver's tables.  The SQL (when the operator is SQL-expressible) runs on
DuckDB with the base tables registered as views; the ``sales`` and
``pred_vs_real`` views are prefixed automatically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storecast.sources.tables import with_views

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``key`` with its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_views(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from storecast.plans import (  # noqa: F401
        evaluation_q, features_q, forecast_q, models_q, quality_q, reports_q, runs_q,
        sources_q, store_forest_q, recursive_q,
        storage_q)
