"""All registered queries for the burned-area operators, and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyrocell.plans.views import Views, with_views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of Views under its name, with the SQL of its result (None where SQL can't say it)."""

    def register(f):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = with_views(sql)
        return f

    return register


def _load() -> None:
    from pyrocell.plans import catalog_queries, composite_queries, mask_queries, product_queries, source_queries, stream_queries, zonal_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
