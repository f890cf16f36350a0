"""Registry of named queries and their DuckDB oracle SQL.

``register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame``
under ``name``; ``sql`` (optional) is the equivalent query DuckDB runs on the
same parquet tables, with the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark, sf_dir):
            from ..session import apply_recommended

            apply_recommended(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c, digits: int = 6) -> Column:
    """Round a double for comparison; ``+ 0.0`` turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def load_all():
    """Import every query module so that the registry is filled."""
    from . import text_queries, graph_queries, linear_queries  # noqa: F401
    from . import sparse_queries, logistic_queries, factor_queries, format_queries  # noqa: F401
    return QUERIES, ORACLES
