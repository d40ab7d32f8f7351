"""Query registry: every operator check is a (Spark plan, DuckDB oracle) pair.

``@query(name, oracle=..., views=...)`` registers a function ``(spark, sf_dir) ->
DataFrame``; the oracle body is wrapped with the derived views it names as CTEs,
so DuckDB, which only has the driver tables, can run it unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regesto.sources.fixtures import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
OPS: dict[str, str] = {}


def query(name: str, oracle: str | None = None, views=(), ops: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPS[name] = ops
        if oracle is not None:
            ORACLES[name] = with_views(views, oracle.strip())
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from regesto.plans import q_scalars, q_html, q_ops, q_regions, q_sources, q_walks  # noqa: F401
