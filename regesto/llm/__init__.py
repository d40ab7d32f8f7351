"""Operators of a training-data pipeline: one module per operator, its query beside it.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries
when it can be imported.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# executors need no copy of this package: what a task uses of it travels with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under ``name``, with its DuckDB SQL if there is one."""

    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    from regesto.llm import chat, collocations, decontaminate, near_dedup, ngram_join, packing, quality_model, quality_rules, spelling, substring_dedup, token_counts, token_files, toxicity  # noqa: F401
