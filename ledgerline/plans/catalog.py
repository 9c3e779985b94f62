"""Registry of named queries: Spark builder + DuckDB oracle text.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame; nothing
is collected.  ``ORACLE[name]`` is the equivalent DuckDB SQL over the driver's
pre-registered views (omitted only for non-SQL operators).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from ledgerline.plans import (  # noqa: F401
        q_loads, q_checks, q_audits, q_review, q_model, q_meta, q_links, q_refresh,
    )
