"""Registry of named queries over the driver's test tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs one operator end to end on
whole tables; ``ORACLE[name]`` is the same result written as DuckDB SQL over the
pre-registered table views.  Operators that only exist as ML / iterative code
have no oracle entry.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (each registers itself)."""
    from panelkit.plans import (q_amounts, q_checks, q_evaluate, q_facts, q_features, q_profile, q_relationship,  # noqa: F401
                                q_sources, q_split, q_status, q_verify, q_wide)
