"""Registry of named queries: a Spark builder and, where SQL can state it, an
equivalent DuckDB text used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from . import q_clean, q_reconcile, q_verify, q_grid, q_polygon, q_funnel, q_io, q_scalar  # noqa: F401
