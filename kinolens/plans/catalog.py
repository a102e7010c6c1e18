"""Registry of queries: a Spark callable and, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with its SQL text."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return add


def load() -> None:
    """Import every module that registers queries."""
    from kinolens.plans import (  # noqa: F401
        q_aggregate,
        q_columns,
        q_evaluate,
        q_extract,
        q_model,
        q_relate,
        q_source,
        q_stream,
        q_text,
        q_vector,
    )
