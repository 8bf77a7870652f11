"""All queries of the engine outside the text subpackage, by name, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "suite_metrics"


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name; ``sql`` says the same in DuckDB, where SQL can."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def with_(cte: str, rest: str) -> str:
    """A statement from common table expressions and what follows them."""
    return f"with {cte.strip()}\n{rest.strip()}"


from runloom.plans import comparison, dataset, evaluation, gates, governance, review, selection, streams, structure, traces  # noqa: E402, F401
