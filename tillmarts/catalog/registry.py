"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


_queries: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function under its own name."""

    def register(run: Run) -> Run:
        if run.__name__ in _queries:
            raise ValueError(f"{run.__name__} is registered twice")
        _queries[run.__name__] = Query(run.__name__, run, sql)
        return run

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)
