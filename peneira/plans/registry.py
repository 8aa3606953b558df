"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    operator: str  # id in the operator inventory
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(operator: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name, with the SQL it must agree with."""

    def add(run: Run) -> Run:
        if run.__name__ in REGISTRY:
            raise ValueError(f"{run.__name__} is registered twice")
        REGISTRY[run.__name__] = Query(run.__name__, operator, run, sql)
        return run

    return add


def load_all() -> dict[str, Query]:
    from peneira.plans import (  # noqa: F401
        aggregate_queries,
        combine_queries,
        filter_queries,
        function_queries,
        job_queries,
        null_queries,
        profile_queries,
        projection_queries,
        python_queries,
        sink_queries,
        source_queries,
    )

    return REGISTRY
