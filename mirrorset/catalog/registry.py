"""Queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFunction, str | None]] = {}


def query(sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under its own name together with the equivalent SQL."""

    def keep(function: QueryFunction) -> QueryFunction:
        REGISTRY[function.__name__] = (function, sql)
        return function

    return keep
