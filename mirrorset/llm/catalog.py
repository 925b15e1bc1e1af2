"""Queries of the language-model operators: name, function and, where it exists, SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LlmQuery = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[LlmQuery, str | None]] = {}


def query(sql: str | None = None) -> Callable[[LlmQuery], LlmQuery]:
    def keep(function: LlmQuery) -> LlmQuery:
        REGISTRY[function.__name__] = (function, sql)
        return function

    return keep
