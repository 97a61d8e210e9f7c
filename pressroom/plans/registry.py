"""Registry of checked queries: a Spark builder and (optionally) the DuckDB
SQL that computes the same answer from the raw driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: QueryFn
    oracle: str | None
    ids: str  # survey inventory ids covered


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, ids)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from pressroom.plans import (q_enrich, q_extract, q_score, q_serve,  # noqa: F401
                                 q_stream, q_text, q_update)
    return REGISTRY
