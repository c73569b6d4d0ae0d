"""Registry of runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.sources.model import MODEL_SQL, Model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``build(model)``; ``sql`` continues the model's common table expressions."""

    def register(build: Callable[[Model], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Model(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = MODEL_SQL + sql
        return build

    return register
