"""All registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandlake.plans import delivery, history, ingest, layers, storage
from demandlake.plans.compare import comparable
from demandlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (ingest, layers, history, storage, delivery)


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(configure(spark), sf_dir))

    return run


def all_queries() -> dict[str, Query]:
    return {name: _prepared(query) for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in module.ORACLES.items()}
