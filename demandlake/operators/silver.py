"""Silver: the layer where cleaning rules belong. The model has none yet, so rows pass unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC, DEMAND_TOPIC


def silver_demand(bronze: DataFrame) -> DataFrame:
    return bronze


def silver_capacity(bronze: DataFrame) -> DataFrame:
    return bronze


def silver_comment(bronze: DataFrame) -> DataFrame:
    return bronze


SILVER = {
    DEMAND_TOPIC: silver_demand,
    CAPACITY_TOPIC: silver_capacity,
    COMMENTS_TOPIC: silver_comment,
}
