"""Bronze: nested messages to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC, CONTRACTS, DEMAND_TOPIC
from demandlake.functions.calendar import contract_date

def _plain_fields(topic: str) -> list[str]:
    """The fields of a topic's contract that hold one value, in its order."""
    return [rule.name for rule in CONTRACTS[topic] if rule.kind in ("string", "boolean", "number")]


_DEMAND_HEADER = _plain_fields(DEMAND_TOPIC)
_CAPACITY_HEADER = _plain_fields(CAPACITY_TOPIC)

_THRESHOLD_FIELDS = [
    "sequenceNumber",
    "subhorizonLength",
    "absoluteNegativeDeviation",
    "relativeNegativeDeviation",
    "absolutePositiveDeviation",
    "relativePositiveDeviation",
]


def bronze_demand(messages: DataFrame) -> DataFrame:
    """One row per demand entry: message header x series x demands.

    A message without series, or a series without demands, has no demand and yields no row.
    """
    entries = (
        messages.select(*_DEMAND_HEADER, F.explode("demandSeries").alias("series"))
        .select(
            *_DEMAND_HEADER,
            F.col("series.demandCategory.demandCategoryCode").alias("demandCategoryCode"),
            F.col("series.customerLocation").alias("customerLocation"),
            F.col("series.expectedSupplierLocation").alias("expectedSupplierLocation"),
            F.explode("series.demands").alias("entry"),
        )
    )
    return entries.select(
        *_DEMAND_HEADER,
        "demandCategoryCode",
        "customerLocation",
        "expectedSupplierLocation",
        F.col("entry.demand").alias("demand"),
        contract_date(F.col("entry.pointInTime")).alias("pointInTime"),
    )


def _array_or_empty(name: str):
    return F.coalesce(F.col(name), F.array().cast("array<string>")).alias(name)


def bronze_capacity(messages: DataFrame) -> DataFrame:
    """One row per capacity entry, with the first alert threshold and the first linked series.

    Missing parts are NULL, missing location and group lists are empty; a message without
    capacities yields no row.
    """
    volatility = F.col("demandVolatilityParameters")
    threshold = F.get(volatility["rollingHorizonAlertThresholds"], F.lit(0))
    series = F.get(F.col("linkedDemandSeries"), F.lit(0))
    entries = messages.select(
        *_CAPACITY_HEADER,
        _array_or_empty("linkedCapacityGroups"),
        _array_or_empty("supplierLocations"),
        volatility["measurementInterval"].alias("measurementInterval"),
        volatility["startReferenceDateTime"].alias("startReferenceDateTime"),
        *[threshold[name].alias(name) for name in _THRESHOLD_FIELDS],
        series["materialNumberCustomer"].alias("materialNumberCustomer"),
        series["materialNumberSupplier"].alias("materialNumberSupplier"),
        series["customerLocation"].alias("customerLocation"),
        series["demandCategory"]["demandCategoryCode"].alias("demandCategoryCode"),
        series["loadFactor"].alias("loadFactor"),
        F.explode("capacities").alias("entry"),
    )
    return entries.select(
        *[name for name in entries.columns if name != "entry"],
        contract_date(F.col("entry.pointInTime")).alias("pointInTime"),
        F.col("entry.agreedCapacity").alias("agreedCapacity"),
        F.col("entry.actualCapacity").alias("actualCapacity"),
        F.col("entry.maximumCapacity").alias("maximumCapacity"),
        F.col("entry.deltaProductionResult").alias("deltaProductionResult"),
    )


def bronze_comment(messages: DataFrame) -> DataFrame:
    """Comments are flat already; only the contract's columns are kept."""
    return messages.select(*[rule.name for rule in CONTRACTS[COMMENTS_TOPIC]])


BRONZE = {
    DEMAND_TOPIC: bronze_demand,
    CAPACITY_TOPIC: bronze_capacity,
    COMMENTS_TOPIC: bronze_comment,
}
