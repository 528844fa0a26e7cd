"""Gold: a star schema out of silver rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC, DEMAND_TOPIC
from demandlake.functions.calendar import calendar_columns, iso_date

_MATERIAL_KEYS = ["MaterialNumberCustomer", "MaterialNumberSupplier"]
_MATERIAL_ATTRIBUTES = [
    "MaterialDescription",
    "MaterialGlobalAssetId",
    "UnitOfMeasure",
    "UnitOfMeasureIsOmitted",
]


def _latest_per_material(rows: DataFrame) -> DataFrame:
    """One row per material: the latest change, ties settled by the attribute values.

    The first grouping is combined by hash on the map side and leaves one row per distinct
    description of a material, however many rows name it; only those few are compared as structs,
    which takes a sort.
    """
    described = rows.groupBy(*_MATERIAL_KEYS, *_MATERIAL_ATTRIBUTES).agg(F.max("changed").alias("changed"))
    newest = F.max(F.struct("changed", *_MATERIAL_ATTRIBUTES)).alias("newest")
    return (
        described.groupBy(*_MATERIAL_KEYS)
        .agg(newest)
        .select(*_MATERIAL_KEYS, *[F.col(f"newest.{name}").alias(name) for name in _MATERIAL_ATTRIBUTES])
    )


def dim_material(silver: DataFrame) -> DataFrame:
    """Materials named by demand rows."""
    return _latest_per_material(
        silver.select(
            F.col("materialNumberCustomer").alias("MaterialNumberCustomer"),
            F.col("materialNumberSupplier").alias("MaterialNumberSupplier"),
            F.col("materialDescriptionCustomer").alias("MaterialDescription"),
            F.col("materialGlobalAssetId").alias("MaterialGlobalAssetId"),
            F.col("unitOfMeasure").alias("UnitOfMeasure"),
            F.col("unitOfMeasureIsOmitted").alias("UnitOfMeasureIsOmitted"),
            F.try_to_timestamp("changedAt").alias("changed"),
        )
    )


def capacity_dim_material(silver: DataFrame) -> DataFrame:
    """Materials named by capacity rows, which carry no description and no asset id."""
    return _latest_per_material(
        silver.select(
            F.col("materialNumberCustomer").alias("MaterialNumberCustomer"),
            F.col("materialNumberSupplier").alias("MaterialNumberSupplier"),
            F.lit(None).cast("string").alias("MaterialDescription"),
            F.lit(None).cast("string").alias("MaterialGlobalAssetId"),
            F.col("unitOfMeasure").alias("UnitOfMeasure"),
            F.col("unitOfMeasureIsOmitted").alias("UnitOfMeasureIsOmitted"),
            F.try_to_timestamp("changedAt").alias("changed"),
        )
    )


def _distinct_values(value: Column, name: str, silver: DataFrame) -> DataFrame:
    """The distinct non-empty values of one column."""
    values = silver.select(value.alias(name))
    return values.filter(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def dim_customer(silver: DataFrame) -> DataFrame:
    return _distinct_values(F.col("customer"), "CustomerBPNL", silver)


def dim_supplier(silver: DataFrame) -> DataFrame:
    return _distinct_values(F.col("supplier"), "SupplierBPNL", silver)


def category_code(spellings: tuple[str, ...]) -> Column:
    """The category code out of the first column that holds one; an empty text counts as missing."""
    return F.coalesce(*[F.nullif(F.col(name), F.lit("")) for name in spellings])


def dim_demand_category(
    silver: DataFrame, spellings: tuple[str, ...] = ("demandCategoryCode",)
) -> DataFrame:
    return _distinct_values(category_code(spellings), "DemandCategoryCode", silver)


def dim_time(silver: DataFrame, column: str = "pointInTime") -> DataFrame:
    """The calendar of all days occurring in a date, timestamp or ISO text column.

    Days that cannot be read are skipped; with no readable day the result is empty.
    """
    source = F.col(column)
    if isinstance(silver.schema[column].dataType, T.StringType):
        day = iso_date(source)
    else:
        day = source.cast("date")
    days = silver.select(day.alias("day")).filter(F.col("day").isNotNull()).distinct()
    return days.select(*calendar_columns(F.col("day")))


def fact_material_demand(
    silver: DataFrame, spellings: tuple[str, ...] = ("demandCategoryCode",)
) -> DataFrame:
    """Demand facts, one per silver row."""
    return silver.select(
        F.col("materialDemandId").alias("DemandID"),
        F.col("materialNumberCustomer").alias("MaterialNumberCustomer"),
        F.col("customer").alias("CustomerBPNL"),
        F.col("supplier").alias("SupplierBPNL"),
        category_code(spellings).alias("DemandCategoryCode"),
        F.col("pointInTime").cast("date").alias("PointInTime"),
        F.col("demand").alias("DemandQuantity"),
        F.col("materialDemandIsInactive").alias("MaterialDemandIsInactive"),
        F.col("changedAt").alias("ChangedAt"),
    )


def fact_capacity_group(silver: DataFrame) -> DataFrame:
    """Capacity facts, one per silver row; messages name no parent group."""
    return silver.select(
        F.col("capacityGroupId").alias("CapacityGroupID"),
        F.col("materialNumberCustomer").alias("MaterialNumberCustomer"),
        F.col("customer").alias("CustomerBPNL"),
        F.col("supplier").alias("SupplierBPNL"),
        F.col("demandCategoryCode").alias("DemandCategoryCode"),
        F.col("pointInTime").cast("date").alias("PointInTime"),
        F.col("actualCapacity").alias("ActualCapacity"),
        F.col("maximumCapacity").alias("MaxCapacity"),
        F.col("agreedCapacity").alias("AgreedCapacity"),
        F.col("deltaProductionResult").alias("DeltaProductionResult"),
        F.col("changedAt").alias("ChangedAt"),
        F.col("startReferenceDateTime").alias("StartReferenceDateTime"),
        F.col("measurementInterval").alias("MeasurementIntervalWeeks"),
        F.lit(None).cast("string").alias("ParentCapacityGroupID"),
    )


def gold_comment(silver: DataFrame) -> DataFrame:
    return silver


GoldTables = dict[str, Callable[[DataFrame], DataFrame]]

# Topic -> gold table -> how to derive it from silver.
GOLD: dict[str, GoldTables] = {
    DEMAND_TOPIC: {
        "DimMaterial": dim_material,
        "DimCustomer": dim_customer,
        "DimSupplier": dim_supplier,
        "DimDemandCategory": dim_demand_category,
        "FactMaterialDemand": fact_material_demand,
        "DimTime": dim_time,
    },
    CAPACITY_TOPIC: {
        "FactCapacityGroup": fact_capacity_group,
        "DimCustomer": dim_customer,
        "DimSupplier": dim_supplier,
        "DimDemandCategory": dim_demand_category,
        "DimMaterial": capacity_dim_material,
        "DimTime": dim_time,
    },
    COMMENTS_TOPIC: {"Comments": gold_comment},
}


def gold_tables(silver: DataFrame, topic: str) -> dict[str, DataFrame]:
    """All gold tables of a topic, by name."""
    return {name: derive(silver) for name, derive in GOLD[topic].items()}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name, row count and column count, in a single job."""
    counted = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(table.columns)).cast("bigint").alias("column_count"),
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
