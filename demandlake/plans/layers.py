"""Queries over the bronze, silver and gold transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.contracts import CAPACITY_TOPIC, DEMAND_TOPIC
from demandlake.functions.calendar import contract_date
from demandlake.operators import bronze, gold, silver
from demandlake.plans import sample_messages as sample
from demandlake.plans import sql_parts as sql
from demandlake.session import scratch_path
from demandlake.sources import tables
from demandlake.streaming.medallion import promote_layer


def bronze_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_demand(sample.demand_documents(spark, sf_dir))


def bronze_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_capacity(sample.capacity_documents(spark, sf_dir))


def bronze_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_comment(sample.comment_documents(spark, sf_dir))


def silver_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_demand(bronze_demand(spark, sf_dir))


def silver_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_capacity(bronze_capacity(spark, sf_dir))


def silver_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_comment(bronze_comment(spark, sf_dir))


_THRESHOLD = [
    "capacityGroupId",
    "measurementInterval",
    "startReferenceDateTime",
    "sequenceNumber",
    "subhorizonLength",
    "absoluteNegativeDeviation",
    "relativeNegativeDeviation",
    "absolutePositiveDeviation",
    "relativePositiveDeviation",
]
_SERIES = [
    "capacityGroupId",
    "materialNumberCustomer",
    "materialNumberSupplier",
    "customerLocation",
    "demandCategoryCode",
    "loadFactor",
]
_LISTS = ["capacityGroupId", "linkedCapacityGroups", "supplierLocations"]


def _capacity_columns(names: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bronze_capacity(spark, sf_dir).select(*names, "pointInTime", "agreedCapacity")

    return query


def _capacity_oracle(names: list[str]) -> str:
    columns = ", ".join(f'"{name}"' for name in [*names, "pointInTime", "agreedCapacity"])
    return f"WITH {sql.CAPACITY} SELECT {columns} FROM capacity"


def date_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates out of text, a part of it in other formats or no date at all."""
    lines = sample.table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey") % 5
    text = (
        F.when(key == 0, F.date_format("l_shipdate", "yyyy/MM/dd"))
        .when(key == 1, F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("-13-01")))
        .when(key == 2, F.date_format("l_shipdate", "yyyy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", text.alias("text")).withColumn(
        "day", contract_date(F.col("text"))
    )


def promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store bronze comments and promote them to silver."""
    lake = scratch_path(spark, "promote")
    stored = tables.append_batch(bronze_comment(spark, sf_dir), f"{lake}/bronze", 0)
    return promote_layer(stored, silver.silver_comment, f"{lake}/silver", 0)


def _of_demand(derive):
    return lambda spark, sf_dir: derive(silver_demand(spark, sf_dir))


def _of_capacity(derive):
    return lambda spark, sf_dir: derive(silver_capacity(spark, sf_dir))


def dim_demand_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category comes from an upper-case column where that is filled, else from the other one."""
    rows = silver_demand(spark, sf_dir)
    legacy = F.when(F.col("customerLocation") == "BPNS-O", F.concat(F.lit("L-"), "demandCategoryCode")).otherwise("")
    return gold.dim_demand_category(
        rows.withColumn("legacyCategoryCode", legacy), ("legacyCategoryCode", "demandCategoryCode")
    )


def dim_time_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column without any date gives an empty calendar with the usual columns."""
    return gold.dim_time(silver_comment(spark, sf_dir), "commentText")


def dim_time_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days out of ISO texts in several spellings, blanks around them and unreadable ones among them."""
    lines = sample.table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey") % 6
    text = (
        F.when(key == 0, F.date_format("l_shipdate", "yyyy"))
        .when(key == 1, F.date_format("l_shipdate", "yyyy-MM-dd'T23:30:00-05:00'"))
        .when(key == 2, F.date_format("l_shipdate", "'  'yyyy-MM-dd' '"))
        .when(key == 3, F.date_format("l_shipdate", "yyyyMMdd"))
        .when(key == 4, F.lit("soon"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    return gold.dim_time(lines.select(text.alias("day")), "day")


def stored_silver(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Silver rows written once, so that each gold table scans only the columns it needs."""
    return tables.append_batch(rows, f"{scratch_path(spark, 'gold')}/silver", 0)


def gold_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, silver_demand(spark, sf_dir))
    return gold.row_counts(gold.gold_tables(stored, DEMAND_TOPIC))


def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, silver_capacity(spark, sf_dir))
    return gold.row_counts(gold.gold_tables(stored, CAPACITY_TOPIC))


QUERIES = {
    "bronze_demand": bronze_demand,
    "bronze_capacity": bronze_capacity,
    "capacity_first_threshold": _capacity_columns(_THRESHOLD),
    "capacity_first_series": _capacity_columns(_SERIES),
    "capacity_array_default": _capacity_columns(_LISTS),
    "bronze_comment": bronze_comment,
    "date_cast": date_cast,
    "silver_demand": silver_demand,
    "silver_capacity": silver_capacity,
    "silver_comment": silver_comment,
    "promote_layer": promote,
    "dim_material": _of_demand(gold.dim_material),
    "dim_customer": _of_demand(gold.dim_customer),
    "dim_supplier": _of_demand(gold.dim_supplier),
    "dim_demand_category": dim_demand_category,
    "fact_material_demand": _of_demand(gold.fact_material_demand),
    "dim_time": _of_demand(gold.dim_time),
    "dim_time_from_text": dim_time_from_text,
    "dim_time_empty": dim_time_empty,
    "fact_capacity_group": _of_capacity(gold.fact_capacity_group),
    "capacity_dim_material": _of_capacity(gold.capacity_dim_material),
    "capacity_dim_customer": _of_capacity(gold.dim_customer),
    "capacity_dim_supplier": _of_capacity(gold.dim_supplier),
    "capacity_dim_category": _of_capacity(gold.dim_demand_category),
    "capacity_dim_time": _of_capacity(gold.dim_time),
    "gold_comment": lambda spark, sf_dir: gold.gold_comment(silver_comment(spark, sf_dir)),
    "gold_fanout_counts": gold_fanout_counts,
    "gold_row_counts": gold_row_counts,
}

_CALENDAR = """CAST(strftime(d, '%Y%m%d') AS BIGINT) AS "DateKey", strftime(d, '%Y-%m-%d') AS "FullDate",
    day(d) AS "Day", month(d) AS "Month", monthname(d) AS "MonthName", quarter(d) AS "Quarter", year(d) AS "Year",
    isodow(d) AS "DayOfWeek", weekofyear(d) AS "WeekOfYear", isodow(d) >= 6 AS "IsWeekend" """

_MATERIAL_KEYS = """"MaterialNumberCustomer", "MaterialNumberSupplier" """


def latest_material(source: str, described: bool) -> str:
    """The material dimension of a flat source, by ranking its rows."""
    description, asset = (
        ('"materialDescriptionCustomer"', '"materialGlobalAssetId"')
        if described
        else ("CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)")
    )
    return f"""
    SELECT "materialNumberCustomer" AS "MaterialNumberCustomer", "materialNumberSupplier" AS "MaterialNumberSupplier",
           {description} AS "MaterialDescription", {asset} AS "MaterialGlobalAssetId",
           "unitOfMeasure" AS "UnitOfMeasure", "unitOfMeasureIsOmitted" AS "UnitOfMeasureIsOmitted"
    FROM {source}
    QUALIFY row_number() OVER (
        PARTITION BY "materialNumberCustomer", "materialNumberSupplier"
        ORDER BY "changedAt" DESC, {description} DESC NULLS LAST, {asset} DESC NULLS LAST,
                 "unitOfMeasure" DESC NULLS LAST, "unitOfMeasureIsOmitted" DESC NULLS LAST) = 1"""


_FACT_CAPACITY = """
    SELECT "capacityGroupId" AS "CapacityGroupID", "materialNumberCustomer" AS "MaterialNumberCustomer",
           customer AS "CustomerBPNL", supplier AS "SupplierBPNL", "demandCategoryCode" AS "DemandCategoryCode",
           "pointInTime" AS "PointInTime", "actualCapacity" AS "ActualCapacity", "maximumCapacity" AS "MaxCapacity",
           "agreedCapacity" AS "AgreedCapacity", "deltaProductionResult" AS "DeltaProductionResult",
           "changedAt" AS "ChangedAt", "startReferenceDateTime" AS "StartReferenceDateTime",
           "measurementInterval" AS "MeasurementIntervalWeeks", CAST(NULL AS VARCHAR) AS "ParentCapacityGroupID"
    FROM capacity"""

FACT_DEMAND = """
    SELECT "materialDemandId" AS "DemandID", "materialNumberCustomer" AS "MaterialNumberCustomer",
           customer AS "CustomerBPNL", supplier AS "SupplierBPNL", "demandCategoryCode" AS "DemandCategoryCode",
           "pointInTime" AS "PointInTime", demand AS "DemandQuantity",
           "materialDemandIsInactive" AS "MaterialDemandIsInactive", "changedAt" AS "ChangedAt"
    FROM demand"""


def _distinct(source: str, column: str, name: str) -> str:
    return f"""SELECT DISTINCT {column} AS "{name}" FROM {source} WHERE {column} <> ''"""


def _calendar_of(days: str) -> str:
    return f"SELECT {_CALENDAR} FROM (SELECT DISTINCT CAST(day_text AS DATE) AS d FROM ({days}))"


def _counts(fact: str, source: str, category: str) -> str:
    """Row and column counts of the six gold tables of a flat source."""
    columns = 9 if fact == "FactMaterialDemand" else 14
    return f"""
    SELECT '{fact}' AS table_name, count(*) AS row_count, {columns} AS column_count FROM {source}
    UNION ALL SELECT 'DimCustomer', count(DISTINCT customer), 1 FROM {source}
    UNION ALL SELECT 'DimSupplier', count(DISTINCT supplier), 1 FROM {source}
    UNION ALL SELECT 'DimDemandCategory', count(DISTINCT {category}), 1 FROM {source}
    UNION ALL SELECT 'DimTime', count(DISTINCT "pointInTime"), 10 FROM {source}
    UNION ALL SELECT 'DimMaterial', count(*), 6 FROM (
        SELECT DISTINCT "materialNumberCustomer", "materialNumberSupplier" FROM {source})"""


_DEMAND = f"WITH {sql.DEMAND} "
_CAPACITY = f"WITH {sql.CAPACITY} "
_COMMENTS = f"WITH {sql.COMMENTS} SELECT * EXCLUDE (event_id) FROM comments"

_DATE_TEXT = """CASE l_partkey % 5 WHEN 0 THEN strftime(l_shipdate, '%Y/%m/%d')
    WHEN 1 THEN strftime(l_shipdate, '%Y') || '-13-01' WHEN 2 THEN strftime(l_shipdate, '%Y')
    ELSE strftime(l_shipdate, '%Y-%m-%d') END"""

ORACLES = {
    "bronze_demand": _DEMAND + "SELECT * FROM demand",
    "bronze_capacity": _CAPACITY + "SELECT * FROM capacity",
    "capacity_first_threshold": _capacity_oracle(_THRESHOLD),
    "capacity_first_series": _capacity_oracle(_SERIES),
    "capacity_array_default": _capacity_oracle(_LISTS),
    "bronze_comment": _COMMENTS,
    "date_cast": f"""SELECT l_orderkey, l_partkey, l_suppkey, {_DATE_TEXT} AS text,
        CASE WHEN l_partkey % 5 >= 3 THEN strftime(l_shipdate, '%Y-%m-%d') END AS day FROM lineitem""",
    "silver_demand": _DEMAND + "SELECT * FROM demand",
    "silver_capacity": _CAPACITY + "SELECT * FROM capacity",
    "silver_comment": _COMMENTS,
    "promote_layer": _COMMENTS,
    "dim_material": _DEMAND + latest_material("demand", described=True),
    "dim_customer": _DEMAND + _distinct("demand", "customer", "CustomerBPNL"),
    "dim_supplier": _DEMAND + _distinct("demand", "supplier", "SupplierBPNL"),
    "dim_demand_category": _DEMAND
    + """SELECT DISTINCT CASE WHEN "customerLocation" = 'BPNS-O' THEN 'L-' ELSE '' END || "demandCategoryCode"
         AS "DemandCategoryCode" FROM demand""",
    "fact_material_demand": _DEMAND + FACT_DEMAND,
    "dim_time": _DEMAND + _calendar_of('SELECT "pointInTime" AS day_text FROM demand'),
    "dim_time_from_text": _calendar_of(
        "SELECT strftime(l_shipdate, '%Y-%m-%d') AS day_text FROM lineitem WHERE l_partkey % 6 NOT IN (0, 4)"
    ),
    "dim_time_empty": _calendar_of(
        "SELECT CAST(TRY_CAST(event_type AS DATE) AS VARCHAR) AS day_text FROM events WHERE TRY_CAST(event_type AS DATE) IS NOT NULL"
    ),
    "fact_capacity_group": _CAPACITY + _FACT_CAPACITY,
    "capacity_dim_material": _CAPACITY + latest_material("capacity", described=False),
    "capacity_dim_customer": _CAPACITY + _distinct("capacity", "customer", "CustomerBPNL"),
    "capacity_dim_supplier": _CAPACITY + _distinct("capacity", "supplier", "SupplierBPNL"),
    "capacity_dim_category": _CAPACITY + _distinct("capacity", '"demandCategoryCode"', "DemandCategoryCode"),
    "capacity_dim_time": _CAPACITY + _calendar_of('SELECT "pointInTime" AS day_text FROM capacity'),
    "gold_comment": _COMMENTS,
    "gold_fanout_counts": _DEMAND + _counts("FactMaterialDemand", "demand", '"demandCategoryCode"'),
    "gold_row_counts": _CAPACITY + _counts("FactCapacityGroup", "capacity", '"demandCategoryCode"'),
}
