"""Queries over the history merge, on two snapshots of the parts table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.operators import gold, scd
from demandlake.plans import layers
from demandlake.plans import sample_messages as sample
from demandlake.plans import sql_parts as sql

FIRST_LOAD = "2024-01-01 00:00:00"
SECOND_LOAD = "2024-02-01 00:00:00"

_SPEC = scd.DimSpec(keys=("part_no",))
_NAME_ONLY = scd.DimSpec(keys=("part_no",), compare=("part_name",))
_KEYS_ONLY = scd.DimSpec(keys=("part_no",), compare=())


def first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts; part 0 has no number, to have a NULL key."""
    return sample.table(spark, sf_dir, "part").select(
        F.nullif("p_partkey", F.lit(0)).alias("part_no"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("bigint").alias("size"),
    )


def second_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later state: by the part's last digit 0 renamed, 1 without brand, 2 resized, 9 gone; every
    fiftieth part has a new sibling with a negative number."""
    parts = sample.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    digit = key % 10
    later = parts.filter(digit != 9).select(
        F.nullif(key, F.lit(0)).alias("part_no"),
        F.when(digit == 0, F.concat("p_name", F.lit(" II"))).otherwise(F.col("p_name")).alias("part_name"),
        F.when(digit != 1, F.col("p_brand")).alias("brand"),
        (F.col("p_size") + F.when(digit == 2, 1).otherwise(0)).cast("bigint").alias("size"),
    )
    added = parts.filter(key % 50 == 0).select(
        (-key - 1).alias("part_no"),
        F.concat(F.lit("new "), "p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("bigint").alias("size"),
    )
    return later.unionByName(added)


def _initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_merge(None, first_snapshot(spark, sf_dir), _SPEC, FIRST_LOAD)


def scd2_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.stamp(first_snapshot(spark, sf_dir), ("part_no", "brand"), FIRST_LOAD)


def scd2_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from before history was kept, one of the four columns present already."""
    legacy = first_snapshot(spark, sf_dir).withColumn("IsCurrent", F.coalesce(F.col("part_no") % 2 == 0, F.lit(True)))
    return scd.backfill(legacy, ("part_no",))


def merged(spark: SparkSession, sf_dir: str, spec: scd.DimSpec = _SPEC) -> DataFrame:
    return scd.scd2_merge(_initial(spark, sf_dir), second_snapshot(spark, sf_dir), spec, SECOND_LOAD)


def scd2_merge_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshot merged twice, the second time later."""
    once = merged(spark, sf_dir)
    return scd.scd2_merge(once, second_snapshot(spark, sf_dir), _SPEC, "2024-03-01 00:00:00")


def scd2_match_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the second snapshot meets the open rows."""
    pairs = scd.match_open(_initial(spark, sf_dir), second_snapshot(spark, sf_dir), _SPEC)
    return pairs.select(
        F.col("open.part_no").alias("open_no"), F.col("incoming.part_no").alias("incoming_no"), "outcome"
    )


def _after_merge(condition: str, spec: scd.DimSpec = _SPEC):
    return lambda spark, sf_dir: merged(spark, sf_dir, spec).filter(condition)


def scd2_null_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose brand went to NULL: both versions."""
    history = merged(spark, sf_dir)
    return history.filter("part_no % 10 = 1 AND part_no > 0")


def scd2_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All registered dimensions: loaded from demand, then merged with what capacity messages say."""
    demand = layers.stored_silver(spark, layers.silver_demand(spark, sf_dir))
    capacity = layers.stored_silver(spark, layers.silver_capacity(spark, sf_dir))
    derive = {
        "DimMaterial": (gold.dim_material, gold.capacity_dim_material),
        "DimCustomer": (gold.dim_customer, gold.dim_customer),
        "DimSupplier": (gold.dim_supplier, gold.dim_supplier),
        "DimDemandCategory": (gold.dim_demand_category, gold.dim_demand_category),
    }
    results = []
    for name, spec in scd.DIM_SPECS.items():
        of_demand, of_capacity = derive[name]
        loaded = scd.scd2_merge(None, of_demand(demand), spec, FIRST_LOAD)
        rows = scd.scd2_merge(loaded, of_capacity(capacity), spec, SECOND_LOAD)
        key = F.concat_ws("/", *[F.coalesce(F.col(column), F.lit("none")) for column in spec.keys])
        results.append(rows.select(F.lit(name).alias("dimension"), key.alias("key"), "ValidFrom", "ValidTo", "IsCurrent"))
    return reduce(DataFrame.unionByName, results)


QUERIES = {
    "scd2_stamp": scd2_stamp,
    "scd2_initial_load": _initial,
    "scd2_backfill": scd2_backfill,
    "scd2_compare_default": _after_merge("true"),
    "scd2_compare_some": _after_merge("true", _NAME_ONLY),
    "scd2_keys_only": _after_merge("true", _KEYS_ONLY),
    "scd2_match_current": scd2_match_current,
    "scd2_null_change": scd2_null_change,
    "scd2_expire": _after_merge("NOT IsCurrent"),
    "scd2_insert": _after_merge(f"ValidFrom = timestamp'{SECOND_LOAD}'"),
    "scd2_keep_absent": _after_merge("part_no % 10 = 9 AND part_no > 0"),
    "scd2_dimensions": scd2_dimensions,
    "scd2_merge": merged,
    "scd2_merge_again": scd2_merge_again,
}

_OPEN_END = scd.OPEN_END


def _key(text: str, moment: str) -> str:
    return f"CAST('0x' || substr(md5({text} || '|{moment}'), 1, 15) AS BIGINT)"


_PART_NO = "coalesce(CAST(part_no AS VARCHAR), '~')"
_ATTRIBUTES = "part_no, part_name, brand, size"

_SNAPSHOTS = """
snapshot_1 AS (
    SELECT p_partkey AS k, nullif(p_partkey, 0) AS part_no, p_name AS part_name, p_brand AS brand,
           CAST(p_size AS BIGINT) AS size
    FROM part
),
snapshot_2 AS (
    SELECT k, part_no, CASE WHEN k % 10 = 0 THEN part_name || ' II' ELSE part_name END AS part_name,
           CASE WHEN k % 10 <> 1 THEN brand END AS brand, CASE WHEN k % 10 = 2 THEN size + 1 ELSE size END AS size
    FROM snapshot_1 WHERE k % 10 <> 9
    UNION ALL
    SELECT NULL, -k - 1, 'new ' || part_name, brand, size FROM snapshot_1 WHERE k % 50 = 0
)"""


def _history(changed: str) -> str:
    """The merged dimension, given which parts count as changed."""
    old = f"""{_ATTRIBUTES}, {_key(_PART_NO, FIRST_LOAD)} AS "SurrogateKey", '{FIRST_LOAD}' AS "ValidFrom" """
    new = f"""{_ATTRIBUTES}, {_key(_PART_NO, SECOND_LOAD)} AS "SurrogateKey", '{SECOND_LOAD}' AS "ValidFrom" """
    return f"""WITH {_SNAPSHOTS},
    history AS (
        SELECT {old}, CASE WHEN {changed} THEN '{SECOND_LOAD}' ELSE '{_OPEN_END}' END AS "ValidTo",
               NOT ({changed}) AS "IsCurrent" FROM snapshot_1
        UNION ALL
        SELECT {new}, '{_OPEN_END}', true FROM snapshot_2 WHERE k IS NULL OR ({changed})
    )"""


_ALL_CHANGES = "k % 10 IN (0, 1, 2)"
_HISTORY = _history(_ALL_CHANGES)

_DIMENSIONS = f"""WITH {sql.DEMAND}, {sql.CAPACITY},
keys_of(dimension, key, source) AS (
    SELECT DISTINCT 'DimCustomer', customer, 1 FROM demand UNION ALL SELECT DISTINCT 'DimCustomer', customer, 2 FROM capacity
    UNION ALL SELECT DISTINCT 'DimSupplier', supplier, 1 FROM demand UNION ALL SELECT DISTINCT 'DimSupplier', supplier, 2 FROM capacity
    UNION ALL SELECT DISTINCT 'DimDemandCategory', "demandCategoryCode", 1 FROM demand
    UNION ALL SELECT DISTINCT 'DimDemandCategory', "demandCategoryCode", 2 FROM capacity
),
old_material AS ({layers.latest_material("demand", described=True)}),
new_material AS ({layers.latest_material("capacity", described=False)}),
materials AS (
    SELECT coalesce(o."MaterialNumberCustomer", n."MaterialNumberCustomer") || '/'
           || coalesce(o."MaterialNumberSupplier", n."MaterialNumberSupplier", 'none') AS key,
           o."MaterialNumberCustomer" IS NOT NULL AS is_old, n."MaterialNumberCustomer" IS NOT NULL AS is_new,
           o."MaterialDescription" IS DISTINCT FROM n."MaterialDescription"
           OR o."MaterialGlobalAssetId" IS DISTINCT FROM n."MaterialGlobalAssetId"
           OR o."UnitOfMeasure" IS DISTINCT FROM n."UnitOfMeasure"
           OR o."UnitOfMeasureIsOmitted" IS DISTINCT FROM n."UnitOfMeasureIsOmitted" AS differs
    FROM old_material o FULL OUTER JOIN new_material n
      ON o."MaterialNumberCustomer" = n."MaterialNumberCustomer"
     AND o."MaterialNumberSupplier" IS NOT DISTINCT FROM n."MaterialNumberSupplier"
)
SELECT dimension, key, CASE WHEN min(source) = 1 THEN '{FIRST_LOAD}' ELSE '{SECOND_LOAD}' END AS "ValidFrom",
       '{_OPEN_END}' AS "ValidTo", true AS "IsCurrent"
FROM keys_of GROUP BY dimension, key
UNION ALL
SELECT 'DimMaterial', key, '{FIRST_LOAD}', CASE WHEN is_new AND differs THEN '{SECOND_LOAD}' ELSE '{_OPEN_END}' END,
       NOT (is_new AND differs)
FROM materials WHERE is_old
UNION ALL
SELECT 'DimMaterial', key, '{SECOND_LOAD}', '{_OPEN_END}', true
FROM materials WHERE is_new AND (NOT is_old OR differs)"""

ORACLES = {
    "scd2_stamp": f"""WITH {_SNAPSHOTS}
        SELECT {_ATTRIBUTES}, {_key(_PART_NO + " || '|' || brand", FIRST_LOAD)} AS "SurrogateKey",
               '{FIRST_LOAD}' AS "ValidFrom", '{_OPEN_END}' AS "ValidTo", true AS "IsCurrent" FROM snapshot_1""",
    "scd2_initial_load": f"""WITH {_SNAPSHOTS}
        SELECT {_ATTRIBUTES}, {_key(_PART_NO, FIRST_LOAD)} AS "SurrogateKey",
               '{FIRST_LOAD}' AS "ValidFrom", '{_OPEN_END}' AS "ValidTo", true AS "IsCurrent" FROM snapshot_1""",
    "scd2_backfill": f"""WITH {_SNAPSHOTS}
        SELECT {_ATTRIBUTES}, {_key(_PART_NO, scd.LEGACY_START)} AS "SurrogateKey",
               '{scd.LEGACY_START}' AS "ValidFrom", '{_OPEN_END}' AS "ValidTo", k % 2 = 0 AS "IsCurrent" FROM snapshot_1""",
    "scd2_compare_default": _HISTORY + "SELECT * FROM history",
    "scd2_compare_some": _history("k % 10 = 0") + "SELECT * FROM history",
    "scd2_keys_only": _history("k < 0") + "SELECT * FROM history",
    "scd2_match_current": f"""WITH {_SNAPSHOTS}
        SELECT part_no AS open_no, CASE WHEN k % 10 <> 9 THEN part_no END AS incoming_no,
               CASE WHEN k % 10 = 9 THEN 'absent' WHEN {_ALL_CHANGES} THEN 'changed' ELSE 'unchanged' END AS outcome
        FROM snapshot_1
        UNION ALL SELECT NULL, part_no, 'new' FROM snapshot_2 WHERE k IS NULL""",
    "scd2_null_change": _HISTORY + "SELECT * FROM history WHERE part_no % 10 = 1 AND part_no > 0",
    "scd2_expire": _HISTORY + """SELECT * FROM history WHERE NOT "IsCurrent" """,
    "scd2_insert": _HISTORY + f"""SELECT * FROM history WHERE "ValidFrom" = '{SECOND_LOAD}'""",
    "scd2_keep_absent": _HISTORY + "SELECT * FROM history WHERE part_no % 10 = 9 AND part_no > 0",
    "scd2_dimensions": _DIMENSIONS,
    "scd2_merge": _HISTORY + "SELECT * FROM history",
    "scd2_merge_again": _HISTORY + "SELECT * FROM history",
}
