"""How tables are laid out: partition columns and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Id columns that, with a point in time, identify the flat layouts.
_FLAT_IDS = ["materialDemandId", "capacityGroupId"]
_GOLD_PARTITIONS = ["PointInTime", "ChangedAt", "CustomerBPNL"]
MONTH = "pointInTimeMonth"


def default_partitions(columns: list[str], override: list[str] | None = None) -> list[str]:
    """Partition columns of a flat bronze or silver table: its id and the point in time.

    This is one folder per id and day, fit for small tables only; `month_partition` is what the
    stream uses.
    """
    for id_column in _FLAT_IDS:
        if {id_column, "pointInTime"} <= set(columns):
            return list(override) if override is not None else [id_column, "pointInTime"]
    raise ValueError(f"need pointInTime and one of {', '.join(_FLAT_IDS)}; got {', '.join(columns)}")


def detect_partitions(columns: list[str]) -> list[str]:
    """Partition columns a gold table offers, in a fixed order; none if it has no other column."""
    found = [name for name in _GOLD_PARTITIONS if name in columns]
    return [] if len(found) == len(columns) else found


def check_columns(frame: DataFrame, names: list[str]) -> None:
    """Raise if a partition column is missing."""
    missing = [name for name in names if name not in frame.columns]
    if missing:
        raise ValueError(f"partition columns missing from the data: {', '.join(missing)}")


def month_partition(frame: DataFrame, moment: str = "pointInTime") -> DataFrame:
    """Add the month of the point in time, a partition column with few values."""
    return frame.withColumn(MONTH, F.date_format(moment, "yyyy-MM"))


def spread_for_write(frame: DataFrame, partitions: list[str]) -> DataFrame:
    """Bring rows of one partition together without letting a big partition end in one task.

    A rebalance lets adaptive execution split large shuffle partitions and join small ones, where
    a plain repartition by the columns would send a hot value to a single writer.
    """
    return frame.hint("rebalance", *[F.col(name) for name in partitions]) if partitions else frame


def merge_schemas(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Rows of both, over the union of their columns; what a side lacks is NULL."""
    return existing.unionByName(added, allowMissingColumns=True)
