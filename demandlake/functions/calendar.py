"""Dates out of text, and the calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.contracts import DATE_FORMAT

_ISO_DAY = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"
_COMPACT_DAY = r"^\d{8}$"


def contract_date(text: Column) -> Column:
    """A `yyyy-MM-dd` text as a date; anything else is NULL."""
    return F.try_to_date(text, DATE_FORMAT)


def iso_date(text: Column) -> Column:
    """The day of an ISO date or date-time text, blanks around it ignored; anything else is NULL.

    The day is the one written in the text, whatever its offset. The patterns keep out partial
    dates (`2025`), which a cast would accept.
    """
    trimmed = F.trim(text)
    readable = trimmed.rlike(_ISO_DAY) & trimmed.try_cast("timestamp").isNotNull()
    return F.when(readable, trimmed.substr(1, 10).try_cast("date")).when(
        trimmed.rlike(_COMPACT_DAY), F.try_to_date(trimmed, "yyyyMMdd")
    )


def calendar_columns(day: Column) -> list[Column]:
    """The ten attributes of the calendar dimension, weeks and weekdays by ISO 8601."""
    monday_is_zero = F.weekday(day)
    return [
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("DateKey"),
        F.date_format(day, DATE_FORMAT).alias("FullDate"),
        F.dayofmonth(day).cast("bigint").alias("Day"),
        F.month(day).cast("bigint").alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.quarter(day).cast("bigint").alias("Quarter"),
        F.year(day).cast("bigint").alias("Year"),
        (monday_is_zero + 1).cast("bigint").alias("DayOfWeek"),
        F.weekofyear(day).cast("bigint").alias("WeekOfYear"),
        (monday_is_zero >= 5).alias("IsWeekend"),
    ]
