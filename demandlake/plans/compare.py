"""Results in types that look the same in every SQL engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(frame: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, all whole numbers as BIGINT."""
    columns = []
    for field in frame.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
            value = F.to_json(value)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        columns.append(value.alias(field.name))
    return frame.select(*columns)
