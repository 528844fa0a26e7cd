"""Outbox: reshape messages for delivery and cut them into chunks. Sending them is not done here."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.contracts import CHUNK_SIZE

# The members a comment is tagged with, in order.
_TAGGED = ["supplier", "author", "commentId", "customer"]

NO_TARGET = "no_target"


def comment_payload(folder_ids: list[str], tenant_id: str) -> Column:
    """The outbound form of a comment row, for one target folder list and tenant."""
    tags = [
        F.struct(
            F.lit("member").alias("Type"), F.lit(name).alias("Name"), F.col(name).alias("Display")
        )
        for name in _TAGGED
    ]
    return F.struct(
        F.array(*[F.lit(folder) for folder in folder_ids]).alias("FolderIds"),
        F.lit(tenant_id).alias("TenantId"),
        F.col("commentType").alias("Title"),
        F.col("commentText").alias("Body"),
        F.array(*tags).alias("Tags"),
    )


def payload_json(payload: Column) -> Column:
    """A payload as JSON text; missing values are written as null."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def iso_text(value: Column, data_type: T.DataType) -> Column:
    """A value with every date and timestamp inside, at any depth, turned into ISO text."""
    if isinstance(data_type, T.DateType):
        return value.cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(F.date_trunc("second", value) == value, whole).otherwise(micros)
    if isinstance(data_type, T.StructType):
        fields = [iso_text(value[field.name], field.dataType).alias(field.name) for field in data_type]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda element: iso_text(element, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(value, lambda _, element: iso_text(element, data_type.valueType))
    return value


def sanitise(frame: DataFrame) -> DataFrame:
    """All dates and timestamps of a frame as ISO text."""
    return frame.select(
        *[iso_text(F.col(field.name), field.dataType).alias(field.name) for field in frame.schema]
    )


# Blocks whose starts one task sums up.
_BLOCKS_PER_GROUP = 10_000


def _starts(sizes: DataFrame, within: list[str], order: str, name: str) -> DataFrame:
    """Add `name`: the sum of the sizes before a row, in the given order inside its group."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    return sizes.withColumn(name, F.coalesce(F.sum("size").over(before), F.lit(0)))


def number_in_topic(payloads: DataFrame, order: list[str], block: Column, source: Column | None = None) -> DataFrame:
    """Number the payloads of each topic from 0 in the given order, without sorting a topic in one task.

    `source`, where given, comes before the order: a file or a partition that payloads came from. `block` must
    be a whole number that never decreases along the order inside a source, and must keep blocks small (say, an
    offset divided by 10,000). Rows are numbered inside their block; a block's start is summed inside its group
    of neighbouring blocks, the group's start over the few groups of a source, and that of a source over the
    sources of a topic.
    """
    blocked = payloads.withColumns({"block": block, "lane": F.lit("") if source is None else source})
    sizes = (
        blocked.groupBy("topic", "lane", "block")
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("group", F.floor(F.col("block") / _BLOCKS_PER_GROUP))
    )
    per_group = sizes.groupBy("topic", "lane", "group").agg(F.sum("size").alias("size"))
    groups = _starts(per_group, ["topic", "lane"], "group", "group_start")
    starts = _starts(sizes, ["topic", "lane", "group"], "block", "block_start").join(
        groups.select("topic", "lane", "group", "group_start"), ["topic", "lane", "group"]
    )
    start = F.col("group_start") + F.col("block_start")
    if source is not None:
        lanes = _starts(per_group.groupBy("topic", "lane").agg(F.sum("size").alias("size")), ["topic"], "lane", "lane_start")
        starts = starts.join(lanes.select("topic", "lane", "lane_start"), ["topic", "lane"])
        start = start + F.col("lane_start")
    starts = starts.select("topic", "lane", "block", start.alias("start"))
    inside = Window.partitionBy("topic", "lane", "block").orderBy(*order)
    return (
        blocked.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["topic", "lane", "block"])
        .withColumn("position", F.col("start") + F.col("place"))
        .drop("block", "lane", "place", "start")
    )


def chunk_payloads(
    payloads: DataFrame, order: list[str], block: Column, chunk_size: int = CHUNK_SIZE, source: Column | None = None
) -> DataFrame:
    """Cut `(topic, payload, ...)` into chunks of `chunk_size` per topic, in order.

    Result: `(topic, chunk_no, payload_count, payload)`, where `payload` is a JSON list, or the
    bare object if the chunk holds one. A topic's chunks are full, but for its last one.
    """
    numbered = number_in_topic(payloads, order, block, source)
    chunks = (
        numbered.withColumn("chunk_no", F.floor(F.col("position") / chunk_size))
        .groupBy("topic", "chunk_no")
        .agg(F.array_sort(F.collect_list(F.struct("position", "payload"))).alias("entries"))
    )
    texts = F.col("entries.payload")
    listed = F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    return chunks.select(
        "topic",
        "chunk_no",
        F.size("entries").cast("bigint").alias("payload_count"),
        F.when(F.size("entries") == 1, F.get(texts, F.lit(0))).otherwise(listed).alias("payload"),
    )


def with_target(chunks: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Add the delivery address configured for each topic; NULL where none is."""
    target = F.lit(None).cast("string")
    for topic, address in targets.items():
        target = F.when(F.col("topic") == topic, address).otherwise(target)
    return chunks.withColumn("target", target)


def deliverable(chunks: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Chunks whose topic has a delivery address, with that address."""
    return with_target(chunks, targets).filter(F.col("target").isNotNull())


def without_target(chunks: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Chunks whose topic has no delivery address, in the quarantine layout."""
    found = with_target(chunks, targets).filter(F.col("target").isNull())
    return found.select("topic", F.col("payload").alias("value"), F.lit(NO_TARGET).alias("reason"))


def payload_counts(payloads: DataFrame) -> DataFrame:
    """Payloads per topic."""
    return payloads.groupBy("topic").agg(F.count(F.lit(1)).alias("payload_count"))
