"""Outbox stream: comments reshaped and chunked for delivery by another service.

What cannot be delivered is put aside: unreadable comments, and messages of other topics.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandlake.contracts import COMMENTS_TOPIC, TOPICS
from demandlake.operators import messages as msg
from demandlake.operators import outbox
from demandlake.sources import tables, topics
from demandlake.sources.files import delete_folder
from demandlake.sources.tables import Origin
from demandlake.streaming.medallion import QUARANTINE, STAGED, origin_of, run_together

# Rows numbered by one task; positions are unique in a source, so a block can hold no more.
_BLOCK_ROWS = 10_000
NOT_FORWARDED = "not_forwarded"


def quarantine_path(location: str) -> str:
    """Where the stream puts aside what it cannot deliver, beside the outbox."""
    return f"{location}-{QUARANTINE}"


def placed(batch: DataFrame) -> DataFrame:
    """Messages as `(topic, value, source, offset)`, by the position they have at their source."""
    if "position" in batch.columns:
        position = F.col("position")
    elif {"partition", "offset"} <= set(batch.columns):
        position = topics.broker_position()
    else:
        raise ValueError("the outbox needs the position of each message; see topic_stream(positions=True)")
    named = batch.select("topic", F.col("value").cast("string").alias("value"), position.alias("position"))
    return named.select("topic", "value", "position.source", "position.offset")


def judged(messages: DataFrame, folder_ids: list[str], tenant_id: str) -> DataFrame:
    """Each message with the payload it becomes, or the reason why it becomes none; each is parsed once."""
    is_comment = F.coalesce(F.col("topic") == COMMENTS_TOPIC, F.lit(False))
    parsed = messages.select("*", F.explode_outer(F.when(is_comment, msg.documents(COMMENTS_TOPIC))).alias("document"))
    rows = parsed.select("topic", "value", "source", "offset", F.col("document").isNotNull().alias("readable"), "document.*")
    known = F.coalesce(F.col("topic").isin(*TOPICS), F.lit(False))
    reason = (
        F.when(~known, msg.UNKNOWN_TOPIC)
        .when(~is_comment, NOT_FORWARDED)
        .when(~F.col("readable"), msg.unreadable_reason(F.col("value")))
    )
    payload = outbox.payload_json(outbox.comment_payload(folder_ids, tenant_id))
    return rows.select(
        "topic",
        "source",
        "offset",
        F.when(F.col("readable"), payload).alias("payload"),
        F.when(~F.col("readable"), F.col("value")).alias("value"),
        reason.alias("reason"),
    )


def outbox_batch(
    batch: DataFrame, batch_id: int | Origin, location: str, folder_ids: list[str], tenant_id: str, targets: Mapping[str, str]
) -> None:
    """Write the chunks of one micro-batch to the outbox table, in the order of the source, and the rest to the quarantine.

    The batch is read and parsed in one pass, whose outcome is stored until both are written. The order hangs on
    positions at the source alone, so a batch tried again, or on other partitions, gives the same chunks.
    """
    spark = batch.sparkSession
    staged = f"{location}-{STAGED}/{batch_id}"
    try:
        rows = judged(placed(batch), folder_ids, tenant_id)
        rows.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        payloads = rows.filter("reason IS NULL").select("topic", "source", "offset", "payload")
        block = F.expr(f"offset div {_BLOCK_ROWS}")
        chunks = outbox.chunk_payloads(payloads, ["offset"], block, source=F.col("source"))
        aside = rows.filter("reason IS NOT NULL").select("topic", "value", "reason")
        run_together(
            spark,
            [
                lambda: tables.append_batch(outbox.deliverable(chunks, targets), location, batch_id),
                lambda: tables.append_batch(aside, quarantine_path(location), batch_id),
            ],
        )
    finally:
        delete_folder(spark, staged)


def start_forwarder(
    source: DataFrame,
    location: str,
    checkpoint: str,
    folder_ids: list[str],
    tenant_id: str,
    targets: Mapping[str, str],
    available_now: bool = True,
) -> StreamingQuery:
    """Start the outbox stream; folders, tenant and targets come from the deployment.

    The source tells the position of each message: `topic_stream(..., positions=True)`, or a broker's stream.
    """
    if COMMENTS_TOPIC not in targets:
        raise ValueError(f"no delivery target configured for {COMMENTS_TOPIC}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        outbox_batch(batch, origin_of(batch, batch_id), location, folder_ids, tenant_id, targets)

    writer = source.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
