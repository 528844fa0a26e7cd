"""Ingest stream: requests through validation to the topics, and reports of what was decided."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from demandlake.operators import validation as val
from demandlake.sources import tables, topics
from demandlake.sources.files import delete_folder
from demandlake.sources.tables import Origin
from demandlake.streaming.medallion import STAGED, origin_of, run_together

ERRORS = "errors"
DISPOSITIONS = "dispositions"


def ingest_batch(requests: DataFrame, batch_id: int | Origin, landing: str, reports: str) -> None:
    """Land the items of accepted requests, and store the violations and the status of every request.

    Requests are checked in one pass, whose outcome is stored; all three outputs are read from it. Each is
    replaced or left alone when the batch is tried again, so no request counts twice.
    """
    spark = requests.sparkSession
    staged = f"{reports}/{STAGED}/{batch_id}"
    try:
        checked = val.checked_requests(requests)
        checked.write.mode("overwrite").parquet(staged)
        checked = spark.read.schema(checked.schema).parquet(staged)
        run_together(
            spark,
            [
                lambda: topics.land_messages(val.messages_of(checked), landing, batch_id),
                lambda: tables.append_batch(val.errors_of(checked), f"{reports}/{ERRORS}", batch_id),
                lambda: tables.append_batch(val.disposition_of(checked), f"{reports}/{DISPOSITIONS}", batch_id),
            ],
        )
    finally:
        delete_folder(spark, staged)


def start_ingest(
    source: DataFrame, landing: str, reports: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Start the stream from `(request_id, endpoint, body)` requests to a landing folder for the main stream.

    `reports/errors` holds the violations, `reports/dispositions` the status of each request.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, origin_of(batch, batch_id), landing, reports)

    writer = source.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
