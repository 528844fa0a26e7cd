"""Archive stream: every message by topic, unaltered, with the time it was archived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from demandlake.operators.messages import decode_messages
from demandlake.sources.topics import stamped


def start_archiver(source: DataFrame, archive: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Add the messages of a `(value, topic)` stream to `archive/topic=<name>/`.

    `sources.archive.read_archive` reads them back, and `topic_stream` may replay them.
    """
    writer = (
        stamped(decode_messages(source))
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("topic")
        .option("checkpointLocation", checkpoint)
        .option("path", archive)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
