"""Queries over the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.contracts import COMMENTS_TOPIC
from demandlake.operators import outbox
from demandlake.plans import sample_messages as sample
from demandlake.plans import sql_parts as sql

FOLDERS = ["folder-1"]
TENANT = "tenant-1"
TARGETS = {COMMENTS_TOPIC: "target/comments"}
_BLOCK_ROWS = 1000


def _payloads(spark: SparkSession, sf_dir: str, topic: Column) -> DataFrame:
    payload = outbox.payload_json(outbox.comment_payload(FOLDERS, TENANT))
    return sample.comment_documents(spark, sf_dir).select("event_id", topic.alias("topic"), payload.alias("payload"))


def _by_type() -> Column:
    return F.substring_index("objectType", ":", -1)


def _blocks() -> Column:
    return F.floor(F.col("event_id") / _BLOCK_ROWS)


def outbox_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payloads(spark, sf_dir, F.lit(COMMENTS_TOPIC)).select("event_id", "payload")


def outbox_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times at every depth: whole seconds or with fractions, in a struct, an array and a map."""
    seconds = F.date_trunc("second", "ts")
    moment = F.when(F.col("event_id") % 2 == 0, seconds.cast("timestamp_ntz")).otherwise(F.col("ts"))
    nested = F.struct(
        F.to_date("ts").alias("day"),
        F.array(moment, F.lit(None).cast("timestamp_ntz")).alias("moments"),
        F.create_map(F.lit("at"), moment).alias("named"),
    )
    events = sample.table(spark, sf_dir, "events").select("event_id", moment.alias("moment"), nested.alias("nested"))
    clean = outbox.sanitise(events)
    return clean.select("event_id", "moment", F.to_json("nested").alias("nested"))


def outbox_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 100 over several topics of different size."""
    return outbox.chunk_payloads(_payloads(spark, sf_dir, _by_type()), ["event_id"], _blocks())


def outbox_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of two over many topics, so that about every second topic ends in a chunk of one."""
    topics = F.concat(F.lit("for "), "author")
    return outbox.chunk_payloads(_payloads(spark, sf_dir, topics), ["event_id"], _blocks(), chunk_size=2)


def outbox_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with the target of their topic; those of a topic that has none are put aside with a reason."""
    topic = F.when(F.col("event_id") % 41 == 0, "returns-topic").otherwise(COMMENTS_TOPIC)
    chunks = outbox.chunk_payloads(_payloads(spark, sf_dir, topic), ["event_id"], _blocks())
    sent = outbox.deliverable(chunks, TARGETS).select("topic", "payload", "target")
    aside = outbox.without_target(chunks, TARGETS).withColumnRenamed("value", "payload")
    return sent.unionByName(aside, allowMissingColumns=True)


def outbox_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.payload_counts(_payloads(spark, sf_dir, _by_type()))


QUERIES = {
    "outbox_comment": outbox_comment,
    "outbox_sanitise": outbox_sanitise,
    "outbox_chunks": outbox_chunks,
    "outbox_unwrap": outbox_unwrap,
    "outbox_target": outbox_target,
    "outbox_counts": outbox_counts,
}


def _tag(name: str, column: str) -> str:
    return f"""'{{"Type":"member","Name":"{name}","Display":"' || {column} || '"}}'"""


_PAYLOADS = f"""WITH {sql.COMMENTS},
payloads AS (
    SELECT event_id, author, substr("objectType", 13) AS event_type,
           '{{"FolderIds":["{FOLDERS[0]}"],"TenantId":"{TENANT}","Title":"' || "commentType" || '","Body":"' || "commentText"
           || '","Tags":[' || {_tag("supplier", "supplier")} || ',' || {_tag("author", "author")} || ','
           || {_tag("commentId", '"commentId"')} || ',' || {_tag("customer", "customer")} || ']}}' AS payload
    FROM comments
)"""


def _chunks(topic: str, size: int) -> str:
    return f"""{_PAYLOADS},
numbered AS (
    SELECT {topic} AS topic, event_id, payload,
           (row_number() OVER (PARTITION BY {topic} ORDER BY event_id) - 1) // {size} AS chunk_no
    FROM payloads
),
chunks AS (
    SELECT topic, chunk_no, count(*) AS payload_count,
           CASE WHEN count(*) = 1 THEN any_value(payload)
                ELSE '[' || string_agg(payload, ',' ORDER BY event_id) || ']' END AS payload
    FROM numbered GROUP BY topic, chunk_no
)"""


_MOMENT = """CASE WHEN event_id % 2 = 0 OR date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END"""

ORACLES = {
    "outbox_comment": _PAYLOADS + "SELECT event_id, payload FROM payloads",
    "outbox_sanitise": f"""SELECT event_id, {_MOMENT} AS moment,
        '{{"day":"' || strftime(ts, '%Y-%m-%d') || '","moments":["' || {_MOMENT} || '",null],"named":{{"at":"'
        || {_MOMENT} || '"}}}}' AS nested FROM events""",
    "outbox_chunks": _chunks("event_type", 100) + "SELECT * FROM chunks",
    "outbox_unwrap": _chunks("'for ' || author", 2) + "SELECT * FROM chunks",
    "outbox_target": _chunks("CASE WHEN event_id % 41 = 0 THEN 'returns-topic' ELSE 'comments-topic' END", 100)
    + """SELECT topic, payload, CASE topic WHEN 'comments-topic' THEN 'target/comments' END AS target,
                CASE topic WHEN 'returns-topic' THEN 'no_target' END AS reason FROM chunks""",
    "outbox_counts": "SELECT event_type AS topic, count(*) AS payload_count FROM events GROUP BY 1",
}
