"""Queries over sources, message parsing and request validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC
from demandlake.operators import messages as msg
from demandlake.operators import validation as val
from demandlake.operators.bronze import bronze_capacity
from demandlake.plans import sample_messages as sample
from demandlake.plans import sql_parts as sql
from demandlake.session import scratch_path
from demandlake.sources import archive, tables, topics
from demandlake.sources.files import delete_folder
from demandlake.streaming.archiver import start_archiver
from demandlake.streaming.ingest import ERRORS, start_ingest

# Stored texts come in files of so many, by which an archive is split into parts.
_DOCUMENTS_PER_FILE = 10_000


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.stored(spark, sample.comment_messages(spark, sf_dir).select("topic", "value"), "messages")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.stored(spark, sample.ingest_requests(spark, sf_dir), "requests")


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.comment_messages(spark, sf_dir).select("topic", F.col("value").cast("binary").alias("value"))
    return msg.decode_messages(raw)


def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.parse_messages(_messages(spark, sf_dir), COMMENTS_TOPIC)


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.quarantine_all(_messages(spark, sf_dir))


def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = msg.route_messages(sample.all_messages(spark, sf_dir))
    return routed.groupBy("topic", "folder").agg(F.count(F.lit(1)).alias("messages"))


def stream_topic_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land messages, read them as a stream in several micro-batches, return what the stream delivered."""
    base = scratch_path(spark, "topic-source")
    topics.land_messages(sample.comment_messages(spark, sf_dir), f"{base}/landing")
    stream = topics.topic_stream(spark, f"{base}/landing", files_per_batch=2)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/received")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("value STRING, topic STRING").parquet(f"{base}/received")


def _awkward_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comment messages, some with line breaks between tokens, inside strings or at the end, some NULL."""
    event = F.col("event_id")
    value = (
        F.when(event % 43 == 0, F.lit(None).cast("string"))
        .when(event % 5 == 0, F.replace("value", F.lit(',"customer"'), F.lit(',\r\n"customer"')))
        .when(event % 7 == 0, F.replace("value", F.lit("Comment "), F.lit("Comment\n")))
        .when(event % 9 == 0, F.concat("value", F.lit("\n\n")))
        .otherwise(F.col("value"))
    )
    return sample.comment_messages(spark, sf_dir).select("topic", value.alias("value"))


def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive a stream of messages, awkward ones among them, and read the archive back."""
    base = scratch_path(spark, "archive")
    topics.land_messages(_awkward_messages(spark, sf_dir), f"{base}/landing")
    source = topics.topic_stream(spark, f"{base}/landing")
    start_archiver(source, f"{base}/archive", f"{base}/checkpoint").awaitTermination()
    kept = archive.read_archive(spark, f"{base}/archive")
    return kept.select("topic", "value", F.col("archived_at").isNotNull().alias("dated"))


def archive_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read an archive of one multi-line document per file, and flatten what is in it.

    Every file takes a block of disk, many times what its document takes in a table. So the archive is written, read
    and flattened in parts, each of which goes before the next is written; what they counted is stored and summed.
    """
    base = scratch_path(spark, "documents")
    documents = sample.capacity_documents(spark, sf_dir)
    pretty = F.to_json(F.struct(*documents.columns), {"pretty": "true"})
    texts = sample.stored(spark, documents.select(pretty.alias("value")), "pretty", maxRecordsPerFile=_DOCUMENTS_PER_FILE)
    for number, part in enumerate(archive.document_parts(texts)):
        location = f"{base}/archive-{number}"
        archive.write_documents(part, CAPACITY_TOPIC, location)
        rows = bronze_capacity(msg.parse_messages(archive.read_documents(spark, location), CAPACITY_TOPIC))
        counted = rows.groupBy("capacityGroupId", "name").agg(
            F.count(F.lit(1)).alias("capacities"), F.max("pointInTime").alias("last_day")
        )
        tables.append_batch(counted, f"{base}/counted", number)
        delete_folder(spark, location)
    return (
        tables.read_table(spark, f"{base}/counted")
        .groupBy("capacityGroupId", "name")
        .agg(F.sum("capacities").alias("capacities"), F.max("last_day").alias("last_day"))
    )


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a table twice and read its current content."""
    location = f"{scratch_path(spark, 'tables')}/comments"
    comments = sample.comment_documents(spark, sf_dir).drop("event_id")
    tables.replace_table(comments.select("commentId"), location, 1)
    tables.replace_table(comments, location, 2)
    return tables.read_table(spark, location)


def normalise_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = val.normalise_requests(_requests(spark, sf_dir))
    return normal.select("request_id", "shape", F.coalesce(F.size("items"), F.lit(0)).alias("item_count"))


def malformed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.malformed_requests(_requests(spark, sf_dir))


def dispatch_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.dispatch_requests(_requests(spark, sf_dir)).select("request_id", "endpoint", "topic")


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.validation_errors(_requests(spark, sf_dir))


def request_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.request_disposition(_requests(spark, sf_dir))


def partner_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand and capacity requests against their own contracts: status and messages per request."""
    requests = sample.stored(spark, sample.partner_requests(spark, sf_dir), "partner-requests")
    messages = F.transform(F.flatten("errors"), lambda error: F.concat_ws(" ", error["field"], error["message"]))
    return val.dispose_requests(requests).select(
        "request_id", "endpoint", "topic", "status", F.array_join(messages, ", ").alias("problems")
    )


def publish_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the items of valid requests to a landing folder and parse what arrived there."""
    location = f"{scratch_path(spark, 'published')}/landing"
    topics.land_messages(val.accepted_messages(_requests(spark, sf_dir)), location)
    return msg.parse_messages(topics.landed_messages(spark, location), COMMENTS_TOPIC)


def _run_ingest(spark: SparkSession, sf_dir: str) -> str:
    """Stream all requests through validation; returns the folder of what came of them."""
    base = scratch_path(spark, "ingest")
    sample.ingest_requests(spark, sf_dir).write.parquet(f"{base}/requests")
    source = topics.request_stream(spark, f"{base}/requests")
    start_ingest(source, f"{base}/landing", f"{base}/reports", f"{base}/checkpoint").awaitTermination()
    return base


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ingest stream landed, parsed as the main stream would."""
    landing = f"{_run_ingest(spark, sf_dir)}/landing"
    return msg.parse_messages(topics.landed_messages(spark, landing), COMMENTS_TOPIC)


def stream_ingest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violations the ingest stream reported."""
    return tables.read_table(spark, f"{_run_ingest(spark, sf_dir)}/reports/{ERRORS}")


def _errors_where(condition: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return validation_errors(spark, sf_dir).filter(condition).select("request_id", "index", "field", "message")

    return query


# Rule -> condition on the error report; the same text serves Spark and the oracle.
_RULES = {
    "validate_required": "message LIKE 'required%'",
    "validate_types": "message LIKE 'type%'",
    "validate_length": "message = 'maxLength'",
    "validate_enum": "message = 'enum'",
    "validate_unique_items": "message = 'uniqueItems'",
}

QUERIES = {
    "decode_messages": decode_messages,
    "parse_messages": parse_messages,
    "quarantine_split": quarantine_split,
    "route_topics": route_topics,
    "stream_topic_source": stream_topic_source,
    "archive_roundtrip": archive_roundtrip,
    "archive_read": archive_read,
    "read_table": read_table,
    "normalise_requests": normalise_requests,
    "malformed_requests": malformed_requests,
    "dispatch_endpoint": dispatch_endpoint,
    "validation_errors": validation_errors,
    "validate_bpnl": _errors_where("message = 'pattern' AND field[0] IN ('customer', 'supplier')"),
    "validate_uuid": _errors_where("message = 'pattern' AND field[0] IN ('commentId', 'objectId')"),
    **{name: _errors_where(condition) for name, condition in _RULES.items()},
    "request_disposition": request_disposition,
    "partner_disposition": partner_disposition,
    "publish_accepted": publish_accepted,
    "stream_ingest": stream_ingest,
    "stream_ingest_errors": stream_ingest_errors,
}

_COMMENT_COLUMNS = """"commentId", "objectId", "objectType", customer, supplier, author, "postedAt",
    "changedAt", "commentText", "commentType", "requestDelete", "listOfReferenceDates" """
_ERROR_COLUMNS = "request_id, index, field, message"

ORACLES = {
    "decode_messages": f"WITH {sql.COMMENT_MESSAGES} SELECT topic, value FROM comment_messages",
    "parse_messages": f"WITH {sql.COMMENT_MESSAGES} SELECT {_COMMENT_COLUMNS} FROM comment_messages WHERE reason IS NULL",
    "quarantine_split": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT topic, value, reason FROM comment_messages WHERE reason IS NOT NULL""",
    "route_topics": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT topic, CASE topic WHEN 'comments-topic' THEN 'comments' END AS folder, count(*) AS messages
        FROM comment_messages GROUP BY topic
        UNION ALL SELECT 'demand-topic', 'demand', count(*)
        FROM (SELECT DISTINCT o_orderkey, l_linenumber // 1000 FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
        UNION ALL SELECT 'capacity-topic', 'capacity', count(*)
        FROM (SELECT DISTINCT s_suppkey, l_orderkey // 10000 FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey)""",
    "stream_topic_source": f"WITH {sql.COMMENT_MESSAGES} SELECT topic, value FROM comment_messages",
    "archive_roundtrip": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT topic,
               CASE WHEN event_id % 43 = 0 THEN NULL
                    WHEN event_id % 5 = 0 THEN replace(value, ',"customer"', ',' || chr(13) || chr(10) || '"customer"')
                    WHEN event_id % 7 = 0 THEN replace(value, 'Comment ', 'Comment' || chr(10))
                    WHEN event_id % 9 = 0 THEN value || chr(10) || chr(10)
                    ELSE value END AS value,
               true AS dated
        FROM comment_messages""",
    "archive_read": f"""WITH {sql.CAPACITY}
        SELECT "capacityGroupId", name, count(*) AS capacities, max("pointInTime") AS last_day
        FROM capacity GROUP BY 1, 2""",
    "read_table": f"WITH {sql.COMMENTS} SELECT {_COMMENT_COLUMNS} FROM comments",
    "normalise_requests": f"""WITH {sql.REQUESTS}
        SELECT request_id, CASE body_kind WHEN 'empty' THEN 'list' ELSE body_kind END AS shape, total AS item_count
        FROM decided""",
    "malformed_requests": f"""WITH {sql.REQUESTS}
        SELECT request_id, endpoint, body_kind AS shape FROM decided WHERE body_kind IN ('malformed', 'scalar')""",
    "dispatch_endpoint": f"""WITH {sql.REQUESTS}
        SELECT request_id, endpoint, CASE endpoint WHEN '/comments' THEN 'comments-topic' END AS topic FROM decided""",
    "validation_errors": f"WITH {sql.REQUESTS} SELECT endpoint, {_ERROR_COLUMNS} FROM errors",
    "validate_bpnl": f"""WITH {sql.REQUESTS}
        SELECT {_ERROR_COLUMNS} FROM errors WHERE message = 'pattern' AND field IN ('["customer"]', '["supplier"]')""",
    "validate_uuid": f"""WITH {sql.REQUESTS}
        SELECT {_ERROR_COLUMNS} FROM errors WHERE message = 'pattern' AND field IN ('["commentId"]', '["objectId"]')""",
    **{
        name: f"WITH {sql.REQUESTS} SELECT {_ERROR_COLUMNS} FROM errors WHERE {condition}"
        for name, condition in _RULES.items()
    },
    "request_disposition": f"""WITH {sql.REQUESTS}
        SELECT request_id, endpoint, status, CASE WHEN status IN (200, 201) THEN total ELSE 0 END AS accepted
        FROM disposition""",
    "partner_disposition": """WITH sent AS (
            SELECT CAST(o_orderkey AS VARCHAR) AS request_id, '/demand' AS endpoint, 'demand-topic' AS topic,
                   o_orderkey % 10 AS digit, 'demandSeries' AS list_field, 'materialDemandIsInactive' AS flag,
                   l_orderkey IS NULL AS bare
            FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber // 1000 FROM lineitem) ON l_orderkey = o_orderkey
            UNION ALL
            SELECT 'CG-' || s_suppkey, '/capacity', 'capacity-topic', s_suppkey % 10, 'capacities', 'capacityGroupIsInactive',
                   l_suppkey IS NULL
            FROM supplier LEFT JOIN (SELECT DISTINCT l_suppkey, l_orderkey // 10000 FROM lineitem) ON l_suppkey = s_suppkey),
        judged AS (
            SELECT *, list_filter([
                CASE WHEN bare AND topic = 'demand-topic' THEN 'required: materialNumberCustomer' END,
                CASE WHEN bare AND topic = 'demand-topic' THEN 'required: materialDescriptionCustomer' END,
                CASE WHEN digit = 0 THEN 'required: customer' END,
                CASE WHEN bare AND topic = 'demand-topic' THEN 'required: supplier' END,
                CASE WHEN bare AND topic = 'capacity-topic' THEN 'required: changedAt' END,
                CASE WHEN bare AND topic = 'capacity-topic' AND digit <> 1 THEN 'required: capacities' END,
                CASE WHEN digit = 1 THEN list_field || ' type: array' END,
                CASE WHEN digit = 2 THEN flag || ' type: boolean' END], lambda x: x IS NOT NULL) AS found
            FROM sent)
        SELECT request_id, endpoint, topic, CASE WHEN len(found) > 0 THEN 422 ELSE 201 END AS status,
               array_to_string(list_sort(list_transform(found, lambda x: CASE WHEN x LIKE 'required%' THEN ' ' || x ELSE x END)), ', ') AS problems
        FROM judged""",
    "publish_accepted": f"""WITH {sql.COMMENTS}, {sql.REQUESTS}
        SELECT {_COMMENT_COLUMNS} FROM comments JOIN items USING (event_id) JOIN disposition USING (request_id)
        WHERE status IN (200, 201)""",
}
ORACLES |= {"stream_ingest": ORACLES["publish_accepted"], "stream_ingest_errors": ORACLES["validation_errors"]}
