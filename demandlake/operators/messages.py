"""From raw topic messages to typed records: decode, parse, quarantine, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.contracts import TOPICS, topic_of
from demandlake.functions import json_values as jv

UNKNOWN_TOPIC = "unknown_topic"
MALFORMED = "malformed_json"
NOT_AN_OBJECT = "not_an_object"
CONTRACT_MISMATCH = "contract_mismatch"


def decode_messages(raw: DataFrame) -> DataFrame:
    """Message bytes as text, with the topic they came from."""
    return raw.select(F.col("value").cast("string").alias("value"), "topic")


def of_topic(messages: DataFrame, topic: str) -> DataFrame:
    """The messages of one registered topic."""
    topic_of(topic)
    return messages.filter(F.col("topic") == topic)


def documents(topic: str) -> Column:
    """The text's document in an array, typed by the topic's schema; NULL if it does not fit."""
    entry = topic_of(topic)
    return jv.strict_documents(F.col("value"), entry.message_schema, entry.id_column)


def parse_with_flag(messages: DataFrame, topic: str, keep: list[str] | None = None) -> DataFrame:
    """The messages of one topic, parsed: `document`, whether it is `readable`, and the columns in `keep`.

    Taking the document out of its array by an outer explode gives one row per message, and a
    column no filter can be pushed through, which would make Spark parse the text again for it.
    """
    parsed = of_topic(messages, topic).select(*(keep or []), F.explode_outer(documents(topic)).alias("document"))
    return parsed.withColumn("readable", F.col("document").isNotNull())


def parse_messages(messages: DataFrame, topic: str) -> DataFrame:
    """The readable messages of one topic as typed columns, one row per message.

    A message that is not one JSON object fitting the topic's schema is left out here and shows
    up in `quarantine_messages`; together the two cover every message exactly once.
    """
    return parse_with_flag(messages, topic).filter("readable").select("document.*")


def unreadable_reason(text: Column) -> Column:
    """Why a message that does not fit its schema was put aside."""
    return (
        F.when(jv.strict_variant(text).isNull(), MALFORMED)
        .when(~jv.starts_with(text, "{"), NOT_AN_OBJECT)
        .otherwise(CONTRACT_MISMATCH)
    )


def quarantine_messages(messages: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic that cannot be read: `(topic, value, reason)`, text unchanged."""
    unreadable = of_topic(messages, topic).filter(documents(topic).isNull())
    return unreadable.select("topic", "value", unreadable_reason(F.col("value")).alias("reason"))


def _is_known() -> Column:
    return F.coalesce(F.col("topic").isin(*TOPICS), F.lit(False))


def quarantine_unknown_topics(messages: DataFrame) -> DataFrame:
    """Messages on topics nobody registered, in the quarantine layout."""
    return messages.filter(~_is_known()).select("topic", "value", F.lit(UNKNOWN_TOPIC).alias("reason"))


def quarantine_all(messages: DataFrame) -> DataFrame:
    """Everything that cannot be processed, over all topics, in one pass."""
    readable = F.lit(False)
    for topic in TOPICS:
        readable = F.when(F.col("topic") == topic, documents(topic).isNotNull()).otherwise(readable)
    reason = F.when(_is_known(), unreadable_reason(F.col("value"))).otherwise(UNKNOWN_TOPIC)
    return messages.filter(~readable).select("topic", "value", reason.alias("reason"))


def route_messages(messages: DataFrame) -> DataFrame:
    """Each message with the table folder its topic leads to; NULL for an unknown topic."""
    folder = F.lit(None).cast("string")
    for topic in TOPICS.values():
        folder = F.when(F.col("topic") == topic.name, topic.folder).otherwise(folder)
    return messages.withColumn("folder", folder)
