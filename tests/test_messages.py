from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC, DEMAND_TOPIC
from demandlake.functions.json_values import strict_variant
from demandlake.operators import messages as msg
from fixtures import comment, demand, messages

GOOD = json.dumps(comment())

UNREADABLE = {
    "": "malformed_json",
    "{": "malformed_json",
    "{'commentId': 'x'}": "malformed_json",
    GOOD + " trailing": "malformed_json",
    GOOD + GOOD: "malformed_json",
    GOOD + "," + GOOD: "malformed_json",
    GOOD + "}": "malformed_json",
    GOOD + "]": "malformed_json",
    "null": "not_an_object",
    "42": "not_an_object",
    '"text"': "not_an_object",
    "[" + GOOD + "]": "not_an_object",
    "[]": "not_an_object",
    json.dumps(comment(requestDelete="yes")): "contract_mismatch",
    json.dumps(comment(listOfReferenceDates="2023-11-05")): "contract_mismatch",
    "{}": "contract_mismatch",
}


def test_unreadable_messages_are_put_aside_with_a_reason(spark):
    frame = messages(spark, COMMENTS_TOPIC, GOOD, *UNREADABLE)
    aside = {row.value: row.reason for row in msg.quarantine_messages(frame, COMMENTS_TOPIC).collect()}
    assert aside == UNREADABLE
    assert msg.parse_messages(frame, COMMENTS_TOPIC).count() == 1


def test_blank_space_and_unknown_fields_do_no_harm(spark):
    pretty = json.dumps(comment(extra={"a": [1]}), indent=2)
    frame = messages(spark, COMMENTS_TOPIC, f"\n  {pretty}\n")
    assert msg.parse_messages(frame, COMMENTS_TOPIC).first().commentText == "Hello"


def test_null_text_is_put_aside(spark):
    frame = spark.createDataFrame([(COMMENTS_TOPIC, None)], "topic string, value string")
    assert msg.quarantine_messages(frame, COMMENTS_TOPIC).first().reason == "malformed_json"


def test_integers_and_fractions_in_one_field(spark):
    frame = messages(spark, DEMAND_TOPIC, demand())
    entries = msg.parse_messages(frame, DEMAND_TOPIC).first().demandSeries[0].demands
    assert [entry.demand for entry in entries] == [742.0, 1200.5]


def test_numbers_must_be_finite_and_texts_take_any_value(spark):
    good = json.dumps(demand())
    bad = [good.replace("742", value) for value in ('"7"', '"NaN"', "NaN")]
    frame = messages(spark, DEMAND_TOPIC, good, *bad)
    assert msg.parse_messages(frame, DEMAND_TOPIC).count() == 1
    assert msg.quarantine_messages(frame, DEMAND_TOPIC).count() == 3
    texts = messages(spark, COMMENTS_TOPIC, comment(author=5, commentText={"x": 1}))
    assert msg.parse_messages(texts, COMMENTS_TOPIC).select("author", "commentText").first() == ("5", '{"x":1}')


def test_routing_and_unknown_topics(spark):
    frame = messages(spark, COMMENTS_TOPIC, GOOD).union(messages(spark, "else", GOOD))
    folders = {row.topic: row.folder for row in msg.route_messages(frame).collect()}
    assert folders == {COMMENTS_TOPIC: "comments", "else": None}
    assert [row.reason for row in msg.quarantine_unknown_topics(frame).collect()] == ["unknown_topic"]


def test_every_message_is_either_parsed_or_put_aside(spark):
    frame = messages(spark, COMMENTS_TOPIC, GOOD, *UNREADABLE).union(messages(spark, CAPACITY_TOPIC, "{}", "{]"))
    parsed = sum(msg.parse_messages(frame, topic).count() for topic in (COMMENTS_TOPIC, CAPACITY_TOPIC, DEMAND_TOPIC))
    assert parsed + msg.quarantine_all(frame).count() == frame.count()


def test_parsing_an_unregistered_topic_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown topic"):
        msg.parse_messages(messages(spark, "else", "{}"), "else")


def test_decode(spark):
    raw = spark.createDataFrame([(bytearray("{\"ä\":1}".encode()), "t")], "value binary, topic string")
    assert msg.decode_messages(raw).first().value == '{"ä":1}'


@pytest.mark.parametrize("text", ['{"a":1}', " [1] ", "0", "null", '{"a":1,"a":2}'])
def test_strict_variant_accepts(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(strict_variant(F.col("t")).isNotNull()).first()[0]


@pytest.mark.parametrize("text", ["", "1 2", "[1]]", '{"a":1}{', "nul", '{"a":1}, {"b":2}'])
def test_strict_variant_refuses(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(strict_variant(F.col("t")).isNull()).first()[0]
