from __future__ import annotations

import datetime as dt
import json
from collections import defaultdict

from pyspark.sql import functions as F

from demandlake.operators import outbox
from fixtures import comment


def payloads(spark, rows):
    return spark.createDataFrame(rows, "topic string, id bigint, payload string")


def test_numbers_and_chunks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(outbox, "_BLOCKS_PER_GROUP", 3)
    # One topic holds most rows, ids have gaps, blocks are small and some are empty.
    rows = [("hot", i * 3, f'"h{i}"') for i in range(1000)] + [(f"t{i % 7}", i * 11, f'"c{i}"') for i in range(60)]
    by_topic = defaultdict(list)
    for topic, _, text in sorted(rows, key=lambda row: row[1]):
        by_topic[topic].append(text)
    expected = {
        (topic, no): texts[no * 8 : no * 8 + 8] for topic, texts in by_topic.items() for no in range((len(texts) + 7) // 8)
    }
    frame = payloads(spark, rows).repartition(8)
    chunks = outbox.chunk_payloads(frame, ["id"], F.floor(F.col("id") / 50), chunk_size=8)
    found = {}
    for row in chunks.collect():
        value = json.loads(row.payload)
        found[row.topic, row.chunk_no] = [json.dumps(v) for v in (value if isinstance(value, list) else [value])]
        assert row.payload_count == len(found[row.topic, row.chunk_no])
    assert found == expected


def test_sources_come_one_after_the_other(spark, monkeypatch):
    """Offsets start anew in each source, one source holds most rows, and partitions do not matter."""
    monkeypatch.setattr(outbox, "_BLOCKS_PER_GROUP", 3)
    rows = [("t", f"file {i % 3 if i < 90 else 1}", i, str(i)) for i in range(700)] + [("u", "file 2", 5, "x"), ("u", "file 0", 9, "y")]
    frame = spark.createDataFrame(rows, "topic string, source string, offset bigint, payload string")
    texts = [row[3] for row in sorted(rows, key=lambda row: row[1:3]) if row[0] == "t"]
    expected = {("t", no): texts[no * 8 : no * 8 + 8] for no in range((len(texts) + 7) // 8)} | {("u", 0): ["y", "x"]}
    for parts in (1, 8):
        block = F.floor(F.col("offset") / 20)
        chunks = outbox.chunk_payloads(frame.repartition(parts), ["offset"], block, 8, F.col("source")).collect()
        assert {(row.topic, row.chunk_no): row.payload.strip("[]").split(",") for row in chunks} == expected


def test_a_chunk_of_one_is_not_a_list(spark):
    rows = [("a", 1, '{"x":1}'), ("b", 1, '{"x":1}'), ("b", 2, '{"x":2}')]
    chunks = outbox.chunk_payloads(payloads(spark, rows), ["id"], F.lit(0))
    assert {row.topic: row.payload for row in chunks.collect()} == {"a": '{"x":1}', "b": '[{"x":1},{"x":2}]'}


def test_comment_payload(spark):
    row = spark.createDataFrame([comment()])
    text = row.select(outbox.payload_json(outbox.comment_payload(["f1", "f2"], "t"))).first()[0]
    assert json.loads(text) == {
        "FolderIds": ["f1", "f2"],
        "TenantId": "t",
        "Title": "information",
        "Body": "Hello",
        "Tags": [
            {"Type": "member", "Name": name, "Display": comment()[name]}
            for name in ("supplier", "author", "commentId", "customer")
        ],
    }


def test_missing_values_are_written_as_null(spark):
    row = spark.createDataFrame([comment()]).withColumn("author", F.lit(None).cast("string"))
    payload = json.loads(row.select(outbox.payload_json(outbox.comment_payload(["f"], "t"))).first()[0])
    assert payload["Tags"][1] == {"Type": "member", "Name": "author", "Display": None}


def test_sanitise_matches_isoformat(spark):
    moments = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60), None]
    day = dt.date(2024, 5, 6)
    schema = "m timestamp, d date, n struct<a: array<timestamp_ntz>, s: struct<d: date>, p: map<string,timestamp>>, i int"
    rows = [(m, day, ([m], (day,), {"k": m}), 7) for m in moments] + [(None, None, None, None)]
    found = outbox.sanitise(spark.createDataFrame(rows, schema)).collect()
    for moment, row in zip(moments, found):
        text = moment and moment.isoformat()
        assert (row.m, row.d, row.n.a, row.n.s.d, row.n.p, row.i) == (text, "2024-05-06", [text], "2024-05-06", {"k": text}, 7)
    assert tuple(found[-1]) == (None, None, None, None)


def test_targets_and_counts(spark):
    frame = payloads(spark, [("a", 1, "{}"), ("a", 2, "{}"), ("b", 1, "{}")])
    assert {r.topic: r.payload_count for r in outbox.payload_counts(frame).collect()} == {"a": 2, "b": 1}
    assert {r.topic: r.target for r in outbox.with_target(frame, {"a": "x"}).collect()} == {"a": "x", "b": None}


def test_chunks_without_a_target_are_put_aside(spark):
    frame = payloads(spark, [("a", 1, "{}"), ("b", 1, "[1]"), (None, 1, "x")])
    assert [(r.topic, r.target) for r in outbox.deliverable(frame, {"a": "x"}).collect()] == [("a", "x")]
    aside = {(r.topic, r.value, r.reason) for r in outbox.without_target(frame, {"a": "x"}).collect()}
    assert aside == {("b", "[1]", "no_target"), (None, "x", "no_target")}
