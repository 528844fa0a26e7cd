from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC, DEMAND_TOPIC
from demandlake.operators import bronze, gold
from demandlake.operators.layout import MONTH
from demandlake.operators.messages import parse_messages
from demandlake.sources import archive, tables, topics
from demandlake.sources.files import child_folders, exists
from demandlake.streaming import medallion
from demandlake.streaming.archiver import start_archiver
from demandlake.streaming.forwarder import start_forwarder
from demandlake.streaming.ingest import ingest_batch
from demandlake.streaming.medallion import start_medallion
from fixtures import capacity, comment, demand, messages

FIRST = demand(materialDescriptionCustomer="first")
SECOND = demand(materialDescriptionCustomer="second", customer="BPNL00000009ZZZZ")


def run(spark, folder, **options):
    source = topics.topic_stream(spark, f"{folder}/landing", **options)
    moment = lambda batch: f"2024-01-{batch + 1:02d} 00:00:00"
    query = start_medallion(source, f"{folder}/lake", f"{folder}/checkpoint", as_of=moment)
    query.awaitTermination()
    return query


def land(spark, folder, topic, *documents):
    topics.land_messages(messages(spark, topic, *documents).coalesce(1), f"{folder}/landing")


def gold_table(spark, folder, topic, name):
    return tables.read_table(spark, tables.layer_path(f"{folder}/lake", "gold", topic, name))


def as_json(document):
    import json

    return json.dumps(document)


def as_text(frame):
    return sorted(map(str, frame.collect()))


def test_stream_equals_batch_on_all_topics(spark, folder):
    land(spark, folder, DEMAND_TOPIC, FIRST, "{broken")
    land(spark, folder, CAPACITY_TOPIC, capacity())
    land(spark, folder, COMMENTS_TOPIC, comment(), comment(requestDelete="yes"))
    land(spark, folder, "returns", "{}")
    run(spark, folder)
    landed = topics.landed_messages(spark, f"{folder}/landing")
    flat = bronze.bronze_demand(parse_messages(landed, DEMAND_TOPIC))
    facts = gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").drop(MONTH)
    assert as_text(facts) == as_text(gold.fact_material_demand(flat))
    assert as_text(gold_table(spark, folder, DEMAND_TOPIC, "DimTime")) == as_text(gold.dim_time(flat))
    assert gold_table(spark, folder, CAPACITY_TOPIC, "FactCapacityGroup").count() == 3
    assert gold_table(spark, folder, COMMENTS_TOPIC, "Comments").count() == 1
    reasons = {
        name: [row.reason for row in tables.read_table(spark, f"{folder}/lake/quarantine/{name}").collect()]
        for name in (DEMAND_TOPIC, COMMENTS_TOPIC, "unknown_topic")
    }
    assert reasons == {
        DEMAND_TOPIC: ["malformed_json"],
        COMMENTS_TOPIC: ["contract_mismatch"],
        "unknown_topic": ["unknown_topic"],
    }
    assert not exists(spark, f"{folder}/lake/quarantine/{CAPACITY_TOPIC}")


def test_later_batches_append_facts_and_merge_dimensions(spark, folder):
    land(spark, folder, DEMAND_TOPIC, FIRST)
    run(spark, folder)
    land(spark, folder, DEMAND_TOPIC, SECOND)
    run(spark, folder)
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 6
    assert gold_table(spark, folder, DEMAND_TOPIC, "DimTime").count() == 3
    materials = gold_table(spark, folder, DEMAND_TOPIC, "DimMaterial").orderBy("ValidFrom").collect()
    assert [(m.MaterialDescription, m.IsCurrent, m.ValidFrom.day) for m in materials] == [("first", False, 1), ("second", True, 2)]
    assert materials[0].ValidTo == materials[1].ValidFrom
    assert gold_table(spark, folder, DEMAND_TOPIC, "DimCustomer").count() == 2


def test_a_second_run_finds_nothing(spark, folder):
    land(spark, folder, COMMENTS_TOPIC, comment())
    run(spark, folder)
    assert sum(progress.numInputRows for progress in run(spark, folder).recentProgress) == 0
    assert gold_table(spark, folder, COMMENTS_TOPIC, "Comments").count() == 1


def test_a_failed_batch_is_not_committed_and_its_retry_leaves_no_duplicates(spark, folder, monkeypatch):
    land(spark, folder, DEMAND_TOPIC, FIRST)
    with monkeypatch.context() as patched:
        broken = {**medallion.GOLD[DEMAND_TOPIC], "DimTime": lambda silver: silver.select("no_such_column")}
        patched.setitem(medallion.GOLD, DEMAND_TOPIC, broken)
        with pytest.raises(StreamingQueryException):
            run(spark, folder)
    run(spark, folder)
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 3
    assert gold_table(spark, folder, DEMAND_TOPIC, "DimMaterial").count() == 1
    assert gold_table(spark, folder, DEMAND_TOPIC, "DimTime").count() == 3


def test_a_failed_silver_step_stops_the_chain(spark, folder, monkeypatch):
    def fail(rows):
        raise RuntimeError("silver failed")

    land(spark, folder, DEMAND_TOPIC, FIRST)
    monkeypatch.setitem(medallion.SILVER, DEMAND_TOPIC, fail)
    with pytest.raises(StreamingQueryException):
        run(spark, folder)
    assert exists(spark, tables.layer_path(f"{folder}/lake", "bronze", DEMAND_TOPIC))
    assert not exists(spark, tables.layer_path(f"{folder}/lake", "gold", DEMAND_TOPIC))


def test_messages_without_rows_leave_empty_tables(spark, folder):
    land(spark, folder, DEMAND_TOPIC, demand(demandSeries=[]), "{broken")
    run(spark, folder)
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 0
    assert tables.read_table(spark, f"{folder}/lake/quarantine/{DEMAND_TOPIC}").count() == 1


def test_documents_over_several_lines(spark, folder):
    import json
    import os

    os.makedirs(f"{folder}/landing/topic={COMMENTS_TOPIC}")
    with open(f"{folder}/landing/topic={COMMENTS_TOPIC}/one.json", "w") as file:
        json.dump(comment(), file, indent=2)
    run(spark, folder, layout=topics.DOCUMENTS)
    assert gold_table(spark, folder, COMMENTS_TOPIC, "Comments").count() == 1


def test_archiver_keeps_every_message(spark, folder):
    land(spark, folder, COMMENTS_TOPIC, comment(), "{bro\nken", None)
    land(spark, folder, "else", "{}")
    source = topics.topic_stream(spark, f"{folder}/landing")
    for _ in range(2):
        start_archiver(source, f"{folder}/archive", f"{folder}/checkpoint").awaitTermination()
    kept = archive.read_archive(spark, f"{folder}/archive")
    assert as_text(kept.select("value", "topic")) == as_text(topics.landed_messages(spark, f"{folder}/landing"))
    assert kept.filter("archived_at IS NULL").count() == 0


def test_forwarder_writes_chunks(spark, folder):
    import json

    land(spark, folder, COMMENTS_TOPIC, *[comment(author=str(i)) for i in range(250)], "{broken")
    source = topics.topic_stream(spark, f"{folder}/landing", positions=True)
    targets = {COMMENTS_TOPIC: "somewhere"}
    start_forwarder(source, f"{folder}/outbox", f"{folder}/checkpoint", ["f"], "t", targets).awaitTermination()
    chunks = tables.read_table(spark, f"{folder}/outbox").orderBy("chunk_no").collect()
    assert [(chunk.chunk_no, chunk.payload_count, chunk.target) for chunk in chunks] == [
        (0, 100, "somewhere"),
        (1, 100, "somewhere"),
        (2, 50, "somewhere"),
    ]
    authors = [payload["Tags"][1]["Display"] for chunk in chunks for payload in json.loads(chunk.payload)]
    assert authors == [str(i) for i in range(250)]


def test_an_outbox_batch_read_again_on_other_partitions_gives_the_same_chunks(spark, folder):
    from demandlake.streaming.forwarder import outbox_batch

    rows = [
        (DEMAND_TOPIC if i % 50 == 7 else COMMENTS_TOPIC, None if i == 3 else as_json(comment(author=str(i))), (f"f{i % 3}", i))
        for i in range(330)
    ]
    batch = spark.createDataFrame(rows, "topic string, value string, position struct<source: string, offset: bigint>")
    found = []
    for parts in (1, 7):
        outbox_batch(batch.repartition(parts), 0, f"{folder}/outbox", ["f"], "t", {COMMENTS_TOPIC: "x"})
        found.append((as_text(tables.read_table(spark, f"{folder}/outbox")), as_text(tables.read_table(spark, f"{folder}/outbox-quarantine"))))
    assert found[0] == found[1] and len(found[0][0]) == 4 and len(found[0][1]) == 8
    with pytest.raises(ValueError, match="position"):
        outbox_batch(batch.drop("position"), 1, f"{folder}/outbox", ["f"], "t", {COMMENTS_TOPIC: "x"})


def test_forwarder_needs_a_target(spark, folder):
    with pytest.raises(ValueError, match="target"):
        start_forwarder(None, f"{folder}/outbox", f"{folder}/checkpoint", ["f"], "t", {})


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {path for path in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in path}


def left_over(spark, before):
    """Shuffle files that were not there before; they are deleted beside the work, so give it a moment."""
    import time

    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return shuffle_files(spark) - before


def test_a_stream_leaves_no_shuffle_files(spark, folder):
    land(spark, folder, DEMAND_TOPIC, FIRST, "{broken")
    land(spark, folder, COMMENTS_TOPIC, comment())
    before = shuffle_files(spark)
    run(spark, folder)
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").schema
    assert left_over(spark, before) == set()
    assert all(name.endswith(".zstd.parquet") for name in written(folder))


def test_landing_in_a_query_leaves_no_shuffle_files(spark, folder):
    from demandlake.plans import storage
    from demandlake.session import DROP_SHUFFLES

    before = shuffle_files(spark)
    setting = spark.conf.get(DROP_SHUFFLES[0], None)
    storage._land(spark, messages(spark, DEMAND_TOPIC, FIRST, SECOND).repartition(3), f"{folder}/landing")
    assert left_over(spark, before) == set()
    assert spark.conf.get(DROP_SHUFFLES[0], None) == setting
    assert topics.landed_messages(spark, f"{folder}/landing").count() == 2


def test_staged_messages_go_once_bronze_has_them(spark, folder, monkeypatch):
    from demandlake.streaming import medallion

    seen, promote = [], medallion.promote_layer

    def watched(stored, transform, target, batch_id):
        seen.append(child_folders(spark, f"{folder}/lake/{medallion.STAGED}/{batch_id}"))
        return promote(stored, transform, target, batch_id)

    monkeypatch.setattr(medallion, "promote_layer", watched)
    for _ in range(2):  # a batch tried again finds its messages at the source
        medallion.process_batch(messages(spark, DEMAND_TOPIC, FIRST, "{broken"), 0, f"{folder}/lake", "2024-01-01 00:00:00")
    assert seen == [[], []]
    assert tables.read_table(spark, f"{folder}/lake/quarantine/{DEMAND_TOPIC}").count() == 1
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 3


def test_consumed_files_go_and_are_read_once(spark, folder):
    for _ in range(3):
        land(spark, folder, DEMAND_TOPIC, FIRST)
    for _ in range(2):
        source = topics.topic_stream(spark, f"{folder}/landing", bytes_per_batch=1, consume=True)
        start_medallion(source, f"{folder}/lake", f"{folder}/checkpoint").awaitTermination()
    assert len(written(f"{folder}/landing")) == 1  # of the last batch, until one follows
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 9


def run_second(spark, folder):
    source = topics.topic_stream(spark, f"{folder}/landing-2")
    start_medallion(source, f"{folder}/lake", f"{folder}/checkpoint-2", as_of=lambda batch: "2024-02-01 00:00:00").awaitTermination()


def test_a_second_checkpoint_adds_to_the_lake(spark, folder):
    land(spark, folder, DEMAND_TOPIC, FIRST, "{broken")
    run(spark, folder)
    topics.land_messages(messages(spark, DEMAND_TOPIC, SECOND, "[broken").coalesce(1), f"{folder}/landing-2")
    run_second(spark, folder)
    assert tables.read_table(spark, tables.layer_path(f"{folder}/lake", "bronze", DEMAND_TOPIC)).count() == 6
    assert tables.read_table(spark, f"{folder}/lake/quarantine/{DEMAND_TOPIC}").count() == 2
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 6
    assert gold_table(spark, folder, DEMAND_TOPIC, "DimCustomer").count() == 2
    materials = gold_table(spark, folder, DEMAND_TOPIC, "DimMaterial").orderBy("ValidFrom").collect()
    assert [(m.MaterialDescription, m.IsCurrent) for m in materials] == [("first", False), ("second", True)]


def test_a_replay_after_another_stream_changes_nothing(spark, folder):
    import os

    land(spark, folder, DEMAND_TOPIC, FIRST)
    run(spark, folder)
    topics.land_messages(messages(spark, DEMAND_TOPIC, SECOND).coalesce(1), f"{folder}/landing-2")
    run_second(spark, folder)
    names = ("FactMaterialDemand", "DimMaterial", "DimCustomer", "DimTime")
    before = {name: as_text(gold_table(spark, folder, DEMAND_TOPIC, name)) for name in names}
    # The first stream did all its work but did not get to commit the batch.
    for name in ("0", ".0.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    run(spark, folder)
    assert {name: as_text(gold_table(spark, folder, DEMAND_TOPIC, name)) for name in names} == before


def test_forwarder_puts_aside_what_it_cannot_deliver(spark, folder):
    from demandlake.streaming.forwarder import quarantine_path

    land(spark, folder, COMMENTS_TOPIC, comment(), "{broken")
    land(spark, folder, DEMAND_TOPIC, FIRST)
    land(spark, folder, "else", "{}")
    source = topics.topic_stream(spark, f"{folder}/landing", positions=True)
    start_forwarder(source, f"{folder}/outbox", f"{folder}/checkpoint", ["f"], "t", {COMMENTS_TOPIC: "x"}).awaitTermination()
    aside = tables.read_table(spark, quarantine_path(f"{folder}/outbox")).collect()
    assert sorted((row.topic, row.reason) for row in aside) == [
        (COMMENTS_TOPIC, "malformed_json"),
        (DEMAND_TOPIC, "not_forwarded"),
        ("else", "unknown_topic"),
    ]


def written(location):
    """The files of a table by name: one written again has another."""
    import os

    return sorted(name for _, _, names in os.walk(location) for name in names if name.startswith("part-"))


def test_an_unchanged_snapshot_writes_nothing(spark, folder):
    gold_folder = tables.layer_path(f"{folder}/lake", "gold", DEMAND_TOPIC)
    before = None
    for _ in range(3):
        land(spark, folder, DEMAND_TOPIC, FIRST)
        run(spark, folder)
        before = before or {name: written(f"{gold_folder}/{name}/open") for name in ("DimMaterial", "DimCustomer")}
    for name in ("DimMaterial", "DimCustomer"):
        assert "closed" not in child_folders(spark, f"{gold_folder}/{name}")
        assert written(f"{gold_folder}/{name}/open") == before[name]
    assert len([name for name in child_folders(spark, f"{gold_folder}/DimTime") if name.startswith("batch_id=")]) == 1
    assert gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand").count() == 9


def test_facts_lie_in_months_or_in_the_layout_asked_for(spark, folder):
    land(spark, folder, DEMAND_TOPIC, FIRST)
    run(spark, folder)
    facts = gold_table(spark, folder, DEMAND_TOPIC, "FactMaterialDemand")
    plan = facts.filter(f"{MONTH} = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pointInTimeMonth" in plan
    source = topics.topic_stream(spark, f"{folder}/landing")
    chosen = {"FactMaterialDemand": ["CustomerBPNL"]}
    start_medallion(source, f"{folder}/other", f"{folder}/checkpoint-2", partitions=chosen).awaitTermination()
    location = tables.layer_path(f"{folder}/other", "gold", DEMAND_TOPIC, "FactMaterialDemand")
    (batch,) = [name for name in child_folders(spark, location) if name.startswith("batch_id=")]
    assert child_folders(spark, f"{location}/{batch}") == [f"CustomerBPNL={FIRST['customer']}"]
    assert as_text(tables.read_table(spark, location).select(*facts.drop(MONTH).columns)) == as_text(facts.drop(MONTH))


def test_a_batch_of_requests_tried_again_lands_once(spark, folder):
    import json

    rows = [("1", "/comments", json.dumps(comment())), ("2", "/comments", "{"), ("3", "/comments", json.dumps(comment(author=5)))]
    requests = spark.createDataFrame(rows, "request_id string, endpoint string, body string")
    for _ in range(2):
        ingest_batch(requests, tables.Origin("s", 0), f"{folder}/landing", f"{folder}/reports")
    assert topics.landed_messages(spark, f"{folder}/landing").count() == 1
    errors = tables.read_table(spark, f"{folder}/reports/errors").collect()
    assert [(row.request_id, row.message) for row in errors] == [("3", "type: string")]
    decided = tables.read_table(spark, f"{folder}/reports/dispositions").collect()
    assert sorted((row.request_id, row.status) for row in decided) == [("1", 201), ("2", 400), ("3", 422)]
