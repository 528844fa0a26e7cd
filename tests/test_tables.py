from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from demandlake.contracts import DEMAND_TOPIC
from demandlake.operators.scd import DimSpec
from demandlake.sources import archive, tables, topics
from demandlake.sources.files import child_folders


def rows(spark, *values):
    return spark.createDataFrame([(value, value % 3) for value in values], "v int, third int")


def content(frame):
    return sorted(row.v for row in frame.collect())


def test_a_batch_written_again_replaces_itself(spark, folder):
    tables.append_batch(rows(spark, 1, 2), f"{folder}/t", 0)
    tables.append_batch(rows(spark, 3), f"{folder}/t", 1)
    tables.append_batch(rows(spark, 4), f"{folder}/t", 1)
    assert content(tables.read_table(spark, f"{folder}/t")) == [1, 2, 4]
    assert content(tables.read_batch(spark, f"{folder}/t", 1)) == [4]
    assert content(tables.read_latest_batch(spark, f"{folder}/t")) == [4]
    schema = rows(spark, 1).schema
    assert tables.read_table(spark, f"{folder}/t", schema).columns == ["v", "third"]


def test_an_empty_batch_can_be_read_back(spark, folder):
    empty = rows(spark, 1).filter("v > 1")
    assert tables.append_batch(empty, f"{folder}/t", 0, ["third"]).count() == 0


def test_partition_columns_are_checked(spark, folder):
    with pytest.raises(ValueError, match="nothere"):
        tables.append_batch(rows(spark, 1), f"{folder}/t", 0, ["nothere"])
    with pytest.raises(ValueError, match="nothere"):
        tables.replace_table(rows(spark, 1), f"{folder}/t", 0, ["nothere"])


def test_partitioned_replace(spark, folder):
    tables.replace_table(rows(spark, *range(30)), f"{folder}/t", 0, ["third"])
    assert child_folders(spark, f"{folder}/t/version=0") == ["third=0", "third=1", "third=2"]
    assert content(tables.read_table(spark, f"{folder}/t").filter("third = 1")) == list(range(1, 30, 3))


def test_an_empty_replacement_is_refused_and_the_old_version_stays(spark, folder):
    tables.replace_table(rows(spark, 1), f"{folder}/t", 0)
    for partitions in ([], ["third"]):
        with pytest.raises(ValueError, match="nothing to write"):
            tables.replace_table(rows(spark, 1).filter("v > 1"), f"{folder}/t", 1, partitions)
    assert content(tables.read_table(spark, f"{folder}/t")) == [1]


def test_an_incomplete_version_is_not_read(spark, folder):
    tables.replace_table(rows(spark, 1), f"{folder}/t", 0)
    tables.replace_table(rows(spark, 2), f"{folder}/t", 1)
    os.remove(f"{folder}/t/version=1/_SUCCESS")
    assert content(tables.read_table(spark, f"{folder}/t")) == [1]


def test_a_table_can_replace_itself(spark, folder):
    tables.replace_table(rows(spark, 1, 2), f"{folder}/t", 0)
    tables.replace_table(tables.read_table(spark, f"{folder}/t").filter("v = 2"), f"{folder}/t", 1)
    assert content(tables.read_table(spark, f"{folder}/t")) == [2]


def test_distinct_rows_accumulate(spark, folder):
    for batch, values in enumerate(((1, 2), (2, 3), (3, 2, 1), (3, 4, 4))):
        tables.extend_distinct(rows(spark, *values), f"{folder}/t", batch)
    assert content(tables.read_table(spark, f"{folder}/t")) == [1, 2, 3, 4]
    # Known rows write nothing, and new ones only themselves.
    assert [name for name in child_folders(spark, f"{folder}/t") if name.startswith("batch_id=")] == [
        "batch_id=0", "batch_id=1", "batch_id=3",
    ]
    assert content(tables.read_batch(spark, f"{folder}/t", 3)) == [4]
    for _ in range(2):  # a batch tried again
        tables.extend_distinct(rows(spark, 3, 4, 5), f"{folder}/t", tables.Origin("s", 3))
    nothing = spark.createDataFrame([(None, None)], "v int, third int")
    for batch in (5, 6):
        tables.extend_distinct(nothing, f"{folder}/t", batch)
    found = tables.read_table(spark, f"{folder}/t").collect()
    assert sorted(str(row.v) for row in found) == ["1", "2", "3", "4", "5", "None"]


def test_columns_may_come_and_go(spark, folder):
    tables.append_batch(rows(spark, 1), f"{folder}/t", 0)
    tables.append_batch(rows(spark, 2).drop("third").withColumn("more", F.lit("x")), f"{folder}/t", 1)
    found = {row.v: (row.third, row.more) for row in tables.read_table(spark, f"{folder}/t").collect()}
    assert found == {1: (1, None), 2: (None, "x")}


def test_preview(spark, folder):
    gold = tables.layer_path(folder, "gold", DEMAND_TOPIC)
    tables.append_batch(rows(spark, 1, 2), f"{gold}/Facts", 0)
    os.makedirs(f"{gold}/Broken")
    assert {name: table.count() for name, table in tables.show_gold(spark, folder, DEMAND_TOPIC, 1).items()} == {"Facts": 2}
    with pytest.raises(ValueError, match="unknown topic"):
        tables.preview_gold(spark, folder, "else")
    with pytest.raises(FileNotFoundError):
        tables.preview_gold(spark, f"{folder}/none", DEMAND_TOPIC)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{gold}/Broken")


def test_archive_of_documents(spark, folder):
    for name in ("t1/20250703T082524_" + "a" * 32 + ".json", "topic=t2/other.txt"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"))
        with open(f"{folder}/{name}", "w") as file:
            file.write('{\n  "a": 1\n}')
    found = {row.topic: (row.value, str(row.archived_at)) for row in archive.read_documents(spark, folder).collect()}
    assert found == {"t1": ('{\n  "a": 1\n}', "2025-07-03 08:25:24"), "t2": ('{\n  "a": 1\n}', "None")}


def test_archive_is_written_a_document_a_file(spark, folder):
    texts = ["{}", "{}", '{\n  "ü": 1\n}', None]
    rows = spark.createDataFrame([(text,) for text in texts], "value string").repartition(2)
    for _ in range(2):
        archive.write_documents(rows, "t", f"file:{folder}")
    written = os.listdir(f"{folder}/topic=t")
    assert len(written) == 8 and all(name.endswith(".json") for name in written)
    found = archive.read_documents(spark, folder).collect()
    assert sorted(row.value for row in found) == sorted(f"{text or ''}\n" for text in texts * 2)
    assert {row.topic for row in found} == {"t"} and all(row.archived_at for row in found)


def test_archive_on_storage_unknown_to_arrow(spark, folder, monkeypatch):
    monkeypatch.setattr(archive, "_opens", lambda location: False)
    archive.write_documents(spark.createDataFrame([("{}",), ("[]",)], "value string"), "t", folder)
    assert sorted(row.value for row in archive.read_documents(spark, folder).collect()) == ["[]\n", "{}\n"]


AWKWARD = [("t", '{\r\n"a":\n1}'), ("t", '{"a":"x\ny"}'), ("t", "broken\n"), ("t", None), ("u", "{}")]


def landed(spark, folder):
    found = topics.landed_messages(spark, folder).select("topic", "value").collect()
    return sorted(map(tuple, found), key=str)


def test_landed_messages_stay_as_they_are(spark, folder):
    sent = spark.createDataFrame(AWKWARD, "topic string, value string")
    topics.land_messages(sent, folder)
    assert landed(spark, folder) == sorted(AWKWARD, key=str)
    topics.land_messages(sent, folder)
    assert landed(spark, folder) == sorted(AWKWARD * 2, key=str)


def test_a_batch_landed_again_is_there_once(spark, folder):
    sent = spark.createDataFrame(AWKWARD, "topic string, value string")
    for label in ("s-0", "s-0", "s-1"):
        topics.land_messages(sent, folder, label)
    assert landed(spark, folder) == sorted(AWKWARD * 2, key=str)
    # A try that ended before it was marked is replaced.
    os.remove(f"{folder}/_landed/s-1")
    topics.land_messages(sent, folder, "s-1")
    assert landed(spark, folder) == sorted(AWKWARD * 2, key=str)


def test_landings_of_text_lines(spark, folder):
    sent = spark.createDataFrame([("t", "{}"), ("u", "[]")], "topic string, value string")
    sent.write.partitionBy("topic").text(f"{folder}/lines")
    found = topics.landed_messages(spark, f"{folder}/lines", topics.LINES).select("topic", "value").collect()
    assert sorted(map(tuple, found)) == [("t", "{}"), ("u", "[]")]


def test_broker_without_connector(spark):
    with pytest.raises(RuntimeError, match="connector"):
        topics.broker_stream(spark, "localhost:1")


def test_an_incomplete_batch_is_not_read(spark, folder):
    tables.append_batch(rows(spark, 1), f"{folder}/t", 0)
    tables.append_batch(rows(spark, 2), f"{folder}/t", tables.Origin("other", 0))
    assert content(tables.read_table(spark, f"{folder}/t")) == [1, 2]
    os.remove(f"{folder}/t/batch_id=other-0/_SUCCESS")
    assert content(tables.read_table(spark, f"{folder}/t")) == [1]


def test_a_table_of_many_batches_is_found_in_one_request(spark, folder, monkeypatch):
    for batch in range(30):
        tables.append_batch(rows(spark, batch).coalesce(1), f"{folder}/t", batch)
    requests = []
    for name in ("exists", "child_folders", "matches_with_time", "read_text"):
        call = getattr(tables, name)
        monkeypatch.setattr(tables, name, lambda *a, call=call, name=name: requests.append(name) or call(*a))
    assert content(tables.read_table(spark, f"{folder}/t")) == list(range(30))
    assert len(requests) <= 5


MATERIAL = DimSpec(keys=("k",), compare=("v",))


def test_a_snapshot_with_a_repeated_key_is_refused(spark, folder):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        tables.merge_dimension(twice, f"{folder}/d", MATERIAL, "2024-01-01", 0)


def test_a_legacy_table_is_taken_up_by_the_merge(spark, folder):
    spark.createDataFrame([(1, "old"), (2, "same")], "k int, v string").write.parquet(f"{folder}/d")
    snapshot = spark.createDataFrame([(1, "new"), (2, "same")], "k int, v string")
    for batch in range(2):
        tables.merge_dimension(snapshot, f"{folder}/d", MATERIAL, f"2024-01-0{batch + 1}", tables.Origin("s", batch))
    found = {(row.k, row.v, row.IsCurrent) for row in tables.read_table(spark, f"{folder}/d").collect()}
    assert found == {(1, "old", False), (1, "new", True), (2, "same", True)}
    assert {"closed", "open"} <= set(child_folders(spark, f"{folder}/d"))
