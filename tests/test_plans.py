"""Plans stay on the JVM side, scan what they need, and survive hot keys."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandlake.contracts import COMMENTS_TOPIC, DEMAND_TOPIC
from demandlake.operators import bronze, gold
from demandlake.operators import messages as msg
from demandlake.operators import validation as val
from demandlake.plans import ingest, storage
from demandlake.plans import sample_messages as sample
from demandlake.plans.registry import all_queries
from demandlake.session import scratch_path
from demandlake.sources import archive
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")

def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_facts_scan_only_their_columns(spark):
    text = plan(gold.dim_time(bronze.bronze_demand(sample.demand_documents(spark, SF_DIR))))
    assert "l_discount" not in text and "l_extendedprice" not in text


def test_stored_silver_is_pruned_and_filtered_at_the_scan(spark, folder):
    silver = spark.createDataFrame([("a", "b", 1)], "customer string, supplier string, demand int")
    silver.write.parquet(f"{folder}/silver")
    text = plan(gold.dim_customer(spark.read.parquet(f"{folder}/silver")))
    assert "ReadSchema: struct<customer:string>" in text
    assert "IsNotNull(customer)" in text


def test_texts_are_parsed_once(spark, folder):
    requests = spark.createDataFrame([("1", "/comments", "{}")], "request_id string, endpoint string, body string")
    requests.write.parquet(f"{folder}/requests")
    stored = spark.read.parquet(f"{folder}/requests")
    outputs = (val.request_disposition, val.validation_errors, val.accepted_messages, val.checked_requests)
    for frame in (output(stored) for output in outputs):
        # Lists are read by one of the two, all other bodies by the other.
        steps = [line for line in plan(frame).splitlines() if "FileScan" not in line]
        assert sum(line.lower().count("parsejson") for line in steps) == 1
        assert sum(line.count("from_json(") for line in steps) == 1
        assert "Exchange" not in plan(frame)


def test_a_batch_of_requests_is_checked_once(spark, folder, monkeypatch):
    """All outputs of the ingest stream come from one checked pass over its source."""
    from demandlake.streaming import ingest as stream

    calls = []
    check = val.check_requests
    monkeypatch.setattr(val, "check_requests", lambda requests: calls.append(1) or check(requests))
    requests = spark.createDataFrame([("1", "/comments", "{}")], "request_id string, endpoint string, body string")
    stream.ingest_batch(requests, 0, f"{folder}/landing", f"{folder}/reports")
    assert calls == [1]


def test_a_micro_batch_is_read_once(spark, folder):
    """The source is scanned in one pass, however many topics it holds; topics read their own folders."""
    from demandlake.streaming import medallion

    rows = [(COMMENTS_TOPIC, "{}"), (DEMAND_TOPIC, "{}"), ("else", "x"), (None, "y")]
    reads = spark.sparkContext.accumulator(0)

    def counted(value, topic):
        reads.add(1)
        return value

    source = spark.createDataFrame(rows, "topic string, value string")
    source = source.withColumn("value", F.udf(counted, "string")("value", "topic"))
    staged = medallion.stage_by_topic(msg.decode_messages(source), f"{folder}/staged")
    assert set(staged) == {"comments", "demand", None}
    for folder_name, frame in staged.items():
        frame.collect()
        assert all(f"/folder={folder_name or '__HIVE_DEFAULT_PARTITION__'}/" in file for file in frame.inputFiles())
    assert reads.value == len(rows)
    assert sorted(map(tuple, staged[None].select("topic", "value").collect()), key=str) == [("else", "x"), (None, "y")]


def test_messages_are_parsed_once_and_without_a_shuffle(spark, folder):
    spark.createDataFrame([(COMMENTS_TOPIC, "{}")], "topic string, value string").write.parquet(f"{folder}/m")
    stored = spark.read.parquet(f"{folder}/m")
    flat = bronze.bronze_demand(msg.parse_messages(stored, DEMAND_TOPIC))
    for frame in (msg.parse_messages(stored, COMMENTS_TOPIC), flat, msg.quarantine_messages(stored, COMMENTS_TOPIC)):
        # A scan repeats its filters in its description.
        steps = [line for line in plan(frame).splitlines() if "FileScan" not in line]
        assert sum(line.count("from_json(") for line in steps) == 1
        assert "Exchange" not in plan(frame)
    assert plan(msg.quarantine_all(stored)).count("FileScan") == 1


@pytest.fixture
def hot_tables(spark, folder):
    """Orders where one order and one supplier hold a third of all lines."""
    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).cast("bigint").alias("l_orderkey"),
        (F.col("id") + 8).alias("l_partkey"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).cast("bigint").alias("l_suppkey"),
        F.col("id").cast("int").alias("l_linenumber"),
        F.col("id").cast("double").alias("l_quantity"),
        F.lit(0.5).alias("l_discount"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 30 AS int))").alias("l_shipdate"),
    )
    orders = spark.range(1, 502).select(
        F.col("id").alias("o_orderkey"),
        F.col("id").alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    suppliers = spark.range(1, 42).select(
        F.col("id").alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(1).alias("s_nationkey"), F.lit(1.0).alias("s_acctbal")
    )
    for name, frame in (("lineitem", lines), ("orders", orders), ("supplier", suppliers)):
        frame.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_hot_source_is_split_over_messages_and_stays_whole(spark, hot_tables):
    documents = sample.demand_documents(spark, hot_tables)
    sizes = documents.select(F.aggregate("demandSeries", F.lit(0), lambda n, s: n + F.size(s["demands"])).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= sample.LINE_NUMBERS_PER_MESSAGE
    rows = bronze.bronze_demand(documents)
    assert rows.count() == 9000
    assert rows.select("demand").distinct().count() == 9000
    assert rows.filter("materialDemandId = '1'").select("supplier", "materialNumberCustomer").distinct().count() == 1


def test_a_hot_supplier_stays_whole(spark, hot_tables):
    rows = bronze.bronze_capacity(sample.capacity_documents(spark, hot_tables))
    assert rows.count() == 9000 and rows.select("agreedCapacity").distinct().count() == 9000


@pytest.mark.parametrize("name", ["route_topics", "partner_disposition"])
def test_message_counts_of_hot_sources_match_sql(spark, hot_tables, name):
    spark.range(50).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"),
        F.col("id").alias("user_id"),
        F.lit("click").alias("event_type"),
    ).write.parquet(f"{hot_tables}/events.parquet")
    assert differences(ingest.QUERIES[name](spark, hot_tables), hot_tables, ingest.ORACLES[name]) == []


def test_stored_halves_follow_the_flag_in_the_text(spark, tmp_path):
    tables_of = {
        "orders": "VALUES (1, 10, 'F', timestamp'2024-01-01', '1-URGENT'), (2, 11, 'O', timestamp'2024-01-01', '5-LOW'), "
        "(3, 12, NULL, timestamp'2024-01-01', NULL), (3, 12, 'F', timestamp'2024-01-02', '5-LOW')",
        "lineitem": "VALUES (1, 5, 6, 1, 2.0D, 'R', 'F', timestamp'2024-02-01'), (3, 5, 6, 1, 3.0D, 'N', 'O', NULL)",
    }
    names = {
        "orders": "o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority",
        "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate",
    }
    for name, values in tables_of.items():
        spark.sql(f"SELECT * FROM ({values}) AS t({names[name]})").write.parquet(f"{tmp_path}/{name}.parquet")
    texts = sample.demand_messages(spark, str(tmp_path))
    flag = F.get_json_object("value", "$.materialDemandIsInactive")
    halves = sample.stored_demand_halves(spark, str(tmp_path), "halves")
    for half, expected in zip(halves, ("true", "false")):
        assert sorted(map(tuple, half.collect())) == sorted(map(tuple, texts.filter(flag == expected).collect()))
        assert "get_json_object" not in plan(half)


@needs_tables
def test_micro_batches_are_landed_by_as_many_tasks_as_there_are_cores(spark):
    base = Path(scratch_path(spark, "x")).parent
    before = set(base.glob("micro-batches-*"))
    storage.stream_micro_batches(spark, SF_DIR)
    (run,) = set(base.glob("micro-batches-*")) - before
    assert len(list(run.glob("landing/topic=*/*/*.parquet"))) >= spark.sparkContext.defaultParallelism
    assert len([path for path in run.glob("checkpoint/commits/*") if path.name.isdigit()]) == 3


def test_an_archive_is_written_and_read_in_parts(spark, tmp_path, monkeypatch):
    """No part lies on disk beside another, and what they hold is counted as a whole."""
    days = [(order, f"2024-01-{order % 28 + 1:02d}") for order in range(0, 60_000, 10_000)]
    lines = [(order, 5, supplier, 1, 2.0, 0.5, day) for supplier in (1, 2) for order, day in days]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate string"
    spark.createDataFrame(lines, names).withColumn("l_shipdate", F.to_timestamp("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    suppliers = [(key, f"Supplier {key}", 3, 1.0) for key in (1, 2, 3)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")

    lying, write = [], archive.write_documents

    def watched(part, topic, location):
        write(part, topic, location)
        lying.append(len(list(Path(location).parent.glob("archive*/topic=*/*.json"))))

    monkeypatch.setattr(archive, "write_documents", watched)
    monkeypatch.setattr(archive, "PART_BYTES", 1, raising=False)
    monkeypatch.setattr(ingest, "_DOCUMENTS_PER_FILE", 1, raising=False)
    found = ingest.archive_read(spark, str(tmp_path)).collect()
    # Two suppliers with a message per block of order numbers, and one without a line.
    assert lying == [1] * 13
    assert sorted((*row[:3], str(row[3])) for row in found) == [("CG-1", "Supplier 1", 6, "2024-01-21"), ("CG-2", "Supplier 2", 6, "2024-01-21")]


@needs_tables
def test_the_stream_takes_a_backlog_in_batches_that_go(spark, monkeypatch):
    base = Path(scratch_path(spark, "x")).parent
    before = set(base.glob("medallion-*"))
    monkeypatch.setattr(storage, "_BYTES_PER_BATCH", 1, raising=False)
    facts = all_queries()["stream_medallion"](spark, SF_DIR)
    (run,) = set(base.glob("medallion-*")) - before
    assert len([path for path in run.glob("checkpoint/commits/*") if path.name.isdigit()]) > 1
    # Each batch took a file, and that of the last stays until another follows.
    assert len(list(run.glob("landing/topic=*/*/*.parquet"))) == 1
    assert differences(facts, SF_DIR, storage.ORACLES["stream_medallion"]) == []


@needs_tables
@pytest.mark.parametrize("name, label", [("stream_second_checkpoint", "second-checkpoint"), ("stream_history", "history")])
def test_stored_halves_go_when_they_have_landed(spark, name, label, monkeypatch):
    base = Path(scratch_path(spark, "x")).parent
    before = set(base.glob(f"{label}-*")) | set(base.glob("*-halves-*"))
    frame = all_queries()[name](spark, SF_DIR)
    (run,) = (set(base.glob(f"{label}-*")) | set(base.glob("*-halves-*"))) - before
    assert not (run / "halves").exists()
    assert differences(frame, SF_DIR, storage.ORACLES[name]) == []
