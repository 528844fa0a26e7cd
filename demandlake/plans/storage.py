"""Queries that write layer tables, in batch or as a stream, and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.contracts import COMMENTS_TOPIC, DEMAND_TOPIC
from demandlake.operators import gold, layout
from demandlake.plans import layers
from demandlake.plans import sample_messages as sample
from demandlake.plans import sql_parts as sql
from demandlake.session import scratch_path, shuffles_dropped
from demandlake.sources import tables, topics
from demandlake.sources.files import delete_folder
from demandlake.streaming.forwarder import quarantine_path, start_forwarder
from demandlake.streaming.medallion import start_medallion

_LOADED_AT = "2024-01-01 00:00:00"
_MICRO_BATCHES = 3
# A batch takes several times the disk of its landed files while it is worked on.
_BYTES_PER_BATCH = 2**30


def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a table partitioned by month, and report what each partition holds."""
    location = f"{scratch_path(spark, 'partitioned')}/demand"
    rows = layout.month_partition(layers.bronze_demand(spark, sf_dir))
    tables.replace_table(rows, location, 1, [layout.MONTH])
    return (
        tables.read_table(spark, location)
        .groupBy(F.col(layout.MONTH).cast("string").alias("month"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("materialDemandId").alias("demands"))
    )


def default_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of the default flat layout."""
    rows = layers.bronze_capacity(spark, sf_dir)
    return rows.groupBy(*layout.default_partitions(rows.columns)).agg(F.count(F.lit(1)).alias("row_count"))


def detect_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of the layout detected for the demand facts."""
    facts = gold.fact_material_demand(layers.silver_demand(spark, sf_dir))
    return facts.groupBy(*layout.detect_partitions(facts.columns)).agg(F.count(F.lit(1)).alias("row_count"))


def schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of one table, the later with a column more and a column less."""
    location = f"{scratch_path(spark, 'evolving')}/partners"
    customers = sample.table(spark, sf_dir, "customer")
    suppliers = sample.table(spark, sf_dir, "supplier")
    tables.append_batch(customers.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), location, 0)
    tables.append_batch(suppliers.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")), location, 1)
    return tables.read_table(spark, location).select("name", "segment", F.col("nation").cast("bigint").alias("nation"))


def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of one table, read as if the later had replaced the earlier."""
    location = f"{scratch_path(spark, 'latest')}/names"
    tables.append_batch(sample.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")), location, 0)
    tables.append_batch(sample.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name")), location, 1)
    return tables.read_latest_batch(spark, location)


def schema_merge_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same union without storage in between."""
    customers = sample.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = sample.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return layout.merge_schemas(customers, suppliers)


def _land(spark: SparkSession, messages: DataFrame, location: str) -> None:
    """Land messages and leave no shuffle files of their making."""
    with shuffles_dropped(spark):
        topics.land_messages(messages, location)


def _run_medallion(spark: SparkSession, messages: DataFrame, label: str, **reading: object) -> str:
    """Land messages and stream them through all layers; returns the lake's folder."""
    base = scratch_path(spark, label)
    _land(spark, messages, f"{base}/landing")
    _stream_again(spark, base, **reading)
    return base


def _stream_again(spark: SparkSession, base: str, **reading: object) -> None:
    """Stream what has landed; `reading` are options of `topic_stream`."""
    source = topics.topic_stream(spark, f"{base}/landing", **reading)
    query = start_medallion(source, f"{base}/lake", f"{base}/checkpoint", as_of=lambda batch: _LOADED_AT)
    query.awaitTermination()


def stream_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all topics through all layers; returns the demand facts.

    A backlog is taken in micro-batches, and the landed files of one go when the next begins: as the lake grows, what
    is yet to be read shrinks.
    """
    messages = sample.all_messages(spark, sf_dir)
    base = _run_medallion(spark, messages, "medallion", bytes_per_batch=_BYTES_PER_BATCH, consume=True)
    facts = tables.read_table(spark, tables.layer_path(f"{base}/lake", "gold", DEMAND_TOPIC, "FactMaterialDemand"))
    return facts.drop(layout.MONTH)


def stream_micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand messages in several micro-batches; returns the dimension merged over all of them."""
    messages = sample.demand_messages(spark, sf_dir)
    base = scratch_path(spark, "micro-batches")
    # As many files as there are cores to write them, two at least for each micro-batch.
    files_per_batch = max(2, -(-spark.sparkContext.defaultParallelism // _MICRO_BATCHES))
    _land(spark, messages.repartition(_MICRO_BATCHES * files_per_batch), f"{base}/landing")
    _stream_again(spark, base, files_per_batch=files_per_batch)
    customers = tables.layer_path(f"{base}/lake", "gold", DEMAND_TOPIC, "DimCustomer")
    return tables.read_table(spark, customers).select("CustomerBPNL", "IsCurrent", "ValidTo")


def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream twice over the same messages; the second run finds nothing to do."""
    base = _run_medallion(spark, sample.comment_messages(spark, sf_dir), "available-now")
    lake = f"{base}/lake"
    _stream_again(spark, base)
    stored = {
        layer: tables.read_table(spark, tables.layer_path(lake, layer, COMMENTS_TOPIC, name))
        for layer, name in (("bronze", None), ("silver", None), ("gold", "Comments"))
    }
    return gold.row_counts(stored).drop("column_count")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream put aside, by reason."""
    base = _run_medallion(spark, sample.comment_messages(spark, sf_dir), "quarantine")
    aside = [tables.read_table(spark, f"{base}/lake/quarantine/{name}") for name in (COMMENTS_TOPIC, "unknown_topic")]
    return reduce(DataFrame.unionByName, aside).select("topic", "value", "reason")


def stream_second_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with a checkpoint each fill one lake; rows per table and customer of what both left there."""
    base = scratch_path(spark, "second-checkpoint")
    first, second = sample.stored_demand_halves(spark, sf_dir, "two-halves", f"{base}/halves")
    for name, part in (("first", first), ("second", second)):
        _land(spark, part, f"{base}/{name}")
        if part is second:
            delete_folder(spark, f"{base}/halves")
        source = topics.topic_stream(spark, f"{base}/{name}")
        start_medallion(source, f"{base}/lake", f"{base}/checkpoint-{name}", as_of=lambda batch: _LOADED_AT).awaitTermination()
    lake = f"{base}/lake"
    left = {
        "bronze": (tables.read_table(spark, tables.layer_path(lake, "bronze", DEMAND_TOPIC)), "customer"),
        "DimCustomer": (tables.read_table(spark, tables.layer_path(lake, "gold", DEMAND_TOPIC, "DimCustomer")), "CustomerBPNL"),
        "FactMaterialDemand": (
            tables.read_table(spark, tables.layer_path(lake, "gold", DEMAND_TOPIC, "FactMaterialDemand")),
            "CustomerBPNL",
        ),
    }
    counts = [
        frame.groupBy(F.lit(name).alias("table_name"), F.col(key).alias("customer")).agg(F.count(F.lit(1)).alias("row_count"))
        for name, (frame, key) in left.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials described by finished orders, then in a second batch by the others: their whole history."""
    base = scratch_path(spark, "history")
    finished, others = sample.stored_demand_halves(spark, sf_dir, "history-halves", f"{base}/halves")
    for part in (finished, others):
        _land(spark, part, f"{base}/landing")
        if part is others:
            delete_folder(spark, f"{base}/halves")
        source = topics.topic_stream(spark, f"{base}/landing")
        moment = lambda batch: f"2024-01-{batch + 1:02d} 00:00:00"
        start_medallion(source, f"{base}/lake", f"{base}/checkpoint", as_of=moment).awaitTermination()
    materials = tables.read_table(spark, tables.layer_path(f"{base}/lake", "gold", DEMAND_TOPIC, "DimMaterial"))
    text = "yyyy-MM-dd HH:mm:ss"
    return materials.select(
        "MaterialNumberCustomer",
        "MaterialNumberSupplier",
        "MaterialDescription",
        "UnitOfMeasure",
        F.date_format("ValidFrom", text).alias("ValidFrom"),
        F.date_format("ValidTo", text).alias("ValidTo"),
        "IsCurrent",
    )


def _run_forwarder(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "outbox")
    topics.land_messages(sample.comment_messages(spark, sf_dir), f"{base}/landing")
    source = topics.topic_stream(spark, f"{base}/landing", positions=True)
    target = {COMMENTS_TOPIC: "target/comments"}
    start_forwarder(source, f"{base}/outbox", f"{base}/checkpoint", ["folder-1"], "tenant-1", target).awaitTermination()
    return f"{base}/outbox"


def stream_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments through the outbox stream; returns the number of payloads and chunks per target."""
    chunks = tables.read_table(spark, _run_forwarder(spark, sf_dir))
    return chunks.groupBy("topic", "target").agg(
        F.sum("payload_count").alias("payloads"), F.count(F.lit(1)).alias("chunks")
    )


def stream_outbox_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the outbox stream put aside, with the reasons."""
    return tables.read_table(spark, quarantine_path(_run_forwarder(spark, sf_dir)))


def preview_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the gold tables of demand, list them as the preview does, and count their rows."""
    lake = scratch_path(spark, "preview")
    rows = layers.silver_demand(spark, sf_dir)
    stored = tables.append_batch(rows, tables.layer_path(lake, "silver", DEMAND_TOPIC), 0)
    for name, frame in gold.gold_tables(stored, DEMAND_TOPIC).items():
        tables.append_batch(frame, tables.layer_path(lake, "gold", DEMAND_TOPIC, name), 0)
    return gold.row_counts(tables.preview_gold(spark, lake, DEMAND_TOPIC))


QUERIES = {
    "write_partitioned": write_partitioned,
    "default_partitions": default_partitions,
    "detect_partitions": detect_partitions,
    "schema_merge": schema_merge,
    "schema_merge_frames": schema_merge_frames,
    "latest_batch": latest_batch,
    "preview_counts": preview_counts,
    "stream_medallion": stream_medallion,
    "stream_micro_batches": stream_micro_batches,
    "stream_available_now": stream_available_now,
    "stream_quarantine": stream_quarantine,
    "stream_outbox": stream_outbox,
    "stream_outbox_quarantine": stream_outbox_quarantine,
    "stream_second_checkpoint": stream_second_checkpoint,
    "stream_history": stream_history,
}

_PARTNERS = """SELECT c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer
    UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier"""

ORACLES = {
    "write_partitioned": f"""WITH {sql.DEMAND}
        SELECT substr("pointInTime", 1, 7) AS month, count(*) AS row_count, count(DISTINCT "materialDemandId") AS demands
        FROM demand GROUP BY 1""",
    "default_partitions": f"""WITH {sql.CAPACITY}
        SELECT "capacityGroupId", "pointInTime", count(*) AS row_count FROM capacity GROUP BY 1, 2""",
    "detect_partitions": f"""WITH {sql.DEMAND}
        SELECT "pointInTime" AS "PointInTime", "changedAt" AS "ChangedAt", customer AS "CustomerBPNL", count(*) AS row_count
        FROM demand GROUP BY 1, 2, 3""",
    "schema_merge": _PARTNERS,
    "schema_merge_frames": _PARTNERS,
    "latest_batch": "SELECT s_name AS name FROM supplier",
    "preview_counts": layers.ORACLES["gold_fanout_counts"],
    "stream_medallion": layers.ORACLES["fact_material_demand"],
    "stream_micro_batches": f"""WITH {sql.DEMAND}
        SELECT DISTINCT customer AS "CustomerBPNL", true AS "IsCurrent", '9999-12-31 23:59:59' AS "ValidTo" FROM demand""",
    "stream_available_now": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT table_name, count(*) AS row_count FROM comment_messages, (VALUES ('bronze'), ('silver'), ('gold')) AS t(table_name)
        WHERE reason IS NULL GROUP BY table_name""",
    "stream_quarantine": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT topic, value, reason FROM comment_messages WHERE reason IS NOT NULL""",
    "stream_outbox_quarantine": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT topic, value, reason FROM comment_messages WHERE reason IS NOT NULL""",
    "stream_second_checkpoint": f"""WITH {sql.DEMAND}
        SELECT table_name, customer, count(*) AS row_count FROM demand, (VALUES ('bronze'), ('FactMaterialDemand')) AS t(table_name)
        GROUP BY table_name, customer
        UNION ALL SELECT DISTINCT 'DimCustomer', customer, 1 FROM demand""",
    "stream_history": f"""WITH {sql.DEMAND},
        latest AS (
            SELECT "materialDemandIsInactive" AS finished, "materialNumberCustomer" AS "MaterialNumberCustomer",
                   "materialNumberSupplier" AS "MaterialNumberSupplier",
                   "materialDescriptionCustomer" AS "MaterialDescription", "unitOfMeasure" AS "UnitOfMeasure"
            FROM demand
            QUALIFY row_number() OVER (PARTITION BY "materialDemandIsInactive", "materialNumberCustomer" ORDER BY "changedAt" DESC, "materialDescriptionCustomer" DESC) = 1
        ),
        earlier AS (SELECT * EXCLUDE (finished) FROM latest WHERE finished),
        later AS (SELECT * EXCLUDE (finished) FROM latest WHERE NOT finished)
        SELECT earlier.*, '2024-01-01 00:00:00' AS "ValidFrom",
               CASE WHEN later."MaterialDescription" <> earlier."MaterialDescription" THEN '2024-01-02 00:00:00'
                    ELSE '9999-12-31 23:59:59' END AS "ValidTo",
               coalesce(later."MaterialDescription" = earlier."MaterialDescription", true) AS "IsCurrent"
        FROM earlier LEFT JOIN later USING ("MaterialNumberCustomer")
        UNION ALL
        SELECT later.*, '2024-01-02 00:00:00', '9999-12-31 23:59:59', true
        FROM later LEFT JOIN earlier USING ("MaterialNumberCustomer")
        WHERE earlier."MaterialDescription" IS DISTINCT FROM later."MaterialDescription" """,
    "stream_outbox": f"""WITH {sql.COMMENT_MESSAGES}
        SELECT topic, 'target/comments' AS target, count(*) AS payloads, (count(*) + 99) // 100 AS chunks
        FROM comment_messages WHERE reason IS NULL GROUP BY topic""",
}
