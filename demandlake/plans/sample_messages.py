"""Domain messages made from the given tables, so that every operator runs on data that grows with them.

Orders become demand messages, suppliers become capacity messages, events become comments and
ingest requests. The rules are plain enough to be repeated in SQL.

A message is one JSON document and so has to fit one row. An order sends one message per
`LINE_NUMBERS_PER_MESSAGE` line numbers and a supplier one per `ORDER_NUMBERS_PER_MESSAGE` order
numbers, all with the same header. The rule looks at no size, so every source follows it alike; a
message stays small as long as an order uses its line numbers for a few lines each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.contracts import CAPACITY_TOPIC, COMMENTS_TOPIC, DEMAND_TOPIC
from demandlake.session import scratch_path, shuffles_dropped
from demandlake.sources.files import COMPACT

LINE_NUMBERS_PER_MESSAGE = 1000
ORDER_NUMBERS_PER_MESSAGE = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, frame: DataFrame, label: str, location: str | None = None, **options: object) -> DataFrame:
    """Write a frame to the scratch folder, or to a `location` that the caller deletes, and read it back.

    Texts are stored before they are parsed, as real ones are; made and parsed in one plan, the
    optimiser would merge both steps and measure neither. `options` are the writer's.
    """
    location = location or scratch_path(spark, label)
    with shuffles_dropped(spark):
        frame.write.options(**{**COMPACT, **options}).parquet(location)
    return spark.read.schema(frame.schema).parquet(location)


def partner(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 12, "0"))


def _day(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")


def _moment(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _with_bodies(headers: DataFrame, bodies: DataFrame, owner: str) -> DataFrame:
    """One message per body, and one without a body for each header whose source has no lines.

    A source with very many lines has many bodies but one header, so only the bodies can be skewed,
    and an inner join lets adaptive execution split them. The hint keeps whole message bodies, whose
    size is easily underestimated, from being broadcast.
    """
    filled = headers.filter("has_lines").join(bodies.hint("merge"), owner)
    return filled.unionByName(headers.filter("NOT has_lines"), allowMissingColumns=True).drop("has_lines", owner, "block")


# --- Demand -------------------------------------------------------------------------------------


def demand_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand messages as typed documents: orders with their lines grouped into series."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    first = lines.groupBy("l_orderkey").agg(F.min(F.struct("l_partkey", "l_suppkey")).alias("first"))
    entry = F.struct(F.col("l_quantity").alias("demand"), _day(F.col("l_shipdate")).alias("pointInTime"))
    series = F.struct(
        F.concat(F.lit("BPNS-"), "l_linestatus").alias("customerLocation"),
        F.when(F.col("l_linestatus") != "O", F.concat(F.lit("BPNS-"), "l_returnflag")).alias("expectedSupplierLocation"),
        F.struct(F.col("l_returnflag").alias("demandCategoryCode")).alias("demandCategory"),
        F.col("demands"),
    )
    # Placed by order and block once; both groupings reuse that placement.
    grouped = (
        lines.withColumn("block", F.expr(f"l_linenumber div {LINE_NUMBERS_PER_MESSAGE}"))
        .repartition("l_orderkey", "block")
        .groupBy("l_orderkey", "block", "l_returnflag", "l_linestatus")
        .agg(F.collect_list(entry).alias("demands"))
        .groupBy("l_orderkey", "block")
        .agg(F.collect_list(series).alias("demandSeries"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    part_key = F.col("first.l_partkey")
    unit = F.when(F.col("o_orderpriority") != "5-LOW", "unit:piece")
    headers = (
        orders.join(first, orders.o_orderkey == first.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("first").isNotNull().alias("has_lines"),
            F.col("o_orderkey").cast("string").alias("materialDemandId"),
            F.concat(F.lit("MAT-"), part_key).alias("materialNumberCustomer"),
            F.when(part_key % 8 != 0, F.concat(F.lit("SUP-"), part_key)).alias("materialNumberSupplier"),
            F.concat(F.lit("Part "), part_key, F.lit(" in "), "o_orderpriority").alias("materialDescriptionCustomer"),
            F.when(part_key % 5 != 0, F.concat(F.lit("asset-"), part_key)).alias("materialGlobalAssetId"),
            partner("BPNL", F.col("o_custkey")).alias("customer"),
            partner("BPNL", F.col("first.l_suppkey")).alias("supplier"),
            _moment(F.col("o_orderdate")).alias("changedAt"),
            unit.alias("unitOfMeasure"),
            unit.isNull().alias("unitOfMeasureIsOmitted"),
            (F.col("o_orderstatus") == "F").alias("materialDemandIsInactive"),
        )
    )
    no_series = F.array().cast(grouped.schema["demandSeries"].dataType)
    return _with_bodies(headers, grouped, "l_orderkey").withColumn(
        "demandSeries", F.coalesce("demandSeries", no_series)
    )


# --- Capacity -----------------------------------------------------------------------------------


def capacity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity messages as typed documents: suppliers with their lines as capacities."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate"
    )
    linked = F.struct("l_partkey", "l_orderkey")
    ends = lines.groupBy("l_suppkey").agg(
        F.min(linked).alias("lowest"),
        F.max(linked).alias("highest"),
        F.min("l_shipdate").alias("since"),
        F.max("l_shipdate").alias("last"),
    )
    capacity = F.struct(
        _day(F.col("l_shipdate")).alias("pointInTime"),
        F.col("l_quantity").alias("agreedCapacity"),
        F.col("l_linenumber").cast("double").alias("actualCapacity"),
        (F.col("l_quantity") + 10).alias("maximumCapacity"),
        F.col("l_discount").alias("deltaProductionResult"),
    )
    grouped = (
        lines.withColumn("block", F.expr(f"l_orderkey div {ORDER_NUMBERS_PER_MESSAGE}"))
        .groupBy("l_suppkey", "block")
        .agg(F.collect_list(capacity).alias("capacities"))
    )

    key = F.col("s_suppkey")

    def series(end: str) -> Column:
        part = F.col(f"{end}.l_partkey")
        return F.struct(
            ((part % 5 + 1) / 2).alias("loadFactor"),
            F.concat(F.lit("MAT-"), part).alias("materialNumberCustomer"),
            F.when(part % 8 != 0, F.concat(F.lit("SUP-"), part)).alias("materialNumberSupplier"),
            F.concat(F.lit("BPNS-"), F.col("s_nationkey").cast("string")).alias("customerLocation"),
            F.struct(F.concat(F.lit("C"), (part % 4).cast("string")).alias("demandCategoryCode")).alias("demandCategory"),
        )

    def threshold(number: int) -> Column:
        return F.struct(
            F.lit(number).cast("bigint").alias("sequenceNumber"),
            (F.col("s_nationkey") % 9 + number).cast("bigint").alias("subhorizonLength"),
            (F.col("s_nationkey") + number).cast("double").alias("absoluteNegativeDeviation"),
            ((key % 7 + 1) / 8).alias("relativeNegativeDeviation"),
            F.col("s_acctbal").alias("absolutePositiveDeviation"),
            ((key % 3 + 1) / 4).alias("relativePositiveDeviation"),
        )

    thresholds = F.array(threshold(1), threshold(2))
    suppliers = table(spark, sf_dir, "supplier")
    headers = suppliers.join(ends, key == ends.l_suppkey, "left").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("lowest").isNotNull().alias("has_lines"),
        F.concat(F.lit("CG-"), key).alias("capacityGroupId"),
        F.col("s_name").alias("name"),
        partner("BPNL", key).alias("supplier"),
        partner("BPNL", F.col("s_nationkey")).alias("customer"),
        F.lit("unit:piece").alias("unitOfMeasure"),
        _moment(F.col("last")).alias("changedAt"),
        F.lit(False).alias("unitOfMeasureIsOmitted"),
        (key % 2 == 0).alias("capacityGroupIsInactive"),
        F.when(key % 3 != 0, F.array(F.concat(F.lit("CG-"), key + 1))).alias("linkedCapacityGroups"),
        F.when(key % 4 != 0, F.array(F.concat(F.lit("BPNS-"), key))).alias("supplierLocations"),
        F.when(
            key % 7 != 0,
            F.struct(
                (key % 6 + 1).cast("bigint").alias("measurementInterval"),
                _moment(F.col("since")).alias("startReferenceDateTime"),
                F.when(F.col("s_nationkey") % 5 != 0, thresholds)
                .otherwise(F.filter(thresholds, lambda _: F.lit(False)))
                .alias("rollingHorizonAlertThresholds"),
            ),
        ).alias("demandVolatilityParameters"),
        F.when(F.col("lowest").isNotNull(), F.array(series("lowest"), series("highest"))).alias("linkedDemandSeries"),
    )
    return _with_bodies(headers, grouped, "l_suppkey")


# --- Comments and requests ----------------------------------------------------------------------


def _uuid(text: Column) -> Column:
    digest = F.md5(text)
    return F.concat_ws(
        "-", *[F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    )


def comment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One good comment per event, with the event's id beside the contract's columns."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type").select(
        "event_id",
        F.concat(F.when(event % 2 == 1, "urn:uuid:").otherwise(""), _uuid(event.cast("string"))).alias("commentId"),
        _uuid(F.concat(F.lit("object-"), F.col("user_id").cast("string"))).alias("objectId"),
        F.concat(F.lit("urn:example:"), "event_type").alias("objectType"),
        partner("BPNL", F.col("user_id")).alias("customer"),
        partner("BPNL", event % 1000).alias("supplier"),
        F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.com")).alias("author"),
        _moment(F.col("ts")).alias("postedAt"),
        _moment(F.col("ts")).alias("changedAt"),
        F.concat(F.lit("Comment "), event, F.lit(" on "), "event_type").alias("commentText"),
        F.when(event % 3 == 0, "warning").otherwise("information").alias("commentType"),
        (event % 7 == 0).alias("requestDelete"),
        F.array(_day(F.col("ts")), F.lit("1999-12-31")).alias("listOfReferenceDates"),
    )


# Faults of request items, by event_id % 20; the other remainders are good items.
FAULTS = {
    0: "objectId missing",
    1: "commentId no uuid",
    2: "customer no partner number",
    3: "commentType unknown",
    4: "requestDelete a string",
    5: "listOfReferenceDates with duplicates",
    6: "commentText of 5001 characters",
    7: "author null",
    8: "listOfReferenceDates with a number",
    9: "commentType a number",
}


def request_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingest item per event, `(event_id, item)` with the item as JSON text, half of them faulty."""
    comments = comment_documents(spark, sf_dir)
    fault = F.col("event_id") % 20
    faulty = comments.withColumns(
        {
            "objectId": F.when(fault != 0, F.col("objectId")),
            "commentId": F.when(fault == 1, "not-a-uuid").otherwise(F.col("commentId")),
            "customer": F.when(fault == 2, "BPNL-42").otherwise(F.col("customer")),
            "commentType": F.when(fault == 3, "urgent").otherwise(F.col("commentType")),
            "listOfReferenceDates": F.when(fault == 5, F.array(F.lit("2024-01-01"), F.lit("2024-01-01"))).otherwise(
                F.col("listOfReferenceDates")
            ),
            "commentText": F.when(fault == 6, F.repeat(F.lit("x"), 5001)).otherwise(F.col("commentText")),
        }
    )
    names = [name for name in comments.columns if name != "event_id"]
    item = F.to_json(F.struct(*names))
    # Faults of type cannot come out of typed columns and are put into the text.
    item = (
        F.when(fault == 4, F.regexp_replace(item, '"requestDelete":(true|false)', '"requestDelete":"yes"'))
        .when(fault == 7, F.regexp_replace(item, '"author":"[^"]*"', '"author":null'))
        .when(fault == 8, F.regexp_replace(item, '"1999-12-31"', "19991231"))
        .when(fault == 9, F.regexp_replace(item, '"commentType":"[^"]*"', '"commentType":5'))
        .otherwise(item)
    )
    return faulty.select("event_id", item.alias("item"))


def ingest_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest requests `(request_id, endpoint, body)` over all events.

    Blocks of four consecutive events: every third block is four requests of one item each (with
    some bodies broken, scalar or empty), the others are one request with a list of four.
    """
    items = request_items(spark, sf_dir)
    event = F.col("event_id")
    block = F.floor(event / 4)
    single = block % 3 == 0
    body = (
        F.when(event % 11 == 0, F.substring("item", 1, 40))
        .when(event % 13 == 0, F.lit("42"))
        .when(event % 17 == 0, F.lit("[]"))
        .when(event % 2 == 0, F.col("item"))
        .otherwise(F.concat(F.lit("["), "item", F.lit("]")))
    )
    singles = items.filter(single).select(
        F.concat(F.lit("s"), event.cast("string")).alias("request_id"),
        F.when(event % 19 == 0, "/nowhere").otherwise("/comments").alias("endpoint"),
        body.alias("body"),
    )
    # A block holds four events at most, as event ids are unique.
    lists = (
        items.filter(~single)
        .groupBy(block.alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("entries"))
        .select(
            F.concat(F.lit("b"), F.col("block").cast("string")).alias("request_id"),
            F.lit("/comments").alias("endpoint"),
            F.concat(F.lit("["), F.array_join("entries.item", ","), F.lit("]")).alias("body"),
        )
    )
    return singles.unionByName(lists)


def partner_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per demand and capacity message (a source may send several), to their endpoints, some faulty by the last digit
    of the message's id: 0 without customer, 1 with a list replaced by an object, 2 with a flag as text."""
    sources = (
        ("/demand", demand_documents(spark, sf_dir), "materialDemandId", "demandSeries", "materialDemandIsInactive"),
        ("/capacity", capacity_documents(spark, sf_dir), "capacityGroupId", "capacities", "capacityGroupIsInactive"),
    )
    requests = []
    for endpoint, documents, key, list_field, flag in sources:
        digit = F.substring(key, -1, 1)
        names = [name for name in documents.columns if name not in ("customer", list_field, flag)]

        def body(*faulty: Column, names: list[str] = names) -> Column:
            return F.to_json(F.struct(*names, *faulty))

        customer, listed, flagged = F.col("customer"), F.col(list_field), F.col(flag)
        text = (
            F.when(digit == "0", body(listed, flagged))
            .when(digit == "1", body(customer, F.struct(F.lit(1).alias("n")).alias(list_field), flagged))
            .when(digit == "2", body(customer, listed, flagged.cast("string").alias(flag)))
            .otherwise(body(customer, listed, flagged))
        )
        requests.append(documents.select(F.col(key).alias("request_id"), F.lit(endpoint).alias("endpoint"), text.alias("body")))
    return requests[0].unionByName(requests[1])


# --- Topic messages -----------------------------------------------------------------------------


def _as_messages(documents: DataFrame, topic: str) -> DataFrame:
    value = F.to_json(F.struct(*documents.columns))
    return documents.select(F.lit(topic).alias("topic"), value.alias("value"))


def demand_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_messages(demand_documents(spark, sf_dir), DEMAND_TOPIC)


def stored_demand_halves(
    spark: SparkSession, sf_dir: str, label: str, location: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Stored demand messages: those of finished orders, and those of the others; one without the flag is in neither.

    The flag is stored beside the text it stands in, so no text is searched for it again.
    """
    documents = demand_documents(spark, sf_dir)
    flag = F.col("materialDemandIsInactive").alias("inactive")
    value = F.to_json(F.struct(*documents.columns)).alias("value")
    messages = stored(spark, documents.select(F.lit(DEMAND_TOPIC).alias("topic"), value, flag), label, location)
    return messages.filter("inactive").drop("inactive"), messages.filter("NOT inactive").drop("inactive")


def capacity_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_messages(capacity_documents(spark, sf_dir), CAPACITY_TOPIC)


def comment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment messages, some of them unreadable or on an unknown topic (by event_id)."""
    comments = comment_documents(spark, sf_dir)
    event = F.col("event_id")
    text = F.to_json(F.struct(*[name for name in comments.columns if name != "event_id"]))
    value = (
        F.when(event % 23 == 0, F.concat(text, F.lit(" trailing")))
        .when(event % 29 == 0, F.substring(text, 1, 60))
        .when(event % 31 == 0, F.concat(F.lit("["), text, F.lit("]")))
        .when(event % 37 == 0, F.regexp_replace(text, '"requestDelete":(true|false)', '"requestDelete":"yes"'))
        .otherwise(text)
    )
    topic = F.when(event % 41 == 0, "returns-topic").otherwise(COMMENTS_TOPIC)
    return comments.select(topic.alias("topic"), value.alias("value"), "event_id")


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of all topics."""
    return (
        demand_messages(spark, sf_dir)
        .unionByName(capacity_messages(spark, sf_dir))
        .unionByName(comment_messages(spark, sf_dir).select("topic", "value"))
    )
