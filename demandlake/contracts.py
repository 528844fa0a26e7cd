"""Topics, message schemas and validation contracts.

Everything here is data: the operators read these definitions and build columns from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Topic:
    """One message stream: where it enters, what it is called, where its tables live."""

    name: str
    endpoint: str
    folder: str
    id_column: str
    message_schema: str


@dataclass(frozen=True)
class FieldRule:
    """What a contract demands of one top-level field of a message.

    ``kind`` is one of string, boolean, number, object, array, strings (an array of strings).
    Patterns are searched for, and apply to strings only; an enumeration applies to any value.
    """

    name: str
    kind: str
    required: bool = False
    pattern: str | None = None
    choices: tuple[str, ...] = field(default=())
    max_chars: int | None = None
    unique_items: bool = False


# --- Fixed values: names, patterns and limits that callers and stored tables depend on. ---

COMMENTS_TOPIC = "comments-topic"
DEMAND_TOPIC = "demand-topic"
CAPACITY_TOPIC = "capacity-topic"

BPNL_PATTERN = r"^BPNL[0-9]{8}[a-zA-Z0-9]{4}$"
UUID_PATTERN = (
    r"(^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$)"
    r"|(^urn:uuid:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$)"
)
COMMENT_TYPES = ("information", "warning", "default", "actionRequired")
MAX_COMMENT_CHARS = 5000
CHUNK_SIZE = 100
DATE_FORMAT = "yyyy-MM-dd"

# --- End of fixed values. ---

DEMAND_SCHEMA = """
    materialDemandId STRING, materialNumberCustomer STRING, materialNumberSupplier STRING,
    materialDescriptionCustomer STRING, materialGlobalAssetId STRING, customer STRING, supplier STRING,
    changedAt STRING, unitOfMeasure STRING, unitOfMeasureIsOmitted BOOLEAN, materialDemandIsInactive BOOLEAN,
    demandSeries ARRAY<STRUCT<
        customerLocation: STRING, expectedSupplierLocation: STRING,
        demandCategory: STRUCT<demandCategoryCode: STRING>,
        demands: ARRAY<STRUCT<demand: DOUBLE, pointInTime: STRING>>>>
"""

CAPACITY_SCHEMA = """
    capacityGroupId STRING, name STRING, supplier STRING, customer STRING, unitOfMeasure STRING, changedAt STRING,
    unitOfMeasureIsOmitted BOOLEAN, capacityGroupIsInactive BOOLEAN,
    linkedCapacityGroups ARRAY<STRING>, supplierLocations ARRAY<STRING>,
    demandVolatilityParameters STRUCT<
        measurementInterval: BIGINT, startReferenceDateTime: STRING,
        rollingHorizonAlertThresholds: ARRAY<STRUCT<
            sequenceNumber: BIGINT, subhorizonLength: BIGINT,
            absoluteNegativeDeviation: DOUBLE, relativeNegativeDeviation: DOUBLE,
            absolutePositiveDeviation: DOUBLE, relativePositiveDeviation: DOUBLE>>>,
    linkedDemandSeries ARRAY<STRUCT<
        loadFactor: DOUBLE, materialNumberCustomer: STRING, materialNumberSupplier: STRING,
        customerLocation: STRING, demandCategory: STRUCT<demandCategoryCode: STRING>>>,
    capacities ARRAY<STRUCT<
        pointInTime: STRING, agreedCapacity: DOUBLE, actualCapacity: DOUBLE,
        maximumCapacity: DOUBLE, deltaProductionResult: DOUBLE>>
"""

COMMENT_SCHEMA = """
    commentId STRING, objectId STRING, objectType STRING, customer STRING, supplier STRING, author STRING,
    postedAt STRING, changedAt STRING, commentText STRING, commentType STRING, requestDelete BOOLEAN,
    listOfReferenceDates ARRAY<STRING>
"""

TOPICS: dict[str, Topic] = {
    topic.name: topic
    for topic in (
        Topic(COMMENTS_TOPIC, "/comments", "comments", "commentId", COMMENT_SCHEMA),
        Topic(DEMAND_TOPIC, "/demand", "demand", "materialDemandId", DEMAND_SCHEMA),
        Topic(CAPACITY_TOPIC, "/capacity", "capacity", "capacityGroupId", CAPACITY_SCHEMA),
    )
}

CONTRACTS: dict[str, tuple[FieldRule, ...]] = {
    COMMENTS_TOPIC: (
        FieldRule("commentId", "string", required=True, pattern=UUID_PATTERN),
        FieldRule("objectId", "string", required=True, pattern=UUID_PATTERN),
        FieldRule("objectType", "string", required=True),
        FieldRule("customer", "string", required=True, pattern=BPNL_PATTERN),
        FieldRule("supplier", "string", required=True, pattern=BPNL_PATTERN),
        FieldRule("author", "string"),
        FieldRule("postedAt", "string"),
        FieldRule("changedAt", "string"),
        FieldRule("commentText", "string", max_chars=MAX_COMMENT_CHARS),
        FieldRule("commentType", "string", choices=COMMENT_TYPES),
        FieldRule("requestDelete", "boolean"),
        FieldRule("listOfReferenceDates", "strings", unique_items=True),
    ),
    # Real demand and capacity messages carry partner numbers outside the comment contract's
    # pattern, so these two contracts check presence and type only.
    DEMAND_TOPIC: (
        FieldRule("materialDemandId", "string", required=True),
        FieldRule("materialNumberCustomer", "string", required=True),
        FieldRule("materialNumberSupplier", "string"),
        FieldRule("materialDescriptionCustomer", "string", required=True),
        FieldRule("materialGlobalAssetId", "string"),
        FieldRule("customer", "string", required=True),
        FieldRule("supplier", "string", required=True),
        FieldRule("changedAt", "string", required=True),
        FieldRule("unitOfMeasure", "string"),
        FieldRule("unitOfMeasureIsOmitted", "boolean", required=True),
        FieldRule("materialDemandIsInactive", "boolean", required=True),
        FieldRule("demandSeries", "array", required=True),
    ),
    CAPACITY_TOPIC: (
        FieldRule("capacityGroupId", "string", required=True),
        FieldRule("name", "string", required=True),
        FieldRule("supplier", "string", required=True),
        FieldRule("customer", "string", required=True),
        FieldRule("changedAt", "string", required=True),
        FieldRule("unitOfMeasure", "string"),
        FieldRule("unitOfMeasureIsOmitted", "boolean", required=True),
        FieldRule("capacityGroupIsInactive", "boolean", required=True),
        FieldRule("linkedCapacityGroups", "strings"),
        FieldRule("supplierLocations", "strings"),
        FieldRule("demandVolatilityParameters", "object"),
        FieldRule("linkedDemandSeries", "array"),
        FieldRule("capacities", "array", required=True),
    ),
}


def topic_of(name: str) -> Topic:
    """The registered topic, or a ValueError naming the ones that exist."""
    if name not in TOPICS:
        raise ValueError(f"unknown topic {name!r}; expected one of {', '.join(TOPICS)}")
    return TOPICS[name]
