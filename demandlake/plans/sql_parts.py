"""SQL for the sample messages, in common table expressions the oracle queries start with."""

from __future__ import annotations

DEMAND = """
first_line AS (
    SELECT l_orderkey AS fl_orderkey, l_partkey AS fl_partkey, l_suppkey AS fl_suppkey
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey) = 1
),
demand_header AS (
    SELECT o_orderkey,
           CAST(o_orderkey AS VARCHAR) AS "materialDemandId",
           'MAT-' || fl_partkey AS "materialNumberCustomer",
           CASE WHEN fl_partkey % 8 <> 0 THEN 'SUP-' || fl_partkey END AS "materialNumberSupplier",
           'Part ' || fl_partkey || ' in ' || o_orderpriority AS "materialDescriptionCustomer",
           CASE WHEN fl_partkey % 5 <> 0 THEN 'asset-' || fl_partkey END AS "materialGlobalAssetId",
           'BPNL' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS customer,
           'BPNL' || lpad(CAST(fl_suppkey AS VARCHAR), 12, '0') AS supplier,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "changedAt",
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'unit:piece' END AS "unitOfMeasure",
           o_orderpriority = '5-LOW' AS "unitOfMeasureIsOmitted",
           o_orderstatus = 'F' AS "materialDemandIsInactive"
    FROM orders JOIN first_line ON fl_orderkey = o_orderkey
),
demand AS (
    SELECT demand_header.* EXCLUDE (o_orderkey),
           l_returnflag AS "demandCategoryCode",
           'BPNS-' || l_linestatus AS "customerLocation",
           CASE WHEN l_linestatus <> 'O' THEN 'BPNS-' || l_returnflag END AS "expectedSupplierLocation",
           l_quantity AS demand,
           strftime(l_shipdate, '%Y-%m-%d') AS "pointInTime"
    FROM demand_header JOIN lineitem ON l_orderkey = o_orderkey
)"""

CAPACITY = """
supplier_lines AS (
    SELECT l_suppkey AS sl_suppkey,
           min(l_partkey) AS first_part,
           strftime(min(l_shipdate), '%Y-%m-%dT%H:%M:%SZ') AS first_moment,
           strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%SZ') AS last_moment
    FROM lineitem GROUP BY l_suppkey
),
capacity AS (
    SELECT 'CG-' || s_suppkey AS "capacityGroupId",
           s_name AS name,
           'BPNL' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS supplier,
           'BPNL' || lpad(CAST(s_nationkey AS VARCHAR), 12, '0') AS customer,
           'unit:piece' AS "unitOfMeasure",
           false AS "unitOfMeasureIsOmitted",
           s_suppkey % 2 = 0 AS "capacityGroupIsInactive",
           last_moment AS "changedAt",
           CASE WHEN s_suppkey % 3 <> 0 THEN '["CG-' || (s_suppkey + 1) || '"]' ELSE '[]' END AS "linkedCapacityGroups",
           CASE WHEN s_suppkey % 4 <> 0 THEN '["BPNS-' || s_suppkey || '"]' ELSE '[]' END AS "supplierLocations",
           CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 6 + 1 END AS "measurementInterval",
           CASE WHEN s_suppkey % 7 <> 0 THEN first_moment END AS "startReferenceDateTime",
           CASE WHEN has_threshold THEN 1 END AS "sequenceNumber",
           CASE WHEN has_threshold THEN s_nationkey % 9 + 1 END AS "subhorizonLength",
           CASE WHEN has_threshold THEN CAST(s_nationkey + 1 AS DOUBLE) END AS "absoluteNegativeDeviation",
           CASE WHEN has_threshold THEN CAST(s_suppkey % 7 + 1 AS DOUBLE) / 8 END AS "relativeNegativeDeviation",
           CASE WHEN has_threshold THEN s_acctbal END AS "absolutePositiveDeviation",
           CASE WHEN has_threshold THEN CAST(s_suppkey % 3 + 1 AS DOUBLE) / 4 END AS "relativePositiveDeviation",
           'MAT-' || first_part AS "materialNumberCustomer",
           CASE WHEN first_part % 8 <> 0 THEN 'SUP-' || first_part END AS "materialNumberSupplier",
           'BPNS-' || s_nationkey AS "customerLocation",
           'C' || (first_part % 4) AS "demandCategoryCode",
           CAST(first_part % 5 + 1 AS DOUBLE) / 2 AS "loadFactor",
           strftime(l_shipdate, '%Y-%m-%d') AS "pointInTime",
           l_quantity AS "agreedCapacity",
           CAST(l_linenumber AS DOUBLE) AS "actualCapacity",
           l_quantity + 10 AS "maximumCapacity",
           l_discount AS "deltaProductionResult"
    FROM (SELECT *, s_suppkey % 7 <> 0 AND s_nationkey % 5 <> 0 AS has_threshold FROM supplier)
    JOIN supplier_lines ON sl_suppkey = s_suppkey
    JOIN lineitem ON l_suppkey = s_suppkey
)"""


def _uuid(text: str) -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr(md5({text}), {start}, {length})" for start, length in cuts)


COMMENTS = f"""
comments AS (
    SELECT event_id,
           CASE WHEN event_id % 2 = 1 THEN 'urn:uuid:' ELSE '' END || {_uuid("CAST(event_id AS VARCHAR)")} AS "commentId",
           {_uuid("'object-' || CAST(user_id AS VARCHAR)")} AS "objectId",
           'urn:example:' || event_type AS "objectType",
           'BPNL' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS customer,
           'BPNL' || lpad(CAST(event_id % 1000 AS VARCHAR), 12, '0') AS supplier,
           'user' || user_id || '@example.com' AS author,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "postedAt",
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "changedAt",
           'Comment ' || event_id || ' on ' || event_type AS "commentText",
           CASE WHEN event_id % 3 = 0 THEN 'warning' ELSE 'information' END AS "commentType",
           event_id % 7 = 0 AS "requestDelete",
           '["' || strftime(ts, '%Y-%m-%d') || '","1999-12-31"]' AS "listOfReferenceDates"
    FROM events
)"""

# The texts of comment messages and the topics they are on.
COMMENT_MESSAGES = (
    COMMENTS
    + """,
comment_texts AS (
    SELECT *,
           '{"commentId":"' || "commentId" || '","objectId":"' || "objectId" || '","objectType":"' || "objectType"
           || '","customer":"' || customer || '","supplier":"' || supplier || '","author":"' || author
           || '","postedAt":"' || "postedAt" || '","changedAt":"' || "changedAt" || '","commentText":"' || "commentText"
           || '","commentType":"' || "commentType" || '","requestDelete":' || "requestDelete"
           || ',"listOfReferenceDates":' || "listOfReferenceDates" || '}' AS good
    FROM comments
),
comment_messages AS (
    SELECT *,
           CASE WHEN event_id % 41 = 0 THEN 'returns-topic' ELSE 'comments-topic' END AS topic,
           CASE WHEN event_id % 23 = 0 THEN good || ' trailing'
                WHEN event_id % 29 = 0 THEN substr(good, 1, 60)
                WHEN event_id % 31 = 0 THEN '[' || good || ']'
                WHEN event_id % 37 = 0 THEN replace(good, '"requestDelete":' || "requestDelete", '"requestDelete":"yes"')
                ELSE good END AS value,
           CASE WHEN event_id % 41 = 0 THEN 'unknown_topic'
                WHEN event_id % 23 = 0 THEN 'malformed_json'
                WHEN event_id % 29 = 0 THEN 'malformed_json'
                WHEN event_id % 31 = 0 THEN 'not_an_object'
                WHEN event_id % 37 = 0 THEN 'contract_mismatch' END AS reason
    FROM comment_texts
)"""
)

# Requests and the violations of their items; `problem` numbers several violations of one item.
REQUESTS = """
placed AS (
    SELECT event_id,
           event_id % 20 AS fault,
           (event_id // 4) % 3 = 0 AS is_single,
           CASE WHEN (event_id // 4) % 3 = 0 THEN 's' || event_id ELSE 'b' || (event_id // 4) END AS request_id,
           CASE WHEN (event_id // 4) % 3 = 0 AND event_id % 19 = 0 THEN '/nowhere' ELSE '/comments' END AS endpoint,
           CASE WHEN (event_id // 4) % 3 <> 0 THEN 'list'
                WHEN event_id % 11 = 0 THEN 'malformed'
                WHEN event_id % 13 = 0 THEN 'scalar'
                WHEN event_id % 17 = 0 THEN 'empty'
                WHEN event_id % 2 = 0 THEN 'object'
                ELSE 'list' END AS body_kind
    FROM events
),
items AS (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY event_id) - 1 AS index
    FROM placed
    WHERE body_kind IN ('object', 'list')
),
faults(fault, field, message) AS (VALUES
    (0, '[]', 'required: objectId'),
    (1, '["commentId"]', 'pattern'),
    (2, '["customer"]', 'pattern'),
    (3, '["commentType"]', 'enum'),
    (4, '["requestDelete"]', 'type: boolean'),
    (5, '["listOfReferenceDates"]', 'uniqueItems'),
    (6, '["commentText"]', 'maxLength'),
    (7, '["author"]', 'type: string'),
    (8, '["listOfReferenceDates","1"]', 'type: string'),
    (9, '["commentType"]', 'enum'),
    (9, '["commentType"]', 'type: string')
),
errors AS (
    SELECT request_id, endpoint, index, field, message
    FROM items JOIN faults USING (fault)
    WHERE endpoint = '/comments'
),
decided AS (
    SELECT placed.request_id,
           any_value(placed.endpoint) AS endpoint,
           any_value(body_kind) AS body_kind,
           count(items_seen.event_id) AS total,
           count(items_seen.event_id) FILTER (WHERE placed.fault < 10) AS failed
    FROM placed LEFT JOIN (SELECT event_id FROM items) AS items_seen USING (event_id)
    GROUP BY placed.request_id
),
disposition AS (
    SELECT *,
           CASE WHEN endpoint <> '/comments' THEN 404
                WHEN body_kind IN ('malformed', 'scalar') THEN 400
                WHEN failed > 0 AND failed < total THEN 400
                WHEN failed > 0 THEN 422
                WHEN total = 1 THEN 201
                ELSE 200 END AS status
    FROM decided
)"""
