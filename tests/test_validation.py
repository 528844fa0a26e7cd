from __future__ import annotations

import json

import pytest

from demandlake.operators import validation as val
from fixtures import capacity, comment, demand


def requests(spark, *bodies, endpoint="/comments"):
    rows = [(str(i), endpoint, body if isinstance(body, str) else json.dumps(body)) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "request_id string, endpoint string, body string")


def errors(spark, *items, endpoint="/comments"):
    """Violations of the items of one request as (index, path, message), in order."""
    rows = val.validation_errors(requests(spark, list(items), endpoint=endpoint)).collect()
    return [(row["index"], row.field, row.message) for row in rows]


def statuses(spark, *bodies, endpoint="/comments"):
    rows = val.request_disposition(requests(spark, *bodies, endpoint=endpoint)).orderBy("request_id").collect()
    return [(row.status, row.accepted) for row in rows]


CASES = [
    (comment(), []),
    (comment(extra=[1]), []),
    (comment(author="ABSENT", commentType="ABSENT", listOfReferenceDates="ABSENT"), []),
    (comment(objectId="ABSENT", customer="ABSENT"), [([], "required: objectId"), ([], "required: customer")]),
    (comment(objectType=None), [(["objectType"], "type: string")]),
    (comment(author=None), [(["author"], "type: string")]),
    (comment(commentId=7), [(["commentId"], "type: string")]),
    (comment(commentId="11111111"), [(["commentId"], "pattern")]),
    (comment(commentId="uuid:11111111-2222-4333-8444-555555555555"), [(["commentId"], "pattern")]),
    (comment(customer="BPNL1234567AAAAA"), [(["customer"], "pattern")]),
    (comment(supplier="XBPNL12345678AAAA"), [(["supplier"], "pattern")]),
    (comment(supplier="BPNL12345678AAAA\n"), []),
    (comment(supplier="BPNL12345678AAAA\r"), [(["supplier"], "pattern")]),
    (comment(commentType="urgent"), [(["commentType"], "enum")]),
    (comment(commentType=5), [(["commentType"], "enum"), (["commentType"], "type: string")]),
    (comment(requestDelete="true"), [(["requestDelete"], "type: boolean")]),
    (comment(requestDelete=1), [(["requestDelete"], "type: boolean")]),
    (comment(commentText="x" * 5000), []),
    (comment(commentText="\U0001f600" * 5000), []),
    (comment(commentText="x" * 5000 + "\n"), []),
    (comment(commentText="x" * 5001), [(["commentText"], "maxLength")]),
    (comment(postedAt="no date"), []),
    (comment(listOfReferenceDates=[]), []),
    (comment(listOfReferenceDates=["a", "b", "a"]), [(["listOfReferenceDates"], "uniqueItems")]),
    (comment(listOfReferenceDates="a"), [(["listOfReferenceDates"], "type: strings")]),
    (comment(listOfReferenceDates=["a", None]), [(["listOfReferenceDates", "1"], "type: string")]),
    (
        comment(listOfReferenceDates=[1, "1", 1.0]),
        [
            (["listOfReferenceDates"], "uniqueItems"),
            (["listOfReferenceDates", "0"], "type: string"),
            (["listOfReferenceDates", "2"], "type: string"),
        ],
    ),
    (17, [([], "type: object")]),
    (None, [([], "type: object")]),
    ([comment()], [([], "type: object")]),
]


def test_comment_contract(spark):
    expected = [(i, path, message) for i, (_, found) in enumerate(CASES) for path, message in found]
    found = errors(spark, *[item for item, _ in CASES])
    # Within one path the order carries no meaning.
    assert sorted(found) == sorted(expected)
    assert [(index, path) for index, path, _ in found] == [(index, path) for index, path, _ in expected]


def test_positions_are_sorted_as_numbers(spark):
    found = errors(spark, comment(listOfReferenceDates=[str(i) for i in range(9)] + [100, 101, 102]))
    assert [path[1] for _, path, _ in found] == ["9", "10", "11"]


def test_demand_and_capacity_contracts(spark):
    assert errors(spark, demand(), demand(unitOfMeasure="ABSENT"), endpoint="/demand") == []
    assert errors(spark, demand(demandSeries={}), endpoint="/demand") == [(0, ["demandSeries"], "type: array")]
    assert errors(spark, capacity(), capacity(linkedDemandSeries="ABSENT"), endpoint="/capacity") == []
    assert errors(spark, capacity(demandVolatilityParameters=[]), endpoint="/capacity") == [
        (0, ["demandVolatilityParameters"], "type: object")
    ]


def test_disposition(spark):
    bad = comment(objectId="ABSENT")
    assert statuses(
        spark,
        comment(),
        [comment()],
        [comment(), comment()],
        [],
        [comment(), bad],
        [bad, bad],
        bad,
        "{",
        "5",
    ) == [(201, 1), (201, 1), (200, 2), (200, 0), (400, 0), (422, 0), (422, 0), (400, 0), (400, 0)]


def test_unknown_endpoint(spark):
    assert statuses(spark, comment(), endpoint="/other") == [(404, 0)]
    assert val.accepted_messages(requests(spark, comment(), endpoint="/other")).count() == 0


def test_only_items_of_valid_requests_are_published(spark):
    sent = val.accepted_messages(requests(spark, [comment(author="a"), comment(author="b")], [comment(author="c"), 1]))
    assert sorted(json.loads(row.value)["author"] for row in sent.collect()) == ["a", "b"]
    assert {row.topic for row in sent.collect()} == {"comments-topic"}


def test_published_items_are_equal_to_the_received_ones(spark):
    item = comment(commentText='quote " and \\ and ü', extra={"n": [1, 2.5, None, True]})
    sent = val.accepted_messages(requests(spark, item)).first()
    assert json.loads(sent.value) == item


@pytest.mark.parametrize("body,shape", [("{", "malformed"), ("5", "scalar"), ('"x"', "scalar"), ("null", "scalar")])
def test_malformed_requests(spark, body, shape):
    assert [row["shape"] for row in val.malformed_requests(requests(spark, body, "[]", "{}")).collect()] == [shape]


def shapes_and_statuses(spark, rows):
    requests = spark.createDataFrame(rows, "request_id string, endpoint string, body string")
    shapes = {r.request_id: r.shape for r in val.normalise_requests(requests).select("request_id", "shape").collect()}
    return shapes, {r.request_id: (r.status, r.accepted) for r in val.request_disposition(requests).collect()}


def test_a_document_beyond_the_limit_is_refused_as_such(spark):
    import json

    full = json.dumps({"commentText": "x" * (val.MAX_ITEM_BYTES - len('{"commentText": ""}'))})
    rows = [("fits", "/comments", full), ("over", "/comments", full + " "), ("broken", "/comments", "[" + full + " ")]
    shapes, statuses = shapes_and_statuses(spark, rows)
    assert shapes == {"fits": "object", "over": "oversize", "broken": "oversize"}
    assert statuses == {"fits": (422, 0), "over": (413, 0), "broken": (413, 0)}


def test_a_list_may_be_of_any_size(spark):
    """40 MB of valid items are accepted as a whole; with one bad item among them the request is refused."""
    import json

    items = [comment(author=str(i), extra="x" * 1_000_000) for i in range(40)]
    rows = [("good", "/comments", json.dumps(items)), ("mixed", "/comments", json.dumps([*items, comment(author=5)]))]
    shapes, statuses = shapes_and_statuses(spark, rows)
    assert shapes == {"good": "list", "mixed": "list"}
    assert statuses == {"good": (200, 40), "mixed": (400, 0)}
    requests = spark.createDataFrame(rows, "request_id string, endpoint string, body string")
    checked = val.checked_requests(requests)
    sent = val.messages_of(checked).selectExpr("get_json_object(value, '$.author') AS author", "length(value) AS n").collect()
    assert sorted(int(row.author) for row in sent) == list(range(40)) and min(row.n for row in sent) > 1_000_000
    assert [(r.request_id, r["index"], r.message) for r in val.errors_of(checked).collect()] == [("mixed", 40, "type: string")]


@pytest.mark.parametrize(
    "body",
    ['[1]]', "[1],[2]", '[1],["x"]', '[], "x"', "[1] junk", "[1,]", "[,1]", "[1 2]", '["a]', "[{]", "['a']", "[NaN]", "[", '[1],"closed":1}'],
)
def test_text_beside_a_list_is_malformed(spark, body):
    assert [row["shape"] for row in val.malformed_requests(requests(spark, body)).collect()] == ["malformed"]


def test_items_of_a_list_keep_their_types(spark):
    body = '[{"a": 1}, "b", 5, 2.50, null, true, [1], {}]'
    rows = val.normalise_requests(requests(spark, body)).selectExpr("transform(items, i -> to_json(i)) AS items").first()
    assert rows["items"] == ['{"a":1}', '"b"', "5", "2.5", "null", "true", "[1]", "{}"]


@pytest.mark.parametrize("text", ['1,"end of document"', "1],[1", '{"a":1},2', '{"a":1}],"x":[1'])
def test_no_text_closes_the_frame_it_is_parsed_in(spark, text):
    from pyspark.sql import functions as F

    from demandlake.functions import json_values as jv

    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.select(jv.strict_variant(F.col("text")).isNull()).first()[0]
