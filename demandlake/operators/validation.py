"""Ingest validation: requests against the contract of their endpoint.

A request is one JSON document holding one item or a list of items. All checks of a request happen
inside its row, so validation needs no shuffle, however many items one sender packs into a request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.contracts import CONTRACTS, TOPICS, FieldRule
from demandlake.functions import json_values as jv

# Shapes of a request body.
MALFORMED = "malformed"
SCALAR = "scalar"
OVERSIZE = "oversize"
OBJECT = "object"
LIST = "list"

# A single document or item of more bytes is refused as such, as the engine's JSON values are bounded; those of
# smaller ones always fit, and a list may be of any size. Nesting of more than 1,000 levels counts as malformed.
MAX_ITEM_BYTES = 16 * 2**20

_ROOT = ""
_WHOLE_FIELD = -1
_NO_ERRORS = "array<struct<field: string, item: int, message: string>>"
# `$` may match before a final line feed only, so other line ends must not count as one.
_UNIX_LINES = "(?d)"


def dispatch_requests(requests: DataFrame) -> DataFrame:
    """Add the topic each request's endpoint publishes to; NULL for an unknown endpoint."""
    topic = F.lit(None).cast("string")
    for entry in TOPICS.values():
        topic = F.when(F.col("endpoint") == entry.endpoint, entry.name).otherwise(topic)
    return requests.withColumn("topic", topic)


def normalise_requests(requests: DataFrame) -> DataFrame:
    """Add `shape` and `items`: a single object becomes a list of one, a list stays as it is.

    A list is taken apart while it is read, so only its single items are bounded. A longer body that cannot be
    read, as it holds a larger item or no JSON, is refused by its size.
    """
    document = F.col("document")
    small = F.octet_length("body") <= MAX_ITEM_BYTES
    is_list = jv.starts_with(F.col("body"), "[")
    # One select per step, as each parsed value is referenced several times by the next one.
    return (
        dispatch_requests(requests)
        .withColumns(
            {
                "listed": F.when(is_list, jv.strict_elements(F.col("body"))),
                "document": F.when(~is_list & small, jv.strict_variant(F.col("body"))),
            }
        )
        .withColumn(
            "shape",
            F.when(F.col("listed").isNotNull(), LIST)
            .when(~small, OVERSIZE)
            .when(document.isNull(), MALFORMED)
            .when(jv.starts_with(F.col("body"), "{"), OBJECT)
            .otherwise(SCALAR),
        )
        .withColumn(
            "items", F.when(F.col("shape") == LIST, F.col("listed")).when(F.col("shape") == OBJECT, F.array(document))
        )
        .drop("document", "listed")
    )


def malformed_requests(requests: DataFrame) -> DataFrame:
    """Requests whose body is too large, not valid JSON, or neither an object nor a list."""
    normal = normalise_requests(requests)
    return normal.filter(F.col("shape").isin(OVERSIZE, MALFORMED, SCALAR)).select("request_id", "endpoint", "shape")


# The checks are written as SQL text: a contract makes hundreds of small expressions, and handing
# them to the engine one text at a time takes a fraction of the time of building them one by one.


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _error(field: str, message: str, item: str = str(_WHOLE_FIELD)) -> str:
    return f"named_struct('field', {_quoted(field)}, 'item', {item}, 'message', {_quoted(message)})"


_SCALAR_TYPES = {"string": "= 'STRING'", "boolean": "= 'BOOLEAN'", "number": "rlike '^(BIGINT|DECIMAL|DOUBLE|FLOAT)'"}
_ELEMENTS = "try_variant_get({value}, '$', 'array<variant>')"
_OBJECT = "try_variant_get({value}, '$', 'map<string,variant>')"


def _read_field(rule: FieldRule) -> str:
    """What the checks of a field need to know, taken from its JSON value `m.<name>` once."""
    value = f"m.{rule.name}"
    parts = [f"'present', {value} IS NOT NULL"]
    if rule.kind in _SCALAR_TYPES:
        parts.append(f"'type', schema_of_variant({value})")
    if rule.pattern or rule.choices or rule.max_chars is not None:
        text = f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN try_variant_get({value}, '$', 'string') END"
        parts.append(f"'text', {text}")
    if rule.kind in ("array", "strings"):
        parts.append(f"'elements', {_ELEMENTS.format(value=value)}")
    if rule.kind == "object":
        parts.append(f"'is_object', {_OBJECT.format(value=value)} IS NOT NULL")
    return f"named_struct({', '.join(parts)})"


def _violations(rule: FieldRule) -> list[tuple[str, str]]:
    """(condition, message) pairs for a field `f.<name>` that is present."""
    field = f"f.{rule.name}"
    if rule.kind in _SCALAR_TYPES:
        fits = f"{field}.type {_SCALAR_TYPES[rule.kind]}"
    elif rule.kind == "object":
        fits = f"{field}.is_object"
    else:
        fits = f"{field}.elements IS NOT NULL"
    found = [(f"NOT ({fits})", f"type: {rule.kind}")]
    if rule.pattern:
        found.append((f"NOT ({field}.text rlike {_quoted(_UNIX_LINES + rule.pattern)})", "pattern"))
    if rule.choices:
        choices = ", ".join(_quoted(choice) for choice in rule.choices)
        found.append((f"NOT coalesce({field}.text IN ({choices}), false)", "enum"))
    if rule.max_chars is not None:
        # A line feed at the very end does not count, as `$` in a pattern matches before it.
        length = f"char_length({field}.text) - CASE WHEN endswith({field}.text, '\\n') THEN 1 ELSE 0 END"
        found.append((f"{length} > {rule.max_chars}", "maxLength"))
    if rule.unique_items:
        names = f"transform({field}.elements, e -> {_identity('e')})"
        found.append((f"size({names}) <> size(array_distinct({names}))", "uniqueItems"))
    return found


def _identity(value: str) -> str:
    """A text that is equal for equal JSON values: 1 and 1.0 agree, "1" and 1 do not."""
    return (
        f"CASE WHEN schema_of_variant({value}) {_SCALAR_TYPES['number']} "
        f"THEN string(try_variant_get({value}, '$', 'double')) ELSE to_json({value}) END"
    )


def _element_errors(rule: FieldRule) -> str:
    """One error per element that is no string."""
    error = _error(rule.name, "type: string", item="i")
    found = f"transform(f.{rule.name}.elements, (e, i) -> CASE WHEN schema_of_variant(e) <> 'STRING' THEN {error} END)"
    return f"coalesce(filter({found}, x -> x IS NOT NULL), cast(array() AS {_NO_ERRORS}))"


def _item_errors(rules: tuple[FieldRule, ...]) -> str:
    """All violations of one item, ordered by place: the item itself, its fields, their elements."""
    checks = []
    lists = []
    for rule in rules:
        if rule.required:
            missing = _error(_ROOT, f"required: {rule.name}")
            checks.append(f"CASE WHEN NOT f.{rule.name}.present THEN {missing} END")
        for condition, message in _violations(rule):
            error = _error(rule.name, message)
            checks.append(f"CASE WHEN f.{rule.name}.present AND {condition} THEN {error} END")
        if rule.kind == "strings":
            lists.append(_element_errors(rule))
    found = ", ".join([f"filter(array({', '.join(checks)}), x -> x IS NOT NULL)", *lists])
    no_object = f"array({_error(_ROOT, 'type: object')})"
    return f"CASE WHEN f.is_object THEN array_sort(concat({found})) ELSE {no_object} END"


def errors_per_item(rules: tuple[FieldRule, ...]) -> Column:
    """The violations of every element of `items`, in stages so that each JSON value is taken apart once."""
    members = ", ".join(f"'{rule.name}', try_element_at(o, '{rule.name}')" for rule in rules)
    fields = ", ".join(f"'{rule.name}', {_read_field(rule)}" for rule in rules)
    objects = f"transform(items, v -> {_OBJECT.format(value='v')})"
    opened = f"transform({objects}, o -> named_struct('is_object', o IS NOT NULL, {members}))"
    read = f"transform({opened}, m -> named_struct('is_object', m.is_object, {fields}))"
    return F.expr(f"transform({read}, f -> {_item_errors(rules)})")


def check_requests(requests: DataFrame) -> DataFrame:
    """Normalised requests plus `errors`: per item, in order, the list of its violations."""
    errors = F.lit(None).cast(f"array<{_NO_ERRORS}>")
    for topic in CONTRACTS:
        errors = F.when(F.col("topic") == topic, errors_per_item(CONTRACTS[topic])).otherwise(errors)
    return normalise_requests(requests).withColumn("errors", errors)


def _reported(numbered: DataFrame) -> DataFrame:
    """Rows with `index` and `item_errors` as the error report."""
    path = (
        F.when(F.col("error.field") == _ROOT, F.array().cast("array<string>"))
        .when(F.col("error.item") == _WHOLE_FIELD, F.array("error.field"))
        .otherwise(F.array(F.col("error.field"), F.col("error.item").cast("string")))
    )
    return numbered.select("request_id", "endpoint", "index", F.explode("item_errors").alias("error")).select(
        "request_id",
        "endpoint",
        F.col("index").cast("bigint").alias("index"),
        path.alias("field"),
        F.col("error.message").alias("message"),
    )


def validation_errors(requests: DataFrame) -> DataFrame:
    """The error report: one row per violation with item index, path and message.

    `field` is the path inside the item: empty for the item itself, the field name, or the field
    name and the element's position.
    """
    # The outer form keeps Spark from testing, and so computing, the errors once more before.
    return _reported(
        check_requests(requests).select("request_id", "endpoint", F.posexplode_outer("errors").alias("index", "item_errors"))
    )


def dispose_requests(requests: DataFrame) -> DataFrame:
    """Decide each request as a whole: `status` and the number of items it may publish.

    200 all items good (also for the empty list), 201 exactly one good item, 400 unreadable or
    only partly good, 404 unknown endpoint, 413 body too large, 422 no good item.
    """
    total = F.size("items")
    failed = F.size(F.filter("errors", lambda errors: F.size(errors) > 0))
    status = (
        F.when(F.col("topic").isNull(), 404)
        .when(F.col("shape") == OVERSIZE, 413)
        .when(F.col("shape").isin(MALFORMED, SCALAR), 400)
        .when((F.col("failed") > 0) & (F.col("failed") < F.col("total")), 400)
        .when(F.col("failed") > 0, 422)
        .when(F.col("total") == 1, 201)
        .otherwise(200)
    )
    counted = check_requests(requests).withColumns({"total": total, "failed": failed})
    decided = counted.withColumn("status", status)
    accepted = F.when(F.col("status").isin(200, 201), F.col("total")).otherwise(0)
    return decided.withColumn("accepted", accepted)


def request_disposition(requests: DataFrame) -> DataFrame:
    """One row per request: status code and accepted item count."""
    return dispose_requests(requests).select("request_id", "endpoint", "status", "accepted")


def accepted_messages(requests: DataFrame) -> DataFrame:
    """The items of fully valid requests as topic messages `(topic, value)`."""
    publishable = F.when(F.col("status").isin(200, 201), F.col("items"))
    return (
        dispose_requests(requests)
        .select("topic", F.explode(publishable).alias("item"))
        .select("topic", F.to_json("item").alias("value"))
    )


def checked_requests(requests: DataFrame) -> DataFrame:
    """Each request with all that is reported or published of it, to be stored: one pass checks it once.

    Columns: request_id, endpoint, topic, status, accepted, `failed_items` (index and errors of the items that
    have any), and `messages`, the texts of the items it may publish.
    """
    indexed = F.transform("errors", lambda errors, index: F.struct(index.alias("index"), errors.alias("item_errors")))
    publishable = F.when(F.col("status").isin(200, 201), F.transform("items", lambda item: F.to_json(item)))
    # Taken out of an array by an outer explode, the decided request is not taken apart, and so checked, again.
    decided = dispose_requests(requests).select(
        "request_id",
        "endpoint",
        F.explode_outer(
            F.array(
                F.struct(
                    "topic",
                    "status",
                    "accepted",
                    F.filter(indexed, lambda item: F.size(item["item_errors"]) > 0).alias("failed_items"),
                    publishable.alias("messages"),
                )
            )
        ).alias("decided"),
    )
    return decided.select("request_id", "endpoint", "decided.*")


def errors_of(checked: DataFrame) -> DataFrame:
    """The error report out of checked requests."""
    items = checked.select("request_id", "endpoint", F.explode("failed_items").alias("item"))
    return _reported(items.select("request_id", "endpoint", "item.*"))


def disposition_of(checked: DataFrame) -> DataFrame:
    """One row per checked request: status code and accepted item count."""
    return checked.select("request_id", "endpoint", "status", "accepted")


def messages_of(checked: DataFrame) -> DataFrame:
    """The items of fully valid requests as topic messages `(topic, value)`, out of checked requests."""
    return checked.select("topic", F.explode("messages").alias("value"))
