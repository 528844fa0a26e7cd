"""Strict JSON: complete documents only, and types checked without coercion.

Spark's JSON readers stop after the first value and ignore what follows, so `{"a": 1} junk` would
pass. Both readers below wrap the text before parsing it, which turns trailing text into an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The closing marker is a hash of the text, which no text holds itself.


def strict_variant(text: Column) -> Column:
    """The text as a variant, or NULL if it is not exactly one JSON value.

    The text is parsed once, between `[` and a closing marker; the filter over the one-element
    array drops the result if the marker is not where it belongs.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.md5(text), F.lit('"]')))
    closed = F.filter(F.array(wrapped), lambda value: F.try_variant_get(value, "$[1]", "string") == F.md5(text))
    return F.try_variant_get(F.get(closed, F.lit(0)), "$[0]", "variant")


def strict_elements(text: Column) -> Column:
    """The elements of a text that is exactly one JSON array, each a variant of its own; NULL for any other text.

    The array is read element by element, so the bound on a variant's size holds for an element, not for all.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(',["'), F.md5(text), F.lit('"]]'))
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    parsed = F.array(F.from_json(wrapped, "array<array<variant>>", options))

    def complete(lists: Column) -> Column:
        end = F.get(F.get(lists, F.lit(1)), F.lit(0))
        return (F.size(lists) == 2) & (F.try_variant_get(end, "$", "string") == F.md5(text))

    return F.get(F.get(F.filter(parsed, complete), F.lit(0)), F.lit(0))


def starts_with(text: Column, bracket: str) -> Column:
    """Whether the first character of a JSON text that is not blank is the given bracket."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith(bracket)


def strict_documents(text: Column, schema: str, key: str) -> Column:
    """The text's one JSON object, typed, in an array; NULL if it is not one object fitting the schema.

    An object without its `key` does not fit, nor does a number written as text, NaN or infinity. A
    STRING field takes any JSON value, a number or an object as its text.

    The text becomes the only element of an array inside an object with a closing member, so one
    pass both types the fields and proves that the text held one complete value. The parsed value is
    referenced once only, for Spark would repeat the parse for every further reference.
    """
    frame = F.concat(F.lit('{"documents":['), text, F.lit('],"closed":1}'))
    layout = f"documents ARRAY<STRUCT<{' '.join(schema.split())}>>, closed INT, broken STRING"
    options = {"columnNameOfCorruptRecord": "broken", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    parsed = F.array(F.from_json(frame, layout, options))

    def complete(record: Column) -> Column:
        return (
            record["broken"].isNull()
            & (record["closed"] == 1)
            & (F.size(record["documents"]) == 1)
            & F.get(record["documents"], F.lit(0))[key].isNotNull()
        )

    return F.get(F.filter(parsed, complete), F.lit(0))["documents"]
