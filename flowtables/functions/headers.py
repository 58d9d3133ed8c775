"""Attribute maps as JSON header text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING_MAP = "map<string,string>"


def sorted_map(attributes: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(attributes)))


def header_text(attributes: Column) -> Column:
    """JSON object with sorted keys; null attribute values become JSON nulls."""
    return F.to_json(sorted_map(attributes))


def text_value_json(value: Column) -> Column:
    """A value as a JSON string, or null."""
    quoted = F.to_json(F.create_map(F.lit("v"), value))
    return F.substring(quoted, F.lit(6), F.length(quoted) - 6)


def typed_value_json(value: Column) -> Column:
    """JSON text of one attribute value: what it parses to, else the value as a JSON string."""
    return F.coalesce(F.to_json(F.try_parse_json(value)), text_value_json(value))


def typed_header_text(attributes: Column, text_regex: str | None = None) -> Column:
    """JSON object with sorted keys whose values are numbers, booleans, objects or strings; the values of names that
    match ``text_regex`` as a whole stay strings."""
    entries = F.array_sort(F.map_entries(attributes))

    def value(entry: Column) -> Column:
        typed = typed_value_json(entry["value"])
        if text_regex is None:
            return typed
        return F.when(entry["key"].rlike(rf"\A(?:{text_regex})\z"), text_value_json(entry["value"])).otherwise(typed)

    def member(entry: Column) -> Column:
        quoted = F.to_json(F.create_map(entry["key"], F.lit("")))
        key = F.substring(quoted, F.lit(2), F.length(quoted) - 5)
        return F.concat(key, F.lit(":"), value(entry))

    return F.concat(F.lit("{"), F.array_join(F.transform(entries, member), ","), F.lit("}"))


def json_type(text: Column) -> Column:
    """number, boolean, object, array, string or null for one JSON text; null if it does not parse."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return (
        F.when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "STRING", "string")
        .when(kind == "VOID", "null")
        .when(kind.isNotNull(), "number")
    )


def header_attributes(header: Column) -> Column:
    """Attribute map of a JSON header, JSON null as the text ``null``; null if not a JSON object."""
    parsed = F.from_json(header, _STRING_MAP)
    return F.transform_values(parsed, lambda _, v: F.coalesce(v, F.lit("null")))
