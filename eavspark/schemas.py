"""Explicit schemas and keys of the entity-attribute-value store."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_SHORT, _INT, _TEXT, _NUM = ShortType(), IntegerType(), StringType(), DoubleType()

# Metadata ids are 16-bit. Ids of entities and codes, and row numbers, are wide: one
# store may unite more than a 32-bit page file holds, and one series may be long.
_ID = LongType()


def _struct(*fields: tuple) -> StructType:
    # a third element marks a nullable column
    return StructType([StructField(f[0], f[1], len(f) > 2) for f in fields])


def _values(name: str, dtype) -> StructType:
    return _struct(("entity_id", _ID), ("attribute_id", _SHORT), ("seq", _ID), (name, dtype))


SCHEMAS: dict[str, StructType] = {
    "data_types": _struct(
        ("id", _SHORT), ("name", _TEXT), ("value_table", _TEXT), ("lookup_table", _TEXT, True),
        ("alt_value_table", _TEXT, True), ("alt_lookup_table", _TEXT, True),
    ),
    "entity_types": _struct(
        ("id", _SHORT), ("key_index_type_id", _SHORT), ("default_index_type_id", _SHORT),
        ("name", _TEXT), ("id_line_view_id", _SHORT), ("id_attribute_id", _SHORT),
    ),
    "entities": _struct(
        ("id", _ID), ("entity_type_id", _SHORT), ("name", _TEXT),
        ("last_updated", TimestampNTZType()),
    ),
    "attributes": _struct(
        ("id", _SHORT), ("data_type_id", _SHORT), ("entity_type_id", _SHORT),
        ("table_id", _SHORT, True), ("name", _TEXT), ("comment", _TEXT, True),
        ("quark", _SHORT, True), ("display_length", _SHORT, True), ("format", _TEXT, True),
        ("max", _NUM, True), ("min", _NUM, True), ("lookup_type_id", _SHORT, True),
    ),
    "tables": _struct(
        ("id", _SHORT), ("entity_type_id", _SHORT), ("name", _TEXT), ("date_attribute_id", _SHORT)
    ),
    "lookups": _struct(
        ("id", _ID), ("lookup_type_id", _SHORT), ("name", _TEXT), ("code", _TEXT, True)
    ),
    "lookup_types": _struct(("id", _SHORT), ("name", _TEXT)),
    "index_types": _struct(
        ("id", _SHORT), ("entity_type_id", _SHORT), ("name", _TEXT), ("prefix", _TEXT, True),
        ("id_line_view_id", _SHORT),
    ),
    "indexes": _struct(("index_type_id", _SHORT), ("term", _TEXT), ("entity_id", _ID)),
    # the same by folded term, the order in which it is stored and searched
    "terms": _struct(
        ("folded", _TEXT), ("index_type_id", _SHORT), ("term", _TEXT), ("entity_id", _ID)
    ),
    "views": _struct(
        ("id", _SHORT), ("name", _TEXT), ("n_rows", _SHORT), ("n_items", _SHORT),
        ("table_id", _SHORT), ("entity_type_id", _SHORT),
    ),
    "view_attributes": _struct(
        ("view_id", _SHORT), ("seq", _SHORT), ("attribute_id", _SHORT), ("x", _SHORT), ("y", _SHORT)
    ),
    "view_captions": _struct(
        ("view_id", _SHORT), ("seq", _SHORT), ("caption", _TEXT, True), ("x", _SHORT), ("y", _SHORT)
    ),
    "menus": _struct(("id", _SHORT), ("name", _TEXT), ("entity_type_id", _SHORT)),
    "menu_items": _struct(
        ("menu_id", _SHORT), ("seq", _SHORT), ("name", _TEXT), ("function", _TEXT, True),
        ("next_menu_id", _SHORT), ("start_menu_id", _SHORT), ("parameter1", _SHORT),
        ("parameter2", _SHORT), ("parameter3", _SHORT), ("parameter4", _SHORT),
    ),
    "user_starters": _struct(
        ("id", _SHORT), ("user_name", _TEXT, True), ("menu_id", _SHORT), ("entity_type_id", _SHORT),
        ("id_line_view_id", _SHORT), ("index_type_id", _SHORT),
    ),
    # when the values of an entity were last loaded: its time of update then
    "loads": _struct(("entity_id", _ID), ("updated", TimestampNTZType())),
    "value_texts": _values("value", _TEXT),
    "value_long_texts": _values("value", _TEXT),
    "value_numbers": _values("value", _NUM),
    "value_dates": _values("value", DateType()),
    "value_times": _values("value", _INT),  # seconds of the day
    "value_lookups": _values("lookup_id", _ID),
    "value_entities": _values("linked_entity_id", _ID),
}

VALUE_KEY = ["entity_id", "attribute_id", "seq"]

VALUE_TABLES = [name for name in SCHEMAS if name.startswith("value_")]

BY_ENTITY = [*VALUE_TABLES, "loads"]  # stored in buckets of entities

KEYS: dict[str, list[str]] = {
    **{name: ["id"] for name in SCHEMAS},
    **{name: VALUE_KEY for name in VALUE_TABLES},
    "loads": ["entity_id"],
    "indexes": ["index_type_id", "term", "entity_id"],
    "terms": ["folded", "index_type_id", "term", "entity_id"],
    "view_attributes": ["view_id", "seq"],
    "view_captions": ["view_id", "seq"],
    "menu_items": ["menu_id", "seq"],
}

# The logical data types (fixed ids).
TEXT, NUMERIC, LOOKUP, DATE, ENTITY_PTR, LONG_TEXT, QUALIFIED, TIME = 1, 2, 3, 4, 5, 6, 7, 8
