"""Column expressions over JSON text: whether it is one value, whether keys repeat at any depth, which keys an object has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_value(text: Column) -> Column:
    """Whether the text is one JSON value and nothing after it: as the value of a key, it leaves the key after it where it is."""
    return F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit(',"e":0}'))).eqNullSafe(F.array(F.lit("v"), F.lit("e")))


def repeats_a_key(text: Column) -> Column:
    """Whether an object at any depth of a JSON value has a key twice: Spark makes no VARIANT of such a text."""
    return is_value(text) & F.try_parse_json(text).isNull()


def has_keys(text: Column, names: Sequence[str]) -> Column:
    """Whether the text is an object of just these keys."""
    return F.array_sort(F.array_distinct(F.json_object_keys(text))).eqNullSafe(F.array(*map(F.lit, sorted(names))))


def part(text: Column, name: str) -> Column:
    """The text of a key's value, null for none or null; white space is gone, the order of keys is kept."""
    return F.get_json_object(text, f"$.{name}")


def elements(text: Column, name: str) -> Column:
    """The texts of the elements of a key's array, null where its value is no array."""
    return F.from_json(part(text, name), "array<string>")
