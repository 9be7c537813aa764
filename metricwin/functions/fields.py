"""Reading fields out of a JSON object parsed as a map of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field_or(fields: Column, name: Column, default: Column) -> Column:
    """The field's text, null if the JSON value is null, ``default`` if it is missing.

    A null map (not a JSON object) gives null, never the default.
    """
    return F.coalesce(fields[name], F.when(~F.map_contains_key(fields, name), default))


def last_of_repeated(fields: Column) -> Column:
    """The map with each field once: of fields that are repeated the last counts."""
    names = F.map_keys(fields)

    def stays(entry: Column, place: Column) -> Column:
        return ~F.array_contains(F.slice(names, place + 2, F.size(names)), entry["key"])

    repeated = F.size(F.array_distinct(names)) < F.size(names)
    once = F.map_from_entries(F.filter(F.map_entries(fields), stays))
    return F.when(repeated, once).otherwise(fields)


def is_boolean(message: Column, name: str) -> Column:
    """Whether a JSON object's field is ``true`` or ``false`` itself, not a text of that name."""
    value = F.try_variant_get(F.try_parse_json(message), f"$.{name}", "variant")
    return F.coalesce(F.schema_of_variant(value) == "BOOLEAN", F.lit(False))


def first_filled(fields: Column, *names: str) -> Column:
    """The first of the named fields that is neither missing, null nor empty."""
    return F.coalesce(*[F.nullif(fields[F.lit(n)], F.lit("")) for n in names])


#: A decimal number, infinity or NaN; no type letters and no hexadecimal, which Spark would read.
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def number(text: Column, value_type: str = "double") -> Column:
    """A number's text as a number, else null; blanks and quotes left by bare NaN do not matter."""
    plain = F.trim(text, F.lit('" '))
    return F.when(plain.rlike(_NUMBER), plain.try_cast(value_type))
