"""Reading untrusted JSON through Variant: presence, type and value of a field.

``from_json`` with a fixed schema nulls a whole array when one item has a wrong type;
Variant keeps each item as it is, so every rule can look at the real type.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def field(value: Column, name: str) -> Column:
    """The field as Variant: null when absent, a VOID variant when JSON null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """Type family of a Variant: STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, OBJECT, ARRAY, VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def text_of(value: Column) -> Column:
    """The string held by a Variant, null for any other type."""
    return F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def python_int(value: Column) -> Column:
    """``int(x)`` with Python's rules as a nullable bigint.

    Booleans count as 0/1, numbers truncate towards zero, strings must be a plain
    signed integer (underscores between digits allowed, so ``"3.0"`` is refused).
    """
    family = kind(value)
    digits = F.regexp_replace(F.btrim(F.try_variant_get(value, "$", "string"), F.lit(" \t\n\r\x0b\x0c")), "_", "")
    plain = F.try_variant_get(value, "$", "string").rlike(r"^\s*[+-]?\d+(_\d+)*\s*$")
    number = F.try_variant_get(value, "$", "double")
    bounded = F.when(F.abs(number) < 9.0e18, number)  # larger than any class id and than bigint
    return (
        F.when(family == "BOOLEAN", F.when(F.try_variant_get(value, "$", "boolean"), 1).otherwise(0))
        .when(family.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), F.coalesce(bounded.cast("bigint"), F.lit(-1)))
        .when((family == "STRING") & plain, F.coalesce(digits.try_cast("bigint"), F.lit(-1)))
        .cast("bigint")
    )
