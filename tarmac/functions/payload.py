"""Typed access to VARIANT payloads, where missing, null and wrongly typed values differ."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarmac.functions.numbers import EXACT, half_away


def field(payload: Column, path: str) -> Column:
    """Sub-value as VARIANT: SQL NULL when missing, a VOID variant for JSON null."""
    return F.try_variant_get(payload, path, "variant")


def kind(value: Column) -> Column:
    """Type name of a VARIANT value; SQL NULL for a missing value."""
    return F.schema_of_variant(value)


def json_text(payload: Column, key: str) -> Column:
    """A field of JSON text as text; null and missing give NULL."""
    return F.get_json_object(payload, f"$.{key}")


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def text_only(payload: Column, path: str) -> Column:
    """The field when it is a JSON string, else NULL."""
    raw = field(payload, path)
    return F.when(kind(raw) == "STRING", F.try_variant_get(raw, "$", "string"))


def text_any(payload: Column, path: str) -> Column:
    """Any scalar as text; null, missing and nested values give NULL."""
    raw = field(payload, path)
    nested = kind(raw).startswith("OBJECT") | kind(raw).startswith("ARRAY")
    return F.when(~nested, F.try_variant_get(raw, "$", "string"))


def whole_number(payload: Column, path: str, to: str = "int") -> Column:
    """Number or numeric text rounded to an integer; anything else gives NULL."""
    raw = field(payload, path)
    return F.when(kind(raw) != "BOOLEAN", half_away(F.try_variant_get(raw, "$", EXACT), to))
