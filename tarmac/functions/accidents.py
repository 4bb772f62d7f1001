"""Field rules for accident features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarmac.functions.numbers import EXACT, half_away
from tarmac.functions.payload import field, kind, text_any, text_only, whole_number

# The currency suffix and the property names of the published accident files.
CURRENCY_SUFFIX = " Kč"
DAMAGE, DAY, CAUSE, COLLISION = "hmotna_skoda", "datum", "pricina", "druh"
SLIGHT, SEVERE, FATAL = "lehce_zraneno", "tezce_zraneno", "usmrceno"

_CLOCK = r"([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?"
_ISO = rf"^(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}})([\s\S]{_CLOCK}(Z|[+-]{_CLOCK})?)?$"


def money_text(text: Column) -> Column:
    """Whole crowns written as text; anything but plain digits gives NULL."""
    digits = F.replace(F.replace(text, F.lit(CURRENCY_SUFFIX), F.lit("")), F.lit(" "), F.lit(""))
    return F.when(digits.rlike("^[0-9]+$"), digits.try_cast("bigint"))


def damage(payload: Column, path: str = f"$.properties.{DAMAGE}") -> Column:
    """Total damage: 0 when missing, NULL for null, nested, boolean or unreadable values."""
    raw = field(payload, path)
    typed = kind(raw)
    number = typed.isin("BIGINT", "DOUBLE", "FLOAT") | typed.startswith("DECIMAL")
    return (
        F.when(raw.isNull(), F.lit(0).cast("bigint"))
        .when(typed == "STRING", money_text(F.try_variant_get(raw, "$", "string")))
        .when(number, half_away(F.try_variant_get(raw, "$", EXACT), "bigint"))
    )


def iso_day(text: Column) -> Column:
    """Calendar day as written in an ISO 8601 date or date-time; the offset plays no part."""
    compact = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    return F.when(text.rlike(_ISO), F.substring(compact, 1, 10).try_cast("date"))


def strip_text(text: Column) -> Column:
    """Trim Unicode white space; empty text becomes NULL, all-blank text becomes empty."""
    return F.when(text != "", F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))


def coordinate(payload: Column, axis: int) -> Column:
    """Position ``axis`` (0 = lon, 1 = lat) of the geometry, NULL when absent."""
    return F.try_variant_get(payload, f"$.geometry.coordinates[{axis}]", "double")


def accident_columns(payload: Column) -> list[Column]:
    """The silver columns read from one feature."""
    return [
        coordinate(payload, 1).alias("lat"),
        coordinate(payload, 0).alias("lon"),
        iso_day(text_only(payload, f"$.properties.{DAY}")).cast("timestamp_ntz").alias("date"),
        strip_text(text_only(payload, f"$.properties.{CAUSE}")).alias("cause"),
        text_any(payload, f"$.properties.{COLLISION}").alias("collision_type"),
        whole_number(payload, f"$.properties.{SLIGHT}").alias("slightly_injured"),
        whole_number(payload, f"$.properties.{SEVERE}").alias("severely_injured"),
        whole_number(payload, f"$.properties.{FATAL}").alias("fatalities"),
        damage(payload).alias("total_damage"),
    ]
