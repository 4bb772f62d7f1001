"""Tag rules for road lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarmac.functions.numbers import half_away

# Named speed limits, road-type defaults, the mile factor and the one-way spellings.
NAMED_LIMITS = {
    "CZ:urban": 50,
    "CZ:rural": 90,
    "CZ:living_street": 20,
    "CZ:pedestrian_zone": 20,
    "walk": 5,
}
ROAD_TYPE_LIMITS = {"residential": 30, "motorway": 130}
KM_PER_MILE = "1.609"
ONE_WAY = ["yes", "alternating", "reversible", "1", "-1"]

_PAIR = r'"((?:[^"\\]|\\.)*)"=>("(?:[^"\\]|\\.)*"|NULL)'


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def tag_map(text: Column) -> Column:
    """``"key"=>"value"`` text as a map; a bare NULL is a null value, a repeated key keeps its first."""
    keys = F.transform(F.regexp_extract_all(text, F.lit(_PAIR), F.lit(1)), _unescape)
    values = F.transform(
        F.regexp_extract_all(text, F.lit(_PAIR), F.lit(2)),
        lambda v: F.when(v != "NULL", _unescape(F.substring(v, F.lit(2), F.length(v) - 2))),
    )

    def firsts(pairs: Column) -> Column:
        return F.filter(pairs, lambda p, i: F.array_position(pairs["key"], p["key"]) == i + 1)

    # the one-element array binds the parsed pairs to a name, so the text is parsed once, not per pair
    pairs = F.array(F.arrays_zip(keys.alias("key"), values.alias("value")))
    return F.map_from_entries(F.get(F.transform(pairs, firsts), F.lit(0)))


def lane_count(text: Column) -> Column:
    """Absolute whole lane count; lists and fractions give NULL."""
    return F.abs(text.try_cast("int").cast("bigint")).try_cast("smallint")


def max_speed(limit: Column, road_type: Column) -> Column:
    """Speed limit in km/h: named zones, miles, first number found, then road-type defaults."""
    miles = F.replace(limit, F.lit(" mph"), F.lit("")).try_cast("decimal(18,6)")
    rule = F.when(limit == "none", F.lit(None).cast("smallint"))
    for name, value in NAMED_LIMITS.items():
        rule = rule.when(limit == name, F.lit(value).cast("smallint"))
    rule = rule.when(
        limit.endswith("mph"), half_away(miles * F.lit(KM_PER_MILE).cast("decimal(4,3)"), "smallint")
    ).when(limit.rlike("[0-9]"), F.regexp_substr(limit, F.lit("[0-9]+")).try_cast("smallint"))
    for name, value in ROAD_TYPE_LIMITS.items():
        rule = rule.when(road_type == name, F.lit(value).cast("smallint"))
    return rule


def one_way(text: Column) -> Column:
    """True for the known one-way spellings, false for everything else including NULL."""
    return F.coalesce(text.isin(ONE_WAY), F.lit(False))
