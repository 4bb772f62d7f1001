"""Bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions.accidents import accident_columns
from tarmac.functions.geometry import is_line
from tarmac.functions.roads import lane_count, max_speed, one_way
from tarmac.functions.weather import hour_columns
from tarmac.operators.quality import quarantine
from tarmac.sources.bronze import choose

# An accident keeps its id when its file is landed again: the file's first raw id and the feature's
# position, packed side by side.  Unlike a hash, two accidents can never share one.
_ORDINAL_BITS = 36
_ID_BITS = 63 - _ORDINAL_BITS
FEW_LOADS = 1_000_000  # an id and a name or two ids each, some tens of MB to every task at most


def clean_accidents(files: DataFrame, features: DataFrame, backfill: bool = False) -> DataFrame:
    """Typed accidents of the newest file, or of every file's newest load for a backfill.

    ``files`` holds one row per load.  For the newest file its id is pushed into the feature scan; for a
    backfill the chosen loads are joined, without moving the features while the loads are few.
    """
    first = files.groupBy("source").agg(F.min("raw_id").alias("first_id"))
    chosen = choose(files, backfill).join(first, "source").select("raw_id", "first_id")
    if not backfill:
        features = features.where(F.col("raw_id") == files.agg(F.max("raw_id")).scalar())
    if chosen.limit(FEW_LOADS + 1).count() <= FEW_LOADS:
        chosen = F.broadcast(chosen)
    fits = (F.col("first_id") < F.lit(1 << _ID_BITS)) & (F.col("ordinal") < F.lit(1 << _ORDINAL_BITS))
    packed = F.shiftleft("first_id", _ORDINAL_BITS).bitwiseOR(F.col("ordinal"))
    accident_id = F.when(fits, packed).otherwise(F.raise_error(F.lit("accident id out of range")).cast("bigint"))
    return features.join(chosen, "raw_id").select(
        accident_id.alias("accident_id"), "raw_id", *accident_columns(F.col("payload"))
    )


def clean_weather(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed hours with ``raw_id``, and the quarantine of rows without a full key."""
    hours = raw.select("raw_id", *hour_columns(F.col("payload"), F.col("source")))
    return quarantine(
        hours,
        {
            "no station code": F.col("station_id").isNull(),
            "no readable time": F.col("date").isNull(),
        },
    )


def road_columns(ways: DataFrame) -> DataFrame:
    """Silver road columns from tags."""
    tags = F.col("tags")
    return ways.select(
        F.col("osm_id").alias("road_id"),
        tags["name"].alias("name"),
        tags["highway"].alias("road_type"),
        F.lit(False).alias("is_intersection"),
        lane_count(tags["lanes"]).alias("lanes"),
        max_speed(tags["maxspeed"], tags["highway"]).alias("max_speed"),
        one_way(tags["oneway"]).alias("oneway"),
        "geom",
    )


def clean_roads(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed roads, and the quarantine of ways without an id or a line."""
    return quarantine(
        road_columns(ways),
        {"no id": F.col("road_id").isNull(), "no line": ~is_line(F.col("geom"))},
    )
