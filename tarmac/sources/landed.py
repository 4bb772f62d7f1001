"""Scans of landed city, weather and road-line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.functions.geometry import line_points, wkb_points
from tarmac.functions.roads import tag_map
from tarmac.functions.weather import SOURCE_PREFIX

CITY_FIELDS = "city string, region string, lat double, lon double, station_id string"


def cities(spark: SparkSession, path: str) -> DataFrame:
    """City reference list, one JSON array per file."""
    return spark.read.schema(CITY_FIELDS).option("multiLine", True).json(path)


def station_ids(city_rows: DataFrame) -> DataFrame:
    """Distinct stations in ascending order."""
    return city_rows.select("station_id").distinct().orderBy("station_id")


def hour_records(response: Column) -> Column:
    """The ``data`` array of a weather response as VARIANT values; NULL when absent."""
    return F.from_json(response, "data array<variant>")["data"]


def explode_hours(responses: DataFrame, response: str, station: str, *keep: str) -> DataFrame:
    """One bronze row per hourly record: its payload and the source tag of its station."""
    return responses.select(
        *keep,
        F.explode(hour_records(F.col(response))).alias("payload"),
        F.concat(F.lit(SOURCE_PREFIX), F.col(station)).alias("source"),
    )


def weather_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses ``station=<id>/*.json``; a file holds one window of one station."""
    station = F.regexp_extract(F.col("_metadata.file_path"), r"station=([^/]+)/", 1)
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return explode_hours(files.select("value", station.alias("station")), "value", "station")


def road_lines(extract: DataFrame) -> DataFrame:
    """Highway lines of an extract with ``osm_id``, ``highway``, ``wkb`` or ``wkt``, and ``all_tags`` text.

    The filter reads the plain column, so a scan can skip the other lines before any tag is parsed.
    """
    return extract.where(F.col("highway").isNotNull()).select(
        F.col("osm_id").cast("bigint").alias("osm_id"),
        "highway",
        (wkb_points(F.col("wkb")) if "wkb" in extract.columns else line_points(F.col("wkt"))).alias("geom"),
        tag_map(F.col("all_tags")).alias("tags"),
    )
