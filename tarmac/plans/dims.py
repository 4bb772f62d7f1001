"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.functions.numbers import half_away, truncate
from tarmac.functions.weather import category


def city_rows(cities: DataFrame) -> DataFrame:
    return cities.select(F.col("city").alias("city_name"), "region", "lat", "lon", "station_id")


def road_rows(roads: DataFrame) -> DataFrame:
    """Roads without name and geometry."""
    return roads.select("road_id", "road_type", "is_intersection", "lanes", "max_speed", "oneway")


def daily_weather(hours: DataFrame) -> DataFrame:
    """One row per station and day: truncated means, rounded wind direction, category."""
    return weather_of_days(weather_sums(hours))


_SUMS = {"temp": "temp_c", "rain": "precipitation_mm", "snow": "snow", "direction": "wind_dir", "wind": "wind_speed"}


def weather_sums(hours: DataFrame) -> DataFrame:
    """Exact sums and counts of the measures per station and day, combined before the one shuffle."""
    sums = [F.sum(measure).alias(f"{name}_sum") for name, measure in _SUMS.items()]
    counts = [F.count(measure).alias(f"{name}_n") for name, measure in _SUMS.items()]
    return hours.groupBy("station_id", "date").agg(*sums, *counts)


def merged_sums(parts: DataFrame) -> DataFrame:
    """Sums of one row per station and day from those of several loads."""
    kinds = dict(parts.dtypes)
    added = [F.sum(c).cast(kinds[c]).alias(c) for name in _SUMS for c in (f"{name}_sum", f"{name}_n")]
    return parts.groupBy("station_id", "date").agg(*added)


def weather_of_days(sums: DataFrame) -> DataFrame:
    """Days from their sums; the category reads the untruncated means."""

    def mean(name: str) -> Column:
        return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n")).alias(name)

    def whole(name: str, to: str) -> Column:
        return F.try_divide(F.col(f"{name}_sum").cast("decimal(20,0)"), F.col(f"{name}_n")).alias(to)

    means = sums.select(
        "station_id", "date", mean("temp"), mean("rain"), whole("snow", "snow_mean"), whole("direction", "direction"), mean("wind")
    )
    return means.select(
        "station_id",
        "date",
        truncate(F.col("temp"), 2).cast("decimal(5,2)").alias("temp_c"),
        truncate(F.col("rain"), 2).cast("decimal(6,2)").alias("precipitation_mm"),
        truncate(F.col("snow_mean"), 2).cast("decimal(6,2)").alias("snow"),
        half_away(F.col("direction"), "int").alias("wind_dir"),
        truncate(F.col("wind"), 2).cast("decimal(5,2)").alias("wind_speed"),
        category(F.col("temp"), F.col("rain"), F.col("snow_mean"), F.col("wind")).alias(
            "weather_category"
        ),
    )
