"""Field and category rules for hourly weather records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarmac.functions.numbers import EXACT, half_away

# Source tag written at landing and the pattern that reads the station back.
SOURCE_PREFIX = "meteostat_hourly_"
STATION_PATTERN = r"(D?\d+)$"


def station_code(source: Column) -> Column:
    """Trailing digits with an optional leading D; NULL when there are none."""
    return F.nullif(F.regexp_extract(source, STATION_PATTERN, 1), F.lit(""))


def hour_columns(payload: Column, source: Column) -> list[Column]:
    """Silver columns of one hourly record held as VARIANT; numbers and numeric text convert alike."""

    def number(key: str, to: str) -> Column:
        return F.try_variant_get(payload, f"$.{key}", to)

    wall_clock = F.try_variant_get(payload, "$.time", "string").try_cast("timestamp_ntz")
    return [
        station_code(source).alias("station_id"),
        wall_clock.cast("date").alias("date"),
        # the text form of a zone-less timestamp; formatting functions would pass through the session zone
        F.substring(wall_clock.cast("string"), 12, 8).alias("time"),
        number("temp", "decimal(5,2)").alias("temp_c"),
        number("prcp", "decimal(6,2)").alias("precipitation_mm"),
        half_away(number("snow", EXACT), "int").alias("snow"),
        half_away(number("wdir", EXACT), "int").alias("wind_dir"),
        number("wspd", "decimal(5,2)").alias("wind_speed"),
    ]


def category(temp: Column, rain: Column, snow: Column, wind: Column) -> Column:
    """Day label from untruncated means; the first rule that holds wins, NULL never holds."""
    return (
        F.when(snow > 1, "snowy")
        .when((rain > 10) & (temp > 0), "Heavy Rain")
        .when(rain.between(F.lit("0.2").cast("decimal(2,1)"), F.lit(10)) & (temp > 0), "Rainy")
        .when(wind > 30, "Windy")
        .when((temp < 0) & (rain <= F.lit("0.2").cast("decimal(2,1)")), "Freezing")
        .otherwise("Clear")
    )
