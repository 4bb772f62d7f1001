"""Generated date inputs: the day spine, fetch windows and yearly file names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spine bounds, first year of history, window length, file name pattern.
SPINE_FIRST, SPINE_LAST = "2000-01-01", "2030-12-31"
FIRST_YEAR = 2010
WINDOW_DAYS = 31
STEM = "nehody_%d01-%d12"


def day_columns(day: Column, first: str = SPINE_FIRST) -> list[Column]:
    """Date attributes of one day; ids count from 1 in date order, Monday is day 1."""
    return [
        (F.date_diff(day, F.lit(first).cast("date")) + 1).alias("date_id"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
    ]


def date_spine(spark: SparkSession, first: str = SPINE_FIRST, last: str = SPINE_LAST) -> DataFrame:
    """One row per day, both ends included; 11,323 rows for the default bounds."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day")).select(*day_columns(F.col("day"), first))


def file_stem(year: Column) -> Column:
    return F.format_string(STEM, year, year)


def years(as_of: dt.date, backfill: bool) -> tuple[int, int]:
    """First and last year to load as of a day: all history, or the previous year alone."""
    last = as_of.year - 1
    return (FIRST_YEAR if backfill else last), last


def year_files(spark: SparkSession, as_of: dt.date, backfill: bool) -> DataFrame:
    """The yearly files a run should read: ``year``, ``stem``."""
    first, last = years(as_of, backfill)
    return (
        spark.range(first, last + 1)
        .select(F.col("id").cast("int").alias("year"))
        .withColumn("stem", file_stem(F.col("year")))
    )


def year_file_paths(folder: str, as_of: dt.date, backfill: bool) -> list[str]:
    first, last = years(as_of, backfill)
    return [f"{folder}/{STEM % (y, y)}.geojson" for y in range(first, last + 1)]


def fetch_bounds(as_of: dt.date, backfill: bool) -> tuple[dt.date, dt.date]:
    """Days to request: history up to the day before ``as_of``, or the whole previous year."""
    if backfill:
        return dt.date(FIRST_YEAR, 1, 1), as_of - dt.timedelta(days=1)
    return dt.date(as_of.year - 1, 1, 1), dt.date(as_of.year - 1, 12, 31)


def fetch_windows(
    stations: DataFrame, first: dt.date, last: dt.date, days: int | None = WINDOW_DAYS
) -> DataFrame:
    """Adjacent windows per station row, without overlap; ``days=None`` gives one window.

    Each station row unfolds its own windows, so there is no join to make.
    """
    begin, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    if first > last:
        return stations.where(F.lit(False)).select("*", begin.alias("start"), end.alias("end"))
    if days is None:
        return stations.select("*", begin.alias("start"), end.alias("end"))
    step = F.make_dt_interval(F.lit(days))
    return stations.select("*", F.explode(F.sequence(begin, end, step)).alias("start")).withColumn(
        "end", F.least(F.date_add("start", days - 1), end)
    )
