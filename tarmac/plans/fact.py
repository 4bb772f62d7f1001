"""Fact assembly: nearest city, date, nearest road, weather of the city's station."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.operators.nearest import NearestIndex, build_index, line_shapes, point_shapes

# The date dimension is generated with a fixed number of days; beyond this it is not broadcast.
_SPINE_LIMIT = 50_000
_SKETCH_KEYS = 10_000  # that the sketch of heavy keys reports at most


def city_index(cities: DataFrame) -> NearestIndex:
    """Index of the cities, which hands over their ``station_id``."""
    return build_index(point_shapes(cities, "city_id", "lon", "lat", "station_id"))


def road_index(roads: DataFrame) -> NearestIndex:
    """Index of the road lines, to be stored beside them."""
    return build_index(line_shapes(roads, "road_id", "geom"))


def both_indexes(cities: DataFrame, roads: DataFrame) -> tuple[NearestIndex, NearestIndex]:
    """The two indexes, made side by side: each is a series of small jobs."""
    with ThreadPoolExecutor(2) as pool:
        city, road = pool.submit(city_index, cities), pool.submit(road_index, roads)
        return city.result(), road.result()


def with_city(places: DataFrame, cities: NearestIndex, **options) -> DataFrame:
    """``places`` with ``city_id`` and ``station_id`` of the closest city."""
    return cities.join(places, "lon", "lat", {"city_id": "id", "station_id": "station_id"}, **options)


def with_road(places: DataFrame, roads: NearestIndex, **options) -> DataFrame:
    """``places`` with ``road_id`` of the closest road line."""
    return roads.join(places, "lon", "lat", {"road_id": "id"}, **options)


def with_date_id(rows: DataFrame, dates: DataFrame, day: str = "date") -> DataFrame:
    """Left join on the calendar day; a timestamp off midnight or outside the spine gets NULL."""
    spine = dates.select(F.col("date").cast("timestamp_ntz").alias("_day"), "date_id")
    if dates.limit(_SPINE_LIMIT + 1).count() <= _SPINE_LIMIT:
        spine = F.broadcast(spine)
    joined = rows.join(spine, F.col(day).cast("timestamp_ntz") == F.col("_day"), "left")
    return joined.drop("_day")


def heavy_keys(rows: DataFrame, key: Column, partitions: int) -> DataFrame:
    """``key, salts`` of the keys that hold more than half the rows of an average task, measured by a mergeable sketch.

    There are fewer than twice as many of them as tasks.  ``salts`` is the number of half tasks a key fills.
    """
    most = min(2 * partitions, _SKETCH_KEYS)
    sketch = F.expr(f"approx_top_k(_key, {most}, {10 * most})")
    found, n = rows.select(key.alias("_key")).agg(sketch, F.count("*")).first()
    half = max(1.0, n / (2 * partitions))
    salts = [(r.item, math.ceil(r["count"] / half)) for r in found if r.item is not None and r["count"] > half]
    return rows.sparkSession.createDataFrame(salts, "_heavy string, _salts int")


def with_weather_id(rows: DataFrame, weather: DataFrame, row_key: str, day: str = "date") -> DataFrame:
    """Left join on station and day.

    Rows without a station or day match nothing; a salt no weather row carries spreads them, so they do not pile up in one
    task.  Station-days that hold many rows are found first: their rows are dealt to several tasks, and their one weather row is
    repeated for each of these.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def key(at: Column) -> Column:
        return F.concat_ws("|", "station_id", at.cast("timestamp_ntz").cast("string"))

    loose = F.col("station_id").isNull() | F.col(day).isNull()
    heavy = F.broadcast(heavy_keys(rows, F.when(~loose, key(F.col(day))), partitions))
    dealt = F.when(loose, -1 - F.pmod(F.xxhash64(row_key), F.lit(1024))).otherwise(
        F.coalesce(F.pmod(F.xxhash64(row_key), F.col("_salts")), F.lit(0))
    )
    own = rows.withColumns({"_day": F.col(day).cast("timestamp_ntz"), "_key": key(F.col(day))})
    salted = own.join(heavy, F.col("_key") == F.col("_heavy"), "left").select(*rows.columns, "_day", dealt.cast("int").alias("_salt"))
    repeated = weather.select("station_id", F.col("date").cast("timestamp_ntz").alias("_day"), "weather_id", key(F.col("date")).alias("_key"))
    facts = repeated.join(heavy, F.col("_key") == F.col("_heavy"), "left").select(
        "station_id", "_day", "weather_id", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt")
    )
    return salted.join(facts, ["station_id", "_day", "_salt"], "left").select(
        *rows.columns, "weather_id"
    )


def assemble_fact(
    accidents: DataFrame,
    cities: NearestIndex,
    dates: DataFrame,
    roads: NearestIndex,
    weather: DataFrame,
    **options,
) -> DataFrame:
    """One row per accident; none at all when there is no city or no road."""
    needed = accidents.select("accident_id", "lon", "lat", "date", "total_damage", "cause")
    placed = with_road(with_city(needed, cities, **options), roads, **options)
    dated = with_date_id(placed, dates)
    return with_weather_id(dated, weather, "accident_id").select(
        "accident_id",
        "city_id",
        "date_id",
        "road_id",
        "weather_id",
        "total_damage",
        F.col("cause").alias("main_cause"),
    )
