"""Weather roll-up, spatial joins, the fact and the constraint checks on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.operators.keys import dense_ids, max_id
from tarmac.operators.merge import first_per_key, insert_only_merge
from tarmac.operators.nearest import PAGES_SCHEMA, NearestIndex, line_shapes, nearest_join, point_shapes
from tarmac.functions.weather import hour_columns
from tarmac.operators.quality import delta_pk_violations, fk_violations, not_null_violations, pk_violations
from tarmac.plans import clean, dims, fact
from tarmac.plans.pipeline import Warehouse
from tarmac.sources.calendar import date_spine
from tarmac.session import scratch_path
from tarmac.sources.landed import road_lines
from tarmac.sources.tables import Table
from tarmac.workload.common import (
    CITY_SQL,
    NEAREST_CITY_SQL,
    NEAREST_ROAD_SQL,
    POINTS_SQL,
    WAYS_SQL,
    WEATHER_SQL,
    Query,
    accident_points,
    city_dim,
    load,
    sql_point_distance,
    way_extract,
    weather_raw,
    with_sql,
)

# -------------------------------------------------------------------------------------- weather


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = clean.clean_weather(weather_raw(spark, sf_dir))
    return first_per_key(good, ["station_id", "date", "time"], [F.col("raw_id")])


def _measures(df: DataFrame) -> list:
    return [
        F.col("temp_c").cast("double").alias("temp_c"),
        F.col("precipitation_mm").cast("double").alias("precipitation_mm"),
        F.col("snow").cast("double").alias("snow"),
        F.col("wind_dir").cast("bigint").alias("wind_dir"),
        F.col("wind_speed").cast("double").alias("wind_speed"),
    ]


def weather_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _hours(spark, sf_dir)
    return hours.select(
        "station_id", F.col("date").cast("string").alias("date"), "time", *_measures(hours)
    )


_MEASURES_SQL = """temp / CAST(100 AS DOUBLE) AS temp_c, prcp / CAST(100 AS DOUBLE) AS precipitation_mm,
       {snow} AS snow, CAST(wdir AS BIGINT) AS wind_dir, wspd / CAST(100 AS DOUBLE) AS wind_speed"""

WEATHER_CLEAN = with_sql(WEATHER_SQL) + f"""
SELECT station_id, strftime(d, '%Y-%m-%d') AS date, t AS time,
       {_MEASURES_SQL.format(snow='CAST(snow AS DOUBLE)')}
FROM silver
"""


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dims.daily_weather(_hours(spark, sf_dir))
    return days.select("station_id", F.col("date").cast("string").alias("date"), *_measures(days))


DAILY_WEATHER = with_sql(WEATHER_SQL) + f"""
SELECT station_id, strftime(d, '%Y-%m-%d') AS date,
       {_MEASURES_SQL.format(snow='snow / CAST(100 AS DOUBLE)')}
FROM daily
"""


def incremental_daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days from hours that arrive in three loads; each load reads its own hours and adds up their sums."""
    house = Warehouse(spark, scratch_path(spark, "loads"))
    raw = weather_raw(spark, sf_dir).withColumn("raw_id", F.col("raw_id") + 1)
    last = max_id(raw, "raw_id")
    for low in range(3):
        own = raw.where((F.col("raw_id") > last * low // 3) & (F.col("raw_id") <= last * (low + 1) // 3))
        house.table("bronze.meteostat_raw").append(own.withColumn("load_date", F.lit(None).cast("timestamp_ntz")))
        house.clean_weather()
    days = dims.weather_of_days(dims.merged_sums(house.table("silver.weather_days").read()))
    return days.select("station_id", F.col("date").cast("string").alias("date"), *_measures(days))


def pruned_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late hours of ten days merged into a month stored by day; of the stored hours only those days are read."""
    good, _ = clean.clean_weather(weather_raw(spark, sf_dir))
    table = Table(spark, scratch_path(spark, "hours"), "silver.weather_clean", part="date_format(date, 'yyyy-MM-dd')")
    keys, order = ["station_id", "date", "time"], [F.col("raw_id")]
    table.merge(good.where("raw_id % 2 = 0"), keys, order)
    table.merge(good.where("raw_id % 2 = 1 AND day(date) > 20"), keys, order)
    hours = table.read()
    return hours.select("station_id", F.col("date").cast("string").alias("date"), "time", *_measures(hours))


PRUNED_MERGE = with_sql(WEATHER_SQL) + f"""
SELECT station_id, strftime(d, '%Y-%m-%d') AS date, t AS time, {_MEASURES_SQL.format(snow='CAST(snow AS DOUBLE)')}
FROM (SELECT * FROM hours WHERE station_id IS NOT NULL AND (event_id % 2 = 0 OR day(d) > 20)
      QUALIFY row_number() OVER (PARTITION BY station_id, d, t ORDER BY event_id % 2, event_id) = 1)
"""


def weather_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dims.daily_weather(_hours(spark, sf_dir))
    return days.select("station_id", F.col("date").cast("string").alias("date"), "weather_category")


WEATHER_CATEGORY = with_sql(WEATHER_SQL) + """
SELECT station_id, strftime(d, '%Y-%m-%d') AS date, category AS weather_category FROM daily
"""


def weather_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_ids(dims.daily_weather(_hours(spark, sf_dir)), ["station_id", "date"], "weather_id")


def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather_dim(spark, sf_dir)
    return rows.select(
        "weather_id", "station_id", F.col("date").cast("string").alias("date"),
        *_measures(rows), "weather_category",
    )


DIM_WEATHER = with_sql(WEATHER_SQL) + f"""
SELECT weather_id, station_id, strftime(d, '%Y-%m-%d') AS date,
       {_MEASURES_SQL.format(snow='snow / CAST(100 AS DOUBLE)')}, category AS weather_category
FROM dim_weather
"""


def unplaced_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours whose required columns are not all filled."""
    columns = hour_columns(F.col("payload"), F.col("source"))
    hours = weather_raw(spark, sf_dir).select("raw_id", *columns)
    broken = not_null_violations(hours, ["station_id", "date", "time"])
    return broken.select("raw_id", "station_id", "time")


UNPLACED_HOURS = with_sql(WEATHER_SQL) + """
SELECT event_id AS raw_id, station_id, t AS time FROM hours WHERE station_id IS NULL
"""


def quarantined_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours kept out of silver, with the reason."""
    _, bad = clean.clean_weather(weather_raw(spark, sf_dir))
    return bad.select("raw_id", F.array_join("reasons", "; ").alias("reasons"))


QUARANTINED_HOURS = with_sql(WEATHER_SQL) + """
SELECT event_id AS raw_id, 'no station code' AS reasons FROM hours WHERE station_id IS NULL
"""


# --------------------------------------------------------------------------------------- joins


def left_join_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("date"))
    return fact.with_date_id(orders, date_spine(spark)).select(
        "o_orderkey", F.col("date_id").cast("bigint").alias("date_id")
    )


LEFT_JOIN_DATE = """
SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2031-01-01'
       THEN date_diff('day', DATE '2000-01-01', CAST(o_orderdate AS DATE)) + 1 END AS date_id
FROM orders
"""


def left_join_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events against their station's day; clear days are missing from the dimension here."""
    columns = hour_columns(F.col("payload"), F.col("source"))
    hours = weather_raw(spark, sf_dir).select("raw_id", *columns)
    station = hours.select("raw_id", "station_id", "date")
    weather = weather_dim(spark, sf_dir).where(F.col("weather_category") != "Clear")
    return fact.with_weather_id(station, weather, "raw_id").select(
        F.col("raw_id").alias("event_id"), "station_id", "weather_id"
    )


LEFT_JOIN_WEATHER = with_sql(WEATHER_SQL) + """
SELECT c.event_id, c.station_id, w.weather_id
FROM cents c LEFT JOIN (SELECT * FROM dim_weather WHERE category <> 'Clear') w
  ON w.station_id = c.station_id AND w.d = c.d
"""


def left_join_weather_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join of events of which two thirds happened at one station on one day."""
    hours = weather_raw(spark, sf_dir).select("raw_id", *hour_columns(F.col("payload"), F.col("source")))
    weather = weather_dim(spark, sf_dir)
    hot = weather.agg(F.min_by(F.struct("station_id", "date"), "weather_id").alias("hot"))
    moved = hours.select("raw_id", "station_id", "date").join(F.broadcast(hot)).select(
        "raw_id",
        *[F.when(F.col("raw_id") % 3 > 0, F.col(f"hot.{c}")).otherwise(F.col(c)).alias(c) for c in ("station_id", "date")],
    )
    return fact.with_weather_id(moved, weather, "raw_id").select(
        F.col("raw_id").alias("event_id"), "station_id", "weather_id"
    )


LEFT_JOIN_WEATHER_SKEWED = with_sql(WEATHER_SQL) + """
, hot AS (SELECT station_id AS s, d AS day FROM dim_weather WHERE weather_id = 1),
moved AS (
  SELECT event_id, CASE WHEN event_id % 3 > 0 THEN s ELSE station_id END AS station_id,
         CASE WHEN event_id % 3 > 0 THEN day ELSE d END AS d FROM cents, hot)
SELECT event_id, m.station_id, w.weather_id
FROM moved m LEFT JOIN dim_weather w ON w.station_id = m.station_id AND w.d = m.d
"""


def _road_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = clean.clean_roads(road_lines(way_extract(spark, sf_dir)))
    return good


def nearest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = point_shapes(city_dim(spark, sf_dir), "city_id", "lon", "lat", "station_id")
    names = {"city_id": "id", "station_id": "station_id", "distance": "distance"}
    found = nearest_join(accident_points(spark, sf_dir), "lon", "lat", shapes, names)
    return found.select("accident_id", "city_id", "station_id", "distance")


NEAREST_POINT = with_sql(POINTS_SQL, CITY_SQL, NEAREST_CITY_SQL) + """
SELECT accident_id, city_id, station_id, d AS distance FROM near_city
"""


def nearest_of_many_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with customers as places, too many for a single array."""
    places = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place_id"),
        (F.col("c_acctbal") / F.lit(100.0)).alias("x"),
        (F.col("c_nationkey").cast("double") * F.lit(4.0)).alias("y"),
    )
    shapes = point_shapes(places, "place_id", "x", "y")
    names = {"place_id": "id", "distance": "distance"}
    found = nearest_join(accident_points(spark, sf_dir), "lon", "lat", shapes, names)
    return found.select("accident_id", "place_id", "distance")


NEAREST_OF_MANY_POINTS = with_sql(
    POINTS_SQL,
    """
places AS (
  SELECT c_custkey AS place_id, c_acctbal / CAST(100 AS DOUBLE) AS x,
         CAST(c_nationkey AS DOUBLE) * CAST(4 AS DOUBLE) AS y FROM customer)""",
    f"""
scored AS (
  SELECT accident_id, place_id, {sql_point_distance('lon', 'lat', 'x', 'y')} AS d FROM pts, places)""",
) + """
SELECT accident_id, arg_min(place_id, (d, place_id)) AS place_id, min(d) AS distance
FROM scored GROUP BY accident_id
"""


def _nearest_road(**options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shapes = line_shapes(_road_table(spark, sf_dir), "road_id", "geom")
        names = {"road_id": "id", "distance": "distance"}
        points = accident_points(spark, sf_dir)
        return nearest_join(points, "lon", "lat", shapes, names, **options).select(
            "accident_id", "road_id", "distance"
        )

    return run


def _stored_index(**options) -> Query:
    """The nearest road of all accidents from an index that was written before and knows no position."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "road-index")
        fact.road_index(_road_table(spark, sf_dir)).pages.write.parquet(path)
        index = NearestIndex(spark.read.schema(PAGES_SCHEMA).parquet(path))
        names = {"road_id": "id", "distance": "distance"}
        points = accident_points(spark, sf_dir)
        return index.join(points, "lon", "lat", names, **options).select("accident_id", "road_id", "distance")

    return run


NEAREST_SEGMENT = with_sql(POINTS_SQL, WAYS_SQL, NEAREST_ROAD_SQL) + """
SELECT accident_id, road_id, d AS distance FROM near_road
"""


def fact_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities, roads = fact.both_indexes(city_dim(spark, sf_dir), _road_table(spark, sf_dir))
    rows = fact.assemble_fact(
        accident_points(spark, sf_dir),
        cities,
        date_spine(spark),
        roads,
        weather_dim(spark, sf_dir),
    )
    return rows.withColumn("date_id", F.col("date_id").cast("bigint"))


FACT_ACCIDENTS = with_sql(
    POINTS_SQL, CITY_SQL, NEAREST_CITY_SQL, WAYS_SQL, NEAREST_ROAD_SQL, WEATHER_SQL
) + """
SELECT p.accident_id, c.city_id,
       date_diff('day', DATE '2000-01-01', p.d) + 1 AS date_id,
       r.road_id, w.weather_id, p.total_damage, p.cause AS main_cause
FROM pts p
JOIN near_city c USING (accident_id)
JOIN near_road r USING (accident_id)
LEFT JOIN dim_weather w ON w.station_id = c.station_id AND w.d = p.d
"""


def _odd_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accidents of which some lack a coordinate and some lie outside the calendar."""
    key = F.col("accident_id")
    return accident_points(spark, sf_dir).withColumns(
        {
            "lon": F.when(key % 17 != 0, F.col("lon")),
            "date": F.when(key % 19 == 0, F.to_timestamp_ntz(F.lit("1999-05-05 00:00:00"))).otherwise(F.col("date")),
        }
    )


def fact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact merged into a target that holds every fifth accident already."""
    cities, roads = fact.both_indexes(city_dim(spark, sf_dir), _road_table(spark, sf_dir))
    rows = fact.assemble_fact(
        _odd_accidents(spark, sf_dir),
        cities,
        date_spine(spark),
        roads,
        weather_dim(spark, sf_dir),
    ).withColumn("date_id", F.col("date_id").cast("bigint"))
    unknown = [F.lit(None).cast("bigint").alias(c) for c in ("city_id", "date_id", "road_id", "weather_id")]
    target = accident_points(spark, sf_dir).where(F.col("accident_id") % 5 == 0).select(
        "accident_id", *unknown, "total_damage", F.lit("loaded before").alias("main_cause")
    )
    return insert_only_merge(rows, target, ["accident_id"], [F.col("accident_id")])


FACT_MERGE = with_sql(
    POINTS_SQL.replace("pts AS", "plain AS"),
    """
pts AS (
  SELECT accident_id, CASE WHEN accident_id % 17 <> 0 THEN lon END AS lon, lat,
         CASE WHEN accident_id % 19 = 0 THEN DATE '1999-05-05' ELSE d END AS d, cause, total_damage
  FROM plain)""",
    CITY_SQL, NEAREST_CITY_SQL, WAYS_SQL, NEAREST_ROAD_SQL, WEATHER_SQL,
) + """
SELECT p.accident_id, c.city_id,
       CASE WHEN p.d >= DATE '2000-01-01' AND p.d < DATE '2031-01-01'
            THEN date_diff('day', DATE '2000-01-01', p.d) + 1 END AS date_id,
       CASE WHEN p.lon IS NULL THEN (SELECT min(road_id) FROM segs) ELSE r.road_id END AS road_id,
       w.weather_id, p.total_damage, p.cause AS main_cause
FROM pts p
JOIN near_city c USING (accident_id)
JOIN near_road r USING (accident_id)
LEFT JOIN dim_weather w ON w.station_id = c.station_id AND w.d = p.d
WHERE p.accident_id % 5 <> 0
UNION ALL
SELECT accident_id, NULL, NULL, NULL, NULL, total_damage, 'loaded before' FROM plain WHERE accident_id % 5 = 0
"""


# -------------------------------------------------------------------------------------- checks


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pk_violations(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


REPEATED_LINES = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY ALL HAVING count(*) > 1
"""


def late_lines_that_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of lines of the last fifth of all orders that are stored already, or come twice."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_linestatus")
    late = lines.where(F.col("l_orderkey") * 5 > lines.agg(F.max("l_orderkey")).scalar() * 4)
    path = scratch_path(spark, "lines")
    lines.where("l_linestatus = 'O'").sort("l_orderkey").write.parquet(path)
    return delta_pk_violations(late, spark.read.parquet(path), ["l_orderkey", "l_linenumber"])


LATE_LINES_THAT_REPEAT = """
WITH late AS (
  SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey * 5 > (SELECT max(l_orderkey) FROM lineitem) * 4),
met AS (
  SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_linestatus = 'O' AND (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM late))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows
FROM (SELECT * FROM late UNION ALL SELECT * FROM met) GROUP BY ALL HAVING count(*) > 1
"""


def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose order is not among the finished orders."""
    finished = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return fk_violations(load(spark, sf_dir, "lineitem"), "l_orderkey", finished, "o_orderkey")


ORPHAN_LINES = """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
GROUP BY l_orderkey
"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "weather_clean": (weather_clean, WEATHER_CLEAN),
    "daily_weather": (daily_weather, DAILY_WEATHER),
    "incremental_daily_weather": (incremental_daily_weather, DAILY_WEATHER),
    "pruned_merge": (pruned_merge, PRUNED_MERGE),
    "weather_category": (weather_category, WEATHER_CATEGORY),
    "dim_weather": (dim_weather, DIM_WEATHER),
    "not_null_violations": (unplaced_hours, UNPLACED_HOURS),
    "quarantined_hours": (quarantined_hours, QUARANTINED_HOURS),
    "left_join_date": (left_join_date, LEFT_JOIN_DATE),
    "left_join_weather": (left_join_weather, LEFT_JOIN_WEATHER),
    "left_join_weather_skewed": (left_join_weather_skewed, LEFT_JOIN_WEATHER_SKEWED),
    "nearest_point": (nearest_point, NEAREST_POINT),
    "nearest_of_many_points": (nearest_of_many_points, NEAREST_OF_MANY_POINTS),
    "nearest_segment": (_nearest_road(), NEAREST_SEGMENT),
    # the path for indexes too large to send to every task
    "nearest_segment_shuffled": (_nearest_road(broadcast_limit=0), NEAREST_SEGMENT),
    "nearest_unseen_positions": (_stored_index(), NEAREST_SEGMENT),
    "nearest_unseen_positions_shuffled": (_stored_index(broadcast_limit=0), NEAREST_SEGMENT),
    "fact_accidents": (fact_accidents, FACT_ACCIDENTS),
    "fact_merge": (fact_merge, FACT_MERGE),
    "pk_violations": (repeated_lines, REPEATED_LINES),
    "delta_pk_violations": (late_lines_that_repeat, LATE_LINES_THAT_REPEAT),
    "fk_violations": (orphan_lines, ORPHAN_LINES),
}
