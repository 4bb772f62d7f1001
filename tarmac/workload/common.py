"""Inputs shared by the registered queries: the given tables, shaped like the engine's own inputs.

Every shape has a SQL twin that computes the expected values straight from the base columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.session import spread

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(selector: Column, options: list[Column]) -> Column:
    """``options[selector % len]``."""
    choice = F.pmod(selector, F.lit(len(options)))
    branches = F.when(choice == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        branches = branches.when(choice == i, option)
    return branches


def sql_pick(selector: str, options: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"CASE ({selector}) % {len(options)} {whens} END"


def text(column: str) -> Column:
    return F.col(column).cast("string")


# ------------------------------------------------------------------------------ weather hours

# events as hourly weather rows: the station follows the event type, one type names no station
STATION_TAGS = {
    "view": "11518",
    "signup": "D1234",
    "click": "11723",
    "error": "11782",
    "purchase": "unknown",
}


def _tag() -> Column:
    tags = F.create_map(*[F.lit(x) for pair in STATION_TAGS.items() for x in pair])
    return tags[F.col("event_type")]


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather rows ``raw_id, payload, source`` built from events."""
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value").cast("decimal(10,2)")
    day = F.day("ts")
    cold = F.lit(10) - day  # colder as the month goes on
    rain = k.cast("decimal(10,1)") * F.lit("0.1").cast("decimal(2,1)") * F.pmod(day, F.lit(4))
    half_day = F.concat(F.pmod(day, F.lit(3)).cast("string"), F.lit(".5"))
    snow = F.when(k < 50, F.lit("null")).otherwise(half_day)
    record = F.concat(
        F.lit('{"time":"'), F.date_format("ts", "yyyy-MM-dd HH:00:00"),
        F.lit('","temp":'), (value + cold).cast("string"),
        F.lit(',"prcp":'), rain.cast("decimal(10,1)").cast("string"),
        F.lit(',"snow":'), snow,
        F.lit(',"wdir":"'), (k * 3).cast("string"),
        F.lit('","wspd":'), (value * F.pmod(day, F.lit(5))).cast("decimal(10,2)").cast("string"),
        F.lit("}"),
    )
    return spread(load(spark, sf_dir, "events"), "event_id").select(
        F.col("event_id").alias("raw_id"),
        F.parse_json(record).alias("payload"),
        F.concat(F.lit("meteostat_hourly_"), _tag()).alias("source"),
    )


_STATION_SQL = (
    "CASE event_type "
    + " ".join(f"WHEN '{k}' THEN {repr(v) if v != 'unknown' else 'NULL'}" for k, v in STATION_TAGS.items())
    + " END"
)

# hundredths as integers, so sums and quotients are exact
WEATHER_SQL = f"""
cents AS (
  SELECT event_id, {_STATION_SQL} AS station_id, CAST(ts AS DATE) AS d,
         strftime(date_trunc('hour', ts), '%H:%M:%S') AS t, day(ts) AS dd,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(CAST(value AS DECIMAL(10,2)) * 100 AS BIGINT) AS v
  FROM events),
hours AS (
  SELECT event_id, station_id, d, t,
         CASE WHEN abs(v + (10 - dd) * 100) < 100000 THEN v + (10 - dd) * 100 END AS temp,
         k * 10 * (dd % 4) AS prcp,
         CASE WHEN k >= 50 THEN dd % 3 + 1 END AS snow,
         k * 3 AS wdir,
         CASE WHEN v * (dd % 5) < 100000 THEN v * (dd % 5) END AS wspd
  FROM cents),
silver AS (
  SELECT * FROM hours WHERE station_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY station_id, d, t ORDER BY event_id) = 1),
daily AS (
  SELECT station_id, d,
         sum(temp) // count(temp) AS temp, sum(prcp) // count(prcp) AS prcp,
         (sum(snow) * 100) // count(snow) AS snow,
         (2 * sum(wdir) + count(wdir)) // (2 * count(wdir)) AS wdir,
         sum(wspd) // count(wspd) AS wspd,
         CASE WHEN sum(snow) > count(snow) THEN 'snowy'
              WHEN sum(prcp) > 1000 * count(prcp) AND sum(temp) > 0 THEN 'Heavy Rain'
              WHEN sum(prcp) >= 20 * count(prcp) AND sum(prcp) <= 1000 * count(prcp)
                   AND sum(temp) > 0 THEN 'Rainy'
              WHEN sum(wspd) > 3000 * count(wspd) THEN 'Windy'
              WHEN sum(temp) < 0 AND sum(prcp) <= 20 * count(prcp) THEN 'Freezing'
              ELSE 'Clear' END AS category
  FROM silver GROUP BY station_id, d),
dim_weather AS (
  SELECT row_number() OVER (ORDER BY station_id, d) AS weather_id, * FROM daily)
"""

# -------------------------------------------------------------------------------- road lines

HIGHWAYS = ["residential", "motorway", "primary", None, "service", "residential", "motorway"]
LIMITS = [
    "CZ:urban", "CZ:rural", "CZ:living_street", "CZ:pedestrian_zone", "walk", "none", "30 mph",
    "30mph", "50;30", "signals", None, "20 mph", "70",
]
LANES = ["2", "-2", "2;3", "1.5", None, "-2147483648"]
ONE_WAYS = ["yes", "alternating", "reversible", "1", "-1", "no", "0", "other", None]


def _tag_text(key: str, selector: Column, options: list[str | None]) -> Column:
    return pick(
        selector, [F.lit("" if o is None else f'"{key}"=>"{o}", ') for o in options]
    )


def way_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road-line extract ``osm_id, highway, wkt, all_tags`` built from part."""
    key = F.col("p_partkey")
    tags = F.concat(
        _tag_text("highway", key, HIGHWAYS),
        _tag_text("maxspeed", key, LIMITS),
        _tag_text("lanes", key, LANES),
        _tag_text("oneway", key, ONE_WAYS),
        F.lit('"name"=>"'), F.col("p_name"), F.lit(r' \"'), F.col("p_brand"), F.lit(r'\" \\, a=>b", '),
        F.lit('"ref"=>NULL, "note"=>"", "size"=>"'), text("p_size"), F.lit('"'),
    )
    # thousandths of a degree, spread over a hundred degrees
    x = F.pmod(key * 7919, F.lit(100003))
    y = F.pmod(key * 104729, F.lit(99991))

    def ordinate(value: Column) -> Column:
        fraction = F.lpad(F.pmod(value, F.lit(1000)).cast("string"), 3, "0")
        return F.concat(F.floor(value / 1000).cast("string"), F.lit("."), fraction)

    vertices = [
        F.concat(ordinate(x), F.lit(" "), ordinate(y)),
        F.concat(ordinate(x + 10 * F.col("p_size")), F.lit("  "), ordinate(y + 130)),
        F.concat(ordinate(x + 170), F.lit(" "), ordinate(y + 20 * F.col("p_size"))),
    ]
    line = F.concat(F.lit("LINESTRING ("), vertices[0], F.lit(", "), vertices[1], F.lit(","), vertices[2], F.lit(")"))
    wkt = pick(
        key,
        [line] * 9 + [
            F.concat(F.lit("POINT ("), vertices[0], F.lit(")")),
            F.concat(F.lit("LINESTRING ("), vertices[0], F.lit(")")),
        ],
    )
    return spread(load(spark, sf_dir, "part"), "p_partkey").select(
        key.alias("osm_id"), pick(key, [F.lit(h) for h in HIGHWAYS]).alias("highway"),
        wkt.alias("wkt"), tags.alias("all_tags"),
    )


def _sql_options(options: list[str | None]) -> list[str]:
    return ["CAST(NULL AS VARCHAR)" if o is None else f"'{o}'" for o in options]


WAYS_SQL = f"""
ways AS (
  SELECT p_partkey AS osm_id, p_size,
         {sql_pick('p_partkey', _sql_options(HIGHWAYS))} AS highway,
         {sql_pick('p_partkey', _sql_options(LIMITS))} AS maxspeed,
         {sql_pick('p_partkey', _sql_options(LANES))} AS lanes,
         {sql_pick('p_partkey', _sql_options(ONE_WAYS))} AS oneway,
         p_name || ' "' || p_brand || '" \\, a=>b' AS name,
         CASE WHEN p_partkey % 11 < 9 THEN 'line' WHEN p_partkey % 11 = 9 THEN 'point' ELSE 'short' END AS shape,
         ((p_partkey * 7919) % 100003) / CAST(1000 AS DOUBLE) AS x0,
         ((p_partkey * 104729) % 99991) / CAST(1000 AS DOUBLE) AS y0,
         ((p_partkey * 7919) % 100003 + 10 * p_size) / CAST(1000 AS DOUBLE) AS x1,
         ((p_partkey * 104729) % 99991 + 130) / CAST(1000 AS DOUBLE) AS y1,
         ((p_partkey * 7919) % 100003 + 170) / CAST(1000 AS DOUBLE) AS x2,
         ((p_partkey * 104729) % 99991 + 20 * p_size) / CAST(1000 AS DOUBLE) AS y2
  FROM part),
roads AS (
  SELECT osm_id AS road_id, name, highway AS road_type, false AS is_intersection,
         CASE lanes WHEN '2' THEN 2 WHEN '-2' THEN 2 END AS lanes,
         CASE WHEN maxspeed = 'CZ:urban' THEN 50 WHEN maxspeed = 'CZ:rural' THEN 90
              WHEN maxspeed IN ('CZ:living_street', 'CZ:pedestrian_zone') THEN 20
              WHEN maxspeed = 'walk' THEN 5 WHEN maxspeed = 'none' THEN NULL
              WHEN maxspeed LIKE '%mph' THEN
                CAST(round(TRY_CAST(replace(maxspeed, ' mph', '') AS DECIMAL(9,3)) * 1.609) AS INTEGER)
              WHEN regexp_matches(maxspeed, '[0-9]') THEN
                CAST(regexp_extract(maxspeed, '[0-9]+') AS INTEGER)
              WHEN highway = 'residential' THEN 30 WHEN highway = 'motorway' THEN 130 END AS max_speed,
         coalesce(oneway IN ('yes', 'alternating', 'reversible', '1', '-1'), false) AS oneway,
         shape, x0, y0, x1, y1, x2, y2
  FROM ways WHERE highway IS NOT NULL),
segs AS (
  SELECT road_id, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM roads WHERE shape = 'line'
  UNION ALL
  SELECT road_id, x1, y1, x2, y2 FROM roads WHERE shape = 'line')
"""

# ------------------------------------------------------------------------- places and accidents


def accident_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as accidents: position from value and props, day from ts."""
    k = F.get_json_object("props", "$.k").cast("double")
    minutes = F.minute("ts").cast("double") / F.lit(60.0)
    return spread(load(spark, sf_dir, "events"), "event_id").select(
        F.col("event_id").alias("accident_id"),
        (F.col("value") * F.lit(0.5)).alias("lon"),
        (k + minutes).alias("lat"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("date"),
        F.col("event_type").alias("cause"),
        F.floor(F.col("value") * 100).cast("bigint").alias("total_damage"),
    )


POINTS_SQL = """
pts AS (
  SELECT event_id AS accident_id, value * CAST(0.5 AS DOUBLE) AS lon,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) + CAST(minute(ts) AS DOUBLE) / CAST(60 AS DOUBLE) AS lat,
         CAST(ts AS DATE) AS d, event_type AS cause, CAST(floor(value * 100) AS BIGINT) AS total_damage
  FROM events)
"""

_CITY_STATIONS = ["11518", "D1234", "11723", "11782", None]


def city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as cities."""
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("city_id"),
        F.col("s_name").alias("city_name"),
        (F.col("s_acctbal") / F.lit(100.0)).alias("lon"),
        (F.col("s_nationkey").cast("double") * F.lit(4.0)).alias("lat"),
        pick(F.col("s_suppkey"), [F.lit(s) for s in _CITY_STATIONS]).alias("station_id"),
    )


CITY_SQL = f"""
cities AS (
  SELECT s_suppkey AS city_id, s_acctbal / CAST(100 AS DOUBLE) AS lon,
         CAST(s_nationkey AS DOUBLE) * CAST(4 AS DOUBLE) AS lat,
         {sql_pick('s_suppkey', _sql_options(_CITY_STATIONS))} AS station_id
  FROM supplier)
"""

# distances written operation by operation as the engine does, so both round alike
def sql_point_distance(px: str, py: str, qx: str, qy: str) -> str:
    return f"sqrt(({px} - {qx}) * ({px} - {qx}) + ({py} - {qy}) * ({py} - {qy}))"


NEAREST_ROAD_SQL = """
reach AS (
  SELECT p.accident_id, s.road_id, p.lon, p.lat, s.ax, s.ay, s.bx - s.ax AS dx, s.by_ - s.ay AS dy
  FROM pts p, segs s),
along AS (
  SELECT *, least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
            ((lon - ax) * dx + (lat - ay) * dy) / (dx * dx + dy * dy))) AS t
  FROM reach),
scored AS (
  SELECT accident_id, road_id,
         sqrt((lon - (ax + t * dx)) * (lon - (ax + t * dx)) + (lat - (ay + t * dy)) * (lat - (ay + t * dy))) AS d
  FROM along),
near_road AS (
  SELECT accident_id, arg_min(road_id, (d, road_id)) AS road_id, min(d) AS d FROM scored GROUP BY accident_id)
"""

NEAREST_CITY_SQL = f"""
near_city AS (
  SELECT p.accident_id, n.city_id, n.station_id, n.d
  FROM pts p, LATERAL (
    SELECT c.city_id, c.station_id, {sql_point_distance('p.lon', 'p.lat', 'c.lon', 'c.lat')} AS d
    FROM cities c ORDER BY d, c.city_id LIMIT 1) n)
"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
