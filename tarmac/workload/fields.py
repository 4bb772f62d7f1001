"""Field rules on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.functions import accidents
from tarmac.functions.geometry import line_points, to_wkb, wkb_points
from tarmac.functions.payload import text_only, whole_number
from tarmac.functions.roads import tag_map
from tarmac.functions.weather import station_code
from tarmac.operators.quality import geom_violations
from tarmac.plans.clean import road_columns
from tarmac.plans.dims import road_rows
from tarmac.sources.landed import road_lines
from tarmac.workload.common import WAYS_SQL, Query, load, pick, text, way_extract, with_sql

# ------------------------------------------------------------------------------ accident fields


def damage_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of damage value, chosen by order key."""
    key, customer = F.col("o_orderkey"), text("o_custkey")

    def member(before: str, *after: object) -> object:
        parts = [F.lit(p) if isinstance(p, str) else p for p in after]
        return F.concat(F.lit('{"properties":{"hmotna_skoda":' + before), *parts, F.lit("}}"))

    cases = [
        member('"', customer, ' 000 Kč"'),
        member('"', customer, '"'),
        member('"-', customer, '"'),
        member('"', customer, '.5"'),
        member('""'),
        member('"', customer, '\u00a0000 Kč"'),
        F.lit('{"properties":{}}'),
        member("null"),
        member("", customer, ".5"),
        member("-", customer, ".5"),
        member("true"),
        member("[1]"),
        member('{"a":1}'),
        member("", customer),
    ]
    payload = F.parse_json(pick(key, cases))
    return load(spark, sf_dir, "orders").select(key, accidents.damage(payload).alias("total_damage"))


DAMAGE_CLEAN = """
SELECT o_orderkey, CASE o_orderkey % 14 WHEN 0 THEN o_custkey * 1000 WHEN 1 THEN o_custkey WHEN 6 THEN 0
       WHEN 8 THEN o_custkey + 1 WHEN 9 THEN -o_custkey - 1 WHEN 13 THEN o_custkey END AS total_damage
FROM orders
"""


def iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    texts = [
        day,
        F.concat(day, F.lit("T23:30:00-05:00")),
        F.concat(day, F.lit(" 08:15")),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.concat(day, F.lit("T00:00:00.123456Z")),
        F.concat(day, F.lit("Tgarbage")),
        F.date_format("o_orderdate", "yyyy"),
        F.date_format("o_orderdate", "yyyy-M-d"),
        F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30")),
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(day, F.lit("T25:00:00")),
    ]
    # two-digit months and days make the yyyy-M-d form valid
    parsed = accidents.iso_day(pick(F.col("o_orderkey"), texts)).cast("string")
    return load(spark, sf_dir, "orders").select("o_orderkey", parsed.alias("date"))


ISO_DATE = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 12 < 5 OR (o_orderkey % 12 = 7 AND month(o_orderdate) > 9 AND day(o_orderdate) > 9)
            THEN strftime(o_orderdate, '%Y-%m-%d') END AS date
FROM orders
"""


def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    texts = [
        F.concat(F.lit(" "), priority, F.lit("  ")),
        F.concat(F.lit("\t\u00a0"), priority, F.lit(" \n")),
        F.lit(""),
        F.lit("   "),
        F.lit(None).cast("string"),
        priority,
    ]
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", accidents.strip_text(pick(F.col("o_orderkey"), texts)).alias("cause")
    )


STRIP_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 2 THEN NULL WHEN 3 THEN '' WHEN 4 THEN NULL
                   ELSE o_orderpriority END AS cause
FROM orders
"""


def coord_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates, counts and text of well and badly formed features."""
    customer = text("o_custkey")
    features = [
        F.concat(F.lit('{"geometry":{"coordinates":['), customer, F.lit('.5,49.25,7]},"properties":{"lehce_zraneno":2.7,"pricina":"a"}}')),
        F.concat(F.lit('{"geometry":{"coordinates":['), customer, F.lit(']},"properties":{"lehce_zraneno":"3","pricina":5}}')),
        F.lit('{"geometry":{},"properties":{"lehce_zraneno":null}}'),
        F.lit('{"geometry":null,"properties":{"lehce_zraneno":"x"}}'),
        F.lit('{"properties":{"lehce_zraneno":true}}'),
        F.lit('{"geometry":{"coordinates":[null,null]}}'),
        F.concat(F.lit('{"geometry":{"coordinates":["x",1]},"properties":{"lehce_zraneno":'), customer, F.lit("}}")),
    ]
    payload = F.parse_json(pick(F.col("o_orderkey"), features))
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        accidents.coordinate(payload, 0).alias("lon"),
        accidents.coordinate(payload, 1).alias("lat"),
        whole_number(payload, f"$.properties.{accidents.SLIGHT}", "bigint").alias("slightly_injured"),
        text_only(payload, f"$.properties.{accidents.CAUSE}").alias("cause"),
    )


COORD_PICK = """
SELECT o_orderkey,
       CASE o_orderkey % 7 WHEN 0 THEN CAST(o_custkey AS DOUBLE) + 0.5 WHEN 1 THEN CAST(o_custkey AS DOUBLE) END AS lon,
       CASE o_orderkey % 7 WHEN 0 THEN CAST(49.25 AS DOUBLE) WHEN 6 THEN CAST(1 AS DOUBLE) END AS lat,
       CASE o_orderkey % 7 WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 6 THEN o_custkey END AS slightly_injured,
       CASE o_orderkey % 7 WHEN 0 THEN 'a' END AS cause
FROM orders
"""


def regex_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        station_code(F.col("source")).alias("station_id"),
        station_code(F.concat(F.lit("x_D"), text("doc_id"))).alias("d_station_id"),
        station_code(F.col("lang")).alias("no_station_id"),
        station_code(F.col("text")).alias("text_station_id"),
    )


REGEX_STATION = """
SELECT doc_id, nullif(regexp_extract(source, '(D?[0-9]+)$', 1), '') AS station_id,
       'D' || doc_id AS d_station_id, nullif(regexp_extract(lang, '(D?[0-9]+)$', 1), '') AS no_station_id,
       nullif(regexp_extract(text, '(D?[0-9]+)$', 1), '') AS text_station_id
FROM documents
"""


# ---------------------------------------------------------------------------------- road fields


def hstore_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = tag_map(F.col("all_tags"))
    parsed = way_extract(spark, sf_dir).select("osm_id", tags.alias("tags"))
    picked = [F.col("tags")[k].alias(k) for k in ("highway", "name", "ref", "note", "size", "zz")]
    return parsed.select(
        "osm_id", *picked, F.size(F.map_keys("tags")).cast("bigint").alias("n_tags")
    )


HSTORE_PARSE = with_sql(WAYS_SQL) + """
SELECT osm_id, highway, name, CAST(NULL AS VARCHAR) AS ref, '' AS note, CAST(p_size AS VARCHAR) AS size,
       CAST(NULL AS VARCHAR) AS zz,
       CAST(4 + (highway IS NOT NULL)::INT + (maxspeed IS NOT NULL)::INT + (lanes IS NOT NULL)::INT
            + (oneway IS NOT NULL)::INT AS BIGINT) AS n_tags
FROM ways
"""


def osm_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = road_lines(way_extract(spark, sf_dir))
    return lines.select(
        "osm_id", "highway", F.col("tags")["name"].alias("name"),
        F.size("geom").cast("bigint").alias("n_points"),
    )


OSM_LINE_SCAN = with_sql(WAYS_SQL) + """
SELECT osm_id, highway, name,
       CAST(CASE shape WHEN 'line' THEN 3 WHEN 'short' THEN 1 END AS BIGINT) AS n_points
FROM ways WHERE highway IS NOT NULL
"""


def wkt_to_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = way_extract(spark, sf_dir).select("osm_id", line_points(F.col("wkt")).alias("geom"))
    vertices = lines.select("osm_id", F.posexplode("geom").alias("vertex", "point"))
    return vertices.select(
        "osm_id", F.col("vertex").cast("bigint").alias("vertex"), "point.lon", "point.lat"
    )


WKT_TO_POINTS = with_sql(WAYS_SQL) + """
SELECT osm_id, CAST(0 AS BIGINT) AS vertex, x0 AS lon, y0 AS lat FROM ways WHERE shape <> 'point'
UNION ALL SELECT osm_id, 1, x1, y1 FROM ways WHERE shape = 'line'
UNION ALL SELECT osm_id, 2, x2, y2 FROM ways WHERE shape = 'line'
"""


def wkb_to_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as WKB in both byte orders and read back; cut ones give no vertex."""
    lines = way_extract(spark, sf_dir).select("osm_id", line_points(F.col("wkt")).alias("geom"))
    stored = lines.select("osm_id", to_wkb(F.col("geom"), F.col("osm_id") % 2 == 0).alias("wkb"))
    cut = F.when(F.col("osm_id") % 7 == 0, F.expr("substr(wkb, 1, octet_length(wkb) - 1)")).otherwise(F.col("wkb"))
    vertices = stored.select("osm_id", F.posexplode(wkb_points(cut)).alias("vertex", "point"))
    return vertices.select(
        "osm_id", F.col("vertex").cast("bigint").alias("vertex"), "point.lon", "point.lat"
    )


WKB_TO_POINTS = with_sql(WAYS_SQL) + """
SELECT osm_id, CAST(0 AS BIGINT) AS vertex, x0 AS lon, y0 AS lat FROM ways WHERE shape <> 'point' AND osm_id % 7 <> 0
UNION ALL SELECT osm_id, 1, x1, y1 FROM ways WHERE shape = 'line' AND osm_id % 7 <> 0
UNION ALL SELECT osm_id, 2, x2, y2 FROM ways WHERE shape = 'line' AND osm_id % 7 <> 0
"""


def _roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return road_columns(road_lines(way_extract(spark, sf_dir)))


def dim_road_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = road_rows(_roads(spark, sf_dir))
    return rows.withColumn("lanes", F.col("lanes").cast("bigint")).withColumn(
        "max_speed", F.col("max_speed").cast("bigint")
    )


DIM_ROAD_PROJECT = with_sql(WAYS_SQL) + """
SELECT road_id, road_type, is_intersection, CAST(lanes AS BIGINT) AS lanes,
       CAST(max_speed AS BIGINT) AS max_speed, oneway FROM roads
"""


def _road_column(column: str, cast: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _roads(spark, sf_dir)
        return rows.select("road_id", "road_type", F.col(column).cast(cast).alias(column))

    return run


def _road_column_sql(column: str, cast: str) -> str:
    return with_sql(WAYS_SQL) + f"SELECT road_id, road_type, CAST({column} AS {cast}) AS {column} FROM roads"


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = way_extract(spark, sf_dir).select("osm_id", line_points(F.col("wkt")).alias("geom"))
    return geom_violations(rows).select("osm_id", F.size("geom").cast("bigint").alias("n_points"))


BAD_LINES = with_sql(WAYS_SQL) + """
SELECT osm_id, CAST(CASE shape WHEN 'short' THEN 1 END AS BIGINT) AS n_points FROM ways WHERE shape <> 'line'
"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "damage_clean": (damage_clean, DAMAGE_CLEAN),
    "iso_date": (iso_date, ISO_DATE),
    "strip_text": (strip_text, STRIP_TEXT),
    "coord_pick": (coord_pick, COORD_PICK),
    "regex_station": (regex_station, REGEX_STATION),
    "hstore_parse": (hstore_parse, HSTORE_PARSE),
    "osm_line_scan": (osm_line_scan, OSM_LINE_SCAN),
    "wkt_to_points": (wkt_to_points, WKT_TO_POINTS),
    "wkb_to_points": (wkb_to_points, WKB_TO_POINTS),
    "dim_road_project": (dim_road_project, DIM_ROAD_PROJECT),
    "lanes_abs": (_road_column("lanes", "bigint"), _road_column_sql("lanes", "BIGINT")),
    "oneway_flag": (_road_column("oneway", "boolean"), _road_column_sql("oneway", "BOOLEAN")),
    "max_speed_norm": (_road_column("max_speed", "bigint"), _road_column_sql("max_speed", "BIGINT")),
    "geom_violations": (bad_lines, BAD_LINES),
}
