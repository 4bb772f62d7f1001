"""Scans, landing and table writes on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.functions.accidents import accident_columns
from tarmac.functions.payload import json_text
from tarmac.operators.keys import dense_ids
from tarmac.operators.merge import first_per_key, insert_only_merge, unseen_sources
from tarmac.session import scratch_path
from tarmac.sources import bronze, calendar, geojson, landed
from tarmac.sources.tables import Table
from tarmac.workload.common import Query, load, pick, text

AS_OF = dt.date(2026, 1, 1)


# ------------------------------------------------------------------------- accident documents


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON document per order, in every shape a landed file may have."""
    key = F.col("o_orderkey")
    properties = F.concat(
        F.lit('"properties":{"datum":"'), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit('T10:00:00","pricina":" '), F.col("o_orderpriority"),
        F.lit(' ","druh":"'), F.col("o_orderstatus"),
        F.lit('","lehce_zraneno":'), F.pmod(key, F.lit(5)).cast("string"),
        F.lit(',"tezce_zraneno":"'), F.pmod(key, F.lit(3)).cast("string"),
        F.lit('","hmotna_skoda":"'), text("o_custkey"), F.lit(' 000 Kč"}'),
    )
    place = F.concat(
        F.lit(',"geometry":{"coordinates":['), text("o_custkey"), F.lit(".25,"),
        F.pmod(key, F.lit(90)).cast("string"), F.lit(".5]}"),
    )
    full = F.concat(F.lit("{"), properties, place, F.lit("}"))
    bare = F.concat(F.lit("{"), properties, F.lit(',"geometry":null}'))

    def wrap(*parts: str | object) -> object:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    shapes = [
        wrap('{"type":"FeatureCollection","features":[', full, ",", full, "]}"),
        wrap('[{"features":[', full, "]}]"),
        F.lit("[]"),
        F.lit('"text"'),
        F.lit("{}"),
        wrap('{"features":[', full, ',5,null,"x"]}'),
        F.lit('{"features":null}'),
        wrap('{"features":[', bare, "]}"),
        wrap('[{"features":[', full, ",", bare, "]},7]"),
    ]
    return load(spark, sf_dir, "orders").select(key, pick(key, shapes).alias("document"))


def _files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Files of up to 1,000 elements each, one per line, of which some are bare features and some no objects."""
    key = F.col("o_orderkey")
    number = key.cast("string")
    full = F.concat(
        F.lit('{"type":"Feature","id":'), number, F.lit(',"properties":{"druh":"'), F.col("o_orderstatus"), F.lit('"}}')
    )
    bare = F.concat(F.lit('{"type":"Feature","id":'), number, F.lit("}"))
    kind = F.pmod(key, F.lit(10))
    element = F.when(kind == 7, F.lit("null")).when(kind == 3, bare).otherwise(full)
    orders = load(spark, sf_dir, "orders").select((F.floor(key / 1000)).alias("doc"), key, element.alias("element"))
    listed = F.sort_array(F.collect_list(F.struct("o_orderkey", "element")))["element"]
    document = F.concat(
        F.lit('{"type": "FeatureCollection",\n\n"features": [\n'),
        F.array_join(listed, ",\n\n"),
        F.lit('\n],\n"crs": {"x": [1, 2]}\n}'),
    )
    path = scratch_path(spark, "geojson")
    orders.groupBy("doc").agg(document.alias("value")).write.partitionBy("doc").text(path)
    return [path]


def _from_files(scan) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = scan(spark, _files(spark, sf_dir))
        return found.select(
            F.regexp_extract("path", "doc=([0-9]+)", 1).cast("bigint").alias("doc"),
            "ordinal",
            F.try_variant_get("payload", "$.id", "bigint").alias("id"),
            F.try_variant_get("payload", "$.properties.druh", "string").alias("druh"),
        )

    return run


FROM_FILES = """
SELECT o_orderkey // 1000 AS doc, place AS ordinal, o_orderkey AS id,
       CASE WHEN o_orderkey % 10 <> 3 THEN o_orderstatus END AS druh
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS place FROM orders)
WHERE o_orderkey % 10 <> 7
"""


def geojson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = geojson.explode_features(_documents(spark, sf_dir), "document", "o_orderkey")
    rows = found.select("o_orderkey", "ordinal", *accident_columns(F.col("payload")))
    return rows.select(
        "o_orderkey", "ordinal", "lat", "lon",
        F.col("date").cast("date").cast("string").alias("date"),
        "cause", "collision_type",
        F.col("slightly_injured").cast("bigint").alias("slightly_injured"),
        F.col("severely_injured").cast("bigint").alias("severely_injured"),
        F.col("fatalities").cast("bigint").alias("fatalities"),
        "total_damage",
    )


GEOJSON_SCAN = """
WITH shapes(shape, ordinal, placed) AS (
  VALUES (0, 0, true), (0, 1, true), (1, 0, true), (5, 0, true), (7, 0, false), (8, 0, true), (8, 1, false))
SELECT o_orderkey, CAST(ordinal AS BIGINT) AS ordinal,
       CASE WHEN placed THEN CAST(o_orderkey % 90 AS DOUBLE) + 0.5 END AS lat,
       CASE WHEN placed THEN CAST(o_custkey AS DOUBLE) + 0.25 END AS lon,
       strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS cause,
       o_orderstatus AS collision_type, o_orderkey % 5 AS slightly_injured,
       o_orderkey % 3 AS severely_injured, CAST(NULL AS BIGINT) AS fatalities,
       o_custkey * 1000 AS total_damage
FROM orders JOIN shapes ON o_orderkey % 9 = shape
"""


# ------------------------------------------------------------------------------ generated dates


def year_file_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a backfill with the number of events each year brings."""
    per_year = load(spark, sf_dir, "events").groupBy(F.year("ts").alias("year")).agg(
        F.count("*").alias("n_events")
    )
    plan = calendar.year_files(spark, AS_OF, backfill=True)
    return plan.join(per_year, "year", "left").select(
        F.col("year").cast("bigint").alias("year"), "stem",
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
    )


YEAR_FILE_PLAN = """
SELECT y AS year, 'nehody_' || y || '01-' || y || '12' AS stem, count(event_id) AS n_events
FROM generate_series(2010, 2025) g(y) LEFT JOIN events ON year(ts) = y
GROUP BY y
"""


def range_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch windows per event type with the events that fall into each."""
    events = load(spark, sf_dir, "events")
    first, last = calendar.fetch_bounds(AS_OF, backfill=True)
    stations = events.select(F.col("event_type").alias("station_id")).distinct()
    windows = calendar.fetch_windows(stations, first, last)
    begin = F.lit(first).cast("date")
    place = F.floor(F.date_diff(F.col("ts").cast("date"), begin) / calendar.WINDOW_DAYS).cast("int")
    counts = events.groupBy(
        F.col("event_type").alias("station_id"),
        F.date_add(begin, place * calendar.WINDOW_DAYS).alias("start"),
    ).agg(F.count("*").alias("n_events"))
    return windows.join(counts, ["station_id", "start"], "left").select(
        "station_id", F.col("start").cast("string").alias("start"),
        F.col("end").cast("string").alias("end"), F.coalesce("n_events", F.lit(0)).alias("n_events"),
    )


RANGE_CHUNKS = """
WITH windows AS (
  SELECT CAST(s AS DATE) AS a, least(CAST(s AS DATE) + 30, DATE '2025-12-31') AS b
  FROM generate_series(TIMESTAMP '2010-01-01', TIMESTAMP '2025-12-31', INTERVAL 31 DAY) g(s)),
stations AS (SELECT DISTINCT event_type AS station_id FROM events)
SELECT station_id, strftime(a, '%Y-%m-%d') AS start, strftime(b, '%Y-%m-%d') AS "end",
       count(event_id) AS n_events
FROM stations CROSS JOIN windows
LEFT JOIN events ON event_type = station_id AND CAST(ts AS DATE) BETWEEN a AND b
GROUP BY station_id, a, b
"""


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day spine with the orders placed on each day."""
    per_day = load(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("*").alias("n_orders")
    )
    spine = calendar.date_spine(spark).join(per_day, "date", "left")
    numbers = ["date_id", "year", "month", "day", "day_of_week"]
    return spine.select(
        F.col("date").cast("string").alias("date"),
        *[F.col(c).cast("bigint").alias(c) for c in numbers],
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
    )


DATE_DIM = """
WITH spine AS (
  SELECT CAST(s AS DATE) AS d
  FROM generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY) g(s)),
counts AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS date, row_number() OVER (ORDER BY d) AS date_id, year(d) AS year,
       month(d) AS month, day(d) AS day, isodow(d) AS day_of_week, coalesce(n, 0) AS n_orders
FROM spine LEFT JOIN counts USING (d)
"""


# ------------------------------------------------------------------------------ JSON payloads


def payload_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event, with two records, one, none, or no data key at all."""
    k = F.get_json_object("props", "$.k")
    clock = F.date_format("ts", "yyyy-MM-dd HH:00:00")

    def record(temp: object) -> object:
        return F.concat(F.lit('{"time":"'), clock, F.lit('","temp":'), temp, F.lit(',"prcp":null}'))

    responses = pick(
        F.col("event_id"),
        [
            F.concat(F.lit('{"meta":{},"data":['), record(k), F.lit(","), record(F.lit("-1.5")), F.lit("]}")),
            F.concat(F.lit('{"data":['), record(k), F.lit("]}")),
            F.lit('{"data":[]}'),
            F.lit('{"meta":{}}'),
        ],
    )
    events = load(spark, sf_dir, "events").select("event_id", "event_type", responses.alias("response"))
    hours = landed.explode_hours(events, "response", "event_type", "event_id")
    return hours.select("event_id", "source", F.to_json("payload").alias("payload"))


PAYLOAD_UNNEST = """
WITH records(shape, fixed) AS (VALUES (0, NULL), (0, '-1.5'), (1, NULL))
SELECT event_id, 'meteostat_hourly_' || event_type AS source,
       '{"prcp":null,"temp":' || coalesce(fixed, json_extract_string(props, '$.k')) || ',"time":"'
       || strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') || '"}' AS payload
FROM events JOIN records ON event_id % 4 = shape
"""


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return load(spark, sf_dir, "events").select(
        "event_id", json_text(props, "k").alias("k"), json_text(props, "zz").alias("zz")
    )


JSON_EXTRACT = """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.zz') AS zz FROM events
"""


# --------------------------------------------------------------------------- raw row selection


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = bronze.latest(load(spark, sf_dir, "events"), "event_id")
    return newest.select("event_id", "user_id", "event_type", "value", "props")


LATEST_SNAPSHOT = """
SELECT event_id, user_id, event_type, value, props FROM events ORDER BY event_id DESC LIMIT 1
"""


def newest_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = bronze.newest_per_source(load(spark, sf_dir, "documents"), "doc_id")
    return newest.select("doc_id", "source", "n_chars", "text")


NEWEST_PER_SOURCE = """
SELECT doc_id, source, n_chars, text FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1
"""


def distinct_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.station_ids(
        load(spark, sf_dir, "events").select(F.col("event_type").alias("station_id"))
    )


DISTINCT_STATIONS = "SELECT DISTINCT event_type AS station_id FROM events ORDER BY 1"


# --------------------------------------------------------------------------------- table writes


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payloads by customer source; building customers were landed before."""
    customers = load(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    tag = F.format_string("cust_%d", F.col("o_custkey"))
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("raw_id"), "o_orderpriority", tag.alias("source")
    )
    seen = customers.select(F.format_string("cust_%d", F.col("c_custkey")).alias("source"))
    schema = "raw_id bigint, payload string, source string, load string"
    table = Table(spark, scratch_path(spark, "bronze_append"), "orders", schema)
    payload = F.to_json(F.struct("o_orderpriority")).alias("payload")
    before = orders.join(seen, "source", "left_semi")
    table.append(before.select("raw_id", payload, "source", F.lit("old").alias("load")))
    fresh = unseen_sources(orders, table.read())
    table.append(fresh.select("raw_id", payload, "source", F.lit("new").alias("load")))
    return table.read()


BRONZE_APPEND = """
SELECT o_orderkey AS raw_id, '{"o_orderpriority":"' || o_orderpriority || '"}' AS payload,
       'cust_' || o_custkey AS source,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'old' ELSE 'new' END AS load
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
"""


def city_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers written as city files, each one array, and read back; some lack a station or a place."""
    key = F.col("s_suppkey")
    city = F.struct(
        F.col("s_name").alias("city"),
        F.col("s_nationkey").cast("string").alias("region"),
        F.col("s_acctbal").alias("lat"),
        F.when(key % 7 != 0, F.col("s_nationkey").cast("double")).alias("lon"),
        F.when(key % 5 != 0, F.format_string("%d", key)).alias("station_id"),
    )
    suppliers = load(spark, sf_dir, "supplier").select(F.floor(key / 1000).alias("part"), city.alias("city"))
    arrays = suppliers.groupBy("part").agg(F.to_json(F.collect_list("city")).alias("value"))
    path = scratch_path(spark, "cities")
    arrays.write.partitionBy("part").text(path)
    return landed.cities(spark, path).select("city", "region", "lat", "lon", "station_id")


CITY_SCAN = """
SELECT s_name AS city, CAST(s_nationkey AS VARCHAR) AS region, s_acctbal AS lat,
       CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS lon,
       CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS station_id
FROM supplier
"""


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt first, then everyone, replaced by a job that reads the first version."""
    schema = "c_custkey bigint, c_name string, c_acctbal double, load string"
    table = Table(spark, scratch_path(spark, "full_refresh"), "customers", schema)
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    table.replace(rows.where(F.col("c_acctbal") < 0).withColumn("load", F.lit("first")))
    known = table.read().select("c_custkey", F.col("load").alias("seen"))
    table.replace(
        rows.join(known, "c_custkey", "left").withColumn("load", F.coalesce("seen", F.lit("second")))
    )
    return table.read()


FULL_REFRESH = """
SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'first' ELSE 'second' END AS load
FROM customer
"""

_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def merge_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items into a target that already holds the open ones; (order, line) repeats in the batch."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = load(spark, sf_dir, "lineitem").select(*keys, *_LINE_ORDER, "l_linestatus")
    order = [F.col(c) for c in _LINE_ORDER]
    target = first_per_key(lines.where(F.col("l_linestatus") == "O"), keys, order)
    merged = insert_only_merge(
        lines.withColumn("load", F.lit("new")), target.withColumn("load", F.lit("old")), keys, order
    )
    return merged.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey", "l_suppkey", "l_extendedprice", "load",
    )


MERGE_OF_LINES = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_linestatus
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem),
target AS (SELECT * FROM ranked WHERE l_linestatus = 'O' AND rn = 1),
batch AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       'old' AS load FROM target
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), l_partkey, l_suppkey, l_extendedprice, 'new' FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM target t
                  WHERE t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber)
"""


def merge_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cities named by nation: few names, many rows each, and some without a name.

    Rows without a name never conflict; nations of one region are in the target before.
    """
    customers = load(spark, sf_dir, "customer")
    named = F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("NATION_"), text("c_nationkey")))
    batch = customers.select(named.alias("city_name"), "c_custkey", F.lit("new").alias("load"))
    target = load(spark, sf_dir, "nation").where(F.col("n_regionkey") == 1).select(
        F.col("n_name").alias("city_name"),
        F.lit(None).cast("bigint").alias("c_custkey"),
        F.lit("old").alias("load"),
    )
    return insert_only_merge(batch, target, ["city_name"], [F.col("c_custkey")], nullable_keys=True)


MERGE_WITH_NULL_KEYS = """
WITH batch AS (
  SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN 'NATION_' || c_nationkey END AS city_name, c_custkey
  FROM customer),
target AS (SELECT n_name AS city_name FROM nation WHERE n_regionkey = 1)
SELECT city_name, CAST(NULL AS BIGINT) AS c_custkey, 'old' AS load FROM target
UNION ALL SELECT city_name, c_custkey, 'new' FROM batch WHERE city_name IS NULL
UNION ALL SELECT city_name, min(c_custkey), 'new' FROM batch
WHERE city_name IS NOT NULL AND city_name NOT IN (SELECT city_name FROM target) GROUP BY city_name
"""


def first_writer_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(
        "event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.hour("ts").cast("bigint").alias("hour"), "event_type", "value",
    )
    return first_per_key(events, ["user_id", "date", "hour"], [F.col("event_id")])


FIRST_WRITER_DEDUPE = """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS date, hour(ts) AS hour, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), hour(ts) ORDER BY event_id) = 1
"""


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_mktsegment", "c_name")
    return dense_ids(rows, ["c_mktsegment", "c_name"], "id", start=101)


SURROGATE_KEYS = """
SELECT 100 + row_number() OVER (ORDER BY c_mktsegment, c_name) AS id, c_mktsegment, c_name FROM customer
"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "city_scan": (city_scan, CITY_SCAN),
    "geojson_file_scan": (_from_files(geojson.document_features), FROM_FILES),
    "geojson_split_scan": (_from_files(geojson.split_features), FROM_FILES),
    "geojson_scan": (geojson_scan, GEOJSON_SCAN),
    "year_file_plan": (year_file_plan, YEAR_FILE_PLAN),
    "range_chunks": (range_chunks, RANGE_CHUNKS),
    "date_dim": (date_dim, DATE_DIM),
    "payload_unnest": (payload_unnest, PAYLOAD_UNNEST),
    "json_extract": (json_extract, JSON_EXTRACT),
    "latest_snapshot": (latest_snapshot, LATEST_SNAPSHOT),
    "newest_per_source": (newest_per_source, NEWEST_PER_SOURCE),
    "distinct_stations": (distinct_stations, DISTINCT_STATIONS),
    "bronze_append": (bronze_append, BRONZE_APPEND),
    "full_refresh": (full_refresh, FULL_REFRESH),
    "insert_only_merge": (merge_of_lines, MERGE_OF_LINES),
    "insert_only_merge_null_keys": (merge_with_null_keys, MERGE_WITH_NULL_KEYS),
    "first_writer_dedupe": (first_writer_dedupe, FIRST_WRITER_DEDUPE),
    "surrogate_keys": (surrogate_keys, SURROGATE_KEYS),
}
