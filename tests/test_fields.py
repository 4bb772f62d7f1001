"""Golden cases of the field rules."""

import datetime as dt
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac.functions import accidents, geometry, roads, weather
from tarmac.functions.geometry import to_wkb, wkb_points
from tarmac.functions.numbers import truncate
from tarmac.plans.clean import clean_weather, road_columns
from tarmac.plans.dims import daily_weather
from tarmac.sources.geojson import explode_features
from tarmac.sources.landed import road_lines


def apply(spark, values, rule, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").select("out").collect()]


DAMAGE = [
    ('{"properties":{"hmotna_skoda":"1 000 Kč"}}', 1000),
    ('{"properties":{"hmotna_skoda":"25000"}}', 25000),
    ('{"properties":{"hmotna_skoda":"-5"}}', None),
    ('{"properties":{"hmotna_skoda":"10.5"}}', None),
    ('{"properties":{"hmotna_skoda":""}}', None),
    ('{"properties":{"hmotna_skoda":"1\u00a0000 Kč"}}', None),
    ('{"properties":{"hmotna_skoda":"99999999999999999999"}}', None),
    ('{"properties":{}}', 0),
    ("{}", 0),
    ('{"properties":{"hmotna_skoda":null}}', None),
    ('{"properties":{"hmotna_skoda":1234.5}}', 1235),
    ('{"properties":{"hmotna_skoda":1234.4999999}}', 1234),
    ('{"properties":{"hmotna_skoda":-2.5}}', -3),
    ('{"properties":{"hmotna_skoda":1.5e3}}', 1500),
    ('{"properties":{"hmotna_skoda":-7}}', -7),
    ('{"properties":{"hmotna_skoda":true}}', None),
    ('{"properties":{"hmotna_skoda":[1]}}', None),
    ('{"properties":{"hmotna_skoda":{"a":1}}}', None),
]


def test_damage(spark):
    got = apply(spark, [t for t, _ in DAMAGE], lambda v: accidents.damage(F.parse_json(v)))
    assert got == [want for _, want in DAMAGE]


DATES = [
    ("2024-06-01", dt.date(2024, 6, 1)),
    ("2024-01-01T23:30:00-05:00", dt.date(2024, 1, 1)),
    ("2024-01-01 08:15", dt.date(2024, 1, 1)),
    ("2024-01-01T08:15:30.123Z", dt.date(2024, 1, 1)),
    ("20240101", dt.date(2024, 1, 1)),
    ("2024-01-01Tgarbage", None),
    ("2024-01-01T25:00", None),
    ("2024", None),
    ("2024-1-5", None),
    ("2024-02-30", None),
    ("20240230", None),
    ("", None),
    (None, None),
    ("2024-W01-1", None),
]


def test_iso_day(spark):
    assert apply(spark, [t for t, _ in DATES], accidents.iso_day) == [d for _, d in DATES]


def test_strip_text(spark):
    texts = [" a ", "\t\u00a0a\n", "", None, "   ", "a b"]
    assert apply(spark, texts, accidents.strip_text) == ["a", "a", None, None, "", "a b"]


FEATURE = '{"properties":{"pricina":" x "},"geometry":{"coordinates":[14.5,50.1]}}'
DOCUMENTS = [
    (f'{{"features":[{FEATURE},5,null,"x"]}}', [0]),
    (f'[{{"features":[{FEATURE},{FEATURE}]}}]', [0, 1]),
    (f'[{{"features":[{FEATURE}]}},7]', [0]),
    (f'[{{"features":[{FEATURE}]}},{{"features":[{FEATURE},{FEATURE}]}}]', [0]),
    (f'{{"features":["x",{FEATURE}]}}', [1]),
    ("[]", []),
    ("[5]", []),
    ('"text"', []),
    ("{}", []),
    ('{"features":null}', []),
    ('{"features":{"a":1}}', []),
]


def test_document_shapes(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(DOCUMENTS)], "i int, doc string")
    rows = explode_features(df, "doc", "i").orderBy("i", "ordinal").collect()
    got = {i: [r.ordinal for r in rows if r.i == i] for i in range(len(DOCUMENTS))}
    assert got == {i: want for i, (_, want) in enumerate(DOCUMENTS)}


def test_coordinates(spark):
    texts = [
        FEATURE,
        '{"geometry":null}',
        '{"geometry":{"coordinates":[1]}}',
        '{"geometry":{"coordinates":[1,2,3]}}',
        "{}",
    ]
    lat = apply(spark, texts, lambda v: accidents.coordinate(F.parse_json(v), 1))
    lon = apply(spark, texts, lambda v: accidents.coordinate(F.parse_json(v), 0))
    assert lat == [50.1, None, None, 2.0, None]
    assert lon == [14.5, None, 1.0, 1.0, None]


def test_station_code(spark):
    sources = ["meteostat_hourly_11518", "meteostat_hourly_D1234", "abc", "1a", None]
    assert apply(spark, sources, weather.station_code) == ["11518", "D1234", None, None, None]


def test_weather_hours(spark):
    rows = [
        (1, '{"time":"2024-01-01 13:05:00","temp":-1.5,"prcp":null,"snow":2.5,"wdir":48.4,"wspd":"3.25"}', "s_1"),
        (2, '{"time":"2024-03-31 02:30:00"}', "s_D2"),
        (3, '{"time":"2024-01-01 13:05:00"}', "none"),
        (4, '{"temp":1}', "s_1"),
        (5, '{"time":"2024-01-01 14:00:00","temp":1000}', "s_1"),
    ]
    raw = spark.createDataFrame(rows, "raw_id long, payload string, source string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Prague")  # 02:30 does not exist there that day
    try:
        good, bad = clean_weather(raw.withColumn("payload", F.parse_json("payload")))
        hours = {r.raw_id: r for r in good.collect()}
        reasons = {r.raw_id: r.reasons for r in bad.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert set(hours) == {1, 2, 5}
    first = hours[1]
    assert (first.date, first.time, first.snow, first.wind_dir) == (dt.date(2024, 1, 1), "13:05:00", 3, 48)
    assert (first.temp_c, first.precipitation_mm, first.wind_speed) == (Decimal("-1.50"), None, Decimal("3.25"))
    assert hours[2].time == "02:30:00"
    assert hours[5].temp_c is None
    assert reasons == {3: ["no station code"], 4: ["no readable time"]}


SPEEDS = [
    ("primary", "CZ:urban", 50),
    ("primary", "CZ:rural", 90),
    ("primary", "CZ:living_street", 20),
    ("primary", "CZ:pedestrian_zone", 20),
    ("primary", "walk", 5),
    ("motorway", "none", None),
    ("primary", "30 mph", 48),
    ("primary", "20 mph", 32),
    ("motorway", "30mph", None),
    ("primary", "50;30", 50),
    ("motorway", "signals", 130),
    ("residential", None, 30),
    ("primary", None, None),
    ("primary", "99999", None),
]


def test_max_speed(spark):
    df = spark.createDataFrame([(i, h, m) for i, (h, m, _) in enumerate(SPEEDS)], "i int, h string, m string")
    rows = df.select("i", roads.max_speed(F.col("m"), F.col("h")).alias("s")).orderBy("i").collect()
    assert [r.s for r in rows] == [want for _, _, want in SPEEDS]


def test_lanes_and_one_way(spark):
    assert apply(spark, ["2", "-2", "2;3", "1.5", None, "99999"], roads.lane_count) == [2, 2, None, None, None, None]
    texts = ["yes", "alternating", "reversible", "1", "-1", "no", "0", "other", None]
    assert apply(spark, texts, roads.one_way) == [True] * 5 + [False] * 4


def test_tag_map(spark):
    text = r'"a"=>"x \"q\" \\ y", "b"=>NULL, "c"=>"", "d"=>"p, q=>r", "a"=>"again", "n"=>"NULL"'
    [tags] = apply(spark, [text], roads.tag_map)
    assert tags == {"a": r'x "q" \ y', "b": None, "c": "", "d": "p, q=>r", "n": "NULL"}
    assert apply(spark, ["", None], roads.tag_map) == [{}, None]


def test_line_points(spark):
    texts = ["LINESTRING (1 2, 3.5  -4,5 6)", "LINESTRING Z (1 2 9, 3 4 9)", "POINT (1 2)", "LINESTRING (1 x, 2 3)", None]
    got = apply(spark, texts, geometry.line_points)
    assert [[(p.lon, p.lat) for p in g] if g else g for g in got] == [
        [(1.0, 2.0), (3.5, -4.0), (5.0, 6.0)], [(1.0, 2.0), (3.0, 4.0)], None, None, None,
    ]


def test_truncate_cuts_toward_zero(spark):
    got = apply(spark, ["-1.239", "1.239", "-1.235", None], lambda v: truncate(v.cast("decimal(10,5)"), 2))
    assert got == [Decimal("-1.23"), Decimal("1.23"), Decimal("-1.23"), None]


def _day(spark, temps=(), winds=()):
    rows = [("s", dt.date(2024, 1, 1), t, d) for t, d in zip(temps, winds)]
    hours = spark.createDataFrame(rows, "station_id string, date date, t string, wind_dir int").select(
        "station_id", "date", F.col("t").cast("decimal(5,2)").alias("temp_c"), "wind_dir",
        F.lit(None).cast("decimal(6,2)").alias("precipitation_mm"),
        F.lit(None).cast("int").alias("snow"), F.lit(None).cast("decimal(5,2)").alias("wind_speed"),
    )
    return daily_weather(hours).first()


def test_daily_means(spark):
    day = _day(spark, ["-1.23", "-1.24"], [350, 10])
    assert (day.temp_c, day.wind_dir, day.snow, day.weather_category) == (Decimal("-1.23"), 180, None, "Clear")
    assert _day(spark, ["1", "2"], [2, 3]).wind_dir == 3


CATEGORIES = [
    ("1.004", "0", "-5", "0", "snowy"),
    ("1", "0", "-5", "0", "Freezing"),
    ("0", "10.004", "5", "0", "Heavy Rain"),
    ("0", "10", "5", "0", "Rainy"),
    ("0", "0.2", "5", "0", "Rainy"),
    ("0", "0.199", "5", "31", "Windy"),
    ("0", "12", "-1", "0", "Clear"),
    ("0", "0.2", "-1", "0", "Freezing"),
    (None, None, None, None, "Clear"),
    (None, None, "-1", "0", "Clear"),
]


@pytest.mark.parametrize("snow,rain,temp,wind,want", CATEGORIES)
def test_category(spark, snow, rain, temp, wind, want):
    def number(v):
        return F.lit(v).cast("decimal(20,10)")

    rule = weather.category(number(temp), number(rain), number(snow), number(wind))
    assert spark.range(1).select(rule).first()[0] == want


def test_road_columns(spark):
    tags = {"highway": "residential", "lanes": "-2", "oneway": "-1", "name": "A"}
    ways = spark.createDataFrame([(9_000_000_000, tags, None)], "osm_id long, tags map<string,string>, geom string")
    row = road_columns(ways).first()
    assert (row.road_id, row.name, row.lanes, row.max_speed, row.oneway, row.is_intersection) == (
        9_000_000_000, "A", 2, 30, True, False,
    )


NUMBERS = [0.0, -0.0, 1.0, -1.0, 0.1, 14.4378, -50.0755, 2.0**-1022, 5e-324, -3e-310, 1.7976931348623157e308, 2.0**52 + 1, 1 / 3, 0.5, 2 - 2**-52]


def test_wkb_of_both_byte_orders(spark):
    """Doubles of every kind are read as they were packed, and written as they would be packed."""
    pairs = list(zip(NUMBERS, reversed(NUMBERS)))
    packed = [struct.pack(f"{o}BII{2 * len(pairs)}d", int(o == "<"), 2, len(pairs), *[v for p in pairs for v in p]) for o in "<>"]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(packed)], "i int, wkb binary")
    points = df.select("i", wkb_points(F.col("wkb")).alias("p"))
    for row in points.collect():
        assert [(v.lon.hex(), v.lat.hex()) for v in row.p] == [(a.hex(), b.hex()) for a, b in pairs]
    written = points.select("i", to_wkb(F.col("p"), F.col("i") == 0).alias("w")).collect()
    assert {r.i: bytes(r.w) for r in written} == dict(enumerate(packed))


def test_wkb_that_is_no_line(spark):
    line = struct.pack("<BII4d", 1, 2, 2, 1.0, 2.0, 3.0, 4.0)
    bad = [None, b"", line[:-1], line + b"x", b"\x02" + line[1:], struct.pack("<BI2d", 1, 1, 1.0, 2.0), struct.pack("<BII", 1, 2, 0)]
    bad += [struct.pack("<BII4d", 1, 2, 2, 1.0, float("nan"), 3.0, 4.0), struct.pack("<BII4d", 1, 2, 2, 1.0, float("inf"), 3.0, 4.0)]
    bad += [struct.pack("<BII6d", 1, 1002, 2, *[1.0] * 6), struct.pack("<BII2d", 1, 2, 0xFFFFFFFF, 1.0, 2.0), b"\x01\x02"]
    df = spark.createDataFrame([(b and bytearray(b) if b is not None else None,) for b in bad], "wkb binary")
    assert [r.p for r in df.select(wkb_points(F.col("wkb")).alias("p")).collect()] == [None] * len(bad)


def test_roads_are_taken_from_wkb(spark):
    line = bytearray(struct.pack(">BII4d", 0, 2, 2, 1.0, 2.0, 3.0, 4.0))
    rows = [(1, "residential", line, None), (2, "primary", bytearray(b"?"), None)]
    found = road_lines(spark.createDataFrame(rows, "osm_id bigint, highway string, wkb binary, all_tags string"))
    assert {r.osm_id: r.geom and [tuple(v) for v in r.geom] for r in found.collect()} == {1: [(1.0, 2.0), (3.0, 4.0)], 2: None}


def test_wkb_expressions_make_each_value_once():
    """Each number's digits are bound to a name; written out again at every use, they were made over and over."""
    written, read = str(to_wkb(F.col("p"), F.col("little"))), str(wkb_points(F.col("wkb")))
    assert read.lower().count("hex(") < 20 and written.lower().count("log2(") < 10
