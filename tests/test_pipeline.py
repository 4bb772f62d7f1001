"""The whole load on small landed files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tarmac.operators.quality import ConstraintError
from tarmac.plans import clean, dims
from tarmac.plans.pipeline import Warehouse
from tarmac.schemas import SCHEMAS
from tarmac.session import scratch_path
from tarmac.sources import geojson
from tarmac.sources.tables import Table
from tarmac.streaming.landing import land_weather

GOLD = [n for n in SCHEMAS if not n.startswith("bronze")]


def feature(lon, lat, day="2024-01-01", damage="1 000 Kč", **more):
    return {
        "type": "Feature",
        "properties": {"datum": day, "pricina": " speed ", "druh": "rear", "lehce_zraneno": 1,
                       "tezce_zraneno": 0, "usmrceno": 0, "hmotna_skoda": damage, **more},
        "geometry": {"type": "Point", "coordinates": [lon, lat]},
    }


YEAR_2023 = [feature(0.1, 0.1, "2023-05-05")]
YEAR_2024 = [
    feature(0.1, 0.1),
    feature(5, 5, "2024-01-02", None),
    feature(None, None, "not a day"),
    feature(5, 1, "1999-01-01", 12.5),
    feature(4.9, 5.0, "2024-01-01T23:59:00+02:00", "x"),
]
CITIES = [
    {"city": "A", "region": "R", "lat": 0.0, "lon": 0.0, "station_id": "11518"},
    {"city": "B", "region": "R", "lat": 5.1, "lon": 5.0, "station_id": "D22"},
    {"city": "A", "region": "again", "lat": 9.0, "lon": 9.0, "station_id": "x"},
]
HOURS = [
    {"time": "2024-01-01 00:00:00", "temp": -1.23, "prcp": 0, "snow": None, "wdir": 350, "wspd": 5},
    {"time": "2024-01-01 01:00:00", "temp": -1.24, "prcp": 0, "snow": None, "wdir": 10, "wspd": 5},
    {"time": "2024-01-01 01:00:00", "temp": 40, "prcp": 0, "snow": None, "wdir": 10, "wspd": 5},
    {"time": "garbage", "temp": 1},
]
ROADS = [
    ("1", "residential", "LINESTRING (0 0, 10 0)", '"highway"=>"residential", "name"=>"Low"'),
    ("2", "motorway", "LINESTRING (5 4, 5 6)", '"highway"=>"motorway", "maxspeed"=>"none", "lanes"=>"-2"'),
    ("3", None, "LINESTRING (0 0.1, 1 0.1)", '"waterway"=>"river"'),
    ("4", "primary", "POINT (1 1)", '"highway"=>"primary"'),
]


@pytest.fixture()
def landed(tmp_path):
    (tmp_path / "accidents").mkdir()
    for name, features in [("nehody_202301-202312", YEAR_2023), ("nehody_202401-202412", YEAR_2024)]:
        document = {"type": "FeatureCollection", "features": features}
        (tmp_path / "accidents" / f"{name}.geojson").write_text(json.dumps(document))
    (tmp_path / "cities.json").write_text(json.dumps(CITIES))
    for station in ("11518", "D22"):
        folder = tmp_path / "weather" / f"station={station}"
        folder.mkdir(parents=True)
        (folder / "2024-01.json").write_text(json.dumps({"meta": {}, "data": HOURS}))
        (folder / "2024-02.json").write_text(json.dumps({"meta": {}}))
    return tmp_path


def content(house, name):
    table = house.table(name).read()
    return sorted((tuple(r) for r in table.collect()), key=repr)


def road_extract(spark):
    return spark.createDataFrame(ROADS, "osm_id string, highway string, wkt string, all_tags string")


def ingest(house, spark, landed, **options):
    paths = sorted(str(p) for p in (landed / "accidents").iterdir())
    for path in paths:  # one call each, so the newest load is the newest year
        house.ingest_accidents([path], **options)
    house.ingest_weather(str(landed / "weather"))
    house.ingest_roads(road_extract(spark))


def test_load_and_repeat(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    ingest(house, spark, landed)
    house.build(str(landed / "cities.json"))

    silver = house.table("silver.traffic_accident_clean").read().collect()
    assert len(silver) == 5  # the newest file alone
    assert {r.total_damage for r in silver} == {1000, None, 13}
    assert {r.cause for r in silver} == {"speed"}

    facts = house.table("gold.fact_traffic_accidents").read()
    dates = {r.date_id: str(r.date) for r in house.table("gold.dim_date").read().collect()}
    weather = {r.weather_id: r for r in house.table("gold.dim_weather").read().collect()}
    cities = {r.city_id: r.city_name for r in house.table("gold.dim_city").read().collect()}
    got = [
        (cities[r.city_id], dates.get(r.date_id), r.road_id,
         weather[r.weather_id].station_id if r.weather_id else None, r.total_damage)
        for r in facts.collect()
    ]
    assert sorted(got, key=repr) == sorted([
        ("A", "2024-01-01", 1, "11518", 1000),
        ("B", "2024-01-02", 2, None, None),
        ("A", None, 1, None, 1000),  # no place, no day: smallest ids, row kept
        ("B", None, 1, None, 13),  # day before the spine
        ("B", "2024-01-01", 2, "D22", None),
    ], key=repr)
    assert house.unplaced_accidents().count() == 1
    assert len(weather) == 2
    day = next(iter(weather.values()))
    assert (str(day.temp_c), day.wind_dir, day.weather_category) == ("-1.23", 180, "Freezing")
    assert [c[1] for c in content(house, "gold.dim_city")] == ["A", "B"]

    before = {name: content(house, name) for name in GOLD}
    ingest(house, spark, landed)  # accident files are known, hours land twice, roads are replaced
    house.build(str(landed / "cities.json"))
    assert {name: content(house, name) for name in GOLD} == before

    ingest(house, spark, landed, allow_reload=True)  # new raw ids, same accidents
    house.build(str(landed / "cities.json"))
    after = {name: content(house, name) for name in GOLD}
    assert after["gold.fact_traffic_accidents"] == before["gold.fact_traffic_accidents"]

    house.build(str(landed / "cities.json"), backfill=True)  # all files, each at its newest load
    assert house.table("silver.traffic_accident_clean").read().count() == 6
    assert house.table("gold.fact_traffic_accidents").read().count() == 6


def test_quarantine(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    ingest(house, spark, landed)
    assert {tuple(r.reasons) for r in house.clean_weather().collect()} == {("no readable time",)}
    assert {(r.road_id, tuple(r.reasons)) for r in house.clean_roads().collect()} == {(4, ("no line",))}
    house.clean_weather()  # the hours are behind the progress mark, their quarantine stays
    house.clean_roads()
    assert {tuple(r.reasons) for r in house.quarantined("weather").read().collect()} == {("no readable time",)}
    assert [r.raw_id for r in house.quarantined("roads").read().collect()] == [4]


def test_weather_is_absorbed_once(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    house.ingest_weather(str(landed / "weather"))
    house.clean_weather()
    before = content(house, "silver.weather_clean")
    assert house.clean_weather().isEmpty()  # nothing new to read
    later = landed / "later" / "station=11518"
    later.mkdir(parents=True)
    more = [HOURS[0] | {"temp": 33}, HOURS[0] | {"time": "2024-01-01 02:00:00"}, HOURS[3]]
    (later / "2024-04.json").write_text(json.dumps({"data": more}))
    house.ingest_weather(str(landed / "later"))
    assert house.clean_weather().count() == 1
    after = content(house, "silver.weather_clean")
    assert len(after) == len(before) + 1 and set(before) <= set(after)
    house.clean_weather(everything=True)
    assert content(house, "silver.weather_clean") == after


def test_empty_input_keeps_the_old_accidents(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    ingest(house, spark, landed)
    house.clean_accidents()
    empty = landed / "accidents" / "nehody_202501-202512.geojson"
    empty.write_text('{"features":[]}')
    house.ingest_accidents([str(empty)])
    house.clean_accidents()
    assert house.table("silver.traffic_accident_clean").read().count() == 5


def _written(features, style):
    if style == "line per feature":
        body = ",\n".join(json.dumps(f) for f in features)
        return '{\n"type": "FeatureCollection",\n"features": [\n' + body + "\n]\n}\n"
    document = {"type": "FeatureCollection", "features": features}
    if style == "one line, members after":
        document["crs"] = "x"
    return json.dumps(document)


@pytest.mark.parametrize("style", ["line per feature", "one line", "one line, members after"])
def test_a_file_read_by_many_tasks(spark, landed, style):
    folder = landed / "large"
    folder.mkdir()
    features = [feature(i / 10, 1.0, damage=i, pricina="a, [b] }") for i in range(2000)]
    path = folder / "nehody_202401-202412.geojson"
    path.write_text(_written(features, style))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    for size in (split, "40000"):
        house = Warehouse(spark, scratch_path(spark, "house"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            house.ingest_accidents([str(path)])
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        house.clean_accidents()
        found.append(content(house, "silver.traffic_accident_clean"))
    assert len(found[0]) == 2000 and found[0] == found[1]
    assert sorted(r.total_damage for r in house.table("silver.traffic_accident_clean").read().collect()) == list(range(2000))


@pytest.mark.parametrize("end", ['{"properties": {"a": 1}, "geometry": \n]}\n', '{"a": 1}', '{"a": "b', '{"a": [1}]}'])
def test_broken_feature_stops_the_load(spark, landed, end):
    path = landed / "broken.geojson"
    path.write_text('{"features": [\n{"properties": {"a": 1}},\n' + end)
    house = Warehouse(spark, scratch_path(spark, "house"))
    with pytest.raises(Exception, match="un(readable feature|finished array) in .*broken"):
        house.ingest_accidents([str(path)])
    assert house.table("bronze.traffic_accidents_raw").read().isEmpty()
    assert house.table("bronze.traffic_accident_features").read().isEmpty()


ODD = [
    feature(1, 2),
    {"type": "Feature", "id": 7},
    None,
    {"type": "Feature", "properties": None, "geometry": None},
    5,
    {"id": "é [x] \"features\": ["},
]


@pytest.mark.parametrize("between,head,tail", [
    (",\n", '{"features": [\n', "\n]}"),
    (",\n\n  ", '{\n"a": {"b": [1]},\n\n"features" : [\n', '\n ] ,\n"crs": {"x": [1]}\n}\n'),
    (",\n", '[\n{"features": [\n', "]}]"),
])
def test_split_scan_gives_the_rows_and_places_of_the_document_scan(spark, tmp_path, between, head, tail):
    path = tmp_path / "a%20 b+c.geojson"
    path.write_text(head + between.join(json.dumps(e, ensure_ascii=False) for e in ODD) + tail)

    def rows(found):
        return sorted((r.path, r.ordinal, str(r.payload)) for r in found.collect())

    whole = rows(geojson.document_features(spark, [str(path)]))
    assert [r[1] for r in whole] == [0, 1, 3, 5]
    assert rows(geojson.split_features(spark, [str(path)])) == whole


WRAPPED = [{"a": {"features": [1]}, "features": ODD, "b": [[1], {"features": [2]}]}, {"features": [{"second": 1}]}]


@pytest.mark.parametrize("size", ["150", "128m"])
def test_split_scan_of_any_layout(spark, tmp_path, size):
    """Same rows and places as the document scan, however the file is laid out and cut into blocks."""
    contents = [
        json.dumps({"features": ODD}, indent=1), json.dumps({"features": ODD}), json.dumps(ODD), json.dumps(WRAPPED, indent=2),
        json.dumps(WRAPPED, ensure_ascii=False), '{"features": [\n{"id": 1},\n{"id": \n2}\n]}', '{"features": null, "a": [1, {"b": 2}]}',
        '{"bbox": [1, 2, 3], "name": "features\\\\", "x\\"": "}{[", "features" : [ {"t": "a\\"}, {"} ] , "z": [{"q": 1}, 2]}', "[]", '"features"',
        '{"a": "features", "b": ["features", {"features": [{"no": 1}]}]}', '{"features": {"features": [{"no": 1}]}}',
    ]
    for i, text in enumerate(contents):
        (tmp_path / f"f{i}.geojson").write_text(text)
    paths = [str(tmp_path / f"f{i}.geojson") for i in range(len(contents))]
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got, want = (
            sorted((r.path, r.ordinal, str(r.payload)) for r in scan(spark, paths).collect())
            for scan in (geojson.split_features, geojson.document_features)
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert got == want and len(want) == 19


def test_split_scan_of_no_features(spark, tmp_path):
    path = tmp_path / "none.geojson"
    path.write_text('{"type": "FeatureCollection",\n"features": []\n}')
    assert geojson.split_features(spark, [str(path)]).isEmpty()


def test_files_of_one_name(spark, tmp_path):
    house, paths = Warehouse(spark, scratch_path(spark, "house")), []
    for folder in ("a", "b c"):
        (tmp_path / folder).mkdir()
        paths.append(str(tmp_path / folder / "n.geojson"))
        (tmp_path / folder / "n.geojson").write_text(json.dumps({"features": [feature(1, 1), feature(2, 2)]}))
    with pytest.raises(ConstraintError, match="one name"):
        house.ingest_accidents(paths)
    assert house.table("bronze.traffic_accidents_raw").read().isEmpty()
    house.ingest_accidents(paths[1:])
    house.ingest_accidents(paths[:1])  # known by name
    features = house.table("bronze.traffic_accident_features").read()
    assert [(r.raw_id, r.ordinal) for r in features.orderBy("ordinal").collect()] == [(1, 0), (1, 1)]


def test_accident_ids_out_of_range_stop_the_load(spark):
    files = spark.createDataFrame([(1 << 27, "a")], "raw_id bigint, source string")
    features = spark.sql("SELECT CAST(1 << 27 AS BIGINT) AS raw_id, 0L AS ordinal, parse_json('{}') AS payload")
    with pytest.raises(Exception, match="out of range"):
        clean.clean_accidents(files, features).collect()


def test_nothing_is_published_without_its_parents(spark, landed, monkeypatch):
    house = Warehouse(spark, scratch_path(spark, "house"))
    ingest(house, spark, landed)
    house.build(str(landed / "cities.json"))
    before = content(house, "gold.fact_traffic_accidents")
    house.table("gold.dim_road").replace(house.table("gold.dim_road").read().where("road_id <> 1"))
    house.clean_accidents(backfill=True)
    with pytest.raises(ConstraintError, match="road_id"):
        house.load_fact()
    assert content(house, "gold.fact_traffic_accidents") == before


def test_repeated_ways_leave_the_old_ones(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    house.ingest_roads(road_extract(spark))
    with pytest.raises(ConstraintError, match="osm_id"):
        house.ingest_roads(road_extract(spark).unionByName(road_extract(spark)))
    assert house.table("bronze.osm_ways").read().count() == 3


def test_year_files_are_read_by_name(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    house.ingest_accident_years(str(landed / "accidents"), dt.date(2025, 6, 1))
    assert [r.source for r in house.table("bronze.traffic_accidents_raw").read().collect()] == ["nehody_202401-202412"]


def test_check_finds_a_missing_parent(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    row = [(1, 99, None, None, None, 0, "x")]
    house.table("gold.fact_traffic_accidents").append(
        spark.createDataFrame(row, SCHEMAS["gold.fact_traffic_accidents"])
    )
    with pytest.raises(ConstraintError, match="city_id"):
        house.check()


def test_stream_lands_each_file_once(spark, landed):
    house = Warehouse(spark, scratch_path(spark, "house"))
    table, progress = house.table("bronze.meteostat_raw"), scratch_path(spark, "progress")
    for expected in (8, 8):
        land_weather(spark, str(landed / "weather"), table, progress).awaitTermination()
        assert table.read().count() == expected
    more = landed / "weather" / "station=11518" / "2024-03.json"
    more.write_text(json.dumps({"data": HOURS[:1]}))
    land_weather(spark, str(landed / "weather"), table, progress).awaitTermination()
    raw = table.read()
    assert raw.count() == 9
    assert raw.select("raw_id").distinct().count() == 9
    assert {r.source for r in raw.select("source").distinct().collect()} == {
        "meteostat_hourly_11518", "meteostat_hourly_D22",
    }
    assert raw.where(F.col("payload").isNull()).isEmpty()


def weather_rows(spark, hours):
    """Bronze rows of (raw_id, day, hour, temperature) at one station."""
    rows = [(i, json.dumps({"time": f"2024-{d} {h:02}:00:00", "temp": t, "prcp": 0.5, "wdir": 90}), "meteostat_hourly_11518") for i, d, h, t in hours]
    frame = spark.createDataFrame(rows, "raw_id bigint, payload string, source string")
    return frame.select("raw_id", F.parse_json("payload").alias("payload"), "source", F.lit(None).cast("timestamp_ntz").alias("load_date"))


LOADS = [
    [(1, "01-31", 1, "1.0"), (2, "01-31", 2, "2.5"), (3, "02-01", 1, "4.0")],
    [(4, "02-01", 2, "6.0"), (5, "02-01", 1, "99.0"), (6, "03-05", 1, "7.0")],  # one hour repeats
    [(7, "03-05", 2, "8.0"), (8, "02-01", 3, "5.0")],
]


def test_days_grow_with_each_load(spark):
    """Sums of days equal those of all hours after every load, and a dimension row stays as it was first built."""
    house = Warehouse(spark, scratch_path(spark, "house"))
    for load in LOADS:
        house.table("bronze.meteostat_raw").append(weather_rows(spark, load))
        house.clean_weather()
        house.load_weather_dim()
        house.load_weather_dim()
        sums = dims.merged_sums(house.table("silver.weather_days").read())
        full = dims.weather_sums(house.table("silver.weather_clean").read())
        assert sorted(dims.weather_of_days(sums).collect()) == sorted(dims.weather_of_days(full).collect())
    found = {(str(r.date), float(r.temp_c)) for r in house.table("gold.dim_weather").read().collect()}
    assert found == {("2024-01-31", 1.75), ("2024-02-01", 4.0), ("2024-03-05", 7.0)}
    ids = sorted(r.weather_id for r in house.table("gold.dim_weather").read().collect())
    assert ids == [1, 2, 3]


def test_a_weather_load_that_fails_half_way_is_repeated(spark, monkeypatch):
    house = Warehouse(spark, scratch_path(spark, "house"))
    house.table("bronze.meteostat_raw").append(weather_rows(spark, LOADS[0]))
    house.clean_weather()
    for step in ("silver.weather_clean", "silver.weather_quarantine"):
        house.table("bronze.meteostat_raw").append(weather_rows(spark, LOADS[1 if step.endswith("clean") else 2]))
        plain = Table.append

        def fail(self, df, batch=None, step=step):
            if self.name == step:
                raise RuntimeError("stopped")
            plain(self, df, batch)

        monkeypatch.setattr(Table, "append", fail)
        with pytest.raises(RuntimeError):
            house.clean_weather()
        monkeypatch.setattr(Table, "append", plain)
        house.clean_weather()
    hours = house.table("silver.weather_clean").read()
    assert hours.count() == 7
    sums = dims.merged_sums(house.table("silver.weather_days").read())
    assert sorted(dims.weather_of_days(sums).collect()) == sorted(dims.daily_weather(hours).collect())


def test_a_repeated_stream_batch_adds_nothing(spark, landed):
    """The stream's note of its finished batch is lost, as by a failure after the write."""
    house = Warehouse(spark, scratch_path(spark, "house"))
    table, progress = house.table("bronze.meteostat_raw"), landed / "progress"
    land_weather(spark, str(landed / "weather"), table, str(progress)).awaitTermination()
    for note in list((progress / "commits").iterdir()):
        note.unlink()
    land_weather(spark, str(landed / "weather"), table, str(progress)).awaitTermination()
    assert table.read().count() == 8


def test_the_road_index_follows_the_lines(spark, landed):
    """It is stored once, made anew when a line is added, and left alone otherwise."""
    house = Warehouse(spark, scratch_path(spark, "house"))
    extract = road_extract(spark)
    house.ingest_roads(extract.limit(1))
    house.clean_roads()
    first = house._road_pages()._versions()
    house.clean_roads()
    assert house._road_pages()._versions() == first
    house.ingest_roads(extract)
    house.clean_roads()
    assert house._road_pages()._versions() != first
    lines = {r.road_id for r in house.table("silver.osm_roads_clean").read().collect()}
    indexed = {i for r in house.road_index().pages.select("own").collect() for i in r.own}
    assert indexed == lines and len(lines) > 1
