"""Table schemas of the three layers, their keys and their references."""

from __future__ import annotations

POINTS = "array<struct<lon:double,lat:double>>"

# layer.table -> DDL column list
SCHEMAS = {
    # One row per landed accident file; its features live in the table below under the same raw_id,
    # so that no document ever has to fit into one row.
    "bronze.traffic_accidents_raw": "raw_id bigint, source string, load_date timestamp_ntz",
    "bronze.traffic_accident_features": "raw_id bigint, ordinal bigint, payload variant",
    "bronze.meteostat_raw": "raw_id bigint, payload variant, source string, load_date timestamp_ntz",
    # highway repeats one tag as a plain column, so that scans can push the filter down
    "bronze.osm_ways": (
        f"osm_id bigint, highway string, geom {POINTS}, tags map<string,string>, "
        "nodes array<bigint>, ingested_at timestamp_ntz"
    ),
    "silver.traffic_accident_clean": (
        "accident_id bigint, raw_id bigint, lat double, lon double, date timestamp_ntz, cause string, "
        "collision_type string, slightly_injured int, severely_injured int, fatalities int, "
        "total_damage bigint"
    ),
    "silver.weather_clean": (
        "station_id string, date date, time string, temp_c decimal(5,2), "
        "precipitation_mm decimal(6,2), snow int, wind_dir int, wind_speed decimal(5,2)"
    ),
    "silver.osm_roads_clean": (
        "road_id bigint, name string, road_type string, is_intersection boolean, lanes smallint, "
        f"max_speed smallint, oneway boolean, geom {POINTS}"
    ),
    # sums and counts per station and day of the hours that one load added
    "silver.weather_days": (
        "station_id string, date date, temp_sum decimal(15,2), temp_n bigint, rain_sum decimal(16,2), rain_n bigint, "
        "snow_sum bigint, snow_n bigint, direction_sum bigint, direction_n bigint, wind_sum decimal(15,2), wind_n bigint"
    ),
    "gold.dim_city": (
        "city_id bigint, city_name string, region string, lat double, lon double, station_id string"
    ),
    "gold.dim_date": "date_id int, date date, year int, month int, day int, day_of_week int",
    "gold.dim_road": (
        "road_id bigint, road_type string, is_intersection boolean, lanes smallint, "
        "max_speed smallint, oneway boolean"
    ),
    "gold.dim_weather": (
        "weather_id bigint, station_id string, date date, temp_c decimal(5,2), "
        "precipitation_mm decimal(6,2), snow decimal(6,2), wind_dir int, wind_speed decimal(5,2), "
        "weather_category string"
    ),
    "gold.fact_traffic_accidents": (
        "accident_id bigint, city_id bigint, date_id int, road_id bigint, weather_id bigint, "
        "total_damage bigint, main_cause string"
    ),
}

# Partitions as expressions over the key.  An accident id starts with the id of its file.
PARTITIONS = {
    "silver.weather_clean": "date_format(date, 'yyyy-MM')",
    "silver.weather_days": "date_format(date, 'yyyy-MM')",
    "gold.dim_weather": "date_format(date, 'yyyy-MM')",
    "gold.fact_traffic_accidents": "shiftright(accident_id, 36)",
}

# How far a raw table has been absorbed; read by the incremental cleaning step.
PROGRESS = "silver.cleaning_progress"
PROGRESS_SCHEMA = "source_table string, raw_id bigint"

# The last id given out per table.
MARKS = "bronze.high_water"
MARKS_SCHEMA = "source_table string, upto bigint"

# How many road lines the stored index covers; lines are only ever added.
INDEXED_SCHEMA = "lines bigint"

# Rows kept out of silver: the id of the raw row and why.
QUARANTINE_SCHEMA = "raw_id bigint, reasons array<string>"

# Unique keys, one list per constraint.
UNIQUE_KEYS = {
    "bronze.traffic_accidents_raw": [["raw_id"]],
    "bronze.traffic_accident_features": [["raw_id", "ordinal"]],
    "bronze.meteostat_raw": [["raw_id"]],
    "bronze.osm_ways": [["osm_id"]],
    "silver.traffic_accident_clean": [["accident_id"]],
    "silver.weather_clean": [["station_id", "date", "time"]],
    "silver.osm_roads_clean": [["road_id"]],
    "silver.weather_days": [],
    "gold.dim_city": [["city_id"], ["city_name"]],
    "gold.dim_date": [["date_id"]],
    "gold.dim_road": [["road_id"]],
    "gold.dim_weather": [["weather_id"], ["station_id", "date"]],
    "gold.fact_traffic_accidents": [["accident_id"]],
}

# Columns that must be filled, beyond the primary keys above.
REQUIRED = {
    "silver.weather_days": ["station_id", "date"],
    "silver.weather_clean": ["station_id", "date", "time"],
    "gold.dim_weather": ["station_id"],
}

# Fact column -> referenced dimension column.
REFERENCES = {
    "city_id": ("gold.dim_city", "city_id"),
    "date_id": ("gold.dim_date", "date_id"),
    "road_id": ("gold.dim_road", "road_id"),
    "weather_id": ("gold.dim_weather", "weather_id"),
}
