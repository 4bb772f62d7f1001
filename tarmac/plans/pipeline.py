"""The whole load as plain calls: ingest, clean, dimensions, fact.

Each step reads written tables and publishes one table, so a failed run is repeated from the step that
failed, and a repeated run changes nothing.  ``as_of`` and ``backfill`` are arguments, never the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.operators.keys import counted_ids, dense_ids, max_id
from tarmac.operators.merge import unseen_sources
from tarmac.operators.nearest import PAGES_SCHEMA, NearestIndex
from tarmac.operators.quality import (
    fk_violations,
    not_null_violations,
    pk_violations,
    require_empty,
)
from tarmac.plans import clean, dims
from tarmac.plans.fact import assemble_fact, city_index, road_index
from tarmac.schemas import (
    INDEXED_SCHEMA,
    PROGRESS,
    PROGRESS_SCHEMA,
    QUARANTINE_SCHEMA,
    REFERENCES,
    REQUIRED,
    SCHEMAS,
    UNIQUE_KEYS,
)
from tarmac.session import cut_lineage
from tarmac.sources import geojson, landed
from tarmac.sources.calendar import date_spine, year_file_paths
from tarmac.sources.tables import Table, take_ids


def _without_scheme(path: Column) -> Column:
    """Scans write the scheme and the slashes after it in different ways."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, name: str) -> Table:
        return Table(self.spark, self.root, name)

    def _noted(self, name: str, nothing: int) -> int:
        """How far table ``name`` was absorbed by the step after it."""
        known = Table(self.spark, self.root, PROGRESS, PROGRESS_SCHEMA).read().where(F.col("source_table") == name)
        row = known.agg(F.max("raw_id")).first()
        return nothing if row[0] is None else row[0]

    def _note(self, name: str, upto: int) -> None:
        progress = Table(self.spark, self.root, PROGRESS, PROGRESS_SCHEMA)
        others = progress.read().where(F.col("source_table") != name)
        progress.replace(others.unionByName(self.spark.createDataFrame([(name, upto)], PROGRESS_SCHEMA)))

    def quarantined(self, what: str) -> Table:
        """Ids of raw rows kept out of silver (``weather`` hours, ``roads``) and the reasons."""
        return Table(self.spark, self.root, f"silver.{what}_quarantine", QUARANTINE_SCHEMA)

    # ------------------------------------------------------------------------------- ingest

    def ingest_accidents(self, paths: list[str], allow_reload: bool = False) -> None:
        """Land accident files: one row per file, one row per feature, each file read by as many tasks as it has blocks.

        A file's stem is its identity: a known one is left out, and two files of one call must not share it.
        """
        files, features = (
            self.table("bronze.traffic_accidents_raw"),
            self.table("bronze.traffic_accident_features"),
        )
        listed = self.spark.read.format("binaryFile").load(paths).select(
            F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "").alias("source"),
            "path",
        )
        known = files.read()
        fresh = listed if allow_reload else unseen_sources(listed, known)
        # a load that stopped halfway leaves features without a file row; its ids are not given again
        last = max(max_id(known, "raw_id"), max_id(features.read(), "raw_id"))
        require_empty(pk_violations(fresh, ["source"]), "several files of one name")
        loads = cut_lineage(dense_ids(fresh, ["source"], "raw_id", start=last + 1))
        todo = [row.path for row in loads.select("path").toLocalIterator()]  # names only
        if not todo:
            return
        found = geojson.split_features(self.spark, todo)
        # features first: without its file row, no feature is ever read
        ids = loads.select("raw_id", _without_scheme(F.col("path")).alias("file"))
        # one row per file: broadcast while they are few, so that features stay where they were read
        small = F.broadcast(ids) if len(todo) <= clean.FEW_LOADS else ids
        decoded = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))  # scans report escaped paths
        placed = found.withColumn("file", _without_scheme(decoded)).join(small, "file", "left")
        unknown = F.raise_error(F.concat(F.lit("feature of an unknown file: "), "file")).cast("bigint")
        features.append(placed.select(F.coalesce("raw_id", unknown).alias("raw_id"), "ordinal", "payload"))
        files.append(loads.select("raw_id", "source").withColumn("load_date", F.current_timestamp().cast("timestamp_ntz")))

    def ingest_accident_years(self, folder: str, as_of: dt.date, backfill: bool = False) -> None:
        self.ingest_accidents(year_file_paths(folder, as_of, backfill))

    def ingest_weather(self, path: str) -> None:
        """Append landed hourly responses; a repeated file adds rows that the silver key ignores."""
        raw = self.table("bronze.meteostat_raw")
        hours = landed.weather_responses(self.spark, path)
        numbered, count = counted_ids(hours, "raw_id")
        numbered = numbered.withColumn("raw_id", F.col("raw_id") + take_ids(raw, "raw_id", count))
        raw.append(numbered.withColumn("load_date", F.current_timestamp().cast("timestamp_ntz")))

    def ingest_roads(self, extract: DataFrame) -> None:
        """Replace the road lines; a repeated id leaves the old ones in place."""
        ways = landed.road_lines(extract).withColumn("nodes", F.lit(None).cast("array<bigint>"))
        require_empty(pk_violations(ways, ["osm_id"]), "bronze.osm_ways repeats osm_id")
        self.table("bronze.osm_ways").replace(
            ways.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
        )

    # -------------------------------------------------------------------------------- clean

    def clean_accidents(self, backfill: bool = False) -> None:
        """Full refresh; with nothing to write the old content stays."""
        files = self.table("bronze.traffic_accidents_raw").read()
        features = self.table("bronze.traffic_accident_features").read()
        rows = clean.clean_accidents(files, features, backfill)
        if not rows.isEmpty():
            self.table("silver.traffic_accident_clean").replace(rows)

    def clean_weather(self, everything: bool = False) -> DataFrame:
        """Insert-only load; returns the rows quarantined now, which ``silver.weather_quarantine`` keeps.

        Rows up to the id absorbed before cannot add anything, since earlier ids win, so only later ones
        are read, and only the months they fall into of the hours before.  The sums per day of the added hours are stored
        beside them.  All that one load writes carries the id it started after: a load that failed half way is
        repeated in the place of its first attempt.
        """
        name = "bronze.meteostat_raw"
        raw = self.table(name).read()
        after, upto = (0 if everything else self._noted(name, 0)), max_id(raw, "raw_id")
        good, bad = clean.clean_weather(
            raw.where((F.col("raw_id") > after) & (F.col("raw_id") <= upto))
        )
        if upto > after:
            hours = self.table("silver.weather_clean")
            keys = ["station_id", "date", "time"]
            added = cut_lineage(hours.new_rows(good, keys, [F.col("raw_id")], replacing=str(after)))
            self.table("silver.weather_days").append(dims.weather_sums(added), after)
            hours.append(added, after)
            kept = bad.select("raw_id", "reasons")
            self.quarantined("weather").merge(kept, ["raw_id"], [F.col("reasons")], batch_id=after)
            if everything:
                self._note("silver.weather_days", -1)
            self._note(name, upto)
        return bad

    def road_index(self) -> NearestIndex:
        """Index of the silver road lines as ``index_roads`` stored it."""
        return NearestIndex(self._road_pages().read())

    def _road_pages(self) -> Table:
        return Table(self.spark, self.root, "silver.osm_roads_index", PAGES_SCHEMA)

    def index_roads(self) -> None:
        """Store the index of the road lines anew."""
        self._road_pages().replace(road_index(self.table("silver.osm_roads_clean").read()).pages)

    def clean_roads(self) -> DataFrame:
        """Insert-only load; returns the quarantined rows, which ``silver.roads_quarantine`` keeps.

        The index stored beside the lines is made anew when lines were added, or an earlier run ended before that.
        """
        good, bad = clean.clean_roads(self.table("bronze.osm_ways").read())
        order = [F.col(c) for c in ("road_type", "name", "max_speed", "lanes")]
        lines = self.table("silver.osm_roads_clean")
        lines.merge(good, ["road_id"], order)
        self.quarantined("roads").replace(bad.select(F.col("road_id").alias("raw_id"), "reasons"))
        indexed = Table(self.spark, self.root, "silver.osm_roads_indexed", INDEXED_SCHEMA)
        count = lines.read().count()
        if not self._road_pages().exists() or indexed.read().agg(F.max("lines")).first()[0] != count:
            self.index_roads()
            indexed.replace(self.spark.createDataFrame([(count,)], INDEXED_SCHEMA))
        return bad

    # --------------------------------------------------------------------------- dimensions

    def _add_numbered(
        self, name: str, batch: DataFrame, keys: list[str], order: list[str], id_column: str, **options
    ) -> None:
        """Insert-only merge on the natural key, with new surrogate ids for the new rows only."""
        target = self.table(name)
        added = target.new_rows(batch, keys, [F.col(c) for c in order], **options)
        # the further columns tell rows without a natural key apart
        by = list(dict.fromkeys(keys + order))
        target.append(dense_ids(added, by, id_column, start=max_id(target.read(), id_column) + 1))

    def load_city_dim(self, path: str) -> None:
        rows = dims.city_rows(landed.cities(self.spark, path))
        order = ["region", "lat", "lon", "station_id"]
        self._add_numbered("gold.dim_city", rows, ["city_name"], order, "city_id", nullable_keys=True)

    def load_date_dim(self) -> None:
        self.table("gold.dim_date").replace(date_spine(self.spark))

    def load_road_dim(self) -> None:
        rows = dims.road_rows(self.table("silver.osm_roads_clean").read())
        self.table("gold.dim_road").merge(rows, ["road_id"], [F.col("road_type")])

    def load_weather_dim(self) -> None:
        """Days that loads since the last build touched, from the sums that all loads stored for them; no hours are read."""
        days = self.table("silver.weather_days")
        done = self._noted(days.name, -1)
        fresh = [b for b in days.batches() if int(b) > done]
        if not fresh:
            return
        touched = cut_lineage(days.read(batches=fresh).select("station_id", "date").distinct())
        sums = days.read(days.parts_of(touched)).join(touched, ["station_id", "date"], "left_semi")
        keys = ["station_id", "date"]
        self._add_numbered("gold.dim_weather", dims.weather_of_days(dims.merged_sums(sums)), keys, keys, "weather_id")
        self._note(days.name, max(map(int, fresh)))

    # --------------------------------------------------------------------------------- fact

    def load_fact(self) -> None:
        """Accidents not yet in the fact are placed and joined, checked, and only then published."""
        fact = self.table("gold.fact_traffic_accidents")
        silver = self.table("silver.traffic_accident_clean").read()
        placed = silver.select("accident_id", "raw_id", "lon", "lat", "date", "total_damage", "cause")
        added = fact.new_rows(placed, ["accident_id"], [F.col("raw_id").desc()])
        accidents = cut_lineage(added.drop("raw_id"))  # read several times
        if accidents.isEmpty():
            return
        rows = cut_lineage(
            assemble_fact(
                accidents,
                city_index(self.table("gold.dim_city").read()),
                self.table("gold.dim_date").read(),
                self.road_index(),
                self.table("gold.dim_weather").read(),
            )
        )
        self.check_references(rows)
        fact.append(rows)

    def unplaced_accidents(self) -> DataFrame:
        """Accidents whose city and road are only stand-ins, for want of coordinates."""
        return not_null_violations(self.table("silver.traffic_accident_clean").read(), ["lat", "lon"])

    def check_references(self, rows: DataFrame) -> None:
        """Raise when fact rows refer to a dimension row that is not there, or repeat an accident."""
        require_empty(pk_violations(rows, ["accident_id"]), "fact repeats accident_id")
        for column, (parent, key) in REFERENCES.items():
            missing = fk_violations(rows, column, self.table(parent).read(), key)
            require_empty(missing, f"fact.{column} is not in {parent}")

    def check(self) -> None:
        """Raise on the first broken constraint of any table; reads all of them, so no load calls it."""
        for name in SCHEMAS:
            df = self.table(name).read()
            for keys in UNIQUE_KEYS[name]:
                keyed = df.dropna(subset=keys)
                require_empty(pk_violations(keyed, keys), f"{name} repeats {keys}")
            required = REQUIRED.get(name, []) + [c for keys in UNIQUE_KEYS[name][:1] for c in keys]
            require_empty(not_null_violations(df, required), f"{name} has NULL in {required}")
        self.check_references(self.table("gold.fact_traffic_accidents").read())

    def build(self, cities_path: str, backfill: bool = False) -> None:
        """Everything after the ingest."""
        self.clean_accidents(backfill)
        self.clean_weather()
        self.clean_roads()
        self.load_city_dim(cities_path)
        self.load_date_dim()
        self.load_road_dim()
        self.load_weather_dim()
        self.load_fact()
