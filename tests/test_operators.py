"""Merge, keys, calendar, checks and tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.operators import keys, merge, quality
from tarmac.plans import fact
from tarmac.session import scratch_path
from tarmac.sources import bronze, calendar
from tarmac.sources.tables import Table, take_ids

SCHEMA = "k string, v string, n int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_insert_only_merge_is_idempotent(spark):
    target = spark.createDataFrame([("k1", "old", 0)], SCHEMA)
    batch = spark.createDataFrame([("k1", "new", 1), ("k2", "b", 3), ("k2", "a", 2)], SCHEMA)
    once = merge.insert_only_merge(batch, target, ["k"], [F.col("n")])
    assert rows(once) == [("k1", "old", 0), ("k2", "a", 2)]
    assert rows(merge.insert_only_merge(batch, once, ["k"], [F.col("n")])) == rows(once)


def test_null_keys(spark):
    target = spark.createDataFrame([(None, "old", 0)], SCHEMA)
    batch = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("k", "c", 3)], SCHEMA)
    unique = merge.insert_only_merge(batch, target, ["k"], [F.col("n")], nullable_keys=True)
    assert rows(unique) == [("k", "c", 3), (None, "a", 1), (None, "b", 2), (None, "old", 0)]
    primary = merge.new_rows(batch, target, ["k"], [F.col("n")])
    assert rows(primary) == [("k", "c", 3)]


def test_dense_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    numbered = keys.dense_ids(df, ["k"], "id", start=5).collect()
    assert sorted((r.id, r.k) for r in numbered) == [(i + 5, i) for i in range(1000)]
    assert keys.dense_ids(df.where("k < 0"), ["k"], "id").count() == 0


def test_counted_ids_are_dense_in_the_order_read(spark):
    numbered, count = keys.counted_ids(spark.range(100, numPartitions=7), "raw_id")
    assert count == 100 and [(r.raw_id, r.id) for r in numbered.orderBy("raw_id").collect()] == [(i + 1, i) for i in range(100)]
    none, count = keys.counted_ids(spark.range(0), "raw_id")
    assert count == 0 and none.isEmpty()


def test_id_ranges_follow_each_other(spark):
    """The first range starts after the ids there are; later ones look no further than the mark."""
    table = Table(spark, scratch_path(spark, "marks"), "silver.t", "raw_id bigint, v string")
    table.append(spark.createDataFrame([(7, "a"), (3, "b")], "raw_id bigint, v string"))
    assert [take_ids(table, "raw_id", n) for n in (5, 0, 1, 100)] == [7, 12, 12, 13]
    table.read = None  # not asked again
    assert take_ids(table, "raw_id", 1) == 113
    other = Table(spark, table.root, "silver.u", "raw_id bigint")
    assert take_ids(other, "raw_id", 2) == 0


def test_latest_and_newest_per_source(spark):
    raw = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "raw_id long, source string")
    assert rows(bronze.latest(raw)) == [(3, "a")]
    assert rows(bronze.newest_per_source(raw)) == [(2, "b"), (3, "a")]
    assert rows(bronze.latest(raw.where("raw_id < 0"))) == []


def test_date_spine(spark):
    spine = calendar.date_spine(spark)
    assert spine.count() == 11_323
    first, sunday, last = (
        spine.where(F.col("date") == F.lit(d).cast("date")).first()
        for d in ("2000-01-01", "2024-01-07", "2030-12-31")
    )
    assert (first.date_id, first.day_of_week) == (1, 6)
    assert sunday.day_of_week == 7
    assert last.date_id == 11_323


def test_fetch_windows(spark):
    stations = spark.createDataFrame([("1",)], "station_id string")
    windows = calendar.fetch_windows(stations, dt.date(2010, 1, 1), dt.date(2010, 3, 15)).orderBy("start")
    assert [(str(r.start)[5:], str(r.end)[5:]) for r in windows.collect()] == [
        ("01-01", "01-31"), ("02-01", "03-03"), ("03-04", "03-15"),
    ]
    whole = calendar.fetch_windows(stations, *calendar.fetch_bounds(dt.date(2025, 5, 1), False), days=None)
    assert [(str(r.start), str(r.end)) for r in whole.collect()] == [("2024-01-01", "2024-12-31")]
    assert calendar.fetch_windows(stations, dt.date(2011, 1, 1), dt.date(2010, 1, 1)).count() == 0


def test_year_files(spark):
    names = [r.stem for r in calendar.year_files(spark, dt.date(2013, 2, 1), True).orderBy("year").collect()]
    assert names == ["nehody_201001-201012", "nehody_201101-201112", "nehody_201201-201212"]
    assert calendar.year_file_paths("/x", dt.date(2013, 2, 1), False) == ["/x/nehody_201201-201212.geojson"]


def test_checks(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", None, 3)], SCHEMA)
    assert rows(quality.pk_violations(df, ["k"])) == [("a", 2)]
    assert rows(quality.not_null_violations(df, ["v"])) == [("b", None, 3)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(quality.fk_violations(df, "k", parent, "id")) == [("b", 1)]
    assert rows(quality.fk_violations(df, "v", parent.where("false"), "id")) == [("x", 1), ("y", 1)]
    stored = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("c", "z", 9)], SCHEMA)
    assert rows(quality.delta_pk_violations(df, stored, ["k"])) == [("a", 4)]
    assert rows(quality.delta_pk_violations(df.where("k = 'b'"), stored, ["k"])) == []
    assert rows(quality.delta_pk_violations(df.where("false"), stored, ["k"])) == []
    with pytest.raises(quality.ConstraintError):
        quality.require_empty(df, "anything")


def test_table_versions(spark):
    table = Table(spark, scratch_path(spark, "versions"), "silver.t", SCHEMA)
    assert not table.exists() and table.read().count() == 0
    table.replace(spark.createDataFrame([("a", "1", 1)], SCHEMA))
    table.append(spark.createDataFrame([("b", "2", 2)], SCHEMA))
    table.replace(table.read().withColumn("n", F.col("n") * 10))  # reads the version it replaces
    assert rows(table.read()) == [("a", "1", 10), ("b", "2", 20)]
    broken = table.read().select("k", "v", F.raise_error(F.lit("no")).cast("int").alias("n"))
    with pytest.raises(Exception):
        table.replace(broken)
    assert rows(table.read()) == [("a", "1", 10), ("b", "2", 20)]
    table.replace(table.read())
    table.drop_old_versions(keep=1)
    assert len(table._versions()) == 1 and table.read().count() == 2


def test_a_failed_append_is_not_seen(spark):
    table = Table(spark, scratch_path(spark, "appends"), "silver.t", SCHEMA)
    table.append(spark.createDataFrame([("a", "1", 1)], SCHEMA))
    many = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"), F.col("id").cast("int").alias("n"))
    broken = many.repartition(4).withColumn("n", F.when(F.col("n") == 77, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception):
        table.append(broken)
    assert rows(table.read()) == [("a", "1", 1)]
    table.append(many)
    assert table.read().count() == 101


def test_a_repeated_batch_takes_the_place_of_the_first(spark):
    table = Table(spark, scratch_path(spark, "repeats"), "silver.t", SCHEMA)
    table.append(spark.createDataFrame([("a", "1", 1)], SCHEMA), "load-1")
    table.append(spark.createDataFrame([("b", "1", 1)], SCHEMA))
    table.append(spark.createDataFrame([("a", "1", 5), ("c", "2", 2)], SCHEMA), "load-1")
    assert rows(table.read()) == [("a", "1", 5), ("b", "1", 1), ("c", "2", 2)]
    assert rows(table.read(but="load-1")) == [("b", "1", 1)]
    assert rows(table.read(batches=["load-1"])) == [("a", "1", 5), ("c", "2", 2)]


def test_a_merge_reads_only_the_partitions_of_its_batch(spark):
    table = Table(spark, scratch_path(spark, "parts"), "silver.t", SCHEMA, part="substr(k, 1, 1)")
    stored = [(f"{first}{i}", "old", i) for first in "abcdefgh" for i in range(5)]
    table.merge(spark.createDataFrame(stored, SCHEMA), ["k"], [F.col("n")])
    late = spark.createDataFrame([("b1", "late", 1), ("b9", "late", 2), ("b9", "later", 3), (None, "x", 4), ("z1", "late", 5)], SCHEMA)
    added = table.new_rows(late, ["k"], [F.col("n")])
    text = added._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters"):].split("]")[0]
    assert "part" in filters and " IN " in filters and "(b,z)" in filters.replace(" ", "").replace("z,b", "b,z")
    assert rows(added) == [("b9", "late", 2), ("z1", "late", 5)]
    table.append(added)
    assert table.read().count() == 42 and table.read(["b"]).count() == 6
    table.replace(table.read())
    assert table.read().count() == 42 and table.batches() == ["0"]


def test_a_hot_station_day_is_dealt_to_many_tasks(spark):
    """Without adaptive execution, no task of the join gets more than twice the rows of the median task."""
    n = 20_000
    rows = spark.range(n).selectExpr(
        "id AS accident_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 997) END AS station_id",
        "CASE WHEN id % 3 = 0 THEN DATE '2024-01-01' ELSE date_add(DATE '2024-01-01', CAST(id % 300 AS INT)) END AS date",
    )
    weather = rows.where("station_id IS NOT NULL").select("station_id", "date").distinct()
    weather = weather.withColumn("weather_id", F.xxhash64("station_id", "date"))
    settings = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = fact.with_weather_id(rows, weather, "accident_id")
        assert joined.where("NOT weather_id <=> xxhash64(station_id, date) AND station_id IS NOT NULL").isEmpty()
        assert joined.count() == n and joined.where("station_id IS NULL AND weather_id IS NULL").count() > 0
        sizes = sorted(r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
