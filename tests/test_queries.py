"""Every registered query next to its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as registered
from tarmac.workload import fields, ingest, star
from tests.oracle import compare, database

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF)


LIBRARY = {**ingest.QUERIES, **fields.QUERIES, **star.QUERIES}


def test_every_query_has_sql():
    assert set(LIBRARY) <= set(registered.queries()) and set(LIBRARY) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SF, name) == ""


def plan(spark, name):
    df = registered.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["left_join_weather", "weather_clean", "geojson_scan", "dim_road_project", "insert_only_merge"])
def test_no_python_and_no_product(spark, name):
    text = plan(spark, name)
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert word not in text


def test_newest_row_is_pushed_into_the_scan(spark):
    text = plan(spark, "latest_snapshot")
    assert "EqualTo(event_id,ScalarSubquery" in text and "Exchange" not in text.split("Subquery")[0]


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    text = plan(spark, "first_writer_dedupe")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_merge_shuffles_each_side_once(spark):
    """De-duplication and anti join share one partitioning."""
    text = plan(spark, "insert_only_merge")
    anti = text[text.index("LeftAnti"):]
    assert anti.count("Exchange hashpartitioning") == 2


def test_small_index_moves_no_points(spark):
    text = plan(spark, "nearest_segment")
    assert "ArrowEvalPython" in text and "Exchange" not in text


def test_date_join_moves_no_rows(spark):
    text = plan(spark, "left_join_date")
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
