"""Nearest joins against brute force."""

import numpy as np
import pandas as pd
import pytest

from tarmac.operators.nearest import PAGES_SCHEMA, NearestIndex, PackedTree, build_index, line_shapes, nearest_join, point_shapes

RNG = np.random.default_rng(7)


def brute(points, segs):
    found = []
    ax, ay, bx, by = segs.T
    dx, dy = bx - ax, by - ay
    squared = dx * dx + dy * dy
    for x, y in points:
        with np.errstate(all="ignore"):
            t = np.where(squared > 0, np.clip(((x - ax) * dx + (y - ay) * dy) / squared, 0, 1), 0)
        ex, ey = x - (ax + t * dx), y - (ay + t * dy)
        d = np.sqrt(ex * ex + ey * ey)
        found.append((int(np.argmin(d)), float(d.min())))
    return found


def short_segments(n, spread=10.0, length=0.1):
    start = RNG.random((n, 2)) * spread
    return np.hstack([start, start + RNG.normal(0, length, (n, 2))])


def cases():
    points = RNG.random((1500, 2)) * 10
    plain = short_segments(1200)
    yield "uniform", points, plain
    # a third of all points and shapes in one tiny spot, and points far outside
    hot_points, hot = points.copy(), plain.copy()
    hot_points[:500] = 5 + RNG.normal(0, 1e-4, (500, 2))
    hot_points[-3:] = [[1000, 1000], [-50, 3], [0, 0]]
    hot[:400, :2] = 5 + RNG.normal(0, 1e-4, (400, 2))
    hot[:400, 2:] = hot[:400, :2] + RNG.normal(0, 1e-5, (400, 2))
    yield "hot spot", hot_points, hot
    yield "long segments", points, RNG.random((300, 4)) * 10
    # segments that share ends, repeat each other, or have no length: many exact ties
    grid = np.array([[x, y, x + 1, y] for x in range(12) for y in range(12)], dtype=float)
    ends = np.hstack([grid[:, :2], grid[:, :2]])
    yield "ties", np.floor(points), np.vstack([grid, grid, ends])
    angle = RNG.random(200) * 6.28
    zero = 0 * angle
    yield "star", points, np.stack([5 + zero, 5 + zero, 5 + 5 * np.cos(angle), 5 + 5 * np.sin(angle)], 1)
    yield "bundle", points[:300], np.tile([0, 5, 10, 5.0], (600, 1)) + RNG.normal(0, 1e-7, (600, 4))


@pytest.mark.parametrize("name,points,segs", list(cases()), ids=lambda v: v if isinstance(v, str) else "")
@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0, "places_per_task": 100}])
def test_index_equals_brute_force(spark, name, points, segs, options):
    pts, shapes = frames(spark, points, segs)
    index = build_index(shapes, page_shapes=64 if options else 4096)
    found = index.join(pts, "x", "y", {"road": "id", "d": "distance"}, **options).toPandas().sort_values("p")
    want = brute(points, segs)
    assert len(found) == len(points)
    assert list(found.road) == [w[0] for w in want]
    assert np.allclose(found.d, [w[1] for w in want], rtol=0, atol=1e-12)


PLACES = [(0.1, 0.1), (5.0, 5.0), (None, 1.0), (None, None), (float("nan"), 2.0)]


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}])
def test_places_without_coordinates_get_the_smallest_id(spark, options):
    accidents = spark.createDataFrame([(i, *p) for i, p in enumerate(PLACES)], "p int, x double, y double")
    cities = spark.createDataFrame(
        [(7, 0.0, 0.0, "s7"), (9, 5.0, 5.1, "s9"), (3, 80.0, 80.0, None)], "id int, x double, y double, st string"
    )
    shapes = point_shapes(cities, "id", "x", "y", "st")
    found = nearest_join(accidents, "x", "y", shapes, {"city": "id", "st": "st"}, **options)
    assert {r.p: (r.city, r.st) for r in found.collect()} == {
        0: (7, "s7"), 1: (9, "s9"), 2: (3, None), 3: (3, None), 4: (3, None),
    }


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": -1}])
def test_no_shapes_no_rows(spark, options):
    accidents = spark.createDataFrame([(1, 0.0, 0.0)], "p int, x double, y double")
    none = spark.createDataFrame([], "id int, ax double, ay double, bx double, by double")
    assert nearest_join(accidents, "x", "y", none, {"road": "id"}, **options).count() == 0


def test_distance_is_to_the_segment_not_its_vertices(spark):
    lines = spark.createDataFrame(
        [(1, [(0.0, 0.0), (10.0, 0.0)]), (2, [(5.0, 3.0), (5.0, 4.0)]), (3, [(5.0, 1.0)])],
        "road_id int, geom array<struct<lon:double,lat:double>>",
    )
    accidents = spark.createDataFrame([(1, 5.0, 1.0)], "p int, x double, y double")
    found = nearest_join(accidents, "x", "y", line_shapes(lines, "road_id", "geom"), {"r": "id", "d": "distance"})
    assert tuple(found.first())[-2:] == (1, 1.0)


def frames(spark, points, segs):
    pts = spark.createDataFrame(pd.DataFrame({"p": range(len(points)), "x": points[:, 0], "y": points[:, 1]}))
    frame = pd.DataFrame(segs, columns=["ax", "ay", "bx", "by"])
    frame.insert(0, "id", range(len(segs)))
    return pts, spark.createDataFrame(frame)


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}])
def test_a_stored_index_answers_any_position(spark, tmp_path, options):
    """Written, read back and asked for places far outside it, without being built again."""
    points, segs = RNG.random((300, 2)) * 10, short_segments(900)
    points[-2:] = [[400.0, -90.0], [-30.0, 5.0]]
    pts, shapes = frames(spark, points, segs)
    build_index(shapes, page_shapes=50).pages.write.parquet(str(tmp_path / "index"))
    index = NearestIndex(spark.read.schema(PAGES_SCHEMA).parquet(str(tmp_path / "index")))
    want = brute(points, segs)
    for part in (pts, pts.where("p >= 298")):
        found = index.join(part, "x", "y", {"road": "id"}, **options).toPandas().sort_values("p")
        assert list(found.road) == [want[p][0] for p in found.p] and len(found) == part.count()


def test_jobs_do_not_depend_on_the_data(spark):
    """Building and asking take the same number of jobs for few and many, spread and bundled shapes."""
    jobs = []
    for n, spread in ((200, 10.0), (5000, 10.0), (5000, 1e-6)):
        points, segs = RNG.random((2000, 2)) * 10, short_segments(n, spread)
        pts, shapes = frames(spark, points, segs)
        group = f"nearest {n} {spread}"
        spark.sparkContext.setJobGroup(group, group)
        build_index(shapes, page_shapes=64).join(pts, "x", "y", {"road": "id"}, broadcast_limit=0).write.format("noop").mode("overwrite").save()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("", "")
    assert max(jobs) <= min(jobs) + 2  # a small exchange may be folded into its neighbour


def test_few_shapes_are_visited(spark, monkeypatch):
    """Of 20,000 shapes, some long, a place meets a few dozen."""
    met = []
    plain = PackedTree.distance
    monkeypatch.setattr(PackedTree, "distance", lambda self, x, y, shape: met.append(len(shape)) or plain(self, x, y, shape))
    segs = np.vstack([short_segments(19_900, length=0.02), short_segments(100, length=3.0)])
    _, shapes = frames(spark, np.zeros((1, 2)), segs)
    stored = build_index(shapes).pages.orderBy("page").toPandas()
    tree = PackedTree(*(np.concatenate(stored[c].to_list()) for c in ("ax", "ay", "bx", "by", "t0", "t1", "own")))
    points = RNG.random((500, 2)) * 10
    tree.nearest(*points.T)
    assert sum(met) / len(points) < 60


def test_repeated_shapes_and_ids(spark):
    """Equal shapes go to the smallest id; an id with several values hands over the smallest; no id, no part."""
    shapes = spark.createDataFrame(
        [(5, 0.0, 0.0, "b"), (4, 0.0, 0.0, "z"), (4, 9.0, 9.0, "a"), (None, 1.0, 1.0, "n"), (8, float("nan"), 0.0, "q")],
        "id int, x double, y double, tag string",
    )
    points = spark.createDataFrame([(1, 0.0, 0.1), (2, 1.0, 1.0), (3, 8.0, 8.0)], "p int, x double, y double")
    for options in ({}, {"broadcast_limit": 0}):
        found = nearest_join(points, "x", "y", point_shapes(shapes, "id", "x", "y", "tag"), {"i": "id", "tag": "tag"}, **options)
        assert {r.p: (r.i, r.tag) for r in found.collect()} == {1: (4, "a"), 2: (4, "a"), 3: (4, "a")}


def test_a_place_searches_few_groups_among_many_shapes():
    """Twenty times the shapes on the same ground: the groups of pieces that a place searches stay about as many."""
    met = []

    class Counted(PackedTree):
        def distance(self, x, y, group):
            met[-1] += len(group)
            return super().distance(x, y, group)

    points = np.vstack([RNG.random((490, 2)) * 10, RNG.random((10, 2)) * 10 + [30, 0]])
    for n in (2_000, 40_000):
        segs = short_segments(n, length=0.3)
        middle = np.floor((segs[:, :2] + segs[:, 2:]) * 25).astype(int)
        segs = segs[np.lexsort((segs[:, 0], middle[:, 1], middle[:, 0] // 10))]
        met.append(0)
        distance, own = Counted(*segs.T, np.zeros(n), np.ones(n), np.arange(n)).nearest(*points.T)
        want = brute(points[-50:], segs)
        assert list(zip(own[-50:], distance[-50:])) == want
    assert met[0] / len(points) < 40 and met[1] < 3 * met[0]


def test_a_small_file_is_searched_by_all_cores(spark, tmp_path):
    """One compressed file is one task; the places and lines made of it are dealt to every core."""
    from tarmac.workload import common

    spark.range(20_000).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' AS ts", "'view' AS event_type", "CAST(id AS double) AS value", "'{\"k\": 1}' AS props"
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(20_000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "1 AS p_size").coalesce(1).write.parquet(
        f"{tmp_path}/part.parquet"
    )
    for rows in (common.accident_points, common.way_extract, common.weather_raw):
        made = rows(spark, str(tmp_path))
        assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and made.count() == 20_000
