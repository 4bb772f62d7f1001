"""Exact nearest-neighbour joins (k = 1) in planar degrees, over a stored index of the shapes.

Shapes are segments; a point is a segment of zero length.  Ties go to the smallest id, and a place without usable
coordinates gets the smallest id of all.

The index follows the shapes alone: long segments are cut into pieces, the pieces are sorted by size and along a space-filling
curve, and every ``page_shapes`` neighbours make a page, one row with its bounding box and a few places on its shapes.
A page is a packed tree: groups of ``FAN`` neighbours have a box, groups of those again, up to one.  Places descend it, first
into a few near boxes of each level, then into every box that is not farther than the shape found there, the nearest first; no
shape outside those boxes can be nearer.

While the shapes are few (counted), the whole tree is broadcast and places are answered where they are.  Beyond that only
the boxes of the pages are, a bounded number: a place learns from them which pages may hold its nearest shape and
meets these by a shuffle, in which pages with many places are dealt to several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.functions.geometry import point_distance, segments
from tarmac.operators.keys import dense_ids
from tarmac.session import cut_lineage, wide

FAN = 16  # neighbours under one box
BEAM = 4  # boxes of each level that a place looks into for its first distance
FIRST_LOOK = 4  # boxes not farther than that which it searches before the others are left out again
PAGE_SHAPES = 4096
MAX_PAGES = 100_000  # whose boxes, some 170 bytes each, are sent to every task; larger indexes have larger pages
BROADCAST_SHAPES = 500_000  # pieces, 56 bytes each, sent to every task at most
PIECES_PER_SHAPE = 0.5  # that cutting long segments may add on average
LEAST_PIECES = 20_000  # that it may add in any case
SAMPLES = 8  # places on the shapes of a page that the directory holds at least
MOST_SAMPLES = 64  # and at most, while its pages are few
PLACES_PER_TASK = 50_000
SLACK = 1e-9  # relative room for rounding when boxes are left out; visiting more does no harm

_ENDS = ["ax", "ay", "bx", "by"]
_SHAPE = [*_ENDS, "t0", "t1", "own"]
_CHUNK = 4096  # places that descend together
_PAIRS = 1 << 18  # pairs of places and boxes held at once
_CURVE_BITS = 24
#: Stored form: the pages of an index, and the columns that its shapes hand over by id.
PAGES_SCHEMA = (
    "page bigint, n bigint, least bigint, x0 double, y0 double, x1 double, y1 double, rx array<double>, ry array<double>, "
    "ax array<double>, ay array<double>, bx array<double>, by array<double>, t0 array<double>, t1 array<double>, own array<bigint>"
)


def line_shapes(lines: DataFrame, id_column: str, geom: str) -> DataFrame:
    """Segments of polylines as shapes."""
    return lines.select(
        F.col(id_column).alias("id"), F.explode(segments(F.col(geom))).alias("s")
    ).select("id", "s.*")


def point_shapes(points: DataFrame, id_column: str, x: str, y: str, *carry: str) -> DataFrame:
    """Points as shapes, with columns to hand over to the match."""
    return points.select(
        F.col(id_column).alias("id"),
        F.col(x).alias("ax"),
        F.col(y).alias("ay"),
        F.col(x).alias("bx"),
        F.col(y).alias("by"),
        *carry,
    )


def _usable(x: str, y: str) -> Column:
    """Both coordinates present and finite; NaN sorts above infinity, so it fails too."""
    limit = F.lit(float("inf"))
    return F.coalesce((F.abs(F.col(x)) < limit) & (F.abs(F.col(y)) < limit), F.lit(False))


# ---------------------------------------------------------------------------------------- tree


class BoxTree:
    """Boxes in the order given; every ``FAN`` neighbours have a box around them, and every ``FAN`` of those again.

    A level is an array of groups by side by member, so that the boxes of a group are read together.
    """

    def __init__(self, low_x, low_y, high_x, high_y) -> None:
        self.reach = float(max(np.abs(side).max() for side in (low_x, low_y, high_x, high_y)))
        self.levels = [_grouped(_padded(low_x, low_y, high_x, high_y))]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            around = below[:, 0].min(1), below[:, 1].min(1), below[:, 2].max(1), below[:, 3].max(1)
            self.levels.append(_grouped(_padded(*around)))

    def _reaches(self, level: int, x: np.ndarray, y: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences of places and the near and far sides of the boxes in their groups, along both axes."""
        sides = self.levels[level][group]
        x, y = x[:, None], y[:, None]
        return (sides[:, 0] - x, x - sides[:, 2]), (sides[:, 1] - y, y - sides[:, 3])

    def _gaps(self, level: int, x: np.ndarray, y: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Squared distances of places to the boxes in their groups."""
        along_x, along_y = self._reaches(level, x, y, group)
        gx, gy = np.maximum(np.maximum(*along_x), 0.0), np.maximum(np.maximum(*along_y), 0.0)
        return gx * gx + gy * gy

    def bound(self, x: np.ndarray, y: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Squared ``distance`` with room for rounding: boxes with a greater gap are farther."""
        return (distance * (1 + SLACK) + 1e-12 * (self.reach + np.abs(x) + np.abs(y))) ** 2

    def within(self, x: np.ndarray, y: np.ndarray, distance: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places and boxes not farther from them than ``distance`` and their gaps, in lots; places ascend, each in one lot."""
        bound = self.bound(x, y, distance)

        def descend(low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            place, group = np.arange(low, high), np.zeros(high - low, dtype=np.int64)
            for level in reversed(range(len(self.levels))):
                gaps = self._gaps(level, x[place], y[place], group)
                row, member = np.nonzero(gaps <= bound[place, None])
                place, group = place[row], group[row] * FAN + member
                if not level:
                    yield place, group, gaps[row, member]
                elif len(place) * FAN > _PAIRS and high - low > 1:  # places amid many near boxes go in smaller lots
                    yield from descend(low, (low + high) // 2)
                    yield from descend((low + high) // 2, high)
                    return

        for low in range(0, len(x), _CHUNK):
            yield from descend(low, min(low + _CHUNK, len(x)))

    def beside(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (ascending) and some of the boxes about them: at each level the ``BEAM`` best ones."""
        place, group = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        for level in reversed(range(len(self.levels))):
            (west, east), (south, north) = self._reaches(level, x[place], y[place], group)
            gx, gy = np.maximum(np.maximum(west, east), 0.0), np.maximum(np.maximum(south, north), 0.0)
            # the nearest boxes, and among those around a place the smallest about it
            corners = west * west + east * east + south * south + north * north
            badness = (gx * gx + gy * gy + 0.01 * corners).reshape(len(x), -1)
            best = np.argpartition(badness, BEAM - 1, axis=1)[:, :BEAM]
            row = np.arange(len(x))[:, None]
            # boxes that only fill up a group are infinitely far
            best = np.where(np.isfinite(badness[row, best]), best, badness.argmin(axis=1)[:, None])
            group = (group.reshape(len(x), -1)[row, best // FAN] * FAN + best % FAN).ravel()
            place = np.repeat(np.arange(len(x)), BEAM)
        return place, group


class PackedTree:
    """Pieces of segments in the order given, in a tree of boxes around every ``FAN`` of them."""

    def __init__(self, ax, ay, bx, by, t0, t1, own) -> None:
        dx, dy = bx - ax, by - ay
        px, py, qx, qy = ax + t0 * dx, ay + t0 * dy, ax + t1 * dx, ay + t1 * dy
        low_x, low_y, high_x, high_y = np.minimum(px, qx), np.minimum(py, qy), np.maximum(px, qx), np.maximum(py, qy)
        sides = _grouped(_padded(low_x, low_y, high_x, high_y))
        self.boxes = BoxTree(sides[:, 0].min(1), sides[:, 1].min(1), sides[:, 2].max(1), sides[:, 3].max(1))
        # the last piece fills up its group
        repeated = np.minimum(np.arange(len(sides) * FAN), len(own) - 1)
        self.shapes = _grouped([column[repeated] for column in (ax, ay, dx, dy, dx * dx + dy * dy)])
        self.own = own[repeated].reshape(-1, FAN)

    def distance(self, x: np.ndarray, y: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Distances of each place to the ``FAN`` shapes of its group."""
        ax, ay, dx, dy, squared = np.moveaxis(self.shapes[group], 1, 0)
        x, y = x[:, None], y[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            along = ((x - ax) * dx + (y - ay) * dy) / squared
        t = np.where(squared > 0, np.minimum(np.maximum(along, 0.0), 1.0), 0.0)
        ex, ey = x - (ax + t * dx), y - (ay + t * dy)
        return np.sqrt(ex * ex + ey * ey)

    def _best(self, x, y, place: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places (ascending in the pairs given) with distance and id of the nearest shape in their groups."""
        reached = self.distance(x[place], y[place], group)
        starts = np.flatnonzero(np.diff(place, prepend=-1))
        best = np.minimum.reduceat(reached.min(axis=1), starts)
        of_best = reached == np.repeat(best, np.diff(starts, append=len(place)))[:, None]
        owner = np.where(of_best, self.own[group], np.iinfo(np.int64).max).min(axis=1)
        return place[starts], best, np.minimum.reduceat(owner, starts)

    def nearest(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance and id of the nearest shape of each place; the smallest id among equals."""
        found = [self._nearest(x[i : i + _CHUNK], y[i : i + _CHUNK]) for i in range(0, len(x), _CHUNK)]
        found.append((np.empty(0), np.empty(0, dtype=np.int64)))
        return np.concatenate([d for d, _ in found]), np.concatenate([own for _, own in found])

    def _nearest(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place, group = self.boxes.beside(x, y)
        _, distance, owner = self._best(x, y, place, group)
        for place, group, gaps in self.boxes.within(x, y, distance.copy()):
            # nearest boxes first: what a place finds in them rules out most of the others
            order = np.lexsort((gaps, place))
            place, group, gaps = place[order], group[order], gaps[order]
            looks = FIRST_LOOK
            while len(place):  # none at all if the nearest piece lies in another tree
                starts = np.flatnonzero(np.diff(place, prepend=-1))
                rank = np.arange(len(place)) - np.repeat(starts, np.diff(starts, append=len(place)))
                now = rank < looks
                at, best, own = self._best(x, y, place[now], group[now])
                better = (best < distance[at]) | ((best == distance[at]) & (own < owner[at]))
                distance[at[better]], owner[at[better]] = best[better], own[better]
                later = ~now
                place, group, gaps = place[later], group[later], gaps[later]
                near = gaps <= self.boxes.bound(x[place], y[place], distance[place])
                place, group, gaps = place[near], group[near], gaps[near]
                looks *= 4
        return distance, owner


def _grouped(columns) -> np.ndarray:
    """Columns as an array of groups of ``FAN`` by column by member."""
    return np.stack([column.reshape(-1, FAN) for column in columns], axis=1)


def _padded(low_x, low_y, high_x, high_y) -> tuple[np.ndarray, ...]:
    """Boxes filled up to a multiple of ``FAN`` with boxes that are infinitely far from everywhere."""
    missing = -len(low_x) % FAN
    far = np.full(missing, np.inf)
    return tuple(np.concatenate((side, far if side is low_x or side is low_y else -far)) for side in (low_x, low_y, high_x, high_y))


def _tree_of(pages: pa.Table) -> PackedTree:
    """One tree over pages in their order."""
    flat = [pages.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False) for name in _SHAPE]
    return PackedTree(*flat)


class Directory:
    """Boxes of all pages, and the places on their shapes."""

    def __init__(self, pages: pa.Table) -> None:
        self.page = pages.column("page").to_numpy()
        self.boxes = BoxTree(*(pages.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")))
        rx, ry = (pages.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("rx", "ry"))
        self.samples = PackedTree(rx, ry, rx, ry, np.zeros(len(rx)), np.zeros(len(rx)), np.arange(len(rx)))

    def candidates(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (by number, ascending) and the pages that may hold their nearest shape."""
        bound, _ = self.samples.nearest(x, y)
        lots = [(np.empty(0, dtype=np.int64),) * 3, *self.boxes.within(x, y, bound)]
        return np.concatenate([lot[0] for lot in lots]), self.page[np.concatenate([lot[1] for lot in lots])]


# --------------------------------------------------------------------------------------- build


def _pieces(shapes: DataFrame, length: float) -> DataFrame:
    """Each segment as pieces ``t0..t1`` no longer than ``length``; a piece keeps the ends of its segment."""
    run = point_distance(*[F.col(c) for c in _ENDS])
    count = F.greatest(F.lit(1), F.ceil(run / F.lit(length)).cast("int"))
    cut = shapes.withColumn("count", count).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    return cut.select(
        *_ENDS, "own", (F.col("part") / F.col("count")).alias("t0"), ((F.col("part") + 1) / F.col("count")).alias("t1"),
        (run / F.col("count")).alias("run"),
    )


def _spread(value: Column) -> Column:
    """The low 24 bits of a number, a zero bit after each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def _along(t: str, axis: str) -> Column:
    return F.col(f"a{axis}") + F.col(t) * (F.col(f"b{axis}") - F.col(f"a{axis}"))


def build_index(
    shapes: DataFrame, page_shapes: int = PAGE_SHAPES, carry: list[str] | None = None, max_pages: int = MAX_PAGES
) -> NearestIndex:
    """Index of ``shapes``: ``id``, ends ``ax, ay, bx, by`` and the columns to hand over (by default all others).

    Shapes without an id or with an end that is not finite take no part.  An id that comes with several values to
    hand over keeps the smallest.
    """
    carry = [c for c in shapes.columns if c not in ("id", *_ENDS)] if carry is None else carry
    ends = [F.col(c).cast("double").alias(c) for c in _ENDS]
    known = shapes.where(F.col("id").isNotNull() & _usable("ax", "ay") & _usable("bx", "by"))
    carried = cut_lineage(known.groupBy("id").agg(F.min(F.struct(*carry)).alias("carried"))) if carry else None
    # among equal shapes only the smallest id can win
    known = cut_lineage(known.select(F.col("id").cast("bigint").alias("own"), *ends).groupBy(*_ENDS).agg(F.min("own").alias("own")))
    length = F.sum(point_distance(*[F.col(c) for c in _ENDS]))
    n, total, x0, y0, x1, y1 = known.agg(
        F.count("*"), length, F.min(F.least("ax", "bx")), F.min(F.least("ay", "by")), F.max(F.greatest("ax", "bx")),
        F.max(F.greatest("ay", "by")),
    ).first()
    if not n:
        empty = shapes.sparkSession.createDataFrame([], PAGES_SCHEMA)
        return NearestIndex(empty, carried)
    side = max(x1 - x0, y1 - y0) or 1.0
    longest = max((total or 0.0) / max(PIECES_PER_SHAPE * n, LEAST_PIECES), side * 1e-9)
    pieces = _pieces(known, longest)
    scale = F.lit(((1 << _CURVE_BITS) - 1) / side)
    cells = [
        F.floor(((_along("t0", axis) + _along("t1", axis)) / 2 - F.lit(low)) * scale).cast("bigint") for axis, low in (("x", x0), ("y", y0))
    ]
    # pieces of one size lie together, so that a long one does not widen the boxes of short ones
    size = F.floor(F.log2(F.greatest(F.col("run") / F.lit(longest), F.lit(2.0**-20))) / 2)
    curve = _spread(cells[0]).bitwiseOR(F.shiftleft(_spread(cells[1]), 1))
    sorted_by = pieces.select(*_SHAPE, size.alias("size"), curve.alias("curve"))
    placed = dense_ids(sorted_by, ["size", "curve", *_ENDS, "t0"], "place", start=0)
    shapes_per_page = max(page_shapes, math.ceil((n + max(PIECES_PER_SHAPE * n, LEAST_PIECES)) / max_pages))
    samples = min(MOST_SAMPLES, max(SAMPLES, SAMPLES * max_pages * shapes_per_page // (n + LEAST_PIECES)))
    low_x, high_x = F.least(_along("t0", "x"), _along("t1", "x")), F.greatest(_along("t0", "x"), _along("t1", "x"))
    low_y, high_y = F.least(_along("t0", "y"), _along("t1", "y")), F.greatest(_along("t0", "y"), _along("t1", "y"))
    packed = placed.groupBy(F.floor(F.col("place") / shapes_per_page).alias("page")).agg(
        F.count("*").alias("n"), F.min("own").alias("least"),
        F.min(low_x).alias("x0"), F.min(low_y).alias("y0"), F.max(high_x).alias("x1"), F.max(high_y).alias("y1"),
        F.sort_array(F.collect_list(F.struct("place", *_SHAPE))).alias("members"),
    )
    picked = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(samples), F.col("n")).cast("int") - 1),
        lambda i: F.get("members", F.floor(i * F.col("n") / F.least(F.lit(samples), F.col("n"))).cast("int")),
    )

    def on_shape(axis: str) -> Column:
        return F.transform(picked, lambda s: s[f"a{axis}"] + s["t0"] * (s[f"b{axis}"] - s[f"a{axis}"])).alias(f"r{axis}")

    pages = packed.select(
        "page", "n", "least", "x0", "y0", "x1", "y1", on_shape("x"), on_shape("y"), *[F.col(f"members.{c}").alias(c) for c in _SHAPE]
    )
    return NearestIndex(cut_lineage(pages), carried)


class NearestIndex:
    """Pages of an index, as built or as stored, and the columns that its shapes hand over by ``id``."""

    def __init__(self, pages: DataFrame, carried: DataFrame | None = None) -> None:
        self.pages, self.carried = pages, carried

    def join(
        self, points: DataFrame, x: str, y: str, names: dict[str, str], broadcast_limit: int = BROADCAST_SHAPES,
        places_per_task: int = PLACES_PER_TASK,
    ) -> DataFrame:
        """``points`` plus the columns of the nearest shape, wherever they lie.

        ``names`` maps output names to ``id``, a carried column or ``distance``.  No shapes, no rows.
        """
        shapes, least = self.pages.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min("least")).first()
        if not shapes:
            found = points.where(F.lit(False)).withColumn("_found", F.lit(None).cast("struct<distance:double,id:bigint>"))
        elif shapes <= broadcast_limit:
            found = self._in_place(points, x, y)
        else:
            found = self._by_page(points, x, y, places_per_task)
        lost = F.struct(F.lit(float("inf")).alias("distance"), F.lit(least).cast("bigint").alias("id"))
        best = F.when(_usable(x, y), F.col("_found")).otherwise(lost)
        found = found.withColumn("_found", best)
        carried = [name for name in names.values() if name not in ("id", "distance")]
        if carried:
            owners = self.carried.select(F.col("id").alias("_id"), "carried")
            owners = F.broadcast(owners) if shapes <= broadcast_limit else owners  # not more ids than shapes
            found = found.join(owners, F.col("_found.id") == F.col("_id"), "left")
        outputs = [
            F.col(f"carried.{source}" if source in carried else f"_found.{source}").alias(name) for name, source in names.items()
        ]
        return found.select(*points.columns, *outputs)

    def _in_place(self, points: DataFrame, x: str, y: str) -> DataFrame:
        """The whole tree reaches every task, so the points stay where they are."""
        spark = points.sparkSession
        tree = spark.sparkContext.broadcast(_tree_of(self.pages.select("page", *_SHAPE).toArrow().sort_by("page")))

        @F.arrow_udf("struct<distance:double,id:bigint>")
        def nearest(places: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for xs, ys in places:
                yield _answered(tree.value, xs, ys)

        return points.withColumn("_found", nearest(F.col(x).cast("double"), F.col(y).cast("double")))

    def _by_page(self, points: DataFrame, x: str, y: str, places_per_task: int) -> DataFrame:
        """Each distinct location meets the pages that may hold its nearest shape."""
        spark = points.sparkSession
        box = ["page", "x0", "y0", "x1", "y1", "rx", "ry"]
        directory = spark.sparkContext.broadcast(Directory(self.pages.select(box).toArrow()))

        @F.arrow_udf("array<bigint>")
        def candidates(places: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for xs, ys in places:
                place, page = directory.value.candidates(xs.to_numpy(), ys.to_numpy())
                ends = np.searchsorted(place, np.arange(len(xs) + 1))
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(page, pa.int64()))

        usable = points.where(_usable(x, y)).select(F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"))
        # few bytes each, but much work: adaptive execution would put them into few tasks
        distinct = usable.distinct().repartition(wide(spark))
        asked = cut_lineage(distinct.withColumn("page", F.explode(candidates("px", "py"))))
        # a page in a large city is asked by many places: several tasks share them, each with its copy of the page
        tasks = asked.groupBy("page").agg(F.ceil(F.count("*") / places_per_task).cast("int").alias("tasks"))
        tasks = F.broadcast(tasks)  # one row per page, at most MAX_PAGES
        dealt = asked.join(tasks, "page").withColumn("task", F.pmod(F.xxhash64("px", "py"), F.col("tasks")).cast("int"))
        copies = self.pages.select("page", *_SHAPE).join(tasks, "page").withColumn(
            "task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))
        )

        def search(page: pa.Table, places: pa.Table) -> pa.Table:
            if not places.num_rows:
                return schema.empty_table()
            distance, own = _tree_of(page).nearest(places.column("px").to_numpy(), places.column("py").to_numpy())
            return pa.table([places.column("px"), places.column("py"), pa.array(distance), pa.array(own)], schema=schema)

        schema = pa.schema([("px", pa.float64()), ("py", pa.float64()), ("distance", pa.float64()), ("id", pa.int64())])
        met = copies.groupBy("page", "task").cogroup(dealt.select("page", "task", "px", "py").groupBy("page", "task")).applyInArrow(
            search, "px double, py double, distance double, id bigint"
        )
        best = met.groupBy("px", "py").agg(F.min(F.struct("distance", "id")).alias("_found"))
        # points without coordinates are spread by a salt that no location carries, and keep no match
        spread = F.when(_usable(x, y), F.lit(0)).otherwise(F.monotonically_increasing_id() % 1024 + 1)
        salted = points.withColumns({"_px": F.col(x).cast("double"), "_py": F.col(y).cast("double"), "_salt": spread})
        # always 0, but not a literal: the optimizer would take a literal out of the join keys again
        best = best.select(F.col("px").alias("_px"), F.col("py").alias("_py"), F.pmod(F.xxhash64("px"), F.lit(1)).alias("_salt"), "_found")
        return salted.join(best, ["_px", "_py", "_salt"], "left").select(*points.columns, "_found")


def _answered(tree: PackedTree, xs: pa.Array, ys: pa.Array) -> pa.StructArray:
    """Distance and id per place; null for one without usable coordinates."""
    x, y = (a.fill_null(np.nan).to_numpy(zero_copy_only=False) for a in (xs, ys))
    sound = np.isfinite(x) & np.isfinite(y)
    distance, own = np.zeros(len(x)), np.zeros(len(x), dtype=np.int64)
    distance[sound], own[sound] = tree.nearest(x[sound], y[sound])
    return pa.StructArray.from_arrays(
        [pa.array(distance, pa.float64()), pa.array(own, pa.int64())], names=["distance", "id"], mask=pa.array(~sound)
    )


def nearest_join(
    points: DataFrame, x: str, y: str, shapes: DataFrame | NearestIndex, names: dict[str, str], **options
) -> DataFrame:
    """``points`` plus the columns of the nearest shape, by an index of its own unless one is given."""
    index = shapes if isinstance(shapes, NearestIndex) else build_index(shapes)
    return index.join(points, x, y, names, **options)
