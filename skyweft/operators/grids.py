"""Regular grids as long tables (r, c, lat, lon, value): target grids, resampling, tiles and their union.

Coordinates of a regular axis are turned into integers once; every lookup is then an equi-join on (r, c).
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def axis_size(low: float, high: float, step: float) -> int:
    """The number of steps from low up to high + step, exclusive, however the last float falls."""
    return math.ceil(round((high + step - low) / step, 9))


def target_grid(spark: SparkSession, left: float, bottom: float, right: float, top: float, resolution: float = 0.01) -> DataFrame:
    """(r, c, lat, lon) over the outer bounds; generated where it is used, whatever its size."""
    rows, cols = axis_size(bottom, top, resolution), axis_size(left, right, resolution)
    cell = F.col("id")
    base = spark.range(rows * cols).select(F.floor(cell / cols).cast("bigint").alias("r"), (cell % cols).alias("c"))
    return base.select("r", "c", (F.lit(bottom) + F.col("r") * F.lit(resolution)).alias("lat"), (F.lit(left) + F.col("c") * F.lit(resolution)).alias("lon"))


def axis_index(x: Column, first: Column | float, step: Column | float, last: Column | int, nearest: bool = True) -> Column:
    """The place of x on a regular axis, clamped to it: nearest (halves to even) or truncated."""
    at = (x - first) / step
    place = (F.rint(at) if nearest else at).cast("bigint")
    return F.least(F.greatest(place, F.lit(0)), F.lit(last) if isinstance(last, int) else last)


def _frame(source: DataFrame) -> dict:
    """First and last coordinates and the steps of a regular grid: one small aggregate on the driver."""
    f = source.agg(F.min("lat").alias("y0"), F.max("lat").alias("y1"), F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.max("r").alias("rows"), F.max("c").alias("cols"), F.min("r").alias("r0"), F.min("c").alias("c0")).first().asDict()
    if f["y0"] is None:
        return {"y0": 0.0, "y1": -1.0, "x0": 0.0, "x1": -1.0, "dy": 1.0, "dx": 1.0, "rows": 0, "cols": 0}
    f["rows"], f["cols"] = f["rows"] - f["r0"], f["cols"] - f["c0"]
    return f | {"dy": (f["y1"] - f["y0"]) / f["rows"] if f["rows"] else 1.0, "dx": (f["x1"] - f["x0"]) / f["cols"] if f["cols"] else 1.0}


def nearest_resample(source: DataFrame, target: DataFrame, value: str = "elevation", step: float | None = None, inside: bool = True) -> DataFrame:
    """target with the value of the nearest source cell; NULL outside of the source's cell centres (inside=False: the edge's value)."""
    f = _frame(source)
    dy, dx = step or f["dy"], step or f["dx"]
    within = F.col("lat").between(f["y0"], f["y1"]) & F.col("lon").between(f["x0"], f["x1"]) if inside else F.lit(True)
    placed = target.withColumns({"__r": F.when(within, axis_index(F.col("lat"), f["y0"], dy, f["rows"])), "__c": F.when(within, axis_index(F.col("lon"), f["x0"], dx, f["cols"]))})
    cells = source.select(F.col("r").alias("__r"), F.col("c").alias("__c"), F.col(value).alias(value))
    return placed.join(cells, ["__r", "__c"], "left").drop("__r", "__c")


def nearest_cells(points: DataFrame, source: DataFrame, columns: Sequence[str] = ("r", "c", "elevation"), step: float | None = None) -> DataFrame:
    """points with the columns of the grid cell nearest on each axis, those outside with the edge's."""
    f = _frame(source)
    placed = points.withColumns({"__r": axis_index(F.col("lat"), f["y0"], step or f["dy"], f["rows"]), "__c": axis_index(F.col("lon"), f["x0"], step or f["dx"], f["cols"])})
    cells = source.select(F.col("r").alias("__r"), F.col("c").alias("__c"), *(F.col(c).alias(f"cell_{c}") for c in columns))
    return placed.join(cells, ["__r", "__c"], "left").drop("__r", "__c")


def block_average(source: DataFrame, target: DataFrame, resolution: float, value: str = "elevation", step: float | None = None) -> DataFrame:
    """target (r, c, lat, lon) with the mean of the source block centred at it, of the odd width that the resolutions give, clipped at the edges."""
    f = _frame(source)
    dy, dx = step or f["dy"], step or f["dx"]
    half = {"r": max(1, int(abs(resolution / dy))) // 2, "c": max(1, int(abs(resolution / dx))) // 2}
    within = F.col("lat").between(f["y0"], f["y1"]) & F.col("lon").between(f["x0"], f["x1"])
    placed = target.where(within).withColumns({"__r": axis_index(F.col("lat"), f["y0"], dy, f["rows"], False), "__c": axis_index(F.col("lon"), f["x0"], dx, f["cols"], False)})
    # targets ask for the cells of their own blocks, which are about as many as the source has when blocks tile it
    span = lambda at: F.explode(F.sequence(F.col(f"__{at}") - half[at], F.col(f"__{at}") + half[at])).alias(at)
    rows = placed.select(F.col("r").alias("tr"), F.col("c").alias("tc"), "__c", span("r"))
    asked = rows.select("tr", "tc", "r", span("c"))
    found = asked.join(source.where(F.col(value).isNotNull()).select("r", "c", value), ["r", "c"]).groupBy("tr", "tc").agg(F.avg(value).alias(value))
    return target.join(found.select(F.col("tr").alias("r"), F.col("tc").alias("c"), value), ["r", "c"], "left")


def tile_boxes(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("tile_id").agg(F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"), F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"), F.count(F.lit(1)).alias("n_cells"))


def tile_relations(boxes: DataFrame, resolution: float = 0.01, adjacent: str = "both") -> DataFrame:
    """Pairs of tiles that are adjacent: (tile_a, tile_b, relation, lat_gap, lon_gap), relation "overlap" or "gap" (over half a cell).

    adjacent: "both" asks for neighbouring edges in latitude and in longitude, so tiles side by side are no pair; "either" corrects that: edges
    that meet on one axis and ranges that overlap or meet on the other. Tiles meet in the squares, as wide as the widest tile, that they or their
    surroundings lie in, so only neighbours are compared."""
    c = F.col
    near = resolution * 1.5
    widest = boxes.agg(F.max(F.greatest(c("lat_max") - c("lat_min"), c("lon_max") - c("lon_min")))).first()[0] or 0.0
    side = widest + 2 * near
    squares = lambda x: F.explode(F.sequence(F.floor((c(f"{x}_min") - near) / side), F.floor((c(f"{x}_max") + near) / side)))
    dealt = boxes.withColumn("__y", squares("lat")).withColumn("__x", squares("lon"))
    a, b = dealt.alias("a"), dealt.alias("b")

    def meets(x: str) -> Column:
        return (F.abs(c(f"a.{x}_max") - c(f"b.{x}_min")) <= near) | (F.abs(c(f"b.{x}_max") - c(f"a.{x}_min")) <= near)

    def overlaps(x: str) -> Column:
        return (c(f"a.{x}_max") >= c(f"b.{x}_min")) & (c(f"b.{x}_max") >= c(f"a.{x}_min"))

    def gap(x: str) -> Column:
        return F.greatest(c(f"b.{x}_min") - c(f"a.{x}_max"), c(f"a.{x}_min") - c(f"b.{x}_max"), F.lit(0.0))

    close = meets("lat") & meets("lon") if adjacent == "both" else (meets("lat") & (overlaps("lon") | meets("lon"))) | (meets("lon") & (overlaps("lat") | meets("lat")))
    both = overlaps("lat") & overlaps("lon")
    pairs = a.join(b, (c("a.__y") == c("b.__y")) & (c("a.__x") == c("b.__x")) & (c("a.tile_id") < c("b.tile_id")) & close)
    relation = F.when(both, "overlap").when((gap("lat") > resolution * 0.5) | (gap("lon") > resolution * 0.5), "gap")
    found = pairs.select(c("a.tile_id").alias("tile_a"), c("b.tile_id").alias("tile_b"), relation.alias("relation"), gap("lat").alias("lat_gap"), gap("lon").alias("lon_gap"))
    return found.where("relation IS NOT NULL").distinct()


def unified_axis(cells: DataFrame, column: str, resolution: float) -> DataFrame:
    """(key, position, index) of the union of coordinates: equal up to half a step they are one line."""
    keyed = cells.select(F.rint(F.col(column) / resolution).cast("bigint").alias("key"), F.col(column).alias("position"))
    lines = keyed.groupBy("key").agg(F.min("position").alias("position"))
    # an axis has a few thousand lines: its order may be numbered in one task
    return lines.select("key", "position", (F.row_number().over(Window.orderBy("key")) - 1).cast("bigint").alias("index"))


def min_spacing(axis: DataFrame) -> DataFrame:
    step = F.col("position") - F.lag("position").over(Window.orderBy("position"))
    return axis.select(step.alias("step")).agg(F.min("step").alias("min_spacing"))


def merge_tiles(tiles: DataFrame, resolution: float, value: str = "elevation") -> DataFrame:
    """The tiles' union on one integer lattice (r, c from coordinates): mean of what tiles contribute to a cell, NULL where none has a value."""
    r, c = F.rint(F.col("lat") / resolution).cast("bigint"), F.rint(F.col("lon") / resolution).cast("bigint")
    return tiles.groupBy(r.alias("r"), c.alias("c")).agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.avg(value).alias(value), F.count(value).alias("n"))


def strict_merge(a: DataFrame, b: DataFrame, value: str = "elevation") -> DataFrame:
    """Full outer union of two grids on (r, c); where both have a value and they differ, `conflict` is true."""
    x, y = a.select("r", "c", F.col(value).alias("__a")), b.select("r", "c", F.col(value).alias("__b"))
    joined = x.join(y, ["r", "c"], "full")
    return joined.select("r", "c", F.coalesce("__a", "__b").alias(value), F.coalesce(F.col("__a") != F.col("__b"), F.lit(False)).alias("conflict"))


def densify(grid: DataFrame) -> DataFrame:
    """All (r, c) of the grid's bounding box, absent cells with NULLs."""
    box = grid.agg(F.min("r"), F.max("r"), F.min("c"), F.max("c")).first()
    if box[0] is None:
        return grid
    r0, r1, c0, c1 = box
    cols = c1 - c0 + 1
    cells = grid.sparkSession.range((r1 - r0 + 1) * cols).select((F.floor(F.col("id") / cols) + r0).cast("bigint").alias("r"), (F.col("id") % cols + c0).alias("c"))
    return cells.join(grid, ["r", "c"], "left")


def coverage(grid: DataFrame, value: str = "elevation") -> DataFrame:
    n, valid = F.count(F.lit(1)), F.count(value)
    return grid.agg(n.alias("n_cells"), valid.alias("n_valid"), (n - valid).alias("n_missing"), F.try_divide(100.0 * valid, n).alias("valid_percent"))


def _corners(method: str, fx: Column, fy: Column) -> list[tuple[int, int, Column]]:
    """(row offset, column offset, weight) of the source cells that a place between them takes."""
    if method == "linear":  # two triangles a square, split from its lower right to its upper left corner
        low = fx + fy <= 1
        return [(0, 0, F.when(low, 1 - fx - fy).otherwise(0.0)), (0, 1, F.when(low, fx).otherwise(1 - fy)), (1, 0, F.when(low, fy).otherwise(1 - fx)), (1, 1, F.when(low, 0.0).otherwise(fx + fy - 1))]

    def along(t: Column) -> list[Column]:
        return [((2 - t) * t - 1) * t / 2, ((3 * t - 5) * t * t + 2) / 2, ((4 - 3 * t) * t + 1) * t / 2, (t - 1) * t * t / 2]

    return [(a - 1, b - 1, y * x) for a, y in enumerate(along(fy)) for b, x in enumerate(along(fx))]


def between(source: DataFrame, target: DataFrame, method: str = "linear", value: str = "elevation", step: float | None = None) -> DataFrame:
    """target (r, c, lat, lon) with the value between the source's cell centres: "linear" over the lattice's triangles, "cubic" by Catmull-Rom splines
    (edges repeated; not a triangulated cubic). NULL outside of the cell centres, and where a cell that counts is missing."""
    f = _frame(source)
    dy, dx = step or f["dy"], step or f["dx"]
    y, x = (F.col("lat") - f["y0"]) / dy, (F.col("lon") - f["x0"]) / dx
    within = F.col("lat").between(f["y0"], f["y1"]) & F.col("lon").between(f["x0"], f["x1"])
    iy, ix = F.least(F.floor(y), F.lit(max(0, f["rows"] - 1))).cast("bigint"), F.least(F.floor(x), F.lit(max(0, f["cols"] - 1))).cast("bigint")
    placed = target.where(within).select("r", "c", iy.alias("iy"), ix.alias("ix"), (y - iy).alias("fy"), (x - ix).alias("fx"))
    clamp = lambda i, last: F.least(F.greatest(i, F.lit(0)), F.lit(last))
    entries = [F.struct(clamp(F.col("iy") + a, f["rows"]).cast("bigint").alias("r"), clamp(F.col("ix") + b, f["cols"]).cast("bigint").alias("c"), w.alias("w")) for a, b, w in _corners(method, F.col("fx"), F.col("fy"))]
    asked = placed.select(F.col("r").alias("tr"), F.col("c").alias("tc"), F.explode(F.filter(F.array(*entries), lambda k: k["w"] != 0)).alias("k")).select("tr", "tc", "k.r", "k.c", "k.w")
    found = asked.join(source.select("r", "c", F.col(value).alias("v")), ["r", "c"], "left").groupBy("tr", "tc")
    sums = found.agg(F.when(F.count("v") == F.count(F.lit(1)), F.sum(F.col("v") * F.col("w"))).alias(value))
    return target.join(sums.select(F.col("tr").alias("r"), F.col("tc").alias("c"), value), ["r", "c"], "left")


def resample(source: DataFrame, target: DataFrame, method: str = "fast_nearest", resolution: float | None = None, value: str = "elevation") -> DataFrame:
    """target with values of the source by one of the methods: fast_nearest (also: vectorized), block_average, nearest (edges extended), linear, cubic."""
    if method in ("fast_nearest", "vectorized"):
        return nearest_resample(source, target, value)
    if method == "nearest":
        return nearest_resample(source, target, value, inside=False)
    if method == "block_average":
        if resolution is None:
            raise ValueError("block_average needs the target's resolution")
        return block_average(source, target, resolution, value)
    if method in ("linear", "cubic"):
        return between(source, target, method, value)
    raise ValueError(f"unknown method: {method}")


def compare_methods(source: DataFrame, target: DataFrame, resolution: float, methods: Sequence[str] = ("fast_nearest", "block_average", "linear", "cubic"), value: str = "elevation") -> DataFrame:
    """(method, seconds, n_valid, min, max, mean), the fastest first: what each method makes of the same target."""
    rows = []
    for method in methods:
        began = time.perf_counter()
        found = resample(source, target, method, resolution, value).agg(F.count(value), F.min(value), F.max(value), F.avg(value)).first()
        rows.append((method, time.perf_counter() - began, *found))
    return source.sparkSession.createDataFrame(rows, "method string, seconds double, n_valid bigint, min double, max double, mean double").orderBy("seconds")


def at_points(points: DataFrame, source: DataFrame, columns: Sequence[str], west: float, south: float, step: float) -> DataFrame:
    """points (lat, lon) with columns of the cell they lie in (edges truncated downwards); NULLs outside."""
    inside = points.withColumns({"__r": F.floor((F.col("lat") - south) / step).cast("bigint"), "__c": F.floor((F.col("lon") - west) / step).cast("bigint")})
    cells = source.select(F.col("r").alias("__r"), F.col("c").alias("__c"), *columns)
    return inside.join(cells, ["__r", "__c"], "left").drop("__r", "__c")
