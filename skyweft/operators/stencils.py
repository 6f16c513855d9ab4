"""Focal operators over long grids (r, c, value): terrain position, gradients, smoothing, dilation, gap filling.

Missing cells are NULL or absent. Box sums are separable sums over lines, wide ones by running sums over blocks; small kernels are scattered:
each source cell is added to its neighbours with map-side sums, and only cells of the grid are kept. Edges are padded beforehand.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grids import densify


def _pad_axis(grid: DataFrame, axis: str, width: int, mode: str, low: int, high: int) -> DataFrame:
    """Copies of the edge lines beyond [low, high]: "nearest" repeats the edge, "reflect" mirrors at it (the edge line twice)."""
    x = F.col(axis)
    if mode == "nearest":
        first = F.when(x == low, F.sequence(x - width, x)).otherwise(F.array(x))
        last = F.when(x == high, F.sequence(x + 1, x + width)).otherwise(F.array().cast("array<bigint>"))
        places = F.concat(first, last)
    elif mode == "reflect":
        size = high - low + 1
        # every place in the padded range whose mirror image is this line
        images = [(low + (m if m < size else 2 * size - 1 - m), p) for p in range(low - width, high + width + 1) for m in [(p - low) % (2 * size)]] if size <= 2 * width else None
        if images is not None:
            table: dict[int, list[int]] = {}
            for line, p in images:
                table.setdefault(line, []).append(p)
            places = F.coalesce(*(F.when(x == line, F.array(*(F.lit(p).cast("bigint") for p in ps))) for line, ps in table.items()), F.array(x))
        else:
            below = F.when(x - low < width, F.array(2 * F.lit(low) - 1 - x)).otherwise(F.array().cast("array<bigint>"))
            above = F.when(high - x < width, F.array(2 * F.lit(high) + 1 - x)).otherwise(F.array().cast("array<bigint>"))
            places = F.concat(F.array(x), below, above)
    else:
        raise ValueError(f"unknown edge mode: {mode}")
    return grid.withColumn(axis, F.explode(places))


def pad(grid: DataFrame, width: int, mode: str) -> DataFrame:
    """The grid with `width` lines more on each side."""
    box = grid.agg(F.min("r"), F.max("r"), F.min("c"), F.max("c")).first()
    if box[0] is None:
        return grid
    return _pad_axis(_pad_axis(grid, "r", width, mode, box[0], box[1]), "c", width, mode, box[2], box[3])


def scatter(grid: DataFrame, kernel: dict[tuple[int, int], float], value: str) -> DataFrame:
    """(r, c, total, weight, n): sums of kernel weight * value, of weights, and the number of present values, for each place any value reaches.
    kernel: {(dr, dc): w}, the weight of the value at (r + dr, c + dc)."""
    entries = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(float(w)).alias("w")) for (a, b), w in kernel.items()))
    spread = grid.where(F.col(value).isNotNull()).select("r", "c", F.col(value).alias("v"), F.explode(entries).alias("k"))
    place = [(F.col("r") - F.col("k.a")).alias("r"), (F.col("c") - F.col("k.b")).alias("c")]
    return spread.groupBy(*place).agg(F.sum(F.col("v") * F.col("k.w")).alias("total"), F.sum("k.w").alias("weight"), F.count("v").alias("n"))


#: Half widths up to which sliding frames are summed afresh for each cell.
NARROW = 8


def _line_sums(cells: DataFrame, line: str, at: str, half: int, values: dict[str, str]) -> DataFrame:
    """cells (line, at, columns of values) with the columns summed over at - half .. at + half on each line, under the names that values gives.

    Wide windows are two parts of neighbouring blocks of the window's width: the end of one and the start of the next. Running sums inside the blocks give
    both, so the work doesn't depend on the width, no block is longer than the window, and nothing is subtracted."""
    if half <= NARROW:
        w = Window.partitionBy(line).orderBy(at).rangeBetween(-half, half)
        return cells.select(line, at, *(F.sum(c).over(w).alias(n) for c, n in values.items()))
    width = 2 * half + 1
    # 0: a cell's values; 1: what cell `to` asks for at the upper end of its window, 2: at the lower end
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), (F.col(at) + d).alias("place")) for k, d in ((0, 0), (1, half), (2, -half))))
    rows = cells.select(line, F.col(at).alias("to"), *values, F.explode(kinds).alias("e")).select(line, "to", "e.kind", "e.place", *(F.when(F.col("e.kind") == 0, F.col(c)).alias(c) for c in values))
    rows = rows.withColumn("block", F.floor(F.col("place") / width))
    up = Window.partitionBy(line, "block").orderBy("place", F.col("kind")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(line, "block").orderBy(F.col("place").desc(), F.col("kind")).rowsBetween(Window.unboundedPreceding, 0)
    parts = rows.select(line, "to", "kind", "place", *(F.when(F.col("kind") == 1, F.sum(c).over(up)).when(F.col("kind") == 2, F.sum(c).over(down)).alias(c) for c in values))
    # a window that is a whole block has both parts equal to it
    twice = (F.col("kind") == 2) & (F.pmod(F.col("place"), F.lit(width)) == 0)
    asked = parts.where((F.col("kind") > 0) & ~twice)
    return asked.groupBy(line, F.col("to").alias(at)).agg(*(F.sum(c).alias(n) for c, n in values.items()))


def box_sums(grid: DataFrame, half: int, value: str) -> DataFrame:
    """grid with total and n: sum and number of present values in the (2 half + 1)-wide square, edges repeated outwards."""
    cells = grid.select("r", "c", F.col(value).cast("double").alias("v"))
    box = cells.agg(F.min("r"), F.max("r"), F.min("c"), F.max("c"), F.count(F.lit(1))).first()
    if box[0] is not None and box[4] < (box[1] - box[0] + 1) * (box[3] - box[2] + 1):
        cells = densify(cells)  # a line's sum is asked for at absent cells too
    padded = pad(cells, half, "nearest")
    counted = padded.withColumn("k", F.col("v").isNotNull().cast("bigint"))
    along = _line_sums(counted, "r", "c", half, {"v": "s", "k": "m"})
    both = _line_sums(along, "c", "r", half, {"s": "total", "m": "n"})
    return grid.join(both.select("r", "c", "total", "n"), ["r", "c"])


def tpi(grid: DataFrame, size: int, value: str = "elevation") -> DataFrame:
    """grid with tpi: the cell minus the mean of the others in the size-wide square (odd, 3 at least); NULL where the cell or all others are missing."""
    if size < 3 or size % 2 == 0:
        raise ValueError("the window must be odd and 3 at least")
    summed = box_sums(grid, size // 2, value)
    others = F.try_divide(F.col("total") - F.col(value), F.col("n") - 1)
    return summed.withColumn("tpi", F.when(F.col(value).isNotNull(), F.col(value) - others)).drop("total", "n")


def sobel(grid: DataFrame, value: str = "elevation") -> DataFrame:
    """grid with gradient: the root of both Sobel sums squared, edges mirrored; NULL where any of the nine cells is missing."""
    smooth = {-1: 1.0, 0: 2.0, 1: 1.0}
    padded = pad(grid.select("r", "c", F.col(value).alias("v")), 1, "reflect")
    entries = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(a * smooth[b]).alias("x"), F.lit(b * smooth[a]).alias("y")) for a in (-1, 0, 1) for b in (-1, 0, 1)))
    spread = padded.where(F.col("v").isNotNull()).select("r", "c", "v", F.explode(entries).alias("k"))
    sums = spread.groupBy((F.col("r") - F.col("k.a")).alias("r"), (F.col("c") - F.col("k.b")).alias("c")).agg(F.sum(F.col("v") * F.col("k.x")).alias("gx"), F.sum(F.col("v") * F.col("k.y")).alias("gy"), F.count("v").alias("n"))
    gradient = F.when(F.col("n") == 9, F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")))
    return grid.join(sums.select("r", "c", gradient.alias("gradient")), ["r", "c"], "left")


def gaussian_weights(sigma: float) -> dict[int, float]:
    """A normalised kernel out to int(4 sigma + 0.5)."""
    radius = int(4 * sigma + 0.5)
    raw = {i: math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)}
    return {i: w / sum(raw.values()) for i, w in raw.items()}


def gaussian(grid: DataFrame, sigma: float, value: str = "elevation", missing: str = "normalise") -> DataFrame:
    """grid with `smooth`, by two one-dimensional passes with mirrored edges. missing: "normalise" takes means over present values, "zero" counts missing
    cells as 0 (and gives them a value), "mean" first puts the mean of the surrounding 6 sigma square in their place."""
    weights = gaussian_weights(sigma)
    cells = grid.select("r", "c", F.col(value).cast("double").alias("v"))
    if missing == "zero":
        cells = cells.withColumn("v", F.coalesce("v", F.lit(0.0)))
    elif missing == "mean":
        k = max(3, round(6 * sigma))
        filled = box_sums(cells, (k + (k % 2 == 0)) // 2, "v")
        cells = filled.select("r", "c", F.coalesce("v", F.try_divide("total", "n")).alias("v"))
    elif missing != "normalise":
        raise ValueError(f"unknown treatment of missing cells: {missing}")
    radius = max(weights)
    along = pad(cells, radius, "reflect")
    rows = scatter(along, {(0, d): w for d, w in weights.items()}, "v").select("r", "c", F.struct("total", "weight").alias("p"))
    entries = F.array(*(F.struct(F.lit(d).alias("a"), F.lit(w).alias("w")) for d, w in weights.items()))
    spread = rows.select("r", "c", "p", F.explode(entries).alias("k")).groupBy((F.col("r") - F.col("k.a")).alias("r"), "c")
    sums = spread.agg(F.sum(F.col("p.total") * F.col("k.w")).alias("total"), F.sum(F.col("p.weight") * F.col("k.w")).alias("weight"))
    smooth = F.try_divide("total", "weight") if missing == "normalise" else F.col("total")
    return grid.join(sums.select("r", "c", smooth.alias("smooth")), ["r", "c"], "left")


def dilate(grid: DataFrame, flag: str, iterations: int) -> DataFrame:
    """grid with `dilated`: true within `iterations` steps (up, down, left, right) of a cell with the flag."""
    diamond = [(a, b) for a in range(-iterations, iterations + 1) for b in range(-iterations, iterations + 1) if abs(a) + abs(b) <= iterations]
    entries = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in diamond))
    reached = grid.where(F.col(flag)).select("r", "c", F.explode(entries).alias("k")).select((F.col("r") + F.col("k.a")).alias("r"), (F.col("c") + F.col("k.b")).alias("c")).distinct()
    return grid.join(reached.withColumn("__hit", F.lit(True)), ["r", "c"], "left").withColumn("dilated", F.coalesce("__hit", F.lit(False))).drop("__hit")


def smooth_steep_cells(grid: DataFrame, width: int = 2, sigma: float = 0.8, percentile: float = 0.95, value: str = "elevation") -> DataFrame:
    """grid with the steepest cells (gradient above the percentile) and their surroundings replaced by smoothed values; missing cells count as 0 in the
    smoothing and stay missing."""
    steep = sobel(grid, value)
    limit = steep.agg(F.percentile("gradient", percentile).alias("limit"))
    marked = steep.crossJoin(F.broadcast(limit)).withColumn("steep", F.coalesce(F.col("gradient") > F.col("limit"), F.lit(False))).select("r", "c", "steep")
    near = dilate(marked, "steep", width).select("r", "c", "dilated")
    smoothed = gaussian(grid, sigma, value, "zero").join(near, ["r", "c"])
    return smoothed.withColumn(value, F.when(F.col("dilated") & F.col(value).isNotNull(), F.col("smooth")).otherwise(F.col(value))).drop("smooth", "dilated")


def _disc(distance: float) -> list[tuple[int, int, float]]:
    reach = int(distance)
    return [(a, b, math.hypot(a, b)) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1) if 0 < math.hypot(a, b) <= distance]


def fill_nearest(grid: DataFrame, distance: float = 5, value: str = "elevation") -> DataFrame:
    """grid with missing cells within `distance` cells of a present one given that one's value; of equally near ones that with the smallest (r, c)."""
    missing = grid.where(F.col(value).isNull()).select("r", "c")
    entries = F.array(*(F.struct(F.lit(d).alias("d"), F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b, d in _disc(distance)))
    # holes ask their surroundings: the work goes with the number of missing cells
    asks = missing.select("r", "c", F.explode(entries).alias("k")).select(F.col("r").alias("tr"), F.col("c").alias("tc"), (F.col("r") + F.col("k.a")).alias("r"), (F.col("c") + F.col("k.b")).alias("c"), F.col("k.d").alias("d"))
    found = asks.join(grid.where(F.col(value).isNotNull()).select("r", "c", F.col(value).alias("v")), ["r", "c"]).groupBy("tr", "tc").agg(F.min_by("v", F.struct("d", "r", "c")).alias("v"))
    filled = grid.join(found.select(F.col("tr").alias("r"), F.col("tc").alias("c"), "v"), ["r", "c"], "left")
    return filled.withColumn(value, F.coalesce(value, "v")).drop("v")


def fill_neighbourhood(grid: DataFrame, rounds: int = 3, value: str = "elevation") -> DataFrame:
    """grid with missing cells filled from the outside in: in each round those with a present cell among their eight neighbours take the neighbours' mean."""
    ring = {(a, b): 1.0 for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)}
    for _ in range(rounds):
        sums = scatter(grid.select("r", "c", value), ring, value).select("r", "c", (F.col("total") / F.col("n")).alias("__mean"))
        grid = grid.join(sums, ["r", "c"], "left").withColumn(value, F.coalesce(value, "__mean")).drop("__mean")
    return grid


def fill_linear(grid: DataFrame, distance: float = 5, value: str = "elevation") -> DataFrame:
    """grid with missing cells near present ones filled by line interpolation: the mean of what the nearest present cells left and right, and above and
    below, give linearly; cells with neither take the nearest value. (Not a triangulation: along rows and columns only.)"""
    here = F.when(F.col(value).isNotNull(), F.struct(F.col("c").alias("x"), F.col("r").alias("y"), F.col(value).alias("v")))
    # from either end: the last present cell so far, carried along in one pass
    nearest = lambda line, order: F.last(here, True).over(Window.partitionBy(line).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))

    def line(a: Column, b: Column, at: str, axis: str) -> Column:
        share = F.try_divide(F.col(at) - a[axis], b[axis] - a[axis])
        return a["v"] + (b["v"] - a["v"]) * share

    sides = grid.withColumns({"__l": nearest("r", F.col("c")), "__rt": nearest("r", F.col("c").desc()), "__u": nearest("c", F.col("r")), "__d": nearest("c", F.col("r").desc())})
    across, down = line(F.col("__l"), F.col("__rt"), "c", "x"), line(F.col("__u"), F.col("__d"), "r", "y")
    lined = sides.select("r", "c", F.when(across.isNotNull() & down.isNotNull(), (across + down) / 2).otherwise(F.coalesce(across, down)).alias("__line"))
    near = fill_nearest(grid, distance, value).select("r", "c", F.col(value).alias("__near"))
    both = grid.join(near, ["r", "c"]).join(lined, ["r", "c"])
    fillable = F.col(value).isNull() & F.col("__near").isNotNull()
    return both.withColumn(value, F.when(fillable, F.coalesce("__line", "__near")).otherwise(F.col(value))).drop("__near", "__line")
