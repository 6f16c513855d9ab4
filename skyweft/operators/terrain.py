"""Terrain classes from a topographic position index, and their connected blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import checkpoints
from .stencils import gaussian, tpi


def window_size(metres: float, pixel: float) -> int:
    """An odd window of about that many metres, 3 at least."""
    size = max(3, round(metres / pixel))
    return size if size % 2 else size + 1


def thresholds(cells: DataFrame, method: str = "quantile", low: float = 0.25, high: float = 0.75, value: str = "tpi") -> DataFrame:
    """One row (low, high). quantile: linear quantiles; zscore: mean -+ population deviation; mad: median -+ 1.4826 times the median absolute deviation,
    NULLs if that is 0."""
    present = cells.where(F.col(value).isNotNull() & ~F.isnan(value))
    if method == "quantile":
        both = present.agg(F.percentile(value, F.array(F.lit(low), F.lit(high))).alias("q"))
        return both.select(F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    if method == "zscore":
        return present.agg((F.avg(value) - F.stddev_pop(value)).alias("low"), (F.avg(value) + F.stddev_pop(value)).alias("high"))
    if method == "mad":
        middle = present.agg(F.median(value).alias("m"))
        spread = present.crossJoin(F.broadcast(middle)).agg(F.first("m").alias("m"), F.median(F.abs(F.col(value) - F.col("m"))).alias("mad"))
        sigma = F.when(F.col("mad") > 0, 1.4826 * F.col("mad"))
        return spread.select((F.col("m") - sigma).alias("low"), (F.col("m") + sigma).alias("high"))
    raise ValueError(f"unknown method: {method}")


def position_class(value: Column, low: Column, high: Column) -> Column:
    """1 ridge at or above high (also if at or below low), -1 valley at or below low, else 0; missing 0."""
    return F.when(value >= high, 1).when(value <= low, -1).otherwise(0)


def classify(cells: DataFrame, limits: DataFrame, value: str = "tpi") -> DataFrame:
    """cells with cls, by the limits' one row."""
    joined = cells.crossJoin(F.broadcast(limits.select(F.col("low").alias("__low"), F.col("high").alias("__high"))))
    return joined.withColumn("cls", position_class(F.col(value), F.col("__low"), F.col("__high"))).drop("__low", "__high")


def label_blocks(cells: DataFrame, cls: int) -> DataFrame:
    """(r, c, label): the 8-connected blocks of a class, numbered from 1 in the order of their first cell.

    Rows are cut into runs first; runs that touch are edges, and star contraction finds the runs' components. Each round is checkpointed."""
    of = cells.where(F.col("cls") == cls).select("r", "c")
    start = F.col("c") - F.row_number().over(Window.partitionBy("r").orderBy("c"))
    runs = of.withColumn("g", start).groupBy("r", "g").agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
    runs = checkpoints.cut(runs.select("r", "c0", "c1", F.struct("r", "c0").alias("run")))
    a, b = runs.alias("a"), runs.alias("b")
    touch = a.join(b, (F.col("b.r") == F.col("a.r") + 1) & (F.col("b.c0") <= F.col("a.c1") + 1) & (F.col("b.c1") >= F.col("a.c0") - 1))
    edges = checkpoints.cut(touch.select(F.col("b.run").alias("x"), F.col("a.run").alias("y")))
    roots = contract(edges)
    named = runs.join(roots, runs["run"] == roots["x"], "left").select("r", "c0", "c1", F.coalesce("y", "run").alias("root"))
    # numbered row by row, behind the blocks that start in rows before: what is ordered in one task is a count a row
    first = named.select("root").distinct().withColumn("r0", F.col("root.r"))
    before = first.groupBy("r0").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("r0")) - F.col("n"))
    inside = first.withColumn("nth", F.row_number().over(Window.partitionBy("r0").orderBy("root")))
    order = inside.join(before, "r0").select("root", (F.col("before") + F.col("nth")).cast("bigint").alias("label"))
    return named.join(order, "root").select("r", F.explode(F.sequence("c0", "c1")).alias("c"), "label")


def contract(edges: DataFrame) -> DataFrame:
    """edges (x, y) of orderable ids -> (x, y) with y the smallest of x's component, for every x that isn't it."""
    now = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x <> y").distinct()
    mark = None
    while True:
        both = now.union(now.select("y", "x"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        outward = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        small = outward.groupBy("x").agg(F.min("y").alias("m"))
        inward = outward.join(small, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).union(small.select("x", F.col("m").alias("y")))
        now = checkpoints.cut(inward.where("x <> y").distinct())
        seen = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("x", "y"))).first())
        if seen == mark:
            return now
        mark = seen


def ridges_and_valleys(cells: DataFrame, size: int, method: str = "quantile", sigma: float | None = None) -> DataFrame:
    """The whole chain: (smooth,) position index, thresholds, classes, block ids; valleys' ids follow the ridges'."""
    base = gaussian(cells, sigma, missing="mean").withColumn("elevation", F.col("smooth")).drop("smooth") if sigma else cells
    found = checkpoints.cut(tpi(base, size))
    classed = checkpoints.cut(classify(found, thresholds(found, method)))
    ridge, valley = label_blocks(classed, 1), label_blocks(classed, -1)
    offset = ridge.agg(F.coalesce(F.max("label"), F.lit(0)).alias("n"))
    ids = ridge.select("r", "c", F.col("label").alias("block_id")).unionByName(valley.crossJoin(F.broadcast(offset)).select("r", "c", (F.col("label") + F.col("n")).alias("block_id")))
    return classed.join(ids, ["r", "c"], "left").withColumn("block_id", F.coalesce("block_id", F.lit(0)))


def outlines(classed: DataFrame) -> DataFrame:
    """(block_id, cls, r, c0, c1): each block as the runs of its rows, which polygons are drawn from."""
    inside = classed.where("block_id > 0")
    g = F.col("c") - F.row_number().over(Window.partitionBy("block_id", "r").orderBy("c"))
    return inside.withColumn("g", g).groupBy("block_id", "cls", "r", "g").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).drop("g")
