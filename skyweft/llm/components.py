"""Connected components of an edge table by alternating star contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import _materialized, drop


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Every vertex u links its neighbours (the larger ones, or itself and the smaller ones) to the smallest vertex at hand. The
    minimum is summed map-side first, so a vertex with very many neighbours costs one row a task, and the join that follows may be split."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least.select("u", F.least("u", "m").alias("m")), "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of orderable ids -> (v, root) for each vertex that isn't its component's smallest; loops and repeats are ignored.

    The number of rounds is logarithmic in the number of vertices; each round's table is written to the shared folder and replaces the one before.
    """
    spark = edges.sparkSession
    now, path = _materialized(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = _mark(now)
    while seen[0]:
        before = path
        now, path = _materialized(_stars(_stars(now, large=True), large=False), "edges")
        drop(spark, before)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("v"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first())
