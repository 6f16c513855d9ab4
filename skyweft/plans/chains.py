"""Whole chains: the micro-batch of a cycle, the historical batch, the elevation build, and a replay of events as a stream."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import checkpoints
from ..operators import cleaning, grids, scoring, stencils, visibility
from ..streaming import slots


def build_dem(tiles: DataFrame, resolution: float, linear_distance: float = 5, nearest_distance: float = 3, width: int = 2) -> DataFrame:
    """Tiles -> one grid: union of their axes, mean where they overlap, gaps filled along lines, steep cells smoothed, last gaps filled."""
    merged = checkpoints.cut(grids.densify(grids.merge_tiles(tiles, resolution)).select("r", "c", "elevation"))
    filled = checkpoints.cut(stencils.fill_linear(merged, linear_distance))
    smoothed = checkpoints.cut(stencils.smooth_steep_cells(filled, width))
    return stencils.fill_nearest(smoothed, nearest_distance)


def cycle(national: DataFrame, regional: DataFrame, cells: DataFrame, by: Sequence[str] = ("slot",)) -> tuple[DataFrame, DataFrame]:
    """Cleaned stations of any number of slots -> (station tables, grids), both with source_type; all slots are one job."""
    both = {"national": False, "national_and_regional": True}
    tables = {k: visibility.estimate(national, regional, combined, by).withColumn("source_type", F.lit(k)) for k, combined in both.items()}
    stations = checkpoints.cut(tables["national"].unionByName(tables["national_and_regional"]))
    slotted = stations.select(*by).distinct().crossJoin(cells)
    found = None
    for k in both:
        one = visibility.interpolate(slotted, stations.where(F.col("source_type") == k), by=by).withColumn("source_type", F.lit(k))
        found = one if found is None else found.unionByName(one)
    return stations, found


def verify(stations: DataFrame, products: DataFrame, by: Sequence[str] = ("model", "slot"), station_by: Sequence[str] = ("station_type",), step: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Observed stations against gridded products (r, c, lat, lon, km and the by columns, all on one lattice) -> (detail, scores)."""
    lattice = products.select("r", "c", "lat", "lon").distinct()
    located = grids.nearest_cells(cleaning.usable(stations, True), lattice, ("r", "c"), step)
    shared = [c for c in by if c in stations.columns]
    pairs = located.join(products.select(F.col("r").alias("cell_r"), F.col("c").alias("cell_c"), "km", *by), ["cell_r", "cell_c", *shared])
    detail = scoring.errors(pairs.withColumn("obs", scoring.to_km(F.col("vis"))).withColumnRenamed("km", "fc"))
    return detail, scoring.scores(detail, (*by, *station_by))


def replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream through five-minute windows behind a 30-minute watermark, run until nothing is left: (slot, n_rows)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    name = f"skyweft_{uuid.uuid4().hex}"
    root = f"{checkpoints.shared_folder(spark)}/{name}"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/event[s].parquet")
    counted = slots.stream_counts(slots.as_utc(stream, "ts")).select(F.unix_timestamp("slot").alias("slot"), "n_rows")

    def keep(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    query = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    # an updated window replaces what an earlier batch said
    rows = spark.read.schema("slot bigint, n_rows bigint, batch bigint").parquet(f"{root}/out")
    return rows.groupBy("slot").agg(F.max_by("n_rows", "batch").alias("n_rows"))
