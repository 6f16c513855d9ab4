"""Estimation of missing visibility, and anisotropic inverse-distance interpolation onto a grid."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .. import checkpoints
from ..functions.geo import EARTH_KM, TINY, aniso_km, degree_weight, geo_km, humidity_weight, power_weight
from ..functions.nearest import SLACK
from .cleaning import first_wins, usable
from .neighbours import MAX_STATIONS, SIZES, many, nearest_in_batches, nearest_of_any, nearest_stations

STATION_COLUMNS = ("code", "lon", "lat", "altitude", "rh", "vis", "vis_rh", "vis_dis", "is_vis_est")


def _weighted(near: Column, weight, keep=lambda x: F.lit(True)) -> Column:
    """Sum of weight * vis over sum of weight, NULL over nothing."""
    start = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))

    def add(t: Column, x: Column) -> Column:
        w = weight(x)
        return F.struct((t["a"] + w * x["s"]["vis"]).alias("a"), (t["b"] + w).alias("b"))

    return F.aggregate(F.filter(near, keep), start, add, lambda t: F.try_divide(t["a"], t["b"]))


def estimates(targets: DataFrame, reference: DataFrame, k: int = 4, by: Sequence[str] = (), legacy: bool = False) -> DataFrame:
    """targets with vis, vis_rh and vis_dis from the k nearest reference stations: means weighted by humidity and by distance, and half of each, or
    the one there is. legacy: neighbours without humidity or visibility are chosen first and then left out, instead of never chosen."""
    found = nearest_of_any(targets, reference, k, ("vis", "rh"), by)
    has_vis = lambda x: x["s"]["vis"].isNotNull()
    has_both = (lambda x: x["s"]["vis"].isNotNull() & x["s"]["rh"].isNotNull()) if legacy else has_vis
    humid = _weighted(F.col("near"), lambda x: humidity_weight(F.col("rh"), x["s"]["rh"]), has_both)
    by_distance = _weighted(F.col("near"), lambda x: degree_weight(x["d"]), has_vis)
    made = found.withColumn("vis_rh", humid).withColumn("vis_dis", by_distance).drop("near")
    return made.withColumn("vis", F.coalesce(0.5 * F.col("vis_rh") + 0.5 * F.col("vis_dis"), "vis_rh", "vis_dis")).withColumn("is_vis_est", F.lit(1))


def estimate(national: DataFrame, regional: DataFrame, combined: bool, by: Sequence[str] = (), legacy: bool = False) -> DataFrame:
    """The station table: observed reference stations, then regional ones with estimated visibility; of equal codes the first. combined: regional
    stations that have visibility are references too (and so never estimated)."""
    reference = usable(national, with_vis=not legacy)
    targets = usable(regional, with_vis=False)
    if combined:
        own = usable(regional, with_vis=True)
        reference = reference.unionByName(own, allowMissingColumns=True)
        targets = targets.where(F.col("vis").isNull())  # the others' estimates would lose against their own observations
    observed = reference.withColumns({"vis_rh": F.lit(None).cast("double"), "vis_dis": F.lit(None).cast("double"), "is_vis_est": F.lit(0)})
    made = estimates(targets, reference, by=by, legacy=legacy)
    return first_wins([observed, made], "code", ("seq",), by).select(*by, "seq", *STATION_COLUMNS)


def leave_one_out(stations: DataFrame, k: int = 4) -> DataFrame:
    """An extension: each observed station's visibility estimated from the others, with the error."""
    known = usable(stations, with_vis=True)
    found = nearest_stations(known, known, k + 1, ("vis", "rh"))
    others = F.slice(F.filter("near", lambda x: x["s"]["seq"] != F.col("seq")), 1, k)
    found = found.withColumn("near", others)
    humid = _weighted(F.col("near"), lambda x: humidity_weight(F.col("rh"), x["s"]["rh"]))
    made = found.select("seq", "code", F.col("vis").alias("observed"), F.coalesce(0.5 * humid + 0.5 * _weighted(F.col("near"), lambda x: degree_weight(x["d"])), humid).alias("estimated"))
    return made.withColumn("error", F.col("estimated") - F.col("observed"))


def interpolate(cells: DataFrame, stations: DataFrame, beta: float = 10.0, power: float = 2.0, n_neighbors: int = 6, selection: str = "all_candidates", by: Sequence[str] = ()) -> DataFrame:
    """cells (lat, lon, elevation, ...) with a column v: visibility by anisotropic inverse-distance weights.

    The 2 * n_neighbors stations nearest in degrees are the candidates. selection: "all_candidates" weights them all, "top_n" the n_neighbors best by
    anisotropic distance. Candidates at distance zero are left out; cells without elevation, or without a candidate, have v NULL. Many stations are
    searched and weighted in batches, few by expressions."""
    if selection not in ("all_candidates", "top_n"):
        raise ValueError(f"unknown selection: {selection}")
    valid = stations.na.drop(subset=["lon", "lat", "vis", "altitude"])
    if many(valid, by):
        return _interpolated(cells, valid, beta, power, n_neighbors, selection, by)
    found = nearest_stations(cells, valid, 2 * n_neighbors, ("vis", "altitude"), by, None)

    def distance(x: Column) -> Column:
        s = x["s"]
        return aniso_km(geo_km(F.col("lat"), F.col("lon"), s["lat"], s["lon"]), F.col("elevation"), s["altitude"], beta)

    measured = F.transform("near", lambda x: F.struct(distance(x).alias("d"), x["seq"].alias("seq"), x["s"].alias("s")))
    used = F.filter(measured, lambda x: x["d"].isNotNull() & (x["d"] > 0))
    if selection == "top_n":
        used = F.slice(F.sort_array(used), 1, n_neighbors)
    value = _weighted(used, lambda x: power_weight(x["d"], power))
    return found.withColumn("v", value).drop("near")


def _interpolated(cells: DataFrame, stations: DataFrame, beta: float, power: float, n_neighbors: int, selection: str, by: Sequence[str]) -> DataFrame:
    keep = n_neighbors if selection == "top_n" else None

    def value(own: pa.Table, chosen: np.ndarray, d: np.ndarray, s: pa.StructArray) -> pa.Array:
        lat, lon, height = (pc.cast(own.column(c), pa.float64()).to_numpy() for c in ("lat", "lon", "elevation"))
        table = np.stack([pc.cast(pc.struct_field(s, c), pa.float64()).to_numpy(zero_copy_only=False) for c in ("lat", "lon", "altitude", "vis")], axis=1)
        v = chosen_mean(lat, lon, height, table, chosen, beta, power, keep)
        return pa.array(v, mask=np.isnan(v))

    return nearest_in_batches(cells, stations, 2 * n_neighbors, ("vis", "altitude"), by, StructField("v", DoubleType()), value)


def interpolate_arrow(cells: DataFrame, stations: DataFrame, beta: float = 10.0, power: float = 2.0, n_neighbors: int = 6, selection: str = "all_candidates", max_stations: int = MAX_STATIONS) -> DataFrame:
    """interpolate() with its arithmetic in NumPy, for very large grids: cells pass through as Arrow batches and are never shuffled. The stations of one
    slot go to every task, so their number is checked; beyond max_stations this is interpolate()."""
    if selection not in ("all_candidates", "top_n"):
        raise ValueError(f"unknown selection: {selection}")
    valid = stations.na.drop(subset=["lon", "lat", "vis", "altitude"])
    rows = valid.select("lat", "lon", "altitude", "vis", "seq").limit(max_stations + 1).collect()
    if len(rows) > max_stations:
        return interpolate(cells, stations, beta, power, n_neighbors, selection)
    table = np.array(sorted((tuple(r) for r in rows), key=lambda r: r[4]), float).reshape(-1, 5)[:, :4]
    keep = n_neighbors if selection == "top_n" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lat, lon, height = (b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("lat", "lon", "elevation"))
            v = weighted_mean(lat, lon, height, table, 2 * n_neighbors, beta, power, keep)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(v, mask=np.isnan(v))], names=[*b.schema.names, "v"])

    return cells.na.drop(subset=["lat", "lon"]).mapInArrow(run, cells.select("*", F.lit(None).cast("double").alias("v")).schema)


def weighted_mean(lat: np.ndarray, lon: np.ndarray, height: np.ndarray, stations: np.ndarray, k: int, beta: float, power: float, keep: int | None) -> np.ndarray:
    """The values of cells from stations (lat, lon, altitude, vis, in order of seq), block by block: a block keeps the stations its cells can have among
    their k nearest (see neighbours)."""
    out = np.full(len(lat), np.nan)
    if not len(stations) or not len(lat):
        return out
    size = SIZES[1]
    _, block = np.unique(np.floor(lat / size) * 1e6 + np.floor(lon / size), return_inverse=True)
    order = np.argsort(block, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
        y, x = lat[part], lon[part]
        cy, cx = (y.min() + y.max()) / 2, (x.min() + x.max()) / 2
        far = np.hypot(stations[:, 0] - cy, stations[:, 1] - cx)
        near = stations
        if len(stations) > k:
            near = stations[far <= np.partition(far, k - 1)[k - 1] + 2 * np.hypot(y.max() - cy, x.max() - cx) + SLACK]
        for at in range(0, len(part), max(1, 2_000_000 // len(near))):
            rows = part[at : at + max(1, 2_000_000 // len(near))]
            dy, dx = lat[rows, None] - near[:, 0], lon[rows, None] - near[:, 1]
            chosen = np.argsort(np.sqrt(dy * dy + dx * dx), axis=1, kind="stable")[:, :k]
            out[rows] = chosen_mean(lat[rows], lon[rows], height[rows], near, chosen, beta, power, keep)
    return out


def chosen_mean(lat: np.ndarray, lon: np.ndarray, height: np.ndarray, stations: np.ndarray, chosen: np.ndarray, beta: float, power: float, keep: int | None) -> np.ndarray:
    """The values of cells from the stations chosen for each (places in the table, a row a cell); with keep from as many of them, the best."""
    if keep is not None:
        chosen = np.sort(chosen, axis=1)  # ties by seq
    y, x, z = (a[:, None] for a in (lat, lon, height))
    sy, sx, sz, sv = (stations[:, i][chosen] for i in range(4))
    east = EARTH_KM * np.radians(sx - x) * np.cos(np.radians((y + sy) / 2))
    north = EARTH_KM * np.radians(sy - y)
    up = beta * np.abs(z - sz) / 1000.0
    d = np.sqrt(east * east + north * north + up * up)
    used = d > 0  # False for cells without elevation too
    if keep is not None and d.shape[1] > keep:
        best = np.argsort(np.where(used, d, np.inf), axis=1, kind="stable")[:, :keep]
        d, sv, used = (np.take_along_axis(a, best, axis=1) for a in (d, sv, used))
    w = np.where(used, 1.0 / np.maximum(d, TINY) ** power, 0.0)
    total = w.sum(axis=1)
    return np.divide((w * sv).sum(axis=1), total, out=np.full(len(lat), np.nan), where=total > 0)


def visibility_grid(national: DataFrame, regional: DataFrame, cells: DataFrame, combined: bool, by: Sequence[str] = (), **options) -> DataFrame:
    """The whole chain: estimate the stations, interpolate them onto the grid. The station table is used more than once and small, so it is kept."""
    return interpolate(cells, checkpoints.cut(estimate(national, regional, combined, by)), by=by, **options)
