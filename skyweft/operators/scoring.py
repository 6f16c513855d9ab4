"""Verification of gridded products against observations, and comparison of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_km(metres: Column) -> Column:
    return metres / 1000.0


def km_if_metres(grid: DataFrame, value: str) -> DataFrame:
    """A legacy product's values in km: divided by 1000 if the largest is over 100."""
    top = grid.agg(F.max(value).alias("__top"))
    return grid.crossJoin(F.broadcast(top)).withColumn(value, F.when(F.col("__top") > 100, F.col(value) / 1000.0).otherwise(F.col(value))).drop("__top")


def errors(pairs: DataFrame, observed: str = "obs", forecast: str = "fc") -> DataFrame:
    """pairs with the clipped forecast, error, absolute error and relative error (percent of observations over 0.001)."""
    fc = F.when(F.col(forecast) < 0, 0.0).otherwise(F.col(forecast))
    error = fc - F.col(observed)
    relative = F.when(F.col(observed) > 0.001, 100.0 * F.abs(error) / F.col(observed))
    return pairs.withColumns({forecast: fc, "error": error, "abs_error": F.abs(error), "rel_error": relative})


def scores(detail: DataFrame, by: Sequence[str] = (), observed: str = "obs", forecast: str = "fc") -> DataFrame:
    """Ten scores a group, from errors(): count, means, bias, mae, mse, rmse, population deviation of the error, correlation (NULL if a side is
    constant), mape over the pairs that have one. A NaN forecast makes all but mape NaN; n_missing counts pairs without a forecast."""
    e, x, y = F.col("error"), F.col(observed), F.col(forecast)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return detail.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y.isNull() | F.isnan(y)).alias("n_missing"),
        F.avg(x).alias("mean_obs"),
        F.avg(y).alias("mean_forecast"),
        F.avg(e).alias("bias"),
        F.avg("abs_error").alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.stddev_pop(e).alias("std_error"),
        r.alias("correlation"),
        F.avg(F.nanvl("rel_error", F.lit(None).cast("double"))).alias("mape"),
    )


def mean_of_means(summaries: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Unweighted means over per-slot scores: each slot counts once, however many stations it has."""
    return summaries.groupBy(*by).agg(F.count(F.lit(1)).alias("n_slots"), *(F.avg(c).alias(c) for c in columns))


def distribution(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean, median, sample deviation, extremes and linear quantiles of the present values."""
    present = rows.where(F.col(value).isNotNull() & ~F.isnan(value))
    quantiles = F.percentile(value, F.array(*(F.lit(q) for q in (0.25, 0.5, 0.75, 0.9, 0.95))))
    made = present.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), quantiles.alias("q"))
    return made.select(*by, "n", "mean", "std", "min", "max", *(F.col("q")[i].alias(n) for i, n in enumerate(("q25", "median", "q75", "q90", "q95"))))


def monthly(rows: DataFrame, by: Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """Means by calendar month, one row a metric: (by, month, metric, mean)."""
    means = rows.groupBy(*by, F.date_format(day, "yyyy-MM").alias("month")).agg(*(F.avg(v).alias(v) for v in values))
    return means.unpivot([*by, "month"], list(values), "metric", "mean")


def grid_statistics(grid: DataFrame, value: str) -> DataFrame:
    """Size, coverage, moments and fog bands (km) of a product, in one pass."""
    v, valid, n = F.col(value), F.count(value), F.count(F.lit(1))
    bands = {"dense": v <= 0.05, "heavy": (v > 0.05) & (v <= 0.2), "fog": (v > 0.2) & (v <= 0.5), "mist": (v > 0.5) & (v <= 1)}
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"n_{k}") for k, c in bands.items()]
    shares = [F.try_divide(100.0 * F.count_if(F.coalesce(c, F.lit(False))), valid).alias(f"pct_{k}") for k, c in bands.items()]
    return grid.agg(n.alias("n_cells"), valid.alias("n_valid"), F.try_divide(100.0 * valid, n).alias("valid_percent"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"), *counts, *shares)


def fog_class(km: Column, null_as_clear: bool = False) -> Column:
    """0 up to 1 km, 1 up to 10, else 2; missing is missing, or 2 with null_as_clear."""
    return F.when(km <= 1, 0).when(km <= 10, 1).when(km.isNotNull() | F.lit(null_as_clear), 2)


#: Fixed values: (upper end in km, bins) of the colour scale's linear segments.
COLOUR_SEGMENTS = ((1.0, 64), (10.0, 96), (20.0, 48), (30.0, 48))


def colour_bin(km: Column) -> Column:
    """The colour, 0 to 255, of a visibility: linear within each segment, clipped at both ends."""
    low, first, out = 0.0, 0, None
    for high, n in COLOUR_SEGMENTS:
        bin_ = (F.least(F.greatest(F.floor((km - low) / (high - low) * n), F.lit(0)), F.lit(n - 1)) + first).cast("bigint")
        out = F.when(km < high, bin_) if out is None else out.when(km < high, bin_)
        low, first = high, first + n
    return out.when(km.isNotNull(), F.lit(first - 1).cast("bigint"))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Inside (south, west, north, east), edges included, whichever way an axis runs."""
    south, west, north, east = box
    return lat.between(min(south, north), max(south, north)) & lon.between(min(west, east), max(west, east))


def in_ring(lon: Column, lat: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Strictly inside a closed ring, by ray casting behind a test of its box."""
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if y1 == y2:
            continue
        straddles = (F.lit(y1) > lat) != (F.lit(y2) > lat)
        meets = lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
        crossings = crossings + F.when(straddles & meets, 1).otherwise(0)
    return in_box(lat, lon, (min(ys), min(xs), max(ys), max(xs))) & (crossings % 2 == 1)


def mask(grid: DataFrame, rings: Sequence[Sequence[tuple[float, float]]], value: str) -> DataFrame:
    """grid with the value kept only inside one of the rings."""
    inside = F.lit(False)
    for ring in rings:
        inside = inside | in_ring(F.col("lon"), F.col("lat"), ring)
    return grid.withColumn(value, F.when(inside, F.col(value)))


def band(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """The value if it lies in the band, else missing."""
    return F.when((F.lit(True) if low is None else value > low) & (F.lit(True) if high is None else value <= high), value)


def cumulative(rows: DataFrame, value: str) -> DataFrame:
    """(value, share): the empirical distribution, a row a distinct value. Counts are summed by value first; what is ordered in one
    task is the distinct values' counts per range."""
    from pyspark.sql import Window

    counts = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.withColumn("range", F.floor(F.log10(F.greatest("value", F.lit(1e-6))) * 16))
    before = ranged.groupBy("range").agg(F.sum("n").alias("m")).withColumn("before", F.sum("m").over(Window.orderBy("range")) - F.col("m"))
    total = rows.agg(F.count(value).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("value"))
    return ranged.withColumn("inside", inside).join(F.broadcast(before.select("range", "before")), "range").crossJoin(F.broadcast(total)).select("value", ((F.col("inside") + F.col("before")) / F.col("total")).alias("share"))


def log_bins(rows: DataFrame, value: str, low: float, high: float, bins: int = 29) -> DataFrame:
    """(bin, n): counts over equal steps of the logarithm between low and high."""
    import math

    width = (math.log10(high) - math.log10(low)) / bins
    place = F.least(F.floor((F.log10(value) - math.log10(low)) / width), F.lit(bins - 1)).cast("bigint")
    return rows.where(F.col(value).between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def tally(rows: DataFrame, status: str = "status") -> DataFrame:
    """(status, n)"""
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def estimate_counts(stations: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, n_estimated, n_observed)"""
    return stations.groupBy(*by).agg(F.count_if(F.col("is_vis_est") == 1).alias("n_estimated"), F.count_if(F.col("is_vis_est") == 0).alias("n_observed"))
