"""The queries of the station and grid operators over the driver's tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo
from .operators import cleaning, grids, neighbours, scoring, stencils, terrain, visibility
from .oracles import ORACLES
from .plans import chains
from .sources import station_feed
from .sources.fixtures import RING, table, view
from .streaming import slots

RES = 0.02
BETA = 10.0
DEM = ("id", "r", "c", "lon", "lat", "elevation")
BOX = (21.05, 110.5, 21.3, 111.5)


def _national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_national")


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_regional")


def _dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_dem")


def _km(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid as a visibility product in km, with missing cells."""
    return _dem(spark, sf_dir).select("id", "r", "c", "lat", "lon", (F.col("elevation") / 40.0).alias("km"))


def clean_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "fx_raw_feed")
    return raw.select("seq", cleaning.code(F.col("v_code")).alias("code"), cleaning.number(cleaning.first_present(F.col("v_vis_primary"), F.col("v_vis_secondary"))).alias("vis"), cleaning.number(F.col("v_rh")).alias("rh"), "update_minute")


def clean_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_raw_feed").select("seq", *(cleaning.number(F.col(c)).alias(c) for c in ("v_vis_primary", "v_vis_secondary", "v_rh")))


def clean_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_raw_feed").select("seq", cleaning.number(cleaning.first_present(F.col("v_vis_primary"), F.col("v_vis_secondary"))).alias("vis"))


def code_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_raw_feed").select("seq", cleaning.code(F.col("v_code")).alias("code"))


def dedup_best_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.best_by_quality(clean_feed(spark, sf_dir), "code", ("seq",), "update_minute", ("vis", "rh")).select("code", "seq", "vis", "rh")


def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = clean_feed(spark, sf_dir)
    return cleaning.first_wins([feed.where("vis IS NOT NULL"), feed], "code").select("code", "seq", "vis")


def sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.sample_counts(_national(spark, sf_dir), _regional(spark, sf_dir))


def geo_distance_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = geo.geo_km(F.lit(23.0), F.lit(113.0), F.col("lat"), F.col("lon"))
    return _regional(spark, sf_dir).select("seq", F.round(d, 6).alias("km"))


def aniso_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = geo.aniso_km(geo.geo_km(F.lit(23.0), F.lit(113.0), F.col("lat"), F.col("lon")), F.lit(100.0), F.col("altitude"), BETA)
    return _regional(spark, sf_dir).select("seq", F.round(d, 6).alias("km"), F.round(geo.power_weight(d), 9).alias("weight"))


def knn4_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = cleaning.usable(_regional(spark, sf_dir), with_vis=False)
    found = neighbours.nearest_stations(targets, cleaning.usable(_national(spark, sf_dir), with_vis=True), 4, ("code",))
    flat = found.select("seq", F.posexplode("near").alias("i", "n"))
    return flat.select("seq", (F.col("i") + 1).cast("bigint").alias("rank"), F.col("n.seq").alias("station"), F.round("n.d", 9).alias("d"))


def _estimate(spark: SparkSession, sf_dir: str, combined: bool) -> DataFrame:
    made = visibility.estimate(_national(spark, sf_dir), _regional(spark, sf_dir), combined)
    return made.select("code", F.round("vis", 3).alias("vis"), F.round("vis_rh", 3).alias("vis_rh"), F.round("vis_dis", 3).alias("vis_dis"), F.col("is_vis_est").cast("bigint").alias("is_vis_est"))


def estimate_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _estimate(spark, sf_dir, False)


def estimate_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _estimate(spark, sf_dir, True)


def _idw(spark: SparkSession, sf_dir: str, stations: DataFrame, selection: str) -> DataFrame:
    return visibility.interpolate(_dem(spark, sf_dir), stations, selection=selection).select("id", "r", "c", F.round("v", 3).alias("v"))


def idw_all_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _idw(spark, sf_dir, _national(spark, sf_dir), "all_candidates")


def idw_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _idw(spark, sf_dir, _national(spark, sf_dir), "top_n")


def _idw_arrow(spark: SparkSession, sf_dir: str, selection: str) -> DataFrame:
    return visibility.interpolate_arrow(_dem(spark, sf_dir), _national(spark, sf_dir), selection=selection).select("id", "r", "c", F.round("v", 3).alias("v"))


def idw_all_candidates_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _idw_arrow(spark, sf_dir, "all_candidates")


def idw_top_n_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _idw_arrow(spark, sf_dir, "top_n")


def pipeline_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visibility.visibility_grid(_national(spark, sf_dir), _regional(spark, sf_dir), _dem(spark, sf_dir), False).select("id", "r", "c", F.round("v", 3).alias("v"))


def pipeline_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visibility.visibility_grid(_national(spark, sf_dir), _regional(spark, sf_dir), _dem(spark, sf_dir), True).select("id", "r", "c", F.round("v", 3).alias("v"))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.nearest_cells(cleaning.usable(_national(spark, sf_dir), True), _dem(spark, sf_dir), step=RES)


def nearest_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir).select("seq", F.col("cell_r").alias("r"), F.col("cell_c").alias("c"), F.col("cell_elevation").alias("value"))


def verify_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _located(spark, sf_dir).select("seq", scoring.to_km(F.col("vis")).alias("obs"), (F.col("cell_elevation") / 100.0 - 1.0).alias("fc"))
    made = scoring.errors(pairs.where("fc IS NOT NULL"))
    return made.select("seq", *(F.round(c, 6).alias(c) for c in ("obs", "fc", "error", "abs_error", "rel_error")))


SCORES = ("mean_obs", "mean_forecast", "bias", "mae", "mse", "rmse", "std_error", "correlation", "mape")


def verify_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = scoring.scores(scoring.errors(view(spark, sf_dir, "fx_pairs")), ("model", "station_type"))
    return made.select("model", "station_type", "n", *(F.round(c, 6).alias(c) for c in SCORES))


def summary_mean_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = scoring.scores(scoring.errors(view(spark, sf_dir, "fx_pairs")), ("model", "station_type", "dt"))
    made = scoring.mean_of_means(slot, ("model", "station_type"), ("bias", "mae", "rmse"))
    return made.select("model", "station_type", "n_slots", *(F.round(c, 6).alias(c) for c in ("bias", "mae", "rmse")))


def model_boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = scoring.distribution(scoring.errors(view(spark, sf_dir, "fx_pairs")), ("model", "station_type"), "error")
    return made.select("model", "station_type", "n", *(F.round(c, 9).alias(c) for c in ("mean", "std", "min", "max", "q25", "median", "q75", "q90", "q95")))


def model_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = scoring.monthly(scoring.errors(view(spark, sf_dir, "fx_pairs")), ("model", "station_type"), "dt", ("error", "abs_error"))
    return made.withColumn("mean", F.round("mean", 9))


def grid_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = grids.target_grid(spark, 110.0, 21.0, 110.5, 21.2, 0.01)
    return made.select("r", "c", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


def _resample_target(spark: SparkSession) -> DataFrame:
    return grids.target_grid(spark, 109.955, 20.957, 111.0, 21.5, 0.03)


def fast_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.nearest_resample(_dem(spark, sf_dir), _resample_target(spark), step=RES).select("r", "c", "elevation")


def block_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = grids.target_grid(spark, 110.005, 21.005, 111.9, 21.39, 0.05)
    return grids.block_average(_dem(spark, sf_dir), target, 0.05, step=RES).select("r", "c", F.round("elevation", 6).alias("elevation"))


def linear_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = grids.target_grid(spark, 110.003, 21.007, 111.0, 21.3, 0.033)
    return grids.between(_dem(spark, sf_dir), target, step=RES).select("r", "c", F.round("elevation", 6).alias("elevation"))


def cubic_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = grids.target_grid(spark, 110.003, 21.007, 111.0, 21.3, 0.033)
    return grids.between(_dem(spark, sf_dir), target, "cubic", step=RES).select("r", "c", F.round("elevation", 6).alias("elevation"))


def method_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What nearest and block resampling make of one target."""
    target = grids.target_grid(spark, 110.005, 21.005, 111.9, 21.39, 0.05)
    made = grids.compare_methods(_dem(spark, sf_dir), target, 0.05, ("fast_nearest", "block_average"))
    return made.select("method", "n_valid", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean")))


def point_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.at_points(_national(spark, sf_dir), _dem(spark, sf_dir).select("r", "c", "id"), ["id"], 109.99, 20.99, RES).select("seq", F.col("id").cast("double").alias("cell"))


def tile_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = grids.tile_boxes(view(spark, sf_dir, "fx_tiles"))
    return made.select(F.col("tile_id").cast("bigint").alias("tile_id"), *(F.round(c, 6).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")), "n_cells")


def _pairs(spark: SparkSession, sf_dir: str, adjacent: str) -> DataFrame:
    made = grids.tile_relations(grids.tile_boxes(view(spark, sf_dir, "fx_tiles")), 0.04, adjacent)
    return made.select(F.col("tile_a").cast("bigint").alias("tile_a"), F.col("tile_b").cast("bigint").alias("tile_b"), "relation", F.round("lat_gap", 6).alias("lat_gap"), F.round("lon_gap", 6).alias("lon_gap"))


def tile_gap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "both")


def tile_gap_pairs_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "either")


def unified_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "fx_tiles")
    made = None
    for axis in ("lat", "lon"):
        one = grids.unified_axis(cells, axis, RES).select(F.lit(axis).alias("axis"), "key", F.round("position", 6).alias("position"), "index")
        made = one if made is None else made.unionByName(one)
    return made


def axis_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.min_spacing(grids.unified_axis(view(spark, sf_dir, "fx_tiles"), "lon", RES)).select(F.round("min_spacing", 6).alias("min_spacing"))


def overlap_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.merge_tiles(view(spark, sf_dir, "fx_tiles"), RES).select("r", "c", F.round("elevation", 6).alias("elevation"), "n")


def tile_strict_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = view(spark, sf_dir, "fx_tiles")
    return grids.strict_merge(tiles.where("tile_id = 1"), tiles.where("tile_id = 2")).select("r", "c", "elevation", "conflict")


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = grids.coverage(grids.densify(grids.merge_tiles(view(spark, sf_dir, "fx_tiles"), RES)))
    return made.withColumn("valid_percent", F.round("valid_percent", 6))


def fill_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.fill_nearest(_dem(spark, sf_dir), 3).select("r", "c", "elevation")


def fill_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.fill_neighbourhood(_dem(spark, sf_dir), 1).select("r", "c", F.round("elevation", 6).alias("elevation"))


def sobel_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.sobel(_dem(spark, sf_dir)).select("r", "c", F.round("gradient", 6).alias("gradient"))


def tpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.tpi(_dem(spark, sf_dir), 5).select("r", "c", F.round("tpi", 6).alias("tpi"))


def tpi_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.tpi(_dem(spark, sf_dir), 11).select("r", "c", F.round("tpi", 6).alias("tpi"))


def _thresholds(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    return terrain.thresholds(stencils.tpi(_dem(spark, sf_dir), 5), method).select(F.round("low", 5).alias("low"), F.round("high", 5).alias("high"))


def tpi_thresholds_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "quantile")


def tpi_thresholds_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "zscore")


def tpi_thresholds_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "mad")


def tpi_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stencils.tpi(_dem(spark, sf_dir), 5)
    limits = terrain.thresholds(cells, "zscore")
    return terrain.classify(cells, limits).select("r", "c", F.col("cls").cast("bigint").alias("cls"))


def tpi_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terrain.ridges_and_valleys(_dem(spark, sf_dir), 5, "zscore").select("r", "c", F.col("cls").cast("bigint").alias("cls"), "block_id")


def fog_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = F.col("km") - 0.9
    return _km(spark, sf_dir).select("id", scoring.fog_class(km).cast("double").alias("fog"), scoring.fog_class(km, True).cast("double").alias("fog_clear"), F.round(scoring.band(km, 1, 10), 6).alias("haze"))


def fog_band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _km(spark, sf_dir).withColumn("km", F.col("km") / 10)
    made = scoring.grid_statistics(cells, "km")
    return made.select("n_valid", *(F.col(f"n_{b}") for b in ("dense", "heavy", "fog", "mist")), *(F.round(f"pct_{b}", 6).alias(f"pct_{b}") for b in ("dense", "heavy", "fog", "mist")))


def grid_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = scoring.grid_statistics(_km(spark, sf_dir), "km")
    return made.select("n_cells", "n_valid", *(F.round(c, 5).alias(c) for c in ("valid_percent", "min", "max", "mean", "median", "std")))


def color_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _km(spark, sf_dir).select("id", scoring.colour_bin(F.col("km")).cast("double").alias("bin"))


def bbox_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dem(spark, sf_dir).where(scoring.in_box(F.col("lat"), F.col("lon"), BOX)).select("id", "elevation")


def polygon_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.mask(_dem(spark, sf_dir), [RING], "elevation").select("id", "elevation")


def value_cdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.cumulative(_national(spark, sf_dir), "vis").select("value", F.round("share", 9).alias("share"))


def value_log_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.log_bins(_national(spark, sf_dir), "vis", 100.0, 100_000.0)


def method_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = visibility.estimates(cleaning.usable(_regional(spark, sf_dir), False), cleaning.usable(_national(spark, sf_dir), True))
    r = F.try_divide(F.covar_pop("vis_rh", "vis_dis"), F.stddev_pop("vis_rh") * F.stddev_pop("vis_dis"))
    return made.agg(F.count("vis_rh").alias("n"), F.round(r, 6).alias("correlation"))


def leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visibility.leave_one_out(_national(spark, sf_dir)).select("seq", F.round("estimated", 3).alias("estimated"), (F.round("error", 3) + 0.0).alias("error"))


def estimate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.estimate_counts(visibility.estimate(_national(spark, sf_dir), _regional(spark, sf_dir), True))


# slots and state


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.as_utc(table(spark, sf_dir, "events"), "ts")


def _epoch(name: str):
    return F.unix_timestamp(name).alias(name)


def slot5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.slot_counts(_events(spark, sf_dir)).select(_epoch("slot"), "n_rows", "n_stations")


def slot_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rescan window of a cycle at each hour of the first day that has events."""
    first = _events(spark, sf_dir).agg(F.min(F.unix_timestamp("ts"))).first()[0]
    times = [datetime.fromtimestamp(first // 86400 * 86400 + h * 3600 + 137, UTC) for h in range(24)]
    rows = [(int(now.timestamp()), int(slot.timestamp())) for now in times for slot in slots.window_times(now)]
    return spark.createDataFrame(rows, "now bigint, slot bigint")


def hourly_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.slot_range(spark, datetime(2024, 1, 1), datetime(2024, 1, 3)).select(_epoch("slot"))


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy(slots.floor_slot(F.col("ts"), 3600).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def anti_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _hours(spark, sf_dir)
    return slots.unpublished(hours, hours.where(F.unix_timestamp("slot") / 3600 % 3 == 0)).select(_epoch("slot"), "n")


def growth_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours whose counts of two stations' groups have grown over a state that has seen the first half of each hour."""
    hour = slots.floor_slot(F.col("ts"), 3600)
    minute = F.unix_timestamp("ts") % 3600 / 60
    counts = lambda rows: rows.groupBy(hour.alias("slot")).agg(F.create_map(F.lit("even"), F.count_if(F.col("user_id") % 2 == 0), F.lit("odd"), F.count_if(F.col("user_id") % 2 == 1)).alias("counts"))
    events = _events(spark, sf_dir)
    before = counts(events.where(minute < 30)).select("slot", F.col("counts").alias("last_processed"))
    found = slots.to_process(counts(events), before.where(F.unix_timestamp("slot") / 3600 % 4 != 0))
    return found.select(_epoch("slot"), F.col("counts")["even"].alias("even"), F.col("counts")["odd"].alias("odd"))


def queue_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.unix_timestamp("slot") / 3600
    status = F.when(hour % 5 == 0, "done").when(hour % 7 == 0, "processing").when(hour % 3 == 0, "failed").otherwise("pending")
    queue = _hours(spark, sf_dir).select("slot", status.alias("status"), F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error"))
    return slots.claim(queue, None, 10)[1].select(_epoch("slot"), "status", F.col("attempts").cast("bigint").alias("attempts"))


def status_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.tally(queue_claim(spark, sf_dir))


def late_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).withColumn("arrived", F.timestamp_seconds(F.unix_timestamp("ts") + F.col("event_id") * 7919 % 3600))
    return slots.late_rescan(rows).select(_epoch("slot"), "n_on_time", "n_late", "n_dropped", "recomputed")


def slot_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot arithmetic: floor, ceiling, 6-hourly flag."""
    day = _events(spark, sf_dir).select("event_id", "ts")
    return day.select("event_id", F.unix_timestamp(slots.floor_slot(F.col("ts"))).alias("lo"), F.unix_timestamp(slots.ceil_slot(F.col("ts"))).alias("hi"), slots.six_hourly(F.col("ts")).alias("six_hourly"))


def slot_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot's names (key, local time, folder), and its delay if it came out an hour after the event."""
    slot = slots.floor_slot(F.col("ts"))
    out = F.timestamp_seconds(F.unix_timestamp("ts") + F.col("event_id") % 7200 - 3600)
    return _events(spark, sf_dir).select("event_id", slots.time_key(slot).alias("key"), slots.beijing(slot).alias("local"), slots.path_parts(slot).alias("folder"), slots.delay_seconds(out, F.col("ts")).alias("delay"))


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hours(spark, sf_dir).select("slot", "n", (F.unix_timestamp("slot") / 3600).cast("bigint").alias("hour"))


def state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state of every second hour, and changes to every third: a success, a failure or only a look."""
    counted = _counted(spark, sf_dir)
    before = counted.where("hour % 2 = 0").select("slot", F.create_map(F.lit("n"), F.col("n") - 1).alias("last_seen"), F.create_map(F.lit("n"), F.col("n") - 2).alias("last_processed"), F.lit("seen").alias("status"), F.lit("old").alias("error"))
    status = F.element_at(F.array(F.lit("success"), F.lit("failed"), F.lit("seen")), (F.col("hour") / 3 % 3).cast("int") + 1)
    changes = counted.where("hour % 3 = 0").select("slot", F.when(F.col("hour") % 5 != 0, F.create_map(F.lit("n"), F.col("n"))).alias("counts"), status.alias("status"), F.lit("new").alias("error"))
    merged = slots.merge_state(before, changes)
    text = lambda c: slots.json_counts(slots.parse_counts(slots.json_counts(F.col(c))))
    return merged.select(_epoch("slot"), text("last_seen").alias("last_seen"), text("last_processed").alias("last_processed"), "status", "error")


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.col("hour")
    status = F.when(hour % 5 == 0, "done").when(hour % 7 == 0, "processing").when(hour % 3 == 0, "failed").otherwise("pending")
    return _counted(spark, sf_dir).where("hour % 11 <> 0").select("slot", status.alias("status"), F.lit(1).alias("attempts"), F.lit("e").alias("error"))


def queue_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue to which every second hour is added, those it has not among them."""
    return slots.enqueue(_queue(spark, sf_dir), _counted(spark, sf_dir).where("hour % 2 = 0")).select(_epoch("slot"), "status", F.col("attempts").cast("bigint").alias("attempts"), "error")


def queue_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _counted(spark, sf_dir).where("hour % 7 = 0").select("slot", (F.col("hour") % 2 == 0).alias("success"), F.when(F.col("hour") % 2 != 0, "broken").alias("error"))
    return slots.queue_result(_queue(spark, sf_dir), results).select(_epoch("slot"), "status", F.col("attempts").cast("bigint").alias("attempts"), "error")


def work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each hour in the order of work: hours after the twelfth are new, the others backlog."""
    counted = _counted(spark, sf_dir)
    order = slots.order_of_work(counted.where("hour % 24 > 12"), counted.where("hour % 24 <= 12"))
    places = [(r.slot, i) for i, r in enumerate(order.collect())]  # a row a slot: some hundred thousand for a year
    return spark.createDataFrame(places, "slot timestamp, place bigint").select(_epoch("slot"), "place")


def month_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = scoring.monthly(scoring.errors(view(spark, sf_dir, "fx_pairs")), ("model", "station_type"), "dt", ("error",))
    return slots.month_over_month(means, ("model", "station_type")).select("model", "station_type", "month", F.round("mean", 9).alias("mean"), (F.round("change", 8) + 0.0).alias("change"))


def marker_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_raw_feed").select((F.col("seq") % 50).alias("part"), F.when(F.col("seq") % 77 != 5, F.col("update_minute")).alias("m"))
    return rows.groupBy("part").agg(cleaning.marker_sum(F.col("m")).cast("double").alias("marker"))


def union_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that stations and events share under their names, from both."""
    stations = _national(spark, sf_dir).select("seq", "lat", "vis", "rh")
    return cleaning.common_union(stations, _regional(spark, sf_dir).select("vis", "altitude", "seq")).select("seq", "vis")


def not_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _dem(spark, sf_dir).withColumn("v", F.col("elevation") - 700)
    return cells.select("id", F.when(F.col("v") == 0, 0.0).otherwise(scoring.band(F.col("v"), 0)).alias("v"))


def request_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests of their hour, their values as seconds, one in nine failed."""
    asked = _events(spark, sf_dir).select(slots.floor_slot(F.col("ts"), 3600).alias("slot"), F.floor(F.abs("value")).alias("seconds"), F.when(F.col("event_id") % 9 == 4, "x").alias("error"))
    made = station_feed.request_timings(asked)
    return made.select(_epoch("slot"), "n_requests", "n_errors", F.col("longest_seconds").cast("double").alias("longest_seconds"), F.col("total_seconds").cast("double").alias("total_seconds"))


def latest_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest update of each hundred rows of the feed, in the formats that services use."""
    minute = F.format_string("2024-01-01 00:%02d:00", "update_minute")
    said = F.when(F.col("seq") % 5 == 0, F.replace(minute, F.lit("-"), F.lit("/"))).when(F.col("seq") % 7 == 0, "soon").otherwise(minute)
    rows = view(spark, sf_dir, "fx_raw_feed").select(F.floor(F.col("seq") / 100).cast("bigint").alias("part"), said.alias(cleaning.UPDATE_FIELD))
    return station_feed.latest_update(rows, ("part",)).select("part", F.unix_timestamp("latest_update").alias("updated"))


def feed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses made of the raw feed, a hundred stations each, one in seven without a field: read, cleaned, the best row a code."""
    raw = view(spark, sf_dir, "fx_raw_feed").where("v_code IS NOT NULL").withColumn("part", F.floor(F.col("seq") / 100).cast("bigint"))
    line = F.concat_ws(",", "v_code", F.lit("n"), F.lit("c"), F.lit("d"), F.lit("113"), F.lit("23"), F.lit("10"), "v_rh", "v_vis_primary", "v_vis_secondary", F.format_string("2024-01-01 00:%02d:00", "update_minute"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n")
    wire = ",".join(station_feed.WIRE_FIELDS)
    head = F.when(F.col("part") % 7 == 3, wire.replace(cleaning.VISIBILITY_FIELDS["national"], "other", 1)).otherwise(wire)
    made = raw.groupBy("part").agg(F.count(F.lit(1)).alias("n"), lines.alias("lines"))
    responses = made.select("part", F.col("part").cast("string").alias("source"), F.concat_ws("\n", F.col("n").cast("string"), F.lit(""), head, "lines").alias("body"), F.lit(None).cast("string").alias("error"))
    read = station_feed.parsed(responses, "national")
    best = station_feed.clean(read, "national", ["part"])
    counted = station_feed.batch_summary(read, ("part",)).select("part", "n_rows", F.col("marker").cast("double").alias("marker"), "n_errors")
    return counted.join(best.groupBy("part").agg(F.count("code").cast("double").alias("n_codes"), F.count("vis").cast("double").alias("n_vis"), F.sum("vis").alias("vis"), F.sum("rh").alias("rh")), "part", "left")


def chain_dem_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.build_dem(view(spark, sf_dir, "fx_tiles"), RES).select("r", "c", F.round("elevation", 6).alias("elevation"))


def fill_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.fill_linear(_dem(spark, sf_dir), 3).select("r", "c", F.round("elevation", 6).alias("elevation"))


def gaussian_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.gaussian(_dem(spark, sf_dir), 0.8).select("r", "c", F.round("smooth", 6).alias("smooth"))


def smooth_steep_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.smooth_steep_cells(_dem(spark, sf_dir)).select("r", "c", F.round("elevation", 6).alias("elevation"))


def dilation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _dem(spark, sf_dir).withColumn("high", F.coalesce(F.col("elevation") > 1450, F.lit(False)))
    return stencils.dilate(flagged, "high", 2).select("r", "c", "dilated")


def stream_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.replay_events(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    clean_feed, clean_sentinels, clean_fallback, code_normalize, dedup_best_quality, dedup_first_wins, sample_counts, geo_distance_km, aniso_distance,
    knn4_stations, estimate_national, estimate_combined, idw_all_candidates, idw_top_n, idw_all_candidates_arrow, idw_top_n_arrow, pipeline_national, pipeline_combined, nearest_cell, verify_detail, verify_stats,
    summary_mean_of_means, model_boxplot_stats, model_monthly, grid_target, fast_nearest, block_average, linear_resample, cubic_resample, method_comparison, point_cells, tile_bbox, tile_gap_pairs, tile_gap_pairs_corrected,
    unified_axes, axis_spacing, overlap_average, tile_strict_merge, coverage_report, fill_nearest, fill_neighborhood, fill_linear, sobel_gradient, tpi, tpi_wide,
    tpi_thresholds_quantile, tpi_thresholds_zscore, tpi_thresholds_mad, tpi_class, tpi_blocks, fog_classes, fog_band_stats, grid_stats, color_bins, bbox_mask,
    polygon_mask, value_cdf, value_log_bins, method_correlation, leave_one_out, estimate_counts, slot5_counts, slot_window, hourly_slots, anti_published, growth_filter, queue_claim, status_tally,
    late_rescan, slot_fields, slot_texts, state_merge, queue_enqueue, queue_results, work_order, month_trend, marker_sums, union_common, not_negative, request_timings, latest_update, feed_tables, chain_dem_build, gaussian_smooth, smooth_steep_cells, dilation, stream_slots,
)}

__all__ = ["ORACLES", "QUERIES"]
