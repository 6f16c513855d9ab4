import json
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyweft.operators import grids, scoring, stencils, terrain
from skyweft.plans import chains
from skyweft.sources import rasters

CELLS = "r bigint, c bigint, elevation double"


def frame(spark, a):
    return spark.createDataFrame([(int(r), int(c), None if np.isnan(a[r, c]) else float(a[r, c])) for r in range(a.shape[0]) for c in range(a.shape[1])], CELLS)


def array(df, shape, value):
    out = np.full(shape, np.nan)
    for r, c, v in df.select("r", "c", value).collect():
        out[r, c] = np.nan if v is None else v
    return out


def random_grid(seed, shape, missing=0.2):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 500, shape).astype(float)
    a[rng.random(shape) < missing] = np.nan
    return a


arrays = given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 9))
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@arrays
def test_tpi(spark, seed, h, w):
    a = random_grid(seed, (h, w))
    got = array(stencils.tpi(frame(spark, a), 5), a.shape, "tpi")
    p = np.pad(a, 2, mode="edge")
    for r in range(h):
        for c in range(w):
            box = p[r : r + 5, c : c + 5].copy()
            box[2, 2] = np.nan
            want = a[r, c] - np.nanmean(box) if np.isfinite(box).any() else np.nan
            # copies of the centre at an edge count as others
            assert (np.isnan(want) and np.isnan(got[r, c])) or got[r, c] == pytest.approx(want, abs=1e-9)


def test_tpi_of_a_constant_grid_is_zero_and_ignores_shifts(spark):
    a = np.full((6, 7), 5.0)
    assert np.abs(array(stencils.tpi(frame(spark, a), 3), a.shape, "tpi")).max() == 0
    b = random_grid(1, (6, 7), 0)
    assert np.allclose(array(stencils.tpi(frame(spark, b), 3), b.shape, "tpi"), array(stencils.tpi(frame(spark, b + 100), 3), b.shape, "tpi"))


def smooth(a, weights):
    radius = max(weights)
    out = a
    for axis in (0, 1):
        widths = [(radius, radius) if i == axis else (0, 0) for i in (0, 1)]
        p = np.pad(out, widths, mode="symmetric")
        out = sum(w * np.take(p, range(radius + d, radius + d + a.shape[axis]), axis=axis) for d, w in weights.items())
    return out


@few
@arrays
def test_gaussian(spark, seed, h, w):
    a = random_grid(seed, (h, w))
    weights = stencils.gaussian_weights(0.8)
    zero = array(stencils.gaussian(frame(spark, a), 0.8, missing="zero"), a.shape, "smooth")
    assert np.allclose(zero, smooth(np.nan_to_num(a), weights))
    if np.isfinite(a).any():
        mean = array(stencils.gaussian(frame(spark, a), 0.8), a.shape, "smooth")
        share = smooth(np.isfinite(a).astype(float), weights)
        with np.errstate(invalid="ignore"):
            want = np.where(share > 0, smooth(np.nan_to_num(a), weights) / share, np.nan)
        assert np.allclose(mean, want, equal_nan=True)


@few
@arrays
def test_dilation_and_sobel(spark, seed, h, w):
    a = random_grid(seed, (h, w), 0.1)
    flagged = frame(spark, a).withColumn("f", F.coalesce(F.col("elevation") > 400, F.lit(False)))
    got = array(stencils.dilate(flagged, "f", 2).withColumn("dilated", F.col("dilated").cast("double")), a.shape, "dilated")
    hot = np.argwhere(np.nan_to_num(a) > 400)
    for r in range(h):
        for c in range(w):
            assert got[r, c] == float(any(abs(r - y) + abs(c - x) <= 2 for y, x in hot))
    gradient = array(stencils.sobel(frame(spark, a)), a.shape, "gradient")
    p = np.pad(a, 1, mode="symmetric")
    s = np.array([1, 2, 1])
    for r in range(h):
        for c in range(w):
            box = p[r : r + 3, c : c + 3]
            want = np.hypot((s * (box[2] - box[0])).sum(), (s * (box[:, 2] - box[:, 0])).sum()) if np.isfinite(box).all() else np.nan
            assert (np.isnan(want) and np.isnan(gradient[r, c])) or gradient[r, c] == pytest.approx(want)


@pytest.mark.parametrize("fill", [lambda g: stencils.fill_nearest(g, 3), lambda g: stencils.fill_linear(g, 3), lambda g: stencils.fill_neighbourhood(g, 2)])
def test_filling_leaves_present_cells_and_fills_near_ones(spark, fill):
    a = np.add.outer(np.arange(12.0), np.arange(12.0))
    a[4:7, 4:7] = np.nan
    a[:, 11] = np.nan
    got = array(fill(frame(spark, a)), a.shape, "elevation")
    assert np.array_equal(got[np.isfinite(a)], a[np.isfinite(a)])
    assert np.isfinite(got).all()


def test_linear_fill_is_exact_on_a_plane(spark):
    a = np.add.outer(np.arange(9.0), 2 * np.arange(9.0))
    b = a.copy()
    b[3:6, 3:6] = np.nan
    assert np.allclose(array(stencils.fill_linear(frame(spark, b), 5), a.shape, "elevation"), a)


def test_steep_cells_are_smoothed_and_missing_ones_stay(spark):
    a = np.zeros((20, 20))
    a[:, 10:] = 100
    a[0, 0] = np.nan
    got = array(stencils.smooth_steep_cells(frame(spark, a), 1, percentile=0.9), a.shape, "elevation")
    assert np.isnan(got[0, 0])
    assert got[10, 3] == 0 and 0 < got[10, 9] < 100


def flood(mask):
    labels, n = np.zeros(mask.shape, int), 0
    for r, c in np.argwhere(mask):
        if labels[r, c]:
            continue
        n += 1
        todo = [(r, c)]
        while todo:
            y, x = todo.pop()
            if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not labels[y, x]:
                labels[y, x] = n
                todo += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return labels


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.floats(0.1, 0.7))
def test_blocks_are_those_of_a_flood_fill(spark, seed, share):
    mask = np.random.default_rng(seed).random((9, 11)) < share
    cells = spark.createDataFrame([(int(r), int(c), int(mask[r, c])) for r in range(9) for c in range(11)], "r bigint, c bigint, cls int")
    got = np.zeros(mask.shape, int)
    for r, c, label in terrain.label_blocks(cells, 1).select("r", "c", "label").collect():
        got[r, c] = label
    assert np.array_equal(got, flood(mask))


def test_thresholds_and_classes(spark):
    cells = spark.createDataFrame([(i, 0, float(v)) for i, v in enumerate([1, 1, 1, 1])], "r bigint, c bigint, tpi double")
    mad = terrain.thresholds(cells, "mad").first()
    assert mad.low is None and mad.high is None
    assert {r.cls for r in terrain.classify(cells, terrain.thresholds(cells, "mad")).collect()} == {0}
    assert {r.cls for r in terrain.classify(cells, terrain.thresholds(cells)).collect()} == {1}  # a tie is a ridge
    with pytest.raises(ValueError):
        terrain.thresholds(cells, "other")
    assert [terrain.window_size(m, 30) for m in (10, 120, 150)] == [3, 5, 5]


def test_chain_gives_blocks_and_outlines(spark):
    a = random_grid(5, (12, 12), 0.05)
    made = terrain.ridges_and_valleys(frame(spark, a), 3, sigma=0.8)
    assert made.where("cls <> 0 AND block_id = 0").count() == 0
    n = terrain.outlines(made).agg(F.sum(F.col("c1") - F.col("c0") + 1)).first()[0]
    assert n == made.where("block_id > 0").count()


def test_tiles_merge_with_the_mean_where_they_overlap(spark):
    rows = [(1, 0.0, 0.0, 10.0), (1, 0.0, 0.02, 20.0), (2, 0.0, 0.0200000001, 40.0), (2, 0.0, 0.04, None)]
    tiles = spark.createDataFrame(rows, "tile_id int, lat double, lon double, elevation double")
    got = {(r.r, r.c): r.elevation for r in grids.merge_tiles(tiles, 0.02).collect()}
    assert got == {(0, 0): 10.0, (0, 1): 30.0, (0, 2): None}


def test_elevation_build_fills_planted_holes(spark):
    rng = np.random.default_rng(0)
    rows = [(t, 21 + r * 0.02, 110 + c * 0.02, float(rng.integers(0, 50))) for t, c0, c1 in ((1, 0, 9), (2, 11, 20)) for r in range(10) for c in range(c0, c1) if (r, c) != (5, 5)]
    tiles = spark.createDataFrame(rows, "tile_id int, lat double, lon double, elevation double")
    built = chains.build_dem(tiles, 0.02)
    assert built.count() == 200 and built.where("elevation IS NULL").count() == 0


def test_axis_sizes_and_target_grid(spark):
    assert grids.axis_size(110.0, 111.0, 0.01) == 101
    g = grids.target_grid(spark, 110.0, 21.0, 110.1, 21.05, 0.01)
    assert g.count() == 11 * 6


def test_side_by_side_tiles_need_the_corrected_relation(spark):
    boxes = spark.createDataFrame([(1, 0.0, 1.0, 0.0, 1.0), (2, 0.0, 1.0, 1.012, 2.0), (3, 1.012, 2.0, 2.012, 3.0)], "tile_id int, lat_min double, lat_max double, lon_min double, lon_max double")
    assert [(r.tile_a, r.tile_b) for r in grids.tile_relations(boxes).collect()] == [(2, 3)]
    assert {(r.tile_a, r.tile_b) for r in grids.tile_relations(boxes, adjacent="either").collect()} == {(1, 2), (2, 3)}


def test_verification(spark):
    pairs = spark.createDataFrame([(1.0, -2.0), (2.0, 3.0), (0.0, 1.0)], "obs double, fc double")
    s = scoring.scores(scoring.errors(pairs)).first()
    assert (s.n, s.n_missing) == (3, 0)
    assert s.bias == pytest.approx((-1 + 1 + 1) / 3) and s.mape == pytest.approx((100 + 50) / 2) and s.mse == pytest.approx(1)
    nan = scoring.scores(scoring.errors(spark.createDataFrame([(1.0, 1.0), (1.0, float("nan"))], "obs double, fc double"))).first()
    assert np.isnan(nan.bias) and nan.mape == 0 and nan.n_missing == 1
    assert scoring.scores(scoring.errors(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "obs double, fc double"))).first().correlation is None


def test_products_verify_by_slot(spark):
    products = spark.createDataFrame([("M", 1, r, c, 23 + r * 0.5, 113 + c * 0.5, float(r + c)) for r in range(3) for c in range(3)], "model string, slot int, r bigint, c bigint, lat double, lon double, km double")
    stations = spark.createDataFrame([(1, "N1", 113.1, 23.1, 1.0, 50.0, 1000.0, 1, "national"), (2, "N2", 199.0, 99.0, 1.0, 50.0, 1000.0, 1, "national")], "seq bigint, code string, lon double, lat double, altitude double, rh double, vis double, slot int, station_type string")
    detail, scores = chains.verify(stations, products)
    assert {r.code: r.fc for r in detail.collect()} == {"N1": 0.0, "N2": 4.0}
    assert scores.first().n == 2


def test_colours_and_classes(spark):
    values = [None, -1.0, 0.0, 0.5, 1.0, 10.0, 19.99, 20.0, 30.0, 99.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, km double")
    got = [r[1] for r in rows.select("i", scoring.colour_bin(F.col("km"))).orderBy("i").collect()]
    assert got == [None, 0, 0, 32, 64, 160, 207, 208, 255, 255]
    fog = [tuple(r)[1:] for r in rows.select("i", scoring.fog_class(F.col("km")), scoring.fog_class(F.col("km"), True)).orderBy("i").collect()]
    assert fog[0] == (None, 2) and fog[4] == (0, 0) and fog[5] == (1, 1) and fog[6] == (2, 2)


def test_mask_keeps_what_is_inside(spark):
    ring = rasters.read_rings(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[113, 23], [114, 23], [114, 24], [113, 24], [113, 23]]]}}]}))
    grid = spark.createDataFrame([(lat, lon, 1000.0) for lat in (22.5, 23.5, 24.5) for lon in (112.5, 113.5, 114.5)], "lat double, lon double, v double")
    assert [(r.lat, r.lon) for r in scoring.mask(grid, ring, "v").where("v IS NOT NULL").collect()] == [(23.5, 113.5)]
    with pytest.raises(ValueError):
        rasters.read_rings('{"type": "FeatureCollection", "features": []}')


def test_legacy_units(spark):
    km = lambda values: [r.v for r in scoring.km_if_metres(spark.createDataFrame([(v,) for v in values], "v double"), "v").collect()]
    assert km([5.0, 99.0]) == [5.0, 99.0] and km([500.0, 99.0]) == [0.5, 0.099]


def test_geotiff_round_trip(spark, tmp_path):
    a = random_grid(2, (5, 7))
    a[np.isnan(a)] = -9999
    (tmp_path / "ASTGTM2_N23E111_dem.tif").write_bytes(rasters.write_geotiff(a, 111.0, 24.0, 0.1, 0.1, -9999))
    cells = rasters.read_rasters(spark, str(tmp_path))
    got = array(cells, a.shape, "value")
    want = np.where(a == -9999, np.nan, a)[::-1]  # rows run from south to north
    assert np.array_equal(got, want, equal_nan=True)
    first = cells.where("r = 0 AND c = 0").select("lat", "lon", *(x.alias(n) for x, n in zip(rasters.tile_corner(F.col("path")), ("a", "b")))).first()
    assert (round(first.lat, 6), round(first.lon, 6), first.a, first.b) == (23.55, 111.05, 23, 111)


@pytest.mark.parametrize("name,corner", [("ASTGTM2_N23E111_dem.tif", (23, 111)), ("ASTGTM2_N45E120_dem.tif", (45, 120)), ("ASTGTM2_N01E001_dem.tif", (1, 1)), ("x.tif", (None, None)), ("ASTGTM2_S23E111_dem.tif", (None, None))])
def test_tile_names(name, corner):
    assert rasters.parse_tile_name(name) == corner


def netcdf(lats, lons, values):
    """A NetCDF-3 file with one field."""
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    name = lambda s: struct.pack(">i", len(s)) + pad(s.encode())
    dims = struct.pack(">ii", 10, 2) + name("lat") + struct.pack(">i", len(lats)) + name("lon") + struct.pack(">i", len(lons))
    variables = [("lat", [0], np.asarray(lats, ">f8")), ("lon", [1], np.asarray(lons, ">f8")), ("visibility", [0, 1], np.asarray(values, ">f8"))]

    def head(starts):
        out = b"CDF\x01" + struct.pack(">i", 0) + dims + struct.pack(">ii", 0, 0) + struct.pack(">ii", 11, len(variables))
        for (n, of, v), start in zip(variables, starts):
            out += name(n) + struct.pack(">i", len(of)) + b"".join(struct.pack(">i", d) for d in of) + struct.pack(">ii", 0, 0) + struct.pack(">iii", 6, v.nbytes, start)
        return out

    at, starts = len(head([0, 0, 0])), []
    for _, _, v in variables:
        starts.append(at)
        at += v.nbytes
    return head(starts) + b"".join(v.tobytes() for _, _, v in variables)


def test_netcdf(spark, tmp_path):
    values = np.arange(6.0).reshape(2, 3)
    (tmp_path / "g.nc").write_bytes(netcdf([23.0, 24.0], [113.0, 114.0, 115.0], values))
    cells = rasters.read_grids(spark, str(tmp_path))
    assert np.array_equal(array(cells, (2, 3), "value"), values)
    assert rasters.product_variable(["x", "vis000"]) == "vis000" and rasters.product_variable(["x", "y"]) == "x"


def test_sinks(spark, tmp_path):
    grid = spark.createDataFrame([("national", "2024-01-01", "0005", 1, 2.0)], "source_type string, date string, slot string, r int, v double")
    rasters.write_grid(grid, str(tmp_path / "g"), attributes={"beta": 10.0})
    assert spark.read.parquet(str(tmp_path / "g")).where("source_type = 'national'").count() == 1
    assert spark.read.parquet(str(tmp_path / "g_meta")).first().value == "10.0"
    rasters.write_csv(grid.select("r", "v"), str(tmp_path / "c"))
    assert "v" in spark.read.option("header", True).csv(str(tmp_path / "c")).columns
    (tmp_path / "m1").mkdir()
    (tmp_path / "m1" / "a.csv").write_text("datetime,bias\n2024-01-01,0.5\n")
    models = rasters.read_models(spark, {"one": str(tmp_path / "m1"), "two": str(tmp_path / "none")}, "datetime string, bias double")
    assert [(r.model, r.bias) for r in models.collect()] == [("one", 0.5)]


def test_strict_merge_and_spacing(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], CELLS)
    b = spark.createDataFrame([(0, 1, 3.0), (0, 2, 4.0)], CELLS)
    got = {(r.r, r.c): (r.elevation, r.conflict) for r in grids.strict_merge(a, b).collect()}
    assert got == {(0, 0): (1.0, False), (0, 1): (2.0, True), (0, 2): (4.0, False)}


@pytest.mark.parametrize("method", ["linear", "cubic"])
def test_resampling_between_cells_is_exact_on_a_plane(spark, method):
    cells = spark.createDataFrame([(r, c, 20 + r * 0.1, 100 + c * 0.1, 3.0 * r - c) for r in range(9) for c in range(9)], "r bigint, c bigint, lat double, lon double, elevation double")
    target = spark.createDataFrame([(0, 0, 20.234, 100.471), (0, 1, 20.3, 100.35), (1, 0, 20.561, 100.212), (1, 1, 99.0, 100.2)], "r bigint, c bigint, lat double, lon double")
    for r in grids.resample(cells, target, method).collect():
        want = 3 * (r.lat - 20) / 0.1 - (r.lon - 100) / 0.1
        assert r.elevation is None if r.lat > 30 else r.elevation == pytest.approx(want)


def test_methods(spark):
    cells = spark.createDataFrame([(r, c, 20 + r * 0.1, 100 + c * 0.1, float(r * 10 + c)) for r in range(3) for c in range(3)], "r bigint, c bigint, lat double, lon double, elevation double")
    target = spark.createDataFrame([(0, 0, 19.0, 100.1), (0, 1, 20.12, 100.12)], "r bigint, c bigint, lat double, lon double")
    got = {m: [r.elevation for r in grids.resample(cells, target, m, 0.35).orderBy("c").collect()] for m in ("fast_nearest", "vectorized", "nearest", "block_average", "linear")}
    assert got == {"fast_nearest": [None, 11.0], "vectorized": [None, 11.0], "nearest": [1.0, 11.0], "block_average": [None, 11.0], "linear": [None, pytest.approx(13.2)]}
    for bad in ("other", "block_average"):
        with pytest.raises(ValueError):
            grids.resample(cells, target, bad)


def test_one_bad_tile_doesnt_lose_the_others(spark, tmp_path):
    (tmp_path / "good.tif").write_bytes(rasters.write_geotiff(np.ones((2, 2)), 111.0, 24.0, 0.1, 0.1))
    (tmp_path / "bad.tif").write_bytes(b"II*")
    found = rasters.read_rasters(spark, str(tmp_path), skip_bad=True).collect()
    assert sum(r.value is not None for r in found) == 4 and sum(r.r is None for r in found) == 1


def test_blocks_as_geojson(spark):
    classed = spark.createDataFrame([(0, 0, 1, 1), (0, 1, 1, 1), (1, 1, 1, 1)], "r bigint, c bigint, cls int, block_id bigint")
    made = rasters.blocks_geojson(terrain.outlines(classed), 100.0, 20.0, 1.0).first()
    assert json.loads(made.geojson)["coordinates"] == [[[[100, 20], [102, 20], [102, 21], [100, 21], [100, 20]]], [[[101, 21], [102, 21], [102, 22], [101, 22], [101, 21]]]]


def test_file_server_address():
    assert rasters.file_server_url("http://h/thredds/dodsC/a.nc") == "http://h/thredds/fileServer/a.nc"


@pytest.mark.parametrize("half", [8, 9, 20])
def test_wide_box_sums_equal_brute_force(spark, half):
    """Windows narrower and wider than the grid, with missing and absent cells."""
    rng = np.random.default_rng(half)
    a = rng.integers(0, 1000, (23, 31)).astype(float)
    a[rng.random(a.shape) < 0.1] = np.nan
    absent = {(3, 4), (22, 30), (10, 10)}
    rows = [(r, c, None if np.isnan(a[r, c]) else float(a[r, c])) for r in range(23) for c in range(31) if (r, c) not in absent]
    grid = spark.createDataFrame(rows, "r bigint, c bigint, elevation double")
    present = {(r, c): v for r, c, v in rows if v is not None}
    found = {(x.r, x.c): (x.total, x.n) for x in stencils.box_sums(grid, half, "elevation").collect()}
    assert len(found) == len(rows)
    for r, c, _ in rows[::37]:
        near = [present[k] for dr in range(-half, half + 1) for dc in range(-half, half + 1) if (k := (min(22, max(0, r + dr)), min(30, max(0, c + dc)))) in present]
        assert found[r, c] == (pytest.approx(sum(near)), len(near))


def test_tiles_of_one_directory_meet_once(spark):
    boxes = spark.createDataFrame([(i, 20.0 + i // 12, 21.0 + i // 12, 110.0 + i % 12, 111.0 + i % 12) for i in range(144)], "tile_id int, lat_min double, lat_max double, lon_min double, lon_max double")
    found = [(r.tile_a, r.tile_b) for r in grids.tile_relations(boxes, 0.01, "either").collect()]
    want = [(a, b) for a in range(144) for b in range(a + 1, 144) if abs(a // 12 - b // 12) <= 1 and abs(a % 12 - b % 12) <= 1]
    assert sorted(found) == want
