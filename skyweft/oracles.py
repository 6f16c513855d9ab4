"""DuckDB SQL for the catalog's queries, over the same views of the driver's tables."""

from __future__ import annotations

from .sources.fixtures import RING, cte

KM = "sqrt(power(6371.0 * radians({lon2} - {lon1}) * cos(radians(({lat1} + {lat2}) / 2.0)), 2) + power(6371.0 * radians({lat2} - {lat1}), 2))"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return KM.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


def _number(c: str) -> str:
    return f"CASE WHEN TRY_CAST(trim({c}) AS DOUBLE) IN (9999, 999999) THEN NULL ELSE TRY_CAST(trim({c}) AS DOUBLE) END"


_present = "CASE WHEN coalesce(TRY_CAST(trim({c}) AS DOUBLE) IN (9999, 999999), false) THEN NULL ELSE {c} END"
_FALLBACK = f"coalesce({_present.format(c='v_vis_primary')}, {_present.format(c='v_vis_secondary')})"
_CODE = "nullif(regexp_replace(trim(v_code), '\\.0$', ''), '')"
_FEED = f"feed AS (SELECT seq, {_CODE} AS code, {_number(_FALLBACK)} AS vis, {_number('v_rh')} AS rh, update_minute FROM fx_raw_feed)"

_REF = "ref AS (SELECT * FROM fx_national WHERE vis IS NOT NULL AND rh IS NOT NULL)"
_TARGET = "target AS (SELECT * FROM fx_regional WHERE rh IS NOT NULL)"
_D = "sqrt((t.lat - s.lat) * (t.lat - s.lat) + (t.lon - s.lon) * (t.lon - s.lon))"


def _near(targets: str, stations: str, k: int) -> str:
    return f"""near AS (SELECT * FROM (SELECT t.seq, t.rh, s.seq AS station, s.code AS s_code, s.vis AS s_vis, s.rh AS s_rh, {_D} AS d, row_number() OVER (PARTITION BY t.seq ORDER BY {_D}, s.seq) AS k
        FROM {targets} t, {stations} s) WHERE k <= {k})"""


_EST = """est AS (SELECT seq, sum(s_vis / power(greatest(abs(rh - s_rh), 0.1), 2)) / sum(1 / power(greatest(abs(rh - s_rh), 0.1), 2)) AS vis_rh,
        sum(s_vis / power(greatest(d, 0.001), 2)) / sum(1 / power(greatest(d, 0.001), 2)) AS vis_dis FROM near GROUP BY seq)"""


def _estimate(combined: bool) -> str:
    """The station table as CTEs, the last named stations."""
    ref = "ref AS (SELECT * FROM fx_national WHERE vis IS NOT NULL AND rh IS NOT NULL" + (" UNION ALL SELECT * FROM fx_regional WHERE vis IS NOT NULL AND rh IS NOT NULL)" if combined else ")")
    target = "target AS (SELECT * FROM fx_regional WHERE rh IS NOT NULL" + (" AND vis IS NULL)" if combined else ")")
    return f"""{cte('fx_national', 'fx_regional')}, {ref}, {target}, {_near('target', 'ref', 4)}, {_EST},
        stations AS (SELECT seq, code, lon, lat, altitude, vis, CAST(NULL AS DOUBLE) AS vis_rh, CAST(NULL AS DOUBLE) AS vis_dis, CAST(0 AS BIGINT) AS is_vis_est FROM ref
        UNION ALL SELECT t.seq, code, lon, lat, altitude, 0.5 * vis_rh + 0.5 * vis_dis, vis_rh, vis_dis, CAST(1 AS BIGINT) FROM target t JOIN est e ON t.seq = e.seq)"""


_EST_OUT = "SELECT code, round(vis, 3) AS vis, round(vis_rh, 3) AS vis_rh, round(vis_dis, 3) AS vis_dis, is_vis_est FROM stations"


def _idw(stations: str, top: bool) -> str:
    chosen = "WHERE d > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, seq) <= 6" if top else "WHERE d > 0"
    return f"""cand AS (SELECT * FROM (SELECT t.id, t.lat AS tlat, t.lon AS tlon, t.elevation, s.seq, s.lat, s.lon, s.altitude, s.vis, row_number() OVER (PARTITION BY t.id ORDER BY {_D}, s.seq) AS k
          FROM fx_dem t, (SELECT * FROM {stations} WHERE vis IS NOT NULL AND altitude IS NOT NULL) s) WHERE k <= 12),
        dist AS (SELECT id, seq, vis, sqrt(power({_km('tlat', 'tlon', 'lat', 'lon')}, 2) + power(10.0 * abs(elevation - altitude) / 1000.0, 2)) AS d FROM cand WHERE elevation IS NOT NULL),
        used AS (SELECT * FROM dist {chosen}),
        v AS (SELECT id, sum(vis / (greatest(d, 1e-12) * greatest(d, 1e-12))) / sum(1 / (greatest(d, 1e-12) * greatest(d, 1e-12))) AS v FROM used GROUP BY id)
        SELECT t.id, t.r, t.c, round(v, 3) AS v FROM fx_dem t LEFT JOIN v ON t.id = v.id"""


_FRAME = "f AS (SELECT min(lat) AS y0, max(lat) AS y1, min(lon) AS x0, max(lon) AS x1, max(r) - min(r) AS nr, max(c) - min(c) AS nc FROM fx_dem)"
_PLACED = f"""placed AS (SELECT n.*, greatest(0, least(nr, CAST(round_even((n.lat - y0) / 0.02, 0) AS BIGINT))) AS pr, greatest(0, least(nc, CAST(round_even((n.lon - x0) / 0.02, 0) AS BIGINT))) AS pc
        FROM fx_national n, f WHERE n.vis IS NOT NULL AND n.rh IS NOT NULL),
        located AS (SELECT p.*, g.r, g.c, g.elevation FROM placed p LEFT JOIN fx_dem g ON p.pr = g.r AND p.pc = g.c)"""
_ERR = "err AS (SELECT model, station_type, dt, obs, greatest(fc, 0) AS fc, greatest(fc, 0) - obs AS e, CASE WHEN obs > 0.001 THEN 100 * abs(greatest(fc, 0) - obs) / obs END AS rel FROM fx_pairs)"


def _target(left: float, bottom: float, rows: int, cols: int, step: float) -> str:
    return f"t AS (SELECT r, c, {bottom}::DOUBLE + r * {step}::DOUBLE AS lat, {left}::DOUBLE + c * {step}::DOUBLE AS lon FROM range({rows}) a(r), range({cols}) b(c))"


_TPI = """box AS (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM fx_dem),
        k AS (SELECT a.dr, b.dc FROM range(-{h}, {h} + 1) a(dr), range(-{h}, {h} + 1) b(dc) WHERE NOT (a.dr = 0 AND b.dc = 0)),
        s AS (SELECT g.r, g.c, avg(n.elevation) AS m FROM fx_dem g CROSS JOIN box CROSS JOIN k
              JOIN fx_dem n ON n.r = greatest(r0, least(r1, g.r + dr)) AND n.c = greatest(c0, least(c1, g.c + dc)) GROUP BY g.r, g.c),
        tpi AS (SELECT g.r, g.c, g.elevation - s.m AS tpi FROM fx_dem g LEFT JOIN s ON g.r = s.r AND g.c = s.c)"""


def _tpi(size: int) -> str:
    return cte("fx_dem") + ", " + _TPI.format(h=size // 2)


_BOXES = "b AS (SELECT CAST(tile_id AS BIGINT) AS tile_id, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max, count(*) AS n_cells FROM fx_tiles GROUP BY tile_id)"


def _pairs(close: str) -> str:
    over = lambda x: f"(a.{x}_max >= b.{x}_min AND b.{x}_max >= a.{x}_min)"
    meets = lambda x: f"(abs(a.{x}_max - b.{x}_min) <= 0.06 OR abs(b.{x}_max - a.{x}_min) <= 0.06)"
    gap = lambda x: f"greatest(b.{x}_min - a.{x}_max, a.{x}_min - b.{x}_max, 0.0)"
    on = close.format(mlat=meets("lat"), mlon=meets("lon"), olat=over("lat"), olon=over("lon"))
    return f"""{cte('fx_tiles')}, {_BOXES}, p AS (SELECT a.tile_id AS tile_a, b.tile_id AS tile_b, {over('lat')} AND {over('lon')} AS o, {gap('lat')} AS lat_gap, {gap('lon')} AS lon_gap FROM b a JOIN b ON a.tile_id < b.tile_id AND {on})
        SELECT tile_a, tile_b, CASE WHEN o THEN 'overlap' ELSE 'gap' END AS relation, round(lat_gap, 6) AS lat_gap, round(lon_gap, 6) AS lon_gap FROM p WHERE o OR lat_gap > 0.02 OR lon_gap > 0.02"""


def _axis(a: str) -> str:
    return f"SELECT '{a}' AS axis, key, round(position, 6) AS position, CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS index FROM (SELECT CAST(round_even({a} / 0.02, 0) AS BIGINT) AS key, min({a}) AS position FROM fx_tiles GROUP BY 1)"


_MERGED = "m AS (SELECT CAST(round_even(lat / 0.02, 0) AS BIGINT) AS r, CAST(round_even(lon / 0.02, 0) AS BIGINT) AS c, avg(elevation) AS elevation, count(elevation) AS n FROM fx_tiles GROUP BY 1, 2)"


def _ring() -> str:
    parts = []
    for (x1, y1), (x2, y2) in zip(RING, RING[1:]):
        parts.append(f"CASE WHEN (({y1}::DOUBLE > lat) <> ({y2}::DOUBLE > lat)) AND lon < ({x2 - x1!r}::DOUBLE) * (lat - {y1}::DOUBLE) / ({y2 - y1!r}::DOUBLE) + {x1}::DOUBLE THEN 1 ELSE 0 END")
    return "(" + " + ".join(parts) + ") % 2 = 1"

_HOURS = "h AS (SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS slot, count(*) AS n FROM events GROUP BY 1), c AS (SELECT slot, n, slot // 3600 AS hour FROM h)"
_QUEUE = """q AS (SELECT slot, CASE WHEN hour % 5 = 0 THEN 'done' WHEN hour % 7 = 0 THEN 'processing' WHEN hour % 3 = 0 THEN 'failed' ELSE 'pending' END AS status, 1 AS attempts, 'e' AS error, hour FROM c WHERE hour % 11 <> 0)"""


def _gauss_weights(sigma: float) -> str:
    radius = int(4 * sigma + 0.5)
    one = f"(SELECT d, exp(-0.5 * power(d / {sigma}::DOUBLE, 2)) AS w FROM range(-{radius}, {radius} + 1) t(d))"
    return f"(SELECT a.d AS a, b.d AS b, a.w * b.w / power((SELECT sum(w) FROM {one} s), 2) AS w FROM {one} a, {one} b)"


def _mirror(at: str, low: str, high: str) -> str:
    """Where a place beyond the edges lies when they are mirrors, the edge line twice."""
    n = f"({high} - {low} + 1)"
    m = f"((({at} - {low}) % (2 * {n}) + 2 * {n}) % (2 * {n}))"
    return f"({low} + CASE WHEN {m} < {n} THEN {m} ELSE 2 * {n} - 1 - {m} END)"


def _gauss(src: str, out: str, sigma: float, zero: bool) -> str:
    value = "coalesce(n.elevation, 0)" if zero else "n.elevation"
    smooth = f"sum({value} * w)" if zero else f"sum({value} * w) / sum(CASE WHEN n.elevation IS NOT NULL THEN w END)"
    return f"""{out}_q AS MATERIALIZED (SELECT g.r, g.c, w, {_mirror('(g.r + k.a)', 'r0', 'r1')} AS sr, {_mirror('(g.c + k.b)', 'c0', 'c1')} AS sc
            FROM {src} g, (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM {src}) x, {_gauss_weights(sigma)} k),
        {out} AS MATERIALIZED (SELECT q.r, q.c, {smooth} AS smooth FROM {out}_q q JOIN {src} n ON n.r = q.sr AND n.c = q.sc GROUP BY q.r, q.c)"""


def _steep(src: str, out: str) -> str:
    """src with its steepest cells and what is two steps from them smoothed."""
    return f"""{out}_p AS MATERIALIZED (SELECT g.r, g.c, dr, dc, greatest(r0, least(r1, g.r + dr)) AS sr, greatest(c0, least(c1, g.c + dc)) AS sc
            FROM {src} g, (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM {src}) x, range(-1, 2) a(dr), range(-1, 2) b(dc)),
        {out}_s AS (SELECT p.r, p.c, count(n.elevation) AS n, sum(n.elevation * dr * (2 - abs(dc))) AS gx, sum(n.elevation * dc * (2 - abs(dr))) AS gy
            FROM {out}_p p JOIN {src} n ON n.r = p.sr AND n.c = p.sc GROUP BY p.r, p.c),
        {out}_g AS MATERIALIZED (SELECT r, c, CASE WHEN n = 9 THEN sqrt(gx * gx + gy * gy) END AS gradient FROM {out}_s),
        {out}_h AS (SELECT r, c FROM {out}_g WHERE gradient > (SELECT quantile_cont(gradient, 0.95) FROM {out}_g)),
        {out}_d AS (SELECT DISTINCT h.r + a.d AS r, h.c + b.d AS c FROM {out}_h h, range(-2, 3) a(d), range(-2, 3) b(d) WHERE abs(a.d) + abs(b.d) <= 2),
        {_gauss(src, f'{out}_m', 0.8, True)},
        {out} AS MATERIALIZED (SELECT g.r, g.c, CASE WHEN d.r IS NOT NULL AND g.elevation IS NOT NULL THEN m.smooth ELSE g.elevation END AS elevation
            FROM {src} g LEFT JOIN {out}_m m ON g.r = m.r AND g.c = m.c LEFT JOIN {out}_d d ON g.r = d.r AND g.c = d.c)"""


def _near_fill(src: str, out: str, distance: int) -> str:
    return f"""{out}_q AS MATERIALIZED (SELECT g.r, g.c, g.r + dr AS sr, g.c + dc AS sc FROM {src} g, range(-{distance}, {distance} + 1) a(dr), range(-{distance}, {distance} + 1) b(dc)
            WHERE g.elevation IS NULL AND dr * dr + dc * dc <= {distance * distance}),
        {out}_n AS (SELECT q.r, q.c, s.elevation AS v, row_number() OVER (PARTITION BY q.r, q.c ORDER BY (s.r - q.r) * (s.r - q.r) + (s.c - q.c) * (s.c - q.c), s.r, s.c) AS k
            FROM {out}_q q JOIN {src} s ON s.r = q.sr AND s.c = q.sc WHERE s.elevation IS NOT NULL),
        {out} AS MATERIALIZED (SELECT g.r, g.c, coalesce(g.elevation, n.v) AS elevation FROM {src} g LEFT JOIN {out}_n n ON g.r = n.r AND g.c = n.c AND k = 1)"""


def _line_fill(src: str, out: str, distance: int) -> str:
    """Line interpolation along rows and columns of the cells that a nearest fill would reach."""
    last = lambda x, order: f"last_value(CASE WHEN elevation IS NOT NULL THEN {x} END IGNORE NULLS) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sides = {"l": "PARTITION BY r ORDER BY c", "t": "PARTITION BY r ORDER BY c DESC", "u": "PARTITION BY c ORDER BY r", "d": "PARTITION BY c ORDER BY r DESC"}
    found = ", ".join(f"{last('elevation', order)} AS {s}v, {last('c' if s in 'lt' else 'r', order)} AS {s}x" for s, order in sides.items())
    return f"""{_near_fill(src, f'{out}_f', distance)},
        {out}_w AS (SELECT r, c, elevation, {found} FROM {src}),
        {out}_l AS (SELECT r, c, elevation, lv + (tv - lv) * ((c - lx) / (tx - lx)) AS across, uv + (dv - uv) * ((r - ux) / (dx - ux)) AS down FROM {out}_w),
        {out} AS MATERIALIZED (SELECT l.r, l.c, CASE WHEN l.elevation IS NULL AND f.elevation IS NOT NULL
            THEN coalesce(CASE WHEN across IS NOT NULL AND down IS NOT NULL THEN (across + down) / 2 ELSE coalesce(across, down) END, f.elevation) ELSE l.elevation END AS elevation
            FROM {out}_l l JOIN {out}_f f ON l.r = f.r AND l.c = f.c)"""


_ALONG = ("(((2 - {t}) * {t} - 1) * {t} / 2)", "(((3 * {t} - 5) * {t} * {t} + 2) / 2)", "(((4 - 3 * {t}) * {t} + 1) * {t} / 2)", "(({t} - 1) * {t} * {t} / 2)")
_SPLINE = " UNION ALL ".join(
    f"SELECT r, c, greatest(0, least(nr, iy + {a - 1})) AS sr, greatest(0, least(nc, ix + {b - 1})) AS sc, {y.format(t='fy')} * {x.format(t='fx')} AS w FROM q" for a, y in enumerate(_ALONG) for b, x in enumerate(_ALONG)
)

_KM = "p AS (SELECT id, r, c, lat, lon, elevation / 40.0 AS km FROM fx_dem)"
_SLOT = "CAST(floor(epoch(ts) / 300) * 300 AS BIGINT)"
_HOUR = "CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT)"
_COLOUR = "CASE " + " ".join(f"WHEN km < {hi} THEN CAST(greatest(0, least({n - 1}, floor((km - {lo}) / ({hi} - {lo}) * {n}))) + {first} AS BIGINT)" for lo, hi, n, first in ((0.0, 1.0, 64, 0), (1.0, 10.0, 96, 64), (10.0, 20.0, 48, 160), (20.0, 30.0, 48, 208))) + " WHEN km IS NOT NULL THEN 255 END"

ORACLES = {
    "clean_feed": f"{cte('fx_raw_feed')}, {_FEED} SELECT * FROM feed",
    "clean_sentinels": f"{cte('fx_raw_feed')} SELECT seq, {_number('v_vis_primary')} AS v_vis_primary, {_number('v_vis_secondary')} AS v_vis_secondary, {_number('v_rh')} AS v_rh FROM fx_raw_feed",
    "clean_fallback": f"{cte('fx_raw_feed')}, {_FEED} SELECT seq, vis FROM feed",
    "code_normalize": f"{cte('fx_raw_feed')}, {_FEED} SELECT seq, code FROM feed",
    "dedup_best_quality": f"""{cte('fx_raw_feed')}, {_FEED} SELECT code, seq, vis, rh FROM feed WHERE code IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY (CASE WHEN vis IS NULL THEN 0 ELSE 1 END + CASE WHEN rh IS NULL THEN 0 ELSE 1 END) DESC, update_minute DESC, seq) = 1""",
    "dedup_first_wins": f"""{cte('fx_raw_feed')}, {_FEED}, u AS (SELECT *, 0 AS f FROM feed WHERE vis IS NOT NULL UNION ALL SELECT *, 1 FROM feed)
        SELECT code, seq, vis FROM u QUALIFY row_number() OVER (PARTITION BY code ORDER BY f, seq) = 1""",
    "sample_counts": f"""{cte('fx_national', 'fx_regional')} SELECT (SELECT count(DISTINCT code) FROM fx_national WHERE rh IS NOT NULL AND vis IS NOT NULL) AS national_valid,
        (SELECT count(DISTINCT code) FROM fx_regional WHERE rh IS NOT NULL) AS regional_valid_rh, (SELECT count(DISTINCT code) FROM fx_regional WHERE rh IS NOT NULL AND vis IS NOT NULL) AS regional_valid_vis""",
    "geo_distance_km": f"{cte('fx_regional')} SELECT seq, round({_km('23.0', '113.0', 'lat', 'lon')}, 6) AS km FROM fx_regional",
    "aniso_distance": f"""{cte('fx_regional')}, d AS (SELECT seq, sqrt(power({_km('23.0', '113.0', 'lat', 'lon')}, 2) + power(10.0 * abs(100.0 - altitude) / 1000.0, 2)) AS d FROM fx_regional)
        SELECT seq, round(d, 6) AS km, round(1 / (greatest(d, 1e-12) * greatest(d, 1e-12)), 9) AS weight FROM d""",
    "knn4_stations": f"{cte('fx_national', 'fx_regional')}, {_REF}, {_TARGET}, {_near('target', 'ref', 4)} SELECT seq, k AS rank, station, round(d, 9) AS d FROM near",
    "estimate_national": f"{_estimate(False)} {_EST_OUT}",
    "estimate_combined": f"{_estimate(True)} {_EST_OUT}",
    "idw_all_candidates": f"{cte('fx_national', 'fx_dem')}, {_idw('fx_national', False)}",
    "idw_top_n": f"{cte('fx_national', 'fx_dem')}, {_idw('fx_national', True)}",
    "pipeline_national": f"{_estimate(False)}, {cte('fx_dem')[5:]}, {_idw('stations', False)}",
    "pipeline_combined": f"{_estimate(True)}, {cte('fx_dem')[5:]}, {_idw('stations', False)}",
    "nearest_cell": f"{cte('fx_national', 'fx_dem')}, {_FRAME}, {_PLACED} SELECT seq, r, c, elevation AS value FROM located",
    "verify_detail": f"""{cte('fx_national', 'fx_dem')}, {_FRAME}, {_PLACED}, p AS (SELECT seq, vis / 1000.0 AS obs, greatest(elevation / 100.0 - 1.0, 0) AS fc FROM located WHERE elevation IS NOT NULL)
        SELECT seq, round(obs, 6) AS obs, round(fc, 6) AS fc, round(fc - obs, 6) AS error, round(abs(fc - obs), 6) AS abs_error, round(CASE WHEN obs > 0.001 THEN 100.0 * abs(fc - obs) / obs END, 6) AS rel_error FROM p""",
    "verify_stats": f"""{cte('fx_pairs')}, {_ERR} SELECT model, station_type, count(*) AS n, round(avg(obs), 6) AS mean_obs, round(avg(fc), 6) AS mean_forecast, round(avg(e), 6) AS bias, round(avg(abs(e)), 6) AS mae,
        round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse, round(stddev_pop(e), 6) AS std_error,
        round(CASE WHEN stddev_pop(obs) * stddev_pop(fc) > 0 THEN covar_pop(obs, fc) / (stddev_pop(obs) * stddev_pop(fc)) END, 6) AS correlation, round(avg(rel), 6) AS mape FROM err GROUP BY 1, 2""",
    "summary_mean_of_means": f"""{cte('fx_pairs')}, {_ERR}, s AS (SELECT model, station_type, dt, avg(e) AS bias, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM err GROUP BY 1, 2, 3)
        SELECT model, station_type, count(*) AS n_slots, round(avg(bias), 6) AS bias, round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse FROM s GROUP BY 1, 2""",
    "model_boxplot_stats": f"""{cte('fx_pairs')}, {_ERR} SELECT model, station_type, count(*) AS n, round(avg(e), 9) AS mean, round(stddev_samp(e), 9) AS std, round(min(e), 9) AS min, round(max(e), 9) AS max,
        round(quantile_cont(e, 0.25), 9) AS q25, round(quantile_cont(e, 0.5), 9) AS median, round(quantile_cont(e, 0.75), 9) AS q75, round(quantile_cont(e, 0.9), 9) AS q90, round(quantile_cont(e, 0.95), 9) AS q95 FROM err GROUP BY 1, 2""",
    "model_monthly": f"""{cte('fx_pairs')}, {_ERR}, g AS (SELECT model, station_type, strftime(dt, '%Y-%m') AS month, avg(e) AS e, avg(abs(e)) AS a FROM err GROUP BY 1, 2, 3)
        SELECT model, station_type, month, 'error' AS metric, round(e, 9) AS mean FROM g UNION ALL SELECT model, station_type, month, 'abs_error', round(a, 9) FROM g""",
    "grid_target": f"WITH {_target(110.0, 21.0, 21, 51, 0.01)} SELECT r, c, round(lat, 6) AS lat, round(lon, 6) AS lon FROM t",
    "fast_nearest": f"""{cte('fx_dem')}, {_FRAME}, {_target(109.955, 20.957, 20, 36, 0.03)},
        p AS (SELECT t.r, t.c, CASE WHEN lat BETWEEN y0 AND y1 AND lon BETWEEN x0 AND x1 THEN least(nr, CAST(round_even((lat - y0) / 0.02, 0) AS BIGINT)) END AS pr, least(nc, CAST(round_even((lon - x0) / 0.02, 0) AS BIGINT)) AS pc FROM t, f)
        SELECT p.r, p.c, g.elevation FROM p LEFT JOIN fx_dem g ON p.pr = g.r AND p.pc = g.c""",
    "block_average": f"""{cte('fx_dem')}, {_FRAME}, {_target(110.005, 21.005, 9, 39, 0.05)},
        p AS (SELECT t.r, t.c, CAST(floor((lat - y0) / 0.02) AS BIGINT) AS pr, CAST(floor((lon - x0) / 0.02) AS BIGINT) AS pc, lat BETWEEN y0 AND y1 AND lon BETWEEN x0 AND x1 AS inside FROM t, f)
        SELECT p.r, p.c, round(avg(g.elevation), 6) AS elevation FROM p LEFT JOIN fx_dem g ON p.inside AND g.r BETWEEN p.pr - 1 AND p.pr + 1 AND g.c BETWEEN p.pc - 1 AND p.pc + 1 GROUP BY 1, 2""",
    "method_comparison": f"""{cte('fx_dem')}, {_FRAME}, {_target(110.005, 21.005, 9, 39, 0.05)},
        p AS (SELECT t.r, t.c, lat BETWEEN y0 AND y1 AND lon BETWEEN x0 AND x1 AS inside, least(nr, CAST(round_even((lat - y0) / ((y1 - y0) / nr), 0) AS BIGINT)) AS pr, least(nc, CAST(round_even((lon - x0) / ((x1 - x0) / nc), 0) AS BIGINT)) AS pc,
            CAST(floor((lat - y0) / ((y1 - y0) / nr)) AS BIGINT) AS br, CAST(floor((lon - x0) / ((x1 - x0) / nc)) AS BIGINT) AS bc FROM t, f),
        a AS (SELECT g.elevation FROM p JOIN fx_dem g ON inside AND p.pr = g.r AND p.pc = g.c),
        b AS (SELECT avg(g.elevation) AS elevation FROM p JOIN fx_dem g ON inside AND g.r BETWEEN p.br - 1 AND p.br + 1 AND g.c BETWEEN p.bc - 1 AND p.bc + 1 GROUP BY p.r, p.c)
        SELECT 'fast_nearest' AS method, count(elevation) AS n_valid, round(min(elevation), 6) AS min, round(max(elevation), 6) AS max, round(avg(elevation), 6) AS mean FROM a
        UNION ALL SELECT 'block_average', count(elevation), round(min(elevation), 6), round(max(elevation), 6), round(avg(elevation), 6) FROM b""",
    "linear_resample": f"""{cte('fx_dem')}, {_FRAME}, {_target(110.003, 21.007, 10, 32, 0.033)},
        p AS (SELECT t.r, t.c, (lat - y0) / 0.02 AS y, (lon - x0) / 0.02 AS x, nr, nc FROM t, f WHERE lat BETWEEN y0 AND y1 AND lon BETWEEN x0 AND x1),
        q AS (SELECT r, c, CAST(least(floor(y), nr - 1) AS BIGINT) AS iy, CAST(least(floor(x), nc - 1) AS BIGINT) AS ix, y - least(floor(y), nr - 1) AS fy, x - least(floor(x), nc - 1) AS fx FROM p),
        k AS (SELECT r, c, iy AS sr, ix AS sc, CASE WHEN fx + fy <= 1 THEN 1 - fx - fy ELSE 0 END AS w FROM q UNION ALL SELECT r, c, iy, ix + 1, CASE WHEN fx + fy <= 1 THEN fx ELSE 1 - fy END FROM q
              UNION ALL SELECT r, c, iy + 1, ix, CASE WHEN fx + fy <= 1 THEN fy ELSE 1 - fx END FROM q UNION ALL SELECT r, c, iy + 1, ix + 1, CASE WHEN fx + fy <= 1 THEN 0 ELSE fx + fy - 1 END FROM q),
        s AS (SELECT k.r, k.c, CASE WHEN count(g.elevation) = count(*) THEN sum(g.elevation * w) END AS v FROM k LEFT JOIN fx_dem g ON k.sr = g.r AND k.sc = g.c WHERE w <> 0 GROUP BY 1, 2)
        SELECT t.r, t.c, round(v, 6) AS elevation FROM t LEFT JOIN s ON t.r = s.r AND t.c = s.c""",
    "point_cells": f"""{cte('fx_national', 'fx_dem')} SELECT n.seq, CAST(g.id AS DOUBLE) AS cell FROM fx_national n LEFT JOIN fx_dem g
        ON g.r = CAST(floor((n.lat - 20.99::DOUBLE) / 0.02::DOUBLE) AS BIGINT) AND g.c = CAST(floor((n.lon - 109.99::DOUBLE) / 0.02::DOUBLE) AS BIGINT)""",
    "estimate_counts": f"{_estimate(True)} SELECT count(*) FILTER (is_vis_est = 1) AS n_estimated, count(*) FILTER (is_vis_est = 0) AS n_observed FROM stations",
    "tile_bbox": f"{cte('fx_tiles')}, {_BOXES} SELECT tile_id, round(lat_min, 6) AS lat_min, round(lat_max, 6) AS lat_max, round(lon_min, 6) AS lon_min, round(lon_max, 6) AS lon_max, n_cells FROM b",
    "tile_gap_pairs": _pairs("{mlat} AND {mlon}"),
    "tile_gap_pairs_corrected": _pairs("(({mlat} AND ({olon} OR {mlon})) OR ({mlon} AND ({olat} OR {mlat})))"),
    "unified_axes": f"{cte('fx_tiles')} {_axis('lat')} UNION ALL {_axis('lon')}",
    "axis_spacing": f"{cte('fx_tiles')}, a AS ({_axis('lon')}), s AS (SELECT position - lag(position) OVER (ORDER BY position) AS d FROM a) SELECT round(min(d), 6) AS min_spacing FROM s",
    "overlap_average": f"{cte('fx_tiles')}, {_MERGED} SELECT r, c, round(elevation, 6) AS elevation, n FROM m",
    "tile_strict_merge": f"""{cte('fx_tiles')} SELECT coalesce(a.r, b.r) AS r, coalesce(a.c, b.c) AS c, coalesce(a.elevation, b.elevation) AS elevation, coalesce(a.elevation <> b.elevation, false) AS conflict
        FROM (SELECT * FROM fx_tiles WHERE tile_id = 1) a FULL JOIN (SELECT * FROM fx_tiles WHERE tile_id = 2) b ON a.r = b.r AND a.c = b.c""",
    "coverage_report": f"""{cte('fx_tiles')}, {_MERGED}, b AS (SELECT (max(r) - min(r) + 1) * (max(c) - min(c) + 1) AS n_cells, count(elevation) AS n_valid FROM m)
        SELECT CAST(n_cells AS BIGINT) AS n_cells, n_valid, CAST(n_cells - n_valid AS BIGINT) AS n_missing, round(100.0 * n_valid / n_cells, 6) AS valid_percent FROM b""",
    "fill_nearest": f"""{cte('fx_dem')}, n AS (SELECT g.r, g.c, s.elevation AS v, row_number() OVER (PARTITION BY g.r, g.c ORDER BY (s.r - g.r) * (s.r - g.r) + (s.c - g.c) * (s.c - g.c), s.r, s.c) AS k
        FROM fx_dem g JOIN fx_dem s ON g.elevation IS NULL AND s.elevation IS NOT NULL AND (s.r - g.r) * (s.r - g.r) + (s.c - g.c) * (s.c - g.c) <= 9)
        SELECT g.r, g.c, coalesce(g.elevation, n.v) AS elevation FROM fx_dem g LEFT JOIN n ON g.r = n.r AND g.c = n.c AND k = 1""",
    "fill_neighborhood": f"""{cte('fx_dem')}, n AS (SELECT g.r, g.c, avg(s.elevation) AS v FROM fx_dem g JOIN fx_dem s ON g.elevation IS NULL AND abs(s.r - g.r) <= 1 AND abs(s.c - g.c) <= 1 GROUP BY 1, 2)
        SELECT g.r, g.c, round(coalesce(g.elevation, n.v), 6) AS elevation FROM fx_dem g LEFT JOIN n ON g.r = n.r AND g.c = n.c""",
    "sobel_gradient": f"""{cte('fx_dem')}, box AS (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM fx_dem),
        k AS (SELECT a.dr, b.dc, a.dr * (2 - abs(b.dc)) AS wx, b.dc * (2 - abs(a.dr)) AS wy FROM range(-1, 2) a(dr), range(-1, 2) b(dc)),
        s AS (SELECT g.r, g.c, count(n.elevation) AS n, sum(n.elevation * wx) AS gx, sum(n.elevation * wy) AS gy FROM fx_dem g CROSS JOIN box CROSS JOIN k
              JOIN fx_dem n ON n.r = greatest(r0, least(r1, g.r + dr)) AND n.c = greatest(c0, least(c1, g.c + dc)) GROUP BY 1, 2)
        SELECT g.r, g.c, round(CASE WHEN n = 9 THEN sqrt(gx * gx + gy * gy) END, 6) AS gradient FROM fx_dem g LEFT JOIN s ON g.r = s.r AND g.c = s.c""",
    "tpi": f"{_tpi(5)} SELECT r, c, round(tpi, 6) AS tpi FROM tpi",
    "tpi_wide": f"{_tpi(11)} SELECT r, c, round(tpi, 6) AS tpi FROM tpi",
    "tpi_thresholds_quantile": f"{_tpi(5)} SELECT round(quantile_cont(tpi, 0.25), 5) AS low, round(quantile_cont(tpi, 0.75), 5) AS high FROM tpi",
    "tpi_thresholds_zscore": f"{_tpi(5)} SELECT round(avg(tpi) - stddev_pop(tpi), 5) AS low, round(avg(tpi) + stddev_pop(tpi), 5) AS high FROM tpi",
    "tpi_thresholds_mad": f"""{_tpi(5)}, m AS (SELECT quantile_cont(tpi, 0.5) AS m FROM tpi), d AS (SELECT quantile_cont(abs(tpi - m), 0.5) AS mad, any_value(m) AS m FROM tpi, m WHERE tpi IS NOT NULL)
        SELECT round(m - 1.4826 * mad, 5) AS low, round(m + 1.4826 * mad, 5) AS high FROM d""",
    "tpi_class": f"""{_tpi(5)}, l AS (SELECT avg(tpi) - stddev_pop(tpi) AS lo, avg(tpi) + stddev_pop(tpi) AS hi FROM tpi)
        SELECT r, c, CAST(CASE WHEN tpi >= hi THEN 1 WHEN tpi <= lo THEN -1 ELSE 0 END AS BIGINT) AS cls FROM tpi, l""",
    "fog_classes": f"""{cte('fx_dem')}, {_KM}, q AS (SELECT id, km - 0.9 AS km FROM p)
        SELECT id, CAST(CASE WHEN km <= 1 THEN 0 WHEN km <= 10 THEN 1 WHEN km IS NOT NULL THEN 2 END AS DOUBLE) AS fog, CAST(CASE WHEN km <= 1 THEN 0 WHEN km <= 10 THEN 1 ELSE 2 END AS DOUBLE) AS fog_clear,
        round(CASE WHEN km > 1 AND km <= 10 THEN km END, 6) AS haze FROM q""",
    "fog_band_stats": f"""{cte('fx_dem')}, {_KM}, q AS (SELECT km / 10 AS km FROM p), n AS (SELECT count(km) AS n_valid, count(*) FILTER (km <= 0.05) AS n_dense, count(*) FILTER (km > 0.05 AND km <= 0.2) AS n_heavy,
        count(*) FILTER (km > 0.2 AND km <= 0.5) AS n_fog, count(*) FILTER (km > 0.5 AND km <= 1) AS n_mist FROM q)
        SELECT *, round(100.0 * n_dense / n_valid, 6) AS pct_dense, round(100.0 * n_heavy / n_valid, 6) AS pct_heavy, round(100.0 * n_fog / n_valid, 6) AS pct_fog, round(100.0 * n_mist / n_valid, 6) AS pct_mist FROM n""",
    "grid_stats": f"""{cte('fx_dem')}, {_KM} SELECT count(*) AS n_cells, count(km) AS n_valid, round(100.0 * count(km) / count(*), 5) AS valid_percent, round(min(km), 5) AS min, round(max(km), 5) AS max,
        round(avg(km), 5) AS mean, round(quantile_cont(km, 0.5), 5) AS median, round(stddev_pop(km), 5) AS std FROM p""",
    "color_bins": f"{cte('fx_dem')}, {_KM} SELECT id, CAST({_COLOUR} AS DOUBLE) AS bin FROM p",
    "bbox_mask": f"{cte('fx_dem')} SELECT id, elevation FROM fx_dem WHERE lat BETWEEN 21.05::DOUBLE AND 21.3::DOUBLE AND lon BETWEEN 110.5::DOUBLE AND 111.5::DOUBLE",
    "polygon_mask": f"{cte('fx_dem')} SELECT id, CASE WHEN {_ring()} THEN elevation END AS elevation FROM fx_dem",
    "value_cdf": f"{cte('fx_national')} SELECT DISTINCT vis AS value, round(cume_dist() OVER (ORDER BY vis), 9) AS share FROM fx_national WHERE vis IS NOT NULL",
    "value_log_bins": f"""{cte('fx_national')} SELECT CAST(least(28, floor((log10(vis) - 2.0) / (3.0 / 29))) AS BIGINT) AS bin, count(*) AS n FROM fx_national WHERE vis BETWEEN 100 AND 100000 GROUP BY 1""",
    "method_correlation": f"""{_estimate(False)} SELECT count(vis_rh) AS n, round(covar_pop(vis_rh, vis_dis) / (stddev_pop(vis_rh) * stddev_pop(vis_dis)), 6) AS correlation FROM stations WHERE is_vis_est = 1""",
    "leave_one_out": f"""{cte('fx_national')}, {_REF}, near AS (SELECT * FROM (SELECT t.seq, t.rh, s.vis AS s_vis, s.rh AS s_rh, {_D} AS d, row_number() OVER (PARTITION BY t.seq ORDER BY {_D}, s.seq) AS k
        FROM ref t, ref s WHERE t.seq <> s.seq) WHERE k <= 4), {_EST} SELECT r.seq, round(0.5 * vis_rh + 0.5 * vis_dis, 3) AS estimated, round(0.5 * vis_rh + 0.5 * vis_dis - vis, 3) + 0.0 AS error FROM ref r JOIN est e ON r.seq = e.seq""",
    "slot5_counts": f"SELECT {_SLOT} AS slot, count(*) AS n_rows, count(DISTINCT user_id) AS n_stations FROM events GROUP BY 1",
    "slot_window": """WITH d AS (SELECT CAST(floor(min(epoch(ts)) / 86400) * 86400 AS BIGINT) AS day FROM events), h AS (SELECT day + h * 3600 + 137 AS now FROM d, range(24) t(h)),
        w AS (SELECT now, CAST(ceil((now - 1800) / 300.0) * 300 AS BIGINT) AS a, CAST(floor((now - 120) / 300.0) * 300 AS BIGINT) AS b FROM h)
        SELECT now, unnest(range(a, b + 1, 300)) AS slot FROM w""",
    "hourly_slots": "SELECT CAST(epoch(t) AS BIGINT) AS slot FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-03 00:00:00', INTERVAL 1 HOUR) s(t)",
    "anti_published": f"SELECT {_HOUR} AS slot, count(*) AS n FROM events WHERE {_HOUR} / 3600 % 3 <> 0 GROUP BY 1",
    "growth_filter": f"""WITH e AS (SELECT {_HOUR} AS slot, user_id % 2 = 0 AS even, floor(epoch(ts)) % 3600 / 60 < 30 AS first FROM events),
        c AS (SELECT slot, count(*) FILTER (even) AS even, count(*) FILTER (NOT even) AS odd, count(*) FILTER (first AND even) AS e0, count(*) FILTER (first AND NOT even) AS o0, bool_or(first) AS had FROM e GROUP BY 1)
        SELECT slot, even, odd FROM c WHERE NOT had OR slot / 3600 % 4 = 0 OR even > e0 OR odd > o0""",
    "queue_claim": f"""WITH h AS (SELECT DISTINCT {_HOUR} AS slot FROM events), q AS (SELECT slot, CASE WHEN slot / 3600 % 5 = 0 THEN 'done' WHEN slot / 3600 % 7 = 0 THEN 'processing' WHEN slot / 3600 % 3 = 0 THEN 'failed' ELSE 'pending' END AS status FROM h),
        t AS (SELECT slot FROM q WHERE status IN ('pending', 'failed') ORDER BY slot LIMIT 10)
        SELECT q.slot, CASE WHEN t.slot IS NOT NULL THEN 'processing' ELSE status END AS status, CAST(1 + CASE WHEN t.slot IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS attempts FROM q LEFT JOIN t ON q.slot = t.slot""",
    "status_tally": f"""WITH h AS (SELECT DISTINCT {_HOUR} AS slot FROM events), q AS (SELECT slot, CASE WHEN slot / 3600 % 5 = 0 THEN 'done' WHEN slot / 3600 % 7 = 0 THEN 'processing' WHEN slot / 3600 % 3 = 0 THEN 'failed' ELSE 'pending' END AS status FROM h),
        t AS (SELECT slot FROM q WHERE status IN ('pending', 'failed') ORDER BY slot LIMIT 10)
        SELECT CASE WHEN slot IN (SELECT slot FROM t) THEN 'processing' ELSE status END AS status, count(*) AS n FROM q GROUP BY 1""",
    "late_rescan": f"""WITH e AS (SELECT {_SLOT} AS slot, CAST(floor(epoch(ts)) AS BIGINT) + event_id * 7919 % 3600 AS a FROM events)
        SELECT slot, count(*) FILTER (a < slot + 300) AS n_on_time, count(*) FILTER (a >= slot + 300 AND a < slot + 1800) AS n_late, count(*) FILTER (a >= slot + 1800) AS n_dropped,
        count(*) FILTER (a >= slot + 300 AND a < slot + 1800) > 0 AS recomputed FROM e GROUP BY 1""",
    "slot_fields": """SELECT event_id, CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS lo, CAST(ceil(epoch_us(ts) / 300000000.0) * 300 AS BIGINT) AS hi, CAST(floor(epoch(ts) / 3600) AS BIGINT) % 6 = 0 AS six_hourly FROM events""",
    "stream_slots": f"SELECT {_SLOT} AS slot, count(*) AS n_rows FROM events GROUP BY 1",
    "slot_texts": """WITH e AS (SELECT event_id, to_timestamp(floor(epoch(ts) / 300) * 300) AT TIME ZONE 'UTC' AS slot FROM events)
        SELECT event_id, strftime(slot, '%Y-%m-%dT%H:%M:%SZ') AS key, strftime(slot + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS local, strftime(slot, '%Y/%m/%d/%Y%m%d%H%M') AS folder, greatest(event_id % 7200 - 3600, 0)::BIGINT AS delay FROM e""",
    "state_merge": f"""WITH {_HOURS}, b AS (SELECT slot, n - 1 AS s, n - 2 AS p FROM c WHERE hour % 2 = 0),
        d AS (SELECT slot, CASE WHEN hour % 5 <> 0 THEN n END AS n, CASE hour // 3 % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'seen' END AS status FROM c WHERE hour % 3 = 0),
        j AS (SELECT coalesce(b.slot, d.slot) AS slot, coalesce(d.n, s) AS s, CASE WHEN d.status = 'success' THEN d.n ELSE p END AS p, b.slot AS had, d.status FROM b FULL JOIN d ON b.slot = d.slot)
        SELECT slot, '{{"n":' || s || '}}' AS last_seen, '{{"n":' || p || '}}' AS last_processed, coalesce(status, 'seen') AS status,
        CASE WHEN status = 'success' THEN NULL WHEN status IS NOT NULL THEN 'new' ELSE 'old' END AS error FROM j""",
    "queue_enqueue": f"""WITH {_HOURS}, {_QUEUE}, a AS (SELECT slot FROM c WHERE hour % 2 = 0)
        SELECT coalesce(q.slot, a.slot) AS slot, CASE WHEN a.slot IS NOT NULL AND coalesce(status, '') <> 'processing' THEN 'pending' ELSE status END AS status, coalesce(attempts, 0)::BIGINT AS attempts,
        CASE WHEN a.slot IS NOT NULL AND coalesce(status, '') <> 'processing' THEN NULL ELSE error END AS error FROM q FULL JOIN a ON q.slot = a.slot""",
    "queue_results": f"""WITH {_HOURS}, {_QUEUE} SELECT slot, CASE WHEN hour % 7 <> 0 THEN status WHEN hour % 2 = 0 THEN 'done' ELSE 'failed' END AS status, attempts::BIGINT AS attempts,
        CASE WHEN hour % 7 <> 0 THEN error WHEN hour % 2 <> 0 THEN 'broken' END AS error FROM q""",
    "work_order": f"""WITH {_HOURS} SELECT slot, row_number() OVER (ORDER BY hour % 24 > 12 DESC, CASE WHEN hour % 24 > 12 THEN -slot ELSE slot END) - 1 AS place FROM c""",
    "month_trend": f"""{cte('fx_pairs')}, {_ERR}, g AS (SELECT model, station_type, strftime(dt, '%Y-%m') AS month, avg(e) AS e FROM err GROUP BY 1, 2, 3)
        SELECT model, station_type, month, round(e, 9) AS mean, round(e - lag(e) OVER (PARTITION BY model, station_type ORDER BY month), 8) + 0.0 AS change FROM g""",
    "marker_sums": f"""{cte('fx_raw_feed')} SELECT seq % 50 AS part, CASE WHEN count(*) = count(m) THEN sum(m)::DOUBLE END AS marker FROM (SELECT seq, CASE WHEN seq % 77 <> 5 THEN update_minute END AS m FROM fx_raw_feed) GROUP BY 1""",
    "union_common": f"{cte('fx_national', 'fx_regional')} SELECT seq, vis FROM fx_national UNION ALL SELECT seq, vis FROM fx_regional",
    "not_negative": f"{cte('fx_dem')} SELECT id, CASE WHEN elevation >= 700 THEN elevation - 700 END AS v FROM fx_dem",
    "request_timings": f"SELECT {_HOUR} AS slot, count(*) AS n_requests, count(*) FILTER (event_id % 9 = 4) AS n_errors, max(floor(abs(value))) AS longest_seconds, sum(floor(abs(value))) AS total_seconds FROM events GROUP BY 1",
    "latest_update": f"""{cte('fx_raw_feed')} SELECT CAST(floor(seq / 100) AS BIGINT) AS part, max(CASE WHEN seq % 5 = 0 OR seq % 7 <> 0 THEN 1704067200 + 60 * update_minute END)::BIGINT AS updated FROM fx_raw_feed GROUP BY 1""",
    "feed_tables": f"""{cte('fx_raw_feed')}, {_FEED}, w AS (SELECT *, CAST(floor(seq / 100) AS BIGINT) AS part FROM feed WHERE code IS NOT NULL),
        k AS (SELECT * FROM w WHERE part % 7 <> 3 QUALIFY row_number() OVER (PARTITION BY part, code ORDER BY (CASE WHEN vis IS NULL THEN 0 ELSE 1 END + CASE WHEN rh IS NULL THEN 0 ELSE 1 END) DESC, update_minute DESC, seq) = 1),
        b AS (SELECT part, count(code) AS n_codes, count(vis) AS n_vis, sum(vis) AS vis, sum(rh) AS rh FROM k GROUP BY 1),
        a AS (SELECT part, CASE WHEN part % 7 = 3 THEN 0 ELSE count(*) END AS n_rows, CASE WHEN part % 7 <> 3 THEN count(*) END AS marker, CASE WHEN part % 7 = 3 THEN 1 ELSE 0 END AS n_errors FROM w GROUP BY 1)
        SELECT a.part, n_rows::BIGINT AS n_rows, marker::DOUBLE AS marker, n_errors::BIGINT AS n_errors, n_codes::DOUBLE AS n_codes, n_vis::DOUBLE AS n_vis, vis, rh FROM a LEFT JOIN b ON a.part = b.part""",
    "gaussian_smooth": f"{cte('fx_dem')}, {_gauss('fx_dem', 'm', 0.8, False)} SELECT r, c, round(smooth, 6) AS smooth FROM m",
    "smooth_steep_cells": f"{cte('fx_dem')}, {_steep('fx_dem', 'm')} SELECT r, c, round(elevation, 6) AS elevation FROM m",
    "fill_linear": f"{cte('fx_dem')}, {_line_fill('fx_dem', 'm', 3)} SELECT r, c, round(elevation, 6) AS elevation FROM m",
    "chain_dem_build": f"""{cte('fx_tiles')}, {_MERGED}, box AS (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM m),
        dense AS MATERIALIZED (SELECT a.r, b.c, m.elevation FROM (SELECT unnest(range(r0, r1 + 1)) AS r FROM box) a CROSS JOIN (SELECT unnest(range(c0, c1 + 1)) AS c FROM box) b LEFT JOIN m ON m.r = a.r AND m.c = b.c),
        {_line_fill('dense', 'lined', 5)}, {_steep('lined', 'smoothed')}, {_near_fill('smoothed', 'filled', 3)} SELECT r, c, round(elevation, 6) AS elevation FROM filled""",
    "cubic_resample": f"""{cte('fx_dem')}, {_FRAME}, {_target(110.003, 21.007, 10, 32, 0.033)},
        p AS (SELECT t.r, t.c, (lat - y0) / 0.02 AS y, (lon - x0) / 0.02 AS x, nr, nc FROM t, f WHERE lat BETWEEN y0 AND y1 AND lon BETWEEN x0 AND x1),
        q AS (SELECT r, c, nr, nc, CAST(least(floor(y), nr - 1) AS BIGINT) AS iy, CAST(least(floor(x), nc - 1) AS BIGINT) AS ix, y - least(floor(y), nr - 1) AS fy, x - least(floor(x), nc - 1) AS fx FROM p),
        k AS ({_SPLINE}), s AS (SELECT k.r, k.c, CASE WHEN count(g.elevation) = count(*) THEN sum(g.elevation * w) END AS v FROM k LEFT JOIN fx_dem g ON k.sr = g.r AND k.sc = g.c WHERE w <> 0 GROUP BY 1, 2)
        SELECT t.r, t.c, round(v, 6) AS elevation FROM t LEFT JOIN s ON t.r = s.r AND t.c = s.c""",
    "tpi_blocks": f"""{_tpi(5).replace('WITH ', 'WITH RECURSIVE ', 1)}, l AS (SELECT avg(tpi) - stddev_pop(tpi) AS lo, avg(tpi) + stddev_pop(tpi) AS hi FROM tpi),
        named AS MATERIALIZED (SELECT r, c, CASE WHEN tpi >= hi THEN 1 WHEN tpi <= lo THEN -1 ELSE 0 END AS cls FROM tpi, l),
        reach AS (SELECT r AS r0, c AS c0, r, c, cls FROM named WHERE cls <> 0
            UNION SELECT x.r0, x.c0, n.r, n.c, n.cls FROM reach x JOIN named n ON n.cls = x.cls AND abs(n.r - x.r) <= 1 AND abs(n.c - x.c) <= 1),
        roots AS (SELECT r0 AS r, c0 AS c, cls, min(r * 1000000 + c) AS root FROM reach GROUP BY 1, 2, 3),
        numbered AS (SELECT r, c, cls, dense_rank() OVER (PARTITION BY cls ORDER BY root) AS label FROM roots),
        most AS (SELECT coalesce(max(label), 0) AS n FROM numbered WHERE cls = 1)
        SELECT k.r, k.c, CAST(k.cls AS BIGINT) AS cls, CAST(coalesce(CASE WHEN k.cls = -1 THEN label + n ELSE label END, 0) AS BIGINT) AS block_id
        FROM named k CROSS JOIN most LEFT JOIN numbered b ON k.r = b.r AND k.c = b.c""",
    "dilation": f"""{cte('fx_dem')} SELECT g.r, g.c, coalesce(bool_or(s.elevation > 1450), false) AS dilated FROM fx_dem g LEFT JOIN fx_dem s ON abs(s.r - g.r) + abs(s.c - g.c) <= 2 GROUP BY 1, 2""",
}
# one result, two engines
ORACLES |= {f"{name}_arrow": ORACLES[name] for name in ("idw_all_candidates", "idw_top_n")}
