import http.server
import threading
import time

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyweft.functions import geo, nearest
from skyweft.operators import cleaning, neighbours, visibility
from skyweft.sources import station_feed as feed

STATION = "seq bigint, code string, name string, city string, county string, lon double, lat double, altitude double, rh double, vis double"
HEAD = "V01301,VF01015_CN,V_CITY,V_COUNTY,V06001,V05001,V07001,V13003,V20001,V20001_701_01,D_UPDATE_TIME"


def national(spark):
    return spark.createDataFrame([(1, "N1", "a", "c", "d", 113.0, 23.0, 10.0, 80.0, 1000.0), (2, "N2", "b", "c", "d", 114.0, 24.0, 20.0, 90.0, 2000.0)], STATION)


def regional(spark):
    return spark.createDataFrame([(11, "R1", "a", "c", "d", 113.2, 23.2, 12.0, 82.0, 3000.0), (12, "R2", "b", "c", "d", 113.8, 23.8, 18.0, 88.0, None)], STATION)


def stored(spark, tmp_path, text, kind="national"):
    (tmp_path / "a.txt").write_bytes(text.encode("utf-8-sig"))
    return feed.read_responses(spark, str(tmp_path), kind)


def test_duplicates_keep_the_more_complete_row(spark, tmp_path):
    raw = stored(spark, tmp_path, f"2\n\n{HEAD}\nN1.0,x,c,d,113,23,10,80,9999,,2024-01-01 00:05:00\n N1 ,x,c,d,113,23,10,80,1000,,2024-01-01 00:00:00\n")
    assert [(r.code, r.vis) for r in feed.clean(raw, "national").collect()] == [("N1", 1000.0)]
    assert raw.first().marker == 2


def test_fallback_before_numbers(spark, tmp_path):
    raw = stored(spark, tmp_path, f"3\n{HEAD}\nA,x,c,d,113,23,10,80,9999,25000,\nB,x,c,d,113,23,10,80,abc,7,\nC,x,c,d,999999,23,10,80,5,7,\n")
    got = {r.code: r for r in feed.clean(raw, "national").collect()}
    assert got["A"].vis == 25000.0
    assert got["B"].vis is None
    assert got["C"].vis == 5.0 and got["C"].lon is None


def test_bad_responses_are_rows_with_errors(spark, tmp_path):
    raw = stored(spark, tmp_path, "1\nV01301,other\nx,y\n")
    assert "lacks fields" in raw.first().error
    assert feed.batch_summary(raw.withColumn("kind", F.lit("national"))).first().n_errors == 1


@pytest.mark.parametrize("text,count", [("12\na", 12), ("\n﻿7\n", 7), ("x\n1", None), ("", None)])
def test_marker(text, count):
    assert feed.marker(text) == count


def test_marker_sum(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None)], "k string, m int")
    assert dict(rows.groupBy("k").agg(cleaning.marker_sum(F.col("m")).alias("m")).collect()) == {"a": 3, "b": None}


def test_secrets_are_masked():
    assert "secret" not in feed.mask("http://h/x?user=u&pwd=secret&Password=secret")
    assert feed.mask(None) == "<unknown>"


def test_lists():
    assert feed.split_list("a, b，a、 c") == ["a", "b", "c"]
    with pytest.raises(ValueError):
        feed.split_list(" , ")


def test_service_reads_each_source_and_isolates_errors(spark):
    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            bad = "province=bad" in self.path
            self.send_response(500 if bad else 200)
            self.end_headers()
            self.wfile.write(b"" if bad else f"1\n{HEAD}\nN1,x,c,d,113,23,10,80,1000,,\n".encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(feed.StationService)
    rows = spark.read.format("stations").options(url=f"http://127.0.0.1:{server.server_port}/x", provinces="good,bad", slots="s1,s2", kinds="national", retries="1").load().collect()
    server.shutdown()
    assert sorted((r.province, r.slot, r.error is None) for r in rows) == [("bad", "s1", False), ("bad", "s2", False), ("good", "s1", True), ("good", "s2", True)]


def test_gbk_table(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("code,name\n1,广州\n".encode("gbk"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    try:
        assert feed.read_table(spark, str(tmp_path / "t.csv"), ["name"], "GBK").first().name == "广州"
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", before)


def test_first_wins_and_common_union(spark):
    a, b = national(spark), national(spark).withColumn("vis", F.lit(5.0)).drop("name")
    assert {r.vis for r in cleaning.first_wins([a, b]).collect()} == {1000.0, 2000.0}
    assert "name" not in cleaning.common_union(a, b).columns


def test_dual_estimation(spark):
    one = {r.code: r for r in visibility.estimate(national(spark), regional(spark), False).collect()}
    both = {r.code: r for r in visibility.estimate(national(spark), regional(spark), True).collect()}
    assert one["R1"].is_vis_est == 1 and one["N1"].is_vis_est == 0 and one["N1"].vis_rh is None
    assert both["R1"].is_vis_est == 0 and both["R1"].vis == 3000.0 and both["R2"].is_vis_est == 1


def test_estimation_in_slots_doesnt_mix_them(spark):
    n = national(spark).withColumn("slot", F.lit(1)).unionByName(national(spark).withColumns({"slot": F.lit(2), "vis": F.col("vis") * 10}))
    r = regional(spark).withColumn("slot", F.lit(1)).unionByName(regional(spark).withColumn("slot", F.lit(2)))
    got = {(x.slot, x.code): x.vis for x in visibility.estimate(n, r, False, by=("slot",)).collect()}
    assert got[2, "R2"] == pytest.approx(10 * got[1, "R2"])


def numpy_idw(cells, stations, beta=10.0, n=6, top=False):
    out = []
    for lat, lon, z in cells:
        order = sorted(range(len(stations)), key=lambda i: (np.hypot(stations[i][0] - lat, stations[i][1] - lon), i))[: 2 * n]
        d = []
        for i in order:
            slat, slon, alt, vis = stations[i]
            dx = 6371 * np.radians(slon - lon) * np.cos(np.radians((slat + lat) / 2))
            dy = 6371 * np.radians(slat - lat)
            d.append((np.sqrt(dx * dx + dy * dy + (beta * (z - alt) / 1000) ** 2), vis))
        d = [x for x in d if x[0] > 0]
        d = sorted(d)[:n] if top else d
        w = [1 / max(x, 1e-12) ** 2 for x, _ in d]
        out.append(sum(a * b[1] for a, b in zip(w, d)) / sum(w) if w else None)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.integers(1, 40))
def test_interpolation_equals_brute_force(spark, seed, n):
    rng = np.random.default_rng(seed)
    stations = [(float(a), float(b), float(c), float(v)) for a, b, c, v in zip(rng.uniform(20, 27, n), rng.uniform(108, 118, n), rng.uniform(0, 900, n), rng.uniform(100, 30000, n))]
    cells = [(float(a), float(b), float(c)) for a, b, c in zip(rng.uniform(20, 27, 25), rng.uniform(108, 118, 25), rng.uniform(0, 900, 25))] + [stations[0][:3]]
    s = spark.createDataFrame([(i, *x) for i, x in enumerate(stations)], "seq bigint, lat double, lon double, altitude double, vis double")
    c = spark.createDataFrame([(i, *x) for i, x in enumerate(cells)], "id bigint, lat double, lon double, elevation double")
    for selection, engine in ((a, b) for a in ("all_candidates", "top_n") for b in (visibility.interpolate, visibility.interpolate_arrow)):
        got = dict(engine(c, s, selection=selection).select("id", "v").collect())
        for i, v in enumerate(numpy_idw(cells, stations, top=selection == "top_n")):
            assert (got[i] is None and v is None) or got[i] == pytest.approx(v, rel=1e-9)
            if v is not None:
                assert min(x[3] for x in stations) - 1e-6 <= got[i] <= max(x[3] for x in stations) + 1e-6


def test_more_stations_than_the_limit_give_the_same(spark):
    rng = np.random.default_rng(3)
    s = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(20, 40, 300), rng.uniform(100, 130, 300)))], "seq bigint, lat double, lon double")
    t = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(18, 42, 60), rng.uniform(98, 132, 60)))], "id bigint, lat double, lon double")
    pick = lambda df: {r.id: [x.seq for x in r.near] for r in df.collect()}
    assert pick(neighbours.nearest_stations(t, s, 5, ())) == pick(neighbours.nearest_stations(t, s, 5, (), max_stations=10))
    ranked = neighbours.nearest_by_rank(t, s, 5, "id", ()).select("id", "rank", "s.s.seq").collect()
    assert {(r.id, r.rank): r.seq for r in ranked} == {(i, k + 1): x for i, xs in pick(neighbours.nearest_stations(t, s, 5, ())).items() for k, x in enumerate(xs)}


def test_sql_functions(spark):
    geo.register_sql(spark)
    a = spark.sql("SELECT geo_km(23D, 113D, 24D, 114D) AS d, aniso_km(3D, 0D, 400D, 10D) AS a").first()
    b = spark.range(1).select(geo.geo_km(F.lit(23.0), F.lit(113.0), F.lit(24.0), F.lit(114.0)).alias("d")).first()
    assert a.d == pytest.approx(b.d) and a.a == pytest.approx(5.0)


def test_empty_and_null_stations(spark):
    cells = spark.createDataFrame([(1, 23.0, 113.0, 1.0)], "id bigint, lat double, lon double, elevation double")
    none = national(spark).withColumn("vis", F.lit(None).cast("double"))
    assert [r.v for r in visibility.interpolate(cells, none).collect()] in ([], [None])
    assert visibility.estimate(national(spark), regional(spark).limit(0), True).count() == 2


def test_service_retries_bounds_requests_and_tells_everything(spark):
    """Bounded concurrency, timings, bodies in errors, and every failure as a row."""
    active, most, asked, guard = 0, 0, {}, threading.Lock()

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            nonlocal active, most
            with guard:
                active += 1
                most = max(most, active)
                asked[self.path] = asked.get(self.path, 0) + 1
                tries = asked[self.path]
            time.sleep(0.05)
            name = self.path.split("province=")[1].split("&")[0]
            status, body = {"down": (503, b"out of order"), "binary": (200, b"\xff\xfe\xfa"), "late": (200 if tries > 1 else 500, f"1\n{HEAD}\nN1,x,c,d,113,23,10,80,1000,,\n".encode())}.get(name, (200, b"upstream error"))
            with guard:
                active -= 1
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(feed.StationService)
    options = {"url": f"http://127.0.0.1:{server.server_port}/x", "provinces": "down,binary,late,odd", "slots": "2024-01-01T08:00:00,2024-01-01T08:05:00", "slot_format": "%Y%m%d%H%M%S", "interfaces": "national=A1,regional=B2", "retries": "2", "concurrency": "2", "pwd": "secret"}
    responses = spark.read.format("stations").options(**options).load().cache()
    rows = responses.collect()
    server.shutdown()
    assert len(rows) == 16 and most <= 2 and all(r.seconds > 0 and "secret" not in f"{r.url}{r.error}" for r in rows)
    assert any("kind=A1" in p and "slot=20240101080500" in p and "pwd=secret" in p for p in asked)
    told = {r.province: (r.attempts, r.error) for r in rows}
    assert told["late"] == (2, None) and told["down"][0] == 2 and "503" in told["down"][1] and "out of order" in told["down"][1]
    assert "isn't UTF-8" in told["binary"][1] and "pwd=%2A%2A%2A" in told["down"][1]
    read = {r.source: r for r in feed.parsed(responses, source="province").collect()}
    assert "no count line" in read["odd"].error and "upstream error" in read["odd"].error and read["late"].V01301 == "N1" and read["late"].marker == 1
    timings = feed.request_timings(responses).collect()
    assert len(timings) == 2 and all(t.n_requests == 8 and t.n_errors == 4 and t.total_seconds >= t.longest_seconds > 0 for t in timings)
    assert [r.complete for r in feed.complete(responses).collect()] == [True, True]
    assert [r.complete for r in feed.complete(responses.where("province = 'down'")).collect()] == [False, False]


def test_many_stations_in_a_slot_are_searched_over_rings(spark):
    rng = np.random.default_rng(8)
    rows = [(s, i, float(rng.uniform(20, 25)), float(rng.uniform(110, 115))) for s in (1, 2) for i in range(60 if s == 1 else 3)]
    stations = spark.createDataFrame(rows, "slot int, seq bigint, lat double, lon double")
    targets = spark.createDataFrame([(s, i, float(rng.uniform(20, 25)), float(rng.uniform(110, 115))) for s in (1, 2) for i in range(20)], "slot int, id int, lat double, lon double")
    flat = lambda most: sorted((r.slot, r.id, [n.seq for n in r.near]) for r in neighbours.nearest_stations(targets, stations, 4, (), ["slot"], max_stations=most).collect())
    assert flat(10) == flat(1000) and [len(n) for s, _, n in flat(10) if s == 2] == [3] * 20


def brute(targets, stations, k):
    """The stations (seq, lat, lon) nearest to each target (id, lat, lon)."""
    s = np.array(stations, float)
    out = {}
    for i, lat, lon in targets:
        dy, dx = lat - s[:, 1], lon - s[:, 2]
        out[i] = [int(x) for x in s[np.lexsort((s[:, 0], np.sqrt(dy * dy + dx * dx))), 0][:k]]
    return out


def candidates(monkeypatch, targets, stations, k, **options):
    """How many stations each target compares."""
    with monkeypatch.context() as m:
        m.setattr(neighbours, "ranked", lambda st, lat, lon, k: F.size(st))
        return {r.id: r.near for r in neighbours.nearest_stations(targets, stations, k, (), **options).collect()}


def test_cells_far_from_many_stations_compare_few(spark, monkeypatch):
    """grids reach far beyond their stations, where all stations of an edge are about as near."""
    rng = np.random.default_rng(11)
    stations = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(20, 25.5, 8000), rng.uniform(109, 117, 8000)))]
    targets = [(i * 100 + j, lat + 0.01 + j // 10 * 0.02, 110.01 + j % 10 * 0.02) for i, lat in enumerate((23.0, 30.0, 60.0, 120.0, 250.0)) for j in range(100)]
    s, t = spark.createDataFrame(stations, "seq bigint, lat double, lon double"), spark.createDataFrame(targets, "id bigint, lat double, lon double")
    wanted = brute(targets, stations, 12)
    assert {r.id: [n.seq for n in r.near] for r in neighbours.nearest_stations(t, s, 12, ()).collect()} == wanted
    assert max(candidates(monkeypatch, t, s, 12).values()) <= 100


def test_copies_at_one_place_are_compared_as_often_as_asked_for(spark, monkeypatch):
    """stations of both networks at equal places, of which ties by seq prefer the first."""
    rng = np.random.default_rng(12)
    places = [(float(a), float(b)) for a, b in zip(rng.uniform(20, 25, 60), rng.uniform(110, 115, 60))]
    stations = [(int(i), *places[j % 60 if j < 600 else 7]) for j, i in enumerate(rng.permutation(2600))]
    targets = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(18, 27, 80), rng.uniform(108, 117, 80)))] + [(80, *places[7])]
    s, t = spark.createDataFrame(stations, "seq bigint, lat double, lon double"), spark.createDataFrame(targets, "id bigint, lat double, lon double")
    got = {r.id: [n.seq for n in r.near] for r in neighbours.nearest_stations(t, s, 12, (), max_stations=100).collect()}
    assert got == brute(targets, stations, 12)
    assert max(candidates(monkeypatch, t, s, 12, max_stations=100).values()) <= 12 * 60


def test_dense_references_are_not_all_compared(spark, monkeypatch):
    """references as dense as the regional stations, and a slot without."""
    rng = np.random.default_rng(13)
    stations = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(22, 22.6, 6000), rng.uniform(113, 113.6, 6000)))]
    targets = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(22, 22.6, 400), rng.uniform(113, 113.6, 400)))] + [(400, -80.0, -170.0)]
    s, t = spark.createDataFrame(stations, "seq bigint, lat double, lon double"), spark.createDataFrame(targets, "id bigint, lat double, lon double")
    assert {r.id: [n.seq for n in r.near] for r in neighbours.nearest_stations(t, s, 4, ()).collect()} == brute(targets, stations, 4)
    assert max(candidates(monkeypatch, t, s, 4).values()) <= 300
    slots = neighbours.nearest_stations(t.withColumn("slot", F.lit(1)).unionByName(t.withColumn("slot", F.lit(2))), s.withColumn("slot", F.lit(1)), 4, (), ["slot"])
    assert {(r.slot, r.id): [n.seq for n in r.near] for r in slots.collect()} == {(1, i): x for i, x in brute(targets, stations, 4).items()}


@pytest.mark.parametrize("selection", ["all_candidates", "top_n"])
def test_interpolation_from_many_stations(spark, monkeypatch, selection):
    """F4 (all candidates) and F5 (the best of them): values on a grid that leaves its stations behind, and what a cell compares."""
    rng = np.random.default_rng(14)
    n = 6000
    stations = [(float(a), float(b), float(c), float(v)) for a, b, c, v in zip(rng.uniform(20, 25.5, n), rng.uniform(109, 117, n), rng.uniform(0, 900, n), rng.uniform(100, 30000, n))]
    cells = [(lat + i // 10 * 0.02, 110.0 + i % 10 * 0.02, float(i * 53 % 1500)) for lat in (21.0, 25.4, 40.0, 200.0) for i in range(60)]
    s = spark.createDataFrame([(i, *x) for i, x in enumerate(stations)], "seq bigint, lat double, lon double, altitude double, vis double")
    c = spark.createDataFrame([(i, *x) for i, x in enumerate(cells)], "id bigint, lat double, lon double, elevation double")
    got = dict(visibility.interpolate(c, s, selection=selection).select("id", "v").collect())
    some = range(0, len(cells), 7)
    for i, v in zip(some, numpy_idw([cells[i] for i in some], stations, top=selection == "top_n")):
        assert got[i] == pytest.approx(v, rel=1e-9)
    assert len(got) == len(cells) and max(candidates(monkeypatch, c, s, 12).values()) <= 100


def numpy_estimates(targets, stations):
    """vis_rh and vis_dis of targets (id, lat, lon, rh) from the 4 nearest of stations (seq, lat, lon, rh, vis)."""
    s, out = {x[0]: x for x in stations}, {}
    for (i, near), t in zip(brute([t[:3] for t in targets], [x[:3] for x in stations], 4).items(), targets):
        d = [max(np.hypot(s[j][1] - t[1], s[j][2] - t[2]), 0.001) for j in near]
        h = [max(abs(s[j][3] - t[3]), 0.1) for j in near]
        out[i] = tuple(sum(s[j][4] / x**2 for j, x in zip(near, w)) / sum(1 / x**2 for x in w) for w in (h, d))
    return out


def no_expressions(monkeypatch):
    """Many stations are a hundred; ranking them in expressions, an entry at a time, is what took too long."""
    monkeypatch.setattr(neighbours, "LISTED", 100)
    monkeypatch.setattr(neighbours, "ranked", lambda *a: pytest.fail("many stations are ranked by expressions"))


@pytest.mark.parametrize("part", [50_000, 7])
def test_estimates_from_many_references_are_searched_in_batches(spark, monkeypatch, part):
    """copies at one place, targets far off and at stations, boxes of more targets than a batch takes, slots with few references or none."""
    no_expressions(monkeypatch)
    monkeypatch.setattr(neighbours, "PART", part)
    rng = np.random.default_rng(15)
    places = [(float(a), float(b)) for a, b in zip(rng.uniform(20, 25, 250), rng.uniform(110, 115, 250))]
    stations = [(int(i), *places[j % 250 if j < 500 else 7], float(rng.uniform(40, 100)), float(rng.uniform(200, 30000))) for j, i in enumerate(rng.permutation(520))]
    targets = [(i, float(a), float(b), float(rng.uniform(40, 100))) for i, (a, b) in enumerate(zip(rng.uniform(18, 27, 80), rng.uniform(108, 117, 80)))]
    targets += [(80, *places[7], 50.0), (81, 200.0, 112.0, 60.0)]
    s, t = spark.createDataFrame(stations, "seq bigint, lat double, lon double, rh double, vis double"), spark.createDataFrame(targets, "id bigint, lat double, lon double, rh double")
    none = spark.createDataFrame([(90, None, 112.0, 50.0)], t.schema)
    slot = lambda df, n: df.withColumn("slot", F.lit(n).cast("int"))
    references = slot(s, 1).unionByName(slot(s.where("seq < 3"), 2))
    found = visibility.estimates(slot(t.unionByName(none), 1).unionByName(slot(t, 2)).unionByName(slot(t, 3)), references, by=("slot",)).collect()
    wanted = {(1, i): x for i, x in numpy_estimates(targets, stations).items()} | {(2, i): x for i, x in numpy_estimates(targets, [x for x in stations if x[0] < 3]).items()}
    assert sorted((r.slot, r.id) for r in found) == sorted(wanted)
    for r in found:
        assert (r.vis_rh, r.vis_dis, r.vis) == pytest.approx((*wanted[r.slot, r.id], sum(wanted[r.slot, r.id]) / 2), rel=1e-9)


def test_targets_in_numpy_find_their_nearest():
    """the search within a batch, with ties, few stations, none, and targets at one place."""
    rng = np.random.default_rng(16)
    for n, m, k in ((900, 400, 4), (900, 3, 4), (5, 400, 12), (300, 0, 4), (0, 9, 4)):
        y, x = np.round(rng.uniform(20, 25, (2, n)), 1)
        sy, sx = np.round(rng.uniform(21, 24, (2, m)), 1)
        y[: n // 3], x[: n // 3], sy[: m // 3], sx[: m // 3] = 22.0, 22.0, 23.0, 23.0
        chosen, d = nearest.nearest_rows(y, x, sy, sx, k)
        assert chosen.shape == d.shape == (n, min(k, m))
        if m:
            assert dict(enumerate(chosen.tolist())) == brute(list(zip(range(n), y, x)), list(zip(range(m), sy, sx)), k)


def scattered(spark, seed, n):
    """Stations, cells around, far from and at them, and both as tables; a cell without elevation, ids from 0."""
    rng = np.random.default_rng(seed)
    stations = [(float(a), float(b), float(c), float(v)) for a, b, c, v in zip(rng.uniform(20, 25, n), rng.uniform(110, 115, n), rng.uniform(0, 900, n), rng.uniform(100, 30000, n))]
    stations += [stations[0][:2] + (z, v) for z, v in ((stations[0][2] + 7, 900.0), (stations[0][2] - 7, 100.0)) * 4]
    cells = [(float(a), float(b), float(c)) for a, b, c in zip(rng.uniform(18, 27, 90), rng.uniform(108, 117, 90), rng.uniform(0, 900, 90))] + [stations[0][:3], (200.0, 112.0, 5.0)]
    s = spark.createDataFrame([(i, *x) for i, x in enumerate(stations)], "seq bigint, lat double, lon double, altitude double, vis double")
    c = spark.createDataFrame([(i, *x) for i, x in enumerate([*cells, (22.0, 112.0, None)])], "id bigint, lat double, lon double, elevation double")
    return stations, cells, s, c


@pytest.mark.parametrize("part", [50_000, 7])
def test_all_candidates_of_many_stations_are_weighted_in_batches(spark, monkeypatch, part):
    """F4"""
    no_expressions(monkeypatch)
    monkeypatch.setattr(neighbours, "PART", part)
    stations, cells, s, c = scattered(spark, 17, 400)
    got = {r.id: r for r in visibility.interpolate(c, s).collect()}
    assert len(got) == len(cells) + 1 and got[len(cells)].v is None
    for i, v in enumerate(numpy_idw(cells, stations)):
        assert (got[i].lat, got[i].lon, got[i].elevation) == cells[i] and got[i].v == pytest.approx(v, rel=1e-9)


@pytest.mark.parametrize("part", [50_000, 7])
def test_the_best_of_many_stations_are_weighted_in_batches(spark, monkeypatch, part):
    """of candidates, among them four pairs at one place and equal distance, the six best by distance and seq."""
    no_expressions(monkeypatch)
    monkeypatch.setattr(neighbours, "PART", part)
    stations, cells, s, c = scattered(spark, 18, 400)
    got = {r.id: r for r in visibility.interpolate(c, s, selection="top_n").collect()}
    assert len(got) == len(cells) + 1 and got[len(cells)].v is None
    for i, v in enumerate(numpy_idw(cells, stations, top=True)):
        if cells[i] != stations[0][:3]:
            assert got[i].v == pytest.approx(v, rel=1e-9)
    vis, up = [900.0, 100.0] * 3, [round(abs(z - stations[0][2]), 6) for _, _, z, _ in stations[400:406]]
    assert up == [7.0] * 6 and got[cells.index(stations[0][:3])].v == pytest.approx(sum(vis) / 6, rel=1e-9)


def test_equal_distances_prefer_the_first_station():
    """the first station is as far to the east as the second is below, so that distances are equal and degrees are not; seq decides."""
    east = 6371.0 * np.radians(1.0)
    height = east * 100.0
    assert 10.0 * height / 1000.0 == east
    stations = np.array([[0.0, 1.0, height, 100.0], [0.0, 0.0, 0.0, 900.0]])
    assert visibility.chosen_mean(np.zeros(1), np.zeros(1), np.array([height]), stations, np.array([[1, 0]]), 10.0, 2.0, 1)[0] == 100.0
