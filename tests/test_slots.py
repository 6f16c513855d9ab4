from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyweft.plans import chains
from skyweft.streaming import service, slots


def at(h, m, s=0):
    return datetime(2024, 1, 1, h, m, s, tzinfo=UTC)


def test_windows():
    found = slots.window_times(at(8, 2), 5)
    assert found == [at(7, 35) + timedelta(minutes=5 * i) for i in range(5)]
    assert slots.hourly_times(at(8, 2)) == [at(8, 0), at(7, 0)]


def test_slot_arithmetic(spark):
    ts = spark.createDataFrame([(at(16, 2, 1),), (at(16, 5),)], "ts timestamp")
    got = ts.select(F.unix_timestamp(slots.floor_slot(F.col("ts"))), F.unix_timestamp(slots.ceil_slot(F.col("ts"))), slots.beijing(F.col("ts"))).collect()
    base = int(at(16, 0).timestamp())
    assert (got[0][0], got[0][1], got[0][2]) == (base, base + 300, "2024-01-02 00:02")
    assert (got[1][0], got[1][1]) == (base + 300, base + 300)


def counts(spark, *rows):
    return spark.createDataFrame([(t, c) for t, c in rows], "slot timestamp, counts map<string,bigint>")


def state(spark, tmp_path):
    return slots.StateTable(spark, f"file://{tmp_path}/state")


def test_growth_and_state(spark, tmp_path):
    table = state(spark, tmp_path)
    one = {"national_valid": 2, "regional_valid_rh": 3, "regional_valid_vis": 1}
    seen = []
    publish = lambda chosen: seen.append(sorted(r.slot for r in chosen.collect()))
    slots.run_cycle(counts(spark, (at(8, 0), one), (at(8, 5), dict.fromkeys(one, 0))), table, publish)
    slots.run_cycle(counts(spark, (at(8, 0), one)), table, publish)
    slots.run_cycle(counts(spark, (at(8, 0), one | {"national_valid": 1})), table, publish)  # fewer: nothing to do
    slots.run_cycle(counts(spark, (at(8, 0), one | {"regional_valid_vis": 2})), table, publish)
    assert [len(s) for s in seen] == [1, 0, 0, 1]

    def fail(chosen):
        raise RuntimeError("no space")

    more = one | {"regional_valid_vis": 9}
    slots.run_cycle(counts(spark, (at(8, 0), more)), table, fail)
    row = table.read().where(F.col("slot") == F.lit(at(8, 0))).first()
    assert (row.status, row.error, row.last_processed["regional_valid_vis"], row.last_seen["regional_valid_vis"]) == ("failed", "no space", 2, 9)
    slots.run_cycle(counts(spark, (at(8, 0), more)), table, publish)
    assert table.read().where("status = 'success'").count() == 1
    assert table.commit(table.read(), 0) == table.version()  # a version is written once


def queue(spark, *rows):
    return spark.createDataFrame(list(rows), slots.QUEUE_SCHEMA)


def test_queue(spark):
    q = queue(spark, (at(7, 50), "done", 1, None), (at(7, 55), "processing", 1, None), (at(8, 0), "failed", 2, "x"))
    again = slots.enqueue(q, counts(spark, (at(7, 50), {}), (at(7, 55), {}), (at(8, 5), {})))
    assert {r.slot.minute: r.status for r in again.collect()} == {50: "pending", 55: "processing", 0: "failed", 5: "pending"}
    taken, left = slots.claim(again, at(8, 5), 1)
    assert [r.slot.minute for r in taken.collect()] == [50]
    assert {r.slot.minute: (r.status, r.attempts) for r in left.collect()}[50] == ("processing", 2)
    assert slots.claim(again, None, 0)[0].count() == 0
    results = spark.createDataFrame([(at(7, 50), True, None), (at(8, 0), False, "y")], "slot timestamp, success boolean, error string")
    done = {r.slot.minute: (r.status, r.error) for r in slots.queue_result(left, results).collect()}
    assert done[50] == ("done", None) and done[0] == ("failed", "y") and done[55][0] == "processing"
    started = spark.createDataFrame([(at(7, 55), at(7, 55))], "slot timestamp, claimed_at timestamp")
    assert slots.release_stale(q, started, at(9, 0)).where("status = 'failed'").count() == 2
    order = slots.order_of_work(counts(spark, (at(8, 0), {}), (at(8, 5), {})), counts(spark, (at(6, 0), {}), (at(5, 0), {})))
    assert [r.slot.hour * 60 + r.slot.minute for r in order.collect()] == [485, 480, 300, 360]


def test_counts_as_json(spark):
    got = counts(spark, (at(8, 0), {"a": 1})).select(slots.parse_counts(slots.json_counts(F.col("counts"))).alias("m")).first()
    assert got.m == {"a": 1} and slots.metrics_row(b=2.0, a=1.0) == '{"a": 1.0, "b": 2.0}'


EVENTS = "event_id bigint, ts timestamp, user_id bigint, value double"


def files(spark, tmp_path, *parts):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")


def test_stream_state_equals_batch_and_restarts_do_nothing(spark, tmp_path):
    files(spark, tmp_path, [(i, at(8, i % 10), i % 4, 1.0) for i in range(40)], [(100 + i, at(8, 3), 9, 1.0) for i in range(5)])
    table, published = state(spark, tmp_path), []
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    for _ in range(2):
        slots.run_stream(stream(), table, lambda chosen: published.append(chosen.count()), f"{tmp_path}/checkpoint").awaitTermination()
    batch = slots.slot_counts(spark.read.schema(EVENTS).parquet(f"{tmp_path}/in/*"))
    assert {r.slot: r.last_processed["n"] for r in table.read().collect()} == {r.slot: r.n_rows for r in batch.collect()}
    assert len(published) == 2


def test_growth_of_slots_as_a_stateful_stream(spark, tmp_path):
    files(spark, tmp_path, [(i, at(8, i % 10), i, 1.0) for i in range(20)], [(50, at(8, 1), 1, 1.0)])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = slots.stream_growth(stream).writeStream.format("memory").queryName("growth").outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    query.awaitTermination()
    rows = spark.sql("SELECT slot, max(n_rows) AS n, sum(n_new) AS m FROM growth GROUP BY slot").collect()
    assert sorted((r.n, r.m) for r in rows) == [(10, 10), (11, 11)]


def test_sessions(spark, tmp_path):
    files(spark, tmp_path, [(1, at(8, 0), 1, 1.0), (2, at(8, 10), 1, 1.0), (3, at(9, 30), 1, 1.0)])
    stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in/*")
    query = slots.stream_sessions(stream, "user_id").writeStream.format("memory").queryName("sessions").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.n_rows for r in spark.sql("SELECT * FROM sessions").collect()) == [1, 2]


def test_replayed_stream_equals_batch(spark, sf_dir):
    streamed = {r.slot: r.n_rows for r in chains.replay_events(spark, sf_dir).collect()}
    events = slots.as_utc(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")
    assert streamed == {r.slot: r.n_rows for r in slots.slot_counts(events).select(F.unix_timestamp("slot").alias("slot"), "n_rows").collect()}


def test_a_cycle_of_several_slots_is_one_job(spark):
    schema = "slot int, seq bigint, code string, lon double, lat double, altitude double, rh double, vis double"
    n = spark.createDataFrame([(s, i, f"N{i}", 113.0 + i, 23.0 + i, 10.0, 80.0, 1000.0 * (i + 1)) for s in (1, 2) for i in range(3)], schema)
    r = spark.createDataFrame([(s, 10 + i, f"R{i}", 113.5 + i, 23.2, 12.0, 82.0, None if i else 3000.0) for s in (1, 2) for i in range(2)], schema)
    cells = spark.createDataFrame([(0, 0, 23.5, 113.5, 10.0)], "r bigint, c bigint, lat double, lon double, elevation double")
    stations, grid = chains.cycle(n, r, cells)
    assert grid.count() == 4 and grid.where("v IS NULL").count() == 0
    assert stations.where("source_type = 'national' AND code = 'R0'").first().is_vis_est == 1
    assert stations.where("source_type = 'national_and_regional' AND code = 'R0'").first().is_vis_est == 0


@pytest.mark.parametrize("processed,expected", [(None, True), ({"a": 1}, False), ({"a": 0}, True), ({"b": 5}, True)])
def test_growth_rule(spark, processed, expected):
    row = spark.createDataFrame([({"a": 1}, processed)], "counts map<string,bigint>, last map<string,bigint>")
    assert row.select(slots.grown(F.col("counts"), F.col("last")).alias("g")).first().g is expected


def test_only_one_cycle_at_a_time(spark, tmp_path):
    path = f"file://{tmp_path}/lock"
    with service.CycleLock(spark, path) as first, service.CycleLock(spark, path) as second:
        assert first and not second
    with service.CycleLock(spark, path) as again:
        assert again
        with service.CycleLock(spark, path, lease_seconds=-1) as taken_over:
            assert taken_over


def test_metrics_and_readiness():
    timings = service.Timings()
    with timings.stage("fetch"):
        pass
    assert set(timings.seconds) == {"fetch"}
    assert service.readiness(True, False, True, True, True) == (200, "ready")
    assert service.readiness(True, False, True, True, False) == (200, "degraded")
    assert service.readiness(True, True, True, True, True)[0] == service.readiness(True, False, False, True, True)[0] == 503


def test_a_cycle_starts_two_minutes_behind_its_slot():
    assert [m for m in range(60) if slots.due_slot(at(8, m))] == list(range(2, 60, 5))
    assert slots.due_slot(at(8, 57)) == at(8, 55) and slots.due_slot(at(8, 0)) is None


def test_no_state_is_lost_between_two_writers(spark, tmp_path):
    a, b = state(spark, tmp_path), state(spark, tmp_path)
    change = lambda minute, n: spark.createDataFrame([(at(8, minute), {"n": n}, "success", None)], "slot timestamp, counts map<string,bigint>, status string, error string")
    a.update(change(0, 1))
    seen = a.version()
    b.update(change(5, 2))
    with pytest.raises(slots.Conflict):
        a._commit(slots.merge_state(a.read(seen), change(10, 3)), seen + 1)
    a.update(change(10, 3))
    assert {r.slot.minute: r.last_processed["n"] for r in b.read().collect()} == {0: 1, 5: 2, 10: 3}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The state was committed, the stream's own commit was lost with the driver."""
    files(spark, tmp_path, [(i, at(8, i % 10), i % 4, 1.0) for i in range(40)], [(100 + i, at(8, 3), 9, 1.0) for i in range(5)])
    table, published = state(spark, tmp_path), []
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run = lambda: slots.run_stream(stream(), table, lambda chosen: published.append(chosen.count()), f"{tmp_path}/checkpoint").awaitTermination()
    run()
    before, times = sorted(map(str, table.read().collect())), len(published)
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    run()
    assert sorted(map(str, table.read().collect())) == before and len(published) == times == 2


def test_a_lock_taken_over_is_not_released_by_who_lost_it(spark, tmp_path):
    path = f"file://{tmp_path}/lock"
    first, second = service.CycleLock(spark, path), service.CycleLock(spark, path, lease_seconds=-1)
    assert first.__enter__() and first.held and first.renew()
    assert second.__enter__() and second.held
    assert not first.held and not first.renew()
    first.__exit__()
    assert second.held and not service.CycleLock(spark, path).__enter__()
    second.__exit__()
    with service.CycleLock(spark, path) as again:
        assert again
