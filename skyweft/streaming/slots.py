"""Five-minute slots, the state of their processing, and the same as Structured Streaming.

Batch and stream share one rule: a slot is processed when any of its counts exceeds what was processed before (or is positive the first time);
decreases and failures leave that baseline as it is. Slots are whole seconds since the epoch, so no expression depends on a time zone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..commits import create_once, read_text

SLOT_SECONDS, RESCAN_MINUTES, READY_DELAY_MINUTES = 300, 30, 2
STATE_SCHEMA = "slot timestamp, last_seen map<string,bigint>, last_processed map<string,bigint>, status string, error string"
QUEUE_SCHEMA = "slot timestamp, status string, attempts int, error string"


def floor_slot(ts: Column, seconds: int = SLOT_SECONDS) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def ceil_slot(ts: Column, seconds: int = SLOT_SECONDS) -> Column:
    return F.timestamp_seconds(F.ceil(F.unix_micros(ts) / (seconds * 1_000_000)) * seconds)


def six_hourly(ts: Column) -> Column:
    """Whether a UTC time lies in an hour that is a multiple of six."""
    return F.floor(F.unix_timestamp(ts) / 3600) % 6 == 0


def beijing(ts: Column) -> Column:
    """The local text of a UTC time, eight hours ahead."""
    return F.date_format(ts + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd HH:mm")


def window_times(now: datetime, delay_minutes: int = READY_DELAY_MINUTES, back_minutes: int = RESCAN_MINUTES) -> list[datetime]:
    """The slots to scan at `now`: from half an hour back, rounded up, to the delay, rounded down."""
    step = timedelta(seconds=SLOT_SECONDS)
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    now = now.replace(tzinfo=UTC) if now.tzinfo is None else now.astimezone(UTC)
    at = epoch + -((epoch - (now - timedelta(minutes=back_minutes))) // step) * step
    last = epoch + (now - timedelta(minutes=delay_minutes) - epoch) // step * step
    first = at if at >= now - timedelta(minutes=back_minutes) else at + step
    return [first + i * step for i in range(max(0, (last - first) // step + 1))]


def hourly_times(now: datetime, hours: int = 2) -> list[datetime]:
    """The last completed hours, latest first."""
    top = now.replace(minute=0, second=0, microsecond=0)
    return [top - timedelta(hours=i) for i in range(hours)]


def as_utc(rows: DataFrame, ts: str) -> DataFrame:
    """rows with a time without zone read as UTC, whatever the session's zone; other times as they are."""
    if rows.schema[ts].dataType.typeName() != "timestamp_ntz":
        return rows
    return rows.withColumn(ts, F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`))"))


def slot_range(spark: SparkSession, first: datetime, last: datetime, seconds: int = 3600) -> DataFrame:
    """(slot): an inclusive sequence of UTC times."""
    a, b = (int(x.replace(tzinfo=x.tzinfo or UTC).timestamp()) for x in (first, last))
    return spark.range(a, b + 1, seconds).select(F.timestamp_seconds("id").alias("slot"))


def slot_counts(rows: DataFrame, ts: str = "ts", station: str = "user_id", by: Sequence[str] = ()) -> DataFrame:
    """(slot, n_rows, n_stations)"""
    return rows.groupBy(*by, floor_slot(F.col(ts)).alias("slot")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(station).alias("n_stations"))


def unpublished(slots: DataFrame, published: DataFrame, by: str = "slot") -> DataFrame:
    """Slots without an output."""
    return slots.join(published.select(by), by, "left_anti")


def grown(counts: Column, processed: Column) -> Column:
    """Whether any count (a map) exceeds its processed one; without a baseline, whether any is positive."""
    above = F.exists(F.map_keys(counts), lambda k: F.coalesce(F.try_element_at(counts, k), F.lit(0)) > F.coalesce(F.try_element_at(processed, k), F.lit(0)))
    return F.coalesce(above, F.lit(False)) if processed is None else F.when(processed.isNull(), F.exists(F.map_values(counts), lambda v: v > 0)).otherwise(above)


def to_process(current: DataFrame, state: DataFrame) -> DataFrame:
    """current (slot, counts map) -> the slots to process."""
    joined = current.join(state.select("slot", "last_processed"), "slot", "left")
    return joined.where(grown(F.col("counts"), F.col("last_processed"))).drop("last_processed")


def merge_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """state with changes (slot, counts or NULL, status, error) put in: a success moves the processed counts, nothing else does; counts of NULL keep
    what was seen; the newest status and error stand."""
    c = changes.select("slot", F.col("counts").alias("__counts"), F.col("status").alias("__status"), F.col("error").alias("__error"))
    both = state.join(c, "slot", "full")
    changed, success = F.col("__status").isNotNull(), F.col("__status") == "success"
    return both.select(
        "slot",
        F.coalesce("__counts", "last_seen").alias("last_seen"),
        F.when(F.coalesce(success, F.lit(False)), F.col("__counts")).otherwise(F.col("last_processed")).alias("last_processed"),
        F.coalesce("__status", "status").alias("status"),
        F.when(changed, F.when(success, None).otherwise(F.col("__error"))).otherwise(F.col("error")).alias("error"),
    )


def enqueue(queue: DataFrame, slots: DataFrame) -> DataFrame:
    """queue with slots pending again, done ones included; those in processing stay as they are."""
    both = queue.join(slots.select("slot").distinct().withColumn("__new", F.lit(True)), "slot", "full")
    busy, new = F.coalesce(F.col("status") == "processing", F.lit(False)), F.col("__new").isNotNull()
    return both.select("slot", F.when(new & ~busy, "pending").otherwise(F.col("status")).alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"), F.when(new & ~busy, None).otherwise(F.col("error")).alias("error"))


def claim(queue: DataFrame, exclude: datetime | None, limit: int) -> tuple[DataFrame, DataFrame]:
    """(the oldest pending or failed slots, `limit` at most and without `exclude`; the queue with them in processing)"""
    free = F.col("status").isin("pending", "failed") & (F.lit(True) if exclude is None else F.col("slot") != F.lit(exclude))
    taken = queue.where(free).orderBy("slot").limit(max(0, limit)).select("slot")
    marked = queue.join(taken.withColumn("__t", F.lit(True)), "slot", "left")
    mine = F.col("__t").isNotNull()
    return taken, marked.select("slot", F.when(mine, "processing").otherwise(F.col("status")).alias("status"), (F.col("attempts") + mine.cast("int")).alias("attempts"), "error")


def release_stale(queue: DataFrame, started: DataFrame, now: datetime, lease_minutes: int = 30) -> DataFrame:
    """queue with slots back to failed that were claimed over a lease ago (started: slot, claimed_at): a lost worker doesn't keep them for ever."""
    late = started.where(F.col("claimed_at") < F.lit(now - timedelta(minutes=lease_minutes))).select("slot", F.lit(True).alias("__late"))
    back = (F.col("status") == "processing") & F.col("__late").isNotNull()
    return queue.join(late, "slot", "left").withColumn("status", F.when(back, "failed").otherwise(F.col("status"))).drop("__late")


def queue_result(queue: DataFrame, results: DataFrame) -> DataFrame:
    """queue with results (slot, success, error): done or failed."""
    r = results.select("slot", "success", F.col("error").alias("__error"))
    return queue.join(r, "slot", "left").select("slot", F.when(F.col("success").isNull(), F.col("status")).when(F.col("success"), "done").otherwise("failed").alias("status"), "attempts", F.when(F.col("success").isNull(), F.col("error")).otherwise(F.col("__error")).alias("error"))


def order_of_work(latest: DataFrame, backfill: DataFrame) -> DataFrame:
    """The newest slots first, then the backlog oldest first."""
    both = latest.select("slot", F.lit(0).alias("p"), (-F.unix_timestamp("slot")).alias("o")).unionByName(backfill.select("slot", F.lit(1).alias("p"), F.unix_timestamp("slot").alias("o")))
    return both.orderBy("p", "o").select("slot")


def late_rescan(rows: DataFrame, ts: str = "ts", arrived: str = "arrived", station: str = "user_id") -> DataFrame:
    """(slot, n_on_time, n_late, n_dropped, recomputed): stations that came within the slot's half hour raise its counts, later ones are not scanned again."""
    slot = floor_slot(F.col(ts))
    end, limit = F.unix_timestamp(slot) + SLOT_SECONDS, F.unix_timestamp(slot) + 60 * RESCAN_MINUTES
    at = F.unix_timestamp(arrived)
    counted = rows.groupBy(slot.alias("slot")).agg(F.count_if(at < end).alias("n_on_time"), F.count_if((at >= end) & (at < limit)).alias("n_late"), F.count_if(at >= limit).alias("n_dropped"))
    return counted.withColumn("recomputed", F.col("n_late") > 0)


# Structured Streaming


def stream_counts(stream: DataFrame, ts: str = "ts", watermark: str = "30 minutes", width: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """(slot, n_rows, total): event-time windows behind a watermark; late rows raise their window until it closes. slide makes windows overlap."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, watermark).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")).select(F.col("w.start").alias("slot"), "n_rows", "total")


def stream_sessions(stream: DataFrame, key: str, ts: str = "ts", gap: str = "30 minutes", watermark: str = "30 minutes") -> DataFrame:
    """An extension: (key, start, end, n_rows) of session windows."""
    w = F.session_window(ts, gap)
    return stream.withWatermark(ts, watermark).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n_rows")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_rows")


def stream_growth(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """(slot, n_rows, n_new): each time a slot's count has grown, its new count. State is one number a slot and leaves with the watermark."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new = sum(len(f) for f in frames)
        before = state.get[0] if state.exists else 0
        state.update((before + new,))
        state.setTimeoutTimestamp(max(int(pd.Timestamp(key[0]).timestamp() * 1000) + 60_000 * RESCAN_MINUTES, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"slot": [key[0]], "n_rows": [before + new], "n_new": [new]})

    slotted = stream.withWatermark(ts, f"{RESCAN_MINUTES} minutes").select(floor_slot(F.col(ts)).alias("slot"), ts)
    return slotted.groupBy("slot").applyInPandasWithState(step, "slot timestamp, n_rows bigint, n_new bigint", "n bigint", "update", "EventTimeTimeout")


class Conflict(Exception):
    """Another writer has committed this version."""


class StateTable:
    """The slots' state as versions of one Parquet table. A version's rows lie in a folder of their own and count once its pointer appears, which only one
    writer can create; the pointer also says which batch of each stream the version has taken in."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        folder = self._path(f"{self.root}/commits")
        if not self._fs.exists(folder):
            return -1
        return max((int(f.getPath().getName()) for f in self._fs.listStatus(folder) if f.getPath().getName().isdigit()), default=-1)

    def _pointer(self, version: int) -> dict:
        return {"folder": None, "batches": {}} if version < 0 else json.loads(read_text(self.spark, f"{self.root}/commits/{version}"))

    def read(self, version: int | None = None) -> DataFrame:
        folder = self._pointer(self.version() if version is None else version)["folder"]
        return self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/{folder}") if folder else self.spark.createDataFrame([], STATE_SCHEMA)

    def batch(self, stream: str) -> int:
        """The last batch of a stream that the state has taken in, -1 if none."""
        return self._pointer(self.version())["batches"].get(stream, -1)

    def commit(self, state: DataFrame, version: int | None = None) -> int:
        """Writes a version, the next one if none is named; Conflict if another writer is faster. Writing a version again that is there changes nothing."""
        last = self.version()
        return last if version is not None and version <= last else self._commit(state, last + 1 if version is None else version)

    def _commit(self, state: DataFrame, v: int, batch: tuple[str, int] | None = None) -> int:
        folder = f"data/{uuid.uuid4().hex}"
        state.select("slot", "last_seen", "last_processed", "status", "error").write.parquet(f"{self.root}/{folder}")
        batches = self._pointer(v - 1)["batches"] | (dict([batch]) if batch else {})
        if not create_once(self.spark, f"{self.root}/commits/{v}", json.dumps({"folder": folder, "batches": batches})):
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)
            raise Conflict(v)
        return v

    def update(self, changes: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Merges changes (slot, counts, status, error) into the last version; again on top of what others commit meanwhile."""
        while True:
            v = self.version()
            try:
                return self._commit(merge_state(self.read(v), changes), v + 1, batch)
            except Conflict:
                continue


def run_cycle(counts: DataFrame, state: StateTable, publish, batch: tuple[str, int] | None = None) -> DataFrame:
    """One batch: choose the slots that have grown, publish them as one job, commit the new state. Returns (slot, status). publish(slots) may raise: then
    the chosen slots are failed and their baseline stays. It replaces a slot's outputs as a whole, since it is asked again for a slot if the driver is lost
    between publishing and committing. batch: (stream, number), noted with the state."""
    version = state.version()
    now = state.read(version)
    chosen = to_process(counts, now).select("slot", "counts")
    status, error = "success", None
    try:
        publish(chosen)
    except Exception as e:
        status, error = "failed", str(e)[:500]
    done = chosen.select("slot", "counts", F.lit(status).alias("status"), F.lit(error).cast("string").alias("error"))
    skipped = counts.join(chosen.select("slot"), "slot", "left_anti").select("slot", "counts", F.lit("seen").alias("status"), F.lit(None).cast("string").alias("error"))
    state.update(done.unionByName(skipped), batch)
    return state.read().select("slot", "status")


def run_stream(stream: DataFrame, state: StateTable, publish, checkpoint: str, ts: str = "ts", interval: str | None = None) -> StreamingQuery:
    """run_cycle() for each micro-batch of new rows. A batch that is replayed after its state was committed changes nothing and publishes nothing, as the
    state names the last batch it has taken in from this checkpoint. interval: a processing time, or what there is now and then end."""

    def batch(rows: DataFrame, number: int) -> None:
        if number <= state.batch(checkpoint):
            return
        counts = rows.groupBy(floor_slot(F.col(ts)).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        before = state.read().select("slot", F.coalesce(F.try_element_at("last_seen", F.lit("n")), F.lit(0)).alias("was"))
        total = counts.join(before, "slot", "left").select("slot", F.create_map(F.lit("n"), F.col("n") + F.coalesce("was", F.lit(0))).alias("counts"))
        run_cycle(total, state, publish, (checkpoint, number))

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def due_slot(now: datetime, first_minute: int = READY_DELAY_MINUTES) -> datetime | None:
    """The slot whose cycle starts in this minute (minutes 2, 7, ..., 57), None in any other; a caller runs each slot once."""
    minute = now.minute - first_minute
    if minute % (SLOT_SECONDS // 60):
        return None
    return now.replace(second=0, microsecond=0) - timedelta(minutes=first_minute)


def time_key(ts: Column) -> Column:
    """A UTC time as text that sorts as the time does."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def path_parts(ts: Column) -> Column:
    """Where a slot's outputs lie: year/month/day/stamp."""
    return F.date_format(ts, "yyyy/MM/dd/yyyyMMddHHmm")


def delay_seconds(now: Column, updated: Column) -> Column:
    """How long after its source's update a slot came out, 0 at least."""
    return F.greatest(F.unix_timestamp(now) - F.unix_timestamp(updated), F.lit(0))


def json_counts(counts: Column) -> Column:
    return F.to_json(counts)


def parse_counts(text: Column) -> Column:
    return F.from_json(text, "map<string,bigint>")


def metrics_row(**seconds: float) -> str:
    """Per-stage seconds as they are kept beside a slot."""
    return json.dumps(seconds, sort_keys=True)


def month_over_month(means: DataFrame, by: Sequence[str]) -> DataFrame:
    return means.withColumn("change", F.col("mean") - F.lag("mean").over(Window.partitionBy(*by).orderBy("month")))
