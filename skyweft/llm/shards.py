"""Sharding by size-tiered compaction, with an atomically committed, versioned manifest.

`append()` writes an arrival as one run: a folder of small immutable Parquet shards. `compact()` sorts the runs whose shards are still small into tiers by
their size (each `fanout` times the one before); a tier with at least `fanout` runs is merged by one job into shards of about the target size, without a
shuffle: a task reads whole neighbouring shards and writes one.

The manifest is a log of versions. A version is a small JSON file that says which runs it adds and removes; it appears by one rename that refuses to
replace (as HDFS does it), so of two writers one commits and the other tries again on top. Every `CHECKPOINT_EVERY` versions the whole list is written once
more as a checkpoint, from which readers start. A writer that has been overtaken by a vacuum may find its version's name free again: such a file lies
at or below a checkpoint that doesn't know its id, no reader looks at it, and the writer, which checks for that after its rename, commits anew. So no
commit is lost, none is repeated, and none is reported that readers don't see. Readers open only what a version lists, so half-written runs of a lost job are never seen.

Merging deletes nothing: old versions stay readable, and a reader may go on with one, until `vacuum()`, which keeps the last `keep` versions
and all that are younger than `age_seconds`, and removes files of lost jobs only when they are that old.

Only the log (a line a run) is handled on the driver; rows are moved by DataFrame reads and writes alone.

Defined results: rows come back as they were, nulls, empty and very long texts and repeated rows included; columns are stored as they are, so
none can clash; an empty arrival commits a version with a run that has no rows; a store without a version reads as the empty table of its schema.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BASE_BYTES, TARGET_BYTES, FANOUT = 1 << 20, 64 << 20, 4
#: Versions between checkpoints, and commits whose ids a checkpoint remembers.
CHECKPOINT_EVERY, KNOWN_IDS = 32, 1000
#: Seconds for which vacuum() leaves versions, and files that no version lists, alone.
RETENTION = 7 * 86_400.0


@dataclass(frozen=True)
class Run:
    """A folder of shards that one job has written."""

    folder: str
    files: int
    bytes: int


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int


class Conflict(Exception):
    """Another writer has committed this version, or has merged these runs."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT, base_bytes: int = BASE_BYTES):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.target_bytes, self.fanout, self.base_bytes = target_bytes, fanout, base_bytes
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # the log

    def _numbers(self, folder: str) -> dict[int, float]:
        """The versions that a folder of the log has, with the times of their files."""
        path = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(path):
            return {}
        found = ((re.fullmatch(r"v(\d+)\.json", f.getPath().getName()), f) for f in self._fs.listStatus(path))
        return {int(m[1]): f.getModificationTime() / 1000 for m, f in found if m}

    def _checkpoint(self, version: int | None = None) -> int:
        """The last checkpoint (at or below version), 0 if there is none."""
        return max((v for v in self._numbers("checkpoints") if version is None or v <= version), default=0)

    def versions(self) -> list[int]:
        """The versions that can be read, ascending."""
        oldest, log = min(self._numbers("checkpoints"), default=0), self._numbers("log")
        whole = all(v in log for v in range(1, oldest + 1))  # nothing has been vacuumed yet
        return sorted({v for v in log if whole or v > oldest} | ({oldest} if oldest else set()))

    def last(self) -> int:
        """The last version, 0 if there is none."""
        return max([self._checkpoint(), *self._numbers("log")])

    def _name(self, folder: str, version: int) -> str:
        return f"{self.root}/{folder}/v{version:010d}.json"

    def _read(self, folder: str, version: int) -> dict:
        stream = self._fs.open(self._path(self._name(folder, version)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, folder: str, version: int, content: dict) -> None:
        """The file appears whole and at once, or Conflict if there is one."""
        draft = self._path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        self._fs.mkdirs(self._path(f"{self.root}/{folder}"))
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self._path(self._name(folder, version)), none)
        except Exception as e:
            self._fs.delete(draft, False)
            if "AlreadyExists" in str(e):
                raise Conflict(version) from e
            raise

    def _state(self, version: int) -> tuple[dict[str, Run], dict[str, str]]:
        """(the runs that a version lists, the ids of the last commits up to it by their version)"""
        base = self._checkpoint(version)
        known = self._read("checkpoints", base) if base else {"runs": [], "ids": {}}
        runs, ids = {r["folder"]: Run(**r) for r in known["runs"]}, dict(known["ids"])
        for v in range(base + 1, version + 1):
            change = self._read("log", v)
            ids[str(v)] = change["id"]
            for folder in change["removed"]:
                del runs[folder]
            runs |= {r["folder"]: Run(**r) for r in change["added"]}
        return runs, {v: ids[v] for v in sorted(ids, key=int)[-KNOWN_IDS:]}

    def runs(self, version: int | None = None) -> list[Run]:
        """What a version lists, the last one if none is named."""
        return list(self._state(self.last() if version is None else version)[0].values())

    def commit(self, version: int, added: Iterable[Run], removed: Iterable[str] = ()) -> None:
        """Makes `version`, the one behind the last, visible at once; Conflict if another writer was faster, however much it has vacuumed since."""
        mine = uuid.uuid4().hex
        self._publish("log", version, {"id": mine, "added": [vars(r) for r in added], "removed": sorted(removed)})
        if (covered := self._checkpoint()) >= version and self._state(covered)[1].get(str(version)) != mine:
            self._fs.delete(self._path(self._name("log", version)), False)  # the name was free because the version has been vacuumed
            raise Conflict(version)
        if version % CHECKPOINT_EVERY == 0:
            self.checkpoint(version)

    def checkpoint(self, version: int) -> None:
        """Writes the whole list of a version, from which readers start."""
        runs, ids = self._state(version)
        try:
            self._publish("checkpoints", version, {"runs": [vars(r) for r in runs.values()], "ids": ids})
        except Conflict:
            pass  # the same list

    def _change(self, added: list[Run], removed: frozenset[str] = frozenset()) -> int:
        """Commits the last version with these changes; again on top of what others commit meanwhile."""
        while True:
            version = self.last()
            if removed and removed - {r.folder for r in self.runs(version)}:
                raise Conflict(version)  # another compaction took them
            try:
                self.commit(version + 1, added, removed)
                return version + 1
            except Conflict:
                continue

    # rows

    def _files(self, folder: str) -> list[Shard]:
        listed = self._fs.listStatus(self._path(folder))
        return sorted((Shard(f.getPath().toString(), f.getLen()) for f in listed if f.getPath().getName().startswith("part-")), key=lambda s: s.path)

    def shards(self, version: int | None = None) -> list[Shard]:
        """The shards of a version's runs."""
        return [s for r in self.runs(version) for s in self._files(r.folder)]

    def _write(self, rows: DataFrame) -> Run:
        folder = f"{self.root}/shards/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(folder)
        found = self._files(folder)
        return Run(folder, len(found), sum(s.bytes for s in found))

    def append(self, rows: DataFrame) -> int:
        """Adds an arrival as one run of immutable shards; returns the version."""
        return self._change([self._write(rows)])

    def tier(self, size: int) -> int:
        tier, least = 0, self.base_bytes
        while size >= least:
            tier, least = tier + 1, least * self.fanout
        return tier

    def due(self) -> list[list[Run]]:
        """The runs to merge: for each tier those whose shards have less than half the target size on average, if there are `fanout` of them."""
        tiers: dict[int, list[Run]] = {}
        for r in self.runs():
            if 2 * r.bytes < self.target_bytes * r.files:
                tiers.setdefault(self.tier(r.bytes), []).append(r)
        return [v for _, v in sorted(tiers.items()) if len(v) >= self.fanout]

    def merge(self, run: Iterable[Run | Shard]) -> int:
        """Rewrites runs (or the runs that shards are of) as one of target-sized shards; Conflict if the last version doesn't list all of them any more."""
        folders = {r.folder if isinstance(r, Run) else r.path.rpartition("/")[0] for r in run}
        listed = {r.folder: r for r in self.runs()}
        if folders - listed.keys():
            raise Conflict(self.last())
        files = max(1, round(sum(listed[f].bytes for f in folders) / self.target_bytes))
        made = self._write(self.spark.read.schema(self.schema).parquet(*sorted(folders)).coalesce(files))
        try:
            return self._change([made], frozenset(folders))
        except Conflict:
            self._fs.delete(self._path(made.folder), True)
            raise

    def compact(self) -> int:
        """Merges until no tier is due; each merge leaves one run of at least `fanout`, in a higher tier or with larger shards."""
        while due := self.due():
            try:
                self.merge(due[0])
            except Conflict:
                continue  # another compaction was faster
        return self.last()

    def read(self, version: int | None = None) -> DataFrame:
        folders = [r.folder for r in self.runs(version)]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def vacuum(self, keep: int = 1, age_seconds: float = 0.0, orphan_seconds: float = RETENTION) -> None:
        """Makes the oldest version to stay the first: that is the oldest of the last `keep` and of those that were last less than age_seconds ago. Deletes
        the log up to it and runs that only older versions list; runs and drafts that no version lists go once they are orphan_seconds old."""
        known = self.versions()
        if not known:
            return
        now, times = time.time(), self._numbers("log")
        first = known[max(0, len(known) - max(1, keep))]
        # a version was the last one until the next was committed
        young = [v for v, after in zip(known, known[1:]) if now - times.get(after, 0) < age_seconds]
        first = min([first, *young])
        old = {r.folder for v in known if v < first for r in self.runs(v)}
        kept = {r.folder for v in known if v >= first for r in self.runs(v)}
        self.checkpoint(first)
        for folder, gone in (("log", lambda v: v <= first), ("checkpoints", lambda v: v < first)):
            for v in self._numbers(folder):
                if gone(v):
                    self._fs.delete(self._path(self._name(folder, v)), False)
        for folder in old - kept:
            self._fs.delete(self._path(folder), True)
        names = {f.rpartition("/")[2] for f in kept}
        for part in ("shards", "drafts"):
            place = self._path(f"{self.root}/{part}")
            for f in self._fs.listStatus(place) if self._fs.exists(place) else ():
                if f.getPath().getName() not in names and now - f.getModificationTime() / 1000 >= orphan_seconds:
                    self._fs.delete(f.getPath(), True)


def compacted(rows: DataFrame, root: str, arrival: Column, arrivals: int | None = None, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT) -> ShardStore:
    """A store at root to which the rows come arrival by arrival, each an append() of its own with a compact() behind it. arrival: the number of a row's
    arrival, from 0 to arrivals - 1 (unknown: as the rows have it); rows without one come last. Each append reads its own rows by a filter."""
    store = ShardStore(rows.sparkSession, root, rows.schema, target_bytes, fanout)
    if arrivals is None:
        arrivals = int(rows.agg(F.max(arrival)).first()[0] or 0) + 1
    for k in range(arrivals):
        store.append(rows.where(arrival == k))
        store.compact()
    rest = rows.where(F.coalesce((arrival < 0) | (arrival >= arrivals), F.lit(True)))
    if not rest.isEmpty():
        store.append(rest)
        store.compact()
    return store
