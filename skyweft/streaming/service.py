"""Running cycles: one at a time over all processes, with their metrics, and what a health check asks."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..commits import create_once, read_text


class CycleLock:
    """A lock over processes; who doesn't get it skips its cycle. A folder holds its generations: who creates the next one, which only one can, holds the lock
    until it is released or its lease has run out; then anyone may create the next. Nobody takes away another's file."""

    def __init__(self, spark: SparkSession, path: str, lease_seconds: float = 1800):
        self.spark, self.path, self.lease_seconds = spark, path.rstrip("/"), lease_seconds
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.owner, self.generation = uuid.uuid4().hex, 0

    def _files(self) -> dict[str, float]:
        folder = self._hadoop(self.path)
        if not self._fs.exists(folder):
            return {}
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in self._fs.listStatus(folder)}

    def _last(self, files: dict[str, float]) -> int:
        return max((int(n) for n in files if n.isdigit()), default=0)

    def __enter__(self) -> bool:
        files = self._files()
        last = self._last(files)
        alive = max((t for n, t in files.items() if n in (str(last), f"{last}.alive")), default=0.0)
        if last and f"{last}.released" not in files and time.time() - alive <= self.lease_seconds:
            return False
        if not create_once(self.spark, f"{self.path}/{last + 1}", self.owner):
            return False
        if self._last(self._files()) > last + 1:  # this generation is long over and its file was cleared away
            return False
        self.generation = last + 1
        for name in files:
            if name.split(".")[0].isdigit() and int(name.split(".")[0]) < last:
                self._fs.delete(self._hadoop(f"{self.path}/{name}"), False)
        return True

    @property
    def held(self) -> bool:
        """Whether this lock has been taken and nobody has taken it over since."""
        return self.generation > 0 and self._last(self._files()) == self.generation and read_text(self.spark, f"{self.path}/{self.generation}") == self.owner

    def renew(self) -> bool:
        """Starts the lease anew; False if it has been taken over."""
        if not self.held:
            return False
        self._fs.create(self._hadoop(f"{self.path}/{self.generation}.alive"), True).close()
        return True

    def __exit__(self, *_) -> None:
        if self.generation:
            create_once(self.spark, f"{self.path}/{self.generation}.released", self.owner)
            self.generation = 0


class Timings:
    """Seconds by stage of a cycle, for its metrics row."""

    def __init__(self):
        self.seconds: dict[str, float] = {}

    def stage(self, name: str):
        return _Stage(self, name)


@dataclass
class _Stage:
    timings: Timings
    name: str
    began: float = field(default=0.0)

    def __enter__(self) -> None:
        self.began = time.time()

    def __exit__(self, *_) -> None:
        self.timings.seconds[self.name] = self.timings.seconds.get(self.name, 0.0) + time.time() - self.began


class ProgressLog(StreamingQueryListener):
    """Keeps each micro-batch's rows and milliseconds; add it with spark.streams.addListener()."""

    def __init__(self):
        self.batches: list[tuple[int, int, dict]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.batchId, p.numInputRows, dict(p.durationMs)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def readiness(started: bool, stopping: bool, grid_there: bool, writable: bool, boundary_there: bool) -> tuple[int, str]:
    """(HTTP status, word): ready only if started, not stopping, with a grid and a place to write; without a boundary degraded, which still serves."""
    if not (started and not stopping and grid_there and writable):
        return 503, "not ready"
    return 200, "ready" if boundary_there else "degraded"
