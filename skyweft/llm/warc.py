"""WARC records and a Merkle fixity audit of replicas.

`records()` serialises pages as WARC/1.0 records; a file is what one task writes, with the records' places in it. `index()` hashes each record with
SHA-256 and notes its id (WARC-Record-ID) and its range of offsets: the leaves. `tree()` hashes neighbouring records, in order, into nodes, and
neighbouring nodes into those above, up to one root a file; a node stands for an ordered range of offsets. Where a node ends is decided by the ids alone
(one in `fanout` ends a node of the first level, one in `fanout` of those a node of the second, and so on), and a node is named by the id at its
end. So a lost, inserted or longer record changes the nodes that hold it and no other's name or hash, although it moves all that follows.

`audit()` compares the replicas' roots and descends, level by level, into nodes whose hashes differ or that one replica lacks; the leaves it ends at
are the damaged, missing or surplus records. A level is written in parts by the node above, and a descent reads only the parts that
hold open nodes.

Defined results: null url and html are empty, line ends in an url are percent-encoded; empty pages are records with an empty block; repeated rows are
records of their own, told apart by their order among those of equal id; a record without an id goes by its hash (so if damaged it is missing here
and surplus there). Empty replicas have no nodes and agree. Only the named columns are read, so other columns can't clash. What can't be parsed in a file
is a row with an error, up to where the next record starts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import fresh_path, materialize

FANOUT = 16
KEY = ["file", "place"]
#: Leaves a part, and parts at least and at most.
PART_ROWS, PARTS = 500_000, (16, 4096)
DATE = "1970-01-01T00:00:00Z"
_LOW = (1 << 33) - 1
_HEAD = 4096


def record(page_id, url, page, date: str = DATE):
    """A page as one WARC record, as a binary column. Its id is made of what it holds. date: when the page was captured."""
    url, page = F.coalesce(url, F.lit("")), F.coalesce(page, F.lit(""))
    url = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    digest = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("")), url, page))
    uuid = F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(page).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.encode(F.concat(head, page, F.lit("\r\n\r\n")), "UTF-8")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """(page_id, file, place, record), written to the shared folder: the files' records in order."""
    made = pages.select(F.col(id_col).alias("page_id"), F.monotonically_increasing_id().alias("rid"), record(F.col(id_col), F.col(url_col), F.col(html_col), date).alias("record"))
    placed = made.select("page_id", F.shiftright("rid", 33).alias("file"), F.col("rid").bitwiseAND(F.lit(_LOW)).alias("place"), "record")
    return materialize(placed, "records")


def index(replica: DataFrame, renumber: bool = False) -> DataFrame:
    """replica (file, place, record; any others) -> (file, place, key, offset, length, hash) of each record: the leaves. renumber: places are
    counted from the file's own records instead of taken as given, for replicas that know only an order."""
    name = F.regexp_extract(F.substring(F.col("record"), 1, _HEAD).cast("string"), r"(?i)\nWARC-Record-ID:\s*<?([^>\r\n]+)", 1)
    digest = F.sha2("record", 256)
    leaves = replica.select(*KEY, F.when(name != "", name).otherwise(digest).alias("id"), F.length("record").cast("bigint").alias("length"), digest.alias("hash"))
    file = Window.partitionBy("file").orderBy("place")
    before = F.coalesce(F.sum("length").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("file", "id").orderBy("place"))
    found = leaves.withColumn("offset", before).withColumn("key", F.concat_ws("#", "id", nth.cast("string")))
    if renumber:
        found = found.withColumn("place", (F.row_number().over(file) - 1).cast("bigint"))
    return materialize(found.select(*KEY, "key", "offset", "length", "hash"), "leaves")


# trees


def _parts(leaves: int) -> int:
    return max(PARTS[0], min(PARTS[1], leaves // PART_ROWS))


class Level(NamedTuple):
    """One level of a tree: rows with `part`, written by it, so that readers can leave parts out."""

    rows: DataFrame
    parts: int


def _part(parts: int):
    return F.pmod(F.xxhash64("file", "up"), F.lit(parts)).cast("int").alias("part")


def _write(level: DataFrame, parts: int) -> Level:
    spark, path = level.sparkSession, fresh_path(level.sparkSession, "level")
    named = level.select("*", _part(parts))
    named.repartition(parts, "part").write.partitionBy("part").option("compression", "zstd").parquet(path)
    return Level(spark.read.schema(named.schema).parquet(path), parts)


def _above(level: DataFrame, fanout: int, height: int, top: bool) -> DataFrame:
    """level with `up`, the key of the node above: the next key at or behind it that ends one, or the file's end."""
    if top:
        return level.withColumn("up", F.lit("root"))
    ends = F.when(F.pmod(F.xxhash64("key"), F.lit(fanout**height)) == 0, F.col("key"))
    behind = Window.partitionBy("file").orderBy(F.col("offset").desc(), F.col("key").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return level.withColumn("up", F.coalesce(F.last(ends, True).over(behind), F.lit("end")))


def _nodes(level: DataFrame) -> DataFrame:
    """The nodes above: each hashes the keys and hashes of its children, in order."""
    children = F.transform(F.array_sort(F.collect_list(F.struct("offset", "key", "hash"))), lambda c: F.concat_ws(":", c["key"], c["hash"]))
    up = level.groupBy("file", "up").agg(F.sha2(F.concat_ws(" ", children), 256).alias("hash"), F.min("offset").alias("offset"), F.max("end").alias("end"))
    return up.select("file", F.col("up").alias("key"), "hash", "offset", "end")


def tree(leaves: DataFrame, fanout: int = FANOUT, height: int | None = None) -> list[Level]:
    """The levels (file, key, up, hash, offset, end), leaves (which have a place too) first; the last has one root a file. height: levels of nodes,
    by default as many as the largest file asks for. fanout children are what a node has on average."""
    per_file = leaves.groupBy("file").count().agg(F.max("count"), F.sum("count")).first()
    most, parts = per_file[0] or 0, _parts(per_file[1] or 0)
    if height is None:
        height = 1
        while fanout**height < most:
            height += 1
    level, levels = leaves.select(*KEY, "key", "hash", "offset", (F.col("offset") + F.col("length")).alias("end")), []
    for h in range(1, height + 1):
        levels.append(_write(_above(level, fanout, h, h == height), parts if h == 1 else PARTS[0]))
        level = _nodes(levels[-1].rows)
    levels.append(_write(level.withColumn("up", F.lit("none")), PARTS[0]))
    return levels


def audit(first: list[Level], second: list[Level], fanout: int = FANOUT) -> DataFrame:
    """(file, place, offset, end, status) of the records in which the trees differ, in the first's places and offsets if it has them. status: damaged,
    missing (from the second) or surplus. Trees of different heights are brought to one."""
    if len(first) != len(second):
        height = max(len(first), len(second)) - 1
        first, second = (t if len(t) > height else tree(_leaves(t), fanout, height) for t in (first, second))
    open_ = None
    for levels in zip(reversed(first), reversed(second)):
        a, b = (t.rows if open_ is None else _of(t, open_) for t in levels)
        leaf = "place" in a.columns
        x, y = a.alias("x"), b.alias("y")
        differ = x.join(y, (F.col("x.file") == F.col("y.file")) & (F.col("x.key") == F.col("y.key")), "full").where(~F.col("x.hash").eqNullSafe(F.col("y.hash")))
        status = F.when(F.col("y.hash").isNull(), "missing").when(F.col("x.hash").isNull(), "surplus").otherwise("damaged")
        found = materialize(differ.select(*(F.coalesce(f"x.{c}", f"y.{c}").alias(c) for c in ("file", "key", *["place"] * leaf, "offset", "end")), status.alias("status")), "differences")
        open_ = found.select("file", F.col("key").alias("up"))
    return found.drop("key")


def _leaves(levels: list[Level]) -> DataFrame:
    return levels[0].rows.select(*KEY, "key", "offset", (F.col("end") - F.col("offset")).alias("length"), "hash")


def _of(level: Level, open_: DataFrame) -> DataFrame:
    """The children of open nodes, from the parts that hold any."""
    hit = [r.part for r in open_.select(_part(level.parts)).distinct().collect()]  # as many numbers as there are parts, at most
    return level.rows.where(F.col("part").isin(hit) if hit else F.lit(False)).join(open_, ["file", "up"], "left_semi")


# files


def parse(data: bytes, piece: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record in a WARC file's bytes, gzip members included and unpacked piece by piece; offsets are in the plain
    bytes. What isn't a record has the one header "error" and is its own block, up to the next record."""
    window = _Window(_plain(data, piece))
    while window.has(1):
        error, headers, size = "", {}, ""
        head = window.find(b"\r\n\r\n", 0, _LONGEST_HEAD)
        if not window.starts(b"WARC/"):
            error = "no record starts here"
        elif head < 0:
            error = "the header does not end"
        else:
            lines = window.cut(0, head).decode("utf-8", "replace").split("\r\n")
            headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}
            size = headers.get("content-length", "")
            if not (size.isascii() and size.isdigit() and len(size) < 19):
                error = "no content length"
            elif not window.has(head + 4 + int(size)):
                error = "the block is cut"
        if error:
            stop = window.find(_NEXT, 1, None)
            length = stop + 4 if stop >= 0 else window.size()
            yield window.base, length, {"error": error}, window.cut(0, length)
        else:
            start, stop = head + 4, head + 4 + int(size)
            length = stop + 4 if window.has(stop + 4) and window.cut(stop, stop + 4) == b"\r\n\r\n" else stop
            yield window.base, length, headers, window.cut(start, stop)
        window.skip(length)


_NEXT, _LONGEST_HEAD = b"\r\n\r\nWARC/", 1 << 20


class _Window:
    """The bytes of an iterator from base on, as far as they have been asked for."""

    def __init__(self, source: Iterator[bytes]):
        self.source, self.buffer, self.at, self.base = source, bytearray(), 0, 0

    def size(self) -> int:
        return len(self.buffer) - self.at

    def has(self, n: int) -> bool:
        while self.size() < n and (more := next(self.source, None)) is not None:
            self.buffer += more
        return self.size() >= n

    def starts(self, what: bytes) -> bool:
        return self.has(len(what)) and self.cut(0, len(what)) == what

    def cut(self, a: int, b: int) -> bytes:
        return bytes(self.buffer[self.at + a : self.at + b])

    def find(self, what: bytes, start: int, stop: int | None) -> int:
        """Where `what` is first found from start on, looked for up to stop; -1 if nowhere."""
        while True:
            found = self.buffer.find(what, self.at + start)
            if found >= 0:
                return found - self.at
            start = max(start, self.size() - len(what) + 1)
            if stop is not None and self.size() >= stop or not self.has(self.size() + 1):
                return -1

    def skip(self, n: int) -> None:
        self.at, self.base = self.at + n, self.base + n
        if 2 * self.at > len(self.buffer):
            del self.buffer[: self.at]
            self.at = 0


def _plain(data: bytes, piece: int) -> Iterator[bytes]:
    if data[:2] != b"\x1f\x8b":
        yield from (data[i : i + piece] for i in range(0, len(data), piece))
        return
    at, member = 0, zlib.decompressobj(31)
    while at < len(data):
        part = data[at : at + piece]
        try:
            out = member.decompress(part)
        except zlib.error:
            return  # what comes behind can't be unpacked
        at += len(part) - len(member.unused_data)
        if out:
            yield out
        if member.eof:
            if data[at : at + 2] != b"\x1f\x8b":
                return
            member = zlib.decompressobj(31)


def read_files(spark: SparkSession, path: str, batch_bytes: int = 4 << 20) -> DataFrame:
    """(path, offset, length, id, url, block, error) of the records of WARC files. Each file is read by one task, which unpacks and hands on some
    batch_bytes at a time; a file may have 2 GB as it lies there. index() takes these rows as file, place (the offset) and record."""
    names = ["path", "offset", "length", "id", "url", "block", "error"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                for offset, length, headers, block in parse(data.as_py()):
                    rows.append((name, offset, length, headers.get("warc-record-id"), headers.get("warc-target-uri"), block, headers.get("error")))
                    held += length
                    if held >= batch_bytes:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, offset bigint, length bigint, id string, url string, block binary, error string")
