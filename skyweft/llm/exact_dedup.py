"""Exact dedup by a heavy-hitter split.

The digests of all documents (SHA-256 of the whole text) are written once. Misra-Gries summaries of fixed size, one a partition and
merged pairwise by key, name every digest with more than 1/(counters+1) of all rows. One exact pass with map-side sums verifies the
candidates, and those that really are that frequent win: their counts and winners, at most `counters` rows of some 60 bytes, are broadcast, so
their rows are settled where they are read. All other digests go through an ordinary shuffle, where no group holds more than 1/(counters+1) of
the rows.

Defined results: null text counts as empty and equals an empty text; of equal texts the row with the largest doc_id stays (null ids
are smallest), of rows that also share the doc_id exactly one; a repeated row counts in group_size. An empty table gives an empty
result. Only doc_id and text are read, so other columns can't clash; `survivors()` returns docs' own columns, and picks its rows by a
bit a row where they are read, so that texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ids_and_text, marks, materialize, numbered, picked

COUNTERS = 256
MERGE_WAYS = 64
_SUMMARY = "digest binary, n bigint"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, rid): rid numbers the rows, so that repeated rows can be told apart. The ids come from the written table's own
    rows, so they stay the same when a task runs again."""
    return _digests(ids_and_text(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()))


def _digests(text: DataFrame) -> DataFrame:
    return materialize(text.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "rid"), "digests")


def summarize(items: Iterator[tuple[bytes, int]], counters: int = COUNTERS) -> dict[bytes, int]:
    """Weighted Misra-Gries in batches: counts are summed up to twice the counters, then the (counters+1)th largest is taken off all.
    That removes as much from counters+1 keys at once, so a key with over 1/(counters+1) of the weight always stays."""
    counts: dict[bytes, int] = {}
    for key, n in items:
        counts[key] = counts.get(key, 0) + n
        if len(counts) > 4 * counters:
            counts = _cut(counts, counters)
    return _cut(counts, counters)


def _cut(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    if len(counts) <= counters:
        return counts
    off = sorted(counts.values(), reverse=True)[counters]
    return {k: v - off for k, v in counts.items() if v > off}


def heavy_candidates(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, every one with over 1/(counters+1) of the rows among them."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _batch(summarize(((k, 1) for b in batches for k in b.column(0).to_pylist()), counters))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _batch(summarize((x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())), counters))

    parts = rows.select("digest").mapInArrow(local, _SUMMARY)
    return parts.repartition(MERGE_WAYS, F.spark_partition_id() % MERGE_WAYS).mapInArrow(merge, _SUMMARY).coalesce(1).mapInArrow(merge, _SUMMARY)


def _batch(counts: dict[bytes, int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "n"])


def decided(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """rows as digests() writes them -> with keep (doc_id, rid) and group_size."""
    totals = [F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size")]
    candidates = heavy_candidates(rows, counters).select("digest")
    frequent = rows.count() / (counters + 1)
    verified = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*totals)
    winners = materialize(verified.where(F.col("group_size") > frequent), "winners")  # fewer than counters + 1
    settled = rows.join(F.broadcast(winners), "digest", "left")
    heavy = settled.where(F.col("keep").isNotNull())
    light = settled.where(F.col("keep").isNull()).select("doc_id", "digest", "rid")
    return heavy.unionByName(light.join(light.groupBy("digest").agg(*totals), "digest"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of docs."""
    return decided(digests(docs, id_col, text_col), counters).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("rid") == F.col("keep.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that groups() marks as kept, one of each text, with their columns as they are."""
    rows, rid = numbered(docs)
    text = rows.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(rid).alias("rid"))
    kept = decided(_digests(text), counters).where(F.col("rid") == F.col("keep.rid"))
    return picked(rows, rid, marks(kept.select("rid"))).drop(rid)
