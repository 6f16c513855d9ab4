"""Shared storage for intermediate tables, and the column plumbing that the operators have in common."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and \t to \r, nothing else.
SPACE = r"[\x20\x09-\x0D]"
#: Rows of a block of marks, in words of 64 bits, and the blocks that are broadcast at most (128 million rows, 22 MB).
_BLOCK_BITS, _WORDS, MOST_BLOCKS = 10, 16, 1 << 17


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; where that is unset (tests, one machine) a temporary one that ends with the process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    return _own_dir()


_own: list[tempfile.TemporaryDirectory] = []


def _own_dir() -> str:
    if not _own:
        _own.append(tempfile.TemporaryDirectory(prefix="skyweft-"))
        atexit.register(_own[0].cleanup)
    return f"file://{_own[0].name}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/skyweft/{name}-{uuid.uuid4().hex}"


_scratch = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written inside (but for what is to be kept) is deleted at the end, so nothing that is used later may still read it."""
    opened = _scratch.__dict__.setdefault("tables", [])
    opened.append([])
    try:
        yield
    finally:
        for path in opened.pop():
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, name: str, codec: str = "zstd", keep: bool = False) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage ends there, and a lost executor costs no earlier stage. keep: the table
    outlives the innermost scratch()."""
    return _materialized(df, name, codec, keep)[0]


def _materialized(df: DataFrame, name: str, codec: str = "zstd", keep: bool = False) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, name)
    opened = _scratch.__dict__.get("tables", [])
    if len(opened) > keep:
        opened[-1 - keep].append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """df written with a number for each row, under a column name that df doesn't have, and that name. The numbers are in the written table, so they stay
    the same when a task runs again."""
    name = "__rid"
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def marks(numbers: DataFrame) -> DataFrame:
    """One column of row numbers -> (block, words): a bit for each row of a block of 1024, as a written table. Only blocks with a number are there."""
    at = F.col(numbers.columns[0])
    word, bit = F.shiftright(at, 6).bitwiseAND(_WORDS - 1), F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))
    words = [F.coalesce(F.bit_or(F.when(word == k, bit)), F.lit(0).cast("bigint")) for k in range(_WORDS)]
    found = numbers.groupBy(F.shiftright(at, _BLOCK_BITS).alias("block")).agg(*(w.alias(f"w{k}") for k, w in enumerate(words)))
    return materialize(found.select("block", F.array(*(f"w{k}" for k in range(_WORDS))).alias("words")), "marks")


def picked(rows: DataFrame, number: str, marked: DataFrame, most: int = MOST_BLOCKS) -> DataFrame:
    """The rows whose number is marked, with their columns as they are. The marks are broadcast, some 0.2 bytes a row, so rows are not shuffled to find
    a few of them; beyond `most` blocks they are joined like any other table."""
    there = marked if marked.count() > most else F.broadcast(marked)
    at = rows[number]
    word = F.get(marked["words"], F.shiftright(at, 6).bitwiseAND(_WORDS - 1).cast("int"))
    bit = F.call_function("shiftright", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1)
    return rows.join(there, (F.shiftright(at, _BLOCK_BITS) == marked["block"]) & (bit == 1), "left_semi")


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null text as empty: whatever other columns docs has can't clash with an operator's own."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bound(value: Column, body) -> Column:
    """body(value) with value computed once a row: a lambda's variable isn't expanded again at each use, as a projected column may be."""
    return F.element_at(F.transform(F.array(value), body), 1)
