"""SimHash near-duplicates with pivot distance tables.

1. Each text's fingerprint: the majority bits of the XXH64 values of its word shingles (Arrow batches, one text at a time).
2. Equal fingerprints become one vertex, so copies never meet each other. Each vertex is written with its row of the pivot table: its Hamming
   distances to REFERENCES fixed fingerprints, PACKED of them in one bigint.
3. The table alone discards pairs but doesn't find them, so there is an index: a pair within `distance` differing bits of 64 agrees on some
   `blocks - distance` of `blocks` bit ranges. Each such choice is a key, and only vertices that share a key are compared. The number of blocks
   follows from the number of vertices, so that keys stay about as selective as the table is large; every choice finds all links.
4. Each bucket takes a few of its own fingerprints as local pivots and tabulates all members' distances to them. A member within
   `distance` of a pivot is linked to it at once, so a crowded bucket becomes a star of n links, not n*n pairs. What star contraction has
   connected by then needs no more comparing: buckets left with one component are done.
5. Buckets of over CROWD members that are still open are split by the same rule again, over the bits that their key leaves free.
6. In what is left, members of different components are paired, all but the largest component's against the rest; pairs whose largest
   difference of coordinates, in the written table or to the bucket's pivots, exceeds `distance` are discarded by the triangle inequality
   (seven coordinates by one addition), and the survivors are verified on the fingerprints themselves.
7. Components of all links; a component's id is its smallest doc_id.

Nothing is capped or sampled: pivots and splits only save work, and every pair within reach is linked, connected already, or tested.

Defined results: null and empty texts, and texts of white space only, have fingerprint 0 and link like any other; fewer words than a
shingle has make one shingle; repeated rows and ties share fingerprint and component; rows with null ids link like any other, a component's id
is null if none of its rows has one; rows that share an id but not the text are judged by their texts. An empty table gives an empty result. Only id
and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import ids_and_text, materialize, numbered, scratch
from .tokenizing import release

SHINGLE, DISTANCE, SEED = 3, 3, 42
REFERENCES, PACKED, LOCAL_PIVOTS = 28, 7, 6
TABLE = [f"t{j}" for j in range(REFERENCES // PACKED)]
#: Members beyond which an open bucket is split once more.
CROWD = 32
_HASH_BATCH = 1 << 16


def shingle_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) > width:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    else:
        shingles = iter([b" ".join(words)] if words else [])
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if over half the hashes have it; as a signed integer."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASH_BATCH):
        part = hashes[at : at + _HASH_BATCH].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str, width: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, fp): rid numbers the rows, fp is a signed bigint."""
    return _fingerprints(ids_and_text(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()), width)


def _fingerprints(text: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(x.as_py(), width) for x in b.column(2)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fp, pa.int64())], names=["doc_id", "rid", "fp"])
        release()

    return text.select("doc_id", "rid", "text").mapInArrow(run, f"doc_id {text.schema['doc_id'].dataType.simpleString()}, rid bigint, fp bigint")


# the pivot table


def _references() -> list[int]:
    """Fixed reference fingerprints, from multiples of the 64-bit golden ratio."""
    return [(((i + 1) * 0x9E3779B97F4A7C15) ^ ((i + 1) * 0xC2B2AE3D27D4EB4F >> 7)) % 2**64 - 2**63 for i in range(REFERENCES)]


def apart(a: Column, b: Column) -> Column:
    """Hamming distance of two bigint columns."""
    return F.bit_count(a.bitwiseXOR(b))


def coordinates(fp: Column) -> list[Column]:
    """A row of the pivot table: the distances to the references, a byte each."""
    refs, out = _references(), []
    for name, at in zip(TABLE, range(0, REFERENCES, PACKED)):
        total = F.lit(0).cast("bigint")
        for i, r in enumerate(refs[at : at + PACKED]):
            total = total.bitwiseOR(F.shiftleft(apart(fp, F.lit(r)).cast("bigint"), 8 * i))
        out.append(total.alias(name))
    return out


def may_be_within(x: dict[str, Column], y: dict[str, Column], distance: int) -> Column:
    """Whether no coordinate of the two rows differs by over distance (below 64). Each byte of a + (128 + distance) - b keeps its top bit if and only
    if a >= b - distance, and none of them borrows."""
    ones = sum(1 << 8 * i for i in range(PACKED))
    top, shift = F.lit(128 * ones), F.lit((128 + distance) * ones)
    test = F.lit(True)
    for t in TABLE:
        for a, b in ((x[t], y[t]), (y[t], x[t])):
            test = test & ((a + shift - b).bitwiseAND(top) == top)
    return test


# the index


def blocks_for(n: int, distance: int) -> int:
    """So many bit ranges that a key has at least log2(n) + 3 bits, or 12 at most."""
    blocks = distance + 1
    while blocks < 12 and 64 * (blocks - distance) // blocks < max(1, n).bit_length() + 3:
        blocks += 1
    return blocks


def agreeing(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks over these bits, of which two values that differ in `distance` of them at most agree in one at least."""
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[edges[i] : edges[i + 1]]) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, max(0, blocks - distance))]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _keys(fp: Column, masks: list[int]) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), fp.bitwiseAND(F.lit(_signed(m))).alias("bits")) for k, m in enumerate(masks))))


def _splits(vertices: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """(kind, crowded, part, mask): by what the members of a bucket are split, those of small ones by nothing. Some thousand rows at most, whatever the
    number of vertices."""
    rows = [(k, False, -1, 0) for k in range(len(masks))]
    for k, m in enumerate(masks):
        free = [b for b in range(64) if not m >> b & 1]
        rows += [(k, True, part, _signed(x)) for part, x in enumerate(agreeing(free, distance + 3, distance))]
    return vertices.sparkSession.createDataFrame(rows, "kind int, crowded boolean, part int, mask bigint")


def links(vertices: DataFrame, distance: int = DISTANCE, local_pivots: int = LOCAL_PIVOTS) -> tuple[DataFrame, DataFrame]:
    """vertices (fp distinct, rep; with their rows of the pivot table, or without) -> (star components (v, root), links (a, b) between the components that
    stars left apart)."""
    if TABLE[0] not in vertices.columns:
        vertices = materialize(vertices.select("fp", "rep", *coordinates(F.col("fp"))), "pivot-table")
    masks = agreeing(list(range(64)), blocks_for(vertices.count(), distance), distance)
    dealt = vertices.select("fp", "rep", *TABLE, _keys(F.col("fp"), masks).alias("key")).select("key.kind", "key.bits", "fp", "rep", *TABLE)
    key = ["kind", "bits"]
    # the bucket's own pivots: its smallest members in several orders, each a map-side minimum
    chosen = [F.min(F.struct(F.xxhash64("fp", F.lit(j)).alias("h"), "fp", "rep")).alias(f"p{j}") for j in range(local_pivots)]
    tables = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *chosen).where("n > 1")
    members = dealt.join(tables.select(*key, *(F.struct(f"p{j}.fp", f"p{j}.rep").alias(f"p{j}") for j in range(local_pivots))), key)
    local = [f"d{j}" for j in range(local_pivots)]
    members = materialize(members.select(*key, "fp", "rep", *TABLE, *(apart(F.col("fp"), F.col(f"p{j}.fp")).cast("tinyint").alias(f"d{j}") for j in range(local_pivots)), *(F.col(f"p{j}.rep").alias(f"r{j}") for j in range(local_pivots))), "local-pivots")
    near = F.explode(F.array(*(F.when(F.col(f"d{j}") <= distance, F.col(f"r{j}")) for j in range(local_pivots))))
    stars = components(members.select(F.col("rep").alias("a"), near.alias("b")).where("a <> b"))
    # what is still apart
    named = members.drop(*(f"r{j}" for j in range(local_pivots))).join(stars.select(F.col("v").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    named = materialize(named, "local-pivots")
    sizes = named.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy(*key).agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("size")).where("parts > 1")
    rest = named.join(largest.select(*key, F.col("top.root").alias("top"), (F.col("size") > CROWD).alias("crowded")), key)
    rest = rest.join(F.broadcast(_splits(vertices, masks, distance)), ["kind", "crowded"]).withColumn("sub", F.col("fp").bitwiseAND(F.col("mask"))).drop("mask", "crowded")
    rest = materialize(rest, "open")
    x, y = rest.where("root <> top").alias("x"), rest.alias("y")
    cx, cy = {c: F.col(f"x.{c}") for c in rest.columns}, {c: F.col(f"y.{c}") for c in rest.columns}
    test = (cx["kind"] == cy["kind"]) & (cx["bits"] == cy["bits"]) & (cx["part"] == cy["part"]) & (cx["sub"] == cy["sub"])
    test = test & (cx["root"] != cy["root"]) & ((cy["root"] == cy["top"]) | (cx["rep"] < cy["rep"])) & may_be_within(cx, cy, distance)
    for d in local:
        test = test & (F.abs(cx[d] - cy[d]) <= distance)
    found = x.join(y, test & (apart(cx["fp"], cy["fp"]) <= distance)).select(cx["root"].alias("a"), cy["root"].alias("b")).distinct()
    return stars, found


def grouped(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fps (doc_id, rid, fp), a written table -> (fp, component_id, first): of each fingerprint its component's smallest doc_id, and the number of the
    row of that id (the first of several; of a component without ids any)."""
    # a row with an id goes before those without
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    with scratch(fps.sparkSession):
        vertices = fps.groupBy("fp").agg(F.min("rid").alias("rep"), row.alias("row"))
        vertices = materialize(vertices.select("fp", "rep", "row", *coordinates(F.col("fp"))), "pivot-table")
        stars, between = links(vertices.select("fp", "rep", *TABLE), distance)
        joined = components(between)
        labels = vertices.select("fp", "rep", "row").join(stars.select(F.col("v").alias("rep"), F.col("root").alias("r1")), "rep", "left")
        labels = labels.withColumn("r1", F.coalesce("r1", "rep")).join(joined.select(F.col("v").alias("r1"), F.col("root").alias("r2")), "r1", "left")
        labels = materialize(labels.select("fp", "row", F.coalesce("r2", "r1").alias("root")), "labels")
        first = materialize(labels.groupBy("root").agg(F.min("row").alias("first")), "components")
        found = labels.select("fp", "root").join(first, "root").select("fp", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("first"))
        return materialize(found, "groups", keep=True)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of docs."""
    fps = materialize(fingerprints(docs, width, id_col, text_col), "fingerprints")
    return fps.join(grouped(fps, distance), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that with the smallest id, with its columns as they are; of repeated rows one. A row without an id stays only if no row of
    its group has one."""
    rows, rid = numbered(docs)
    text = rows.select(F.col(id_col).alias("doc_id"), F.col(rid).alias("rid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fps = materialize(_fingerprints(text, width), "fingerprints")
    stay = grouped(fps, distance).select(F.col("first").alias(rid)).distinct()
    return rows.join(stay, rid, "left_semi").drop(rid)
