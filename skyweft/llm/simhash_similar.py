"""SimHash near-dedup at a given similarity: fingerprints and pivot tables discard, the texts' own shingles decide.

What few differing bits of 64 (simhash) find is nearly equal; two texts with four fifths of their 5-word shingles in common differ in some ten bits, and
where fingerprints may be that far apart no range of their bits is selective. So this part of the operator has another index, and its links are verified
on the texts:

1. Each text's set of word shingles as XXH64 values (Arrow batches, one text at a time): its size, a digest, the SimHash fingerprint of the set, and
   BANDS keys, each of ROWS minima of the hashes under random functions. Texts with equal sets become one vertex, so copies never meet each
   other. Each vertex is written with its row of the pivot table (simhash: Hamming distances to fixed fingerprints).
2. Vertices that share a key may be compared. A pair of similarity s shares none with chance (1 - s^ROWS)^BANDS: 5e-8 at 0.8, 2e-15 at 0.9.
3. Each bucket takes a few of its own members as local pivots. Members within DISTANCE bits of a pivot are verified against it on the texts; those alike
   form stars, so a group of n copies costs n links. What star contraction has connected needs no more comparing: buckets left with one
   component are done.
4. In the others, members of different components are paired, all but the largest component's against the rest, each pair at its first common key.
   Discarded are pairs whose sizes can't be alike, whose coordinates in the pivot table differ by over DISTANCE, whose fingerprints do, and those
   that share none of their rarest shingles: of n shingles a pair that must have m in common shares one of the n - m + 1 rarest of each, whatever
   the order of rarity. That order takes counts of hashes in a table of fixed size. Texts whose part to look at is longer than RAREST
   pass this last test.
5. The survivors are verified on the texts. Components of all links; of each the row with the smallest id stays.

Keys are counted first, so only members of shared buckets are dealt out with more than their number. Of the texts, only those of pairs to be verified
are shuffled, and those of open buckets and the rows that stay are picked where they are read (shared: marks and picked).

DISTANCE is far above what links have: at a similarity of 0.8 bits differ with chance 0.15 each, so that 25 or more of 64 do with chance 1e-6 (small
sets spread a little more). No bucket is capped or sampled. Rows are told apart by a number of their own, so repeated rows and rows without an id are
settled like any other; a row without an id stays only if no row of its component has one.

Defined results: null text counts as empty; texts without words have the empty set and are alike; fewer words than a shingle has make
one shingle; A-Z are lower-cased. An empty table gives an empty result. docs' own columns come back as they are; none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import marks, materialize, numbered, picked, scratch
from .simhash import TABLE, apart, coordinates, majority, may_be_within, shingle_hashes
from .tokenizing import release

#: Words of a shingle, and the least similarity of a link in percent.
WIDTH, PERCENT, DISTANCE = 5, 80, 24
BANDS, ROWS, LOCAL_PIVOTS = 32, 4, 3
#: Rarest shingles that are compared at most, and counters of the table of rarity in slices.
RAREST, SLICES, SLICE = 128, 64, 4096
_CHUNK = 1 << 12
_KEPT_SETS = 256


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    return np.unique(shingle_hashes(text, width))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(42)
    return random.integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1), random.integers(0, 2**64, BANDS * ROWS, np.uint64)


def band_keys(hashes: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """A signed key for each band."""
    times, plus = functions
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        np.minimum(least, (hashes[at : at + _CHUNK, None] * times + plus).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(b.tobytes(), k) - 2**63 for k, b in enumerate(least.reshape(BANDS, ROWS))]


def signatures(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """rows (rid, doc_id, text) -> (rid, doc_id, n, digest, fp, keys): the set's size, digest, fingerprint and bands' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions()
        for b in batches:
            made = []
            for x in b.column(2):
                found = shingle_set(x.as_py(), width)
                made.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), majority(found), band_keys(found, functions)))
            columns = list(zip(*made)) or [()] * 4
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            yield pa.record_batch([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["rid", "doc_id", "n", "digest", "fp", "keys"])
        release()

    return rows.mapInArrow(run, f"rid bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, digest binary, fp bigint, keys array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """pairs (a, b), texts (v, text) -> (a, b, common, total): the shingles that both or any of the two have. Only the pairs' own texts are shuffled."""
    pairs = materialize(pairs, "pairs")
    texts = picked(texts, "v", marks(pairs.select(F.explode(F.array("a", "b")))))
    both = pairs.join(texts.select(F.col("v").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("v").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def of(v: int, text: pa.Scalar) -> np.ndarray:
            if v not in sets:
                if len(sets) >= _KEPT_SETS:
                    del sets[next(iter(sets))]
                sets[v] = shingle_set(text.as_py(), width)
            return sets[v]

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                common, total = [], []
                for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                    x, y = of(a, ta), of(b, tb)
                    common.append(len(np.intersect1d(x, y, assume_unique=True)))
                    total.append(len(x) + len(y) - common[-1])
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "common", "total"])
        release()

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint, common bigint, total bigint")


# rarity


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(SLICES * SLICE)).astype(np.int64)


def rarity(texts: DataFrame, width: int = WIDTH) -> np.ndarray:
    """How many shingles of the texts fall on each counter of a table of fixed size (2 MB), summed slice by slice over the cluster."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLICES * SLICE, np.int64)
        for b in batches:
            for x in b.column(0):
                counts += np.bincount(_places(shingle_set(x.as_py(), width)), minlength=len(counts))
        yield _slices(dict(enumerate(counts.reshape(SLICES, SLICE))))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1)):
                sums[i] = sums.get(i, 0) + np.frombuffer(x.as_py(), np.int64)
        yield _slices(sums)

    parts = texts.select("text").mapInArrow(local, "slice int, counts binary")
    found = parts.repartition(SLICES, "slice").mapInArrow(total, "slice int, counts binary").collect()  # SLICES rows
    out = np.zeros((SLICES, SLICE), np.int64)
    for r in found:
        out[r.slice] = np.frombuffer(r.counts, np.int64)
    return out.reshape(-1)


def _slices(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(counts), pa.int32()), pa.array([c.tobytes() for c in counts.values()], pa.binary())], names=["slice", "counts"])


def needed(sizes: Column | int, percent: int) -> Column | int:
    """Of two sets with so many elements together, how many both must have for their similarity to reach the percentage."""
    up = percent * sizes + 99 + percent
    return F.floor(up / (100 + percent)).cast("int") if isinstance(sizes, Column) else up // (100 + percent)


def rarest(texts: DataFrame, counts: np.ndarray, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """texts (v, text) -> (v, rare): the shingles of which a text alike must have one, rarest first; NULL where they are over RAREST."""
    table = counts.astype(np.uint32 if counts.max(initial=0) < 2**32 else np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b, out = whole.slice(at, 1024), []
                for x in b.column(1):
                    found = shingle_set(x.as_py(), width)
                    least = (len(found) * percent + 99) // 100  # the smallest set that can be alike lies inside
                    part = len(found) - least + 1
                    out.append(found[np.lexsort((found, table[_places(found)]))[:part]].view(np.int64) if part <= RAREST else None)
                yield pa.record_batch([b.column(0), pa.array(out, pa.list_(pa.int64()))], names=["v", "rare"])
        release()

    return texts.select("v", "text").mapInArrow(run, "v bigint, rare array<bigint>")


# links


def _alike(common: Column, total: Column, percent: int) -> Column:
    return 100 * common >= percent * total


def _open(members: DataFrame) -> DataFrame:
    """members with their bucket's largest component as top, of the buckets with more than one."""
    sizes = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    tops = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return members.join(tops.select("key", F.col("most.root").alias("top")), "key")


def links(vertices: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT, distance: int = DISTANCE) -> DataFrame:
    """vertices (v, n, fp, keys, rows of the pivot table), texts (v, text) -> verified links (a, b) that connect all that is alike."""
    dealt = vertices.select("v", F.explode("keys").alias("key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")  # few keys are, so nothing else is dealt out by all
    dealt = materialize(dealt.join(shared, "key"), "shared").join(vertices.select("v", "n", "fp"), "v")
    chosen = [F.min(F.struct(F.xxhash64("v", F.lit(j)).alias("h"), "v", "n", "fp")).alias(f"p{j}") for j in range(LOCAL_PIVOTS)]
    members = materialize(dealt.join(dealt.groupBy("key").agg(*chosen), "key"), "buckets")
    pivots = members.select("v", "n", "fp", F.explode(F.array(*(F.struct(f"p{j}.v", f"p{j}.n", f"p{j}.fp") for j in range(LOCAL_PIVOTS)))).alias("p"))
    fits = _alike(F.least("n", "p.n"), F.greatest("n", "p.n"), percent) & (apart(F.col("fp"), F.col("p.fp")) <= distance) & (F.col("v") != F.col("p.v"))
    asked = pivots.where(fits).select(F.greatest("v", "p.v").alias("a"), F.least("v", "p.v").alias("b")).distinct()
    told = materialize(verified(asked, texts, width), "verified")
    near = told.where(_alike(F.col("common"), F.col("total"), percent)).select("a", "b")
    stars = components(near).withColumnRenamed("v", "m")
    # what is still apart
    named = members.select("key", "v").join(stars, F.col("v") == F.col("m"), "left").select("key", "v", F.coalesce("root", "v").alias("root"))
    rest = materialize(_open(materialize(named, "buckets")), "open")
    asked = marks(rest.select("v"))
    asking = materialize(picked(texts, "v", asked), "open-texts")
    rare = rarest(asking, rarity(asking, width), width, percent)
    facts = materialize(picked(vertices, "v", asked).select("v", "n", "fp", "keys", *TABLE).join(rare, "v"), "rarest")
    rest = rest.join(facts, "v")
    x, y = rest.where("root <> top").alias("x"), rest.alias("y")
    cx, cy = {c: F.col(f"x.{c}") for c in rest.columns}, {c: F.col(f"y.{c}") for c in rest.columns}
    test = (cx["key"] == cy["key"]) & (cx["root"] != cy["root"]) & ((cy["root"] == cy["top"]) | (cx["v"] < cy["v"]))
    test = test & _alike(F.least(cx["n"], cy["n"]), F.greatest(cx["n"], cy["n"]), percent) & may_be_within(cx, cy, distance) & (apart(cx["fp"], cy["fp"]) <= distance)
    common = needed(cx["n"] + cy["n"], percent)
    part = lambda c: F.slice(c["rare"], F.lit(1), F.greatest(c["n"].cast("int") - common + 1, F.lit(0)))
    test = test & F.coalesce(F.arrays_overlap(part(cx), part(cy)), F.lit(True)) & (F.get(F.array_intersect(cx["keys"], cy["keys"]), 0) == cx["key"])
    left = x.join(y, test).select(F.greatest(cx["v"], cy["v"]).alias("a"), F.least(cx["v"], cy["v"]).alias("b"))
    more = verified(left.join(told.select("a", "b"), ["a", "b"], "left_anti"), texts, width)
    return near.unionByName(more.where(_alike(F.col("common"), F.col("total"), percent)).select("a", "b"))


def survivors(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of a component other than the one with the smallest id; their columns as they are."""
    rows, rid = numbered(docs)
    texts = rows.select(F.col(rid).alias("rid"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with scratch(docs.sparkSession):
        signs = materialize(signatures(texts, width), "signatures")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
        sets = materialize(signs.groupBy("digest").agg(first), "sets")
        vertices = picked(signs, "rid", marks(sets.select("first.rid")))
        vertices = materialize(vertices.select(F.col("rid").alias("v"), "n", "fp", "keys", *coordinates(F.col("fp"))), "pivot-table")
        with scratch(docs.sparkSession):
            linked = materialize(links(vertices, texts.select(F.col("rid").alias("v"), "text"), width, percent), "links", keep=True)
        found = components(linked)
        roots = sets.select(F.col("first.rid").alias("m"), "first").join(found, F.col("m") == F.col("v"), "left").select("first", F.coalesce("root", "m").alias("root"))
        stay = roots.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.rid").alias(rid))
        stay = materialize(stay, "stay", keep=True)
    return picked(rows, rid, marks(stay)).drop(rid)
