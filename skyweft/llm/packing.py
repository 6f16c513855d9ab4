"""Best-fit packing by minimum bin slack over the histogram of lengths.

1. Arrow batches of texts become pieces: token ids, an end id, cut only where a document exceeds a sequence. A piece's ids are little-endian
   uint32 in one binary value. The pieces are written once to the shared folder. Texts are encoded some megabytes at a time: in NumPy and Arrow for
   what each byte and each unit costs, in Python only for the different units.
2. Only the histogram of piece lengths (at most `capacity` rows, whatever the corpus) reaches the driver. A piece that fills a sequence is one.
   For the others minimum bin slack plans on the histogram: a bin takes the longest length left, and a bitset subset-sum dynamic program over the lengths
   still available finds the fullest combination for the rest; that combination is removed, as often at once as the histogram holds it.
3. The plan is a table of rank ranges: "pieces of this length with these ranks go to those sequences at that offset". It has at most a few
   rows a bin pattern. Ranks come from a window over (length, salt), with salts in proportion to a length's number, so that a length that a third
   of all pieces share is ranked by as many tasks as its share asks for. Where each salt's ranks start is a table of at most capacity + STARTS rows.
   Both tables are broadcast, the plan only up to PLAN_ROWS.

Defined results: null text is empty and gives one piece with the end id alone; repeated rows and repeated ids give pieces of their own;
an empty table gives an empty result. Only id and text are read, so other columns can't clash; `pack()` carries what pieces() made.
"""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ids_and_text, materialize
from .tokenizing import load_tokenizer, release

CAPACITY, END_ID = 4096, 1
#: Pieces a salt at least, salts of all lengths together at most, and rows of a plan that is broadcast.
SALT_ROWS, STARTS, PLAN_ROWS = 65_536, 65_536, 500_000
#: Units whose ids a worker keeps (in each of two generations), bytes of texts that are encoded at once (beside one text), and pieces an Arrow batch returns at most.
CACHED_UNITS, TEXT_BYTES, BATCH = 400_000, 1 << 22, 2048

#: Lower case in Latin-1, and what the tokenizer's split pattern takes its characters for, as Unicode has them.
LOWER = bytes(range(256)).decode("latin-1").lower().encode("latin-1")
BLANK, LETTER, DIGIT, OTHER = range(4)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[np.frombuffer("\t\n\x0b\x0c\r \x85\xa0".encode("latin-1"), np.uint8)] = BLANK
KINDS[np.frombuffer("0123456789²³¹¼½¾".encode("latin-1"), np.uint8)] = DIGIT
KINDS[[*range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = LETTER
TAIL = b"\n\n\n"


def unit_starts(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of lower-case Latin-1 text with TAIL behind it: is it the first of a unit, is it in one. Units are the matches of the split pattern
    's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+, so only an apostrophe that begins a run can begin one of the first seven."""
    kinds = KINDS[text]
    inside = kinds != BLANK
    first = inside.copy()
    first[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    quotes = np.flatnonzero(first & (text == ord("'")))
    one, two = text[quotes + 1], text[quotes + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    first[quotes[short | long] + 1] = False
    behind = np.concatenate([quotes[short] + 2, quotes[long] + 3])
    first[behind] |= kinds[behind] == LETTER
    return first, inside


class WordIds:
    """Token ids of whole texts by a tokenizer that lower-cases, drops white space and never joins text over what its split pattern separates: a
    text's ids are its units' ids, and most units recur, so a worker keeps the ids of those it has met.

    Latin-1 texts (which no normal form changes) are split into the pattern's own units, all of a batch at once; any other text, and one with a
    special string in it, at ASCII white space only, and what else the tokenizer may split at lies inside such a word."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = {c: "".join(x for x, _ in split(chr(c))) for c in set(LOWER) if KINDS[c] != BLANK}  # a character's bytes, as the model has them
        self.known: dict[bytes | str, bytes] = {}  # by units of Latin-1 texts, and by words of others
        self.before: dict[bytes | str, bytes] = {}

    def _latin(self, text: str) -> bytes | None:
        """A text in lower case, if it can be split into units."""
        try:
            found = text.encode("latin-1").translate(LOWER)
        except UnicodeEncodeError:
            return None
        return None if any(x in text for x in self.special) else found

    def _meet(self, units: set[bytes] | set[str]) -> None:
        """Sees to it that all are known."""
        missing = units.difference(self.known)
        again = missing & self.before.keys()
        self.known.update((u, self.before[u]) for u in again)
        new = list(missing - again)
        if not new:
            return
        if isinstance(new[0], bytes):  # the library's normalizer and split leave them as they are to its model
            spelt = b"\n".join(new).decode("latin-1").translate(self.spelling).split("\n")
            made = ([t.id for t in found] for found in map(self.model.tokenize, spelt))
        else:
            made = (e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False))
        self.known.update((u, struct.pack(f"<{len(ids)}I", *ids)) for u, ids in zip(new, made))

    def _encode_latin(self, texts: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"\n".join(texts) + TAIL, np.uint8)
        first, inside = unit_starts(data)
        offsets = np.append(np.flatnonzero(first[inside]), np.count_nonzero(inside))
        if len(offsets) == 1:
            return [b""] * len(texts)
        found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
        units = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._meet(set(units))
        _, ends, ids = pa.array([self.known[u] for u in units], pa.large_binary()).take(found.indices).buffers()  # the ids in order
        places = np.cumsum([0, *(len(t) + 1 for t in texts)])
        bounds = np.frombuffer(ends, np.int64)[np.searchsorted(np.flatnonzero(first), places)].tolist()
        return [bytes(memoryview(ids)[a:b]) for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        if len(self.known) > CACHED_UNITS:
            self.known, self.before = {}, self.known
        latin = [self._latin(t) for t in texts]
        units = iter(self._encode_latin([x for x in latin if x is not None]))
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if x is None else [] for t, x in zip(texts, latin)]
        self._meet(set().union(*words))
        return [b"".join(map(self.known.__getitem__, w)) if x is None else next(units) for w, x in zip(words, latin)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids), the texts' token ids in pieces of at most `capacity`."""
    text = ids_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer)  # a task's own: its units hardly recur in other tasks, and idle workers would keep them
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            upto = np.cumsum(pc.binary_length(whole.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(upto // TEXT_BYTES)) + 1).tolist(), whole.num_rows]
            for at, to in zip(cuts, cuts[1:]):
                b = whole.slice(at, to - at)
                rows: list[tuple] = []
                for doc, ids in zip(b.column(0).to_pylist(), words.encode(b.column(1).to_pylist())):
                    ids += end
                    rows += [(doc, k, k * capacity, len(part) // 4, part) for k, part in enumerate(ids[i : i + 4 * capacity] for i in range(0, len(ids), 4 * capacity))]
                for i in range(0, len(rows), BATCH):
                    part = list(zip(*rows[i : i + BATCH]))
                    yield pa.record_batch([pa.array(part[0], b.column(0).type), pa.array(part[1], pa.int32()), pa.array(part[2], pa.int64()), pa.array(part[3], pa.int64()), pa.array(part[4], pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])
        del words
        release()

    kind = text.schema["doc_id"].dataType.simpleString()
    return text.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def fullest(lengths: list[int], left: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths (ascending; left: how many of each) with the largest sum up to room: {length: how many}."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        n, chunk = min(left[lengths[i]], room // lengths[i]), 1
        while n > 0:  # 1, 2, 4, ... copies at once
            take = min(chunk, n)
            more = (reach | (reach << (take * lengths[i]))) & mask
            if more != reach:
                steps.append((lengths[i], take, reach))
                reach = more
            n, chunk = n - take, chunk * 2
        if reach >> room:
            break
    at, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= take * length
    return out


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(how many bins, [(length, how many in each), ...]), ...] that hold every piece of the histogram."""
    left = {k: v for k, v in histogram.items() if v > 0}
    lengths, plan = sorted(left), []
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        used = fullest(lengths, left, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                lengths.remove(k)
        plan.append((times, sorted(used.items(), reverse=True)))
    return plan


def plan_rows(plan: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple]:
    """(length, first_rank, end_rank, per_bin, first_sequence, offset) for each length of each bin pattern."""
    rows, ranked, sequence = [], {}, 0
    for times, used in plan:
        offset = 0
        for length, n in used:
            first = ranked.get(length, 0)
            rows.append((length, first, first + times * n, n, sequence, offset))
            ranked[length] = first + times * n
            offset += n * length
        sequence += times
    return rows


def salts(histogram: dict[int, int]) -> dict[int, int]:
    """How many salts each length gets: at most STARTS and one a length."""
    each = max(SALT_ROWS, -(-sum(histogram.values()) // STARTS))
    return {k: -(-n // each) for k, n in histogram.items()}


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """made (a written table with rid, a number of the row, doc_id, piece, length and more columns) -> with sequence_id and offset, without rid."""
    spark, kept = made.sparkSession, [c for c in made.columns if c != "rid"]
    histogram = {r[0]: r[1] for r in made.groupBy("length").count().collect()}  # at most `capacity` lengths
    whole = made.where(F.col("length") == capacity)  # a sequence each, so their own numbers name them
    alone = whole.select(*kept, (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    histogram.pop(capacity, None)
    rows = plan_rows(minimum_bin_slack(histogram, capacity))
    table = spark.createDataFrame(rows, "length bigint, first_rank bigint, end_rank bigint, per_bin bigint, first_sequence bigint, base bigint")
    shares = spark.createDataFrame(list(salts(histogram).items()), "length bigint, salts bigint")
    salted = made.where(F.col("length") < capacity).join(F.broadcast(shares), "length").withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("salts"))).drop("salts")
    by_salt = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    starts = by_salt.select("length", "salt", before.alias("before"))  # as many as there are salts
    local = F.row_number().over(Window.partitionBy("length", "salt").orderBy("rid")) - 1
    ranked = salted.withColumn("local", local).join(F.broadcast(starts), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("local"))
    m, t = ranked.alias("m"), (F.broadcast(table) if len(rows) <= PLAN_ROWS else table).alias("t")
    found = m.join(t, (F.col("m.length") == F.col("t.length")) & (F.col("m.rank") >= F.col("t.first_rank")) & (F.col("m.rank") < F.col("t.end_rank")))
    nth = F.col("m.rank") - F.col("t.first_rank")
    planned = found.select(
        *(F.col(f"m.{c}") for c in kept),
        (F.col("t.first_sequence") + F.floor(nth / F.col("t.per_bin"))).cast("bigint").alias("sequence_id"),
        (F.col("t.base") + (nth % F.col("t.per_bin")) * F.col("m.length")).cast("bigint").alias("offset"),
    )
    return planned.unionByName(alone)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all texts with their ids and places."""
    made = pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    return pack(materialize(made.withColumn("rid", F.monotonically_increasing_id()), "pieces"), capacity)


def packed_digests(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """packed_documents() with a CRC-32 of each piece's ids in their place, taken as the ids are made: only the digests are written."""
    made = pieces(docs, tokenizer, capacity, end_id).withColumn("rid", F.monotonically_increasing_id())
    return pack(materialize(made.select("rid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces"), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences, each at most `capacity` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return whole.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
