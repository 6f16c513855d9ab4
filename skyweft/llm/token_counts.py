"""Token counts with overlap resynchronisation for huge documents.

Texts of up to `chunk` code points are counted in Arrow batches: such a text is split where white space begins, which the byte-level pattern always
does too, and the library encodes each of a task's different words once. A text with a special string, or for another kind of tokenizer, is encoded
as it is. A longer text is cut at special strings (as the library does before
anything else) and its plain stretches into chunks, which are dealt out over the cluster. Each chunk is encoded with offsets, `overlap` code points into
its right neighbour, and so are the neighbour's first ones. The two are spliced at a place where both have a pre-token boundary that is proven: the
byte-level pre-tokenizer scans from left to right and looks at most LOOKAHEAD code points past a match, so a pre-token that ends that far before the
end of what was encoded is one of the whole text if the one before it was. Equal boundaries then mean equal scans from there on, so tokens left of the
place count in the left chunk and the others in the right one: a chunk adds its tokens before the place and takes off the neighbour's.

A chunk whose right seam has no common boundary is encoded again, alone, with an overlap of WIDEN times the length; from a quarter of a chunk on it is
joined with its neighbour instead, and all neighbours in a row whose seams are open become one chunk at once. So a text that is one pre-token is
encoded a few times as a whole, not once for every chunk.

Defined results: null text is empty (0 bytes, 0 tokens); rows are independent, so ties and repeated rows get equal counts; an empty table
gives an empty result. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ids_and_text, materialize
from .tokenizing import load_tokenizer, release

CHUNK, OVERLAP, WIDEN, LIMIT = 65_536, 256, 4, 1024
#: Code points past the end of a match that the pre-token pattern may have looked at ('re, 've, 'll reach two further than the apostrophe).
LOOKAHEAD = 3
BATCH = 64
#: Words whose counts a task keeps (in each of two generations), and the code points of the longest that it keeps.
CACHED_WORDS, CACHED_LENGTH = 400_000, 64
#: A word with the white space before it. No match of the byte-level pattern goes on from a word into white space, and none looks back.
SPACED_WORDS = re.compile(r"\s*\S+|\s+")
#: White space in Python but not in Unicode's (and the library's) property.
SEPARATORS = re.compile(r"[\x1c-\x1f]")


def _specials(tokenizer) -> re.Pattern | None:
    found = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, found))) if found else None


class WordCounts:
    """Token counts of whole texts by a tokenizer: the sum of their words' counts where it can't join text over the beginning of white space."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.special = _specials(self.tokenizer)
        before = self.tokenizer.pre_tokenizer
        self.by_words = self.tokenizer.normalizer is None and type(before).__name__ == "ByteLevel" and before.use_regex and not before.add_prefix_space
        self.known: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def _words(self, text: str) -> list[str]:
        whole = not self.by_words or SEPARATORS.search(text) or (self.special and self.special.search(text))
        return [text] if whole else SPACED_WORDS.findall(text)

    def counts(self, texts: list[str]) -> list[int]:
        split = [self._words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.before = {}, self.known
        missing = set().union(*split).difference(self.known)
        again = missing & self.before.keys()
        self.known.update((w, self.before[w]) for w in again)
        new = list(missing - again)
        self.known.update(zip(new, (len(e.ids) for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        get = self.known.__getitem__
        found = [sum(map(get, w)) for w in split]
        for w in new:
            if len(w) > CACHED_LENGTH:
                del self.known[w]
        return found


def stretches(text: str, tokenizer) -> tuple[int, list[tuple[int, int]]]:
    """(number of special strings, the (start, end) of what lies between them)."""
    pattern, at, out, n = _specials(tokenizer), 0, [], 0
    for m in pattern.finditer(text) if pattern else ():
        out.append((at, m.start()))
        at, n = m.end(), n + 1
    out.append((at, len(text)))
    return n, [x for x in out if x[1] > x[0]]


def boundaries(text: str, tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """(pre-token ends in code points, tokens up to each) of one chunk, from the offsets of its tokens."""
    made = tokenizer.encode(text, add_special_tokens=False)
    words = np.array(made.word_ids, np.int64)
    last = np.flatnonzero(np.append(words[1:] != words[:-1], True)) if len(words) else words
    return np.array(made.offsets, np.int64).reshape(-1, 2)[last, 1], last + 1


def splice(left: str, head: str, start: int, end: int, size: int, tokenizer) -> tuple[int, int] | None:
    """(tokens of the left chunk, tokens of its neighbour) before the first boundary behind `end`, or at it, that both have; None if there is none.
    left: the stretch, of `size` code points, from the chunk's start on over its end; head: the stretch from its end on, where the neighbour starts."""
    ends, counts = boundaries(left, tokenizer)
    ends = ends + start
    if end >= size:
        return (int(counts[-1]) if len(counts) else 0), 0
    proven = lambda places, stop: (places <= stop - LOOKAHEAD) | (places == size)
    tail = (ends >= end) & proven(ends, start + len(left))
    right, before = boundaries(head, tokenizer)
    right = right + end
    known = {end: 0} | {p: n for p, n, ok in zip(right.tolist(), before.tolist(), proven(right, end + len(head)).tolist()) if ok}
    return next(((n, known[p]) for p, n in zip(ends[tail].tolist(), counts[tail].tolist()) if p in known), None)


def bodies(body: str, start: int, end: int, overlap: int) -> tuple[str, str]:
    """What splice() must see of a stretch."""
    return body[start : end + overlap + LOOKAHEAD], body[end : end + overlap + LOOKAHEAD]


def joined(parts: list[tuple[int, int, int, bool]], chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """The chunks (start, end, overlap) to encode next, of a stretch's chunks (start, end, overlap, whether its seam is open) in order."""
    out, at = [], 0
    while at < len(parts):
        start, end, wide, open_ = parts[at]
        at += 1
        if not open_:
            continue
        if WIDEN * wide <= max(overlap, chunk // 4):
            out.append((start, end, WIDEN * wide))
            continue
        while open_ and at < len(parts):
            _, end, wide, open_ = parts[at]
            at += 1
        out.append((start, end, overlap))
    return out


def count_by_chunks(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The count of one text in memory, by the same chunks and splices."""
    n, plain = stretches(text, tokenizer)
    for a, b in plain:
        body, todo, found = text[a:b], [(x, min(x + chunk, b - a), overlap) for x in range(0, b - a, chunk)], {}
        while todo:
            for x, y, wide in todo:
                found = {k: v for k, v in found.items() if not x <= k[0] < y} | {(x, y): (wide, splice(*bodies(body, x, y, wide), x, y, b - a, tokenizer))}
            todo = joined([(*k, wide, made is None) for k, (wide, made) in sorted(found.items())], chunk, overlap)
        n += sum(made[0] - made[1] for _, made in found.values())
    return n


_PARTS = "rid bigint, s int, start int, end int, overlap int, tokens bigint"


def _encode(parts: DataFrame, huge: DataFrame, tokenizer: str) -> DataFrame:
    """parts (rid, s, start, end, overlap) -> with tokens: what the chunk adds to its stretch's count, NULL where its seam is open."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for at in range(0, len(row["parts"]), BATCH // 4):
                    made = [{**p, "rid": row["rid"], "s": row["s"], "size": len(row["body"])} for p in row["parts"][at : at + BATCH // 4]]
                    for p in made:
                        p["left"], p["head"] = bodies(row["body"], p["start"], p["end"], p["overlap"])
                    yield pa.RecordBatch.from_pylist(made, _BODIES)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_tokenizer(tokenizer)
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                made = splice(r["left"], r["head"], r["start"], r["end"], r["size"], library)
                yield pa.RecordBatch.from_pylist([{**{c: r[c] for c in ("rid", "s", "start", "end", "overlap")}, "tokens": made and made[0] - made[1]}], _COUNTS)

    asked = parts.groupBy("rid", "s").agg(F.collect_list(F.struct("start", "end", "overlap")).alias("parts"))  # a few numbers a chunk
    dealt = huge.select("rid", "s", "body").join(asked, ["rid", "s"]).select("rid", "s", "body", "parts")
    dealt = dealt.mapInArrow(cut, "rid bigint, s int, start int, end int, overlap int, size int, left string, head string")
    return dealt.repartition("rid", "s", "start").mapInArrow(encode, _PARTS)


_BODIES = pa.schema([("rid", pa.int64()), *((x, pa.int32()) for x in ("s", "start", "end", "overlap", "size")), ("left", pa.string()), ("head", pa.string())])
_COUNTS = pa.schema([("rid", pa.int64()), *((x, pa.int32()) for x in ("s", "start", "end", "overlap")), ("tokens", pa.int64())])


def _join(parts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The chunks to encode next, of all of those stretches that have open seams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = joined([(p["start"], p["end"], p["overlap"], p["tokens"] is None) for p in row["parts"]], chunk, overlap)
                made = [{"rid": row["rid"], "s": row["s"], "start": x, "end": y, "overlap": w} for x, y, w in found]
                yield pa.RecordBatch.from_pylist(made, pa.schema(list(_COUNTS)[:5]))

    all_ = parts.groupBy("rid", "s").agg(F.array_sort(F.collect_list(F.struct("start", "end", "overlap", "tokens"))).alias("parts"), F.count_if(F.col("tokens").isNull()).alias("open"))
    return all_.where("open > 0").select("rid", "s", "parts").mapInArrow(run, "rid bigint, s int, start int, end int, overlap int")


def _whole(text: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of texts of up to a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordCounts(tokenizer)  # a task's own, as idle workers would keep it
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                n = words.counts(b.column(2).to_pylist())
                yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
        del words
        release()

    kind = text.schema["doc_id"].dataType.simpleString()
    return text.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def _huge(text: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of texts over `chunk` code points."""
    numbered = text.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_tokenizer(tokenizer)
        for batch in batches:
            for i in range(batch.num_rows):
                rid, doc, size, body = (batch.column(c)[i] for c in range(4))
                body = body.as_py()
                n, plain = stretches(body, library)
                for s, (a, b) in enumerate(plain or [(0, 0)]):
                    yield pa.record_batch([pa.array([rid]), pa.array([doc], batch.column(1).type), pa.array([size]), pa.array([n if s == 0 else 0], pa.int64()), pa.array([s], pa.int32()), pa.array([body[a:b]])], names=["rid", "doc_id", "n_bytes", "specials", "s", "body"])

    kind = text.schema["doc_id"].dataType.simpleString()
    huge = materialize(numbered.mapInArrow(cut, f"rid bigint, doc_id {kind}, n_bytes bigint, specials bigint, s int, body string"), "stretches")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(chunk))).alias("start")
    todo = huge.select("rid", "s", F.length("body").alias("size")).select("rid", "s", "size", starts)
    todo = todo.select("rid", "s", "start", F.least(F.col("start") + chunk, "size").alias("end"), F.lit(overlap).alias("overlap"))
    parts = materialize(_encode(todo, huge, tokenizer), "parts")
    while not parts.where("tokens IS NULL").isEmpty():
        todo = materialize(_join(parts, chunk, overlap), "open")
        gone = todo.select("rid", "s", F.col("start").alias("from"), F.col("end").alias("to"))
        inside = (parts["rid"] == gone["rid"]) & (parts["s"] == gone["s"]) & (parts["start"] >= gone["from"]) & (parts["start"] < gone["to"])
        parts = materialize(parts.join(gone, inside, "left_anti").unionByName(_encode(todo, huge, tokenizer)), "parts")
    whole = huge.select("rid", "s", "doc_id", "n_bytes", "specials").join(parts.groupBy("rid", "s").agg(F.sum("tokens").alias("total")), ["rid", "s"])
    return whole.groupBy("rid", "doc_id", "n_bytes").agg((F.sum("specials") + F.sum("total")).cast("bigint").alias("n_tokens")).drop("rid")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for each row of docs; counts as the library gives them for the whole text."""
    text = ids_and_text(docs, id_col, text_col)
    counted = _whole(text.where(F.length("text") <= chunk), tokenizer).unionByName(_huge(text.where(F.length("text") > chunk), tokenizer, chunk, overlap))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
