"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

Texts of up to `giant` code points are encoded by the library in Arrow batches. A longer one is cut into chunks; a chunk sees REACH code points more on
either side, whatever the text. Its segmentation depends on its neighbours only through the piece that covers (or ends at) the cut before it, so each
chunk yields a transfer matrix over max-plus: from every piece that may cover its left cut to every piece that may cover its right cut, the best score of
a path between them, or minus infinity (no entry). Up-sweep: the matrices of FAN neighbours are combined into one, level by level, until a document has
one (the product is associative, so the tree may have any shape). Down-sweep: a node whose outer states are known fixes those between its
children by the best path, down to the chunks. Each chunk is then backtraced on its own. Only matrices (a few entries each: boundary states are
pieces over one place) and states leave a chunk's task, and a task sees at most FAN of them at a time.

For a unigram model a path's score is the sum of its pieces' scores. The models at hand are BPE, whose result is not a best sum of scores. It
is a path all the same: a sequence of pieces is the BPE encoding of a text if and only if each piece is the encoding of itself and each two
neighbours are the encoding of their concatenation (merges have strict ranks). So for BPE a piece is a state, a step between two pieces
that don't encode that way is minus infinity, any other is 0, and just one path is left. Runs of two or more spaces have pieces of equal
rank in these models; so such a run, with the piece that holds the first character behind it, is one arc that the library encodes. Cuts are never put
into a run or close behind one, but at its front.

Pieces never join text over the front of a space, which `PieceModel` verifies on the vocabulary; so inside a chunk the scan has a single
state at each unit's start (spaces and the word behind them) and remembers units it has encoded.

Defined results: null text is empty and gives no ids; rows are independent, so ties and repeated rows get equal ids; unknown characters become
byte pieces; an empty table gives an empty result. Only id and text are read, so other columns can't clash. Decoding gives back the
text, save that U+2581, the model's own sign for a space, comes back as a space.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ids_and_text, materialize
from .tokenizing import load_pieces, once

SPACE = "▁"
GIANT, CHUNK, BATCH = 65_536, 16_384, 64
#: Code points beyond its cuts that a chunk sees (no piece is longer), and neighbours that a node of the tree combines.
REACH, FAN = 64, 16
CACHED = 200_000
#: A boundary state: where the piece over a cut starts and ends, in code points of the marked text.
State = tuple[int, int]


class PieceModel:
    """A BPE vocabulary: which pieces there are, and which may stand side by side."""

    def __init__(self, path: str):
        self.library = load_pieces(path)
        n = self.library.vocab_size()
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i) for i in range(n)]
        self.rank = {self.library.id_to_piece(i): (-self.library.get_score(i), i) for i in range(n) if not special[i]}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.rank))
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("this vocabulary has pieces that reach over the front of a space")
        if self.longest > REACH:
            raise ValueError(f"this vocabulary has pieces of over {REACH} code points")
        self.own: dict[str, bool] = {}
        self.side: dict[tuple[str, str], bool] = {}
        self.units: dict[str, list[str]] = {}

    def merge(self, text: str) -> list[str]:
        """BPE of a short text: the best-ranked neighbours first, leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best = min(((self.rank[a + b][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def is_piece(self, piece: str) -> bool:
        """A single character, or a piece that merging makes of its own characters."""
        if len(piece) == 1:
            return True
        if piece not in self.rank:
            return False
        if piece not in self.own:
            self.own[piece] = self.merge(piece) == [piece]
        return self.own[piece]

    def may_follow(self, left: str, right: str) -> bool:
        pair = (left, right)
        if pair not in self.side:
            if len(self.side) > CACHED:
                self.side.clear()
            self.side[pair] = self.merge(left + right) == [left, right]
        return self.side[pair]

    def ids(self, piece: str | int) -> list[int]:
        if isinstance(piece, int):
            return [piece]
        if piece in self.rank:
            return [self.rank[piece][1]]
        return [self.bytes[b] for b in piece.encode()]

    def unit(self, unit: str) -> list[str] | list[int]:
        """The pieces of spaces and the word behind them, one path through the lattice; ids where the library made them."""
        if unit not in self.units:
            if len(self.units) > CACHED:
                self.units.clear()
            if unit.startswith(SPACE * 2):
                self.units[unit] = self.spaced(unit)
            else:
                self.units[unit] = trail(self, unit, lattice(self, unit, {0: {-1: 1}}, len(unit)), 0, len(unit))
        return self.units[unit]

    def spaced(self, text: str) -> list[int]:
        """The library's ids of a text that starts with a space."""
        return self.library.encode(text[1:].replace(SPACE, " "))

    def last(self, ids: list[int]) -> int:
        """Code points of the last piece; an unknown character is one, in bytes."""
        return 1 if self.library.is_byte(ids[-1]) else len(self.library.id_to_piece(ids[-1]))

    def heads(self, text: str, front: int) -> list[int]:
        """Where an arc may end that starts with the run of spaces at front: behind a piece that holds the character that follows the run."""
        run = front + len(SPACE) * 2
        while run < len(text) and text[run] == SPACE:
            run += 1
        if run == len(text):
            return [run]
        return [e for e in range(run + 1, min(len(text), run + self.longest) + 1) if e - self.last(self.spaced(text[front:e])) <= run]

    def arc(self, text: str, start: int, end: int) -> list[str] | list[int]:
        """What stands for text[start:end] in the result: a piece, or the ids of a run and the piece behind it."""
        return self.spaced(text[start:end]) if text.startswith(SPACE * 2, start) else [text[start:end]]

    def ending(self, text: str, start: int, end: int) -> str:
        """The last piece of an arc."""
        return text[end - self.last(self.spaced(text[start:end])) : end] if text.startswith(SPACE * 2, start) else text[start:end]


def marked(text: str) -> str:
    """The text as the model sees it: spaces marked, one more in front."""
    return SPACE + text.replace(" ", SPACE) if text else ""


#: {where arcs end: {where they start: from which of several starting states, as bits}}; a start of -1 is the front of a unit.
Lattice = dict[int, dict[int, int]]


def lattice(model: PieceModel, text: str, arcs: Lattice, stop: int) -> Lattice:
    """arcs with all pieces that may follow them one after another and start before stop."""
    for at in range(min(arcs, default=stop), stop):
        for start, bits in arcs.get(at, {}).items():
            before = model.ending(text, start, at) if start >= 0 else None
            for to in range(at + 1, min(len(text), at + model.longest) + 1):
                piece = text[at:to]
                if model.is_piece(piece) and (before is None or model.may_follow(before, piece)):
                    ends = arcs.setdefault(to, {})
                    ends[at] = ends.get(at, 0) | bits
    return arcs


def from_front(model: PieceModel, text: str, front: int, stop: int) -> Lattice:
    """The lattice of the unit that starts at front."""
    if text.startswith(SPACE * 2, front):
        return lattice(model, text, {e: {front: 1} for e in model.heads(text, front)}, stop)
    return lattice(model, text, {front: {-1: 1}}, stop)


def trail(model: PieceModel, text: str, arcs: Lattice, start: int, end: int) -> list[str] | list[int]:
    """The pieces from start to end, of a lattice with one starting state: encodings are unique, so just one arc ends at a place."""
    back = []
    while end != start:
        before = next(iter(arcs[end]))
        back.append((before, end))
        end = before
    return [p for a, b in reversed(back) for p in model.arc(text, a, b)]


def is_front(text: str, at: int) -> bool:
    """Whether a unit starts here, or the text."""
    return at == 0 or text[at] == SPACE and text[at - 1] != SPACE


def unit_starts(text: str) -> list[int]:
    """Where a piece certainly starts: the front of each run of spaces."""
    return [m.start() for m in re.finditer(f"{SPACE}+", text)]


def cuts(text: str, chunk: int) -> list[tuple[int, int]]:
    """The (start, end) of the chunks of a marked text: cut every `chunk` code points, or at the front of a run of spaces that is there or ends up to REACH
    code points before."""
    runs = [m.span() for m in re.finditer(f"{SPACE}{{2,}}", text)]
    ends = [e for _, e in runs]
    places = [0]
    for at in range(chunk, len(text), chunk):
        i = bisect_left(ends, at - REACH)
        near = [r for r in runs[i : i + REACH] if r[0] < at]
        at = near[0][0] if near else at
        if at > places[-1]:
            places.append(at)
    return list(zip(places, [*places[1:], len(text)])) if text else []


def frame(text: str, a: int, b: int) -> tuple[int, str]:
    """(where it starts, the part of the marked text) that chunk [a, b) must see: REACH code points on either side, and the whole of a run of spaces
    that it starts or ends in or close behind (cuts() puts no cut there)."""
    left, right = max(0, a - REACH), min(len(text), b + REACH)
    if not is_front(text, a):
        run = text.rfind(SPACE * 2, max(0, left - 1), a + 1)
        while run > 0 and text[run - 1] == SPACE:
            run -= 1
        left = min(left, run) if run >= 0 else left
    if b < len(text) and text[b] == SPACE and not is_front(text, b):
        while b < len(text) and text[b] == SPACE:
            b += 1
        right = min(len(text), b + REACH)
    return left, text[left:right]


def states(model: PieceModel, body: str, cut: int) -> list[State]:
    """The arcs that may cover the cut: they start before it and end at or behind it. Where a unit starts at the cut, all arcs end there, so one state
    stands for all."""
    if cut == 0 or cut >= len(body) or is_front(body, cut):
        return [(-1, cut)]
    front = max(body.rfind(SPACE, 0, cut), 0)
    while front > 0 and body[front - 1] == SPACE:
        front -= 1
    first, found = front, []
    if body.startswith(SPACE * 2, front):
        found = [(front, e) for e in model.heads(body, front) if e >= cut]
        first = len(body) - len(body[front:].lstrip(SPACE)) + 1
    found += [(s, e) for s in range(max(first, cut - model.longest), cut) for e in range(cut, min(len(body), s + model.longest) + 1) if model.is_piece(body[s:e])]
    return found


def _fronts(body: str, at: int, stop: int) -> list[int]:
    """The unit fronts in [at, stop], the end of the body among them if it is the text's."""
    return [f for f in unit_starts(body) if at <= f <= stop] + [len(body)] * (stop == len(body))


def transfer(model: PieceModel, body: str, a: int, b: int) -> dict[State, dict[State, float]]:
    """The chunk's max-plus matrix as rows without minus infinities: for BPE every entry is 0."""
    ins, outs, fronts = states(model, body, a), states(model, body, b), _fronts(body, a, b)
    rows: dict[State, dict[State, float]] = {}
    arcs: Lattice = {}
    for k, (s, e) in enumerate(ins):
        if s >= 0 and e > b:  # the same arc covers this cut too
            rows[s, e] = {o: 0.0 for o in outs if o == (s, e)}
        else:
            arcs.setdefault(e, {})[s] = 1 << k
    if not fronts:  # one word all along
        if a < b and ins == [(-1, a)]:
            arcs = from_front(model, body, a, b)
        arcs = lattice(model, body, arcs, b)
        for k, i in enumerate(ins):
            rows.setdefault(i, {o: 0.0 for o in outs if arcs.get(o[1], {}).get(o[0], 0) >> k & 1})
        return {i: row for i, row in rows.items() if row}
    if ins == [(-1, a)]:
        through = 1
    else:
        ends = lattice(model, body, arcs, fronts[0]).get(fronts[0], {})
        through = reduce(lambda x, y: x | y, ends.values(), 0)
    last = fronts[-1]
    found = outs if last == b else [o for o in outs if o[0] in from_front(model, body, last, b).get(o[1], {})]
    return {i: {o: 0.0 for o in found} for k, i in enumerate(ins) if through >> k & 1 and found}


def combine(left: dict, right: dict) -> dict:
    """The max-plus product of two matrices whose states have absolute places."""
    out: dict = {}
    for i, row in left.items():
        best: dict = {}
        for k, x in row.items():
            for j, y in right.get(k, {}).items():
                if x + y > best.get(j, float("-inf")):
                    best[j] = x + y
        if best:
            out[i] = best
    return out


def chain_states(matrices: list[dict], first: State, last: State) -> list[State]:
    """The states at the cuts of a chain, its outer two given, on the best path."""
    ahead: list[dict[State, tuple[float, State]]] = []  # of each matrix from the last: the best score to the end, and the next state
    best = {last: 0.0}
    for m in reversed(matrices):
        now = {}
        for i, row in m.items():
            found = [(x + best[j], j) for j, x in row.items() if j in best]
            if found:
                now[i] = max(found)
        ahead.append(now)
        best = {i: x for i, (x, _) in now.items()}
    out = [first]
    for now in reversed(ahead):
        out.append(now[out[-1]][1])
    return out


def best_entry(matrix: dict) -> tuple[State, State]:
    """The states at both ends of a whole document."""
    return max(((x, i, j) for i, row in matrix.items() for j, x in row.items()))[1:]


def backtrace(model: PieceModel, body: str, before: State, after: State, stop: int) -> list[int]:
    """The ids of the arcs behind `before` up to and with `after`."""
    start, at = before
    if at >= stop:
        return []
    out: list = []
    fronts = _fronts(body, at, stop)
    if start >= 0 and (not fronts or at < fronts[0]):  # the rest of a unit whose front lies before the cut
        end = fronts[0] if fronts else after[1]
        out += trail(model, body, lattice(model, body, {at: {start: 1}}, min(end, stop)), at, end)
        at = end
    for f in fronts:
        if f > at:
            out += model.unit(body[at:f])
            at = f
    if at < stop:
        out += trail(model, body, from_front(model, body, at, stop), at, after[1])
    return [i for p in out for i in model.ids(p)]


def _model(path: str) -> PieceModel:
    return once(("pieces", path), lambda: PieceModel(path))


def encode_by_chunks(text: str, model: PieceModel, chunk: int = CHUNK, fan: int = FAN) -> list[int]:
    """One text's ids by the same matrices and the same tree, on one machine."""
    whole = marked(text)
    if not whole:
        return []
    spans = cuts(whole, chunk)
    frames = [frame(whole, a, b) for a, b in spans]
    levels = [[_moved(transfer(model, body, a - left, b - left), left) for (a, b), (left, body) in zip(spans, frames)]]
    while len(levels[-1]) > 1:
        levels.append([reduce(combine, levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    at = list(best_entry(levels[-1][0]))
    for below in reversed(levels[:-1]):
        at = [at[0], *(x for k, i in enumerate(range(0, len(below), fan)) for x in chain_states(below[i : i + fan], at[k], at[k + 1])[1:])]
    return [i for k, ((_, b), (left, body)) in enumerate(zip(spans, frames)) for i in backtrace(model, body, _shift(at[k], -left), _shift(at[k + 1], -left), b - left)]


def _shift(state: State, by: int) -> State:
    return (state[0] + by if state[0] >= 0 else -1, state[1] + by)


def _moved(matrix: dict, by: int) -> dict:
    return {_shift(i, by): {_shift(j, by): x for j, x in row.items()} for i, row in matrix.items()}


_ENTRY = "struct<s0:int,e0:int,s1:int,e1:int,score:double>"
_AT = "rid bigint, k int, s0 int, e0 int, s1 int, e1 int"
_PLACE = ("s0", "e0", "s1", "e1")
_MATRIX = pa.schema([("rid", pa.int64()), ("k", pa.int32()), ("m", pa.list_(pa.struct([*((x, pa.int32()) for x in _PLACE), ("score", pa.float64())])))])
_STATES = pa.schema([("rid", pa.int64()), ("k", pa.int32()), *((x, pa.int32()) for x in _PLACE)])


def _entries(matrix: dict) -> list[dict]:
    return [{"s0": i[0], "e0": i[1], "s1": j[0], "e1": j[1], "score": x} for i, row in matrix.items() for j, x in row.items()]


def _matrix(entries: list[dict]) -> dict:
    out: dict = {}
    for e in entries:
        out.setdefault((e["s0"], e["e0"]), {})[e["s1"], e["e1"]] = e["score"]
    return out


def _up(chains: DataFrame) -> DataFrame:
    """chains (rid, k, ms) -> (rid, k, m): the product of each chain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                m = reduce(combine, (_matrix(part["m"]) for part in r["ms"]))
                yield pa.RecordBatch.from_pylist([{"rid": r["rid"], "k": r["k"], "m": _entries(m)}], _MATRIX)

    return chains.mapInArrow(run, f"rid bigint, k int, m array<{_ENTRY}>")


def _ends(tops: DataFrame) -> DataFrame:
    """(rid, k, m), a matrix a document -> the states at both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                i, j = best_entry(_matrix(r["m"]))
                yield pa.RecordBatch.from_pylist([{"rid": r["rid"], "k": r["k"], "s0": i[0], "e0": i[1], "s1": j[0], "e1": j[1]}], _STATES)

    return tops.mapInArrow(run, _AT)


def _down(at: DataFrame, chains: DataFrame) -> DataFrame:
    """The states around each node's children from those around the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = chain_states([_matrix(part["m"]) for part in r["ms"]], (r["s0"], r["e0"]), (r["s1"], r["e1"]))
                rows = [{"rid": r["rid"], "k": part["k"], "s0": x[0], "e0": x[1], "s1": y[0], "e1": y[1]} for part, x, y in zip(r["ms"], found, found[1:])]
                yield pa.RecordBatch.from_pylist(rows, _STATES)

    return at.join(chains, ["rid", "k"]).select("rid", *_PLACE, "ms").mapInArrow(run, _AT)


def _giant(text: DataFrame, model: str, chunk: int, fan: int = FAN) -> DataFrame:
    """(doc_id, rid, k, ids): the ids of each chunk of each text."""
    kind = text.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                whole = marked(batch.column(2)[i].as_py())
                for k, (a, b) in enumerate(cuts(whole, chunk)):
                    left, body = frame(whole, a, b)
                    yield pa.record_batch([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), *(pa.array([x], pa.int32()) for x in (k, a, b, left)), pa.array([body])], names=["rid", "doc_id", "k", "a", "b", "left", "body"])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in batches:
            for r in batch.to_pylist():
                made = _moved(transfer(pieces, r["body"], r["a"] - r["left"], r["b"] - r["left"]), r["left"])
                yield pa.RecordBatch.from_pylist([{"rid": r["rid"], "k": r["k"], "m": _entries(made)}], _MATRIX)

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in batches:
            for i, r in enumerate(batch.to_pylist()):
                ids = backtrace(pieces, r["body"], _shift((r["s0"], r["e0"]), -r["left"]), _shift((r["s1"], r["e1"]), -r["left"]), r["b"] - r["left"])
                yield pa.record_batch([batch.column("doc_id").slice(i, 1), pa.array([r["rid"]]), pa.array([r["k"]], pa.int32()), pa.array([ids], pa.list_(pa.int32()))], names=["doc_id", "rid", "k", "ids"])

    numbered = text.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    chunks = materialize(numbered.mapInArrow(cut, f"rid bigint, doc_id {kind}, k int, a int, b int, left int, body string").repartition("rid", "k"), "chunks")
    level = chunks.select("rid", "k", "a", "b", "left", "body").mapInArrow(matrices, f"rid bigint, k int, m array<{_ENTRY}>")
    chains, most = [], chunks.agg(F.max("k")).first()[0] or 0
    while most > 0:
        node = F.floor(F.col("k") / fan).cast("int")
        chain = level.groupBy("rid", node.alias("node")).agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("ms"))  # fan small matrices at most
        chains.append(materialize(chain.select("rid", F.col("node").alias("k"), "ms"), "chains"))
        level, most = _up(chains[-1]), most // fan
    at = _ends(level)
    for chain in reversed(chains):
        at = _down(at, chain)
    return chunks.join(at, ["rid", "k"]).select("doc_id", "rid", "k", "b", "left", "body", *_PLACE).mapInArrow(trace, f"doc_id {kind}, rid bigint, k int, ids array<int>")


def encode(docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, k, ids): the ids of each text; a giant text has a number rid (others: -1) and parts k, whose ids are to be read in that order."""
    text = ids_and_text(docs, id_col, text_col)
    kind = text.schema["doc_id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                b = batch.slice(at, BATCH)
                ids = library.encode(b.column(1).to_pylist(), num_threads=1)
                yield pa.record_batch([b.column(0), pa.array([-1] * b.num_rows, pa.int64()), pa.array([0] * b.num_rows, pa.int32()), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "rid", "k", "ids"])

    short = text.where(F.length("text") <= giant).mapInArrow(whole, f"doc_id {kind}, rid bigint, k int, ids array<int>")
    return short.unionByName(_giant(text.where(F.length("text") > giant), model, chunk))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """encoded (doc_id, rid, k, ids) -> with text: that of the part, where k > 0 without the space that a text's first part drops."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_pieces(model)
        comma = library.piece_to_id(",")
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                b = batch.slice(at, BATCH)
                parts = b.column("ids").to_pylist()
                inner = b.column("k").to_pylist()
                # a piece in front keeps the library from dropping the space a later part may start with
                texts = library.decode([[comma, *ids] if k else ids for ids, k in zip(parts, inner)]) if parts else []
                yield pa.record_batch([*(b.column(c) for c in ("doc_id", "rid", "k", "ids")), pa.array([t[1:] if k else t for t, k in zip(texts, inner)], pa.string())], names=["doc_id", "rid", "k", "ids", "text"])

    return encoded.select("doc_id", "rid", "k", "ids").mapInArrow(run, f"doc_id {kind}, rid bigint, k int, ids array<int>, text string")


def to_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


_PRIME = (1 << 61) - 1
_SUMS = ("n", "sums", "plain", "chars")


def _sums(ids: list[int], text: str) -> tuple[int, int, int, int]:
    """(number of ids, sum of (i + 1) * id modulo _PRIME, sum of ids, code points of the text)"""
    x = np.array(ids, np.int64)
    return len(ids), int((x * np.arange(1, len(x) + 1)).sum()) % _PRIME, int(x.sum()), len(text)


def digests(docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sum, decoded_chars): per text, its number of ids, sum((i + 1) * id) over its ids modulo 2**61 - 1 with i from 0, and the code
    points of what they decode to. Short texts are encoded, decoded and summed in one pass; parts of a giant text are summed behind the ids before them."""
    text = ids_and_text(docs, id_col, text_col)
    kind = text.schema["doc_id"].dataType.simpleString()
    fields = ", ".join(f"{c} bigint" for c in _SUMS)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                b = batch.slice(at, BATCH)
                ids = library.encode(b.column(1).to_pylist(), num_threads=1)
                made = [_sums(i, t) for i, t in zip(ids, library.decode(ids, num_threads=1))]
                yield pa.record_batch([b.column(0), *(pa.array(x, pa.int64()) for x in zip(*made))], names=["doc_id", *_SUMS])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_sums(i, t) for i, t in zip(b.column("ids").to_pylist(), b.column("text").to_pylist())]
            yield pa.record_batch([*(b.column(c) for c in ("doc_id", "rid", "k")), *(pa.array(x, pa.int64()) for x in (zip(*made) if made else [()] * 4))], names=["doc_id", "rid", "k", *_SUMS])

    names = [F.col("n").alias("n_tokens"), F.col("sums").alias("ids_sum"), F.col("chars").alias("decoded_chars")]
    short = text.where(F.length("text") <= giant).mapInArrow(whole, f"doc_id {kind}, {fields}").select("doc_id", *names)
    long = decode(_giant(text.where(F.length("text") > giant), model, chunk), model).mapInArrow(parts, f"doc_id {kind}, rid bigint, k int, {fields}")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("rid").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = long.withColumn("sums", F.col("sums").cast("decimal(38,0)") + before * F.col("plain").cast("decimal(38,0)"))
    total = F.pmod(F.sum("sums"), F.lit(_PRIME).cast("decimal(38,0)")).cast("bigint")
    return short.unionByName(moved.groupBy("rid", "doc_id").agg(F.sum("n").alias("n"), total.alias("sums"), F.sum("chars").alias("chars")).select("doc_id", *names))
