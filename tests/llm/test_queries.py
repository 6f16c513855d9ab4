"""The queries without SQL over the whole small tables, row by row against brute force."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash

from skyweft.llm import html_text, queries
from skyweft.llm.tokenizing import load_pieces, load_tokenizer, tokenizer_path


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()


def test_op1_turns_and_loss(spark, sf_dir):
    talks: dict = {-7: [(0, "user", queries.CONTROL_TEXT), (1, "assistant", queries.CONTROL_TEXT)]}
    for r in table(spark, sf_dir, "conversations"):
        talks.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    want = {}
    for conv, turns in talks.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        want[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    found = {r.conv_id: r for r in queries.QUERIES["op1_chat_formatting"](spark, sf_dir).collect()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in found.items()} == want
    assert all(r.formatted_chars >= sum(len(t) for _, _, t in talks[k]) for k, r in found.items())


def test_op2_counts(spark, sf_dir):
    library = load_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 1024) for r in table(spark, sf_dir, "documents") for n in [len(library.encode(r.text or "", add_special_tokens=False).ids)]]
    assert sorted(map(tuple, queries.QUERIES["op2_token_counts"](spark, sf_dir).collect())) == sorted(want)


def test_op3_texts(spark, sf_dir):
    want = [(r.page_id, r.url, text, len(text)) for r in table(spark, sf_dir, "pages") for text in [html_text.main_text(r.html or "")]]
    assert sorted(map(tuple, queries.QUERIES["op3_html_extraction"](spark, sf_dir).collect()), key=repr) == sorted(want, key=repr)


def test_op4_ids(spark, sf_dir):
    library = load_pieces(tokenizer_path("piece_bpe_32k.model"))
    want = [(r.doc_id, len(ids), sum((i + 1) * x for i, x in enumerate(ids)) % (2**61 - 1), len(r.text or "")) for r in table(spark, sf_dir, "documents") for ids in [library.encode(r.text or "")]]
    assert sorted(map(tuple, queries.QUERIES["op4_sentencepiece"](spark, sf_dir).collect())) == sorted(want)


def test_op5_components(spark, sf_dir):
    points = {}
    for r in table(spark, sf_dir, "documents"):
        words = (r.text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        points[r.doc_id] = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
    root = {i: i for i in points}
    while True:
        new = {i: min(root[j] for j in points if (points[i] ^ points[j]).bit_count() <= 3) for i in points}
        if new == root:
            break
        root = new
    want = [(i, f"{p:016x}", root[i]) for i, p in points.items()]
    assert sorted(map(tuple, queries.QUERIES["op5_simhash"](spark, sf_dir).collect())) == sorted(want)


def test_op7_pieces_and_sequences(spark, sf_dir):
    library = load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    want, total = [], 0
    for r in table(spark, sf_dir, "documents"):
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        want += [(r.doc_id, k, 4096 * k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(ids[i : i + 4096] for i in range(0, len(ids), 4096))]
    found = queries.QUERIES["op7_packing"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    places: dict = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert len(places) == -(-total // 4096)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_takes_an_empty_table(spark, sf_dir, tmp_path, name):
    for t in ("documents", "pages", "conversations"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (name == "op1_chat_formatting")
