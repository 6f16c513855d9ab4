"""Dedup, shards, WARC audit and the pipeline against brute force."""

import gzip
import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyweft.llm import components, exact_dedup, packing, quality_rules, queries, shards, shared, simhash, simhash_similar, warc
from skyweft.llm.shared import fresh_path


def near_copies(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.5:
            text = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text))
        else:
            out.append(" ".join(rng.choices(words, k=rng.randint(1, 200))))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    texts = near_copies(1) + [None, "", "", " \n", "A b\tc D", "a B c d", "x " * 30000]
    rows = [(i, t, "v", "v", "v") for i, t in enumerate(texts)] + [(3, texts[3], "v", "v", "v"), (None, texts[5], "v", "v", "v")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, fp string, keep string, digest string")


# exact


def test_summary_keeps_every_heavy_key():
    rng = random.Random(2)
    for _ in range(50):
        items = [rng.choice(b"abc") if rng.random() < 0.6 else rng.randrange(1000) for _ in range(2000)]
        kept = exact_dedup.summarize(((x, 1) for x in items), 5)
        assert len(kept) <= 5 and {x for x in set(items) if items.count(x) > len(items) / 6} <= set(kept)


@pytest.mark.parametrize("counters", [2, 1024])
def test_exact_groups(spark, docs, counters):
    more = docs.unionByName(spark.createDataFrame([(1000 + i, "hot", "v", "v", "v") for i in range(900)], docs.schema))
    found = exact_dedup.groups(more, counters=counters).collect()
    groups: dict = {}
    for r in more.collect():
        groups.setdefault(r.text or "", []).append(r.doc_id)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    assert exact_dedup.groups(more.limit(0)).count() == 0


def test_exact_survivors(spark, docs):
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns
    assert kept.select("text").na.fill("").distinct().count() == docs.select("text").na.fill("").distinct().count()
    by = docs.groupBy(F.coalesce("text", F.lit("")).alias("t")).agg(F.max("doc_id").alias("m"))
    assert {r.doc_id for r in kept.collect()} == {r.m for r in by.collect()}


# near


def slow_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_shingles(text, width=5):
    words = text.lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def slow_components(points, distance=3):
    return slow_links(points, lambda x, y: (x ^ y).bit_count() <= distance)


def slow_links(points, linked):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if linked(points[i], points[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(points))]


def test_near_duplicates(spark, docs):
    rows = docs.collect()
    points = [slow_fingerprint(r.text) for r in rows]
    roots = slow_components(points)
    least: dict = {}
    for r, root in zip(rows, roots):
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    found = simhash.near_duplicates(docs).collect()
    want = [(r.doc_id, f"{p:016x}", least[root]) for r, p, root in zip(rows, points, roots)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.representatives(docs.where("doc_id IS NOT NULL"))
    assert {r.doc_id for r in kept.collect()} == set(least.values()) and kept.columns == docs.columns


@pytest.mark.parametrize("seed,flips", [(1, 1), (2, 2), (3, 4)])
def test_crowded_buckets_lose_no_link(spark, seed, flips):
    """Chains and clouds of fingerprints around a few centres: every link counts, and pivots must not hide any."""
    rng = random.Random(seed)
    points = set()
    for _ in range(4):
        p = rng.getrandbits(64)
        for _ in range(120):
            points.add(p)
            q = p
            for _ in range(rng.randint(1, flips)):
                q ^= 1 << rng.randrange(64)
            p = q if rng.random() < 0.4 else p
    points = sorted(points)
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    vertices = spark.createDataFrame(list(zip(signed, range(len(points)))), "fp bigint, rep bigint")
    stars, between = simhash.links(vertices, local_pivots=2)
    edges = stars.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(between)
    label = {r.v: r.root for r in components.components(edges).collect()}
    roots = slow_components(points)
    least: dict = {}
    for i, root in enumerate(roots):
        least[root] = min(least.get(root, i), i)
    assert [label.get(i, i) for i in range(len(points))] == [least[r] for r in roots]


def kept_rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_stages_keep_one_of_repeated_rows_and_judge_texts_not_ids(spark):
    """Rows that share an id are judged by their own texts, repeated rows leave one, rows without an id are rows like any other."""
    a, b = "one two three four five six seven eight", "some other words that share nothing with it at all"
    rows = [(5, a), (5, b), (3, a), (5, b), (None, "q"), (None, "q"), (8, "x y"), (8, "x y"), (None, "x y"), (2, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    exact = [(5, a), (5, b), (None, "q"), (8, "x y"), (2, None)]
    near = [(3, a), (5, b), (None, "q"), (8, "x y"), (1, "")]
    assert kept_rows(exact_dedup.survivors(docs)) == sorted(exact, key=repr)
    assert kept_rows(exact_dedup.survivors(docs, counters=2)) == sorted(exact, key=repr)
    assert kept_rows(simhash.representatives(docs)) == sorted(near, key=repr)
    assert kept_rows(simhash_similar.survivors(docs)) == sorted(near, key=repr)
    clash = docs.withColumn("__rid", F.lit("mine"))
    assert all({r["__rid"] for r in f.collect()} == {"mine"} for f in (exact_dedup.survivors(clash), simhash.representatives(clash), simhash_similar.survivors(clash)))


def shuffled(spark):
    """Bytes that stages have written to shuffles so far."""
    bus, jvm = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jvm
    bus.waitUntilEmpty(30_000)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_stages_do_not_shuffle_all_texts(spark):
    """Nothing is small enough to be broadcast of itself, as in large tables; a few near copies are verified, the other texts stay where they are."""
    rng = random.Random(9)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(2000)) for _ in range(200)]
    rows = [*enumerate(texts), *((200 + i, t) for i, t in enumerate(texts[:5])), *((300 + i, t + " end") for i, t in enumerate(texts[5:10]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    size, before = sum(len(t) for _, t in rows), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, most, want in ((exact_dedup, 0.05, {*range(5, 205), *range(300, 305)}), (simhash_similar, 0.4, {*range(200)})):
            path = fresh_path(spark, "stage-input")
            docs.write.parquet(path)
            at = shuffled(spark)
            assert {r.doc_id for r in stage.survivors(spark.read.parquet(path)).collect()} == want
            assert shuffled(spark) - at < most * size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("most", [shared.MOST_BLOCKS, 0])
def test_picked_rows_are_the_marked_ones(spark, most):
    """Numbers at the ends of words and blocks, in the upper partitions too; columns of the names that marks have."""
    numbers = [p * 2**33 + i for p in (0, 1, 700) for i in (0, 1, 31, 62, 63, 64, 127, 1023, 1024, 2047, 5000)]
    wanted = numbers[::2] + [numbers[0], 3 * 2**33]
    rows = spark.createDataFrame([(n, str(n), "own") for n in numbers], "rid bigint, block string, words string").repartition(3)
    found = shared.picked(rows, "rid", shared.marks(spark.createDataFrame([(n,) for n in wanted], "n bigint")), most)
    assert found.columns == rows.columns
    assert sorted(map(tuple, found.collect())) == [(n, str(n), "own") for n in sorted(numbers[::2])]
    assert shared.picked(rows, "rid", shared.marks(rows.limit(0).select("rid")), most).count() == 0


def test_only_frequent_digests_are_broadcast(spark):
    """One text has a third of the rows and the others a few each: the winners are those with over rows / (counters + 1), the others are shuffled."""
    docs = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"t{i // 4}") for i in range(600)], "doc_id bigint, text string")
    rows = exact_dedup.digests(docs)
    assert exact_dedup.heavy_candidates(rows, 8).count() <= 8
    plan = exact_dedup.decided(rows, 8)
    assert plan.count() == 600 and {r.group_size for r in plan.collect()} <= {200, 1, 2, 3}
    assert sorted(r.kept for r in exact_dedup.groups(docs, counters=8).collect()).count(True) == len({r.text for r in docs.collect()})


@pytest.mark.parametrize("distance", [3, 24])
def test_the_pivot_table_discards_exactly_by_the_largest_difference(spark, distance):
    rng = random.Random(distance)
    pairs = [(p, p ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 40))})) for p in (rng.getrandbits(64) for _ in range(300))]
    pairs += [(0, 2**64 - 1), (0, 0)]
    signed = lambda p: p - 2**64 if p >= 2**63 else p
    refs = [r % 2**64 for r in simhash._references()]
    far = [max(abs((p ^ r).bit_count() - (q ^ r).bit_count()) for r in refs) for p, q in pairs]
    frame = spark.createDataFrame([(i, signed(p), signed(q)) for i, (p, q) in enumerate(pairs)], "i int, p bigint, q bigint")
    x, y = (frame.select("i", *simhash.coordinates(F.col(c))).alias(a) for c, a in (("p", "x"), ("q", "y")))
    both = x.join(y, "i").select("i", simhash.may_be_within({t: F.col(f"x.{t}") for t in simhash.TABLE}, {t: F.col(f"y.{t}") for t in simhash.TABLE}, distance).alias("may"))
    assert {r.i: r.may for r in both.collect()} == {i: f <= distance for i, f in enumerate(far)}


def test_a_crowd_that_agrees_in_30_bits_is_split(spark):
    """Fingerprints that share one bucket and little else: all links are found, among them planted ones."""
    rng = random.Random(9)
    points = sorted({(rng.getrandbits(34) << 30) | 12345 for _ in range(1500)})
    points = sorted({*points, *(p ^ (1 << 40) ^ (1 << 63) for p in points[::50])})
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    stars, between = simhash.links(spark.createDataFrame(list(zip(signed, range(len(points)))), "fp bigint, rep bigint"))
    label = {r.v: r.root for r in components.components(stars.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(between)).collect()}
    least: dict = {}
    roots = slow_components(points)
    for i, root in enumerate(roots):
        least[root] = min(least.get(root, i), i)
    assert [label.get(i, i) for i in range(len(points))] == [least[r] for r in roots]


def test_keys_cover_all_pairs_at_any_size():
    assert [simhash.blocks_for(n, 3) for n in (1, 1000, 10**6, 10**9)] == sorted(simhash.blocks_for(n, 3) for n in (1, 1000, 10**6, 10**9))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    found = {r.v: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {v: r for v, r in parent.items() if v != r}


# shards


def test_shards(spark, docs):
    store = shards.ShardStore(spark, fresh_path(spark, "store"), docs.schema, target_bytes=60_000, fanout=3, base_bytes=2000)
    assert store.read().count() == 0 and store.shards() == []
    for part in range(4):
        store.append(docs.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == part).repartition(3))
    before = store.versions()[-1]
    assert before == 4 and len(store.shards()) == 12
    old = store.shards()
    store.compact()
    assert store.versions()[-1] > before and not store.due()
    assert len(store.shards()) < 12
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(store.read()) == rows(docs)
    with pytest.raises(shards.Conflict):
        store.commit(store.versions()[-1], [])
    with pytest.raises(shards.Conflict):
        store.merge(old[:2])  # another writer has merged these
    again = shards.ShardStore(spark, store.root, docs.schema)
    assert again.append(docs.limit(0)) == store.versions()[-1]
    assert rows(again.read()) == rows(docs)


def test_a_store_keeps_versions_until_vacuum(spark, docs):
    store = shards.ShardStore(spark, fresh_path(spark, "store"), docs.schema)
    store.append(docs.limit(10))
    store.append(docs.limit(5))
    assert (store.read(1).count(), store.read().count()) == (10, 15)
    store.vacuum()
    assert store.versions() == [2] and store.read().count() == 15


def test_compaction_runs_without_python(spark, docs):
    store = shards.compacted(docs, fresh_path(spark, "store"), F.pmod("doc_id", F.lit(3)))
    assert "Python" not in store.read()._jdf.queryExecution().executedPlan().toString()
    assert store.read().count() == docs.count()


def test_an_overtaken_writer_loses_no_rows(spark, docs):
    """A reads the last version, B appends twice and vacuums, A commits on what it has read."""
    root = fresh_path(spark, "store")
    a, b = (shards.ShardStore(spark, root, docs.schema) for _ in range(2))
    a.append(docs.limit(1))
    stale = a.last()
    mine = a._write(docs.limit(3))
    b.append(docs.limit(5))
    b.append(docs.limit(7))
    b.vacuum()
    with pytest.raises(shards.Conflict):
        a.commit(stale + 1, [mine])
    assert b.last() == 3 and b.read().count() == 13
    assert a._change([mine]) == 4
    assert a.read().count() == b.read().count() == 16


def test_an_open_reader_outlives_compaction(spark, docs):
    store = shards.ShardStore(spark, fresh_path(spark, "store"), docs.schema, fanout=2)
    store.append(docs.limit(10))
    store.append(docs.limit(20))
    version, reader = store.last(), store.read()
    store.compact()
    assert store.last() > version and len(store.runs()) == 1
    assert reader.count() == store.read(version).count() == store.read().count() == 30
    store.vacuum(keep=1, age_seconds=3600)
    assert store.read(version).count() == 30  # too young to go
    store.vacuum()
    assert store.versions() == [store.last()] and store.read().count() == 30


def test_vacuum_takes_what_lost_jobs_left_and_checkpoints_shorten_the_log(spark, docs, monkeypatch):
    monkeypatch.setattr(shards, "CHECKPOINT_EVERY", 3)
    store = shards.ShardStore(spark, fresh_path(spark, "store"), docs.schema, fanout=100)
    lost = store._write(docs.limit(2))
    for n in range(7):
        store.append(docs.limit(n))
    assert store.versions() == [1, 2, 3, 4, 5, 6, 7] and store._checkpoint() == 6
    assert [store.read(v).count() for v in (1, 4, 7)] == [0, 6, 21]
    store.vacuum(keep=2)
    assert store.versions() == [6, 7] and store._files(lost.folder)
    store.vacuum(keep=2, orphan_seconds=0)
    assert store.read().count() == 21 and not store._fs.exists(store._path(lost.folder))


def test_arrivals_are_appends_of_their_own_and_no_column_clashes(spark):
    rows = spark.createDataFrame([(i, f"t{i}", i * 7) for i in range(40)] + [(None, "none", 1)], "doc_id bigint, text string, __arrival bigint")
    store = shards.compacted(rows, fresh_path(spark, "store"), F.pmod("doc_id", F.lit(8)), 8, fanout=4)
    assert store.last() >= 9 + 2  # eight arrivals, the row without one, merges between them
    assert sorted(map(tuple, store.read().collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)


# WARC


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>é{i}</p>" * (i % 7)) for i in range(700)] + [(None, None, None), (5, "http://h/5", "x" * 100_000), (5, "http://h/5", "x" * 100_000)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def test_records_parse_back(pages):
    for r in warc.records(pages.limit(20)).collect():
        (offset, length, headers, block), = warc.parse(bytes(r.record))
        assert offset == 0 and length == len(r.record) and headers["content-type"] == "text/html"


def test_warc_files(spark, tmp_path, pages):
    data = b"".join(bytes(r.record) for r in warc.records(pages.limit(10)).collect())
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data[: len(data)]))
    found = warc.read_files(spark, str(tmp_path)).collect()
    assert len(found) == 20
    for r in found:
        assert data[r.offset : r.offset + r.length].endswith(bytes(r.block) + b"\r\n\r\n")


@pytest.mark.parametrize("fanout", [2, 16])
def test_audit_finds_exactly_the_damage(spark, pages, fanout):
    first = warc.records(pages)
    wrong = F.when(F.col("page_id") % 50 == 7, F.overlay("record", F.encode(F.lit("Z"), "UTF-8"), F.lit(3))).otherwise(F.col("record"))
    second = first.where("page_id IS NULL OR page_id % 90 <> 11").select("page_id", "file", "place", wrong.alias("record"))
    second = second.unionByName(spark.createDataFrame([(-1, 0, 5000, b"more")], "page_id bigint, file bigint, place bigint, record binary"))
    found = warc.audit(warc.tree(warc.index(first), fanout), warc.tree(warc.index(second), fanout), fanout)
    got = {(r.file, r.place): r.status for r in found.collect()}
    want = {(0, 5000): "surplus"}
    for r in first.select("page_id", "file", "place").collect():
        if r.page_id is not None and r.page_id % 90 == 11:
            want[r.file, r.place] = "missing"
        elif r.page_id is not None and r.page_id % 50 == 7:
            want[r.file, r.place] = "damaged"
    assert got == want
    same = warc.tree(warc.index(first), fanout)
    assert warc.audit(same, list(same), fanout).count() == 0


def test_a_replica_that_counts_its_own_places_loses_only_what_it_lost(spark, pages):
    """One lost, one inserted and one longer record move all that follows, in a file of some hundred records."""
    first = warc.records(pages.coalesce(1))
    longer = F.when(F.col("place") == 300, F.concat("record", F.encode(F.lit("more"), "UTF-8"))).otherwise(F.col("record"))
    second = first.where("place <> 40").select("file", F.col("place").cast("double").alias("place"), longer.alias("record"))
    second = second.unionByName(spark.createDataFrame([(0, 99.5, b"WARC/1.0\r\nWARC-Record-ID: <urn:uuid:new>\r\n\r\n")], "file bigint, place double, record binary"))
    ours, theirs = warc.index(first), warc.index(second, renumber=True)
    assert {r.place for r in theirs.collect()} == set(range(first.count()))
    found = warc.audit(warc.tree(ours, 4), warc.tree(theirs, 4), 4)
    assert sorted((r.place, r.status) for r in found.collect()) == [(40, "missing"), (99, "surplus"), (300, "damaged")]
    taller = warc.audit(warc.tree(ours, 4), warc.tree(theirs, 4, height=7), 4)
    assert taller.count() == 3


def test_a_descent_leaves_parts_out(spark, pages):
    levels = warc.tree(warc.index(warc.records(pages.coalesce(1))), 4)
    open_ = levels[1].rows.where("key <> 'end'").limit(1).select("file", F.col("key").alias("up"))
    of = warc._of(levels[0], open_)
    assert "PartitionFilters: [isnotnull(part" in of._jdf.queryExecution().executedPlan().toString() or "part#" in of._jdf.queryExecution().executedPlan().toString()
    assert of.select("part").distinct().count() == 1 and of.count() < 60


def test_bad_files_are_rows_with_an_error(spark, tmp_path, pages):
    good = [bytes(r.record) for r in warc.records(pages.where("page_id < 3")).collect()]
    bad = {"cut": good[0] + good[1][:-40], "junk": good[0] + b"not a record\r\n\r\n" + good[1], "length": good[0].replace(b"Content-Length", b"Content-Size") + good[1], "head": b"WARC/1.0\r\nContent-Length: 1", "none": b"", "gz": gzip.compress(good[0])[:-20]}
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
    got: dict = {}
    for r in warc.read_files(spark, str(tmp_path), batch_bytes=10).collect():
        got.setdefault(r.path.rpartition("/")[2], []).append((r.offset, r.error is None))
    at = len(good[0])
    assert sorted(got["cut"]) == [(0, True), (at, False)] and sorted(got["junk"]) == [(0, True), (at, False), (at + 16, True)]
    assert [ok for _, ok in sorted(got["length"])] == [False, True] and got["head"] == [(0, False)] and "none" not in got
    for piece in (1, 7, 1 << 20):
        whole = list(warc.parse(b"".join(good), piece))
        assert [x[1] for x in whole] == [len(g) for g in good] and all("warc-date" in x[2] and x[2]["warc-record-id"].startswith("<urn:uuid:") for x in whole)
    breaks = spark.createDataFrame([(1, "http://h/\r\nX: y", "p")], "page_id bigint, url string, html string")
    ((_, _, headers, block),) = warc.parse(bytes(warc.records(breaks).first().record))
    assert headers["warc-target-uri"] == "http://h/%0D%0AX: y" and "x" not in headers and block == b"p"


def test_empty_replicas_agree(spark, pages):
    none = warc.tree(warc.index(warc.records(pages.limit(0))))
    assert warc.audit(none, list(none)).count() == 0


# the whole


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    wanted, found = c.execute(queries.ORACLES[name]).df(), queries.QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    rows = lambda f: sorted(map(repr, f[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_without_sql_give_a_row_each(spark, sf_dir, name):
    table, column = {"op1_chat_formatting": ("conversations", "conv_id"), "op3_html_extraction": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    found, source = queries.QUERIES[name](spark, sf_dir), spark.read.parquet(f"{sf_dir}/{table}.parquet")
    assert found.select(column).distinct().count() == source.select(column).distinct().count() + (name == "op1_chat_formatting")


def test_three_bits_over_the_table(spark, sf_dir):
    """The operator's own rule over the documents of the table: fingerprints of 3-word shingles within 3 bits."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id IS NOT NULL").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    first: dict = {}
    for (i, _), root in zip(rows, slow_components([slow_fingerprint(t) for _, t in rows])):
        first[root] = min(first.get(root, i), i)
    assert {r.doc_id for r in simhash.representatives(docs).collect()} == set(first.values())


def test_pipeline(spark, sf_dir):
    """The stages by brute force. Near-duplicates in a stage are five-word shingle sets of a Jaccard similarity of 0.8 or more; the three bits of the
    operator's own query have a test of their own above."""
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    good = {r.doc_id for r in quality_rules.measured(frame).where("kept").collect()}
    rows = [r for r in rows if r[0] in good]
    last = {t: max(i for i, x in rows if x == t) for _, t in rows}
    rows = sorted((i, t) for i, t in rows if last[t] == i)
    roots = slow_links([slow_shingles(t) for _, t in rows], lambda x, y: 5 * len(x & y) >= 4 * len(x | y))
    first: dict = {}
    for (i, _), root in zip(rows, roots):
        first[root] = min(first.get(root, i), i)
    kept = set(first.values())
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == kept
    words = packing.WordIds(queries.tokenizer_path("word_bpe_49k.json"))
    total = {i: len(words.encode([t])[0]) // 4 + 1 for i, t in rows if i in kept}
    by: dict = {}
    for r in found:
        by[r.doc_id] = by.get(r.doc_id, 0) + r.length
    assert by == total
    assert len({r.sequence_id for r in found}) == -(-sum(total.values()) // 4096)
    assert np.all([r.offset + r.length <= 4096 for r in found])


# near copies in the pipeline


def test_near_dedup_links_what_is_eight_tenths_alike(spark):
    """Against brute force: chains of copies, repeated rows, rows without an id, texts without words."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    rows = list(enumerate(near_copies(3, 120)))
    for k in range(15):
        text = rng.choices(words, k=200)
        for step in range(5):
            rows.append((1000 + 10 * k + step, " ".join(text)))
            for _ in range(3):
                text[rng.randrange(200)] = rng.choice(words)
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, "a b c d e f"), (None, "A b c d e f"), (7000, None), (7001, " \n")]
    split = [(t or "").lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in split]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 5 * len(x & y) >= 4 * len(x | y):
                parent[find(i)] = find(j)
    groups: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    want = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=repr)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.near(spark, docs, "")
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == want
