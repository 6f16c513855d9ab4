"""Chat windows, token counts, page text, pieces, packing and rules against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyweft.llm import chat, html_text, packing, quality_rules, sentence_pieces, token_counts
from skyweft.llm.tokenizing import load_tokenizer, tokenizer_path

BYTES, WORDS, PIECES = (tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["a", "b", " ", "  ", "\n", "'re", "'", "é", "日", "1", "23", "<|endoftext|>", "!!", "don't", "\t", " ", "x" * 40, "😀", "<|endoftext", "the", "###", "</turn>", "\\", "é"]
texts = st.lists(st.sampled_from(ODD), max_size=40).map("".join)
DOCS = "doc_id bigint, text string, fp string, n_tokens string, length string, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empties, a very long text, repeated rows, and columns that clash with the operators' own."""
    rows = [(1, None), (2, ""), (3, "  \n "), (4, "one two"), (5, "The cat and the dog. " * 40), (5, "The cat and the dog. " * 40), (6, "q" * 9000 + " tail" * 4000), (7, "<|endoftext|> x " * 3000), (None, "no id"), (8, "日本語 " * 500)]
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], DOCS)


# chat


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=5), texts), max_size=6))
def test_template_is_reversible(turns):
    assert chat.parse("".join(chat.format_turn(r, t)[0] for r, t in turns)) == turns
    for r, t in turns:
        formatted, a, b = chat.format_turn(r, t)
        assert chat.unescape(formatted[a:b]) == t


def test_windows(spark):
    rng = random.Random(4)
    rows = []
    for conv in [*range(40), None]:
        n = rng.randint(1, 12)
        rows += [(conv, k, "system" if k == 0 and rng.random() < 0.4 else ("assistant", "user")[k % 2], "".join(rng.choices(ODD, k=rng.randint(0, 60))), "x") for k in range(n)]
    rows += [(100, 0, None, None, "x"), (100, 0, None, None, "x"), (100, None, "assistant", "first", "x"), (101, 0, "assistant", "long " * 5000, "x")]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window string")
    made = chat.windows(talks, BYTES, budget=128)
    found = {r.conv_id: r for r in chat.read_back(made).collect()}
    whole: dict = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        whole.setdefault(conv, []).append((role or "", text or ""))
    assert set(found) == set(whole)
    for conv, turns in whole.items():
        r = found[conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    by: dict = {}
    for w in made.collect():
        by.setdefault(w.conv_id, []).append(w)
        assert w.tokens <= 128 or (w.n_new == 1 and w.over_budget)
    for conv, windows in by.items():
        windows.sort(key=lambda w: w.window)
        assert [w.first_turn for w in windows] == [sum(x.n_new for x in windows[:i]) for i in range(len(windows))]
        system = whole[conv][0] if whole[conv][0][0] == "system" else None
        for w in windows[1:]:
            if system:
                assert chat.parse(w.text)[0] == system
    assert any(w.n_repeated > 1 for ws in by.values() for w in ws)
    assert chat.read_back(chat.windows(talks.limit(0), BYTES)).count() == 0


# token counts


@settings(max_examples=120, deadline=None)
@given(texts, st.integers(3, 50), st.integers(1, 12))
def test_chunked_counts_are_the_librarys(text, chunk, overlap):
    library = load_tokenizer(BYTES)
    assert token_counts.count_by_chunks(text, library, chunk, overlap) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aeéß'sstre l  \t\n\x0b\x85\xa0\x1c\x1f1²½.,*<|Äς日😀\u1680\u180e\u2003\u200b\u2028\u202f\u3000\ufeff", max_size=40) | texts, max_size=4))
def test_counts_by_words_are_the_librarys(many):
    words = token_counts.WordCounts(BYTES)
    want = [len(words.tokenizer.encode(t, add_special_tokens=False).ids) for t in many]
    assert words.counts(many) == words.counts(many) == want


def test_each_word_is_encoded_once(monkeypatch):
    words, library, asked = token_counts.WordCounts(BYTES), load_tokenizer(BYTES), []

    class Watched:
        def encode_batch_fast(self, given, **more):
            asked.extend(given)
            return library.encode_batch_fast(given, **more)

    words.tokenizer = Watched()
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 4)  # the next batch begins another generation
    long = " " + "日本" * 100
    many = ["The cat and the dog." * 50, "the cat\n and the dog" + long, "<|endoftext|> x"] * 3
    for _ in range(3):
        assert words.counts(many) == [len(library.encode(t, add_special_tokens=False).ids) for t in many]
    assert Counter(asked)[" the"] == Counter(asked)["the"] == 1 and Counter(asked)[long] == 3  # too long to be kept
    assert long not in words.known


def test_token_counts(spark, docs):
    library = load_tokenizer(BYTES)
    found = token_counts.token_counts(docs, BYTES, limit=100, chunk=2000, overlap=16).collect()
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 100) for r in docs.collect() for n in [len(library.encode(r.text or "", add_special_tokens=False).ids)]]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(docs.limit(0), BYTES).count() == 0


# pages


ARTICLE = "First, a long enough paragraph; it has words, commas and stops. It goes on, and on."


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        (f"<nav><a>Home</a></nav><article><h1>T</h1><p>{ARTICLE}<p>Sh<b>or</b>t<br>x</article><footer>f</footer>", f"T {ARTICLE} Short x"),
        (f"<header>Site</header><div class='cookie-notice'>{ARTICLE}</div><div id=content><p>{ARTICLE}</p><p>b</p></div><div class=sidebar><p>{ARTICLE}</p></div>", f"{ARTICLE} b"),
        (f"<main><p>{ARTICLE}</p><section class='comments'><p>{ARTICLE}</p></section><form>f<input></form><aside>s</aside><script>var a = '<p>no</p>'</script></main>", ARTICLE),
        (f"<article><header><h1>Head</h1></header><p>{ARTICLE}</p><footer>f</footer><!-- <p>no</p> --></article>", f"Head {ARTICLE}"),
        (f"<body class='has-sidebar'><div class='with-sidebar'><p>{ARTICLE}</p></div><div class=ad>ad</div>", ARTICLE),
        (f"<article><p>{ARTICLE}<div style='display: none'>no</div><p hidden>no</p></article", ARTICLE),
        ("<nav>only</nav>", ""),
        ("<p>a<b>c</p></i><td>d", "ac d"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = " ".join(f"<p>Paragraph {i}: {ARTICLE * 4}</p>" for i in range(12))


@pytest.mark.parametrize("part", ["<div class=section>{}</div>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<table><tr><td>{}</td></tr></table>"])
def test_text_around_the_largest_part_stays(part):
    page = f"<nav>no</nav><div id=content><h1>T</h1><p>Intro. {ARTICLE}</p>{part.format(LONG)}<p>Outro. {ARTICLE}</p></div><div class=sidebar><p>no</p></div>"
    found = html_text.main_text(page)
    assert found.startswith(f"T Intro. {ARTICLE} Paragraph 0:") and found.endswith(f"Outro. {ARTICLE}") and "no" not in found.split()


def test_teaser_cards_replace_no_body():
    cards = "".join(f"<article><p>Card {i}: {ARTICLE * 4}</p></article>" for i in range(4))
    found = html_text.main_text(f"<div id=content><h1>T</h1>{LONG}</div><div>{cards}</div>")
    assert all(f"Paragraph {i}:" in found for i in range(12))


def test_pages(spark):
    page = f"<article><p>{ARTICLE}</p></article>"
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, page, "x"), (2, None, page, "x"), (3, "u", page * 3000, "x")], "page_id bigint, url string, html string, text string")
    found = sorted(map(tuple, html_text.main_texts(pages).collect()), key=repr)
    assert found[0] == (1, "u", "", 0) and found[1] == found[2] == (2, None, ARTICLE, len(ARTICLE))
    assert found[3][3] == 3000 * (len(ARTICLE) + 1) - 1
    assert html_text.main_texts(pages.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<", ">", "a", " ", "&lt", '"', "'", "<b", "=", "<!--", "-->", "<script>", "</script", "<article>", "/"]), max_size=30).map("".join))
def test_broken_markup_never_fails(page):
    html_text.main_text(page)


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<form><p>{ARTICLE}</p></form>", ARTICLE),
        (f"<div class='side-by-side'><p>{ARTICLE}</p></div>", ARTICLE),
        (f"<div class='search-results'><p>{ARTICLE}</p></div>", ARTICLE),
        (f"<article><p>{ARTICLE}</p><section id=discussion><p>We discuss. {ARTICLE}</p></section></article>", f"{ARTICLE} We discuss. {ARTICLE}"),
        (f"<form id=aspnet><nav>n</nav><div class=promo><main><p>{ARTICLE}</p></main></div></form>", ARTICLE),
        (f"<div id=c><p>{ARTICLE}</p><p>b</p><div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><p>See <a href=4>this</a>.</p></div>", f"{ARTICLE} b See this."),
        ("<p>" + "<b>" * 20_000 + "deep", "deep"),
    ],
)
def test_marks_that_hold_the_article_are_void(page, text):
    assert html_text.main_text(page) == text


def slow_path_scores(nodes):
    """The definition, node by node: what path_scores() does with sums and kernels."""
    out = []
    weight = {d: np.exp(-(d * d) / (2 * html_text.SIGMA**2)) for d in (-2, -1, 0, 1, 2)}

    def ratio(i, what):
        same = [(e, t) for e, t in nodes if e.path == nodes[i][0].path]
        return sum(what(t) for e, t in same if not e.link and not e.never) / len(same)

    for i, (e, _) in enumerate(nodes):
        near = [(w, i + d) for d, w in weight.items() if 0 <= i + d < len(nodes)]
        length, marks = (sum(w * ratio(j, what) for w, j in near) / sum(w for w, _ in near) for what in (len, lambda t: len(html_text.PUNCTUATION.findall(t))))
        out.append(0.0 if e.never or e.link else length * (1 + marks))
    return out


LAYOUTS = [
    "<nav><ul>{nav}</ul></nav><article><h1>{title}</h1>{body}</article><footer>{foot}</footer>",
    "<div id=nav>{nav}</div><div class=content><h1>{title}</h1>{body}</div><div class=sidebar><p>{ad}</p></div><div id=footer><p>{foot}</p></div>",
    "<table><tr><td>{links}</td><td><h1>{title}</h1>{body}</td></tr></table>",
    "<main><h1>{title}</h1>{body}<div class=comments><p>{ad}</p><p>{foot}</p></div></main><aside>{ad}</aside>",
    "<form><div class=menu>{nav}</div><div><h1>{title}</h1>{body}</div><div class='ad-slot'>{ad}</div></form>",
    "<div class=wrapper><div class='cookie-notice'><p>{ad}</p></div><section><h2>{title}</h2>{body}<div>{links}</div></section></div>",
]


def layouts(seed):
    """(page, its article's text) in several layouts, some without any mark of the article."""
    rng = random.Random(seed)
    words = lambda n: " ".join(rng.choice(("lorem", "ipsum", "dolor,", "sit", "amet.", "&amp;", "a")) for _ in range(n))
    link = lambda: f"<a href=x>{words(2)}</a>"
    title, parts = words(4), [words(rng.randint(1, 60)) for _ in range(rng.randint(3, 14))] + [words(50)]
    body = "".join(f"<p>{p}</p>" if rng.random() < 0.8 else f"<ul><li>{p}</li></ul>" for p in parts)
    filled = {"nav": "".join(f"<li>{link()}</li>" for _ in range(5)), "links": " ".join(link() for _ in range(6)), "title": title, "body": body, "ad": words(12), "foot": "&copy; " + words(8)}
    return [(x.format(**filled), " ".join([title, *parts]).replace("&amp;", "&")) for x in LAYOUTS]


def test_precision_and_recall_over_labelled_layouts():
    right = kept = wanted = 0
    for seed in range(100):
        for page, text in layouts(seed):
            a, b = Counter(html_text.main_text(page).split()), Counter(text.split())
            right, kept, wanted = right + (a & b).total(), kept + a.total(), wanted + b.total()
    print(f"precision {right / kept:.4f}, recall {right / wanted:.4f}")
    assert right / kept > 0.99 and right / wanted > 0.99


def test_path_scores_follow_the_definition_and_select(spark, sf_dir, monkeypatch):
    """All pages of the table: the article between its tags, read by a pattern; scores as defined; and without the paths' threshold results differ."""
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    for page in pages:
        inner = re.search("<article>(.*?)</article>", page, re.S)[1]
        assert html_text.main_text(page) == " ".join(html_text.html.unescape(re.sub("<[^>]*>", " ", inner.replace("<b>", ""))).split())
    for page in [*pages[:10], *(p for p, _ in layouts(1))]:
        read, every = html_text.text_nodes(page)
        nodes = [(e, t) for e, t in read if t and t.strip()]
        html_text.judge(nodes, every)
        assert html_text.path_scores(nodes) == pytest.approx(slow_path_scores(nodes))
    before = [html_text.main_text(p) for p, _ in layouts(1)]
    monkeypatch.setattr(html_text, "content_paths", lambda nodes, scores: {e.path for e, _ in nodes})
    assert [html_text.main_text(p) for p, _ in layouts(1)] != before


# pieces


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.PieceModel(PIECES)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 30))
def test_scan_encodes_as_the_library(model, text, chunk):
    assert sentence_pieces.encode_by_chunks(text, model, chunk) == model.library.encode(text)


def test_matrices_combine_associatively(model):
    rng = random.Random(1)
    whole = sentence_pieces.marked("".join(rng.choices(ODD, k=40)))
    parts = [(a, min(a + 9, len(whole))) for a in range(0, len(whole), 9)]
    made = []
    for a, b in parts:
        left, body = sentence_pieces.frame(whole, a, b)
        made.append(sentence_pieces._moved(sentence_pieces.transfer(model, body, a - left, b - left), left))
    left = right = None
    for m in made:
        left = m if left is None else sentence_pieces.combine(left, m)
    for m in reversed(made):
        right = m if right is None else sentence_pieces.combine(m, right)
    assert left == right and len(left) == 1


SPACED = [*ODD, "     ", "in", "tion", "x" * 100, " " * 70]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(SPACED), max_size=40).map("".join), st.sampled_from((1, 3, 9, 64, 150)), st.integers(2, 5))
def test_trees_of_any_shape_encode_as_the_library(model, text, chunk, fan):
    assert sentence_pieces.encode_by_chunks(text, model, chunk, fan) == model.library.encode(text)


@pytest.mark.parametrize("text", ["xyz" * 20_000, "".join(random.Random(3).choices("abcdefgh", k=60_001)), " " * 60_000 + "abc", "ab  " * 15_000, "  " + "etaoin" * 10_000], ids=["repeats", "random", "spaces", "pairs", "run"])
def test_frames_stay_small_whatever_the_text(model, text):
    """Texts without spaces, or of nothing else: what chunks see adds up to little more than the text, and ids are the library's."""
    whole = sentence_pieces.marked(text)
    spans = sentence_pieces.cuts(whole, 4096)
    assert spans[0][0] == 0 and spans[-1][1] == len(whole) and all(b == c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert sum(len(sentence_pieces.frame(whole, a, b)[1]) for a, b in spans) <= len(whole) + 2 * sentence_pieces.REACH * len(spans)
    assert sentence_pieces.encode_by_chunks(text, model, 4096, 4) == model.library.encode(text)


def test_encode_decode_and_digests(spark, docs, model):
    encoded = sentence_pieces.encode(docs, PIECES, giant=3000, chunk=500)
    found = sorted(map(tuple, sentence_pieces.digests(docs, PIECES, giant=3000, chunk=500).collect()), key=repr)
    want = []
    for r in docs.collect():
        ids = model.library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sum((i + 1) * x for i, x in enumerate(ids)) % (2**61 - 1), len(r.text or "")))
    assert found == sorted(want, key=repr)
    parts: dict = {}
    for n, r in enumerate(sentence_pieces.decode(encoded, PIECES).collect()):
        parts.setdefault((r.rid, n if r.rid < 0 else 0), []).append((r.k, r.text))
    whole = sorted(("".join(t for _, t in sorted(v)) for v in parts.values()))
    texts = [r.text or "" for r in docs.collect()]
    assert sorted(whole) == sorted(texts)
    assert sentence_pieces.encode(docs.limit(0), PIECES).count() == 0


# packing


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=12))
def test_plan_packs_everything_once(histogram):
    plan = packing.minimum_bin_slack(histogram, 60)
    used = Counter()
    for times, bins in plan:
        assert times > 0 and sum(k * n for k, n in bins) <= 60
        for k, n in bins:
            used[k] += times * n
    assert used == Counter(histogram)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9), st.integers(0, 60))
def test_fullest_is_a_best_subset(items, room):
    left = Counter(items)
    used = packing.fullest(sorted(left), left, room)
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums}
    assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
    assert all(n <= left[k] for k, n in used.items())


def test_packing(spark, docs):
    library = load_tokenizer(WORDS)
    pieces = [r.asDict() for r in packing.packed_digests(docs, WORDS, capacity=64).collect()]
    want = []
    for r in docs.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(r.doc_id, k, k * 64, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(ids[i : i + 64] for i in range(0, len(ids), 64))]
    assert sorted(((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces), key=repr) == sorted(want, key=repr)
    places: dict = {}
    for p in pieces:
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    room: list[int] = []  # first fit decreasing
    for p in sorted((p["length"] for p in pieces), reverse=True):
        k = next((k for k, r in enumerate(room) if r >= p), None)
        if k is None:
            room.append(64 - p)
        else:
            room[k] -= p
    assert len(places) <= len(room)
    whole = packing.sequences(packing.packed_documents(docs, WORDS, capacity=64)).collect()
    assert sum(r.length for r in whole) == sum(len(r.ids) // 4 for r in whole) == sum(p["length"] for p in pieces)
    assert packing.packed_digests(docs.limit(0), WORDS).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeéß'sstre l\t\n\x0b\x85\xa0\x1c1²½.,*<|ÀÖ×÷ÿµªº\xadÄéΣςİŉΑ日​", max_size=40))
def test_words_encode_as_the_whole(text):
    words = packing.WordIds(WORDS)
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


UNITS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\t-\\r \\x85\\xa00-9²³¹¼½¾a-zªµºß-öø-ÿ]+")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("'strevlmd a1!\n"), st.characters(max_codepoint=255)), max_size=30))
def test_units_are_the_patterns(text):
    data = np.frombuffer(text.encode("latin-1").translate(packing.LOWER) + packing.TAIL, np.uint8)
    first, inside = packing.unit_starts(data)
    starts = np.flatnonzero(first).tolist()
    found = [data[a:b][inside[a:b]].tobytes().decode("latin-1") for a, b in zip(starts, [*starts[1:], len(data)])]
    assert found == UNITS.findall(text.lower())


@settings(max_examples=150, deadline=None)
@given(st.lists(texts | st.text(max_size=20) | st.text(alphabet=st.characters(max_codepoint=255), max_size=40), max_size=6))
def test_many_texts_encode_as_each(many):
    words = packing.WordIds(WORDS)
    want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in many]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(many)] == want


def test_units_of_a_batch_go_to_the_model_once(monkeypatch):
    words, asked = packing.WordIds(WORDS), []
    library, model = words.tokenizer, words.tokenizer.model

    class Watched:
        def tokenize(self, unit):
            asked.append(unit)
            return model.tokenize(unit)

    words.tokenizer, words.model = None, Watched()  # neither a text nor a unit is encoded in another way
    monkeypatch.setattr(packing, "CACHED_UNITS", 3)  # the next batch begins another generation
    for many in (["The cat's hat, the été.", "", " \n"], ["THE CAT'S", "dog"], []):
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(many)] == [library.encode(t, add_special_tokens=False).ids for t in many]
    assert max(Counter(asked).values()) == 1 and len(asked) == 8


def test_texts_are_encoded_some_at_a_time(spark, docs, monkeypatch):
    def pieces():
        return sorted(map(tuple, packing.pieces(docs, WORDS, 64).collect()), key=repr)

    whole = pieces()
    monkeypatch.setattr(packing, "TEXT_BYTES", 100)
    assert pieces() == whole


# rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols, dup = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines))
    base = n < 50 or 100 * len(covered) > 50 * n
    stop = sum(w.lower() in quality_rules.STOP_WORDS for w in words)
    kept = not base and 2 * n <= chars <= 15 * n and 100 * symbols <= 30 * n and 100 * dup <= 60 * len(lines) and 1000 * stop >= 20 * n
    return n, chars, symbols, dup, len(covered), base, kept


def test_rules(spark, docs):
    rng = random.Random(7)
    more = [(100 + i, "".join(rng.choices(["the ", "cat ", "sat\n", "on #", "of\t", "x y z ", "\n", " ", "and ", "*** ", "dog "], k=rng.randint(0, 200)))) for i in range(60)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    found = sorted(map(tuple, quality_rules.measured(rows).collect()), key=repr)
    assert found == sorted(((r.doc_id, *brute(r.text)) for r in rows.collect()), key=repr)
    kept = quality_rules.accepted(rows.withColumn("m", F.lit(1)))
    assert kept.count() == sum(x[-1] for x in found) > 0 and kept.columns == ["doc_id", "text", "m"]
    assert quality_rules.measured(rows.limit(0)).count() == 0


def test_rules_run_without_python(spark, docs):
    plan = quality_rules.measured(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
