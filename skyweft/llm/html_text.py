"""Main text of web pages by tag-path ratios.

A page is read once into text nodes, each with its root-to-leaf tag path (tag names with their class and id words, roles and hiding). For each path
the text length and the punctuation of its nodes are aggregated; both ratios (per node) are smoothed along the page with a Gaussian and fused
into one score by their product. A path that lies in an element that is never part of an article (menus, headers, footers, sidebars, notices, adverts,
forms, reader comments, by tag, role, or class and id words) has no score, nor has one inside a link. Paths that reach a share of the standard deviation
of all scores are content paths, and their nodes are content.

Short paragraphs, headings and links of an article score little, so the content nodes also name its block: the innermost element that has all of them (a
list, quote or table stands in the element around it), with the paragraphs and headings that stand beside it, or the article and main elements if
nearly all of their text lies there. In the block, nodes of weaker paths are content too, unless the path has no score for the reasons above, or is
a menu without a name: mostly links, repeated, and outside of paragraphs, lists and tables.

A mark on an element that holds the article is void: a form with most of the page's text in it, a named element around article or main, and any named
element where nothing at all would be left otherwise.

White space inside a block becomes one space, blocks are joined by one space. Character references are decoded as browsers do.

Defined results: a null or empty page, or one without article text, gives "" and 0; rows are independent, so ties and repeated rows get
equal texts; broken markup never fails, however deep (unclosed elements end with their parents, stray ends are ignored). An empty table gives an empty
result. Only the id, url and html columns are read, so other columns can't clash.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their roles in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("head nav aside button select option input label fieldset footer menu dialog svg math canvas audio video object embed applet map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
#: Words of class and id names (split at -, _ and case) of what surrounds an article.
AROUND = frozenset("""
    ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit adcontainer adsbygoogle sponsor sponsored sponsors promo promos promotion promoted banner banners
    nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc skip topbar toolbar
    sidebar sidebars aside widget widgets related recommended recommendations trending
    cookie cookies consent gdpr notice notices alert popup popups modal overlay newsletter subscribe subscription signup paywall
    comment comments commentlist disqus reply replies respond responses
    share sharing social follow footer masthead header copyright login searchbox searchform searchbar
""".split())  # fmt: skip
#: Those that may also name parts of an article inside one, and words that make a name one of the page's layout ("with-sidebar").
OWN = frozenset("header masthead".split())
LAYOUT = frozenset("with without has no".split())
#: Elements that hold a part of an article, never a whole one, and those that belong to it where they stand beside it.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption tbody thead tfoot tr td th figure figcaption br hr".split())
BESIDE = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: What an end tag or a start tag may close without saying so: tag -> (closed by its start, not looked for beyond).
CLOSES = {
    "p": (frozenset({"p"}), frozenset("body article section div td th li blockquote main aside table button".split())),
    "li": (frozenset({"li"}), frozenset("ul ol menu".split())),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset("tr table".split())),
    "th": (frozenset({"td", "th"}), frozenset("tr table".split())),
    "option": (frozenset({"option"}), frozenset("select datalist optgroup".split())),
}
CLOSING_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "li", "caption", "tbody", "thead", "tfoot", "dd", "dt"}
MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|(?<==)\"[^\"]*+\"|(?<==)'[^']*+'|\"|')*+)>|<[!?/][^>]*>?|<[A-Za-z][^>]*\Z",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？«»\"'()-]")
SIGMA, SHARE, MOST = 1.0, 0.5, 0.8
#: Share of the page's text from which a form isn't one, and what makes a path a menu: its share of links, and nodes.
WRAPS, LINKS, REPEATS = 0.5, 0.8, 3
#: Marks of elements: part of an article, void if it holds one, never part of one.
FREE, NAMED, OUTSIDE = 0, 1, 2


class Element:
    __slots__ = ("tag", "path", "parent", "mark", "never", "article", "link", "inside")

    def __init__(self, tag: str, parent: Element | None, paths: dict, names: tuple[str, ...] = (), hidden: bool = False, role: str = ""):
        self.tag, self.parent = tag, parent
        self.path = paths.setdefault((parent.path if parent else -1, tag, names, hidden, role), len(paths))
        self.article = bool(parent and parent.article) or tag in ("article", "main") or role in ("main", "article")
        around = not any(n in LAYOUT for n in names) and any(n in AROUND and not (self.article and n in OWN) for n in names)
        self.mark = FREE
        if tag in NEVER or hidden:
            self.mark = OUTSIDE
        elif tag not in ("body", "html", "main") and (around or tag == "form" or tag == "header" and not self.article):
            self.mark = NAMED
        self.never = False
        self.link = bool(parent and parent.link) or tag == "a"
        #: whether it stands in a paragraph, heading, list or table of its block
        self.inside = tag in PARTS or bool(parent and parent.inside and tag not in BLOCKS)


def _attributes(rest: str) -> tuple[tuple[str, ...], bool, str]:
    """(class and id words, whether it is hidden or has a role outside of articles, its role)"""
    if "=" not in rest and "hidden" not in rest.lower():
        return (), False, ""
    words: list[str] = []
    hidden, role = bool(NOT_SHOWN.search(rest)), ""
    for name, value in NAMES.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            role = value.lower()
            hidden = hidden or role in ROLES
        elif name == "hidden":
            hidden = hidden or not value or value.lower() in ("hidden", "until-found")
        else:
            words += [w.lower() for w in WORDS.findall(value)]
    return tuple(words), hidden, role


def text_nodes(page: str) -> tuple[list[tuple[Element, str | None]], list[Element]]:
    """The page's (element, text) in order, a text of None marks the edge of a block; and its elements, parents before children."""
    paths: dict[tuple, int] = {}
    root = Element("html", None, paths)
    stack, out, every, at = [root], [], [root], 0
    open_ = {"html": 1}  # how many elements of a tag are open
    folded = page.lower() if "<" in page else page
    if len(folded) != len(page):  # a few letters change their length
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), page)

    def cut(i: int) -> None:
        for e in stack[i:]:
            open_[e.tag] -= 1
        del stack[i:]

    def push(e: Element) -> None:
        stack.append(e)
        every.append(e)
        open_[e.tag] = open_.get(e.tag, 0) + 1

    while m := MARKUP.search(page, at):
        if m.start() > at:
            out.append((stack[-1], page[at : m.start()]))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if open_.get(tag) and tag != "html":
                cut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            if tag in BLOCKS:
                out.append((stack[-1], None))
            continue
        if tag in RAW:
            end = folded.find(f"</{tag}", at)
            close = page.find(">", end) if end >= 0 else -1
            at = close + 1 if close >= 0 else len(page)
            continue
        if tag in ("html", "body"):
            if tag == "body" and not open_.get("body"):
                cut(1)
                push(Element("body", root, paths))
            continue
        if tag in BLOCKS:
            out.append((stack[-1], None))
        for closed, limit in (CLOSES.get(tag, _NOTHING), CLOSES["p"] if tag in CLOSING_P else _NOTHING):
            if any(open_.get(t) for t in closed):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in closed:
                        cut(i)
                        break
                    if stack[i].tag in limit:
                        break
        if tag in VOID:
            continue
        if not m["rest"].endswith("/") or tag not in ("svg", "path"):
            push(Element(tag, stack[-1], paths, *_attributes(m["rest"])))
    if at < len(page):
        out.append((stack[-1], page[at:]))
    return out, every


_NOTHING: tuple[frozenset[str], frozenset[str]] = (frozenset(), frozenset())


def judge(nodes: list[tuple[Element, str]], every: list[Element]) -> None:
    """Sets never: whether an element, or one around it, is marked and the mark isn't void."""
    size = dict.fromkeys(every, 0)
    for e, text in nodes:
        size[e] += len(text)
    holds: set[Element] = set()  # elements around an article or main that has no mark of its own
    for e in reversed(every):
        if e.parent is not None:
            size[e.parent] += 0 if e.mark == OUTSIDE else size[e]
            if e in holds or e.tag in ("article", "main") and e.mark == FREE:
                holds.add(e.parent)
    void = {e for e in every if e.mark == NAMED and (e in holds or e.tag == "form" and size[e] >= WRAPS * size[every[0]])}
    while True:
        for e in every:
            e.never = bool(e.parent and e.parent.never) or e.mark == OUTSIDE or e.mark == NAMED and e not in void
        if any(not e.never and not e.link for e, _ in nodes):
            return
        named = [e for e in every if e.mark == NAMED and e not in void and not (e.parent and e.parent.never) and size[e]]
        if not named:
            return
        void.add(max(named, key=size.get))


def path_scores(nodes: list[tuple[Element, str]]) -> list[float]:
    """A score for each text node: its path's smoothed text and punctuation per node, fused; 0 in links and in what is never part of an article."""
    sums: dict[int, list[float]] = {}
    for e, text in nodes:
        s = sums.setdefault(e.path, [0, 0, 0])
        s[0] += 1
        if not e.link and not e.never:
            s[1] += len(text)
            s[2] += len(PUNCTUATION.findall(text))
    reach = max(1, math.ceil(2 * SIGMA))
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-reach, reach + 1)]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            part = [(k, values[i + d]) for k, d in zip(kernel, range(-reach, reach + 1)) if 0 <= i + d < len(values)]
            out.append(sum(k * v for k, v in part) / sum(k for k, _ in part))
        return out

    lengths = smooth([sums[e.path][1] / sums[e.path][0] for e, _ in nodes])
    marks = smooth([sums[e.path][2] / sums[e.path][0] for e, _ in nodes])
    return [0.0 if e.never or e.link else x * (1 + y) for (e, _), x, y in zip(nodes, lengths, marks)]


def content_paths(nodes: list[tuple[Element, str]], scores: list[float]) -> set[int]:
    """The paths whose mean score reaches SHARE of the standard deviation of all nodes' scores (at least one, if any has a score)."""
    if not any(scores):
        return set()
    mean = sum(scores) / len(scores)
    deviation = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    by_path: dict[int, list[float]] = {}
    for (e, _), s in zip(nodes, scores):
        by_path.setdefault(e.path, []).append(s)
    means = {p: sum(v) / len(v) for p, v in by_path.items()}
    return {p for p, v in means.items() if v > 0 and v >= min(SHARE * deviation, max(means.values()))}


def menu_paths(nodes: list[tuple[Element, str]], chosen: set[int]) -> set[int]:
    """Paths of repeated links without a name: their text lies in links nearly all, and not in paragraphs, lists or tables."""
    sums: dict[int, list[int]] = {}
    for e, text in nodes:
        around = e
        while around.link and around.parent is not None and around.tag not in BLOCKS:
            around = around.parent
        s = sums.setdefault(around.path, [0, 0, 0])
        s[0] += len(text.strip())
        if e.link and not around.inside:
            s[1] += len(text.strip())
            s[2] += 1
    found = {p for p, (size, links, n) in sums.items() if p not in chosen and n >= REPEATS and links >= LINKS * size}
    return found


def article_blocks(nodes: list[tuple[Element, str]], every: list[Element], scores: list[float], chosen: set[int]) -> set[Element]:
    """The elements that hold the article."""
    votes, holds = dict.fromkeys(every, 0.0), dict.fromkeys(every, 0)
    for (e, text), s in zip(nodes, scores):
        if s and e.path in chosen:
            votes[e] += len(text)
            holds[e] += 1
    depth = {}
    for e in reversed(every):
        if e.parent is not None:
            votes[e.parent] += votes[e]
            holds[e.parent] += holds[e]
    for e in every:
        depth[e] = depth[e.parent] + 1 if e.parent is not None else 0
    total, number = votes[every[0]], holds[every[0]]
    if not number:
        return set()
    outer = {e for e in every if e.article and not (e.parent and e.parent.article) and holds[e]}
    if outer and sum(votes[e] for e in outer) >= MOST * total:
        return outer
    block = max((e for e in every if holds[e] == number), key=depth.get)
    while block.parent is not None and (block.tag not in BLOCKS or block.tag in PARTS):
        block = block.parent
    above, around = block, {block}
    while above.parent is not None:
        above = above.parent
        around.add(above)
    return {block, *(e for e in every if e.tag in BESIDE and e.parent in around)}


def main_text(page: str) -> str:
    """The text of the page's article."""
    read, every = text_nodes(page)
    found = [(e, t if t is None else html.unescape(t)) for e, t in read]
    nodes = [(e, t) for e, t in found if t is not None and t.strip()]
    judge(nodes, every)
    scores = path_scores(nodes)
    chosen = content_paths(nodes, scores)
    blocks = article_blocks(nodes, every, scores, chosen)
    menus = menu_paths(nodes, chosen)
    kept: dict[Element, bool] = {}
    inside: dict[Element, bool] = {}
    menu: dict[Element, bool] = {}
    for e in every:
        inside[e] = e in blocks or e.parent is not None and inside[e.parent]
        menu[e] = e.path in menus or e.parent is not None and e.link and menu[e.parent]
        kept[e] = inside[e] and (e.path in chosen or not e.never and not menu[e])
    return " ".join("".join(" " if t is None else t for e, t in found if t is None or kept[e]).split())


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of pages."""
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                texts = [main_text(x.as_py()) for x in b.column(2)]
                yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = named.schema
    return named.mapInArrow(run, f"page_id {kinds['page_id'].dataType.simpleString()}, url {kinds['url'].dataType.simpleString()}, text string, n_chars bigint")
