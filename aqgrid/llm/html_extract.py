"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into blocks: runs of text between block-level tags, each with the tags and the class and id names of its open
ancestors. A chain over the blocks of a page labels each as content or boilerplate; features are ancestor tags and name
parts, the block's own tag, its size, link density, punctuation, its place, the sizes and links of its neighbours, the share
of the page's text in its container and its distance from the title. Weights are trained here by gradient ascent on the
likelihood of labelled pages (forward-backward), and pages are decoded by Viterbi.

The labelled pages are generated by rule, in many layouts and from invented words, so that labels are exact: articles in
``article``, ``main``, named or nameless ``div`` containers, with menus, banners, adverts, forms, related links, teasers,
reader comments and footers around and between their paragraphs, with and without telling names. Training takes a few
seconds on the driver and depends on no input; the weights (a few hundred numbers) travel with the task.

Names tell nothing where they stand on the page itself, or on an element that holds most of its text and the start of its
article (``has-sidebar``, ``comments-open``, a form around all): what such an element is called says what else is in it.

Open elements hand down what they add to their ancestors' sets, so the work for a page is in proportion to its length
however deep or broken its markup is.

Text inside ``script``, ``style``, ``svg`` and the like, comments and declarations is never a block; that of ``math`` stays.
Where no end tag follows, ``script``, ``style``, ``textarea`` and ``title`` run to the page's end, others are skipped alone. Character references are
decoded, white space inside a block becomes one space, blocks are trimmed, empty ones dropped and the rest joined by a
newline. Unclosed and stray tags are tolerated as browsers do: a paragraph ends at the next block-level tag.

Nulls: a null html is empty, its text is empty; null ids and urls are passed on. Repeated rows each get their row. Extra
columns are not read. A page of any length is read whole, in one pass; an empty table gives no rows.
"""

from __future__ import annotations

import html as _html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from aqgrid.llm.common import chunks

# Tags of the HTML standard by their role.
RAW = frozenset("script style template noscript textarea title iframe noembed noframes xmp select option datalist object canvas audio video".split())
TO_THE_END = frozenset("script style textarea title".split())
MATH = frozenset("math maction maligngroup menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr ruby rt rp img".split()) | MATH
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("body div section article main aside td form ol ul header footer nav".split())
_TABLE = frozenset("table tr tbody thead tfoot body html".split())
_ANCESTORS = CLOSES_P | _BOXES | frozenset("button center dd dialog dt figcaption li summary tbody td th tr".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|(?=<)|\Z)", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

# Parts of class and id names that mark what is not the article.
_BAD_NAMES = frozenset(
    "nav navbar menu header masthead banner footer copyright legal sidebar side aside widget ad ads adv advert advertisement promo sponsor sponsored cookie consent "
    "notice alert popup modal overlay newsletter subscribe signup form login search share sharing social related recommended breadcrumb breadcrumbs pager pagination "
    "comment comments disqus reply respond reader tags meta byline toolbar skip".split()
)
_GOOD_NAMES = frozenset("article content post entry story body main text page prose".split())
#: A name that ends so is a part of the article, whatever stands before: a quote to share, a caption of an advert.
_CONTENT_HEADS = frozenset("quote blockquote pullquote caption lead intro abstract figure".split())
#: An element that holds this share of the page's text and the start of its article is around the article, not beside it; of
#: one without a title, article or main element in it, the greater share is asked for.
AROUND, AROUND_UNMARKED = 0.5, 0.8
_BAD_TAGS = frozenset("nav header footer aside button menu dialog fieldset".split())

_TELLING = _BAD_NAMES | _GOOD_NAMES | {"hidden!"}
_NONE: frozenset[str] = frozenset()


class Block(NamedTuple):
    """A run of text between block-level tags."""

    text: str
    tags: frozenset[str]  # of its ancestors
    names: frozenset[str]  # telling parts of their class and id names, but for elements around the article
    links: int  # characters in links
    breaks: int
    own: str  # the innermost block-level tag
    box: int  # numbers of the nearest container, the one around it, and the nearest article
    outer: int
    article: int
    named: Named | None = None  # the innermost named element around it


class Named:
    """An element with telling names, the next one around it, the text in it, and whether it holds the start of the article."""

    __slots__ = ("all_names", "marked", "names", "outer", "page", "size")

    def __init__(self, names: frozenset[str], outer: Named | None, page: bool):
        self.names, self.outer, self.page = names, outer, page
        self.size, self.marked, self.all_names = 0, False, None


class Open(NamedTuple):
    """An open element: its tag, what holds for all that it contains, and the numbers of its containers."""

    tag: str
    tags: frozenset[str]
    named: Named | None
    box: int
    outer: int
    article: int


_ROOT = Open("none", _NONE, None, 0, 0, 0)


def _end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


def _is_empty(attributes: str) -> bool:
    """A slash ends the tag, and is not part of a value without quotes."""
    if not attributes.endswith("/"):
        return False
    cut = max(attributes.rfind(c) for c in " \t\n\r\f\"'")
    return "=" not in attributes[cut + 1 :] and not (attributes[cut : cut + 1].isspace() and attributes[:cut].rstrip().endswith("="))


def _svg_ends(page: str, at: int) -> dict[int, int]:
    """Where each svg element that is closed ends, by the end of its start tag; an end tag closes the last one open."""
    out: dict[int, int] = {}
    still: list[int] = []
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if tag == "svg" and m[1]:
            if still:
                out[still.pop()] = at
        elif tag == "svg" and not _is_empty(m[3]):
            still.append(at)
        elif tag in ("script", "style") and not m[1] and not _is_empty(m[3]):
            end = _end_tag(tag).search(page, at)
            at = end.end() if end else at
    return out


class _Stack:
    """The open elements of a page. Inline ones are kept aside by tag, as only their telling names matter."""

    def __init__(self) -> None:
        self.open: list[Open] = []
        self.scopes: list[Counter] = [Counter()]  # open block-level tags, anew within each table and cell
        self.count: Counter = Counter()
        self.inline: dict[str, list[frozenset]] = {}
        self.inline_names: Counter = Counter()
        self.boxes = 0
        self.marks: set[str] = set()  # tags that start an article and have been seen
        self.seen_named: list[Named] = []

    def top(self) -> Open:
        return self.open[-1] if self.open else _ROOT

    def inline_now(self) -> frozenset[str]:
        return frozenset(k for k, n in self.inline_names.items() if n > 0) if self.inline_names else _NONE

    def push(self, tag: str, names: frozenset[str]) -> None:
        up = self.top()
        box, outer, article = up.box, up.outer, up.article
        if tag in _BOXES:
            self.boxes += 1
            box, outer = self.boxes, up.box
            article = self.boxes if tag == "article" else article
        if tag == "form":  # counts as a name, as some pages are one form
            names |= {"form"}
        tags = up.tags if tag in up.tags or tag not in _ANCESTORS or tag == "form" else up.tags | {tag}
        named = up.named
        if names:
            named = Named(names, up.named, tag in ("html", "body"))
            self.seen_named.append(named)
        if tag in ("h1", "article", "main") and tag not in self.marks:  # the first of its kind
            self.marks.add(tag)
            around = named
            while around is not None and not around.marked:
                around.marked, around = True, around.outer
        self.open.append(Open(tag, tags, named, box, outer, article))
        if tag in ("table", "td", "th"):
            self.scopes.append(Counter())
        self.scopes[-1][tag] += 1
        self.count[tag] += 1

    def pop(self) -> None:
        tag = self.open.pop().tag
        self.scopes[-1][tag] -= 1
        self.count[tag] -= 1
        if tag in ("table", "td", "th"):
            self.scopes.pop()

    def closes(self, tag: str) -> bool:
        """Whether an end tag has an open element; tables and cells keep what is around them open."""
        open_here = self.count if tag in _TABLE else self.scopes[-1]
        return any(open_here[t] > 0 for t in (_HEADINGS if tag in _HEADINGS else (tag,)))

    def close(self, tag: str) -> None:
        same = _HEADINGS if tag in _HEADINGS else (tag,)
        while self.open[-1].tag not in same:
            self.pop()
        self.pop()

    def put_inline(self, tag: str, names: frozenset[str]) -> None:
        self.inline.setdefault(tag, []).append(names)
        self.inline_names.update(names)

    def end_inline(self, tag: str) -> None:
        if self.inline.get(tag):
            self.inline_names.subtract(self.inline[tag].pop())

    def clear_inline(self) -> None:
        if self.inline:
            self.inline.clear()
            self.inline_names.clear()


def _names(attributes: str) -> frozenset[str]:
    """Telling parts of the class, id and role of a tag, and whether it is hidden."""
    if "=" not in attributes and "hidden" not in attributes:
        return _NONE
    parts: set[str] = set()
    for a in _ATTR.finditer(attributes):
        value = (a[2] or a[3] or a[4] or "").lower()
        kind = a[1].lower()
        if kind in ("class", "id", "role"):
            for name in value.split():
                found = _NAME.findall(name)
                parts.update(found if not found or found[-1] not in _CONTENT_HEADS else set(found) - _BAD_NAMES)
        elif kind == "hidden" or (kind == "aria-hidden" and value == "true") or (kind == "style" and "display:none" in value.replace(" ", "")):
            parts.add("hidden!")
    return frozenset(parts & _TELLING)


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order."""
    if not page:
        return []
    out: list[Block] = []
    stack = _Stack()
    text: list[str] = []
    links = breaks = in_link = 0
    at, n = 0, len(page)
    endless: set[str] = set()  # tags with no end tag in the rest of the page
    svg_ends: dict[int, int] | None = None

    def flush() -> None:
        nonlocal links, breaks
        if text:
            t = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
            if t:
                e = stack.top()
                links_in = min(links, len(t))
                out.append(Block(t, e.tags, stack.inline_now(), links_in, breaks, e.tag, e.box, e.outer, e.article, e.named))
                if e.named is not None:
                    e.named.size += len(t) - links_in
            text.clear()
        links = breaks = 0

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if in_link:
                links += len(piece)
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            if tag in INLINE:
                stack.end_inline(tag)
            elif stack.closes(tag):
                flush()
                stack.clear_inline()
                stack.close(tag)
            elif tag == "p":  # an end tag without a paragraph makes an empty one
                flush()
            continue
        if tag in RAW:
            end = None if tag in endless else _end_tag(tag).search(page, at)
            if end is None:
                endless.add(tag)
            at = end.end() if end else n if tag in TO_THE_END else at
            continue
        if tag == "svg":
            if not _is_empty(m[3]):
                svg_ends = _svg_ends(page, m.start()) if svg_ends is None else svg_ends
                at = svg_ends.get(at, at)
            continue
        if tag == "br":
            text.append(" ")
            breaks += 1
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                text.append(" " if tag == "img" else "")
            continue
        names, empty = _names(m[3]), m[3].rstrip().endswith("/")
        if tag in INLINE:
            if tag == "a":
                in_link = 1
            if names and not empty:
                stack.put_inline(tag, names)
            continue
        flush()
        in_link = 0
        stack.clear_inline()
        if tag in CLOSES_P and any(x.tag == "p" for x in stack.open[-3:]):
            stack.close("p")
        elif tag in _CLOSED_BY and stack.top().tag in _CLOSED_BY[tag]:
            stack.pop()
        if not empty:
            stack.push(tag, names)
    flush()
    return _with_names(out, stack.seen_named)


def _with_names(page: list[Block], named: list[Named]) -> list[Block]:
    """Blocks with the names of what is around them. Those of the page, and of elements that hold most of its text and the
    start of its article, tell nothing about a block; one pass up and one down the named elements, in their order."""
    if not named:
        return [b._replace(named=None) for b in page]
    total = sum(len(b.text) - b.links for b in page) or 1
    for e in reversed(named):  # what lies in an element also lies in those around it
        if e.outer is not None:
            e.outer.size += e.size
    for e in named:
        share = e.size / total
        around = e.page or (share >= AROUND if e.marked else share >= AROUND_UNMARKED)
        mine = e.names - _BAD_NAMES - {"hidden!"} if around else e.names
        above = e.outer.all_names if e.outer is not None else _NONE
        e.all_names = above if mine <= above else above | mine
    return [b._replace(names=b.names | b.named.all_names if b.named is not None else b.names, named=None) for b in page]


def _bucket(share: float) -> str:
    return "most" if share >= 0.6 else "much" if share >= 0.3 else "some" if share >= 0.1 else "little"


def _shape(b: Block) -> str:
    density = b.links / len(b.text)
    return ("all" if density >= 0.8 else "half" if density >= 0.3 else "few") + str(min(len(b.text) // 40, 3))


def features(page: list[Block]) -> list[list[str]]:
    """Names of the binary features of each block."""
    out, n = [], len(page)
    seen_article = any("article" in b.tags for b in page)
    seen_main = any("main" in b.tags for b in page)
    size, linked, number, articles = Counter(), Counter(), Counter(), Counter()
    for b in page:
        plain = len(b.text) - b.links
        for box in {b.box, -1 - b.outer}:  # containers by their own text, and by that of the containers in them
            size[box] += plain
            linked[box] += b.links
            number[box] += 1
        articles[b.article] += plain
    total = sum(len(b.text) - b.links for b in page) or 1
    top_box, top_outer = (max((v for k, v in size.items() if (k >= 0) == own), default=0) for own in (True, False))
    top_article = max((v for k, v in articles.items() if k), default=0)
    title = next((k for k, b in enumerate(page) if b.own == "h1"), None)
    shapes = [_shape(b) for b in page]
    for k, b in enumerate(page):
        t, names = b.text, b.names
        f = ["bias", f"own:{b.own}"]
        f += [f"in:{x}" for x in b.tags if x not in ("html", "body")]
        bad, good = names & _BAD_NAMES, names & _GOOD_NAMES
        bad_tag = not b.tags.isdisjoint(_BAD_TAGS)
        if "hidden!" in names:
            f.append("hidden")
        if bad:
            f += ["bad-name", *(f"name:{x}" for x in bad)]
        if good:
            f += ["good-name"] if not bad else ["good-and-bad-name"]
        if bad_tag:
            f.append("bad-tag")
        clean = not bad and not bad_tag and "hidden!" not in names
        if seen_article:
            largest = bool(b.article) and articles[b.article] == top_article
            f.append("in-article" if largest else "in-other-article" if b.article else "beside-article")
            if clean and largest:
                f.append("clean-in-article")
        elif seen_main:
            f.append("in-main" if "main" in b.tags else "beside-main")
            if clean and "main" in b.tags:
                f.append("clean-in-article")
        elif clean:
            f.append("clean-plain")
            f += [f"plain-box:{_bucket(size[b.box] / total)}", f"plain-outer:{_bucket(size[-1 - b.outer] / total)}"]
            if size[b.box] == top_box:
                f.append("plain-top-box")
            if size[-1 - b.outer] == top_outer:
                f.append("plain-top-outer")
            f.append("plain-title:" + ("none" if title is None else "before" if k < title else "at" if k == title else "after" if k - title < 8 else "far"))
        f.append(f"box:{_bucket(size[b.box] / total)}")
        f.append("box-links:" + ("many" if linked[b.box] > size[b.box] else "few"))
        f.append("box-blocks:" + ("short" if size[b.box] + linked[b.box] < 60 * number[b.box] else "long"))
        f.append(f"size:{min(len(t).bit_length(), 10)}")
        density = b.links / len(t)
        linked_as = "links:0" if not b.links else "links:some" if density < 0.3 else "links:half" if density < 0.8 else "links:all"
        f.append(linked_as)
        if "clean-in-article" in f:
            f.append(f"clean-in-article:{linked_as}")  # a link in the article's own list is part of it
        f.append("before:" + (shapes[k - 1] if k else "none"))
        f.append("behind:" + (shapes[k + 1] if k + 1 < n else "none"))
        f.append("end:stop" if t[-1] in ".!?…\"”»" else "end:other")
        if "©" in t or "(c)" in t[:40].lower():
            f.append("copyright")
        if k == 0:
            f.append("first")
        if k == n - 1:
            f.append("last")
        if b.breaks:
            f.append("breaks")
        out.append(f)
    return out


class Crf:
    """Two labels (0 boilerplate, 1 content), binary features, transition weights."""

    def __init__(self, names: dict[str, int], w: np.ndarray, trans: np.ndarray):
        self.names, self.w, self.trans = names, w, trans
        self.gain = dict(zip(names, (w[:, 1] - w[:, 0]).tolist(), strict=True))

    def decode(self, feats: list[list[str]]) -> list[int]:
        """Viterbi: the likeliest labels of a page."""
        get = self.gain.get
        (t00, t01), (t10, t11) = self.trans.tolist()
        v0 = v1 = 0.0
        back = []
        for k, fs in enumerate(feats):
            e = sum([get(f, 0.0) for f in fs])
            if k == 0:
                v0, v1 = 0.0, e
                continue
            a, b, c, d = v0 + t00, v1 + t10, v0 + t01, v1 + t11
            back.append((int(b > a), int(d > c)))
            v0, v1 = max(a, b), max(c, d) + e
        y = [int(v1 > v0)]
        for p in reversed(back):
            y.append(p[y[-1]])
        return y[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 60, ridge: float = 0.02, rate: float = 0.5) -> Crf:
    """Maximise the regularised likelihood of labelled pages by adaptive gradient ascent; pages of one length go together."""
    names: dict[str, int] = {}
    for fs, _ in pages:
        for f in fs:
            for x in f:
                names.setdefault(x, len(names))
    of = np.repeat(np.arange(len(pages)), [len(y) for _, y in pages])
    place = np.concatenate([np.arange(len(y)) for _, y in pages])
    y = np.concatenate([y for _, y in pages]).astype(int)
    x = np.zeros((len(y), len(names)), np.float32)
    for k, f in enumerate(f for fs, _ in pages for f in fs):
        x[k, [names[v] for v in f]] = 1
    follows = place > 0
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(follows) - 1], y[follows]), 1)
    w, trans = np.zeros((len(names), 2)), np.zeros((2, 2))
    hw, ht = np.full_like(w, 1e-6), np.full_like(trans, 1e-6)
    target = np.eye(2)[y]
    for _ in range(rounds):
        p, pair = _marginals((x @ w.astype(np.float32)).astype(float), trans, of, place)
        gw = x.T @ (target - p).astype(np.float32) - ridge * len(pages) * w
        gt = seen - pair - ridge * len(pages) * trans
        hw += gw**2
        ht += gt**2
        w += rate * gw / np.sqrt(hw)
        trans += rate * gt / np.sqrt(ht)
    return Crf(names, w, trans)


def _marginals(e: np.ndarray, trans: np.ndarray, of: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label marginals and summed pair marginals by scaled forward-backward, all pages in step."""
    pages, longest = int(of[-1]) + 1, int(place.max()) + 1
    psi, t = np.ones((longest, pages, 2)), np.exp(trans)
    psi[place, of] = np.exp(e - e.max(axis=1, keepdims=True))
    live = np.zeros((longest, pages), bool)
    live[place, of] = True
    a, b, scale = np.zeros_like(psi), np.ones_like(psi), np.ones((longest, pages))
    for k in range(longest):
        v = psi[k] * (a[k - 1] @ t if k else 1)
        scale[k] = v.sum(axis=1)
        a[k] = v / scale[k][:, None]
    for k in range(longest - 2, -1, -1):
        back = (psi[k + 1] * b[k + 1]) @ t.T / scale[k + 1][:, None]
        b[k] = np.where(live[k + 1][:, None], back, 1.0)
    pair = np.zeros((2, 2))
    for k in range(1, longest):
        each = a[k - 1][:, :, None] * (psi[k] * b[k])[:, None, :] * t / scale[k][:, None, None]
        pair += each[live[k]].sum(axis=0)
    return (a * b)[place, of], pair


# ---- labelled pages, generated by rule


_PARTS = ("ka", "lo", "ri", "ten", "mo", "sa", "ve", "un", "der", "ing")
#: Invented words of one to three parts.
_VOCABULARY = [*_PARTS * 10, *(a + b for a in _PARTS for b in _PARTS), *(a + b + a for a in _PARTS for b in _PARTS)]


def _words(r: random.Random, n: int) -> str:
    words = r.choices(_VOCABULARY, k=n)
    words[0] = words[0].capitalize()
    return " ".join(words)


def _sentence(r: random.Random, long: bool) -> str:
    """Text of content: sentences, now and then without a full stop, shouting or with symbols."""
    t = ". ".join(_words(r, r.randint(2, 14)) for _ in range(r.randint(1, 6 if long else 2)))
    kind = r.random()
    return t.upper() + "!!" if kind < 0.1 else t + " &amp; ###" if kind < 0.2 else t if kind < 0.3 else t + "."


LAYOUTS = ("article", "main", "div", "div-article", "section", "plain", "columns", "teasers", "list-comments")


def labelled_page(r: random.Random, layouts: tuple[str, ...] = LAYOUTS) -> str:
    """A page in which the text of content blocks starts with a mark that ``labelled`` takes off again."""
    mark = "\u0001"
    kind = r.choice(layouts + ("article",) * (2 if "article" in layouts else 0))
    good = r.choice(["content", "post", "entry", "story", "article-body", "main-text", "post-content"])
    link = lambda: f'<a href="/x">{_words(r, r.randint(1, 3))}</a>'
    menu = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 7))) + "</ul>"
    text = lambda: _sentence(r, r.random() < 0.5)
    long = lambda: _sentence(r, True)

    def odd() -> str:
        """A name that tells nothing."""
        return f' class="{r.choice("bcdwxz")}{r.randint(1, 99)}"' if r.random() < 0.5 else ""

    def teaser() -> str:
        inner = f"<h{r.randint(2, 4)}>{link()}</h3><p>{_words(r, r.randint(4, 14))}</p>" + (link() if r.random() < 0.5 else "")
        return f"<article{odd()}>{inner}</article>" if kind != "columns" else f"<div{odd()}>{inner}</div>"

    def comment() -> str:
        return f"<li{odd()}><div>{link()} <span>{r.randint(1, 30)}.{r.randint(1, 12)}.</span></div><p>{text()}</p><div>{link()}</div></li>"

    def junk(inside: bool) -> str:
        c = r.choice
        pool = [
            f'<div class="{c(["ad", "ads", "advert", "ad-slot", "sponsored", "promo"])}">{text()}</div>',
            f'<aside class="{c(["sidebar", "related", "widget", ""])}"><h3>{_words(r, 2)}</h3>{menu()}<p>{text()}</p></aside>',
            f'<div class="{c(["sidebar", "side-col", "widget-area"])}"><p>{text()}</p>{menu()}</div>',
            f'<div class="{c(["cookie-notice", "cookie-banner", "consent", "notice", "alert"])}"><p>{text()}</p><button>{_words(r, 1)}</button></div>',
            f"<form><label>{_words(r, 2)}</label><input name=q><button>{_words(r, 1)}</button><p>{text()}</p></form>",
            f'<div class="{c(["newsletter", "subscribe", "share", "social-links"])}"><p>{text()}</p>{link()}</div>',
            f'<section class="{c(["comments", "comment-list", "reader-comments"])}"><h2>{_words(r, 1)}</h2><div class="comment"><p>{text()}</p></div><div class="comment"><p>{text()}</p></div></section>',
            f'<div id="{c(["comments", "disqus_thread", "respond"])}"><article><p>{text()}</p></article><p>{text()}</p></div>',
            f'<nav class="{c(["breadcrumbs", "pager", ""])}">{link()} {link()}</nav>',
            f"<nav>{menu()}</nav>",
            f'<div class="{c(["menu", "navbar", "breadcrumb", "pagination"])}">{menu()}</div>',
            f'<div style="display:none">{text()}</div>',
        ]
        return c(pool[:10] if inside else pool)

    def content() -> str:
        c = r.random()
        if c < 0.62:
            return f"<p>{mark}{text()}" + ("</p>" if r.random() < 0.85 else "")
        if c < 0.7:
            return f"<h{r.randint(2, 4)}>{mark}{_words(r, r.randint(1, 6))}</h2>"
        if c < 0.77:
            return "<ul>" + "".join(f"<li>{mark}{_words(r, r.randint(1, 9))}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if c < 0.83:
            return f"<blockquote>{mark}{text()}</blockquote>"
        if c < 0.87:
            return f"<pre>{mark}{text()}</pre>"
        if c < 0.9 and kind in ("article", "main", "div-article", "teasers"):  # a list of links or a linked line of the article itself
            return "<ul>" + "".join(f"<li>{mark}{link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>" if r.random() < 0.8 else f"<p>{mark}{link()}</p>"
        if c < 0.92:
            return f"<p><b>{mark}{text()}<br><p>{mark}{text()}</p>"
        if c < 0.96:
            return "<table><tr>" + "".join(f"<td>{mark}{_words(r, 2)}</td>" for _ in range(3)) + "</tr></table>"
        return f"<p>{mark}{_words(r, 3)} {link()} {text()}</p>"

    inside = [content() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12]))]
    if kind in ("plain", "columns", "teasers", "list-comments"):  # what tells the main text there is how much of it there is
        inside = [f"<p>{mark}{long()} {long()}</p>" for _ in range(r.randint(2, 4))] + inside
        r.shuffle(inside)
    for _ in range(r.choice([0, 0, 0, 1, 2])):
        inside.insert(r.randint(0, len(inside)), junk(True))
    title = f"<h1>{mark}{_words(r, r.randint(1, 8))}</h1>" if r.random() < 0.85 else ""
    if title and r.random() < 0.15 and kind == "article":
        title = f"<header>{_words(r, 2)}</header>" + title
    inner = title + "".join(inside)
    body = {
        "article": f"<article>{inner}</article>",
        "main": f"<main>{inner}</main>",
        "div": f'<div class="{good}">{inner}</div>',
        "div-article": f'<div id="page"><article class="{good}">{inner}</article></div>',
        "section": f'<section class="{good}">{inner}</section>',
        "plain": f"<div{odd()}><div{odd()}>{inner}</div></div>",
        "columns": f"<div{odd()}><div{odd()}>{inner}</div><div{odd()}>{''.join(r.choice([teaser, menu])() for _ in range(r.randint(1, 4)))}</div></div>",
        "teasers": f"<article{odd()}>{inner}</article><section{odd()}>{''.join(teaser() for _ in range(r.randint(1, 5)))}</section>",
        "list-comments": f"<article{odd()}>{inner}</article><h3>{_words(r, r.randint(1, 3))}</h3><ol{odd()}>{''.join(comment() for _ in range(r.randint(1, 6)))}</ol>",
    }[kind]
    head = []
    if r.random() < 0.8:
        head.append(f"<nav>{menu()}</nav>")
    if r.random() < 0.4:
        head.append(f'<header class="{r.choice(["site-header", "masthead", ""])}"><p>{_words(r, 3)}</p>{menu() if r.random() < 0.5 else ""}</header>')
    head += [junk(False) for _ in range(r.choice([0, 1, 1, 2]))]
    tail = [junk(False) for _ in range(r.choice([0, 0, 1, 2]))]
    if r.random() < 0.85:
        tail.append(f"<footer>{r.choice(['&copy; ', '', 'Copyright '])}{text()}</footer>" if r.random() < 0.8 else f'<div class="footer">{text()}</div>')
    return f"<html><head><title>{_words(r, 3)}</title><style>p{{}}</style></head><body>{''.join(head)}{body}{''.join(tail)}<script>x()</script></body></html>"


def labelled(count: int, seed: int, layouts: tuple[str, ...] = LAYOUTS) -> list[tuple[list[Block], list[int]]]:
    out = []
    for k in range(count):
        page = blocks(labelled_page(random.Random(seed * 100_003 + k), layouts))
        if page:
            out.append(([b._replace(text=b.text.lstrip("\u0001") or "x") for b in page], [int(b.text.startswith("\u0001")) for b in page]))
    return out


@lru_cache(maxsize=4)
def default_model(count: int = 900, seed: int = 7, layouts: tuple[str, ...] = LAYOUTS) -> Crf:
    """The model trained on ``count`` generated pages."""
    return train([(features(p), y) for p, y in labelled(count, seed, layouts)])


def main_text(page: str | None, model: Crf) -> str:
    bs = blocks(page)
    if not bs:
        return ""
    return "\n".join(b[0] for b, y in zip(bs, model.decode(features(bs)), strict=True) if y)


def extract(pages: DataFrame, model: Crf | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars); no shuffle."""
    m = default_model() if model is None else model
    shared = pages.sparkSession.sparkContext.broadcast((m.names, m.w, m.trans))
    id_type = pages.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf(*shared.value)
        for b in chunks(batches, html_col):
            texts = [main_text(h, crf) for h in b.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(to_arrow_type(id_type)), b.column(url_col), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"page_id {id_type.simpleString()}, url string, text string, n_chars long")
