"""Main text of web pages, by gradient-boosted trees over DOM nodes and hierarchical decoding.

1. A tolerant parser makes a tree of each page's elements; an unclosed element ends where
   its parent ends or where a sibling of its kind must begin.
2. Every element gets features: its kind, words of its class and id, its depth, the length
   and density of its subtree's text, links, sentence marks, and the same of its siblings.
3. Boosted trees give each element the log odds that it belongs to the main text. They are
   fitted by numpy on elements whose answer is known: pages written from a grammar of usual
   layouts, filled with words of a bounded sample of the input's own pages.
4. Decoding picks the best consistent answer for the whole tree: what is inside a rejected
   element is rejected, and an element with a rejected parent cannot be kept. The best sum
   of log odds, each weighted by the text that hangs on it, is found bottom up.

Pages are independent, so the work is one pass; the model has a fixed size and is broadcast.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gradewise.functions import column
from gradewise.llm.text import batches, show_code, utf8

# Kinds of HTML elements, by the standard and by usual practice.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set(
    "head script style template noscript iframe object svg canvas audio video map title "
    "select option datalist textarea button annotation annotation-xml".split()
)
#: What may stand in a head; any other start tag, and text, ends an open one, as its end tag may be left out.
IN_HEAD = set("title meta link base basefont bgsound script style noscript noframes template".split())
#: Elements of formulas, which are part of the text around them.
MATH = set(
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts "
    "none mtable mtr mlabeledtr mtd mspace mstyle mpadded mphantom menclose merror mfenced maction semantics".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var ruby rt rp".split()
) | MATH
#: Starting one of these ends an open one of the same group.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
    "tbody": {"tr", "td", "th", "thead"},
}
#: Blocks that end an open paragraph.
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: An element of these is not closed from outside by a tag for something within.
SCOPES = set("table td th ul ol dl article aside section nav header footer main div form body html".split())

#: No part of an article by their tag, on pages that mark one.
NEVER_MAIN = set("footer nav form menu dialog".split())

# Words of class and id attributes that tell what an element is for.
GOOD_WORDS = "article content main post body entry story text prose blog page".split()
BAD_WORDS = (
    "nav menu navbar navigation breadcrumb breadcrumbs header masthead topbar footer bottom copyright sidebar side "
    "aside rail widget ad ads advert advertisement adslot sponsor sponsored promo banner cookie cookies consent gdpr "
    "notice alert popup modal overlay comment comments reply replies disqus discussion respond share social sharing "
    "related recommended recommendations more popular trending newsletter subscribe signup login search form tags tag "
    "meta byline toc pagination pager skip legal disclaimer teaser toolbar"
).split()
KINDS = [
    "article", "main", "section", "div", "p", "h1", "h2", "h3", "li", "ul", "ol", "table", "td", "blockquote", "pre",
    "nav", "header", "footer", "aside", "form", "figure", "figcaption", "dl", "details", "menu", "address", "body",
]
#: Attribute words get a feature each if they are among these, and counts by kind in any case.
TOLD_WORDS = GOOD_WORDS + BAD_WORDS
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass(slots=True)
class Node:
    """An element. ``content`` holds texts and elements in page order."""

    tag: str
    words: list[str] = field(default_factory=list)
    parent: Node | None = None
    content: list = field(default_factory=list)
    role: str = ""


class TreeBuilder(HTMLParser):
    """Builds a tree whatever the markup's faults, in time in proportion to the page.

    The depths of open elements are kept by tag, so an end tag is matched without a walk.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#page")
        self.open = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.scopes = [0]

    def _enter(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.open))
        if node.tag in SCOPES:
            self.scopes.append(len(self.open))
        self.open.append(node)

    def _leave(self, depth: int) -> None:
        """Close the element at ``depth`` and all within."""
        while len(self.open) > depth:
            tag = self.open.pop().tag
            self.depths[tag].pop()
            if tag in SCOPES:
                self.scopes.pop()

    def _innermost(self, tags) -> int:
        """Depth of the innermost open element of ``tags``, 0 if none is open."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "body":
            self._end({"head"})
        elif tag not in IN_HEAD:
            self._end_head()
        if tag in ENDS_P:
            self._end({"p"})
        if tag in CLOSES:
            self._end(CLOSES[tag])
        told = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        raw = f"{told.get('class', '')} {told.get('id', '')}"
        node = Node(tag, [w.lower() for w in WORD.findall(raw)], self.open[-1], role=told.get("role", "").lower())
        if "hidden" in told or told.get("aria-hidden") == "true":
            node.words.append("popup")
        self.open[-1].content.append(node)
        if tag not in VOID:
            self._enter(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "li"):
            self.handle_endtag(tag)

    def _end(self, tags: set[str]) -> None:
        """Close the innermost open element of ``tags`` unless a scope lies between."""
        depth = self._innermost(tags)
        if depth and depth >= self.scopes[-1]:
            self._leave(depth)

    def _end_head(self) -> None:
        if self.open[-1].tag == "head":
            self._leave(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        depth = self._innermost((tag,))
        if depth and (tag in SCOPES or depth >= self.scopes[-1]):
            self._leave(depth)

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self._end_head()
        self.open[-1].content.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


@dataclass(slots=True)
class Block:
    """A block element with what its own inline content says and what hangs below it."""

    node: Node
    parent: int
    depth: int
    own: int = 0  # characters directly in the block, inline elements included
    chars: int = 0  # characters of the subtree
    linked: int = 0  # of these, inside links
    marks: int = 0  # sentence marks
    elements: int = 1
    paragraphs: int = 0
    links: int = 0
    fields: int = 0
    order: int = 0


def blocks_of(root: Node) -> list[Block]:
    """Block elements in page order, parents first; hidden elements and what they hold left out."""
    blocks = [Block(root, -1, 0)]
    stack = [(root, 0, False, iter(root.content))]
    while stack:
        node, at, link, rest = stack[-1]
        for item in rest:
            block = blocks[at]
            if isinstance(item, str):
                n = len(item) - item.count(" ") - item.count("\n")
                block.own += n
                block.linked += n * link
                block.marks += sum(item.count(m) for m in ".,!?;:")
                continue
            if item.tag in HIDDEN:
                block.fields += item.tag in ("select", "textarea", "button")
                continue
            inline = item.tag in INLINE or item.tag in VOID
            if inline:
                block.links += item.tag == "a"
                block.fields += item.tag == "input"
                block.elements += item.tag not in MATH
                stack.append((item, at, link or item.tag == "a", iter(item.content)))
            else:
                blocks.append(Block(item, at, block.depth + 1, order=len(blocks)))
                blocks[-1].paragraphs = int(item.tag == "p")
                stack.append((item, len(blocks) - 1, link, iter(item.content)))
            break
        else:
            stack.pop()
    for block in blocks:
        block.chars = block.own
    for block in reversed(blocks[1:]):
        up = blocks[block.parent]
        for name in ("chars", "linked", "marks", "elements", "paragraphs", "links", "fields"):
            setattr(up, name, getattr(up, name) + getattr(block, name))
    return blocks


NUMBERS = 18


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row per block: numbers of the subtree, its place and siblings, then kinds and words."""
    total = max(blocks[0].chars, 1)
    count = len(blocks)
    children, places = np.zeros(count, int), np.zeros(count, int)
    for i, b in enumerate(blocks[1:], 1):
        places[i] = children[b.parent]
        children[b.parent] += 1
    table = np.zeros((count, NUMBERS + 2 * len(KINDS) + len(TOLD_WORDS) + 4), np.float32)
    kind_at = {k: NUMBERS + i for i, k in enumerate(KINDS)}
    word_at = {w: NUMBERS + 2 * len(KINDS) + i for i, w in enumerate(TOLD_WORDS)}
    good, bad = set(GOOD_WORDS), set(BAD_WORDS)
    tail = table.shape[1] - 4
    for i, b in enumerate(blocks):
        siblings = children[max(b.parent, 0)]
        up = blocks[max(b.parent, 0)]
        n = max(b.chars, 1)
        table[i, :NUMBERS] = (
            b.depth,
            np.log1p(b.chars),
            np.log1p(b.own),
            b.chars / total,
            b.chars / b.elements,
            b.linked / n,
            b.marks / n,
            b.links / b.elements,
            b.paragraphs,
            np.log1p(b.fields),
            siblings,
            places[i] / max(siblings, 1),
            b.chars / max(up.chars, 1),
            up.linked / max(up.chars, 1),
            b.order / count,
            children[i],
            up.paragraphs,
            b.own / n,
        )
        for at, own in ((0, b), (len(KINDS), up)):
            if own.node.tag in kind_at:
                table[i, kind_at[own.node.tag] + at] = 1
        for w in b.node.words:
            if w in word_at:
                table[i, word_at[w]] = 1
            table[i, tail] += w in good
            table[i, tail + 1] += w in bad
        table[i, tail + 2] = b.node.role in ("main", "article")
        table[i, tail + 3] = b.node.role in (
            "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu",
        )
    return table


# Boosted trees -----------------------------------------------------------------------


@dataclass
class Trees:
    """Trees of one depth as arrays: per tree the inner nodes' feature and limit, and the leaves."""

    base: float
    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1]))
        for feature, limit, leaf in zip(self.features, self.limits, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += leaf[at - (len(leaf) - 1)]
        return total


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.25, bins: int = 16
) -> Trees:
    """Second-order boosting for the log loss, splits at quantiles of each feature.

    All candidate splits are one matrix of zeros and ones, so a level's sums on either side
    of every candidate are one product.
    """
    candidates = [
        (f, edge)
        for f in range(x.shape[1])
        for edge in np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[:-1], method="lower"))
        if edge < x[:, f].max()
    ]
    feature = np.array([f for f, _ in candidates])
    limit = np.array([e for _, e in candidates], np.float32)
    above = (x[:, feature] > limit).astype(np.float32)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(x), base)
    inner, n_leaves = 2**depth - 1, 2**depth
    features = np.zeros((rounds, inner), np.int64)
    limits = np.full((rounds, inner), np.inf, np.float32)
    leaves = np.zeros((rounds, n_leaves))
    for tree in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, bend = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first = 2**level - 1
            inside = at == np.arange(first, 2 * first + 1)[:, None]
            sides = [(inside * v).astype(np.float32) for v in (slope, bend)]
            (g, h), (gt, ht) = [v @ above for v in sides], [v.sum(1, keepdims=True) for v in sides]
            gain = g**2 / (h + 1) + (gt - g) ** 2 / (np.maximum(ht - h, 0) + 1) - gt**2 / (ht + 1)
            best = gain.argmax(1)
            for node, split in enumerate(best):
                if gain[node, split] > 1e-3:
                    features[tree, first + node], limits[tree, first + node] = feature[split], limit[split]
            at = 2 * at + 1 + (x[np.arange(len(x)), features[tree, at]] > limits[tree, at])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, n_leaves), np.bincount(leaf, bend, n_leaves)
        leaves[tree] = -rate * g / (h + 1)
        score += leaves[tree][leaf]
    return Trees(base, features, limits, leaves)


# Layouts with known answers ----------------------------------------------------------


class Grammar:
    """Pages of usual layouts from given sentences; elements of the main text are marked."""

    MARK = "\x01"

    def __init__(self, sentences: list[str], seed: int = 11):
        self.rng = np.random.default_rng(seed)
        self.sentences = sentences

    def pick(self, *options):
        return options[self.rng.integers(len(options))]

    def chance(self, share: float) -> bool:
        return self.rng.random() < share

    def sentence(self) -> str:
        text = self.sentences[self.rng.integers(len(self.sentences))]
        return text.replace("&", "&amp;").replace("<", "&lt;")

    def some(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.integers(low, high + 1)))

    def short(self, n: int = 3) -> str:
        return " ".join(self.sentence().split()[: self.rng.integers(1, n + 1)])

    def wrap(self, tag: str, words: str, inside: str, keep: bool = False) -> str:
        """An element, named by class or id or not at all; the mark makes it part of the answer."""
        attr = "" if not words or self.chance(0.15) else f' {self.pick("class", "class", "id")}="{words}"'
        return f"<{tag}{attr}{' data-keep' if keep else ''}>{inside}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f'<li><a href="/{i}">{self.short()}</a></li>' for i in range(self.rng.integers(low, high + 1))]
        return f"<ul>{''.join(items)}</ul>"

    def paragraph(self) -> str:
        inside = self.some(1, 6) if self.chance(0.8) else self.short(6)
        if self.chance(0.2):
            inside += f' <a href="/x">{self.short()}</a> {self.sentence()}'
        if self.chance(0.15):
            return f"<p data-keep><b>{self.sentence()}<br>"  # never closed
        return f"<p data-keep>{inside}</p>"

    def heading(self, level: str = "h2") -> str:
        return f"<{level} data-keep>{self.short(9)}</{level}>"

    def article(self) -> str:
        parts = [self.heading("h1")] if self.chance(0.8) else []
        for _ in range(self.rng.integers(1, 14)):
            kind = self.rng.random()
            if kind < 0.75:
                parts.append(self.paragraph())
            elif kind < 0.85:
                parts.append(self.heading(self.pick("h2", "h3")))
            elif kind < 0.9:
                parts.append("<ul data-keep>" + "".join(f"<li data-keep>{self.sentence()}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.94:
                parts.append(f"<blockquote data-keep>{self.sentence()}</blockquote>")
            elif kind < 0.97:
                rows = "".join(f"<tr data-keep><td data-keep>{self.short()}</td><td data-keep>{self.short()}</td></tr>" for _ in range(3))
                parts.append(f"<table data-keep>{rows}</table>")
            else:
                parts.append(self.junk_inside())
        if self.chance(0.15):
            parts.insert(self.rng.integers(len(parts) + 1), self.junk_inside())
        return "".join(parts)

    def junk_inside(self) -> str:
        return self.pick(
            lambda: self.wrap("div", self.pick("ad", "advert", "ad-slot", "sponsored", "promo"), self.some(1, 2)),
            lambda: self.wrap("div", self.pick("share", "social-share", "share-buttons"), self.links(2, 4)),
            lambda: self.wrap("aside", self.pick("", "related", "promo"), self.some(1, 3)),
            lambda: self.wrap("div", self.pick("newsletter", "signup", "subscribe"), self.form()),
        )()

    def form(self) -> str:
        inside = f"<label>{self.short()}</label><input name=q><button>{self.short(2)}</button>"
        return f"<form{self.pick('', ' class=search', ' id=signup')}>{self.pick('', self.sentence())}{inside}</form>"

    def comments(self) -> str:
        one = [
            self.wrap("div", self.pick("comment", "comment-body", "reply"), f"<p>{self.some(1, 3)}</p>")
            for _ in range(self.rng.integers(1, 6))
        ]
        inside = f"<h3>{self.short(3)}</h3>" * self.chance(0.6) + "".join(one)
        return self.wrap(self.pick("section", "div", "ol"), self.pick("comments", "comment-list", "discussion", "responses comments"), inside)

    def junk(self, bottom: bool) -> str:
        options = [
            lambda: self.wrap("div", self.pick("ad", "ads", "advert banner", "ad-box"), self.some(1, 2)),
            lambda: self.wrap("div", self.pick("cookie-notice", "cookie-banner", "consent", "notice", "gdpr alert"),
                              f"<p>{self.some(1, 2)}</p><button>{self.short(1)}</button>"),
            lambda: self.wrap(self.pick("aside", "div"), self.pick("sidebar", "side-bar widget", "rail"),
                              f"<h3>{self.short()}</h3>" + self.pick(self.links(3, 8), f"<p>{self.some(1, 3)}</p>")),
            lambda: self.wrap("div", self.pick("breadcrumb", "breadcrumbs"), self.links(2, 4)),
            lambda: self.form(),
            lambda: self.wrap("div", self.pick("popup", "modal", "overlay"), f"<p>{self.some(1, 2)}</p>"),
        ]
        if bottom:
            options += [
                self.comments,
                self.comments,
                lambda: self.wrap(self.pick("section", "div"), self.pick("related", "recommended", "more-stories"),
                                  f"<h3>{self.short()}</h3>" + self.links(2, 6)),
                lambda: self.wrap("nav", self.pick("", "pagination"), self.links(2, 4)),
            ]
        return self.pick(*options)()

    def page(self) -> str:
        nav = self.pick("nav", "nav", "div", "ul")
        top = self.wrap(nav, "" if nav == "nav" and self.chance(0.5) else self.pick("nav", "menu", "main-menu", "navbar"), self.links(3, 9))
        if self.chance(0.4):
            top = self.wrap("header", self.pick("", "site-header", "masthead"), self.pick("", f"<h1>{self.short()}</h1>", f"<p>{self.short(6)}</p>") + top)
        elif self.chance(0.3):
            top = self.wrap("div", self.pick("header", "topbar"), f"<span>{self.short(5)}</span>") + top
        body = self.article()
        holder = self.pick(
            ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"),
            ("div", "post entry"), ("section", "story"), ("div", "main-text"), ("div", ""),
        )
        core = self.wrap(*holder, body, keep=True)
        if self.chance(0.3):
            core = self.wrap(self.pick("main", "div"), self.pick("", "main", "page", "wrapper"), core + self.pick("", self.junk(True)), keep=True)
        above = "".join(self.junk(False) for _ in range(self.rng.integers(0, 3)))
        below = "".join(self.junk(True) for _ in range(self.rng.integers(0, 4)))
        foot = self.wrap(self.pick("footer", "footer", "div"), self.pick("", "footer", "site-footer"),
                         self.pick(f"&copy; {self.short(4)} &middot; {self.sentence()}", f"<p>{self.some(1, 2)}</p>", self.links(2, 6)))
        if foot.startswith("<div>"):
            foot = self.wrap("footer", "", self.sentence())
        inside = top + above + core + below + foot * self.chance(0.9)
        if self.chance(0.3):
            inside = self.wrap("div", self.pick("", "wrapper", "container", "page"), inside, keep=True)
        return f"<html><head><title>{self.short(6)}</title></head><body data-keep>{inside}</body></html>"


class MarkedBuilder(TreeBuilder):
    """Notes which elements the grammar marked."""

    def __init__(self) -> None:
        super().__init__()
        self.marked: set[int] = set()

    def handle_starttag(self, tag: str, attrs) -> None:
        super().handle_starttag(tag, attrs)
        node = self.open[-1].content[-1] if tag in VOID else self.open[-1]
        if any(k == "data-keep" for k, _ in attrs):
            self.marked.add(id(node))


def marked_blocks(html: str) -> tuple[np.ndarray, np.ndarray]:
    builder = MarkedBuilder()
    builder.feed(html)
    builder.close()
    blocks = blocks_of(builder.root)
    keep = np.array([id(b.node) in builder.marked or b.parent < 0 or b.node.tag == "html" for b in blocks], float)
    return features_of(blocks), keep


def fit_extractor(sentences: list[str], n_pages: int = 900, seed: int = 11) -> Trees:
    grammar = Grammar(sentences, seed)
    parts = [marked_blocks(grammar.page()) for _ in range(n_pages)]
    return fit_trees(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))


# Decoding ----------------------------------------------------------------------------


def never_main(blocks: list[Block]) -> np.ndarray:
    """Blocks whose tag says that they are no part of an article: page ends, menus and forms.

    One that holds an article or main element is judged by the trees like any other, as some
    pages stand in a form as a whole; so is the end of a quotation, which names its source.
    """
    holds_main = np.zeros(len(blocks), bool)
    quoted = np.zeros(len(blocks), bool)
    for i in range(len(blocks) - 1, 0, -1):
        if holds_main[i] or blocks[i].node.tag in ("article", "main") or blocks[i].node.role in ("main", "article"):
            holds_main[blocks[i].parent] = True
    for i, b in enumerate(blocks[1:], 1):
        quoted[i] = quoted[b.parent] or b.node.tag == "blockquote"
    told = np.array([b.node.tag in NEVER_MAIN for b in blocks], bool)
    any_main = bool(holds_main[0]) if len(blocks) else False
    return told & ~holds_main & ~quoted & any_main


def decode(blocks: list[Block], log_odds: np.ndarray) -> np.ndarray:
    """The consistent set of kept blocks with the largest sum: none without its parent, none of ``never_main``.

    A block kept gains its weighted log odds and the best of its children; one rejected
    gains the loss of all that hangs below it, so rejection is a choice about the subtree.
    """
    weight = np.array([1 + np.log1p(b.own) for b in blocks])
    value = weight * np.clip(log_odds, -8, 8)
    inside = value.copy()  # best sum if kept
    dropped = -value  # sum if the whole subtree is rejected
    never = never_main(blocks)
    for i in range(len(blocks) - 1, 0, -1):
        if never[i]:
            continue
        up = blocks[i].parent
        inside[up] += max(inside[i], dropped[i])
        dropped[up] += dropped[i]
    keep = np.zeros(len(blocks), bool)
    keep[0] = True
    for i, b in enumerate(blocks[1:], 1):
        keep[i] = keep[b.parent] and not never[i] and inside[i] > dropped[i]
    return keep


def text_of(blocks: list[Block], keep: np.ndarray) -> str:
    """Kept blocks' texts in page order: white space inside one is one space, and so is what joins them."""
    kept = {id(b.node) for b, k in zip(blocks, keep) if k}
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    stack = [iter(blocks[0].node.content)] if blocks else []
    edges = [True]
    while stack:
        for item in stack[-1]:
            if isinstance(item, str):
                run.append(item)
                continue
            if item.tag in HIDDEN:
                continue
            if item.tag in VOID:
                if item.tag in ("br", "hr"):
                    run.append(" ")
                continue
            inline = item.tag in INLINE
            if item.tag in ("mtr", "mtd"):
                run.append(" ")
            if not inline:
                close()
                if id(item) not in kept:
                    continue
            stack.append(iter(item.content))
            edges.append(not inline)
            break
        else:
            stack.pop()
            if edges.pop():
                close()
    close()
    return " ".join(out)


def main_texts(htmls: list[str], trees: Trees) -> list[str]:
    pages = [blocks_of(parse(h)) for h in htmls]
    odds = trees.log_odds(np.concatenate([features_of(p) for p in pages]))
    ends = np.cumsum([len(p) for p in pages])
    return [text_of(p, decode(p, odds[e - len(p) : e])) for p, e in zip(pages, ends)]


# On tables ---------------------------------------------------------------------------

SENTENCE = re.compile(r"[^.<>{}\n]{15,300}\.")


def sample_sentences(pages: DataFrame, html: str, key: str, max_pages: int) -> list[str]:
    """Sentences of at most ``max_pages`` pages, those with the smallest hashes of their key."""
    rows = pages.select(column(key).alias("id"), column(html).alias("html"))
    place = F.pmod(F.xxhash64(F.lit("page"), "id"), F.lit(1 << 30))
    share = min(1.0, 2 * max_pages / max(rows.count(), 1))
    found = F.slice(F.regexp_extract_all(F.regexp_replace("html", "<[^>]*>", "\n"), F.lit(SENTENCE.pattern), F.lit(0)), 1, 40)
    sample = (
        rows.withColumn("place", place)
        .filter(F.col("place") < int(share * (1 << 30)))
        .select("place", "id", found.alias("found"))
        .orderBy("place", "id")
        .limit(max_pages)
        .collect()
    )
    sentences = [s.strip() for r in sample for s in r["found"] or []]
    return sentences or ["A page may have no sentence at all."]


def extractor(trees) -> Column:
    def extract(htmls: pa.Array) -> pa.Array:
        raw = utf8(htmls)
        texts = [
            text for group in batches(raw) for text in main_texts([raw[i].decode() for i in group], trees.value)
        ]
        return pa.array(texts, pa.string())

    return arrow_udf(extract, "string").asNondeterministic()


def extract_main_text(
    pages: DataFrame, html: str = "html", key: str = "page_id", into: str = "main_text", max_pages: int = 200
) -> DataFrame:
    """``pages`` with ``into``: the main text of each whole page, empty where there is none.

    Null html is the empty page. Markup of any kind of fault is read as far as it goes, and
    plain text without elements is kept. Character references are decoded; white space in a
    block becomes one space; blocks are joined by a space. Formulas in MathML are text like
    any other; what is not shown as text (``HIDDEN``: scripts, drawings, form fields, what stands
    in for embedded objects) is left out. Pages that repeat are extracted
    alike. The model sees sentences of at most ``max_pages`` pages. A column of ``pages``
    called ``into`` is replaced; other columns play no part.
    """
    show_code(pages)
    trees = fit_extractor(sample_sentences(pages, html, key, max_pages))
    held = pages.sparkSession.sparkContext.broadcast(trees)
    return pages.withColumn(into, extractor(held)(column(html)))
