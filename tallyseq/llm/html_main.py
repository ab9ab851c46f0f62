"""Main text of web pages: boosted trees over DOM-node features, decoded along the tree.

A page is parsed into a tree of block elements and runs of text. Each element gets features of
its own, of its subtree (text, links, tag density), of its attributes' tokens, its depth, its siblings
and its ancestors, and the trees give the log odds that it belongs to the article. Decoding
chooses the best set of elements in which a chosen one's ancestors are chosen as well: below
a rejected element nothing is kept. The trees learn from generated pages of many layouts,
whose labels are known by construction.

Defined results for odd input: a null or empty page, and one without an article, has empty
text; broken or cut-off markup is closed at the end, in time linear in the page's length however long or deeply
nested it is; of choices of elements with equal log odds the smaller one is taken; white space in any sense of Unicode
counts as such; rows that repeat an id are read each; an empty table gives an empty result;
other columns pass through, one that has the name of the added column as name + ``_input``.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.boosted_trees import BoostedTrees, fit
from tallyseq.llm.names import clear_of

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never the page's text.
SILENT = frozenset("script style template noscript iframe object svg math head title canvas audio video select option textarea button".split())
RAW = frozenset("script style textarea title iframe noscript".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEPS_OPEN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
_PLAIN = re.compile(r"[^>\"']*")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
#: A name, taken whole, and its value if it has one; a run of letters is read once.
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

TOKEN_GROUPS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager links skip",
    "head": "header masthead topbar logo branding banner hero",
    "foot": "footer foot copyright legal bottom colophon imprint",
    "side": "sidebar side aside widget rail related recommended popular trending more secondary complementary teaser",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion adbox adslot dfp",
    "notice": "cookie cookies consent notice alert gdpr popup modal newsletter subscribe signup overlay dialog paywall",
    "comment": "comment comments disqus reply replies respond discussion commentlist feedback",
    "social": "share social follow sharing tweet buttons",
    "form": "form search login contact input field",
    "content": "content article post entry main story body text page prose articlebody maincontent",
}
_GROUP_OF = {t: i for i, words in enumerate(TOKEN_GROUPS.values()) for t in words.split()}
TAG_GROUPS = ("p", "h1 h2 h3 h4 h5 h6", "article", "main", "section", "div", "nav menu", "header", "footer", "aside", "form fieldset", "ul ol dl", "li dt dd", "table tbody tr td th thead", "pre blockquote", "figure figcaption", "body html")
_TAG_OF = {t: i for i, words in enumerate(TAG_GROUPS) for t in words.split()}


class Node:
    __slots__ = ("attrs", "children", "groups", "link", "parent", "tag")

    def __init__(self, tag: str, parent: Node | None, attrs: dict[str, str]):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        self.children: list[Node | list] = []  # elements, and runs of text as [text, characters inside links]
        named = " ".join(attrs.get(k, "") for k in ("class", "id", "role")) if attrs else ""
        words = re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", named).lower()) if named else ()
        self.groups = {_GROUP_OF[w] for w in words if w in _GROUP_OF}


class Tags:
    """One pass over the tags of a page. A quote that never closes is a character like any other."""

    def __init__(self, page: str):
        self.page = page
        self.last = {quote: page.rfind(quote) for quote in "\"'"}

    def end(self, at: int) -> int:
        """The place behind the tag that is open at ``at``."""
        while True:
            at = _PLAIN.match(self.page, at).end()
            if at == len(self.page):
                return at
            quote = self.page[at]
            at += 1
            if quote == ">":
                return at
            if self.last[quote] >= at:
                at = self.page.index(quote, at) + 1

    def walk(self) -> Iterator[tuple[int, int, str | None, bool]]:
        """(start, end, name or None for comments and declarations, whether it is an end tag), each from where the last ended.

        ``send`` a place to go on from there.
        """
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            head = page[at : at + 1]
            if head in ("!", "?"):
                mark = "-->" if page.startswith("!--", at) else ">"
                found = page.find(mark, at + 3 if mark == "-->" else at)
                at = len(page) if found < 0 else found + len(mark)
                name = None
            else:
                m = _NAME.match(page, at)
                if m is None:
                    continue
                at, name = self.end(m.end()), m[1].lower()
            moved = yield start, at, name, head == "/"
            if moved is not None:
                at = moved
                yield start, at, None, False  # answers the send


def parse(page: str) -> Node:
    """The tree of block elements of a page, in time that is linear in its length.

    Open elements are counted by name and found by their depth, so neither an end tag without a
    start nor an element that closes others climbs the tree in vain.
    """
    root = Node("html", None, {})
    path, depths = [root], defaultdict(list)  # open elements, and their depths by name
    inline: Counter[str] = Counter()  # open inline elements of the current block
    run = None

    def say(text: str) -> None:
        nonlocal run
        if not text:
            return
        if run is None:
            run = [[], 0]
            path[-1].children.append(run)
        run[0].append(text)
        if inline["a"]:
            run[1] += len(text)

    def leave(depth: int) -> None:
        """Close the element at a depth and all below it."""
        nonlocal run
        while len(path) > depth:
            depths[path.pop().tag].pop()
        run = None
        inline.clear()

    at = 0
    tags = Tags(page).walk()
    for start, end, name, closes in tags:
        say(html.unescape(page[at:start]))
        at = end
        if name is None:
            continue
        if closes:
            if name in INLINE:
                if inline[name]:
                    inline[name] -= 1
            elif depths[name]:
                leave(depths[name][-1])
            continue
        if name in INLINE:
            if name == "br":
                say(" ")
            elif name not in VOID:
                inline[name] += 1
            continue
        if name in ("html", "body") and len(path) == 1 and not root.children:
            continue
        if path[-1].tag == "p":  # a block start closes an open paragraph
            leave(len(path) - 1)
        if name in CLOSES_ITSELF:
            fence = max((depths[t][-1] for t in KEEPS_OPEN[name] if depths[t]), default=0)
            over = [depths[t][k] for t in CLOSES_ITSELF[name] if (k := bisect_right(depths[t], fence)) < len(depths[t])]
            if over:
                leave(min(over))
        whole = page[start:end]
        attrs = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTR.finditer(whole) if a.lastindex > 1} if " " in whole or "\n" in whole else {}
        run = None
        if name in VOID:
            continue
        node = Node(name, path[-1], attrs)
        path[-1].children.append(node)
        if name in RAW:
            found = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = found.end() if found else len(page)
            tags.send(at)
        elif not whole.endswith("/>"):
            depths[name].append(len(path))
            path.append(node)
            inline.clear()
    say(html.unescape(page[at:]))
    return root


WIDTH = len(TAG_GROUPS) + 2 * len(TOKEN_GROUPS) + 22


def features(root: Node) -> tuple[list[Node], np.ndarray, list[int]]:
    """Elements in page order that are not silent, their features, and each one's parent by number (-1: none)."""
    nodes: list[Node] = []
    parents: list[int] = []
    stack = [(root, -1)]
    while stack:
        node, up = stack.pop()
        if node.tag in SILENT:
            continue
        nodes.append(node)
        parents.append(up)
        stack += [(c, len(nodes) - 1) for c in reversed(node.children) if isinstance(c, Node)]
    n = len(nodes)
    own, links, marks, inner, heads, paras = (np.zeros(n) for _ in range(6))
    depth, kids, index, same = (np.zeros(n) for _ in range(4))
    for i, node in enumerate(nodes):
        for c in node.children:
            if isinstance(c, list):
                text = "".join(c[0])
                own[i] += len(text.strip())
                links[i] += min(c[1], len(text))
                marks[i] += text.count(".") + text.count(",")
            else:
                kids[i] += 1
        heads[i], paras[i] = node.tag in ("h1", "h2"), node.tag == "p"
        if parents[i] >= 0:
            depth[i] = depth[parents[i]] + 1
    text, link, mark, inner, head, para = own.copy(), links.copy(), marks.copy(), np.ones(n), heads.copy(), paras.copy()
    for i in range(n - 1, 0, -1):
        for a in (text, link, mark, inner, head, para):
            a[parents[i]] += a[i]
    before: dict[int, int] = {}
    tags: dict[tuple[int, str], int] = {}
    for i, node in enumerate(nodes):
        index[i] = before.get(parents[i], 0)
        before[parents[i]] = before.get(parents[i], 0) + 1
        tags[parents[i], node.tag] = tags.get((parents[i], node.tag), 0) + 1
    x = np.zeros((n, WIDTH))
    g0, g1, f0 = len(TAG_GROUPS), len(TAG_GROUPS) + len(TOKEN_GROUPS), len(TAG_GROUPS) + 2 * len(TOKEN_GROUPS)
    total = max(text[0], 1.0)
    for i, node in enumerate(nodes):
        up = parents[i]
        if node.tag in _TAG_OF:
            x[i, _TAG_OF[node.tag]] = 1
        for g in node.groups:
            x[i, g0 + g] = 1
        if up >= 0:  # what any ancestor says
            x[i, g1:f0] = np.maximum(x[up, g1:f0], x[up, g0:g1])
            x[i, f0 : f0 + 4] = np.maximum(x[up, f0 : f0 + 4], [nodes[up].tag in t for t in (("nav", "menu"), ("footer",), ("aside",), ("article", "main"))])
        same[i] = tags[up, node.tag]
    up = np.maximum(parents, 0)
    siblings = np.array([before[p] for p in parents])
    x[:, f0 + 4 :] = np.stack(
        [
            np.log1p(text),
            np.log1p(own),
            link / np.maximum(text, 1),
            links / np.maximum(own, 1),
            100 * inner / np.maximum(text, 20),  # tag density of the subtree
            mark / np.maximum(text, 1),
            text / total,
            text / np.maximum(text[up], 1),
            np.log1p(text[up] / siblings),
            depth,
            siblings,
            index / siblings,
            same,
            kids,
            head,
            np.log1p(para),
            np.array(["hidden" in v.attrs or "none" in v.attrs.get("style", "") or v.attrs.get("aria-hidden") == "true" for v in nodes], float),
            np.array([v.tag == "form" for v in nodes], float),
        ],
        axis=1,
    )
    return nodes, x, parents


def decode(margin: np.ndarray, parents: list[int]) -> np.ndarray:
    """The best choice of elements by the sum of log odds, where a chosen one's ancestors are chosen."""
    n = len(parents)
    without, best = -margin, margin.copy()  # of the subtree: nothing chosen, the element chosen
    for i in range(n - 1, 0, -1):
        without[parents[i]] += without[i]
        best[parents[i]] += max(best[i], without[i])
    chosen = np.zeros(n, bool)
    for i in range(n):
        chosen[i] = best[i] > without[i] and (i == 0 or chosen[parents[i]])
    return chosen


def blocks(nodes: list[Node], chosen: np.ndarray) -> list[str]:
    """Text runs of the chosen elements in page order, white space folded."""
    kept = {id(v) for v, c in zip(nodes, chosen, strict=True) if c}
    out, stack = [], [iter(nodes[0].children)] if nodes and chosen[0] else []
    while stack:
        c = next(stack[-1], None)
        if c is None:
            stack.pop()
        elif isinstance(c, list):
            if text := " ".join("".join(c[0]).split()):
                out.append(text)
        elif id(c) in kept:
            stack.append(iter(c.children))
    return out


# ---- training pages ----


class _Pages:
    """Generated pages in many layouts. ``data-y`` marks what belongs to the article (1) or not (0)."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        made = ["".join(r.choice(("ta", "re", "on", "mi", "lo", "ver", "sti", "qua", "en", "zu", "é", "ñor")) for _ in range(r.randint(1, 4))) for _ in range(r.randint(lo, hi))]
        junk = r.choice(("", "", "", "", "|", "&amp;&amp;", "***"))
        if junk:
            made = [w + (" " if junk == "|" else "") + junk for w in made]
        stop = r.choice((0.0, 0.08, 0.12))
        return " ".join(w + ("." if r.random() < stop else "," if r.random() < 0.05 else "") for w in made).capitalize() + ("." if r.random() < 0.8 else "")

    def pick(self, *some: str) -> str:
        return self.r.choice(some)

    def links(self, lo: int = 2, hi: int = 9) -> str:
        kind, n = self.r.random(), self.r.randint(lo, hi)
        made = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(n)]
        return f"<ul>{''.join(f'<li>{a}</li>' for a in made)}</ul>" if kind < 0.6 else f"<p>{' | '.join(made)}</p>" if kind < 0.8 else " ".join(f"<div>{a}</div>" for a in made)

    def named(self, tag: str, *names: str) -> str:
        how = self.r.random()
        if how < 0.15:
            return f"<{tag} data-y=0>"
        name = self.pick(*names)
        return f'<{tag} {self.pick("class", "class", "id")}="{name}{self.pick("", "", "-box", " wide", "-1")}" data-y=0>'

    def clutter(self) -> str:
        r, w = self.r, self.words
        tag = self.pick("div", "div", "section", "aside")
        kind = r.randrange(9)
        if kind == 0:
            return f"{self.named(tag, 'ad', 'ads', 'advert', 'sponsored', 'promo')}{self.pick(w(3, 30), '<p>' + w(5, 25) + '</p>', '<a href=x>' + w(3, 12) + '</a>')}</{tag}>"
        if kind == 1:
            return f"{self.named('aside', 'sidebar', 'widget', 'related', 'popular')}<h3>{w(1, 4)}</h3>{self.pick(self.links(), '<p>' + w(8, 40) + '</p>')}</aside>"
        if kind == 2:
            return f"<div class=\"{self.pick('cookie-notice', 'consent', 'newsletter', 'alert', 'popup')}\" data-y=0><p>{w(8, 40)}</p><button>{w(1, 2)}</button></div>"
        if kind == 3:
            return f"{self.named(tag, 'share', 'social', 'follow')}{self.links(2, 5)}</{tag}>"
        if kind == 4:
            return f"<form action=/s data-y=0><label>{w(1, 4)}</label><input name=q><p>{w(2, 12)}</p></form>"
        if kind == 5:
            items = "".join(f"<{t} class=comment><p><b>{w(1, 2)}</b></p><p>{w(5, 60)}</p></{t}>" for t in [self.pick("li", "div", "article")] * r.randint(1, 6))
            return f"<{tag} {self.pick('id', 'class')}=\"{self.pick('comments', 'comment-list', 'discussion', 'replies')}\" data-y=0><h2>{w(1, 3)}</h2>{items}</{tag}>"
        if kind == 6:
            return f"{self.named('nav', 'breadcrumb', 'menu', 'toc')}{self.links()}</nav>"
        if kind == 7:
            return f"{self.named('div', 'menu', 'navbar', 'links', 'breadcrumbs')}{self.links()}</div>"
        return f"<aside data-y=0>{self.pick('<p>' + w(5, 40) + '</p>', self.links())}</aside>"

    def body(self) -> str:
        r, w = self.r, self.words
        parts = [f"<h1>{w(2, 12)}</h1>"] if r.random() < 0.8 else []
        loose, bold = r.random() < 0.3, r.random() < 0.4
        for _ in range(r.choice((1, 2, 4, 8, 12))):
            kind = r.random()
            if kind < 0.72:
                text = w(1, r.choice((6, 20, 60, 120)))
                text = f"<b>{text}<br>" if bold and r.random() < 0.3 else text
                text = text + f' <a href="/x">{w(1, 5)}</a> ' + w(2, 20) if r.random() < 0.12 else text
                parts.append(f"<p>{text}" + ("" if loose or text.endswith("<br>") else "</p>"))
            elif kind < 0.8:
                parts.append(f"<h2>{w(1, 7)}</h2>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{w(2, 15)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{w(4, 40)}</p></blockquote>")
            elif kind < 0.93:
                parts.append(f"<table><tr><td>{w(1, 5)}<td>{w(1, 5)}</tr></table>")
            elif kind < 0.95:
                parts.append(f"<pre>{w(3, 20)}</pre>")
            elif kind < 0.97:
                parts.append(f"<figure><img src=i><figcaption>{w(2, 10)}</figcaption></figure>")
            else:
                parts.append(self.clutter())
        return "".join(parts)

    def page(self) -> str:
        r, w = self.r, self.words
        holder = self.pick("<article data-y=1>|</article>", "<article data-y=1>|</article>", '<main><article class="post" data-y=1>|</article></main>', "<main data-y=1>|</main>", '<div class="content" data-y=1>|</div>', '<div id="main"><div class="post-body" data-y=1>|</div></div>', '<section class="entry" data-y=1>|</section>', '<div id="article-body" data-y=1>|</div>', '<div class="story"><div class="text" data-y=1>|</div></div>')
        some = lambda most: "".join(self.clutter() for _ in range(r.randint(0, most)))
        head = f"<header data-y=0>{self.pick('<h1>' + w(1, 4) + '</h1>', '<a href=/>' + w(1, 3) + '</a>', '<p>' + w(2, 12) + '</p>')}{self.pick('', self.links())}</header>" if r.random() < 0.5 else ""
        nav = f"<nav data-y=0>{self.links()}</nav>" if r.random() < 0.7 else ""
        foot = f"{self.pick('<footer data-y=0>', '<footer data-y=0>', '<div class=footer data-y=0>', '<div id=copyright data-y=0>')}{self.pick('&copy; ' + w(2, 20), '<p>' + w(4, 40) + '</p>', self.links() + '<p>' + w(2, 15) + '</p>')}"
        left, right = holder.split("|")
        inner = f"{head}{nav}{some(2)}{left}{self.body()}{right}{some(3)}{foot}"
        wrap = self.pick("|", "|", '<div id="page">|', '<div class="container"><div class="row">|', "<div>|").split("|")[0]
        return f"<html><head><title>{w(2, 8)}</title></head><body>{wrap}{inner}</body></html>"


def training_rows(pages: int = 260, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all elements of generated pages; an element that holds article text is open (1)."""
    made, xs, ys = _Pages(seed), [], []
    for _ in range(pages):
        nodes, x, parents = features(parse(made.page()))
        own = np.full(len(nodes), -1)
        for i, v in enumerate(nodes):
            own[i] = int(v.attrs["data-y"]) if "data-y" in v.attrs else own[parents[i]] if i else 0
        y = own.copy()
        for i in range(len(nodes) - 1, 0, -1):
            y[parents[i]] = max(y[parents[i]], y[i])
        xs.append(x)
        ys.append(y)
    return np.concatenate(xs), np.concatenate(ys).astype(float)


@lru_cache(maxsize=4)
def train(pages: int = 260, seed: int = 5) -> BoostedTrees:
    return fit(*training_rows(pages, seed))


def extract(pages: list[str | None], model: BoostedTrees) -> list[str]:
    """Main texts of whole pages; the trees score the elements of many pages at once."""
    out: list[str] = []
    for at in range(0, len(pages), 64):
        read = [features(parse(page or "")) for page in pages[at : at + 64]]
        margins = np.split(model.margin(np.concatenate([x for _, x, _ in read])), np.cumsum([len(n) for n, _, _ in read])[:-1])
        out += ["\n".join(blocks(nodes, decode(m, parents))) for (nodes, _, parents), m in zip(read, margins, strict=True)]
    return out


def main_text(page: Column, model: BoostedTrees | None = None) -> Column:
    own = model or train()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series(extract([*some], own), dtype=object)

    return run(page)


def extract_pages(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Add the main text; the trees are trained once in the driver and sent along."""
    named = clear_of(pages, out_col)
    return named.withColumn(out_col, main_text(named[named.columns[pages.columns.index(html_col)]]))
