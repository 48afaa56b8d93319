"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements; inline elements belong to the block they stand in, and scripts, styles and
other elements whose content is no text are left out. Each node has features: its tag, the learned weights of its, its
ancestors' and its descendants' attribute tokens, text and link density of its subtree, depth, and how it compares with its
siblings, with the nearest holder of paragraphs above and with the page. The trees give each node the probability of
belonging to the main text if its parent does, and learn it from such nodes alone. Decoding goes down the tree: a node is
kept if its parent is and it likelier belongs than not, so an ancestor and a descendant never contradict each other. The text is that of the kept nodes in page order: white space within a block
becomes one space, blocks are joined by one.

Attribute tokens are the words of class, id and role, whatever they are, hashed into BUCKETS; a bucket's weight is the
smoothed log-odds of the main text among the nodes that have it. Nothing is a list of names. Weights are learned on one half
of the fitting pages and the trees on the other, so that the trees see them as they are on unknown pages.

No page states labels as such, so they come from what the features of a row don't show: of a bounded sample of the table's
own pages, from the elements that state a role, once with these elements and once with all of them turned to plain `div`s
without attributes; and of pages drawn by rule (`layout_page`), from how they were drawn, half of them with names that occur
in no other page. Null and empty pages, and pages without a kept node, give the empty text; broken markup is read as browsers
do in the common cases (elements that close each other implicitly, stray end tags, elements that end with their parent), but
an element without text that is never closed ends at the next block, so that it can't swallow the page; repeated rows are
extracted each; a null page_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches, stored

SAMPLE_PAGES = 300
LAYOUT_PAGES = 6000
TREES, DEPTH = 24, 6
FIT_TASKS = 8
#: Hash buckets of attribute tokens, and how many nodes a bucket without evidence counts as.
BUCKETS, PRIOR = 1 << 12, 4.0
#: Elements by their role in HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()) | frozenset("math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style noscript template head title svg iframe object canvas audio video textarea select option button map datalist annotation annotation-xml".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",)}
TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "pre", "figure", "body", "html", "figcaption", "dl", "dt", "dd", "tr", "th")
TAG_AT = {t: k for k, t in enumerate(TAGS)}
HEADINGS = frozenset(("h1", "h2", "h3", "h4"))
CONTROLS = frozenset(("input", "button", "select", "textarea"))
#: Elements that state a role: of the main text, and of others.
STATED, OTHERS = frozenset(("article", "main")), frozenset(("nav", "footer", "aside", "form", "header"))
#: Elements whose content is raw up to their end tag.
RAW = frozenset(("script", "style"))
NUMBERS = ("depth", "chars", "density", "links", "stops", "page_share", "children", "below", "index", "from_end", "siblings", "same_tag", "sibling_share", "top_share", "after_top", "before_top", "twins", "child_twins", "child_chars", "paragraphs", "longest", "headings", "has_h1", "after_h1", "controls", "page_twins", "in_stated", "in_other", "token_own", "token_least", "token_most", "token_below", "up_links", "up_top_share", "above_page_share", "above_top_share", "above_least_share", "above_h1", "above_headings", "above_paragraphs", "above_longest", "above_twins", "holder_share", "holder_links", "holder_up", "holder_paragraphs", "holder_siblings_share", "best_up", "best_down", "best_share", "after_best")
WIDTH = len(TAGS) + len(NUMBERS)
WORD = re.compile(r"[a-z]+")
END_TAG = re.compile(r"</([A-Za-z]+)")


class Page(HTMLParser):
    """The block tree: tag, parent and attribute tokens of each node, and the text runs in page order."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens = ["#page"], [-1], [()]
        self.runs: list[tuple[int, list[str], int]] = []  # node, parts, characters of links
        self.controls = [0]
        self.open = [0]
        self.skip: list[str] = []
        self.ends: dict[str, int] = {}
        for tag in END_TAG.findall(html):
            tag = tag.lower()
            self.ends[tag] = self.ends.get(tag, 0) + 1
        self.loose = False  # what is skipped has no end tag
        self.link = 0
        self.fresh = True
        self.feed(html)
        self.close()

    def _pop_to(self, tags: tuple[str, ...], scope: tuple[str, ...] = ()) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if tag in tags:
                del self.open[k:]
                self.fresh = True
                return
            if tag in scope:
                return

    def _ends_head(self, tag: str) -> bool:
        """An open head ends at a tag that can't stand in it; within its noscript and template only body ends the former."""
        if self.skip[:1] != ["head"]:
            return False
        return tag not in IN_HEAD if len(self.skip) == 1 else tag == "body" and "template" not in self.skip

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._ends_head(tag):
            self.skip.clear()
        if self.loose and tag not in INLINE and tag not in VOID:
            self.skip.clear()
            self.loose = False
        if self.skip:
            if tag not in VOID:
                self.skip.append(tag)
            return
        if tag in CONTROLS:
            self.controls[self.open[-1]] += 1
        if tag in NO_TEXT:
            self.skip.append(tag)
            self.loose = tag != "head" and not self.ends.get(tag)
            return
        if tag == "a":
            self.link += 1
        if tag in INLINE:
            self.fresh = self.fresh or tag in ("mtr", "mtd")
            return
        self.fresh = True
        if tag in VOID:
            return
        if tag in CLOSES_P and "p" in map(self.tag.__getitem__, self.open[-3:]):
            self._pop_to(("p",))
        if tag in CLOSES:
            self._pop_to(CLOSES[tag], SCOPE[tag])
        own: list[str] = []
        for k, v in attrs:
            if v and k in ("class", "id", "role"):
                own += WORD.findall(v.lower())
        self._add(tag, tuple(own))

    def _add(self, tag: str, tokens: tuple[str, ...]) -> None:
        self.tag.append(tag)
        self.controls.append(0)
        self.parent.append(self.open[-1])
        self.tokens.append(tokens)
        self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID and self._ends_head(tag):
            self.skip.clear()
        self.handle_starttag(tag, attrs)  # the slash means nothing

    def set_cdata_mode(self, elem: str, **kw: object) -> None:
        if elem in RAW or self.ends.get(elem):
            super().set_cdata_mode(elem, **kw)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.ends:
            self.ends[tag] -= 1
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
                self.loose = self.loose and bool(self.skip)
                return
            if tag in INLINE or (tag not in ("body", "html") and (self.skip[0] == "head" or tag not in (self.tag[k] for k in self.open))):
                return
            self.skip.clear()  # a parent's end
            self.loose = False
        if tag == "a":
            self.link = max(0, self.link - 1)
        elif tag not in INLINE and tag not in VOID:
            self._pop_to((tag,))

    def handle_data(self, data: str) -> None:
        if self.skip == ["head"] and data.strip():
            self.skip.clear()
        if self.skip:
            return
        if self.open == [0] and data.strip():
            # text outside of all elements stands in a body that isn't written
            self._add("body", ())
        node = self.open[-1]
        if self.fresh or not self.runs or self.runs[-1][0] != node:
            self.runs.append((node, [], 0))
            self.fresh = False
        run = self.runs[-1]
        run[1].append(data)
        if self.link:
            self.runs[-1] = (run[0], run[1], run[2] + len(data))

    def blocks(self) -> list[tuple[int, str, int]]:
        """(node, text, characters of links) of the runs that are not blank."""
        out = []
        for node, parts, links in self.runs:
            if text := " ".join("".join(parts).split()):
                out.append((node, text, min(links, len(text))))
        return out


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def features(page: Page, blocks: list[tuple[int, str, int]], weights: np.ndarray) -> np.ndarray:
    """A row for each node, the page's root first."""
    n = len(page.tag)
    x = np.zeros((n, WIDTH), np.float32)
    chars, links, stops, below, kids = [0] * n, [0] * n, [0] * n, [0] * n, [[] for _ in range(n)]
    depth, stated, others, longest, paragraphs, headings, h1 = ([0] * n for _ in range(7))
    controls = list(page.controls)
    own, least, most, down = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    first_h1 = n
    for node, text, link in blocks:
        c = len(text)
        chars[node] += c
        links[node] += link
        stops[node] += text.count(".") + text.count(",")
        longest[node] = max(longest[node], c)
        paragraphs[node] += c >= 60
    sign = list(zip(page.tag, page.tokens, strict=True))
    same_sign = Counter(sign)
    for i in range(1, n):
        p, tag = page.parent[i], page.tag[i]
        kids[p].append(i)
        depth[i] = depth[p] + 1
        if (k := TAG_AT.get(tag)) is not None:
            x[i, k] = 1
        if page.tokens[i]:
            w = [weights[bucket(t)] for t in page.tokens[i]]
            own[i] = max(w, key=abs)
        down[i] = own[i]
        least[i], most[i] = min(least[p], own[i]), max(most[p], own[i])
        stated[i] = int(stated[p] or tag in STATED)
        others[i] = int(others[p] or tag in OTHERS)
        if tag in HEADINGS:
            headings[i] = 1
            if tag == "h1":
                h1[i] = 1
                first_h1 = min(first_h1, i)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
        below[p] += below[i] + 1
        longest[p] = max(longest[p], longest[i])
        paragraphs[p] += paragraphs[i]
        headings[p] += headings[i]
        h1[p] += h1[i]
        controls[p] += controls[i]
        down[p] = max(down[p], down[i])
    whole = max(chars[0], 1)
    top = [max(near, key=lambda i: (chars[i], -i)) if near else 0 for near in kids]
    share = [1.0] * n
    up_links, up_share = [0.0] * n, [1.0] * n
    for i in range(1, n):
        p = page.parent[i]
        share[i] = chars[i] / max(chars[top[p]], 1)
        up_links[i] = max(up_links[p], links[i] / max(chars[i], 1) if chars[i] else 0.0)
        up_share[i] = min(up_share[p], share[i])
    # the nearest node above that holds a paragraph, and how far up it is
    holder, up = [0] * n, [0] * n
    # characters of the paragraphs that stand in a node itself; the node with most of them is the best one
    held = [0] * n
    for i in range(1, n):
        p = page.parent[i]
        holder[i], up[i] = (p, 1) if paragraphs[p] else (holder[p], up[p] + 1)
        if not kids[i] and chars[i] >= 40 and 3 * links[i] <= chars[i]:
            held[p] += chars[i]
    best = max(range(n), key=lambda i: (held[i], -i))
    on_path, k = {}, best
    while k >= 0:
        on_path[k] = len(on_path)
        k = page.parent[k]
    meet, rise = [best if i == best else 0 for i in range(n)], [0] * n
    for i in range(1, n):
        meet[i], rise[i] = (i, 0) if i in on_path else (meet[page.parent[i]], rise[page.parent[i]] + 1)
    rows, twins = [], [1] * n
    for p, near in enumerate(kids):
        if not near:
            continue
        tags, signs = Counter(page.tag[i] for i in near), Counter(sign[i] for i in near)
        for k, i in enumerate(near):
            c, m = max(chars[i], 1), kids[i]
            twin = max(Counter(sign[j] for j in m).values()) / len(m) if len(m) > 1 else 0.0
            rows.append((i, (min(depth[i], 20), min(chars[i], 5000), min(chars[i] / (below[i] + 1), 1000), links[i] / c, min(stops[i] / c, 0.2), chars[i] / whole, min(len(m), 50), min(below[i], 200), min(k, 50), min(len(near) - 1 - k, 50), min(len(near), 50), min(tags[page.tag[i]], 50), chars[i] / max(chars[p], 1), share[i], float(i > top[p]), float(i < top[p]), min(signs[sign[i]], 50), twin, min(chars[i] / max(len(m), 1), 1000), min(paragraphs[i], 50), min(longest[i], 1000), min(headings[i], 20), min(h1[i], 2), float(i >= first_h1), min(controls[i], 20), min(same_sign[sign[i]], 50), stated[i], others[i], own[i], least[i], most[i], down[i], up_links[i], up_share[i], chars[p] / whole, share[p], up_share[p], min(h1[p], 2), min(headings[p], 20), min(paragraphs[p], 50), min(longest[p], 1000), twins[p], chars[holder[i]] / whole, links[holder[i]] / max(chars[holder[i]], 1), min(up[i], 10), min(paragraphs[holder[i]], 50), share[holder[i]], min(rise[i], 10), min(on_path[meet[i]], 10), chars[meet[i]] / whole, float(i > best))))
            twins[i] = min(signs[sign[i]], 50)
    if rows:
        x[[r[0] for r in rows], len(TAGS) :] = np.array([r[1] for r in rows], np.float32)
    return x


def decode(parent: list[int], p: np.ndarray) -> list[bool]:
    """Which nodes are kept, from the root, which counts as kept, down: a node is if its parent is and p, its probability if its parent belongs to the main text, is over a half."""
    kept = [True] * len(parent)
    for i in range(1, len(parent)):
        kept[i] = kept[parent[i]] and float(p[i]) > 0.5
    return kept


class Trees(NamedTuple):
    """Flat regression trees: at node k go left if x[feature] <= threshold; leaves have feature -1."""

    feature: list[np.ndarray]
    threshold: list[np.ndarray]
    left: list[np.ndarray]
    right: list[np.ndarray]
    value: list[np.ndarray]
    weights: list[float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, t, a, b, v, w in zip(*self, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                own = f[at]
                leaf = own < 0
                if leaf.all():
                    break
                down = x[rows, np.maximum(own, 0)] <= t[at]
                at = np.where(leaf, at, np.where(down, a[at], b[at]))
            margin += w * v[at]
        return 1 / (1 + np.exp(-2 * margin))


def exported(model) -> Trees:
    """The trees of a fitted MLlib model; all splits are on continuous features."""
    out = Trees([], [], [], [], [], list(model.treeWeights))
    for tree in model.trees:
        f, t, a, b, v = [], [], [], [], []

        def walk(node) -> int:
            k = len(f)
            f.append(-1), t.append(0.0), a.append(0), b.append(0), v.append(node.prediction())
            if node.subtreeDepth() > 0:
                f[k], t[k] = node.split().featureIndex(), node.split().threshold()
                a[k] = walk(node.leftChild())
                b[k] = walk(node.rightChild())
            return k

        walk(tree._java_obj.rootNode())
        for held, x in zip(out[:5], (f, t, a, b, v), strict=True):
            held.append(np.array(x))
    return out


def stated_labels(page: Page) -> list[int] | None:
    """1 for nodes in an article or main element, its header included, or above one, 0 for others and for what stands in elements of another role; None if no element states the main text."""
    if STATED.isdisjoint(page.tag):
        return None
    n = len(page.tag)
    out, inside, away = [0] * n, [False] * n, [False] * n
    for i in range(1, n):
        p = page.parent[i]
        # the header of an article has its title
        away[i] = away[p] or (page.tag[i] in OTHERS and not (page.tag[i] == "header" and inside[p]))
        inside[i] = inside[p] or page.tag[i] in STATED
        out[i] = int(inside[i] and not away[i])
    return above(page, out)


def above(page: Page, out: list[int]) -> list[int]:
    for i in range(len(out) - 1, 0, -1):
        if out[i]:
            out[page.parent[i]] = 1
    return out


def masked(page: Page) -> None:
    """Takes away what states a role: elements become div, attribute tokens go."""
    page.tag = ["div" if t in STATED or t in OTHERS else t for t in page.tag]
    page.tokens = [()] * len(page.tokens)


#: Names that drawn layouts use for a role, besides invented ones.
NAMES = {
    "main": ("article", "content", "main", "post", "entry", "story", "text", "body"), "header": ("header", "masthead", "banner", "top"), "menu": ("menu", "nav", "navbar", "navigation", "links", "breadcrumb"),
    "notice": ("notice", "cookie", "alert", "consent", "modal", "popup"), "ad": ("ad", "ads", "advert", "promo", "sponsored"), "form": ("search", "login", "newsletter", "subscribe", "signup", "form"),
    "side": ("sidebar", "aside", "related", "widget", "more"), "share": ("share", "social", "tags", "meta"), "comments": ("comments", "comment", "replies", "discussion", "responses", "disqus"), "footer": ("footer", "legal", "copyright", "bottom"),
}
ELEMENT = {"header": "header", "menu": "nav", "form": "form", "side": "aside", "footer": "footer", "main": "article"}


def layout_page(seed: int, invented: bool | None = None) -> tuple[str, list[str]]:
    """A page of a layout drawn by rule, and the blocks of its main text. With `invented` no role is stated: all elements are plain and all names made up; by default so are half of the pages."""
    r = random.Random(seed)
    invented = r.random() < 0.5 if invented is None else invented
    letters = r.choice(["bcdfglmnprst", "hjkvwz", "bdgmnrst"])
    word = lambda: "".join(r.choice(letters) + r.choice("aeiou") for _ in range(r.randint(1, 4)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + r.choice([".", ".", ".", ",", ""])
    text = lambda most=8: " ".join(sentence(r.randint(3, 14)) for _ in range(r.choice([1, 2, r.randint(1, most)])))
    kept: list[str] = []
    used: dict[str, str] = {}

    def attribute(role: str) -> str:
        if invented:
            name = used.setdefault(role, r.choice(["", f"{word()}{r.randint(1, 9)}", word() + word(), f"{word()}-{word()}"]))
        else:
            name = r.choice(["", "site-", "page ", "box ", "main-" if role != "main" else ""]) + r.choice(NAMES[role])
        return f' {r.choice(["class", "class", "id"])}="{name}"' if name else ""

    def wrap(role: str, body: str) -> str:
        tag = "div" if invented else r.choice(["div", "div", "section", ELEMENT.get(role, "div")])
        plain = tag == ELEMENT.get(role) and r.random() < 0.5
        return f"<{tag}{'' if plain else attribute(role)}>{body}</{tag}>"

    def items(n: int) -> str:
        links = [f'<a href="/{k}">{sentence(r.randint(1, 4))}</a>' for k in range(n)]
        style = r.randrange(4)
        if style < 2:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
        return "".join(f"<div>{x}</div>" for x in links) if style == 2 else f"<p>{' | '.join(links)}</p>"

    def comments() -> str:
        style, own = r.randrange(4), attribute("comments") if r.random() < 0.6 else ""
        who = lambda: r.choice([f"<b>{word().title()}</b> ", f"<div>{word().title()} {r.randint(1, 28)}</div>", f"<h4>{word().title()}</h4>", f"<span>{word()}</span>: ", ""])
        each = [f"<p>{who()}{text(3)}</p>" if style == 0 else f"<div{own}>{who()}<p>{text(3)}</p></div>" if style < 3 else f"<li{own}>{who()}{text(3)}</li>" for _ in range(r.randint(1, 7))]
        head = r.choice(["", f"<h3>{r.randint(2, 99)} {word()}</h3>", f"<h2>{word().title()}</h2>", f"<h3>{word().title()} ({len(each)})</h3>"])
        tail = r.choice(["", "", f"<form><textarea></textarea><button>{word()}</button></form>", f'<a href="#">{word()}</a>'])
        return wrap("comments", head + (f"<ul>{''.join(each)}</ul>" if style == 3 else "".join(each)) + tail)

    def other(role: str) -> str:
        if role == "comments":
            return comments()
        if role == "menu" or (role in ("side", "share", "footer", "header") and r.random() < 0.5):
            title = f"<h3>{sentence(2)}</h3>" if role == "side" and r.random() < 0.6 else ""
            return wrap(role, title + items(r.randint(2, 9)))
        if role == "form":
            return wrap(role, f"<p>{sentence(r.randint(2, 8))}</p><input name=q><label>{word()}</label><button>{word()}</button>")
        if role in ("ad", "side") and r.random() < 0.5:
            return wrap(role, f'<h3>{sentence(3)}</h3><p>{sentence(9)} <a href="/x">{sentence(2)}</a></p>')
        return wrap(role, r.choice([sentence(r.randint(2, 14)), f"<p>{sentence(r.randint(3, 20))}</p>", f"<p>{sentence(6)} <a href=/y>{word()}</a></p>"]))

    def own(t: str) -> str:
        """t, a block of the main text."""
        kept.append(t)
        return t

    def short() -> str:
        return r.choice([word(), f"{r.randint(1, 9999)} {word()}", sentence(r.randint(1, 4)), sentence(r.randint(3, 9))])

    def linked(t: str) -> str:
        """t, now and then with inline elements that don't change it."""
        words = t.split(" ")
        if len(words) > 4 and r.random() < 0.25:
            k = r.randrange(len(words))
            words[k] = r.choice(["<a href=/z>{}</a>", "<em>{}</em>", "<code>{}</code>", "<b>{}</b>"]).format(words[k])
        return " ".join(words)

    def table() -> str:
        wide, head = r.randint(2, 4), r.random() < 0.5
        row = lambda tag: "<tr>" + "".join(f"<{tag}>{own(short())}</{tag}>" for _ in range(wide)) + "</tr>"
        inner = (f"<thead>{row('th')}</thead>" if head and r.random() < 0.5 else row("th") if head else "") + "".join(row("td") for _ in range(r.randint(1, 5)))
        return f"<table>{inner}</table>"

    def items_of_text() -> str:
        tag, long, deep = r.choice(["ul", "ol"]), r.random() < 0.4, r.random() < 0.15
        each = [f"<li>{'<p>' if deep else ''}{linked(own(text(3) if long else short()))}{'</p>' if deep else ''}</li>" for _ in range(r.randint(1, 7))]
        return f"<{tag}>{''.join(each)}</{tag}>"

    def quote(level: int = 0) -> str:
        inner = own(sentence(r.randint(2, 12))) if r.random() < 0.5 else "".join(f"<p>{own(text(3))}</p>" for _ in range(r.randint(1, 3)))
        return f"<blockquote>{inner}{quote(1) if not level and r.random() < 0.2 else ''}</blockquote>"

    def figure() -> str:
        caption = f"<figcaption>{own(sentence(r.randint(2, 12)))}</figcaption>" if r.random() < 0.8 else ""
        return f"<figure><img src=/{word()}.png>{caption}</figure>"

    def terms() -> str:
        return "<dl>" + "".join(f"<dt>{own(short())}</dt><dd>{own(text(2) if r.random() < 0.4 else short())}</dd>" for _ in range(r.randint(1, 5))) + "</dl>"

    def piece(level: int) -> str:
        kind = r.random()
        if kind < 0.08:
            return f"<{(h := r.choice(['h2', 'h2', 'h3', 'h4']))}>{own(sentence(r.randint(1, 8)))}</{h}>"
        if kind < 0.16:
            return items_of_text()
        if kind < 0.2:
            return quote()
        if kind < 0.24:
            return table()
        if kind < 0.28:
            return figure()
        if kind < 0.32:
            return terms()
        if kind < 0.35:
            lines = [" ".join(word() for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 6))]
            own(" ".join(lines))
            return "<pre>" + "\n  ".join(lines) + "</pre>"
        if kind < 0.4:
            return f"<div>{own(text())}</div>"
        if kind < 0.46:
            return f"<p><b>{own(text())}<br>"
        if kind < 0.54 and level < 2:
            tag = "div" if invented else r.choice(["section", "section", "div"])
            size = r.choice([2, 3, 4])
            head = f"<h{size}>{own(sentence(r.randint(1, 7)))}</h{size}>" if r.random() < 0.8 else ""
            return f"<{tag}>{head}{''.join(piece(level + 1) for _ in range(r.randint(1, 4)))}</{tag}>"
        return f"<p>{linked(own(text() if r.random() < 0.85 else sentence(r.randint(1, 4))))}</p>"

    def body() -> str:
        out = []
        if r.random() < 0.8:
            title = f"<h1>{own(sentence(r.randint(2, 9)))}</h1>"
            out.append(f"<{(t := 'div' if invented else r.choice(['header', 'div']))}>{title}</{t}>" if r.random() < 0.15 else title)
        sections = r.random() < 0.35
        for _ in range(r.randint(1, 4) if sections else r.randint(1, 10)):
            if sections:
                tag = "div" if invented else r.choice(["section", "div"])
                out.append(f"<{tag}><h2>{own(sentence(r.randint(1, 7)))}</h2>{''.join(piece(1) for _ in range(r.randint(1, 4)))}</{tag}>")
            else:
                out.append(piece(0))
            if r.random() < 0.05:
                out.append(other(r.choice(["ad", "share", "form"])))
        return "".join(out)

    if r.random() < 0.03:
        # a page without block elements
        t = text()
        page = r.choice(["<html><body>{}</body></html>", "<body>{}", "{}"]).format(linked(own(t)))
        return page, [" ".join(x.split()) for x in kept]

    before = [other(x) for x in r.sample(["header", "menu", "menu", "ad", "notice", "form"], r.randint(0, 4))]
    after = [other(x) for x in r.sample(["footer", "side", "comments", "comments", "share", "ad", "form", "menu"], r.randint(0, 5))]
    middle = wrap("main", body() + (other(r.choice(["comments", "share"])) if r.random() < 0.2 else ""))
    if r.random() < 0.4:
        middle = f"<div{r.choice(['', ' class=wrap', ' id=page'])}>{other('side') if r.random() < 0.3 else ''}{middle}{other(r.choice(['side', 'comments'])) if r.random() < 0.5 else ''}</div>"
    whole = "".join([*before, middle, *after]) if r.random() < 0.85 else middle
    for _ in range(r.choice([0, 0, 0, 1, 2])):
        whole = f"<div{r.choice(['', ' class=outer', ' id=root'])}>{whole}</div>"
    head = f"<head><title>{word()}</title></head>"
    page = r.choice([f"<!DOCTYPE html><html>{head}<body>{whole}</body></html>", f"<html>{head}<body>{whole}</body></html>", f"<html>{head}<body>{whole}", f"<body>{whole}</body>", whole])
    return page, [" ".join(t.split()) for t in kept]


def layout_labels(page: Page, blocks: list[tuple[int, str, int]], kept: list[str]) -> list[int]:
    """1 for nodes that hold a block of the main text, and for those above them."""
    out, wanted = [0] * len(page.tag), set(kept)
    for node, t, _ in blocks:
        if t in wanted:
            out[node] = 1
    return above(page, out)


def _fitting_pages(html: str, seed: int | None) -> Iterator[tuple[Page, list[tuple[int, str, int]], list[int]]]:
    """The pages to learn from, with labels: a drawn one; or a given one as it is and masked, if it states its main text."""
    if seed is not None:
        html, kept = layout_page(seed)
    page = Page(html)
    blocks = page.blocks()
    labels = stated_labels(page) if seed is None else layout_labels(page, blocks, kept)
    if labels is not None and len(page.tag) > 1:
        yield page, blocks, labels
        if seed is None:
            masked(page)
            yield page, blocks, labels


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in slices(batches, "html"):
        n, hit = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for html, seed in zip(s.column(0).to_pylist(), s.column(1).to_pylist(), strict=True):
            for page, _, labels in _fitting_pages(html, seed):
                for tokens, label in zip(page.tokens, labels, strict=True):
                    at = [bucket(t) for t in tokens]
                    n[at] += 1
                    hit[at] += label
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(hit[at])], names=["bucket", "n", "hit"])


class Model(NamedTuple):
    weights: np.ndarray
    trees: Trees


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, layout_pages: int = LAYOUT_PAGES, html: str = "html", page_id: str = "page_id") -> Model:
    """Fits weights and trees on at most sample_pages of the table and layout_pages drawn ones."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    spark = pages.sparkSession
    small_batches(spark)
    own = pages.select(F.col(html).cast("string").alias("html"), F.pmod(F.xxhash64(F.col(page_id).cast("string")), F.lit(1_000_003)).alias("h")).filter("html <> ''")
    share = 3.0 * sample_pages / max(own.count(), 1)
    own = own.filter(F.col("h") < share * 1_000_003).orderBy("h", F.sha2("html", 256)).limit(sample_pages).select("html", F.lit(None).cast("long").alias("seed"), (F.col("h") % 2).alias("half"))
    drawn = spark.range(0, layout_pages, numPartitions=2).select(F.lit("").alias("html"), F.col("id").alias("seed"), (F.col("id") % 2).alias("half"))
    # a few rows that each cost much: spread by hand, over a fixed number of tasks
    every = stored(own.unionByName(drawn)).repartition(FIT_TASKS)

    counts = every.filter("half = 0").select("html", "seed").mapInArrow(_token_rows, "bucket long, n long, hit long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("hit").alias("hit")).collect()
    weights = np.zeros(BUCKETS)
    for row in counts:  # at most BUCKETS
        weights[row["bucket"]] = np.log((row["hit"] + PRIOR / 2) / (row["n"] - row["hit"] + PRIOR / 2))
    shared = spark.sparkContext.broadcast(weights)

    def node_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "html"):
            for html, seed in zip(s.column(0).to_pylist(), s.column(1).to_pylist(), strict=True):
                for page, blocks, labels in _fitting_pages(html, seed):
                    # only nodes whose parent belongs to the main text: what the trees give is conditional on that
                    at = [i for i in range(1, len(labels)) if page.parent[i] == 0 or labels[page.parent[i]]]
                    x = features(page, blocks, shared.value)[at]
                    rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, WIDTH), pa.int32()), pa.array(x.ravel().astype(float)))
                    yield pa.RecordBatch.from_arrays([rows, pa.array([labels[i] for i in at], pa.float64())], names=["x", "label"])

    data = every.filter("half = 1").select("html", "seed").mapInArrow(node_rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.35, maxBins=32, seed=7, minInstancesPerNode=5).fit(data)
    data.unpersist()
    return Model(weights, exported(model))


def extract(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    df = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    schema = df.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for s in slices(batches, "html", 1 << 20):
            pages_ = [Page(h or "") for h in s.column(2).to_pylist()]
            blocks = [p.blocks() for p in pages_]
            x = [features(p, b, model.weights) for p, b in zip(pages_, blocks, strict=True)]
            edge = np.cumsum([0, *map(len, x)])
            prob = model.trees.probability(np.concatenate(x)) if edge[-1] else np.zeros(0)
            texts = []
            for k, (p, own) in enumerate(zip(pages_, blocks, strict=True)):
                kept = decode(p.parent, prob[edge[k] : edge[k + 1]])
                texts.append(" ".join(t for node, t, _ in own if kept[node]))
            yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return df.mapInArrow(run, schema)
