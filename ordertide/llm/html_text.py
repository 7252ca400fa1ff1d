"""Operator 4: main text of web pages by tree scoring.

A page is read into a light tree. Every paragraph-like block earns points for its length and its commas
and passes them to its ancestors, less with each step; a container's sum is discounted by the share of
its text that is in links. The best container, raised to the article or main element around it, and
those of its siblings that score well are kept; menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments inside them are cut by element, role, class or id, or, outside
of an article element, as lists of links. A class, id or role is a mark if all its words are; a marked part
that holds the article itself is kept. Blocks keep the page's order.

Edge cases. Null, empty and textless html give an empty text. Repeated rows give a row each; an empty table
gives none; among equally good containers the first one counts. Very long and broken pages take time in
proportion to their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.rows import map_texts

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe noembed noframes xmp".split())
CUT = frozenset("script style noscript textarea title iframe noembed noframes head nav aside footer form button select option label template svg canvas object audio video dialog menu input".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
WHOLE = frozenset(("article", "main"))
ENDS_P = BLOCK - {"body", "html"}
#: Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices notification alert comment comments commentlist disqus replies respond sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead topbar share sharing social related recommended newsletter subscribe signup login popup modal "
    "overlay pagination pager widget toolbar skip search contentinfo complementary dialog".split()
)
#: Words that say where or how a marked part stands, and nothing of what it holds.
NEUTRAL = frozenset(
    "a area bar block body bottom box bg center col column container content element fixed float footer full global group head "
    "holder horizontal icon id in inner inline item items js label layer layout left link links list main mobile module nav on "
    "one outer page pane panel part primary region right row secondary section site slot sticky sub three title top two unit "
    "vertical widget wrap wrapper zone".split()
)
_START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_STOP = re.compile("[>\"']")
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_UNSEEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|style\s*=\s*(?:\"[^\"]*|'[^']*|)display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: How far up points go, and the share of the best score that a sibling needs.
REACH, SIBLING = 5, 0.2
#: Share of a page's points that marked parts must leave to the rest; else one of them holds the article.
REST = 0.2


class Node:
    __slots__ = ("name", "cut", "marked", "parent", "items", "score", "mass", "chars", "linked", "links", "blocks")

    def __init__(self, name: str, parent: Node | None, cut: bool, marked: bool = False):
        self.name, self.parent, self.cut, self.marked = name, parent, cut, marked
        self.items: list = []
        self.reset()

    def reset(self) -> None:
        self.score, self.mass, self.chars, self.linked, self.links, self.blocks = 0.0, 0.0, 0, 0, 0, False


def _marked(name: str, attributes: str) -> bool:
    """Whether a class, id or role is made of marks, beside words that say nothing of what the element holds."""
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _NAMED.finditer(attributes):
        for token in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _PARTS.findall(token)]
            if any(w in MARKS for w in words) and all(w in MARKS or w in NEUTRAL for w in words):
                return True
    return False


def _hidden(attributes: str) -> bool:
    return bool(attributes) and bool(_UNSEEN.search(attributes) or _HIDDEN.search(_VALUE.sub("=", attributes)))


class _Reader:
    """Reads a page in one pass: each character is looked at a bounded number of times, however broken it is."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.root = self.node = Node("html", None, False)
        #: Open elements by name, within the innermost article or main and around it.
        self.open: list[dict[str, int]] = [{}]
        self.gone: set[str] = set()
        self.loose = False

    def descend(self, child: Node) -> None:
        if child.name in WHOLE:
            self.open.append({})
        scope = self.open[-1]
        scope[child.name] = scope.get(child.name, 0) + 1
        self.node = child

    def leave(self, node: Node) -> None:
        """Close ``node`` and everything open in it."""
        while self.node is not node.parent:
            scope = self.open[-1]
            scope[self.node.name] -= 1
            if self.node.name in WHOLE:
                self.open.pop()
            self.node = self.node.parent

    def find(self, text: str, at: int) -> int:
        """Where ``text`` stands next; one that is not there is not searched again."""
        found = -1 if text in self.gone else self.html.find(text, at)
        if found < 0:
            self.gone.add(text)
        return found

    def tag_end(self, at: int) -> int:
        """Where the tag's > is. A quote counts behind an equals sign, and if it is closed."""
        html, start = self.html, at
        while not self.loose:
            m = _STOP.search(html, at)
            if m is None:
                # All that is left is in quotes: from here on they do not count.
                self.loose = True
                break
            if m[0] == ">":
                return m.start()
            before = m.start() - 1
            while before > start and html[before].isspace():
                before -= 1
            at = m.end()
            if html[before] == "=":
                closed = self.find(m[0], at)
                at = closed + 1 if closed >= 0 else at
        return html.find(">", start)

    def closing(self, name: str) -> None:
        if self.open[-1].get(name):
            up = self.node
            while up.name != name:
                up = up.parent
            self.leave(up)

    def opening(self, name: str, attributes: str, at: int) -> int:
        """Take up an element; gives where to read on, -1 for nowhere."""
        if name in ("html", "body"):
            return at
        if name in ENDS_P and self.open[-1].get("p"):
            up, last = self.node, None
            while up is not self.root and (up.name == "p" or up.name not in BLOCK):
                last = up if up.name == "p" else last
                up = up.parent
            if last is not None:
                self.leave(last)
        if name in ("li", "td", "th", "tr", "dd", "dt", "option") and self.node.name == name:
            self.leave(self.node)
        header = name == "header" and len(self.open) == 1
        child = Node(name, self.node, name in CUT or header or _hidden(attributes), _marked(name, attributes))
        self.node.items.append(child)
        if name in RAW:
            end = None if name in self.gone else re.compile(f"</{name}\\b[^>]*>?", re.I).search(self.html, at)
            if end is None:
                self.gone.add(name)
                return -1 if name in ("script", "style") else at
            child.items.append(self.html[at : end.start()])
            return end.end()
        if name not in VOID and (not attributes.endswith("/") or name in ("p", "div", "b", "i", "a", "span", "li")):
            self.descend(child)
        return at

    def read(self) -> Node:
        html, at = self.html, 0
        while at >= 0:
            m = _START.search(html, at)
            if m is None or (m[1] is None and m.start() > self.last):
                self.node.items.append(html[at:])
                break
            if m.start() > at:
                self.node.items.append(html[at : m.start()])
            if m[1]:
                end = self.find("-->", m.end())
                at = end + 3 if end >= 0 else -1
                continue
            end = self.tag_end(m.end())
            at = end + 1
            if m[3] is None:
                continue
            if m[2]:
                self.closing(m[3].lower())
            else:
                at = self.opening(m[3].lower(), html[m.end() : end], at)
        return self.root


def parse(html: str) -> Node:
    """The tree of a page; tags that are never closed end with their parent or with the next block."""
    return _Reader(html).read()


def _nodes(root: Node) -> list[Node]:
    """All nodes that are not cut, parents first."""
    order = [root]
    for node in order:
        order += [x for x in node.items if isinstance(x, Node) and not x.cut]
    return order


def _judge_marks(root: Node) -> None:
    """Cut marked parts, but not one that holds what the rest of the page lacks: the article.

    They are cut as they are if an article or main with text, or ``REST`` of all points, is outside of them.
    Otherwise the one with the most points is no mark's, and what is marked inside it is judged in its turn.
    """
    marked = [n for n in _nodes(root) if n.marked]
    if not marked:
        return
    _measure(root)
    while True:
        inside: set[int] = set()
        top = []
        for node in _nodes(root):
            if node.parent is not None and id(node.parent) in inside:
                inside.add(id(node))
            elif node.marked:
                inside.add(id(node))
                top.append(node)
        whole = any(n.name in WHOLE and n.chars and id(n) not in inside for n in _nodes(root))
        rest = root.mass - sum(n.mass for n in top)
        most = max(top, key=lambda n: n.mass, default=None)
        if whole or most is None or not most.mass or rest >= REST * root.mass:
            break
        most.marked = False
    for node in _nodes(root):
        node.reset()
    for node in marked:
        node.cut = node.cut or node.marked


def _measure(root: Node) -> None:
    """Points of blocks passed upwards, and text, link text and links of every node."""
    for node in reversed(_nodes(root)):
        own = "".join(x for x in node.items if isinstance(x, str))
        node.chars += len(own.strip())
        if node.name == "a":
            node.linked, node.links = node.chars, 1
        up = node.parent
        if node.name in BLOCK and not node.blocks:
            flat = _flat(node)
            if len(flat) >= 25 and node.linked < 0.5 * max(1, node.chars):
                points = 1 + flat.count(",") + min(len(flat) / 100, 3.0)
                node.mass = points
                to, step = up or node, 1
                while to is not None and step <= REACH:
                    to.score += points / step
                    to, step = to.parent, step + (1 if step < 2 else 2)
        if up is not None:
            up.chars += node.chars
            up.linked += node.linked
            up.links += node.links
            up.mass += node.mass
            up.blocks = up.blocks or node.blocks or node.name in BLOCK


def _flat(node: Node) -> str:
    return " ".join("".join(_strings(node)).split())


def _strings(node: Node) -> Iterator[str]:
    stack: list = list(reversed(node.items))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            yield x
        elif not x.cut:
            stack += reversed(x.items)


def _rank(node: Node) -> float:
    return node.score * (1 - node.linked / max(1, node.chars))


def _link_list(node: Node) -> bool:
    return node.links > 1 and node.name in ("ul", "ol", "div", "table", "section", "dl") and node.linked > 0.6 * max(1, node.chars)


def _best(root: Node) -> list[Node]:
    nodes, order = [root], []
    for node in nodes:
        if not node.cut:
            order.append(node)
            nodes += [x for x in node.items if isinstance(x, Node)]
    best = max(order, key=_rank)
    if _rank(best) <= 0:
        wholes = [x for x in order if x.name in WHOLE]
        return wholes[:1] or [root]
    up = best
    while up is not None:
        if up.name in WHOLE:
            best = up
        up = up.parent
    if best.parent is None:
        return [best]
    least = SIBLING * _rank(best)
    siblings = [x for x in best.parent.items if isinstance(x, Node) and not x.cut]
    if best.name in WHOLE:
        return [x for x in siblings if x is best or (x.name == best.name and _rank(x) >= least)]
    return [x for x in siblings if x is best or _heading(x) or (_rank(x) >= least and not _link_list(x)) or (x.name == "p" and x.linked < 0.25 * max(1, x.chars))]


def _heading(node: Node) -> bool:
    return len(node.name) == 2 and node.name[0] == "h" and node.name[1] in "123456"


def _blocks(node: Node, blocks: list[list[str]]) -> None:
    """Text by blocks. Lists of links are menus unless they stand in an article or main."""
    stack: list = [node]
    written = node.name in WHOLE
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            blocks[-1].append(x)
        elif x is None:
            blocks.append([])
        elif x.name == "br":
            blocks[-1].append(" ")
        elif not x.cut and (written or not _link_list(x)):
            if x.name in BLOCK:
                blocks.append([])
                stack.append(None)
            stack += reversed(x.items)


def main_text(html: str | None) -> str:
    """The blocks of the main text, one a line; empty for null, empty or textless pages."""
    if not html:
        return ""
    root = parse(html)
    _judge_marks(root)
    _measure(root)
    blocks: list[list[str]] = [[]]
    for node in _best(root):
        blocks.append([])
        _blocks(node, blocks)
    lines = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``row``, text and n_chars of every row of ``pages``; any other columns are left alone."""

    def fn(pages_html: list) -> dict:
        texts = [main_text(h) for h in pages_html]
        return {"main": texts, "n_chars": list(map(len, texts))}

    return map_texts(pages, html_col, fn, "main string, n_chars bigint", 1_000_000)


def extraction_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page. Null html gives an empty text."""
    done = extract_pages(pages.select("page_id", "url", "html"))
    return done.select("row.page_id", "row.url", F.col("main").alias("text"), "n_chars")
