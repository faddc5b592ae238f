"""The main content of a page: a tree of its elements, densities from the leaves up, the best subtree.

Every block of text is worth its words outside links, less those inside links and a constant, so that
menus, lists of links and captions are worth less than nothing. An element is worth the sum of its
blocks. From the body down, the way goes to a child as long as that child alone is worth nearly as
much as all of its siblings; where it ends stands the content, of which parts that consist of links,
or are named as something else, are left out. Names in class, id and role are hints only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

#: Elements that are no content, whatever they hold.
DROPPED = {"script", "style", "nav", "header", "footer", "aside", "noscript", "template", "svg", "form", "button", "iframe", "select", "dialog", "head", "title"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements of the head, and those that may stand inside a paragraph.
_HEAD = {"title", "meta", "link", "script", "style", "base", "noscript", "template"}
_ANYWHERE = {"script", "style", "noscript", "template", "svg", "iframe", "button", "select", "input", "link", "meta"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "font"}
#: What an element's start closes, if it is open in the same container.
_CLOSES = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_CONTAINERS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "html", "blockquote"}
_OTHER = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disclaimer|foot(?:er)?|menu|nav\w*|newsletter|pagination|pager|popup|promo\w*|recommend\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|tags?|teasers?|toolbar|widget|complementary|contentinfo|navigation)(?:$|[\s_-])")
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|main|post|story|text)(?:$|[\s_-])")
_BYLINE = re.compile(r"(?:^|[\s_-])(?:author|byline|autor\w*|firma)(?:$|[\s_-])")
_BY = re.compile(r"^(?:by|por|von|par|di)\s+", re.I)

#: What a block must be worth: words beyond this, and as much more for each word inside a link.
COST, LINKED = 6, 2
#: The share of its siblings' worth that a child must have alone to be followed.
DOMINANT = 0.8


class Node:
    """An element: tag, attributes, children (elements and texts), and what is counted below it."""

    __slots__ = ("tag", "attrs", "children", "words", "linked", "worth", "other")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.words = self.linked = 0
        self.worth = 0.0
        named = " ".join(attrs.get(k, "") for k in ("class", "id", "role")).lower()
        self.other = tag in DROPPED or bool(named and tag not in ("html", "body", "article", "main") and _OTHER.search(named) and not _CONTENT.search(named)) or "hidden" in attrs

    def below(self) -> Iterator[Node]:
        """This element and all below it, in the order of the page."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack += reversed(node.children)
        return " ".join("".join(out).split())


class Tree(HTMLParser):
    """Elements of any page, however badly it is closed; depth is bounded, so that deep nesting is flat from there."""

    DEPTH = 400

    def __init__(self):
        super().__init__()
        self.root = Node("html", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            for k, v in attrs:
                self.root.attrs[k] = self.root.attrs.get(k) or v or ""
            return
        if tag == "body":
            if any(n.tag == "body" for n in self.open):
                return
            del self.open[1:]
        elif self.open[-1].tag == "head" and tag not in _HEAD:
            self.open.pop()
        if tag not in _INLINE and tag not in _ANYWHERE:
            k = len(self.open) - 1
            while k and self.open[k].tag in _INLINE:
                k -= 1
            if k and self.open[k].tag == "p":
                del self.open[k:]
        closes = _CLOSES.get(tag, ())
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in closes:
                del self.open[k:]
                break
            if self.open[k].tag in _CONTAINERS:
                break
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].children.append(node)
        if tag not in _VOID and len(self.open) < self.DEPTH:
            self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in DROPPED and tag not in DROPPED:
                return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


def tree_of(html: str | None) -> Node:
    """The counted tree of a page."""
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    _count(tree.root)
    return tree.root


def _count(root: Node) -> None:
    """Words and linked words of every element, and what it is worth, from the leaves up."""
    order = list(root.below())
    inside = {id(root): False}  # in a link
    for node in order:
        for c in node.children:
            if isinstance(c, Node):
                inside[id(c)] = inside[id(node)] or c.tag == "a"
    for node in reversed(order):
        own = own_linked = 0
        for c in node.children:
            if isinstance(c, str):
                words, linked, inline = len(c.split()), len(c.split()) * inside[id(node)], True
            elif c.other:
                continue
            else:
                words, linked, inline = c.words, c.linked, c.tag in _INLINE
                node.worth += c.worth * (not inline)
            node.words, node.linked = node.words + words, node.linked + linked
            own, own_linked = own + words * inline, own_linked + linked * inline
        if node.tag not in _INLINE and own:
            node.worth += own - own_linked - LINKED * own_linked - COST


def content_of(root: Node) -> Node:
    """The element that holds the page's content."""
    at = next((n for n in root.below() if n.tag == "body"), root)
    while True:
        blocks = [c for c in at.children if isinstance(c, Node) and c.tag not in _INLINE and not c.other]
        plus = sum(max(c.worth, 0) for c in blocks)
        best = max(blocks, key=lambda c: c.worth, default=None)
        if best is None or best.worth <= 0 or best.worth < DOMINANT * plus or best.tag in ("p", "pre", "table", "ul", "ol", "dl", "blockquote"):
            return at
        own = sum(len(c.split()) for c in at.children if isinstance(c, str)) + sum(c.words - c.linked for c in at.children if isinstance(c, Node) and c.tag in _INLINE)
        if own > best.words:  # text that stands beside the blocks
            return at
        at = best


def unwanted(node: Node) -> bool:
    """Whether a part of the content is none: named as something else, or links for the most part."""
    if node.other:
        return True
    return node.tag not in _INLINE and node.tag[:1] + node.tag[2:] != "h" and node.words > 0 and 2 * node.linked > node.words and (node.words > 2 * COST or node.words == node.linked and node.tag in ("ul", "ol", "div", "section"))


def events(root: Node) -> Iterator[tuple[str, str]]:
    """("start", tag), ("end", tag) and ("text", data) of the wanted parts below an element, it included."""
    stack: list = [root]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple) or isinstance(x, str):
            yield x if isinstance(x, tuple) else ("text", x)
        elif x is root or not unwanted(x):
            yield "start", x.tag
            if x.tag not in _VOID:
                stack.append(("end", x.tag))
                stack += reversed(x.children)


def title_of(root: Node, content: Node) -> str | None:
    """The first heading of the content, else of the page: of the highest rank that there is."""
    for level in ("h1", "h2"):
        for where in (content, root):
            for node in where.below():
                if node.tag == level and (text := node.text()):
                    return text
    return None


def author_of(root: Node) -> str | None:
    """Who is named as the author: by rel or itemprop, then by an element's name."""
    named = lambda n: " ".join(n.attrs.get(k, "") for k in ("class", "id")).lower()
    for wanted in (lambda n: "author" in n.attrs.get("rel", "").lower().split() or n.attrs.get("itemprop", "").lower() == "author", lambda n: bool(_BYLINE.search(named(n)))):
        for node in root.below():
            if node.tag not in ("link", "meta") and wanted(node) and (text := _BY.sub("", node.text())) and len(text) <= 100:
                return text
    return None


def date_of(root: Node) -> str | None:
    """The first date that a time element declares."""
    return next((x for n in root.below() if n.tag == "time" and (x := n.attrs.get("datetime", "").strip())), None)
