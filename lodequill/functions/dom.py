"""A small tolerant document tree over the standard library's tokenizer, with
the selectors that the page operators use."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_P_ENDERS = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_REPEATS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_WALLS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "text")

    def __init__(self, tag: str, attrs: dict | None = None, text: str = ""):
        self.tag, self.attrs, self.children, self.parent, self.text = tag, attrs or {}, [], None, text

    def add(self, node: Node) -> Node:
        node.parent = self
        self.children.append(node)
        return node

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if n.tag != "#text":
                yield n
                stack.extend(reversed(n.children))

    def all_text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if n.tag == "#text":
                out.append(n.text)
            stack.extend(reversed(n.children))
        return "".join(out)

    def select(self, selector: str) -> list[Node]:
        tests = compile_selector(selector)
        return [n for n in self.walk() if any(t(n) for t in tests)]

    def first(self, selector: str) -> Node | None:
        tests = compile_selector(selector)
        return next((n for n in self.walk() if any(t(n) for t in tests)), None)

    def remove(self) -> None:
        if self.parent:
            self.parent.children.remove(self)
            self.parent = None

    def unwrap(self) -> None:
        """Put the children in the node's place."""
        up = self.parent
        i = up.children.index(self)
        for c in self.children:
            c.parent = up
        up.children[i : i + 1] = self.children
        self.parent = None

    def inner(self) -> str:
        return "".join(render(c) for c in self.children)


def render(node: Node) -> str:
    if node.tag == "#text":
        return html.escape(node.text, quote=False)
    attrs = "".join(f' {k}="{html.escape(v)}"' for k, v in node.attrs.items())
    return f"<{node.tag}{attrs}>" + ("" if node.tag in VOID else node.inner() + f"</{node.tag}>")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.at = self.root

    def _close(self, names, walls=()):
        n = self.at
        while n is not self.root and n.tag not in walls:
            if n.tag in names:
                self.at = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in _P_ENDERS:
            self._close(("p",), ("div", "td", "th", "li", "section", "article", "blockquote", "button", "table"))
        if tag in _REPEATS:
            self._close(_REPEATS[tag], _WALLS[tag])
        node = self.at.add(Node(tag, {k: v or "" for k, v in attrs}))
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close((tag,))

    def handle_data(self, data):
        self.at.add(Node("#text", text=data))


def parse(page: str | None) -> Node:
    b = _Builder()
    b.feed(page or "")
    b.close()
    return b.root


def _attribute(name, op, value, fold):
    value = value.lower() if fold else value

    def test(n):
        own = n.attrs.get(name)
        if own is None:
            return False
        own = own.lower() if fold else own
        return {None: True, "=": own == value, "*=": value in own, "^=": own.startswith(value)}[op]

    return test


_SELECTORS: dict = {}
_ATTR = re.compile(r"""\[([\w:-]+)\s*(?:([*^]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*(i)?)?\s*\]""")


def compile_selector(selector: str) -> list:
    """Comma lists of compounds of tag, .class, #id and [attr op value i]."""
    if selector not in _SELECTORS:
        tests = []
        for part in re.split(r",(?![^\[]*\])", selector):
            part = part.strip()
            checks = [_attribute(m[1], m[2], next((g for g in m.groups()[2:5] if g is not None), ""), bool(m[6])) for m in _ATTR.finditer(part)]
            bare = _ATTR.sub("", part)
            tag = re.match(r"[a-zA-Z*][\w-]*|\*", bare)
            if tag and tag[0] != "*":
                checks.append(lambda n, t=tag[0].lower(): n.tag == t)
            for kind, name in re.findall(r"([.#])([\w-]+)", bare):
                checks.append((lambda n, v=name: v in n.attrs.get("class", "").split()) if kind == "." else (lambda n, v=name: n.attrs.get("id") == v))
            tests.append(lambda n, cs=tuple(checks): all(c(n) for c in cs))
        _SELECTORS[selector] = tests
    return _SELECTORS[selector]
