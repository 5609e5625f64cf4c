"""A small HTML tree with CSS selection, for use inside Arrow functions.

The tree recovers from what pages really hold: void elements, implied end
tags, stray end tags. The selector grammar is type, class, id, attribute (with
``=``, ``^=``, ``*=``), ``:not(...)``, descendant, child and comma; anything
else, pseudo-elements among it, doesn't parse.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

# Void elements, and which open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
P_CLOSERS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "tbody": {"table"}}
UNSEEN = frozenset(("script", "style", "template"))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """Descendants in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in UNSEEN:
                stack.extend(reversed(x.children))

    def text(self, separator: str) -> str:
        """Stripped text nodes, empty ones dropped, joined."""
        return separator.join(s for s in map(str.strip, self.strings()) if s)

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None)
        self.at = self.root

    def _close(self, names: set[str], stop: set[str]) -> None:
        node = self.at
        while node is not self.root and node.tag not in stop:
            if node.tag in names:
                self.at = node.parent
                return self._close(names, stop)
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in P_CLOSERS:
            self._close({"p"}, {"table", "td", "th", "button", "li"} - {tag})
        if tag in CLOSES:
            self._close(CLOSES[tag], STOPS[tag])
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


class SelectorError(ValueError):
    pass


_SIMPLE = re.compile(
    r"""\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\s\]"']+))\s*)?\]|:not\((?P<neg>[^()]*)\)|(?P<tag>\*|[A-Za-z][\w-]*)"""
)


def _compound(text: str) -> list:
    tests, i = [], 0
    while i < len(text):
        m = _SIMPLE.match(text, i)
        if not m or m["tag"] and tests:
            raise SelectorError(text)
        i = m.end()
        if m["tag"]:
            tests.append(("tag", m["tag"].lower()))
        elif m["cls"]:
            tests.append(("class", m["cls"]))
        elif m["id"]:
            tests.append(("attr", "id", "=", m["id"]))
        elif m["attr"]:
            value = next((m[k] for k in ("dq", "sq", "bare") if m[k] is not None), None)
            tests.append(("attr", m["attr"].lower(), m["op"], value))
        else:
            tests.append(("not", [_compound(x.strip()) for x in m["neg"].split(",")]))
    if not tests:
        raise SelectorError(text)
    return tests


def compile_selector(selector: str) -> list[list]:
    """Alternatives; each a list of (combinator, tests) from left to right."""
    out = []
    for part in re.split(r",(?![^()\[\]]*[)\]])", selector):
        steps, combinator, found = [], " ", False
        for token in re.findall(r"\s*>\s*|\s+|(?:\[[^\]]*\]|\([^)]*\)|[^\s>\[(])+", part.strip()):
            if token.strip() in ("", ">"):
                combinator = token.strip() or " "
            else:
                steps.append((combinator, _compound(token)))
                combinator, found = " ", True
        if not found:
            raise SelectorError(selector)
        out.append(steps)
    return out


def _passes(node: Node, tests: list) -> bool:
    for t in tests:
        if t[0] == "tag":
            ok = t[1] in ("*", node.tag)
        elif t[0] == "class":
            ok = t[1] in node.classes
        elif t[0] == "attr":
            have = node.attrs.get(t[1])
            ok = have is not None and {None: lambda: True, "=": lambda: have == t[3], "^=": lambda: bool(t[3]) and have.startswith(t[3]), "$=": lambda: bool(t[3]) and have.endswith(t[3]), "*=": lambda: bool(t[3]) and t[3] in have, "~=": lambda: t[3] in have.split()}[t[2]]()
        else:
            ok = not any(_passes(node, inner) for inner in t[1])
        if not ok:
            return False
    return True


def _matches(node: Node, steps: list) -> bool:
    combinator, tests = steps[-1]
    if not _passes(node, tests):
        return False
    if len(steps) == 1:
        return True
    up = node.parent
    if combinator == ">":
        return up is not None and up.tag != "#document" and _matches(up, steps[:-1])
    while up is not None and up.tag != "#document":
        if _matches(up, steps[:-1]):
            return True
        up = up.parent
    return False


def select(root: Node, selector: str) -> list[Node]:
    """Matches in document order; raises ``SelectorError``."""
    alternatives = compile_selector(selector)
    return [n for n in root.walk() if any(_matches(n, steps) for steps in alternatives)]


def select_all(root: Node, selectors: list[str]) -> list[Node]:
    """Matches of each selector in turn, repeats kept; one that doesn't parse gives none."""
    out = []
    for s in selectors:
        try:
            out += select(root, s)
        except SelectorError:
            continue
    return out
