"""A small document tree over the standard HTML parser, for pages that expressions can't read."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_STEP = re.compile(r"([a-z0-9*]*)(#[\w-]+)?((?:\.[\w-]+)*)")


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def parts(self, separator: str) -> list[str]:
        """Text between the elements named ``separator``."""
        out = [""]
        for c in self.children:
            if isinstance(c, str):
                out[-1] += c
            elif c.tag == separator:
                out.append("")
            else:
                inner = c.parts(separator)
                out[-1] += inner[0]
                out += inner[1:]
        return out

    def _is(self, step: str) -> bool:
        tag, ident, classes = _STEP.fullmatch(step).groups()
        own = self.attrs.get("class", "").split()
        return (not tag or tag in ("*", self.tag)) and (not ident or self.attrs.get("id") == ident[1:]) and all(c in own for c in classes.split(".") if c)

    def select(self, path: str) -> list[Node]:
        """Elements by a path of tag, #id and .class steps (descendants)."""
        *above, last = path.split()
        found = []
        for n in self.walk():
            if not n._is(last):
                continue
            rest, up = list(above), n.parent
            while rest and up is not None:
                if up._is(rest[-1]):
                    rest.pop()
                up = up.parent
            if not rest:
                found.append(n)
        return found

    def first(self, path: str) -> Node | None:
        return next(iter(self.select(path)), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
