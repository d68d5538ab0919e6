"""A small document tree over the standard HTML parser: enough to select elements by tag, class and id and to read their text."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from operator import attrgetter

_VOID = frozenset("br img hr meta link input area base col embed source track wbr".split())
_SILENT = ("script", "style")
_NO_CLASSES: frozenset[str] = frozenset()
_NO_ATTRIBUTES: dict[str, str] = {}
_place = attrgetter("place")
_NAME, _BLANK = r"[a-zA-Z_:][-a-zA-Z0-9_:.]*", r"[\t\n\r\f ]"
_ATTRIBUTE = rf"""({_NAME})(?:="((?:[^"&]|&amp;)*)"|='((?:[^'&]|&amp;)*)')?"""
_ATTRIBUTES = rf"""(?:{_BLANK}+{_NAME}(?:="(?:[^"&]|&amp;)*"|='(?:[^'&]|&amp;)*')?)*"""
#: Markup on which all versions of the standard parser agree: text, end tags, start tags (name, attributes, whether closed at once),
#: comments and document types. Elements whose text isn't markup count only if nothing in it looks like markup. What isn't regular is
#: matched with all that follows it, so that matches leave nothing out.
_REGULAR = re.compile(
    rf"([^<]+)|</([a-z][a-z0-9]*)>"
    rf"|<(?:(?!s[ct]|xmp|if|no|t[ei]|pl)|(?!(script|style|xmp|iframe|noembed|noframes|noscript)\b(?!{_ATTRIBUTES}{_BLANK}*>[^<&]*</\3>))"
    rf"(?!(title|textarea)\b(?!{_ATTRIBUTES}{_BLANK}*>[^<]*</\4>))(?!plaintext\b))"
    rf"([a-z][a-z0-9]*)({_ATTRIBUTES}){_BLANK}*(/?)>"
    rf"|<!--[^->]*-->|<![dD][oO][cC][tT][yY][pP][eE][^>]*>|(.+)",
    re.S,
)


class Node:
    """An element; ``items`` holds child elements and strings in document order.

    ``order`` lists all elements of the document as they begin. Those below an element follow it there, up to ``end``, so
    that they are found without a walk. ``index``, which the root has once something was looked up, tells them by tag,
    class and id.
    """

    __slots__ = ("tag", "attributes", "parent", "items", "classes", "order", "place", "end", "index")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None, classes: frozenset[str] | None = None):
        self.tag, self.attributes, self.parent, self.items = tag, attributes, parent, []
        self.classes = _classes(attributes) if classes is None else classes
        self.order, self.index = [] if parent is None else parent.order, None
        self.place, self.end = len(self.order), len(self.order) + 1
        self.order.append(self)

    def get(self, name: str) -> str:
        return self.attributes.get(name) or ""

    def elements(self) -> list[Node]:
        """All elements below, in document order."""
        return self.order[self.place + 1 : self.end]

    def strings(self) -> Iterator[tuple[str, Node]]:
        """All strings below with the element each stands in; those of scripts and styles aren't text."""
        for item in self.items:
            if isinstance(item, str):
                yield item, self
            elif item.tag not in _SILENT:
                yield from item.strings()

    def children(self, **wanted) -> list[Node]:
        fits = _filter(**wanted)
        return [i for i in self.items if isinstance(i, Node) and fits(i)]

    def every(self, **wanted) -> list[Node]:
        """Elements below by ``tag`` (one or several), ``css`` (classes, all of them), ``id`` or ``where``."""
        return list(self._found(self.end, **wanted))

    def first(self, **wanted) -> Node | None:
        return next(self._found(self.end, **wanted), None)

    def following(self, **wanted) -> list[Node]:
        """Later siblings."""
        if self.parent is None:
            return []
        fits, found, passed = _filter(**wanted), [], False
        for item in self.parent.items:
            if passed and isinstance(item, Node) and fits(item):
                found.append(item)
            passed = passed or item is self
        return found

    def onward(self, **wanted) -> Node | None:
        """The first fitting element after this one's start, wherever in the document."""
        return next(self._found(len(self.order), **wanted), None)

    def _found(self, end: int, tag: str | tuple[str, ...] | None = None, css: str = "", id: str | None = None, where: Callable[[Node], bool] | None = None) -> Iterator[Node]:
        """Fitting elements between this one and place ``end``: from the index, or from all of them where those are fewer."""
        fits, kind, name = _by_name(tag, css, id)
        if kind is None:
            known = self.order[self.place + 1 : end]
        else:
            root = self.order[0]
            if root.index is None:
                root.index = _index(self.order)
            part = root.index[kind]
            known = part.get(name, ()) if isinstance(name, str) else sorted((e for n in name for e in part.get(n, ())), key=_place)
            if len(known) > end - self.place:
                known = self.order[self.place + 1 : end]
        start = self.place
        for e in known:
            if start < e.place < end and fits(e) and (where is None or where(e)):
                yield e

    def text(self) -> str:
        return "".join(self._texts([]))

    def words(self) -> str:
        """The stripped, non-empty strings with a blank between, white space collapsed."""
        return " ".join(" ".join(self._texts([])).split())

    def _texts(self, found: list[str]) -> list[str]:
        for item in self.items:
            if isinstance(item, str):
                found.append(item)
            elif item.tag not in _SILENT:
                item._texts(found)
        return found


def _filter(tag: str | tuple[str, ...] | None = None, css: str = "", id: str | None = None, where: Callable[[Node], bool] | None = None) -> Callable[[Node], bool]:
    fits, _, _ = _by_name(tag, css, id)
    return fits if where is None else lambda e: fits(e) and where(e)


@lru_cache(1024)
def _by_name(tag: str | tuple[str, ...] | None, css: str, id: str | None) -> tuple[Callable[[Node], bool], int | None, str | tuple[str, ...]]:
    """Whether an element fits, and in which part of the index, by which name or names, all that do are found."""
    needed, tags = frozenset(css.split()), (tag,) if isinstance(tag, str) else tag
    kind, name = (2, id) if id else (1, max(needed, key=len)) if needed else (0, tag if isinstance(tag, str) else tuple(dict.fromkeys(tag))) if tag else (None, "")
    if isinstance(tag, str) and id is None:
        return ((lambda e: e.tag == tag and needed <= e.classes) if needed else (lambda e: e.tag == tag)), kind, name
    return (lambda e: (tags is None or e.tag in tags) and needed <= e.classes and (id is None or e.get("id") == id)), kind, name


def _index(order: list[Node]) -> tuple[dict[str, list[Node]], ...]:
    """A document's elements by tag, by class and by id."""
    tags, classes, ids = defaultdict(list), defaultdict(list), defaultdict(list)
    for e in order:
        tags[e.tag].append(e)
        for name in e.classes:
            classes[name].append(e)
        if "id" in e.attributes:
            ids[e.attributes["id"]].append(e)
    return tags, classes, ids


def _classes(attributes: dict[str, str]) -> frozenset[str]:
    return frozenset(attributes["class"].split()) if "class" in attributes else _NO_CLASSES


@lru_cache(8192)
def _attributes(text: str) -> tuple[dict[str, str], frozenset[str]]:
    """Attributes and classes of a regular start tag."""
    found = {name.lower(): (double or single).replace("&amp;", "&") for name, double, single in re.findall(_ATTRIBUTE, text)}
    return found, _classes(found)


class _Builder(HTMLParser):
    """The tree, by the standard parser from where markup isn't regular."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def read(self, html: str) -> None:
        at, order = self.root, self.root.order
        for text, ended, _, _, begun, attributes, closed, rest in _REGULAR.findall(html):
            if text:
                at.items.append(unescape(text) if "&" in text else text)
            elif begun:
                known, classes = _attributes(attributes) if attributes else (_NO_ATTRIBUTES, _NO_CLASSES)
                node = Node(begun, known, at, classes)
                at.items.append(node)
                if not closed and begun not in _VOID:
                    at = node
            elif ended == at.tag != "":
                at.end, at = len(order), at.parent
            elif ended:
                self.at = at
                self.handle_endtag(ended)
                at = self.at
            elif rest:
                self.at = at
                self.feed(rest)
                self.close()
                at = self.at
        self.at = at
        self._leave(self.root)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.items.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.items.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self._leave(node)
            self.at = node.parent

    def handle_data(self, data):
        self.at.items.append(data)

    def _leave(self, last: Node) -> None:
        """The open elements up to ``last`` hold what has come till now."""
        node, end = self.at, len(self.root.order)
        while node is not last:
            node.end, node = end, node.parent
        last.end = end


def parse(html: str | None) -> Node:
    """The root of a page; broken markup gives what could be read."""
    builder = _Builder()
    builder.read(html or "")
    return builder.root
