"""Listing pages to cards: repeated siblings of a page's tree that each have an address of their own."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from gleanery.config import CONFIG

#: Elements that hold furniture, that close themselves, and that are never cards. Fixed values.
FURNITURE = frozenset(("nav", "script", "style", "noscript", "footer", "header", "aside"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
NOT_CARDS = frozenset(("a", "b", "br", "button", "em", "i", "img", "input", "label", "option", "span", "strong", "svg"))


class _Node:
    __slots__ = ("tag", "classes", "children", "text", "href")

    def __init__(self, tag: str, classes: str = "", href: str | None = None):
        self.tag, self.href = tag, href
        self.classes = " ".join(sorted(c for c in classes.split() if not any(x.isdigit() for x in c)))
        self.children: list[_Node] = []
        self.text: list[str] = []

    def words(self) -> str:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            out += node.text
            todo += reversed(node.children)
        return " ".join(" ".join(out).split())

    def hrefs(self) -> list[str]:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if node.href:
                out.append(node.href)
            todo += reversed(node.children)
        return out


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("root")
        self.open = [self.root]
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in FURNITURE:
            self.hidden += 1
        if self.hidden or tag in VOID:
            return
        own = dict(attrs)
        node = _Node(tag, own.get("class") or "", own.get("href"))
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        if tag in FURNITURE:
            self.hidden = max(0, self.hidden - 1)
            return
        if self.hidden:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.open[-1].text.append(data)


def _own_links(group: list[_Node], least: int, short: int, long: int) -> list[str | None] | None:
    """The address that each of a group alone has, if the group is one of cards: enough of them, each sized, more than half with such an address."""
    if len(group) < least or group[0].tag in NOT_CARDS or not all(short <= len(c.words()) <= long for c in group):
        return None
    owners = Counter(h for c in group for h in set(c.hrefs()))
    own = [next((h for h in c.hrefs() if owners[h] == 1), None) for c in group]
    return own if 2 * sum(h is not None for h in own) > len(group) else None


def cards_of(page: str | None, least: int = CONFIG.card_siblings, short: int = CONFIG.card_min_chars, long: int = CONFIG.card_max_chars) -> list[tuple[str, str]]:
    """(href, text) of a page's cards: the largest group of siblings of one tag and class, or else of one tag, of which each has the size of a card and more
    than half an address that no other has. Elements without such a group are searched further down."""
    tree = _Tree()
    tree.feed(page or "")
    out: list[tuple[str, str]] = []
    todo = [tree.root]
    while todo:
        node = todo.pop()
        taken: set[int] = set()
        for alike in (lambda c: (c.tag, c.classes), lambda c: c.tag):
            groups: dict[object, list[_Node]] = defaultdict(list)
            for child in node.children:
                groups[alike(child)].append(child)
            best = max(groups.values(), key=len, default=[])
            own = _own_links(best, least, short, long)
            if own is not None:
                out += [(h or "", c.words()) for h, c in zip(own, best)]
                taken = set(map(id, best))
                break
        todo += [c for c in reversed(node.children) if id(c) not in taken]
    return out


def cards(pages: DataFrame, page: str, body: str) -> DataFrame:
    """page, pos, href, text of all cards."""
    kind = pages.schema[page].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, k, h, t) for p, b in zip(batch["page"], batch["body"]) for k, (h, t) in enumerate(cards_of(b))]
            yield pd.DataFrame(rows, columns=["page", "pos", "href", "text"])

    return pages.selectExpr(f"`{page}` AS page", f"`{body}` AS body").mapInPandas(run, f"page {kind}, pos int, href string, text string")
