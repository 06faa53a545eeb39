"""HTML pages as sequences of leaf blocks."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Elements that end the block before them. The block-level elements of HTML.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav noscript ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose content is no text of the page.
HIDDEN = frozenset("script style template head title textarea svg math object audio video canvas iframe select".split())
# Elements that may stand in a head; any other one, and text, ends it. Fixed values of HTML, as below.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
_FOREIGN = ("svg", "math")
# Elements that end an svg or math element, and those of its elements inside which they do not.
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_INTEGRATION = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Opening one of these closes an open one of the same set, up to a container.
_SIBLINGS = {t: g for g in (("li",), ("dt", "dd"), ("td", "th"), ("tr",), ("option",), ("p",)) for t in g}
_STOP = frozenset("table ul ol dl div section article body tr".split())
_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|!\[CDATA\[(.*?)\]\]>|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?)", re.S)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+", re.I)


class Element:
    """An open element with its class, id and role words. Blocks below it share it, so that deep nesting
    costs one element each."""

    __slots__ = ("tag", "names", "above", "cells")

    def __init__(self, tag: str, names: list[str], above: Element | None):
        self.tag, self.names, self.above = tag, names, above
        # For whoever hashes paths: what is known of this element's path.
        self.cells: frozenset[int] | None = None


@dataclass
class Block:
    """Text with white space as single spaces, the innermost of its elements, and how many of its
    characters stand in links."""

    text: str
    element: Element | None
    link_chars: int

    @property
    def path(self) -> tuple[str, ...]:
        """Tags from the outermost in, each followed by its words."""
        out, at = [], self.element
        while at is not None:
            out.append((at.tag, *at.names))
            at = at.above
        return tuple(w for words in reversed(out) for w in words)


class _Open:
    """The open elements, with the places of each tag, so that looking for one does not walk them all."""

    def __init__(self):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.hidden = 0

    def push(self, tag: str, names: list[str]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Element(tag, names, self.stack[-1] if self.stack else None))
        self.hidden += tag in HIDDEN

    def close(self, k: int) -> None:
        """Closes elements from the innermost up to the one at place ``k``."""
        while len(self.stack) > k:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            self.hidden -= tag in HIDDEN

    def last(self, tags) -> int:
        """Place of the innermost element with one of the tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def top(self) -> str | None:
        return self.stack[-1].tag if self.stack else None


def _names(attributes: str) -> list[str]:
    return [
        "." + part.lower()
        for found in _NAME.finditer(attributes)
        for part in _PART.findall(found.group(1) or found.group(2) or found.group(3) or "")
    ]


def blocks(html: str) -> list[Block]:
    """Leaf blocks in page order. Character references are decoded; comments, declarations and
    hidden elements give nothing; unclosed and misplaced tags are repaired as browsers do for
    paragraphs, list items, table cells, heads, svg and math."""
    out: list[Block] = []
    opened = _Open()
    text: list[str] = []
    linked = 0
    pos, size = 0, len(html)

    def flush():
        nonlocal linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, opened.stack[-1] if opened.stack else None, linked))
            text.clear()
        linked = 0

    while pos < size:
        found = _TAG.search(html, pos)
        stop = found.start() if found else size
        if stop > pos and opened.top() == "head" and html[pos:stop].strip():
            opened.close(len(opened.stack) - 1)
        if stop > pos and not opened.hidden:
            piece = html[pos:stop]
            text.append(piece)
            if opened.places.get("a"):
                linked += len(piece.strip())
        if not found:
            break
        pos = found.end()
        if found.group(1) is not None and not opened.hidden:
            text.append(found.group(1))
            continue
        tag = (found.group(3) or "").lower()
        if not tag:
            continue
        if found.group(2):
            at = opened.last((tag,))
            if tag in BLOCK and not opened.hidden:
                flush()
            if at >= 0:
                opened.close(at)
            elif tag == "br" and not opened.hidden:
                text.append(" ")
            continue
        if opened.hidden and opened.top() == "head":
            if tag in ("head", "html"):
                continue
            if tag in ("noscript", "noframes"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, pos)
                pos = end.end() if end else pos
                continue
            if tag not in _IN_HEAD:
                opened.close(len(opened.stack) - 1)
        elif opened.hidden and tag in _BREAKOUT:
            while opened.top() in _FOREIGN:
                opened.close(len(opened.stack) - 1)
        elif opened.hidden and tag in _INTEGRATION and opened.last(_FOREIGN) >= 0:
            if not found.group(4).rstrip().endswith("/"):
                opened.push(tag, [])
            continue
        if opened.hidden and tag not in HIDDEN:
            continue
        if tag in BLOCK or tag in HIDDEN:
            flush()
            sibling = opened.last(_SIBLINGS.get(tag, ("p",) if tag in BLOCK else ()))
            if sibling >= 0 and sibling >= opened.last(_STOP):
                opened.close(sibling)
        elif tag in VOID:
            text.append(" ")
        if tag in VOID or found.group(4).rstrip().endswith("/") and tag in HIDDEN:
            continue
        if tag in ("script", "style", "textarea", "title"):
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, pos)
            pos = end.end() if end else size
            continue
        opened.push(tag, _names(found.group(4)))
    flush()
    return out
