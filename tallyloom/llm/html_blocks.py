"""Leaf blocks of an HTML page: runs of text that no block element interrupts."""

from __future__ import annotations

import html
import re
from collections.abc import Generator
from dataclasses import dataclass

#: A tag whose quotes are closed, one that ends at the first '>', and other markup.
STRICT = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
LENIENT = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
OTHER = re.compile(r"<[!?/][^>]*>")
#: The first of these fails only by reading on to the end of the page. After so many failures the page's
#: quotes are not trusted any more, so that no page costs the square of its length.
FAILURES = 50
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Their content is not markup and no text of the page. All other elements may hold text.
RAW = {"script", "style", "noscript", "iframe", "textarea"}
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr img object "
    # formulas and drawings within a line
    "math maction mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext "
    "munder munderover semantics annotation svg g defs use path rect circle line text tspan".split()
)
#: An element of the first kind that begins ends an open one of the second, up to the fence.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
FENCES = {"table", "td", "th", "button", "article", "section", "main", "div", "body"}


@dataclass(slots=True, eq=False)
class Node:
    """An open element, with those around it, which blocks share."""

    parent: Node | None
    tag: str
    #: The parts of its class, id and role.
    parts: tuple[str, ...]
    #: Which of its tag and parts no element around it has.
    new: tuple[str, ...]


@dataclass(slots=True)
class Block:
    text: str
    path: Node | None
    linked: int


#: Nodes of equal paths are one object, also of different pages, up to so many.
KEPT_NODES = 20_000
_NODES: dict[tuple[Node | None, str, tuple[str, ...]], Node] = {}


class Open:
    """The open elements. Finding the last one of a kind takes no search."""

    def __init__(self):
        self.stack: list[Node] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of those that are not inline
        self.named: dict[str, int] = {}

    def top(self) -> Node | None:
        return self.stack[-1] if self.stack else None

    def push(self, tag: str, parts: tuple[str, ...]) -> None:
        stack, named = self.stack, self.named
        key = (stack[-1] if stack else None, tag, parts)
        node = _NODES.get(key)
        places = self.places.get(tag)
        if places is None:
            places = self.places[tag] = []
        if node is None:
            new = [] if places else [f"in {tag}"]
            new += [f"named {p}" for p in parts if not named.get(p)]
            if len(_NODES) >= KEPT_NODES:
                _NODES.clear()
            node = _NODES[key] = Node(*key, tuple(new))
        places.append(len(stack))
        if tag not in INLINE:
            self.blocks.append(len(stack))
        for p in parts:
            named[p] = named.get(p, 0) + 1
        stack.append(node)

    def last(self, tags: set[str]) -> int:
        found = -1
        for t in tags:
            places = self.places.get(t)
            if places and places[-1] > found:
                found = places[-1]
        return found

    def cut(self, place: int) -> None:
        """End the elements from this place on."""
        while len(self.stack) > place:
            node = self.stack.pop()
            self.places[node.tag].pop()
            for p in node.parts:
                self.named[p] -= 1
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def end(self, names: set[str], fences: set[str]) -> None:
        """End the last element of these names, if no fence is open within it."""
        place = self.last(names)
        if place >= 0 and place > self.last(fences):
            self.cut(place)

    def close(self, tag: str) -> None:
        places = self.places.get(tag)
        place = places[-1] if places else -1
        # The end of an inline element doesn't reach beyond a block.
        if place >= 0 and not (tag in INLINE and self.blocks and self.blocks[-1] > place):
            self.cut(place)


def _parts(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found: list[str] = []
    for m in NAMES.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        found += PART.findall(CAMEL.sub(" ", value).lower())
    return tuple(sorted(set(found)))


def _markup(page: str) -> Generator[tuple[int, int, re.Match | None], int | None, None]:
    """Begin and end of each tag or other markup in order, and the match of a tag."""
    at, failures = 0, 0
    last = page.rfind(">")
    while True:
        at = page.find("<", at)
        if at < 0 or at > last and not page.startswith("<!--", at):
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, None
            at = end
            continue
        m = None
        if page[at + 1 : at + 2].isalpha() or page[at + 1 : at + 2] == "/":
            if failures < FAILURES:
                m = STRICT.match(page, at)
                failures += m is None
            m = m or LENIENT.match(page, at)
        tag, m = m, m or OTHER.match(page, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        skip = yield m.start(), at, tag
        if skip is not None:
            at = skip


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks in order, references decoded and white space made one space.

    The time is in proportion to the page's length, however deep its elements lie in each other and
    whatever it leaves open.
    """
    out: list[Block] = []
    elements = Open()
    pieces: list[str] = []
    path: Node | None = None
    linked = links = 0

    def close_block() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, path, linked))
            pieces, linked = [], 0

    def add(text: str) -> None:
        nonlocal path, linked
        if not text:
            return
        if not pieces:
            if text.isspace():
                return
            path = elements.top()
        text = html.unescape(text) if "&" in text else text
        if links:
            linked += len(text)
        pieces.append(text)

    done = 0
    markup = _markup(page)
    found = next(markup, None)
    while found is not None:
        begin, end, m = found
        if done < begin:
            add(page[done:begin])
        done = end
        skip = None
        if m is not None:
            closing, tag, attributes = m[1], m[2].lower(), m[3]
            if tag not in INLINE:
                close_block()
            if closing:
                elements.close(tag)
                if tag == "a":
                    links = 0
            elif tag in RAW and not attributes.endswith("/"):
                stop = RAW_END[tag].search(page, done)
                done = skip = stop.end() if stop else len(page)
            elif tag not in VOID and not attributes.endswith("/"):
                if tag not in INLINE:
                    elements.end({"p"}, FENCES)
                    if tag in ENDS:
                        elements.end(*ENDS[tag])
                if tag == "a":
                    links = 1
                elements.push(tag, _parts(attributes))
        try:
            found = markup.send(skip)
        except StopIteration:
            found = None
    add(page[done:])
    close_block()
    return out
