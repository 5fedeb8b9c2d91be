"""Leaf blocks of a page: the runs of text between block-level tags, with their ancestors.

A page is read once from front to back, and no place in it is looked at again from another one, so the
time grows with the page's length whatever stands in it. Blocks share their ancestors.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

#: Elements of HTML whose content is no text, or whose tag has no end.
RAW = frozenset("script style textarea title noscript template svg iframe select".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Fixed value: elements that stand in a line and do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br input".split()
)
#: Fixed value: an open element that the start of certain others ends.
IMPLIED_END = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 "
        "h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Ancestors at which the search for an implied end stops.
SCOPES = frozenset("ul ol dl table td th article section main div body html aside nav".split())

#: Elements that end one of these, by their name.
ENDED_BY = {
    name: tuple(ended for ended, ending in IMPLIED_END.items() if name in ending)
    for name in frozenset().union(*IMPLIED_END.values())
}

#: What begins markup: a tag's name, a comment, or a declaration.
OPENING = re.compile(r"<(?:(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)|(?P<comment>!--)|[!?])")
#: What may end a tag, or begin a quoted value in which ">" does not.
CLOSING = re.compile(r"""=\s*(["'])|>""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
ATTRIBUTE = re.compile(
    r"""(?i)\b(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
)


class Step(NamedTuple):
    """An open element: its name, and which features it has that none of its ancestors has."""

    parent: Step | None
    name: str
    own: tuple[str, ...]


class Block(NamedTuple):
    """Text of a leaf block, its innermost ancestor, and what stood inside it."""

    text: str
    step: Step | None
    linked: int
    controls: int


def _words(rest: str) -> list[str]:
    """The class, id and role words of a tag."""
    if not rest or rest.isspace():
        return []
    words = []
    for found in ATTRIBUTE.finditer(rest):
        kind, value = found[1].lower(), (found[2] or "").strip("\"'").lower()
        if kind in ("class", "id", "role"):
            words += re.findall(r"[a-z]+", value)
        elif kind == "hidden" or "display:none" in value.replace(" ", ""):
            words.append("hidden")
    return list(dict.fromkeys(words))


class Tags:
    """Ends of tags in a page, each found by going on from the last one."""

    def __init__(self, html: str):
        self.html = html
        #: Where the last quotes stand: one after which there is no other begins no value.
        self.last = {quote: html.rfind(quote) for quote in "\"'"}

    def end(self, at: int) -> int:
        """The place of the ">" of a tag that is open at ``at``; -1 if the page ends in it."""
        while found := CLOSING.search(self.html, at):
            at = found.end()
            if not found[1]:
                return at - 1
            if at <= self.last[found[1]]:
                at = self.html.index(found[1], at) + 1
        return -1


class Elements:
    """The open elements. Opening and closing one takes the same time at every depth."""

    def __init__(self):
        self.steps: list[Step] = []
        #: Depths at which elements of a name are open, and those of all scopes.
        self.depths: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.held: set[str] = set()

    def open(self, name: str, words: list[str]) -> None:
        depth = len(self.steps)
        features = [f"inside {name}", *(f"class {word}" for word in words)]
        parent = self.steps[-1] if self.steps else None
        if parent:
            features.append(f"{parent.name}>{name}")
        own = tuple(f for f in features if f not in self.held)
        self.held.update(own)
        self.steps.append(Step(parent, name, own))
        self.depths.setdefault(name, []).append(depth)
        if name in SCOPES:
            self.scopes.append(depth)

    def inside(self, name: str) -> bool:
        return bool(self.depths.get(name))

    def cut(self, depth: int) -> None:
        """Close the elements from this depth on."""
        while len(self.steps) > depth:
            step = self.steps.pop()
            self.depths[step.name].pop()
            if step.name in SCOPES:
                self.scopes.pop()
            self.held.difference_update(step.own)

    def end(self, name: str) -> None:
        self.cut(self.depths[name][-1])

    def begin(self, name: str) -> None:
        """Close the innermost element that the start of ``name`` ends, if its scope has one."""
        ended = [self.depths[n][-1] for n in ENDED_BY.get(name, ()) if self.inside(n)]
        if ended and max(ended) >= (self.scopes[-1] if self.scopes else 0):
            self.cut(max(ended))


def leaf_blocks(html: str) -> list[Block]:
    """The blocks of a page in page order; blocks without text are left out.

    Scripts, styles, comments and other raw content have no text. Character references are decoded
    once, white space becomes single spaces. Unclosed and misplaced tags are taken as browsers do in
    the common cases: a paragraph ends where a block begins, an end tag without a start is ignored, a
    tag or comment in which the page ends is no text. A page without a tag is one block.
    """
    blocks: list[Block] = []
    parts: list[str] = []
    elements, tags = Elements(), Tags(html)
    linked = controls = 0
    step: Step | None = None

    def close() -> None:
        nonlocal linked, controls
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, step, linked, controls))
            parts.clear()
        linked = controls = 0

    def say(text: str) -> None:
        nonlocal step, linked
        if not parts:
            if not text or text.isspace():
                return
            step = elements.steps[-1] if elements.steps else None
        parts.append(text)
        if elements.inside("a"):
            linked += len(text)

    at = 0
    while found := OPENING.search(html, at):
        say(html[at : found.start()])
        name, at = found["name"], found.end()
        if name is None:
            mark = "-->" if found["comment"] else ">"
            stop = html.find(mark, at)
            at = len(html) if stop < 0 else stop + len(mark)
            continue
        stop = tags.end(at)
        if stop < 0:
            at = len(html)
            break
        name, rest, at = name.lower(), html[at:stop], stop + 1
        if found["end"]:
            if elements.inside(name):
                if name not in INLINE:
                    close()
                elements.end(name)
            continue
        if name in RAW:
            controls += name in ("textarea", "select")
            # Of these only svg, which is no HTML, ends at "/>".
            if name != "svg" or not rest.endswith("/"):
                raw = RAW_END[name].search(html, at)
                stop = tags.end(raw.end()) if raw else -1
                at = len(html) if stop < 0 else stop + 1
            continue
        if name == "br":
            if parts:
                parts.append(" ")
            continue
        if name in ("input", "button"):
            controls += 1
        if name not in INLINE:
            close()
            elements.begin(name)
        if name not in VOID and not rest.endswith("/"):
            elements.open(name, _words(rest))
    say(html[at:])
    close()
    return blocks
