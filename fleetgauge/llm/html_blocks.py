"""Text blocks of a web page, with the elements they lie in."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from fleetgauge.llm.common import Memo

# Element names of HTML by how they are treated.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
# Their content is no text of the page: code, inert markup, what stands in for another document, and form input.
RAW_TAGS = frozenset("script style template iframe noembed noframes textarea".split())
# Their content is text, but no markup.
PLAIN_TAGS = frozenset(("xmp",))
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACE_TAGS = frozenset(("br", "hr"))
UNSEEN_TAGS = frozenset(("head",))
LIST_TAGS = frozenset("ul ol menu dl table select".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")


# Places that the words of a path are hashed to.
PLACES = 96


def _places(mark: str) -> int:
    bits = 0
    for word in mark.split():
        bits |= 1 << zlib.crc32(word.encode()) % PLACES
    return bits


_PLACES = Memo(_places, 50_000)


class Path:
    """Where an element lies: its mark, the path of the element around it, and the hashed places of all their words.

    Paths share their outer parts, so deep nesting costs one object for each element.
    """

    __slots__ = ("outer", "mark", "bits")

    def __init__(self, outer: Path | None, mark: str):
        self.outer, self.mark = outer, mark
        self.bits = _PLACES[mark] | (outer.bits if outer else 0)

    @staticmethod
    def of(marks: Iterable[str]) -> Path | None:
        path = None
        for mark in marks:
            path = Path(path, mark)
        return path


def marks_inside_out(path: Path | None) -> Iterator[str]:
    while path:
        yield path.mark
        path = path.outer


@dataclass
class Block:
    text: str
    path: Path | None
    link_chars: int
    label: int | None = None


@dataclass
class _Open:
    """Elements that are open, with a count of each name so that a stray end tag costs nothing."""

    names: list[str] = field(default_factory=list)
    path: Path | None = None
    count: dict[str, int] = field(default_factory=dict)

    def push(self, name: str, mark: str) -> None:
        self.names.append(name)
        self.path = Path(self.path, mark)
        self.count[name] = self.count.get(name, 0) + 1

    def pop_to(self, name: str) -> None:
        while self.names:
            top = self.names.pop()
            self.path = self.path.outer
            self.count[top] -= 1
            if top == name:
                return


def mark_of(name: str, attributes: str) -> str:
    """An element's name and the words of its class, id and role."""
    words = [name]
    for found in _NAMES.findall(attributes) if "=" in attributes else ():
        words += [w.lower() for w in _WORD.findall("".join(found))]
    return " ".join(words)


def blocks_of(page: str) -> list[Block]:
    """The text blocks in page order: character references decoded, white space turned into single spaces, trimmed.

    Scripts, styles, templates, embedded documents, text areas, comments and the head have no blocks; all other text has, formulas,
    drawings and alternative content included. End tags that fit nothing are ignored; an element that is never closed ends with the page.
    """
    found: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    path: Path | None = None
    links = at = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text and not any(stack.count.get(t) for t in UNSEEN_TAGS):
                found.append(Block(text, path, min(links, len(text))))
            parts.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal path, links
        if not text:
            return
        if not parts or not path or len(parts) < 2 and parts[0].isspace():
            path = stack.path
        parts.append(text)
        if stack.count.get("a"):
            links += len(text.strip())

    size = len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            if tag[0].startswith("<![CDATA["):
                add(html.escape(tag[0][9:].removesuffix("]]>"), quote=False))
            continue
        name, closing = tag[2].lower(), bool(tag[1])
        if name in SPACE_TAGS:
            if name == "hr":
                flush()
            add(" ")
            continue
        if closing:
            if name in BLOCK_TAGS:
                flush()
            if stack.count.get(name):
                stack.pop_to(name)
            continue
        if name in VOID_TAGS:
            continue
        if name in RAW_TAGS or name in PLAIN_TAGS:
            if not tag[3].endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                if name in PLAIN_TAGS:
                    flush()
                    add(html.escape(page[at : end.start() if end else size], quote=False))
                    flush()
                at = end.end() if end else size
            continue
        if name in BLOCK_TAGS:
            flush()
            if stack.count.get("p"):
                # a block element ends an open paragraph unless a list or table lies between
                for open_ in reversed(stack.names):
                    if open_ == "p":
                        stack.pop_to("p")
                        break
                    if open_ in BLOCK_TAGS:
                        break
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack.count.get(name):
                for open_ in reversed(stack.names):
                    if open_ == name:
                        stack.pop_to(name)
                        break
                    if open_ in LIST_TAGS:
                        break
            if name == "body" and stack.count.get("head"):
                stack.pop_to("head")
        stack.push(name, mark_of(name, tag[3]))
    flush()
    return found
