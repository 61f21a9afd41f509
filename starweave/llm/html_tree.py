"""A page as a tree of blocks with their texts, from markup that need not be well formed."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element names of HTML.
#: Their content is not text of the page.
RAW = frozenset("script style template noscript iframe object svg math textarea select title canvas audio video".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that run along in a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
#: Elements that the start of another one of these ends.
SIBLINGS = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "tbody": ("thead tbody tr td th", ("table",)),
    "tfoot": ("thead tbody tr td th", ("table",)),
}
#: Elements that group blocks, whose class, role or id may say what they are for.
GROUPS = frozenset("div section ul ol dl table center header footer aside nav form main article figure details".split())
# Words that class, role and id of a group are made of. A value is understood if it has no others.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended popular "
    "newsletter subscribe subscription signup login register search popup modal overlay pagination pager widget toolbar "
    "complementary contentinfo skip hidden copyright tags trending".split()
)
MAIN_WORDS = frozenset("article articlebody main content post entry story text body".split())
NEUTRAL_WORDS = frozenset(
    "site page top bottom left right box list bar block blocks container wrapper wrap inner outer section area item items "
    "links unit slot panel row column col group global primary secondary sticky fixed form posts articles stories".split()
)
KNOWN_WORDS = BOILERPLATE_WORDS | MAIN_WORDS | NEUTRAL_WORDS
#: Elements inside each other that become blocks of their own; what lies deeper belongs to the last of them.
DEPTH = 150

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][A-Za-z0-9:-]*)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_HINT = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """An element: its name, hints from its class, id and role, and its blocks and texts in page order.

    Hints are words of values that are understood, and ``~`` with the first class that is not. What differs from page
    to page, as an id made of a title does, is none.
    """

    name: str
    hints: tuple[str, ...] = ()
    kids: list[Block | Text] = field(default_factory=list)

    @property
    def tag(self) -> str:
        return ".".join((self.name, *self.hints))


@dataclass
class Text:
    """A run of text; ``linked`` counts its characters inside links."""

    value: str
    linked: int
    tag: str = "#"


def _hints(name: str, rest: str) -> tuple[str, ...]:
    if "=" not in rest or name not in GROUPS:
        return ()
    found: dict[str, None] = {}
    other = None
    for m in _HINT.finditer(rest):
        kind, *values = m.groups()
        for value in next(v for v in values if v is not None).split():
            words = _WORD.findall(_CAMEL.sub("-", value).lower())
            if words and KNOWN_WORDS.issuperset(words):
                found.update(dict.fromkeys(words))
            elif words and kind.lower() == "class" and other is None:
                other = "~" + "-".join(words)
    return (*found, other) if other else tuple(found)


def parse(html: str) -> Block:
    """The tree of a page. Unclosed elements end with the element around them, or with the page."""
    root = Block("#page")
    stack = [root]
    pieces: list[str] = []
    linked = 0
    in_link = 0
    at = 0
    deep: list[str] = []  # open elements beyond the last block

    def flush() -> None:
        nonlocal linked
        if pieces:
            value = " ".join("".join(pieces).split())
            if value:
                stack[-1].kids.append(Text(value, min(linked, len(value))))
            pieces.clear()
        linked = 0

    def close(names: tuple[str, ...] | frozenset[str], within: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                flush()
                del stack[depth:]
                return
            if stack[depth].name in within:
                return

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            value = unescape(raw) if "&" in raw else raw
            pieces.append(value)
            if in_link:
                linked += len(value.strip())

    for m in iter(lambda: _TOKEN.search(html, at), None):
        add(html[at : m.start()])
        at = m.end()
        token = m.group()
        if token.startswith("<![CDATA["):
            pieces.append(token[9:].removesuffix("]]>"))
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            if name == "a":
                in_link = 0
            if name == "br":
                pieces.append(" ")
            elif name not in INLINE and name not in VOID:
                if name in deep:
                    flush()
                    while deep.pop() != name:
                        pass
                    continue
                before = len(stack)
                close((name,), ())
                if len(stack) < before:
                    deep.clear()
            continue
        rest = m["rest"] or m["rest2"] or ""
        if name in RAW:
            if not rest.rstrip().endswith("/"):
                end = re.compile(rf"</{name}\s*+[^>]*+>", re.I).search(html, at)
                at = end.end() if end else len(html)
            if name not in ("svg", "math", "audio", "video", "canvas"):
                continue
            pieces.append(" ")
            continue
        if name in VOID:
            if name in ("br", "hr"):
                pieces.append(" ")
            if name == "hr":
                flush()
            continue
        if name in INLINE:
            if name == "a":
                in_link = 1
            continue
        flush()
        if len(stack) > DEPTH:
            if name not in ("p", "li", "dt", "dd", "tr", "td", "th") and not rest.rstrip().endswith("/"):
                deep.append(name)
            continue
        close(("p",), ("table", "td", "th", "li", "div", "section", "article", "main", "body"))
        if name in SIBLINGS:
            names, within = SIBLINGS[name]
            close(frozenset(names.split()), within)
        if name in ("html", "body") and any(b.name == name for b in stack):
            continue
        if name == "body":
            close(("head",), ())
        block = Block(name, _hints(name, rest))
        stack[-1].kids.append(block)
        if not (rest.rstrip().endswith("/") and name not in ("p", "div")):
            stack.append(block)
            in_link = 0
    add(html[at:])
    flush()
    return root
