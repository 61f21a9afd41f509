"""Union-free wrappers of a host's pages, and the main text that they point to.

A wrapper is a tree of elements in which a part may be optional, repeated or a
text slot. The first page of a host is its own wrapper. Every further page is
aligned with it: neighbouring parts that recur become repeated groups, parts
that only one side has become optional, texts fill slots. Wrappers of parts of a
host are aligned with each other in the same way. Each slot sums what its texts
were like on all pages: how long, how much inside links, and whether they vary.

A wrapper is bounded by the layout: elements are told apart by name and by what
their class says of their purpose, and a list that grows beyond ``WIDE`` parts
becomes a bag, with one part for each kind of element in any order.

Slots are then main text or not, once for the whole host and each choice of the
article's parts, of which a page takes the first one that it has text in. Inside an
element that says that it is the article, everything is main text but for elements
that say that they are something else. Elsewhere the slots' statistics decide as well:
links, and short texts that are the same wherever they occur while others vary.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.html_tree import BOILERPLATE_WORDS, MAIN_WORDS, Block, Text, parse
from starweave.llm.tables import free_name
from starweave.session import stage

#: Elements in a repeated group at most.
PERIOD = 4
#: Hosts whose wrappers a task holds before it passes them on.
HELD = 1024
#: Parts side by side at most; more become a bag.
WIDE = 64
#: Outside an article, a text that is the same on all pages, two or more, and at most so long belongs to the layout.
SAME_PAGES, SAME_CHARS = 2, 120
#: Outside an article, a slot with more of its characters inside links is a menu.
LINKED = 0.7

# Elements that are not part of an article.
BOILERPLATE_ELEMENTS = frozenset("nav header footer aside form dialog menu head button fieldset legend".split())
ARTICLE_WORDS = frozenset(["articlebody"])
#: Elements that hold blocks, so one of them may be the whole article.
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())

#: A wrapper part: t tag, k kids, b 1 if these are a bag, o optional, r repeated, and for slots n pages, c characters, l linked ones, h hash, v varies.
Part = dict


def _slot(text: Text) -> Part:
    return {"t": "#", "n": 1, "c": len(text.value), "l": text.linked, "h": crc32(text.value.encode()), "v": 0, "o": 0, "r": 0}


def of_page(block: Block) -> Part:
    """The wrapper of one page, with its repeated parts folded."""
    kids = [_slot(k) if isinstance(k, Text) else of_page(k) for k in block.kids]
    return _bounded({"t": block.tag, "o": 0, "r": 0}, _fold(kids))


def _bounded(part: Part, kids: list[Part], bag: bool = False) -> Part:
    if bag or len(kids) > WIDE:
        return part | {"k": _bag(kids), "b": 1}
    return part | {"k": kids}


def _plain_tag(tag: str) -> str:
    """A tag without what a class says that is not understood."""
    return tag.split(".~")[0]


def _bag(kids: list[Part]) -> list[Part]:
    """One part for each kind of element, in the order in which they first occur."""
    found: dict[str, Part] = {}
    for kid in kids:
        tag = _plain_tag(kid["t"])
        part = kid | {"t": tag, "o": 1, "r": 1}
        if tag in found:
            part = merge(found[tag], part)
            if tag == "#":
                part["v"] = 1
        found[tag] = part
    return list(found.values())


def merge(one: Part, two: Part) -> Part:
    """A wrapper of everything that either of two parts with one tag is a wrapper of."""
    out = {"t": one["t"], "o": one["o"] | two["o"], "r": one["r"] | two["r"]}
    if one["t"] == "#":
        varies = one["v"] | two["v"] | (one["h"] != two["h"])
        return out | {"n": one["n"] + two["n"], "c": one["c"] + two["c"], "l": one["l"] + two["l"], "h": one["h"], "v": int(varies)}
    if "b" in one or "b" in two:
        return _bounded(out, one["k"] + two["k"], bag=True)
    return _bounded(out, _align(one["k"], two["k"]))


def _repeat(parts: list[Part]) -> Part:
    whole = parts[0]
    for part in parts[1:]:
        whole = merge(whole, part)
        if whole["t"] == "#":
            whole["v"] = 1
    return whole | {"r": 1}


def _fold(kids: list[Part]) -> list[Part]:
    """Groups that follow each other with the same tags become one repeated group."""
    for period in range(1, PERIOD + 1):
        out: list[Part] = []
        i = 0
        while i < len(kids):
            group = [k["t"] for k in kids[i : i + period]]
            count = 1
            while len(group) == period and [k["t"] for k in kids[i + count * period : i + (count + 1) * period]] == group:
                count += 1
            if count > 1:
                rounds = [kids[i + j * period : i + (j + 1) * period] for j in range(count)]
                out += [_repeat([r[j] for r in rounds]) for j in range(period)]
                i += count * period
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def _align(one: list[Part], two: list[Part]) -> list[Part]:
    """The longest common sequence of tags is merged; what only one side has is optional."""
    a, b = [p["t"] for p in one], [p["t"] for p in two]
    if a == b:
        return [merge(x, y) for x, y in zip(one, two, strict=True)]
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            longest[i][j] = (
                longest[i + 1][j + 1] + 1 if a[i] == b[j] else max(longest[i + 1][j], longest[i][j + 1])
            )
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out.append(merge(one[i], two[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and longest[i + 1][j] >= longest[i][j + 1]):
            out.append(one[i] | {"o": 1})
            i += 1
        else:
            out.append(two[j] | {"o": 1})
            j += 1
    return _fold(out)


def _is_boilerplate(tag: str, in_article: bool) -> bool:
    name, *hints = tag.split(".")
    if name in BOILERPLATE_ELEMENTS and not (name == "header" and in_article):
        return True
    return name not in ("main", "article") and not BOILERPLATE_WORDS.isdisjoint(hints) and ARTICLE_WORDS.isdisjoint(hints)


def _slots(part: Part) -> Iterator[Part]:
    """Text slots of a part that are not inside boilerplate."""
    if part["t"] == "#":
        yield part
        return
    for kid in part["k"]:
        if kid["t"] == "#" or not _is_boilerplate(kid["t"], part["t"].startswith("article")):
            yield from _slots(kid)


def _plain(part: Part) -> int:
    """Characters outside links and boilerplate."""
    return sum(s["c"] - s["l"] for s in _slots(part))


def _find(part: Part, wanted) -> list[Part]:
    """Outermost parts that are wanted and not boilerplate."""
    if part["t"] == "#":
        return []
    if wanted(part["t"]):
        return [part]
    return [p for kid in part["k"] if not _is_boilerplate(kid["t"], False) for p in _find(kid, wanted)]


def _main_roots(wrapper: Part) -> list[tuple[list[Part], bool]]:
    """The parts that hold the article, by element, else by name, else by where the text is; and what comes next for
    pages of other templates, which have nothing there. With each, whether it says itself that it is the article."""
    total = _plain(wrapper)
    rules = (
        (lambda t: t.split(".")[0] == "article" or "articlebody" in t.split("."), True),
        (lambda t: t.split(".")[0] == "main" or "main" in t.split(".")[1:], True),
        (lambda t: bool(MAIN_WORDS & set(t.split(".")[1:])), False),
    )
    named = [(found, sure) for r, sure in rules if (found := [p for p in _find(wrapper, r) if _plain(p)])]
    half = lambda roots: 2 * sum(map(_plain, roots)) >= total
    here = wrapper
    while True:
        kids = [k for k in here["k"] if k["t"].split(".")[0] in CONTAINERS and not _is_boilerplate(k["t"], False)]
        best = max(kids, key=_plain, default=None)
        if best is None or 10 * _plain(best) < 9 * _plain(here):
            break
        here = best
    rest = [([here], False), ([wrapper], False)]
    first = next((choice for choice in named if half(choice[0])), None)
    if first is not None:
        return [first, *(choice for choice in named if choice is not first), *rest]
    together = half(_find(wrapper, lambda t: any(r(t) for r, _ in rules)))
    return [*named, *rest] if together else [rest[0], *named, rest[1]]


def label(wrapper: Part) -> Part:
    """``wrapper`` with ``m`` set on slots: for each choice of the article's parts, 1 if inside and 2 if main text."""
    choices = _main_roots(wrapper)
    for i, (roots, sure) in enumerate(choices):
        slots = [s for root in roots for s in _slots(root)]
        varied = any(s["v"] for s in slots)
        for s in slots:
            menu = s["l"] > LINKED * s["c"]
            layout = varied and not s["v"] and s["n"] >= SAME_PAGES and s["c"] <= SAME_CHARS * s["n"]
            s.setdefault("m", [0] * len(choices))[i] = 1 if not sure and (menu or layout) else 2
    return wrapper


def main_text(page: Block, wrapper: Part) -> str:
    """Texts of the page in main slots of its host's labelled wrapper, joined by one space.

    Of the choices of the article's parts, the first one that the page has text in.
    """
    out: list[tuple[list[int], str]] = []

    def walk(block: Block, part: Part) -> None:
        at = 0
        items = part["k"]
        for kid in block.kids:
            tag = _plain_tag(kid.tag) if "b" in part else kid.tag
            order = (*range(at, len(items)), *range(at))  # onwards, else the next round of a repeated group
            found = next((i for i in order if items[i]["t"] == tag), None)
            if found is None:
                continue
            at = found
            if isinstance(kid, Text):
                if "m" in items[found]:
                    out.append((items[found]["m"], kid.value))
                if not items[found]["r"]:
                    at += 1
            else:
                walk(kid, items[found])
                if not items[found]["r"]:
                    at += 1

    walk(page, wrapper)
    best = min((next(i for i, x in enumerate(m) if x) for m, _ in out), default=0)
    return " ".join(value for m, value in out if m[best] == 2)


def host(url: Column) -> Column:
    """Lower-case host of an address, without port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def infer(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON) from rows ``host, html``: one row per host, from all of its pages.

    Each task folds its pages of a host into one wrapper, so a hot host sends one row per task; these are
    folded one after another, never held together.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Part] = {}
        for batch in batches:
            for name, html in zip(batch.column(0), batch.column(1), strict=True):
                key, new = name.as_py(), of_page(parse(html.as_py() or ""))
                held[key] = merge(held[key], new) if key in held else new
                if len(held) > HELD:
                    yield _rows(held)
                    held = {}
        yield _rows(held)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, built = None, None
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                new = json.loads(part.as_py())
                if key == name:
                    built = merge(built, new)
                else:
                    if name is not None:
                        yield _rows({name: built})
                    name, built = key, new
        if name is not None:
            yield _rows({name: built})

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            yield _rows({k.as_py(): label(json.loads(w.as_py())) for k, w in zip(*batch.columns, strict=True)})

    parts = pages.select("host", "html").mapInArrow(partial, "host string, wrapper string")
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(labelled, "host string, wrapper string")


def _rows(held: dict[str, Part]) -> pa.RecordBatch:
    texts = [json.dumps(p, separators=(",", ":")) for p in held.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(texts, pa.string())], names=["host", "wrapper"])


@lru_cache(maxsize=256)
def _loaded(wrapper: str) -> Part:
    return json.loads(wrapper)


def extract(df: DataFrame, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of every page.

    * Null or empty markup, and pages without main text, give an empty text. Pages without a host share one wrapper.
    * Character references are decoded; white space inside a block becomes one space, and blocks are joined by one.
    * Whole pages are read. Repeated rows are pages of their own. An empty table gives an empty result.
    * A column of the name of ``text`` is replaced; other columns are kept.
    """
    of, wrapper, key = free_name(df, "page_host", "wrapper", "wrapper_host")
    pages = df.withColumn(of, host(F.col(url)))
    found = stage(infer(pages.select(F.col(of).alias("host"), F.col(html).alias("html"))), "wrappers")

    @F.arrow_udf("string")
    def texts(markup: pa.Array, wrappers: pa.Array) -> pa.Array:
        pairs = zip(markup, wrappers, strict=True)
        return pa.array([main_text(parse(m.as_py()), _loaded(w.as_py())) if m.as_py() else "" for m, w in pairs], pa.string())

    joined = pages.join(found.select(F.col("host").alias(key), F.col("wrapper").alias(wrapper)), F.col(of) == F.col(key))
    kept = [c for c in df.columns if c != text]
    return joined.withColumn(text, texts(F.col(html), F.col(wrapper))).select(*kept, text)
