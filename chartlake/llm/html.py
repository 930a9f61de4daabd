"""Main text of web pages by wrapper induction.

Pages of one host are taken in groups. The block trees of a group are aligned with the tree
of one of them by simple tree matching. A text slot with the same content on nearly all
pages belongs to the template; slots that vary are content, inside and outside of articles.
Adverts and menus vary too: between slots that vary, the tag and the whole class names of
an element decide, unless that would leave most of the pages that bear them empty.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.shared import chosen, staged

GROUP_PAGES = 256
# A slot is template text if this share of at least so many different pages agrees on it, or
# all of fewer pages.
AGREE, AT_LEAST = 0.8, 5
# Scores of pairs of shapes that are remembered in a group of pages; others are computed anew.
REMEMBERED = 1 << 17
# Deeper elements count as part of the one around them.
DEEPEST = 200

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*))>|<[!?][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Content of these is never text of the page.
RAW = frozenset("script style title textarea noscript template svg iframe object canvas math".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("hr".split())
# Navigation and controls are never content.
NEVER = frozenset("head nav menu dialog button select".split())
# Tags and whole class, id or role names that settle what slots that vary leave open.
ASIDE = frozenset("footer header aside form search".split())
MARKS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar footer header masthead comment comments reply replies discussion cookie cookies cookie-banner "
    "cookie-consent cookie-notice consent notice notification popup modal newsletter subscribe share sharing social "
    "related breadcrumb breadcrumbs widget disclaimer".split()
)
# These hold the content, whatever they are called.
HOLDERS = frozenset("html body main article".split())
# An open element of the key closes when one of these begins inside it.
CLOSES = {
    "p": BLOCK, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "option": frozenset({"option", "optgroup"}),
}
TEXT = "#"


class Node:
    """A block element, or with label ``#`` a block of text."""

    __slots__ = ("label", "kids", "mark", "inside", "text", "linked", "shape")

    def __init__(self, label: str, mark: str = "", inside: bool = False, text: str = "", linked: bool = False):
        # The mark is the word that sets the element aside; inside: of an article or main element.
        self.label, self.mark, self.inside, self.text, self.linked = label, mark, inside, text, linked
        self.kids: list[Node] = []
        self.shape = 0


def mark_of(tag: str, names: list[str], parent: Node) -> str:
    """The word that sets an element aside, or none; its parts inherit it up to the next article."""
    if parent.mark in NEVER or tag in NEVER:
        return parent.mark if parent.mark in NEVER else tag
    if tag in HOLDERS:
        return "" if tag in ("article", "main") and parent.mark not in ASIDE else parent.mark
    if parent.mark:
        return parent.mark
    # The header of an article is its title, the footer of one is not text.
    if tag in ASIDE and not (tag == "header" and parent.inside):
        return tag
    return next((w for name in names for w in name.lower().split() if w in MARKS), "")


def parse(html: str) -> Node:
    """The tree of block elements and text blocks of a page, however broken its markup."""
    root = Node("page")
    open_nodes, tags = [root], [""]
    pieces: list[str] = []
    plain = links = 0  # characters of the block outside and inside links
    in_link = False
    at = 0

    def flush() -> None:
        nonlocal plain, links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                top = open_nodes[-1]
                top.kids.append(Node(TEXT, top.mark, top.inside, text, links > plain))
            pieces.clear()
        plain = links = 0

    def say(raw: str) -> None:
        nonlocal plain, links
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        n = len(text.strip())
        if in_link:
            links += n
        else:
            plain += n

    while True:
        found = TOKEN.search(html, at)
        if not found:
            say(html[at:])
            break
        if found.start() > at:
            say(html[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag in RAW:
            if not found[1] and not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif tag not in BLOCK:
            if tag == "a":
                in_link = not found[1]
            elif tag in ("br", "wbr", "img"):
                pieces.append(" " if tag != "wbr" else "")
        elif found[1]:
            flush()
            in_link = False
            if tag in tags:
                while tags.pop() != tag:
                    open_nodes.pop()
                open_nodes.pop()
        else:
            flush()
            in_link = False
            while tag in CLOSES.get(tags[-1], ()):
                tags.pop()
                open_nodes.pop()
            if tag in VOID:
                continue
            parent = open_nodes[-1]
            names = [next(filter(None, m.groups()[1:]), "") for m in ATTRIBUTE.finditer(found[3])] if found[3] else []
            mark = mark_of(tag, names, parent)
            node = parent
            if len(tags) <= DEEPEST or (mark and not parent.mark):
                node = Node(" ".join([tag, *sorted(names)]), mark, parent.inside or tag in ("article", "main"))
                parent.kids.append(node)
            open_nodes.append(node)
            tags.append(tag)
    flush()
    return root


class Alignment:
    """Simple tree matching of the trees of one group, exact in memory linear in the siblings.

    A shape numbers a label with the shapes of its children; how well two trees match
    depends on their shapes only.
    """

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.parts: list[tuple[int, tuple[int, ...]]] = []  # of each shape: label number, children
        self.sizes: list[int] = []
        self.labels: dict[str, int] = {}
        self.score = lru_cache(REMEMBERED)(self.score_anew)

    def add(self, root: Node) -> None:
        """Set the shapes of a tree."""
        order, stack = [], [root]
        while stack:
            order.append(stack.pop())
            stack += order[-1].kids
        for node in reversed(order):
            key = (self.labels.setdefault(node.label, len(self.labels)), tuple(k.shape for k in node.kids))
            node.shape = self.numbers.setdefault(key, len(self.parts))
            if node.shape == len(self.parts):
                self.parts.append(key)
                self.sizes.append(1 + sum(self.sizes[k] for k in key[1]))

    def score_anew(self, a: int, b: int) -> int:
        """Nodes of the best match of two shapes whose labels are equal."""
        if a == b:
            return self.sizes[a]
        x, y = self.parts[a][1], self.parts[b][1]
        first, last = equal_ends(x, y)
        same = sum(self.sizes[k] for k in x[:first]) + sum(self.sizes[k] for k in x[len(x) - last :])
        return 1 + same + int(self.best_scores(x[first : len(x) - last], y[first : len(y) - last])[-1])

    def best_scores(self, x: tuple[int, ...], y: tuple[int, ...]) -> np.ndarray:
        """The best score of all of ``x`` with each beginning of ``y``, one row at a time."""
        best = np.zeros(len(y) + 1, np.int64)
        if not x or not y:
            return best
        kinds, which = np.unique(np.array(y), return_inverse=True)
        labelled: dict[int, list[int]] = {}
        for at, kind in enumerate(kinds.tolist()):
            labelled.setdefault(self.parts[kind][0], []).append(at)
        kinds = kinds.tolist()
        before, worth = None, None
        for shape in x:
            if shape != before:
                gains = np.zeros(len(kinds), np.int64)
                for at in labelled.get(self.parts[shape][0], ()):
                    gains[at] = self.score(min(shape, kinds[at]), max(shape, kinds[at]))
                before, worth = shape, gains[which] if gains.any() else None
            if worth is not None:
                best[1:] = np.maximum(best[1:], best[:-1] + worth)
                np.maximum.accumulate(best, out=best)
        return best

    def pairs(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The pairs of text blocks of the best match of two trees with equal labels."""
        found, nodes = [], [(a, b)]
        while nodes:
            p, q = nodes.pop()
            if p.label == TEXT:
                found.append((p, q))
                continue
            # Hirschberg: halve the one list and find where the other is cut.
            runs = [(p.kids, q.kids)]
            while runs:
                x, y = runs.pop()
                xs, ys = tuple(k.shape for k in x), tuple(k.shape for k in y)
                first, last = equal_ends(xs, ys)
                nodes += zip(x[:first], y[:first])
                nodes += zip(x[len(x) - last :], y[len(y) - last :])
                x, y = x[first : len(x) - last], y[first : len(y) - last]
                if not x or not y:
                    continue
                if len(x) == 1:
                    gains = [
                        self.score(min(x[0].shape, k.shape), max(x[0].shape, k.shape)) if k.label == x[0].label else 0
                        for k in y
                    ]
                    at = max(range(len(y)), key=gains.__getitem__)
                    if gains[at]:
                        nodes.append((x[0], y[at]))
                    continue
                xs, ys = xs[first : len(xs) - last], ys[first : len(ys) - last]
                half = len(x) // 2
                ahead = self.best_scores(xs[:half], ys)
                behind = self.best_scores(xs[:half - 1 : -1], ys[::-1])[::-1]
                cut = int(np.argmax(ahead + behind))
                runs += [(x[:half], y[:cut]), (x[half:], y[cut:])]
        return found


def equal_ends(x, y) -> tuple[int, int]:
    """How many shapes are equal at the beginning and then at the end; matching them is best."""
    short = min(len(x), len(y))
    first = 0
    while first < short and x[first] == y[first]:
        first += 1
    last = 0
    while last < short - first and x[-1 - last] == y[-1 - last]:
        last += 1
    return first, last


def texts_of(node: Node) -> list[Node]:
    """Text blocks below a node in page order."""
    found, stack = [], [node]
    while stack:
        top = stack.pop()
        if top.label == TEXT:
            found.append(top)
        else:
            stack += reversed(top.kids)
    return found


def template_slots(roots: list[Node], different: list[int]) -> set[int]:
    """Text blocks with the same content in their slot on nearly all of the different pages.

    Slots are those of the page with the most text blocks. Where a text stands outside of
    all slots on enough pages, one of these pages is the next model, for what is left. On
    fewer than ``AT_LEAST`` pages all must agree, and what is inside of articles is left alone.
    """
    few = len(different) < AT_LEAST
    need = len(different) if few else max(AT_LEAST, ceil(AGREE * len(different)))
    own = {i: texts_of(roots[i]) for i in different}
    alignment = Alignment()
    for i in different:
        alignment.add(roots[i])
    first = model = max(different, key=lambda i: len(own[i]))
    held: set[int] = set()
    constant: list[list[Node]] = []
    while True:
        slots: dict[int, list[Node]] = {}
        for i in different:
            for mine, other in alignment.pairs(roots[model], roots[i]):
                if id(mine) not in held and id(other) not in held:
                    slots.setdefault(id(mine), []).append(other)
        for found in slots.values():
            held.update(map(id, found))
            text, n = Counter(t.text for t in found).most_common(1)[0]
            if n >= need:
                constant.append([t for t in found if t.text == text])
        loose: dict[str, list[int]] = {}
        for i in different:
            for text in {t.text for t in own[i] if id(t) not in held}:
                loose.setdefault(text, []).append(i)
        waiting = [pages[0] for pages in loose.values() if len(pages) >= need]
        if not waiting:
            break
        model = min(waiting)  # all of its blocks are held after its turn
    shown = [t for t in own[first] if t.mark not in NEVER]
    articles = any(t.inside for t in shown)
    template: set[int] = set()
    for inside in (False,) if few else (False, True):
        here = [c for c in constant if c[0].inside == inside]
        found = {id(t) for c in here for t in c}
        size = sum(len(t.text) for t in shown if t.inside == inside)
        # Where most of the text agrees, the pages are versions of one text.
        if 2 * sum(len(t.text) for t in shown if id(t) in found) <= size or (articles and not inside):
            template |= found
    return template


def extract_group(pages: list[str | None], marks: bool = True) -> list[str]:
    """Main texts of pages of one host; without ``marks``, what alignment alone gives."""
    roots = [parse(html or "") for html in pages]
    blocks = [[t for t in texts_of(root) if t.mark != "head"] for root in roots]
    # Copies of a page say nothing about its template.
    different = list({tuple(t.text for t in own): i for i, own in reversed(list(enumerate(blocks)))}.values())
    template = template_slots(roots, different) if len(different) > 1 else set()
    varying = [[t for t in own if id(t) not in template] for own in blocks]
    if not marks:
        return ["\n".join(t.text for t in own) for own in varying]
    able = [[t for t in own if t.mark not in NEVER and (t.inside or not t.linked)] for own in varying]
    # A mark says nothing where it leaves most of the pages that bear it without content.
    bears, empty = Counter(), Counter()
    for i in different:
        words = {t.mark for t in able[i]}
        bears.update(words)
        if "" not in words:
            empty.update(words)
    overruled = {w for w in bears if 2 * empty[w] > bears[w]} | {""}
    return ["\n".join(t.text for t in own if t.mark in overruled) for own in able]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The pages of a host are dealt to groups of about 256, so a host of any size is many
    groups; each induces its wrapper from its own pages. A null or malformed url has an
    empty host. Null and empty html give an empty text, as do pages that hold nothing but
    template. Repeated pages stay, and do not count as agreement. Null ids stay null. An
    empty table gives no rows. Other columns are ignored.
    """
    rows = chosen(pages, page_id=id_col, url=url_col, html=html_col).withColumn(
        "host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    )
    # Written, so that the planner broadcasts it only if it is in fact small.
    hosts = staged(
        rows.groupBy("host").agg(F.ceil(F.count("*") / F.lit(GROUP_PAGES)).alias("groups")), "hosts"
    )

    def texts(table: pa.Table) -> pa.Table:
        found = extract_group(table.column("html").to_pylist())
        return pa.table(
            {
                "page_id": table.column("page_id"), "url": table.column("url"),
                "text": pa.array(found, pa.string()),
                "n_chars": pa.array([len(t) for t in found], pa.int64()),
            }
        )

    return (
        rows.join(hosts, "host")
        .withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("groups")))
        .select("host", "part", "page_id", "url", "html")
        .groupBy("host", "part")
        .applyInArrow(texts, "page_id long, url string, text string, n_chars long")
    )
