"""Main text of web pages by minimum-cut labelling.

A page becomes its text blocks in order, each with the elements around it.  A
linear classifier over tag names, class and id words, link share and length
gives each block a cost of being content and of being boilerplate; these are
the capacities to the two terminals.  Blocks that follow one another, and
blocks of one container, are tied by smoothness edges that weaken with their
distance in the tree.  The minimum cut labels the page: blocks whose terminal
capacity outweighs their edges first, the rest by maximum flow.

A null or empty page has an empty text; a null page_id or url is carried along;
repeated rows are separate pages; an empty table gives an empty result.  A quote
that never closes ends with its tag, and a tag that never closes is text.  ``br``
counts as white space; comments, declarations and the elements in ``DROPPED``
never yield text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consolida.llm.common import rows_of

#: Comments, declarations and tags.  A quote counts after "=" alone, and only if it closes; else the tag ends at the next ">".
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")

DROPPED = frozenset("script style noscript template svg math iframe object head title textarea select button canvas audio video map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element that a start tag of these closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Weights of the classifier: by tag, and by words in class, id or role.
TAG_WEIGHTS = {"nav": -7.0, "footer": -7.0, "aside": -7.0, "form": -7.0, "menu": -7.0, "dialog": -7.0, "article": 3.0, "main": 2.0}
#: A header outside an article is the page's.
PAGE_HEADER = -7.0
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr login masthead menu modal navbar navigation nav newsletter notice notices notification overlay paywall popup privacy promo promoted promotion recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets complementary contentinfo banner dialog alert".split()
)
BAD_WORD, GOOD_WORD, HIDDEN = -7.0, 1.5, -9.0
GOOD_WORDS = frozenset("article content entry main post story text".split())
BIAS, OUTSIDE, UNMARKED, LINKS, LONG, SHORT = -0.2, -2.5, 1.0, -2.5, 1.5, -0.3
LONG_TEXT = 80
NEXT, SIBLING = 0.8, 0.6
TINY = 1e-9
#: Share of an edge's weight that stays between elements of other names or other evidence.
UNLIKE = 0.25
EXTRACTED = "page_id long, url string, text string, n_chars long, n_blocks long, cut double"


#: An open element of these keeps a paragraph around it from being ended by a block.
BARRIERS = ("table", "td", "th", "li", "div", "button")
CELLS = ("table", "td", "th")


class _Element:
    __slots__ = ("block", "depth", "good", "name", "parent", "score")

    def __init__(self, name: str, parent: _Element | None, score: float, good: bool):
        self.name, self.parent, self.score, self.good = name, parent, score, good
        self.depth = parent.depth + 1 if parent else 0
        self.block: _Element = self if parent is None or name in BLOCKS else parent.block


class _Stack:
    """Open elements, and by name the places of those that are open, so that no tag walks through all of them."""

    def __init__(self) -> None:
        self.open = [_Element("", None, 0.0, False)]
        self.places: dict[str, list[int]] = {}

    def push(self, e: _Element) -> None:
        self.places.setdefault(e.name, []).append(len(self.open))
        self.open.append(e)

    def cut(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop().name].pop()

    def last(self, *names: str) -> int:
        """The place of the innermost open element with one of these names; 0 if there is none."""
        return max(p[-1] if (p := self.places.get(n)) else 0 for n in names)


def _element(name: str, attributes: str, parent: _Element) -> _Element:
    score, good = parent.score, parent.good
    if name == "header":
        score += 0.0 if good else PAGE_HEADER
    elif name in TAG_WEIGHTS:
        score += TAG_WEIGHTS[name]
        good = good or name in ("article", "main")
    if attributes:
        bad = fine = False
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "style":
                score += HIDDEN if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else 0.0
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                score += HIDDEN
            elif key in ("class", "id", "role"):
                words = {w.lower() for w in _NAME_WORD.findall(value)}
                bad, fine = bad or bool(words & BAD_WORDS), fine or bool(words & GOOD_WORDS)
        if name not in ("body", "html"):
            score += BAD_WORD * bad + GOOD_WORD * (fine and not bad)
    return _Element(name, parent, score, good)


def blocks(html: str) -> list[tuple[str, _Element, int]]:
    """(text, innermost block element, characters inside links) of each text block in page order."""
    out: list[tuple[str, _Element, int]] = []
    stack, parts, linked, in_link, at = _Stack(), [], 0, 0, 0
    ends = html.rfind(">")

    def end() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                out.append((text, stack.open[-1].block, linked))
            parts.clear()
        linked = 0

    while True:
        m = _TAG.search(html, at) if at <= ends or html.find("<!--", at) >= 0 else None  # past the last ">" only a comment can begin
        piece = html[at : m.start()] if m else html[at:]
        if piece:
            parts.append(piece)
            linked += len(piece) if in_link else 0
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["close"] or m["close2"]:
            if name in BLOCKS:
                end()
            if name == "a":
                in_link = max(0, in_link - 1)
            place = stack.last(name)
            if place and (name in BLOCKS or place >= stack.last(*CELLS)):
                stack.cut(place)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in DROPPED:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            if name == "head" and not close:
                close = re.compile(r"(?=<body[\s>])", re.I).search(html, at)
            parts.append(" ")
            at = close.end() if close else len(html) if name not in ("head", "button", "select", "map") else at
            continue
        if name in BLOCKS:
            end()
            paragraph = stack.last("p")
            if paragraph > stack.last(*BARRIERS):  # a block element ends an open paragraph
                stack.cut(paragraph)
        for other in CLOSES.get(name, ()):
            if stack.open[-1].name == other:
                stack.cut(len(stack.open) - 1)
                break
        if name == "a":
            in_link += 1
        rest = m["rest"] if m["name"] else m["rest2"]
        if name not in VOID and not rest.rstrip().endswith("/"):
            stack.push(_element(name, rest, stack.open[-1]))
    end()
    return out


def unary(found: list[tuple[str, _Element, int]]) -> list[float]:
    """Cost of being boilerplate less cost of being content, of each block."""
    marked = any(e.good and e.score > -5 for _, e, _ in found)
    out = []
    for text, e, linked in found:
        score = BIAS + e.score + (UNMARKED if not marked else 0.0 if e.good else OUTSIDE)
        score += LINKS if linked * 2 > len(text) else 0.0
        score += LONG if len(text) >= LONG_TEXT else SHORT
        out.append(score)
    return out


def _distance(a: _Element, b: _Element) -> int:
    """Steps between two elements of the tree."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def _likeness(a: _Element, b: _Element) -> float:
    return 1.0 if a.name == b.name and abs(a.score - b.score) < 1 else UNLIKE


def smoothness(found: list[tuple[str, _Element, int]]) -> dict[tuple[int, int], float]:
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, (_, e, _) in enumerate(found):
        if i:
            before = found[i - 1][1]
            edges[i - 1, i] = NEXT / (1 + _distance(before, e)) * _likeness(before, e)
        above = id(e.parent)
        if above in last:
            key = last[above], i
            edges[key] = edges.get(key, 0.0) + SIBLING * _likeness(found[last[above]][1], e)
        last[above] = i
    return edges


def _settled(excess: list[float], near: list[list[tuple[int, float]]]) -> tuple[list[bool | None], list[float]]:
    """Sides of the nodes whose own excess outweighs all their edges, and what is left of the others' excess.

    Such a node takes its side in a minimum cut whatever its neighbours do; its
    edges then add to theirs, which may settle them too.
    """
    left, side = list(excess), [None] * len(excess)
    tied = [sum(w for _, w in edges) for edges in near]
    queue = list(range(len(excess)))
    while queue:
        i = queue.pop()
        if side[i] is not None or -tied[i] < left[i] <= tied[i] + TINY:
            continue
        side[i] = left[i] > 0
        for j, w in near[i]:
            if side[j] is None:
                left[j] += w if side[i] else -w
                tied[j] = max(0.0, tied[j] - w)
                queue.append(j)
    return side, left


def _flooded(left: list[float], near: list[list[tuple[int, float]]]) -> list[bool]:
    """Which nodes residual capacity reaches from the source after a maximum flow, by blocking flows over level graphs."""
    n, to, room = len(left), [], []
    arcs: list[list[int]] = [[] for _ in range(n)]
    for a in range(n):
        for b, w in near[a]:
            if a < b:
                arcs[a].append(len(to))
                arcs[b].append(len(to) + 1)
                to += b, a
                room += w, w
    while True:
        level, queue = [-1] * n, [i for i in range(n) if left[i] > TINY]
        for i in queue:
            level[i] = 0
        for a in queue:
            for e in arcs[a]:
                if room[e] > TINY and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if not any(left[i] < -TINY for i in queue):
            return [x >= 0 for x in level]
        current = [0] * n
        for source in [i for i in queue if level[i] == 0]:
            path: list[int] = []
            at = source
            while left[source] > TINY:
                if left[at] < -TINY:
                    push = min([left[source], -left[at], *(room[e] for e in path)])
                    left[source] -= push
                    left[at] += push
                    for e in path:
                        room[e] -= push
                        room[e ^ 1] += push
                    del path[next((k for k, e in enumerate(path) if room[e] <= TINY), len(path)) :]
                    at = to[path[-1]] if path else source
                    continue
                while current[at] < len(arcs[at]):
                    e = arcs[at][current[at]]
                    if room[e] > TINY and level[to[e]] == level[at] + 1:
                        break
                    current[at] += 1
                else:
                    if not path:
                        break
                    at = to[path.pop() ^ 1]
                    current[at] += 1
                    continue
                path.append(e)
                at = to[e]


def minimum_cut(excess: list[float], edges: dict[tuple[int, int], float]) -> tuple[list[bool], float]:
    """(is on the source's side, cut beyond the smaller terminal costs), with as few nodes on that side as can be.

    ``excess`` holds what is left of the terminal capacities after the flow
    straight through each node: positive towards the source, negative the sink.
    """
    near: list[list[tuple[int, float]]] = [[] for _ in excess]
    for (a, b), w in edges.items():
        if w > 0:
            near[a].append((b, w))
            near[b].append((a, w))
    side, left = _settled(excess, near)
    rest = [i for i, s in enumerate(side) if s is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        inside = [[(number[j], w) for j, w in near[i] if j in number] for i in rest]
        for i, s in zip(rest, _flooded([left[i] for i in rest], inside), strict=True):
            side[i] = s
    cut = sum(w for (a, b), w in edges.items() if w > 0 and side[a] != side[b])
    return side, cut + sum(abs(x) for x, s in zip(excess, side, strict=True) if s != (x > 0) and x)


def extract(html: str | None) -> tuple[str, int, float]:
    """(main text, blocks, cut)."""
    found = blocks(html or "")
    keep, cut = minimum_cut(unary(found), smoothness(found))
    return "\n".join(text for (text, _, _), k in zip(found, keep, strict=True) if k), len(found), cut


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(page_id, url, *extract(html)) for page_id, url, html in rows_of([batch], "page_id", "url", "html")]
        ids, urls, texts, counts, cuts = zip(*rows, strict=True) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array(cuts, pa.float64())],
            names=["page_id", "url", "text", "n_chars", "n_blocks", "cut"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, cut) of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_extracted, EXTRACTED)
