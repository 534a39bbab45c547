"""Main text of web pages by minimum-cut labelling of blocks.

A page becomes a row of text blocks with their path of open elements. A linear
classifier turns a block's path, class names, links and length into a score; positive
scores are the cost of calling it boilerplate, negative ones of calling it content. These are the
capacities to the two terminals. Smoothness edges join neighbours, stronger the
more of their paths they share, and all blocks of one container through a node
of its own. The minimum cut, found by maximum flow, is the cheapest labelling; blocks on the
content side are the text.

Defined results: null, empty and text-free html give an empty text. Markup that is not closed
ends with the page, a head with the first thing that cannot be in it, and only a closed
svg, object or select is left out; formulas are text. "<" that starts no tag is text. Character references are decoded, white
space within a block becomes one space, blocks are joined by one newline. Pages are read whole,
one by one; repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.words import extended, pieces

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|title)(?=[\s>/])(?>\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?>\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"\s(?:hidden(?=[\s/=]|\Z)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z]+")

# Elements by their role in HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr output picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
#: Formulas run within a line; what annotates them is not shown.
MATH = frozenset("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split())
#: May stand within a paragraph; their text is none of the page's once they are closed.
EMBEDDED = frozenset("svg object select".split())
#: All that can be in a head, besides what is read raw.
IN_HEAD = frozenset("html head base link meta".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_ITSELF = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
#: What an open item may not be closed across.
SCOPE = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table"}
AWAY = frozenset("nav footer aside form menu dialog button fieldset header".split())
HOME = frozenset("article main".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
AWAY_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login"
    " sidebar widget related recommended recommendations share sharing social comment comments commentlist reply replies respond disqus breadcrumb breadcrumbs menu nav navbar navigation"
    " footer header masthead copyright toolbar pager pagination skip search complementary contentinfo form teaser".split()
)
HOME_NAMES = frozenset("article content post entry main story articlebody".split())
#: What heads an article where its class also names one, such as entry-header.
HEADS = frozenset("header masthead banner".split())
#: A class with such a part tells the state of the page, such as has-sidebar or comments-open.
STATES = frozenset("has no with without open closed".split())

AWAY_SCORE, HOME_SCORE, AWAY_NAME_SCORE, HOME_NAME_SCORE, PROSE_SCORE = -6.0, 2.5, -6.0, 1.0, 0.8
EMBEDDED_SCORE = -12.0
NEIGHBOUR, CONTAINER = 0.8, 0.3


class Block:
    __slots__ = ("parts", "linked", "path", "text")

    def __init__(self, path):
        self.path, self.parts, self.linked, self.text = path, [], 0, ""


def blocks(html: str) -> list[Block]:
    """Text blocks in page order. A path is a tuple of (serial number, tag, score of its names)."""
    out: list[Block] = []
    path: list[tuple[int, str, float]] = []
    current, anchors, serial, at, muted, deep, homes = None, 0, 0, 0, False, 0, 0
    ended_by_tag: set[int] = set()

    def cut(k: int) -> None:
        nonlocal deep, homes
        deep -= sum(x[1] in EMBEDDED for x in path[k:])
        homes -= sum(x[1] in HOME for x in path[k:])
        del path[k:]

    def leave_head() -> None:
        if path and path[-1][1] == "head":
            path.pop()

    def add(piece: str) -> None:
        nonlocal current
        if piece and not muted:
            if not piece.isspace():
                leave_head()
            if current is None:
                current = Block(tuple(path))
                out.append(current)
            current.parts.append(piece)
            current.linked += len(piece) * (anchors > 0)

    for m in _TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            if m["raw"]:
                current = None
            continue
        tag, close, rest = tag.lower(), m["close"] or m["close2"], m["rest"] or m["rest2"] or ""
        if not close and tag not in IN_HEAD:
            leave_head()
        if tag in MATH:
            ends = close and (tag == "math" or tag.startswith("annotation"))
            muted = not ends and (muted or tag.startswith("annotation"))
            continue
        muted = False
        if tag in INLINE:
            if tag == "a":
                anchors = 0 if close else 1
            elif tag == "br":
                add(" ")
            continue
        current = None
        if tag not in EMBEDDED and (not deep or tag in PROSE):
            anchors = 0
        if close:
            for k in range(len(path) - 1, -1, -1):
                if path[k][1] == tag:
                    if tag in EMBEDDED:
                        ended_by_tag.add(path[k][0])
                    cut(k)
                    break
            continue
        if path and path[-1][1] == "p" and tag not in EMBEDDED:
            path.pop()
        ended = ENDS_ITSELF.get(tag, "").split()
        if ended and tag != "p":
            stop = SCOPE.get(tag, "").split()
            for k in range(len(path) - 1, -1, -1):
                if path[k][1] in stop:
                    break
                if path[k][1] in ended:
                    cut(k)
                    break
        if tag not in VOID and not rest.endswith("/"):
            serial += 1
            path.append((serial, tag, 0.0 if tag in ("html", "body") else _name_score(rest, homes > 0)))
            homes += tag in HOME
            deep += tag in EMBEDDED
    add(html[at:])
    for b in out:
        b.text = " ".join(unescape("".join(b.parts)).split())
    found = [b for b in out if b.text]
    holders = _holders(found)
    if ended_by_tag or holders:
        for b in found:
            b.path = tuple((k, tag, (max(names, 0.0) if k in holders else names) + EMBEDDED_SCORE * (k in ended_by_tag)) for k, tag, names in b.path)
    return found


def _name_score(attributes: str, inside: bool) -> float:
    if not attributes:
        return 0.0
    score = AWAY_NAME_SCORE if _HIDDEN.search(attributes) else 0.0
    for m in _NAMES.finditer(attributes):
        score += _value_score((m[1] or m[2] or m[3] or "").lower(), inside)
    return score


def _value_score(value: str, inside: bool) -> float:
    """A class that is wholly an AWAY name decides, then one with a HOME name, then one with an AWAY part."""
    home = part = False
    for name in value.split():
        parts = set(_SPLIT.split(name)) - {""}
        away = parts & AWAY_NAMES
        if away and away == parts:
            return AWAY_NAME_SCORE
        if parts & HOME_NAMES and (not away or inside and away <= HEADS):
            home = True
        elif away and not parts & STATES:
            part = True
    return HOME_NAME_SCORE if home else AWAY_NAME_SCORE if part else 0.0


def _holders(found: list[Block]) -> set[int]:
    """The elements around a main or around the article with most text: their names do not tell what is in these."""
    sizes: dict[int, int] = {}
    around: dict[int, tuple[str, list[int]]] = {}
    for b in found:
        for k, (serial, tag, _) in enumerate(b.path):
            if tag in HOME:
                sizes[serial] = sizes.get(serial, 0) + len(b.text)
                around.setdefault(serial, (tag, [x[0] for x in b.path[:k]]))
                if tag == "article":
                    break
    articles = [x for x in around if around[x][0] == "article"]
    chosen = [x for x in around if around[x][0] == "main"] + ([max(articles, key=lambda x: (sizes[x], -x))] if articles else [])
    return {x for c in chosen for x in around[c][1]}


def score(block: Block) -> float:
    """The classifier: above 0 speaks for content."""
    total, inside = -0.4 if block.path else 0.2, False
    for _, tag, names in block.path:
        total += names
        if tag in HOME:
            total += 0 if inside else HOME_SCORE
            inside = True
        elif tag in AWAY and not (tag == "header" and inside):
            total += AWAY_SCORE
    if block.path and block.path[-1][1] in PROSE:
        total += PROSE_SCORE
    words = block.text.count(" ") + 1
    total += min(1.5, 0.4 * math.log2(1 + words / 4))
    return total - 2.0 * min(1.0, block.linked / max(len(block.text), 1))


def content_side(scores: list[float], edges: list[tuple[int, int, float]], nodes: int) -> list[bool]:
    """Minimum cut between content and boilerplate: Dinic's maximum flow on the terminals and the smoothness edges."""
    source, sink = nodes, nodes + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(nodes + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0.0)
        elif s < 0:
            join(i, sink, -s, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    while True:
        level = [-1] * (nodes + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(len(scores))]
        turn = [0] * (nodes + 2)
        way: list[int] = []
        x = source
        while True:  # depth first along rising levels, with an explicit stack
            if x == sink:
                flow = min(room[e] for e in way)
                cut = 0
                for k, e in enumerate(way):
                    room[e] -= flow
                    room[e ^ 1] += flow
                for k, e in enumerate(way):
                    if room[e] <= 1e-9:
                        cut = k
                        break
                x = to[way[cut] ^ 1]
                del way[cut:]
                continue
            moved = False
            while turn[x] < len(out[x]):
                e = out[x][turn[x]]
                if room[e] > 1e-9 and level[to[e]] == level[x] + 1:
                    way.append(e)
                    x = to[e]
                    moved = True
                    break
                turn[x] += 1
            if not moved:
                if x == source:
                    break
                level[x] = -1
                x = to[way.pop() ^ 1]


def smoothness(found: list[Block]) -> tuple[list[tuple[int, int, float]], int]:
    """Edges between neighbours and to a node for each container with several blocks; the number of nodes."""
    edges = []
    held: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if len(b.path) > 1:
            held.setdefault(b.path[-2][0], []).append(i)
        if i:
            before = found[i - 1].path
            shared = sum(1 for p, q in zip(before, b.path) if p[0] == q[0])
            apart = len(before) + len(b.path) - 2 * shared
            edges.append((i - 1, i, NEIGHBOUR / (1 + apart)))
    nodes = len(found)
    for own in held.values():
        if len(own) > 1:
            edges += [(i, nodes, CONTAINER) for i in own]
            nodes += 1
    return edges, nodes


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    if not found:
        return ""
    edges, nodes = smoothness(found)
    keep = content_side([score(b) for b in found], edges, nodes)
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points) instead of the html. These names win over clashing columns."""
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    source = pages.select(*keep, html)
    schema = extended(pages.select(*keep).schema, "text string, n_chars long")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, html):
                texts = [main_text(x.as_py()) for x in piece.column(piece.num_columns - 1)]
                rest = list(piece.columns[:-1])
                yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return source.mapInArrow(run, schema)
