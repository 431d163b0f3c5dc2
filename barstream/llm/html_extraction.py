"""Main text of web pages by minimum cut.

A page is cut into blocks of text. What a block is like (its words, links, place in the tree and the names of the
elements around it) gives a cost for calling it content and one for calling it boilerplate. These costs are the
capacities between a block and the two terminals; neighbours on the page, and blocks under one element, are tied
by smoothness edges. The minimum cut splits the blocks at least total cost; what stays with the source is content.

Pages are independent: nothing is shuffled, and a task holds one slice of pages.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.token_counts import slice_texts

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
#: Elements of plain text: all up to their closing tag, or the page's end.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in ("script", "style", "textarea", "title")}
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")

_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table
tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in "noscript template iframe svg select".split()}  # with what they hold, if closed
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

#: What elements and names say about the text in them.
_BAD_ELEMENTS = frozenset("nav footer aside form menu button dialog fieldset label".split())
_GOOD_ELEMENTS = frozenset("article main".split())
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_BAD_NAMES = frozenset("""ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar navigation
menu menubar breadcrumb breadcrumbs sidebar aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice
alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus reply replies respond discussion share
sharing social related recommended recommendations more widget pagination pager search form copyright legal disclaimer skip hidden tags
outbrain taboola teaser paywall""".split())
_GOOD_NAMES = frozenset("article content post entry story main text body prose".split())
_LAYOUT_NAMES = frozenset("has with without no overflow".split())  # names like has-sidebar tell of the layout, not of the text
_FIRM_ELEMENTS = frozenset("nav footer aside dialog".split())      # hold no article, whatever is in them

_CERTAIN = 14.0    # cost of a bad hint on a block's nearest named element
_FIRM = 8.0        # of one on a named element above that: this much or less, by its distance
_WEAK = 3.5
_MOST = 8.0        # of all such hints together
_REMEMBERED = 16   # bad elements around a block; farther ones cost next to nothing
_LONG_WORDS = 20   # of a long paragraph
_LONG_BLOCKS = 2   # after an h1 show that an element holds the article

_SCALE = 1000


@dataclass
class Block:
    tag: str
    parent: int
    above: int
    good: bool
    hidden: bool
    inside: bool                       # of an article or main element
    depth: int                         # named elements around it
    hints: tuple[tuple[int, int, bool], ...]  # bad elements around it, outer ones first: number, depth, firm
    bad: bool = False                  # for certain
    doubt: float = 0.0                 # cost of bad hints farther away
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass(slots=True)
class Hints:
    good: bool = False
    bad: bool = False
    hidden: bool = False
    named: bool = False
    article: bool = False
    main: bool = False


def _hints(tag: str, attributes: str) -> Hints:
    hints = Hints(tag in _GOOD_ELEMENTS, tag in _BAD_ELEMENTS, False, False, tag in _GOOD_ELEMENTS, tag == "main")
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "role":
            role = value.lower()
            hints.main, hints.article = hints.main or role == "main", hints.article or role in ("main", "article")
            hints.good, hints.bad = hints.good or hints.article, hints.bad or role in _BAD_ROLES
        elif name in ("class", "id"):
            for part in value.split():
                words = {w.lower() for w in _NAME.findall(part)}
                hints.bad = hints.bad or words.isdisjoint(_LAYOUT_NAMES) and not words.isdisjoint(_BAD_NAMES)
                hints.good = hints.good or not words.isdisjoint(_GOOD_NAMES)
            hints.named = hints.named or tag in _BLOCKS and bool(value.strip())
        elif name == "style":
            hints.hidden = hints.hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        else:
            hints.hidden = hints.hidden or name == "hidden" or value.lower() == "true"
    hints.named = hints.named or hints.good or hints.bad
    hints.good = hints.good and not hints.bad
    return hints


def _weigh_hints(blocks: list[Block]) -> None:
    """What the bad elements around each block cost it. Elements that hold the article are not bad: those with an h1 and
    long paragraphs after it that no other bad element below them holds. Firm ones stay bad."""
    held: dict[int, list[Block]] = {}
    for block in blocks:
        for number, _, firm in block.hints:
            if not firm:
                held.setdefault(number, []).append(block)
    cancelled: set[int] = set()
    for number in sorted(held, reverse=True):  # elements below others come first
        titled, found = False, 0
        for block in held[number]:
            if any(other > number and other not in cancelled for other, _, _ in block.hints):
                continue
            if block.tag == "h1":
                titled = True
            elif titled and block.text.count(" ") + 1 >= _LONG_WORDS and block.linked <= 0.3 * len(block.text):
                found += 1
        if found >= _LONG_BLOCKS:
            cancelled.add(number)
    for block in blocks:
        block.bad = block.hidden
        for number, depth, firm in block.hints:
            if number in cancelled:
                continue
            if depth == block.depth:
                block.bad = True
            else:
                block.doubt += (_FIRM * 0.9 ** (block.depth - depth - 1)) if firm else (_WEAK * 0.5 ** (block.depth - depth - 1))
        block.doubt = min(block.doubt, _MOST)


def markup(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """(begin, end, closing, tag, attributes) of everything that is not text; comments and the like have no tag.

    Linear in the page: after the last ``>`` there is no more markup, and once a quote has no end before which its
    tag could close, quotes are read as other characters from there on.
    """
    last, at, quotes = page.rfind(">"), 0, True

    def tag_end(at: int) -> int:
        """The place of the tag's ``>``, those in quotes left out."""
        nonlocal quotes
        if quotes:
            look = at
            while stop := _STOP.search(page, look):
                if stop[0] == ">":
                    return stop.start()
                look = page.find(stop[0], stop.end()) + 1
                if not look:
                    break
            quotes = False
        return page.find(">", at)

    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, False, None, ""
        elif at > last:
            return
        elif page[at + 1] in "!?":
            end = page.find(">", at) + 1
            yield at, end, False, None, ""
        else:
            closing = page[at + 1] == "/"
            name = _TAG_NAME.match(page, at + 1 + closing)
            if not name:
                at += 1
                continue
            tag, end = name[0].lower(), tag_end(name.end())
            if tag in _RAW and not closing:
                found = _RAW[tag].search(page, end + 1)
                end = found.end() if found else len(page)
                yield at, end, False, None, ""
            else:
                attributes, end = page[name.end():end], end + 1
                end = max((yield at, end, closing, tag, attributes) or 0, end)
        at = end


def blocks_of(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    blocks: list[Block] = []
    # Open elements: tag, number, good, hidden, inside an article, inside a link, named elements so far, bad elements,
    # whether a firm one is among these, place of the nearest block element on the stack
    stack: list[tuple] = [("", 0, False, False, False, False, 0, (), False, 0)]
    open_tags: Counter[str] = Counter()
    number, at, current = 0, 0, None
    unclosed: set[str] = set()

    def add(text: str):
        nonlocal current
        if current is None:
            if not text.strip():
                return
            holder = stack[-1][9]
            above = stack[holder - 1][9] if holder else 0
            further = stack[above - 1][9] if above else 0
            _, _, good, hidden, inside, _, depth, around, _, _ = stack[-1]
            current = Block(stack[holder][0], stack[above][1], stack[further][1], good, hidden, inside, depth, around)
            blocks.append(current)
        current.pieces.append(text)
        if stack[-1][5]:
            current.linked += len(text.strip())

    def close(index: int):
        nonlocal current
        if stack[-1][9] >= index:
            current = None
        open_tags.subtract(e[0] for e in stack[index:])
        del stack[index:]

    found, skip_to = markup(page), None
    while True:
        try:
            begin, end, closing, tag, attributes = found.send(skip_to)
        except StopIteration:
            break
        skip_to = None
        if begin > at:
            add(page[at:begin])
        at = end
        if tag is None:
            continue
        if closing:
            if open_tags[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            elif tag in _BLOCKS:
                current = None
            continue
        if tag in _SKIPPED:
            if tag not in unclosed and not (tag == "svg" and attributes.endswith("/")):
                if over := _SKIPPED[tag].search(page, at):
                    at = skip_to = over.end()
                else:
                    unclosed.add(tag)
            continue
        if tag in _BLOCKS:
            if stack[-1][9] and (stack[stack[-1][9]][0] == "p" or stack[stack[-1][9]][0] in _CLOSES.get(tag, ())):
                close(stack[-1][9])
            current = None
        if tag in _VOID:
            if current is not None:
                current.pieces.append(" ")
            continue
        number += 1
        hints = _hints(tag, attributes)
        _, _, good, hidden, inside, link, depth, around, firm, holder = stack[-1]
        if tag == "header" and not inside:
            hints.bad = hints.named = True
        if tag != "body" and tag != "html":
            good, hidden, depth = good or hints.good, hidden or hints.hidden, depth + hints.named
            if hints.article:  # in it, only what is nearer counts
                around, firm = tuple(h for h in around if h[2] and not hints.main), firm and not hints.main
            if hints.bad:
                around = (*around, (number, depth, tag in _FIRM_ELEMENTS))
                if len(around) > _REMEMBERED:  # the nearest firm one is kept in any case
                    nearest = max((i for i, h in enumerate(around) if h[2]), default=1)
                    around = around[1:] if nearest else (around[0], *around[2:])
                firm = firm or tag in _FIRM_ELEMENTS
            inside = inside or hints.article and not firm
        open_tags[tag] += 1
        stack.append((tag, number, good, hidden, inside, link or tag == "a", depth, around, firm, len(stack) if tag in _BLOCKS else holder))
    if at < len(page):
        add(page[at:])
    for block in blocks:
        block.text = _SPACE.sub(" ", html.unescape("".join(block.pieces))).strip()
    blocks = [b for b in blocks if b.text]
    _weigh_hints(blocks)
    return blocks


def content_score(block: Block) -> float:
    """Log odds of being content."""
    words = block.text.count(" ") + 1
    score = 0.12 * (min(words, 30) - 8) - 5.0 * min(1.0, block.linked / len(block.text))
    if block.tag in ("p", "pre", "blockquote"):
        score += 1.0
    elif block.tag in ("h1", "h2", "h3", "h4"):
        score += 0.5
    elif block.tag in ("li", "div", "td"):
        score -= 0.3
    if block.text[-1] in ".!?…。":
        score += 0.4
    if block.inside:
        score += 5.0
    elif block.good:
        score += 2.5
    return score - (_CERTAIN if block.bad else block.doubt)


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: a positive score ties a node to it, a negative one to the sink."""
    n = len(scores)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    heads, room = [], []

    def tie(a: int, b: int, there: int, back: int):
        graph[a].append(len(heads)), heads.append(b), room.append(there)
        graph[b].append(len(heads)), heads.append(a), room.append(back)

    for i, score in enumerate(scores):
        if score > 0:
            tie(source, i, int(score * _SCALE), 0)
        elif score < 0:
            tie(i, sink, int(-score * _SCALE), 0)
    for a, b, weight in edges:
        tie(a, b, int(weight * _SCALE), int(weight * _SCALE))
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] and level[heads[e]] < 0:
                    level[heads[e]] = level[a] + 1
                    queue.append(heads[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if not room[e])
                at = heads[path[full] ^ 1]
                del path[full:]
                continue
            while tried[at] < len(graph[at]):
                e = graph[at][tried[at]]
                if room[e] and level[heads[e]] == level[at] + 1:
                    break
                tried[at] += 1
            else:
                if at == source:
                    break
                level[at] = -1
                at = heads[path.pop() ^ 1]
                continue
            path.append(e)
            at = heads[e]


def main_text(page: str) -> str:
    """Text of the content blocks, one a line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    scores = [content_score(b) for b in blocks]
    edges, last_below, last_above = [], {}, {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, 0.5 if blocks[i - 1].bad == block.bad else 0.15))
        for last, key, weight in ((last_below, (block.parent, block.bad), 0.8), (last_above, (block.above, block.bad), 0.3)):
            if key in last:
                edges.append((last[key], i, weight))
            last[key] = i
    return "\n".join(b.text for b, kept in zip(blocks, minimum_cut(scores, edges)) if kept)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, with text (empty if none) and n_chars.

    Null or empty pages have no text. Repeated rows give equal texts; null ids and urls are kept; an empty table
    gives none. A column named like a new one is replaced.
    """
    rest = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    read = pages.select(*rest, F.col(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found in slice_texts(batch.column(len(rest))):
                texts = pa.array([main_text(page) for page in found], pa.string())
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=[*rest, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(run, f"{fields}{', ' if rest else ''}`{text_col}` string").withColumn(
        "n_chars", F.length(text_col).cast("long"))
