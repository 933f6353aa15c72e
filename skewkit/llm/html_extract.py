"""Main-text extraction from raw HTML by minimum-cut labelling.

A page is cut into blocks: runs of text between block-level tags, each with the
path of elements it stands in. A linear classifier turns a block's features (its path,
class names, length, links, punctuation) into the log odds of being content;
they become the capacities of its edge to the content or the boilerplate
terminal. Smoothness edges join blocks that follow each other, and blocks that
are neighbours under the same parent, so that a doubtful block goes
with its surroundings. The minimum cut is the labelling of least total cost.

A boilerplate word in a class, id or role counts against an element only if it names the element's own role
(``sidebar``, ``cookie-notice``) or, in other names (``comments-x``), if the element holds a small share of the text; never
in names of a state or layout (``has-sidebar``, ``comments-open``), and never on what holds an article or nearly all of the text.

Elements inside a line count as well: hidden ones give no text, and adverts, share links and form labels are blocks of their own
for the cut, in the same line; where they go, the parts of the line around them are joined again. Other inline elements change nothing.

Scripts, styles, markup, comments in the markup and hidden parts give no block; ``aria-hidden`` parts are
seen by readers, and formulas are text (without their annotations). Character
references are decoded, white space inside a block becomes one space, blocks
are joined in page order by an empty line; nothing else is dropped or cut.

Results: a null, empty or text-free page gives an empty text. Broken markup is read
leniently: missing end tags are implied, stray ones ignored, a ``<`` that opens nothing
is text. Pages are independent rows; repeated ones come out alike, null urls and ids stay.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_slices

#: Elements that end a block where they begin and end.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is never text of the page.
RAW_TAGS = frozenset("script style noscript template textarea iframe object svg annotation annotation-xml canvas audio video head title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a new element of the kind implicitly ends.
IMPLIED_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select div article section main aside body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Words of class, id and role values that mark boilerplate.
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner sidebar "
    "sidenav menu nav navbar navigation topbar breadcrumb breadcrumbs masthead header footer foot contentinfo complementary "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog newsletter subscribe "
    "subscription signup signin login register search searchform share sharing sharebar social related recommended "
    "recommendations trending widget widgets comment comments commentlist reply replies respond disqus discussion "
    "pagination pager toolbar legal copyright disclaimer skip hidden tags taglist toc form paywall rail".split())
GOOD_WORDS = frozenset("article articlebody content entry main post story text prose".split())
#: Words of names that say where or how an element stands, not what it is.
PLACE_WORDS = frozenset(
    "site page global main top bottom left right primary secondary tertiary box block container wrapper wrap inner outer section area "
    "list bar item items group panel region col column row unit slot body content module link links primary js id the my".split())
#: Words of names that tell a state or layout of an element that is something else.
STATE_WORDS = frozenset(
    "has have no non not with without hide hides show shows is are open opened closed enabled disabled on off allow allowed layout "
    "supports free visible using use".split())
#: Words of class, id and role values that make an inline element a block of its own, and what may stand beside them.
INLINE_BAD = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion share sharing sharebar "
    "newsletter subscribe signup login".split())
INLINE_PLACE = PLACE_WORDS | {"button", "btn", "icon", "text", "label", "inline", "span"}
#: An element with a bad role is spared if it holds this share of the text, one with a bad word in another name,
#: or beside the name of a content role, at HINT_SHARE.
ROLE_SHARE = 0.8
HINT_SHARE = 0.3
#: What counts against elements of a bad role.
BAD_ROLE = 8.0
BAD_TAGS = {"nav": 9.0, "footer": 8.0, "aside": 8.0, "form": 8.0, "button": 8.0, "select": 8.0, "option": 8.0, "menu": 8.0,
            "dialog": 8.0, "fieldset": 6.0, "legend": 6.0, "label": 6.0}

_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*)>"
    r"|<[!?/][^>]*>", re.S)
_attribute = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_word = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_hidden_style = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An open element: its tag, the prior of what stands in it, and what it says about its content.

    The prior is known once the page is read (``settle``): it depends on the share of the text in the element.
    """

    __slots__ = ("tag", "parent", "prior", "in_article", "hidden", "own", "good", "share", "chars", "plain", "holds_article", "region")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.prior = self.own = 0.0
        self.good = False
        self.share = 0.0                # spared from this share of the text on; 0: nothing speaks against it
        self.chars = self.plain = 0     # of text, and of text in no element with a bad word below this one
        self.region = (0, 0)            # plain and all characters of what is spared around
        self.in_article = (parent.in_article if parent else False) or tag in ("article", "main")
        self.holds_article = tag == "main"
        self.hidden = parent.hidden if parent else False
        if tag in ("article", "main") and not (parent and parent.in_article):
            self.own += 4.0
        if tag in BAD_TAGS:
            self.own -= BAD_TAGS[tag]
        elif tag == "header" and not self.in_article:
            self.own -= 7.0
        if attrs and not attrs.isspace():
            self._read(attrs)

    def _read(self, attrs: str) -> None:
        good_role = False
        for name, *values in _attribute.findall(attrs):
            value = values[0] or values[1] or values[2]
            name = name.lower()
            if name == "style":
                self.hidden |= bool(_hidden_style.search(value))
            elif name == "hidden":
                self.hidden = True
            elif name == "aria-hidden":
                if value.lower() == "true" and not self.in_article:
                    self.share = max(self.share, HINT_SHARE)
            elif name in ("class", "id", "role", "itemprop"):
                for token in value.split():
                    words = {w.lower() for w in _word.findall(token)}
                    self.good |= not words.isdisjoint(GOOD_WORDS)
                    good_role |= words.isdisjoint(BAD_WORDS) and not words.isdisjoint(GOOD_WORDS)
                    bad = words & BAD_WORDS - ({"header"} if self.in_article else set())
                    if bad and words.isdisjoint(STATE_WORDS):
                        role = all(w in bad or w in PLACE_WORDS or w.isdigit() for w in words)
                        self.share = max(self.share, ROLE_SHARE if role else HINT_SHARE)
        if good_role:
            self.share = min(self.share, HINT_SHARE)

    def settle(self) -> None:
        """Set the prior; the parent's is set."""
        if self.parent:
            self.prior, self.region = self.parent.prior, self.parent.region
        else:
            self.region = (self.plain, self.chars)
        self.prior += self.own
        bad = self.share and self.parent and self.tag != "article" and not self.holds_article
        clean, everything = self.region
        if bad and not (self.chars and self.chars >= self.share * (self.chars + clean) and 2 * self.chars >= everything):
            self.prior -= BAD_ROLE
        else:
            if bad:
                self.region = (clean + self.plain, self.chars)
            if self.good and not self.in_article:
                self.prior += 2.0


def _apart(name: str, attrs: str) -> bool:
    """Whether an inline element is an advert, a share link or a form's label."""
    if name == "label":
        return True
    for key, *values in _attribute.findall(attrs):
        if key.lower() in ("class", "id", "role"):
            for token in (values[0] or values[1] or values[2]).split():
                words = {w.lower() for w in _word.findall(token)}
                if not words.isdisjoint(INLINE_BAD) and words <= INLINE_BAD | INLINE_PLACE and words.isdisjoint(STATE_WORDS):
                    return True
    return False


def _hides(attrs: str) -> bool:
    return any(key.lower() == "hidden" or key.lower() == "style" and _hidden_style.search(values[0] or values[1] or values[2])
               for key, *values in _attribute.findall(attrs))


class Block:
    """A run of text, the element it stands in, and how much of it are links. Parts of one line have its number (``line``)
    and whether white space stands before and after them."""

    __slots__ = ("text", "element", "linked", "line", "spaced")

    def __init__(self, text: str, element: Element, linked: int, line: int = 0, spaced: tuple[bool, bool] = (True, True)):
        self.text, self.element, self.linked, self.line, self.spaced = text, element, linked, line, spaced

    def odds(self) -> float:
        """Log odds of being content."""
        words = self.text.count(" ") + 1
        tag = self.element.tag
        share = min(1.0, self.linked / max(len(self.text), 1))
        odds = self.element.prior + min(words, 40) / 20 - 4.0 * share
        if tag == "p":
            odds += 1.0
        elif tag in HEADINGS:
            odds += 0.8
        elif tag in ("li", "td", "th", "dt", "dd"):
            odds -= 0.2
        if self.text[-1] in ".!?…。！？\"”»":
            odds += 0.5
        if "©" in self.text and not self.element.in_article:
            odds -= 3.0
        return odds


def blocks(html: str) -> list[Block]:
    """The visible text blocks of a page, in page order."""
    out: list[Block] = []
    top = Element("html", "", None)
    stack = [top]
    elements = [top]
    pieces: list[str] = []
    state = {"linked": 0, "link": False, "line": 0, "hidden": 0}
    inline: list[tuple[str, str, int]] = []       # open inline elements: name, what it does, elements around it

    def cut() -> None:
        """End a part of a line."""
        raw = "".join(pieces)
        text = " ".join(raw.split())
        if text and not stack[-1].hidden:
            out.append(Block(text, stack[-1], state["linked"], state["line"], (raw[0].isspace(), raw[-1].isspace())))
        pieces.clear()
        state["linked"] = 0

    def flush() -> None:
        cut()
        state["link"] = False
        state["line"] += 1

    def close(first: int) -> None:
        """End the open inline elements from ``first`` on."""
        for _, kind, depth in reversed(inline[first:]):
            if kind == "hidden":
                state["hidden"] -= 1
            elif kind == "apart" and depth < len(stack):
                cut()
                del stack[depth:]
        del inline[first:]

    def close_outside() -> None:
        """End the inline elements of elements that have ended."""
        first = next((i for i, (_, _, depth) in enumerate(inline) if depth > len(stack)), len(inline))
        close(first)

    def add(raw: str) -> None:
        if state["hidden"]:
            return
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if state["link"]:
            state["linked"] += len(text)

    at, n, last_end = 0, len(html), html.rfind(">")
    while at < n:
        m = _token.search(html, at) if at <= last_end or "<!--" in html[at:at + 4] else None
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name == "a":
                state["link"] = False
            elif name in BLOCK_TAGS:
                flush()
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), 0)
                if depth:
                    del stack[depth:]
                    close_outside()
            if inline and name not in BLOCK_TAGS:
                first = next((i for i in range(len(inline) - 1, -1, -1) if inline[i][0] == name), None)
                if first is not None:
                    close(first)
            continue
        if name in RAW_TAGS:
            closed = m["attrs"].endswith("/")
            if name in ("head", "title") or not closed:
                end = re.compile(rf"</{name}\b[^>]*>" + (r"|(?=<body\b)" if name == "head" else ""), re.I).search(html, at)
                if end:
                    at = end.end()
                elif name in ("script", "style"):
                    at = n
            if name not in ("head", "title"):
                pieces.append(" ")
            continue
        if name == "br" or name == "img":
            pieces.append(" ")
        elif name == "a":
            state["link"] = True
        if name in BLOCK_TAGS:
            flush()
            if name == "html" or name == "body":
                if m["attrs"].strip():
                    stack[0]._read(m["attrs"])
                continue
            if name == "hr":
                continue
            _end_implied(stack, name)
            close_outside()
            stack.append(Element(name, m["attrs"], stack[-1]))
            elements.append(stack[-1])
        elif name not in VOID_TAGS and not m["attrs"].endswith("/"):
            attrs = m["attrs"]
            plain = not attrs or attrs.isspace()
            if not plain and _hides(attrs):
                state["hidden"] += 1
                inline.append((name, "hidden", len(stack)))
            elif (name == "label" or not plain) and _apart(name, attrs):
                cut()
                inline.append((name, "apart", len(stack)))
                stack.append(Element(name, attrs, stack[-1]))
                elements.append(stack[-1])
            elif inline:                                    # its end must not end one of the kinds above
                inline.append((name, "", len(stack)))
    flush()
    _settle(elements, out)
    return out


def _settle(elements: list[Element], found: list[Block]) -> None:
    """The priors of a page's elements, in page order (parents first)."""
    for b in found:
        chars = len(b.text) - b.linked
        b.element.chars += chars
        b.element.plain += chars
    for e in reversed(elements[1:]):
        if e.tag not in BAD_TAGS and e.tag != "header":      # what has a boilerplate tag is no text for what is around it
            e.parent.chars += e.chars
            e.parent.plain += 0 if e.share else e.plain
    articles = [e for e in elements if e.tag == "article" and not e.share]
    if articles:                                             # others may be teasers and comments
        max(articles, key=lambda e: e.chars).holds_article = True
    for e in reversed(elements[1:]):
        e.parent.holds_article |= e.holds_article
    for e in elements:
        e.settle()


def _end_implied(stack: list[Element], name: str) -> None:
    if stack[-1].tag == "p":                       # a block-level start tag ends a paragraph
        stack.pop()
    if stack[-1].tag in HEADINGS and name in HEADINGS | {"p", "div", "article", "section", "ul", "ol", "table"}:
        stack.pop()
    ends = IMPLIED_ENDS.get(name)
    if ends:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                del stack[i:]
                return
            if stack[i].tag in SCOPES:
                return


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other and between neighbours under one parent."""
    edges, last = [], {}
    for i, b in enumerate(found):
        parent = b.element.parent or b.element
        if i:
            before = found[i - 1].element
            same = (before.parent or before) is parent
            edges.append((i - 1, i, 1.0 if same else 0.25 if before.in_article == b.element.in_article else 0.05))
        key = id(parent)
        if key in last and last[key] < i - 1:
            edges.append((last[key], i, 0.8))
        last[key] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut.

    A node's positive odds are the capacity of its edge from the source, negative ones of its edge to
    the sink; ``edges`` are undirected. Augments along shortest paths, level by level (Dinic's algorithm).
    """
    n = len(odds)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def link(u: int, v: int, there: float, back: float) -> None:
        graph[u].append(len(to))
        to.append(v)
        room.append(there)
        graph[v].append(len(to))
        to.append(u)
        room.append(back)

    for i, c in enumerate(odds):
        if c > 0:
            link(source, i, c, 0.0)
        elif c < 0:
            link(i, sink, -c, 0.0)
    for u, v, c in edges:
        link(u, v, c, c)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                keep = next(i for i, e in enumerate(path) if room[e] <= least)
                u = to[path[keep] ^ 1]
                del path[keep:]
            while tried[u] < len(graph[u]):
                e = graph[u][tried[u]]
                if room[e] > least and level[to[e]] == level[u] + 1:
                    path.append(e)
                    u = to[e]
                    break
                tried[u] += 1
            else:
                if u == source:
                    break
                level[u] = -2
                u = to[path.pop() ^ 1]
                tried[u] += 1


def label(found: list[Block]) -> list[bool]:
    """Which blocks are content."""
    return minimum_cut([b.odds() for b in found], smoothness(found)) if found else []


def main_text(html: str | None) -> tuple[str, int, int]:
    """The main text, the number of blocks and of content blocks."""
    found = blocks(html) if html else []
    chosen = [b for b, yes in zip(found, label(found), strict=True) if yes]
    parts = []
    for i, b in enumerate(chosen):
        if i and chosen[i - 1].line == b.line:
            parts.append(" " if chosen[i - 1].spaced[1] or b.spaced[0] else "")
        elif i:
            parts.append("\n\n")
        parts.append(b.text)
    return "".join(parts), len(found), len(chosen)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_content_blocks`` of each page."""
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        made = [main_text(h) for h in part.column("html").to_pylist()]
        return pa.record_batch({
            "page_id": part.column("page_id"), "url": part.column("url"),
            "text": pa.array([m[0] for m in made], pa.string()),
            "n_chars": pa.array([len(m[0]) for m in made], pa.int64()),
            "n_blocks": pa.array([m[1] for m in made], pa.int64()),
            "n_content_blocks": pa.array([m[2] for m in made], pa.int64())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_slices(rows, run, "page_id long, url string, text string, n_chars long, n_blocks long, n_content_blocks long",
                      column="html")
