"""Main text of web pages by minimum-cut labelling of text blocks.

A tolerant parser cuts a page into blocks of text with the chain of elements around each. A linear
classifier gives each block a cost for being called content and one for being called boilerplate; these
become terminal capacities. What an element's tag or names say against its text counts the less, the more of
the page's text it holds. Blocks that follow each other and blocks below the same element are tied by
smoothness edges. The minimum cut (max-flow by blocking flows) separates content from boilerplate at the
least total cost, and the content side is joined in page order.

Null or empty html: empty text. Pages that repeat are extracted each. No rows give no rows. White space
is what ``str.split`` takes for it; character references are decoded as in HTML 5. Columns other than
the three named are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shipped, slices

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template svg math head title iframe object canvas select option "
                    "textarea button datalist audio video map".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                   "p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Start tags that leave an open head open; any other ends it, as its end tag may be left out.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES = {"p": BLOCKS - {"body", "html"}, "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]),
          "dt": frozenset(["dd", "dt"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]),
          "th": frozenset(["td", "th", "tr"])}
CONTENT_TAGS = frozenset(["article", "main"])
BOILER_TAGS = frozenset("nav footer aside form menu dialog search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                         "form toolbar".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs sidebar aside widget widgets footer foot copyright cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "signin register share sharing social related recommended recommendations trending popular "
    "pagination pager search form toolbar masthead topbar hidden legal disclaimer tags taglist skip".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
#: First words of class names that say what a page has, lacks or is filed under, not what an element is; and words
#: that make a name one of the page's layout wherever they stand.
MODIFIERS = frozenset("no not without with has have category categories cat tag format status type".split())
LAYOUT_WORDS = frozenset("layout template".split())

_TOKEN = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


class Element:
    """An open or closed element: what its tag, role and names say, and how much text it holds.

    ``boiler``: the kinds of evidence against it (structure, words, comments).
    """

    __slots__ = ("tag", "parent", "boiler", "main", "named", "header", "chars", "holds_main")

    def __init__(self, tag: str, parent: Element | None, attrs: list):
        self.tag, self.parent, self.chars, self.holds_main = tag, parent, 0, False
        self.main, self.named = tag in CONTENT_TAGS, False
        self.header = tag == "header"
        self.boiler = {"structure"} if tag in BOILER_TAGS else set()
        for key, value in attrs:
            value = value or ""
            if key in ("class", "id"):
                for name in value.split():
                    self._name([w.lower() for w in _TOKEN.findall(name)])
            elif key == "role":
                if value.lower() in BOILER_ROLES:
                    self.boiler.add("structure")
                self.main |= value.lower() in ("main", "article")
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or \
                    key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                self.boiler.add("structure")

    def _name(self, words: list[str]) -> None:
        """Evidence of one class name or id."""
        found = set(words)
        if len(words) > 1 and words[0] in MODIFIERS or not found.isdisjoint(LAYOUT_WORDS):
            return
        if not found.isdisjoint(BOILER_WORDS):
            self.boiler.add("words")
        if not found.isdisjoint(COMMENT_WORDS):
            self.boiler.add("comments")
        self.named |= not found.isdisjoint(CONTENT_WORDS) and self.tag not in ("body", "html", "p")
        self.header |= "header" in found


class Block:
    __slots__ = ("element", "text", "linked", "heading")

    def __init__(self, element: Element, text: str, linked: int, heading: bool):
        self.element, self.text, self.linked, self.heading = element, text, linked, heading


class PageParser(HTMLParser):
    """Cuts a page into blocks; unclosed and wrongly nested elements are closed as browsers would."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Element("html", None, [])]
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.dropped = self.links = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                element = self.stack[-1]
                while element.tag not in BLOCKS and element.parent:
                    element = element.parent
                self.blocks.append(Block(element, text, min(self.linked, len(text)), element.tag[:1] == "h"
                                         and element.tag[1:].isdigit()))
            self.parts.clear()
        self.linked = 0

    def pop(self) -> None:
        tag = self.stack.pop().tag
        self.open[tag] -= 1
        self.dropped -= tag in DROPPED
        self.links -= tag == "a"

    def leave_head(self) -> None:
        while self.stack[-1].tag == "head":
            self.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "body" and not self.open.get("template"):
            while self.open.get("head"):
                self.close_to("head", ())
        if tag not in IN_HEAD:
            self.leave_head()
        if tag == "br" or tag == "img":
            self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            if self.open.get("p") and tag in CLOSES["p"]:
                self.close_to("p", ("article", "section", "div", "td", "th", "table", "li", "aside", "main"))
            ends = CLOSES.get(tag)
            if ends and tag != "p" and any(self.open.get(t) for t in ends):
                for t in ends:
                    if self.open.get(t):
                        self.close_to(t, ("ul", "ol", "dl", "table", "menu", "dir"))
        if tag in VOID:
            return
        self.stack.append(Element(tag, self.stack[-1], attrs))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.dropped += tag in DROPPED
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "br" and tag != "img" and tag not in BLOCKS:
            self.handle_endtag(tag)

    def close_to(self, tag: str, stops: tuple) -> None:
        """Close the innermost open ``tag`` with all in it, unless one of ``stops`` lies between."""
        for k in range(len(self.stack) - 1, 0, -1):
            at = self.stack[k].tag
            if at == tag:
                while len(self.stack) > k:
                    self.pop()
                return
            if at in stops:
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if self.open.get(tag):
            self.close_to(tag, () if tag in BLOCKS else ("p", "div", "article", "section", "td", "li", "body"))

    def handle_data(self, data):
        if data.strip():
            self.leave_head()
        if not self.dropped:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks_of(html: str) -> list[Block]:
    parser = PageParser()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


#: Weights of the classifier, in hundredths of a log-odd; positive speaks for content.
WEIGHTS = {"bias": 40, "structure": -600, "words": -450, "comments": -600, "main": 250, "named": 100, "site_header": -500,
           "link_density": -400, "long": 150, "short": -60, "sentence": 60, "heading": 60}
#: Shares of the page's text up to which evidence against an element counts in full, and from which on not at all:
#: what holds most of a page is a wrapper, whatever its name. Comments may well be longer than their article.
FADES = {"structure": (0.5, 0.9), "words": (0.4, 0.8), "comments": (0.8, 0.98)}
#: Least share of the page's text in the article that makes the elements around it wrappers.
MAIN_SHARE = 0.2
ADJACENT, SAME_PARENT, SAME_BRANCH = 60, 80, 25


def measure(blocks: list[Block]) -> int:
    """Notes in each element how much text it holds, and which elements are around the page's main element (the
    ``article`` or ``main`` with the most text outside comments); returns the page's text length."""
    mains: dict[int, Element] = {}
    for block in blocks:
        element = block.element
        while element:
            element.chars += len(block.text)
            if element.main:
                mains[id(element)] = element
            element = element.parent
    total = sum(len(b.text) for b in blocks)
    found = [m for m in mains.values() if m.chars >= MAIN_SHARE * total and not _commented(m)]
    above = max(found, key=lambda m: m.chars).parent if found else None
    while above:
        above.holds_main = True
        above = above.parent
    return total


def _commented(element: Element | None) -> bool:
    while element:
        if "comments" in element.boiler:
            return True
        element = element.parent
    return False


def _against(element: Element, total: int) -> float:
    """The strongest evidence that an element is boilerplate, weakened by its share of the text."""
    least, share = 0.0, element.chars / total
    for kind in element.boiler:
        full, none = FADES[kind]
        if share < none and not element.holds_main:
            least = min(least, WEIGHTS[kind] * min(1.0, (none - share) / (none - full)))
    return least


def evidence(block: Block, total: int) -> int:
    """The classifier: log-odds of content over boilerplate. ``total``: length of the page's text."""
    words = block.text.count(" ") + 1
    found = WEIGHTS["bias"]
    found += int(WEIGHTS["link_density"] * block.linked / len(block.text))
    found += WEIGHTS["long"] if words >= 15 else WEIGHTS["short"] if words < 4 else 0
    found += WEIGHTS["sentence"] * (block.text[-1] in ".!?…。”\"")
    found += WEIGHTS["heading"] * block.heading
    element, against, main, named, header = block.element, 0.0, False, False, False
    while element:
        against = min(against, _against(element, total))
        header |= element.header and not element.holds_main and not main and element.chars < 0.5 * total
        main |= element.main
        named |= element.named
        element = element.parent
    # a header inside the main element is the article's own
    found += WEIGHTS["main"] if main else WEIGHTS["named"] * named + WEIGHTS["site_header"] * header
    return found + int(against)


def minimum_cut(gain: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut.

    ``gain`` > 0 is the capacity from the source, < 0 that to the sink; edges carry flow both ways.
    Blocking flows are searched along the distance levels from the source (Dinic).
    """
    n = len(gain)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            edge(source, i, g, 0)
        elif g < 0:
            edge(i, sink, -g, 0)
    for (a, b), capacity in edges.items():
        edge(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                cut = len(path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if not room[e] and k < cut:
                        cut = k
                del path[cut:]
                node = to[path[-1]] if path else source
                continue
            while at[node] < len(out[node]):
                e = out[node][at[node]]
                if room[e] and level[to[e]] == level[node] + 1:
                    path.append(e)
                    node = to[e]
                    break
                at[node] += 1
            else:
                if not path:
                    break
                at[to[path[-1] ^ 1]] += 1
                path.pop()
                node = to[path[-1]] if path else source


def label(blocks: list[Block]) -> list[bool]:
    """True for content."""
    total = measure(blocks)
    gain = [evidence(b, total) for b in blocks]
    edges: dict[tuple[int, int], int] = {}
    last_below: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges[i - 1, i] = edges.get((i - 1, i), 0) + ADJACENT
        for element, capacity in ((block.element.parent, SAME_PARENT),
                                  (block.element.parent and block.element.parent.parent, SAME_BRANCH)):
            if element is not None:
                j = last_below.get(id(element))
                if j is not None:
                    edges[j, i] = edges.get((j, i), 0) + capacity
                last_below[id(element)] = i
    return minimum_cut(gain, edges)


def main_text(html: str) -> str:
    blocks = blocks_of(html)
    return " ".join(b.text for b, keep in zip(blocks, label(blocks)) if keep) if blocks else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [main_text(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return shipped(rows).mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
