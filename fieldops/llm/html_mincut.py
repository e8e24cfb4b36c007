"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks in page order.  A fixed linear classifier looks at a block's
words, links, tags and class names and says how much it costs to call it article text and how much
to call it boilerplate; these become capacities to two terminals.  Neighbouring blocks are joined
by edges that cost something to cut, more if they lie in the same part of the document tree.  The
minimum cut is the labelling of least total cost, found by maximum flow.

What a name, a role or a form says against an element is set aside where the page itself speaks for
it: if it holds the article, or more than half of the running text of its article or, on pages without
one, of the page.  A layout is called ``has-sidebar`` and a whole page may be one form; only what is beside the text is not
part of it.  Without any such sign, edges decide: a line too short to tell goes with its neighbours.

Rows: a null or empty page has an empty text.  Whatever is malformed is read as far as it makes
sense: open tags end with the page, stray end tags are ignored.  Repeated rows are read alike.
Further columns are passed on; of a name that is also a result's, the result stays.
"""
from __future__ import annotations

import re
from collections import Counter, deque
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from fieldops.llm import common as C

#: their content is never text of the page (fixed values of HTML)
SILENT = frozenset("script style template noscript title head iframe object svg math canvas audio video select textarea button option datalist".split())
#: tags that stay within a block (fixed values of HTML)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr br img input meta link".split())
#: what does not end an open head (fixed values of HTML)
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an open element that an opening tag ends, because it cannot hold it
IMPLIED_END = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
               "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"}}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

#: costs in tenths of a nat: what each sign says for article text (positive) or boilerplate
TAG_COST = {"article": 60, "main": 40, "nav": -90, "footer": -90, "aside": -90, "form": -90, "menu": -90, "dialog": -90,
            "header": -70, "figcaption": 10, "blockquote": 5}
GOOD_NAME = re.compile(r"(?:^|[-_\s])(?:article|post|entry|story|content|main|body|text|prose)(?:$|[-_\s])", re.I)
BAD_NAME = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|aside|widget|related|footer|foot|"
    r"header|masthead|topbar|toolbar|cookies?|consent|gdpr|notice|alert|popup|modal|newsletter|subscribe|signup|login|"
    r"comments?|comment-\w+|disqus|replies|share|sharing|social|follow|legal|copyright|disclaimer|pagination|pager|tags?|"
    r"search|form)(?:$|[-_\s])", re.I)
BAD_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: names of what readers wrote, which may well be most of a page
READERS = re.compile(r"(?:^|[-_\s])(?:comments?|comment-\w+|disqus|replies)(?:$|[-_\s])", re.I)
NAME_COST, BAD_NAME_COST = 25, -90
NEAR, SAME_PARENT = 4, 14
ARTICLE = frozenset(("article", "main"))


class Block:
    __slots__ = ("cost", "within", "letters", "linked", "parent", "parts")

    def __init__(self, parent: int):
        self.parent, self.cost, self.within, self.parts, self.linked, self.letters = parent, 0, [], [], 0, 0


class _Element:
    """What a tag and its attributes say: for or against article text, and whether that may be set aside."""
    __slots__ = ("parent", "cost", "soft", "article", "header", "letters", "holds")

    def __init__(self, parent: int, tag: str, attrs: list):
        self.parent, self.cost, self.soft, self.letters = parent, TAG_COST.get(tag, 0), 0, 0
        named = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden", "style")}
        names, role = f"{named.get('class', '')} {named.get('id', '')}", named.get("role", "").lower()
        self.article = self.holds = tag in ARTICLE or role in ARTICLE
        self.header = tag == "header"
        if tag in ("form", "header"):
            self.cost, self.soft = 0, TAG_COST[tag]
        if BAD_NAME.search(names) and tag not in ("article", "main", "body", "html"):
            if READERS.search(names):
                self.cost = min(self.cost, BAD_NAME_COST)
            self.soft = min(self.soft, BAD_NAME_COST)
        elif GOOD_NAME.search(names) and self.cost >= 0:
            self.cost += NAME_COST
        if role in BAD_ROLE:
            self.soft = min(self.soft, BAD_NAME_COST)
        if "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", ""):
            self.cost = min(self.cost, BAD_NAME_COST)


class _Page(HTMLParser):
    """Reads a page into blocks, each with its parent element and the elements that its text lies in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, element number, number of the innermost element at or above it that is no inline one
        self.stack: list[tuple[str, int, int]] = []
        self.open_tags: Counter[str] = Counter()
        self.elements = [_Element(0, "", [])]
        self.blocks: list[Block] = []
        self.open: Block | None = None
        self.links = 0
        self.silent = 0

    def settle(self) -> None:
        """The cost of each block from its elements, once the page is known as a whole."""
        every = self.elements
        for e in reversed(every[1:]):
            every[e.parent].letters += e.letters
            every[e.parent].holds |= e.holds
        costs, inside = [0], [0]  # inside: the nearest article around an element's children
        for e in every[1:]:
            above, own = costs[e.parent], e.cost
            # what holds the article, or most of an article or of a page without one, is no boilerplate whatever it is called
            around = inside[e.parent]
            ours = e.holds or ((around or not every[0].holds) and 2 * e.letters > every[around].letters)
            if e.soft < 0 and not ours and not (e.header and around and e.soft == TAG_COST["header"]):
                own = min(own, e.soft)
            if own < 0 or above < 0:
                costs.append(min(own, above) if own < 0 else above)
            else:
                costs.append(max(above, own) + min(above, own) // 4)
            inside.append(len(costs) - 1 if e.article else around)
        for b in self.blocks:
            found = [costs[n] for n in b.within]
            b.cost = found[0] if min(found) >= 0 else min(found)

    def _end_block(self) -> None:
        self.open = None

    def _end_head(self) -> None:
        """End a head that was left open, before what it cannot hold."""
        while self.stack and self.stack[-1][0] == "head":
            self._close(len(self.stack) - 1)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in HEAD:
            self._end_head()
        if tag == "br":
            self._text(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            return
        ends = IMPLIED_END.get(tag, frozenset()) | ({"p"} if tag in _ENDS_P else set())
        if ends:
            for i in range(len(self.stack) - 1, -1, -1) if any(self.open_tags[t] for t in ends) else ():
                if self.stack[i][0] in ends:
                    self._close(i)
                    break
                if self.stack[i][0] not in INLINE:
                    break
        if tag not in INLINE:
            self._end_block()
        number, above = len(self.elements), self.stack[-1] if self.stack else ("", 0, 0)
        self.elements.append(_Element(above[1], tag, attrs))
        self.stack.append((tag, number, above[2] if tag in INLINE else number))
        self.open_tags[tag] += 1
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def _close(self, at: int) -> None:
        for tag, _, _ in self.stack[at:]:
            self.open_tags[tag] -= 1
            self.silent -= tag in SILENT
            self.links -= tag == "a"
            if tag not in INLINE:
                self._end_block()
        del self.stack[at:]

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if self.open_tags[tag]:
            self._close(next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag))
        elif tag not in INLINE:
            self._end_block()

    def handle_data(self, data: str) -> None:
        self._text(data)

    def _text(self, data: str) -> None:
        if self.silent:
            if self.stack[-1][0] != "head" or not data.strip():
                return
            self._end_head()
        if self.open is None:
            if not data.strip():
                return
            # the element around the block's own
            own = self.stack[-1][1] if self.stack else 0
            self.open = Block(self.stack[-2][2] if len(self.stack) > 1 else 0)
            self.open.within.append(own)
            self.blocks.append(self.open)
        elif self.stack and self.stack[-1][1] != self.open.within[-1]:
            self.open.within.append(self.stack[-1][1])
        self.open.parts.append(data)
        n = sum(not c.isspace() for c in data) if len(data) < 200 else len(data)
        self.open.letters += n
        if self.links:
            self.open.linked += n
        else:
            self.elements[self.stack[-1][1] if self.stack else 0].letters += n


def read_blocks(html: str) -> list[tuple[str, Block]]:
    """(text, block) of all blocks with text, white space made single."""
    page = _Page()
    page.feed(html)
    page.close()
    page.settle()
    out = []
    for b in page.blocks:
        text = " ".join("".join(b.parts).split())
        if text:
            out.append((text, b))
    return out


def content_cost(text: str, block: Block) -> int:
    """How much more it costs to call the block boilerplate than article text."""
    words = text.count(" ") + 1
    cost = block.cost + min(words, 40) // 2 - 4
    cost += 6 if text[-1] in ".!?…:\"'”»" and words > 3 else 0
    return cost - 40 * block.linked // max(1, block.letters)


def min_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut.

    source, sink: capacities to the terminals; edges: (i, j, capacity) both ways.  Levels are found
    by breadth-first search and filled by depth-first search until the sink is out of reach."""
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(i: int, j: int, there: int, back: int) -> None:
        out[i].append(len(to))
        to.append(j)
        room.append(there)
        out[j].append(len(to))
        to.append(i)
        room.append(back)

    for i in range(n):
        both = min(source[i], sink[i])  # flows through at once
        if source[i] > both:
            add(s, i, source[i] - both, 0)
        if sink[i] > both:
            add(i, t, sink[i] - both, 0)
    for i, j, c in edges:
        add(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            i = queue.popleft()
            for e in out[i]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        arc = [0] * (n + 2)
        path: list[int] = []
        i = s
        while True:
            if i == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if not room[e])
                i = to[path[k] ^ 1]
                del path[k:]
                continue
            while arc[i] < len(out[i]):
                e = out[i][arc[i]]
                if room[e] and level[to[e]] == level[i] + 1:
                    break
                arc[i] += 1
            if arc[i] < len(out[i]):
                path.append(e)
                i = to[e]
            elif path:
                i = to[path.pop() ^ 1]
                arc[i] += 1
            else:
                break


def main_text(html: str) -> str:
    """The page's article, one block a line."""
    blocks = read_blocks(html)
    if not blocks:
        return ""
    costs = [content_cost(t, b) for t, b in blocks]
    edges, last = [], {}
    for i, (_, b) in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR))
        if b.parent in last:
            edges.append((last[b.parent], i, SAME_PARENT))
        last[b.parent] = i
    keep = min_cut([max(0, c) for c in costs], [max(0, -c) for c in costs], edges)
    return "\n".join(t for (t, _), k in zip(blocks, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """pages (html, ...) with text and n_chars (code points); html itself is dropped."""
    held = C.carry(pages, "html")
    schema = C.extended(held.schema, ("text", "string"), ("n_chars", "long"))

    def run(batches):
        for b in C.steps(batches, "html"):
            texts = [main_text(x.as_py() or "") for x in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.names)

    return C.restore(held.mapInArrow(run, schema), "text", "n_chars")
