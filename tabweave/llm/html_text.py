"""Main text of web pages by tree scoring.

A page is read into a flat list of elements with their parents. Menus, adverts, forms and the like are left out with all
they hold. Every block of text gives points for its length and commas to its container, half of them to the next
ancestor and a third to the one above; points of a container shrink with the share of its text inside links. The best
container (or the article around it) and the siblings that look like text are kept, whole and in page order.

Words of class or id are weaker signs: the page is read with such elements first, and again without those that hold neither
the main element, nor the article with most points, nor (where nothing else looks like content) most points of the page.

A page is one row: work and memory follow the longest page, nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPLIT_NAME = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

#: Fixed values of HTML: elements without content, with raw content, that start a block, that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre li td th dd dt h1 h2 h3 h4 h5 h6 blockquote figcaption caption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the key is ended by a start of one of the values, up to the nearest of `SCOPE`.
ENDED_BY = {
    "p": BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "legend"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"},
    "tr": {"tr", "tbody"},
    "option": {"option"},
}
SCOPE = {"p": {"table", "td", "th", "button"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}}

#: Elements, roles and words of class or id that mark what is not the article.
LEFT_OUT = frozenset("nav footer aside form menu dialog button fieldset header head".split()) | RAW
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs captcha comment comments consent cookie cookies "
    "discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination "
    "popup promo promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar topbar widget widgets".split()
)
NEUTRAL_BEFORE = frozenset("has no with without".split())
CONTENT_WORDS = frozenset("article content entry main post story text body".split())
BONUS = 25.0

#: The open elements that a start tag ends; elements that such a search does not go beyond.
ENDS = {tag: [k for k, by in ENDED_BY.items() if tag in by] for tag in frozenset().union(*ENDED_BY.values())}
BARRIERS = (*SCOPE["p"], *SCOPE["li"], "dl")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _names(value: str) -> set[str]:
    """Words of a class or id, without those that only say what a page has or has not."""
    out = set()
    for name in value.split():
        words = [w.lower() for w in SPLIT_NAME.split(name.lower() if name.isupper() else name) if w]
        out.update(w for i, w in enumerate(words) if not i or words[i - 1] not in NEUTRAL_BEFORE)
    return out


class Page:
    """Elements of a page (parallel lists) and its text pieces in order; a piece None ends a block."""

    def __init__(self, html: str, without: frozenset[int] = frozenset()):
        """`without`: numbers of elements to hide."""
        self.tags, self.parents, self.bonus, self.starts, self.ends = ["#"], [-1], [0.0], [0], [0]
        self.pieces: list[tuple[int, str | None, bool]] = []
        self._open, self._hidden, self._links = [0], -1, 0
        #: Depths of the open elements by tag.
        self._at: dict[str, list[int]] = defaultdict(list)
        self._without = without
        #: Elements with a left-out word; main elements and articles, and whether they are more than an article.
        self.doubtful: set[int] = set()
        self.mains: dict[int, bool] = {}
        self._read(html)
        self.ends[0] = len(self.pieces)

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = TOKEN.search(html, at)
            self._text(html[at : m.start() if m else n])
            if not m:
                return
            at = m.end()
            if m["cdata"] is not None:
                self._text(m["cdata"])
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            if m["end"] or m["end2"]:
                self._end(tag)
                continue
            self._start(tag, _attributes(m["rest"] or m["rest2"] or ""))
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else n
                self._end(tag)

    def _text(self, text: str) -> None:
        if text and self._hidden < 0:
            self.pieces.append((self._open[-1], unescape(text) if "&" in text else text, self._links > 0))

    def _boundary(self) -> None:
        if self._hidden < 0 and self.pieces and self.pieces[-1][1] is not None:
            self.pieces.append((self._open[-1], None, False))

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        if ended := self._depth(ENDS.get(tag, ())):
            if ended >= self._depth(BARRIERS):
                self._close_to(ended)
        if tag == "br":
            self._text(" ")
        if tag in BLOCK:
            self._boundary()
        if tag in VOID:
            return
        words = _names(attributes.get("class", "")) | _names(attributes.get("id", ""))
        role = attributes.get("role", "").lower()
        main = tag in ("article", "main") or role in ("main", "article") or attributes.get("itemprop") == "articleBody"
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._open[-1])
        self.bonus.append(BONUS if main or tag in BLOCK and words & CONTENT_WORDS else 0.0)
        self.starts.append(len(self.pieces))
        self.ends.append(-1)
        self._at[tag].append(len(self._open))
        self._open.append(node)
        self._links += tag == "a"
        style = attributes.get("style", "").replace(" ", "").lower()
        unseen = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
        unwanted = tag in LEFT_OUT and not (tag == "header" and self._at["article"]) or role in LEFT_OUT_ROLES
        if words & LEFT_OUT_WORDS and not main and tag not in ("body", "html"):
            self.doubtful.add(node)
        elif main and not words & LEFT_OUT_WORDS:
            self.mains[node] = not (tag == "article" or role == "article") or attributes.get("itemprop") == "articleBody"
        if self._hidden < 0 and (unseen or unwanted or node in self._without):
            self._hidden = len(self._open) - 1

    def _depth(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element of some tags, 0 without any."""
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=0)

    def _end(self, tag: str) -> None:
        if tag in ("body", "html"):
            return
        if at := self._depth((tag,)):
            self._close_to(at)

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            node = self._open[-1]
            if self.tags[node] in BLOCK:
                self._boundary()
            self._open.pop()
            self._at[self.tags[node]].pop()
            self._links -= self.tags[node] == "a"
            self.ends[node] = len(self.pieces)
            if self._hidden >= len(self._open):
                self._hidden = -1

    def blocks(self, first: int, last: int) -> Iterator[tuple[int, str, int]]:
        """Element, text and characters inside links of each block among some pieces."""
        parts: list[str] = []
        node, linked = 0, 0
        for at, text, link in [*self.pieces[first:last], (0, None, False)]:
            if text is not None:
                node = node if parts else at
                parts.append(text)
                linked += len(text) if link else 0
            elif parts:
                if joined := " ".join("".join(parts).split()):
                    yield node, joined, linked
                parts, linked = [], 0

    def left_out(self) -> frozenset[int]:
        """The doubtful elements that do not hold the article."""
        n = len(self.tags)
        points = [0.0] * n
        for node, text, link in self.blocks(0, len(self.pieces)):
            points[node] += (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(1.0, link / len(text)))
        for i in range(n - 1, 0, -1):
            points[self.parents[i]] += points[i]
        articles = [i for i, more in self.mains.items() if not more and points[i]]
        holders = {max(articles, key=lambda i: (points[i], -i))} if articles else set()
        holders |= {i for i, more in self.mains.items() if more and points[i]}
        holds = [i in holders for i in range(n)]
        for i in range(n - 1, 0, -1):
            holds[self.parents[i]] |= holds[i]
        # For each element the doubtful one around it (or itself), and content known in that and outside of it.
        around, known, out = [0] * n, [0] * n, set()
        for i in range(1, n):
            around[i] = i if i in self.doubtful else around[self.parents[i]]
            known[around[i]] += self.bonus[i] > 0 and points[i] > 0 and i not in self.doubtful
        outside = [0] * n
        for i in range(1, n):
            up = around[self.parents[i]]
            outside[i] = outside[up] + known[up] if i in self.doubtful else 0
            if i in self.doubtful and not holds[i] and (outside[i] or 2 * points[i] <= points[0]):
                out.add(i)
        return frozenset(out)

    def _container(self, node: int) -> int:
        """The element that a block of text gives its points to."""
        while node and self.tags[node] not in BLOCK:
            node = self.parents[node]
        while node and self.tags[node] in PARAGRAPH:
            node = self.parents[node]
        return node

    def main_text(self) -> str:
        n = len(self.tags)
        for i in range(n):
            if self.ends[i] < 0:
                self.ends[i] = len(self.pieces)
        points, chars, linked = [0.0] * n, [0] * n, [0] * n
        given: set[int] = set()
        for node, text, link in self.blocks(0, len(self.pieces)):
            share = 1 + text.count(",") + min(len(text) / 100, 3)
            chars[node] += len(text)
            linked[node] += link
            to = self._container(node)
            for part in (1, 2, 3):
                points[to] += share / part
                given.add(to)
                if not to:
                    break
                to = self.parents[to]
        if not given:
            return ""
        for i in range(n - 1, 0, -1):
            chars[self.parents[i]] += chars[i]
            linked[self.parents[i]] += linked[i]
        density = [min(1.0, linked[i] / chars[i]) if chars[i] else 0.0 for i in range(n)]
        score = {i: (points[i] + self.bonus[i]) * (1 - density[i]) for i in given}
        best = max(score, key=lambda i: (score[i], -i))
        up = best
        while up:
            if self.tags[up] in ("article", "main"):
                best = up
                break
            up = self.parents[up]
        kept = []
        for i in range(n):
            if self.parents[i] != self.parents[best] or self.ends[i] == self.starts[i]:
                continue
            alike = score.get(i, 0.0) >= max(10.0, 0.2 * score.get(best, 0.0)) and density[i] < 0.5
            texty = self.tags[i] in PARAGRAPH and density[i] < 0.25
            if i == best or alike or texty and self.tags[best] not in ("article", "main", "body"):
                kept.append((self.starts[i], self.ends[i]))
        if not best:
            kept = [(0, len(self.pieces))]
        return "\n".join(text for first, last in kept for _, text, _ in self.blocks(first, last))


def main_text(html: str | None) -> str:
    """The article of a page: character references decoded, white space inside a block one space, blocks joined by \\n."""
    if not html:
        return ""
    page = Page(html)
    out = page.left_out() if page.doubtful else None
    return out and Page(html, out).main_text() or page.main_text()


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """Key columns of every page with `text` (empty for null, empty or text-free pages) and `n_chars` (its code points).

    Repeated rows are read alike, each by itself; markup may be broken or cut off; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                found = [main_text(x.as_py()) for x in rows.column(len(keys))]
                columns = [rows.column(i) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=names)

    source = pages.select(*[pages[k] for k in keys], pages[html].cast("string").alias("_html"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    names = [*keys, "text", "n_chars"]
    return source.mapInArrow(run, f"{head}, text string, n_chars long")
