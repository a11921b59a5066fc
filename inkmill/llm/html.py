"""Main text of HTML pages: text-to-tag ratios of lines from the standard library's parser.

The parser's events cut a page into lines at block elements.

1. A line's ratio is its characters over its tags; a tag of a link counts more, as lines of links are menus.
   ``PRIOR`` weighs it by what HTML says of the elements around: more in an article, much less in a form or where
   a class or id has a word of ``DOUBTFUL``.  A weight alone takes nothing out: if a whole page is in a form, all lines weigh less.
2. The ratios are smoothed over the lines with a Gaussian kernel.
3. The threshold is the standard deviation of the smoothed ratios, as is usual for this method, and their
   maximum at most.  Lines of one container are a cluster; it is content if lines from the threshold on hold most of its characters.
4. Clusters beside content in the same container join it if they are no more doubtful than all of it and not mostly links, so that short
   paragraphs and lists of an article stay; so do headings right before content.
5. Reader comments whose container has no telling name are known by their structure: after content, one container has
   REPLIES containers or more of one tag and class, without headings, most of which begin with a short line such as a name.

Only elements that HTML itself sets apart from the text (navigation, footers, scripts and the like) are left out
whatever their ratios are.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody template textarea tfoot thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset("article blockquote body center details div dl figure form header hgroup main ol section table ul".split())
#: Elements that HTML sets apart from the text, or that hold no text to read.
LEFT_OUT = frozenset("aside audio button canvas datalist dialog footer head iframe input label menu nav noscript object option script search select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
ARTICLE = frozenset("article main".split())
#: Words of class and id names that make a container doubtful; they weigh a ratio and exclude nothing.
DOUBTFUL = frozenset("ad ads advert advertisement banner comment comments consent cookie disqus notice popup promo related replies share sidebar social sponsored subscribe widget".split())
#: Weights of a line's ratio inside an article, and inside a form or a doubtful container.
IN_ARTICLE, IN_DOUBT = 4.0, 1 / 16
#: Doubtful containers in each other that weigh.
MOST_DOUBTS = 3
#: Containers alike that make a list of comments, and characters of the line that one begins with, at most.
REPLIES, SHORT = 3, 80
#: Containers above a line that may be one comment, or their list.
ABOVE = 3
#: Tags that each tag of a link counts as.
LINK_TAGS = 3
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SHARE = 0.5
RADIUS, SIGMA = 2, 1.0


class Container:
    """A place in the tree of containers; each line belongs to the innermost around it."""

    __slots__ = ("parent", "prior", "doubts", "kind", "article")

    def __init__(self, parent: Container | None, prior: float, doubts: int, kind: str, article: bool) -> None:
        #: How many containers from here up are doubtful, and tag and class.
        self.parent, self.prior, self.doubts, self.kind, self.article = parent, prior, doubts, kind, article


class Line:
    __slots__ = ("text", "tags", "linked", "at", "heading")

    def __init__(self, text: str, tags: int, linked: int, at: Container | None, heading: bool) -> None:
        self.text, self.tags, self.linked, self.at, self.heading = text, tags, linked, at, heading


class PageLines(HTMLParser):
    """Lines of a page in order; a line that is left out has no container (``at`` is None) and no text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        root = Container(None, 1.0, 0, "", False)
        #: Open elements: tag, container (None: left out), whether an article is around.
        self.stack: list[tuple[str, Container | None, bool]] = [("", root, False)]
        self.places: dict[str, list[int]] = {}
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def cut(self) -> None:
        tag, at, _ = self.stack[-1]
        text = " ".join("".join(self.parts).split()) if at is not None else ""
        if text or self.tags:
            self.lines.append(Line(text, self.tags, self.linked, at, tag in HEADINGS))
        self.parts, self.tags, self.linked = [], 0, 0

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            self.places[self.stack.pop()[0]].pop()

    def _open(self, tag: str, stop: frozenset[str]) -> int | None:
        """Place of the innermost open ``tag`` above any of ``stop``."""
        own = self.places.get(tag)
        if not own or own[-1] < len(self.stack) - 1 and any(p and p[-1] > own[-1] for p in map(self.places.get, stop) if p):
            return None
        return own[-1]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
            self.tags += 1
            return
        if tag in BLOCK:
            self.cut()
            if (at := self._open("p", CONTAINER | {"button", "li", "td"})) is not None:
                self._pop(at)
            if tag in ("li", "dd", "dt", "tr") and (at := self._open(tag, frozenset(("ul", "ol", "dl", "table")))) is not None:
                self._pop(at)
        elif tag in ("td", "th"):
            self.parts.append(" ")
        self.tags += LINK_TAGS if tag == "a" else 1
        if tag in VOID:
            return
        _, at, inside = self.stack[-1]
        if at is not None:
            at = self._within(tag, dict(attrs), at, inside)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, at, inside or tag in ARTICLE))

    def _within(self, tag: str, attrs: dict[str, str | None], at: Container, inside: bool) -> Container | None:
        """The container for what is in this element; None if that is left out."""
        if tag in LEFT_OUT or tag == "header" and not inside:
            return None
        if tag not in ("html", "body"):
            if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or _HIDDEN.search(attrs.get("style") or ""):
                return None
            if (attrs.get("role") or "").lower() in ROLES:
                return None
        names = attrs.get("class") or attrs.get("id")
        doubtful = tag == "form" or bool(names) and any(x.lower() in DOUBTFUL for x in _NAME.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}"))
        if tag not in CONTAINER and not doubtful:
            return at
        prior = at.prior * (IN_DOUBT if doubtful and at.doubts < MOST_DOUBTS else 1) * (IN_ARTICLE if tag in ARTICLE and not inside else 1)
        return Container(at, prior, at.doubts + doubtful, f"{tag} {attrs.get('class') or ''}", inside or tag in ARTICLE)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += LINK_TAGS if tag == "a" else 1
        if tag in BLOCK:
            self.cut()
        elif tag in ("td", "th"):
            self.parts.append(" ")
        if (at := self._open(tag, frozenset() if tag in BLOCK or tag in LEFT_OUT else BLOCK)) is not None:
            self._pop(at)

    def handle_data(self, data: str) -> None:
        if self.stack[-1][1] is None:
            return
        self.parts.append(data)
        if self.places.get("a"):
            self.linked += len(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...`` of any kind is a comment, as in browsers."""
        return self.parse_bogus_comment(i)


def lines_of(html: str) -> list[Line]:
    page = PageLines()
    page.feed(html)
    page.close()
    page.cut()
    return page.lines


def text_to_tag(lines: list[Line]) -> np.ndarray:
    """Weighed ratios; 0 for what is left out."""
    return np.array([0.0 if x.at is None else x.at.prior * len(x.text) / max(1, x.tags) for x in lines])


def smoothed(ratios: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    x = np.arange(-radius, radius + 1)
    kernel = np.exp(-(x**2) / (2 * sigma**2))
    return np.convolve(np.pad(ratios, radius), kernel / kernel.sum(), "valid")


def replies(lines: list[Line], use: list[int], clusters: dict[int, list[int]], chosen: set[int]) -> set[int]:
    """Clusters of ``chosen`` that are comments: parts of a list of containers alike that stands after other chosen text and outside its article."""
    lists: dict[int, dict[int, list[int]]] = {}
    held: dict[int, Container] = {}
    for i in use:
        item = lines[i].at
        for _ in range(ABOVE):
            if item is None or item.parent is None:
                break
            held[id(item)] = item
            lists.setdefault(id(item.parent), {}).setdefault(id(item), []).append(i)
            item = item.parent
    out: set[int] = set()
    for items in lists.values():
        kinds: dict[str, list[int]] = {}
        for c in items:
            kinds.setdefault(held[c].kind, []).append(c)
        for kind, own in kinds.items():
            if len(own) < REPLIES or kind.startswith(("table ", "ul ", "ol ", "dl ")) or any(held[c].article for c in own):
                continue
            parts = [items[c] for c in own]
            begun = sum(len(p) > 1 and len(lines[p[0]].text) <= SHORT for p in parts)
            if 3 * begun < 2 * len(parts) or any(lines[i].heading for p in parts for i in p):
                continue
            inside = {i for p in parts for i in p}
            own_clusters = {id(lines[i].at) for i in inside}
            before = [c for c in chosen - own_clusters if clusters[c][-1] < min(inside)]
            if before:
                out |= own_clusters & chosen
    return out


def content_lines(lines: list[Line], level: np.ndarray) -> list[int]:
    """Numbers of the lines that are main text, by the smoothed ratios ``level``."""
    use = [i for i, x in enumerate(lines) if x.text]
    if not use:
        return []
    threshold = min(level.std(), level[use].max())
    clusters: dict[int, list[int]] = {}
    for i in use:
        clusters.setdefault(id(lines[i].at), []).append(i)
    size = {c: sum(len(lines[i].text) for i in own) for c, own in clusters.items()}
    above = {c: sum(len(lines[i].text) for i in own if level[i] >= threshold) for c, own in clusters.items()}
    chosen = {c for c in clusters if above[c] >= SHARE * size[c]}
    if not chosen:
        chosen = {max(clusters, key=lambda c: (above[c], size[c]))}

    chosen -= replies(lines, use, clusters, chosen)

    # Clusters beside content: in a container of content, or between contents of one parent.
    held = {id(lines[own[0]].at): lines[own[0]].at for own in clusters.values()}
    rank = {c: k for k, c in enumerate(clusters)}  # by first line
    between: dict[int, tuple[int, int]] = {}
    for c in chosen:
        lo, hi = between.get(id(held[c].parent), (rank[c], rank[c]))
        between[id(held[c].parent)] = min(lo, rank[c]), max(hi, rank[c])
    doubt = min(held[c].doubts for c in chosen)
    listed = replies(lines, use, clusters, set(clusters))
    for c, own in clusters.items():
        around = id(held[c].parent)
        lo, hi = between.get(around, (rank[c], rank[c]))
        if (around in chosen or lo < rank[c] < hi) and held[c].doubts <= doubt and c not in listed and 2 * sum(lines[i].linked for i in own) <= size[c]:
            chosen.add(c)
    taken = [i for i in use if id(lines[i].at) in chosen]
    # Headings right before content.
    place = {i: k for k, i in enumerate(use)}
    heads = set()
    for i in taken:
        k = place[i] - 1
        while k >= 0 and lines[use[k]].heading and id(lines[use[k]].at) not in chosen and use[k] not in heads and lines[use[k]].at.doubts <= doubt:
            heads.add(use[k])
            k -= 1
    return sorted(heads.union(taken))


def main_text(html: str | None) -> str:
    """Blocks of the content in page order, joined by an empty line; '' if there is none."""
    if not html:
        return ""
    lines = lines_of(html)
    return "\n\n".join(lines[i].text for i in content_lines(lines, smoothed(text_to_tag(lines))))


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns of ``pages`` but the HTML, with the main text in ``text_col``.

    A column of that name is replaced; others stay, whatever their names.  A null or empty page, and one without main
    text, has ''.  Repeated rows stay; an empty table stays empty.  Broken HTML is read as
    far as the parser reads it; the whole page is read, however long or deep.
    """
    keep = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower())]
    base = pages.select(*map(common.col, keep), html_col)
    schema = common.with_field(pages.select(*map(common.col, keep)).schema, text_col, "string")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in b.column(len(keep)).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], names=[*keep, text_col])

    return common.map_arrow(base, run, schema, rows=200)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
