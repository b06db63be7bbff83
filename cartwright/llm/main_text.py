"""Main text of web pages by composite text density.

Every node of a page's tree gets its characters per tag, adjusted by how much of it is link text.
The node whose children's densities sum highest holds the main text; the smallest density
on its way up to the body is the bar that other parts of the body have to reach.  Elements whose tag, role or
class says that they are furniture (menus, adverts, comments and so on) leave the tree first, and
an ``article`` or ``main`` element around the chosen node stands for the body where there is one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartwright.llm.common import col, free_name, ship, slices

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Elements that hold no article text.
_FURNITURE = frozenset(
    "head nav footer aside form button select option input label fieldset menu dialog template object svg canvas audio video map datalist".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_LANDMARKS = frozenset(("article", "main"))
_COMMENT_WORDS = frozenset("comment comments commentlist commentary disqus respond reply replies discussion".split())
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login menu nav navbar "
    "navigation topnav breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead related recommended recommendations share "
    "sharing social pagination pager search toolbar skip hidden copyright".split()
)
_CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre section table ul dd dt summary".split()
)
#: A start tag ends an open element of these names, unless one of the fences is met first.
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
}
_TAG = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|([!?/])[^>]*>)""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]*)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes); kinds are text, start, end."""
    at, size = 0, len(html)
    while at < size:
        opening = html.find("<", at)
        if opening < 0:
            yield "text", html[at:], ""
            return
        if opening > at:
            yield "text", html[at:opening], ""
        found = _TAG.match(html, opening) or _LOOSE_TAG.match(html, opening)
        if found is None:
            # A lone "<" is text; a tag or comment cut off by the end of the page is nothing.
            if html[opening + 1 : opening + 2].isalpha() or html.startswith(("</", "<!", "<?"), opening):
                return
            yield "text", "<", ""
            at = opening + 1
            continue
        if found.re is _TAG:
            comment, slash, name, attributes, _ = found.groups()
        else:
            comment, (slash, name, attributes) = None, found.groups()
        at = found.end()
        if comment:
            if html.startswith((">", "->"), at):
                at = html.index(">", at) + 1
                continue
            end = html.find("-->", at)
            if end < 0:
                return
            at = end + 3
        elif name:
            name = name.lower()
            yield "end" if slash else "start", name, attributes
            if not slash and name in _RAW:
                end = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(html, at)
                if end is None:
                    return
                at = end.start()


class _Page:
    """The tree as columns: node 0 is the page, parents come before children."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.attributes = ["html"], [-1], [""]
        #: (node, text) in page order; a None text marks the edge of a block.
        self.pieces: list[tuple[int, str | None]] = []
        self._open = [0]
        for kind, name, attributes in _tokens(html):
            if kind == "text":
                if name:
                    self.pieces.append((self._open[-1], name))
            elif kind == "start":
                self._start(name, attributes)
            else:
                self._end(name)

    def _edge(self, name: str) -> None:
        if name not in _INLINE:
            self.pieces.append((self._open[-1], None))

    def _close(self, names: tuple[str, ...], fences: tuple[str, ...]) -> None:
        """Close the nearest open element of these names with all that it holds, up to a fence."""
        for place in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[place]]
            if tag in names:
                del self._open[place:]
                self.pieces.append((self._open[-1], None))
                return
            if tag in fences:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):
            return
        if name in _CLOSES_PARAGRAPH:
            self._close(("p",), ("table", "button", "object", "td", "th", "caption"))
        if name in _SIBLINGS:
            self._close(*_SIBLINGS[name])
        elif name == "a":
            self._close(("a",), ("table", "td", "th", "button", "object"))
        elif self.tag[self._open[-1]] == "head" and name not in ("title", "meta", "link", "script", "style", "base", "noscript", "template"):
            self._open.pop()
        self._edge(name)
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.attributes.append(attributes)
        if name not in _VOID:
            self._open.append(len(self.tag) - 1)

    def _end(self, name: str) -> None:
        self._edge(name)
        for place in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[place]]
            if tag == name:
                del self._open[place:]
                break
            if tag in ("td", "th", "table") and name not in ("td", "th", "tr", "tbody", "thead", "tfoot", "table", "article", "main", "div", "section"):
                break
        self._edge(name)


def _says(attributes: str) -> tuple[bool, bool, bool]:
    """Whether attributes say: furniture, comments, hidden."""
    furniture = comments = hidden = False
    for name, *values in _NAMED.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            furniture |= not words.isdisjoint(_FURNITURE_WORDS)
            comments |= not words.isdisjoint(_COMMENT_WORDS)
        elif name == "role":
            furniture |= value.strip().lower() in _ROLES
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        elif name == "style":
            hidden |= bool(_INVISIBLE.search(value))
    return furniture, comments, hidden


def _furniture(page: _Page) -> list[bool]:
    """Nodes that leave the tree, with all below them."""
    size = len(page.tag)
    landmark, heading = [False] * size, [False] * size
    for node in range(size - 1, 0, -1):
        above, tag = page.parent[node], page.tag[node]
        landmark[above] |= landmark[node] or tag in _LANDMARKS
        heading[above] |= heading[node] or tag == "h1"
    gone, inside = [False] * size, [False] * size
    for node in range(1, size):
        above, tag, attributes = page.parent[node], page.tag[node], page.attributes[node]
        inside[node] = inside[above] or tag in _LANDMARKS
        if gone[above] or tag in _FURNITURE or tag in _RAW:
            gone[node] = True
            continue
        if tag == "header":
            # The header of the page goes, that of an article holds its title.
            gone[node] = not inside[above]
        if attributes and tag not in _INLINE | {"a"}:
            furniture, comments, hidden = _says(attributes)
            if furniture and tag not in _LANDMARKS and not landmark[node] and not heading[node] and not (tag == "header" and inside[above]):
                gone[node] = True
            if (comments and not heading[node] and not (tag == "main")) or hidden:
                gone[node] = True
    return gone


def _densities(page: _Page, gone: list[bool]) -> tuple[list[int], list[int], list[float], list[float]]:
    """Characters, link characters, composite density and sum of the children's densities of every node."""
    size = len(page.tag)
    chars, link_chars, tags, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
    in_link = [False] * size
    for node in range(1, size):
        in_link[node] = in_link[page.parent[node]] or page.tag[node] == "a"
    for node, text in page.pieces:
        if text is not None and not gone[node]:
            count = len(text.strip())
            chars[node] += count
            if in_link[node]:
                link_chars[node] += count
    for node in range(size - 1, 0, -1):
        if not gone[node]:
            above = page.parent[node]
            chars[above] += chars[node]
            link_chars[above] += link_chars[node]
            tags[above] += tags[node] + 1
            link_tags[above] += link_tags[node] + (page.tag[node] == "a")
    share = link_chars[0] / chars[0] if chars[0] else 0.0
    density, sums = [0.0] * size, [0.0] * size
    for node in range(size):
        c = chars[node]
        if gone[node] or not c:
            continue
        value = c / max(tags[node], 1)
        base = log(c / max(c - link_chars[node], 1) * link_chars[node] + share * c + e)
        if base > 1:
            value *= log(max(c / max(link_chars[node], 1) * max(tags[node], 1) / max(link_tags[node], 1), 1.0)) / log(base)
        density[node] = value
    for node in range(1, size):
        sums[page.parent[node]] += density[node]
    return chars, link_chars, density, sums


def _chosen(page: _Page, gone: list[bool]) -> list[bool]:
    """Nodes of the main text, with all below them."""
    size = len(page.tag)
    chars, link_chars, density, sums = _densities(page, gone)
    # The outermost landmark around each node.
    frame = [0] * size
    for node in range(1, size):
        frame[node] = frame[page.parent[node]] or (node if page.tag[node] in _LANDMARKS and not gone[node] else 0)
    framed = any(frame[n] and chars[n] for n in range(size))
    allowed = [n for n in range(size) if not gone[n] and chars[n] and (frame[n] or not framed)]
    picked = [False] * size
    if not allowed:
        return picked
    # A leaf has no children to sum; text right under a node counts as a child.
    best = max(allowed, key=lambda n: (sums[n], density[n], -n))
    top, path = frame[best], []
    node = best
    while True:
        path.append(node)
        if node == top or node == 0:
            break
        node = page.parent[node]
    bar = min(density[n] for n in path)
    if top:
        # A landmark is an article as its author marked it: all of it but blocks made of links.
        picked[top] = True
        for node in range(top + 1, size):
            if frame[node] == top and not gone[node] and page.tag[node] in ("ul", "ol", "div", "section", "table") and node not in path:
                if chars[node] and link_chars[node] * 2 > chars[node]:
                    gone[node] = True
        return picked
    # Subtrees: the densest sum at or below each node.
    peak = list(range(size))
    for node in range(size - 1, 0, -1):
        above = page.parent[node]
        if not gone[node] and sums[peak[node]] > sums[peak[above]]:
            peak[above] = peak[node]
    open_nodes = [False] * size
    open_nodes[0] = True
    picked[best] = True
    title = None
    for node in range(size):
        if node and not open_nodes[page.parent[node]]:
            continue
        if gone[node] or not chars[node] or density[node] < bar:
            continue
        open_nodes[node] = True
        picked[peak[node]] = True
    for node in range(best):
        if page.tag[node] == "h1" and not gone[node]:
            title = node
    if title is not None:
        picked[title] = True
    return picked


def main_text(html: str | None) -> str:
    """The article's text, its blocks joined by one space; "" if there is none."""
    if not html:
        return ""
    page = _Page(html)
    gone = _furniture(page)
    kept = _chosen(page, gone)
    for node in range(1, len(page.tag)):
        kept[node] = (kept[node] or kept[page.parent[node]]) and not gone[node]
    blocks, block = [], []
    for node, text in page.pieces:
        if text is None:
            if block:
                blocks.append("".join(block))
                block = []
        elif kept[node]:
            block.append(unescape(text))
    blocks.append("".join(block))
    return " ".join(" ".join(blocks).split())


def extract(pages: DataFrame, html: str = "html", output: str = "text") -> DataFrame:
    """Add the main text of every page as ``output`` and its code points as ``n_chars``.

    Null and empty pages, and pages without an article, have an empty text.  Rows, repeated ones too, and other columns
    stay as they are; columns that already have one of the new names are replaced.  A page of any length is read
    whole, in memory that grows with the page; nesting of any depth is walked without recursion.  Of two nodes with equal sums
    the first counts.  An empty table gives an empty table.  There is no shuffle.
    """
    ship(pages.sparkSession)
    added = (output, "n_chars")
    kept = [name for name in pages.columns if name.lower() not in {a.lower() for a in added}]
    work = free_name("html_to_read", pages.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, work):
                texts = [main_text(page) for page in part.column(work).to_pylist()]
                values = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), *values], [*kept, *added])

    fields = [*(pages.schema[name] for name in kept), T.StructField(output, T.StringType()), T.StructField("n_chars", T.LongType())]
    return pages.select(*[col(name) for name in kept], col(html).cast("string").alias(work)).mapInArrow(run, T.StructType(fields))
