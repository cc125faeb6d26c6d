"""Main text of web pages by tree scoring.

A page becomes a tree of elements and a list of text blocks. Every block outside page furniture
earns points, one for being there, one per comma and one per hundred characters, and passes
them on: in full to its parent, by half to the grandparent, less and less further up. Elements
made for articles start with a bonus. An element's points are discounted by the share of its text
that is link text. The best element is the container; siblings with a good share of its points, and
plain paragraphs beside it, are kept too. The result is every block inside what is kept, in page
order, but furniture: menus, page headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments.

Defined results: NULL or empty HTML, and pages without text, give the empty text; markup that is cut
off or left open is read as far as it goes; very long pages are read whole, in time linear in their
length; NULL page_id and url are carried along; repeated rows give repeated results; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmarts.llm.common import map_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_LABEL = re.compile(r"[a-z]+|[0-9]+")

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW_TAGS = frozenset("script style textarea title noscript iframe xmp noembed".split())
PARAGRAPH_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dd dt td th figcaption caption summary".split())
FURNITURE_TAGS = frozenset(
    "head nav footer aside form button select option dialog menu svg math canvas object audio video template "
    "fieldset label".split()
)
#: Parts of a class, id or role that name furniture.
FURNITURE_LABELS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup menu "
    "nav navbar navigation breadcrumb breadcrumbs sidebar aside widget related recommended recommendations share "
    "sharing social comment comments disqus reply replies respond footer header masthead toolbar pagination pager "
    "search login complementary contentinfo".split()
)
#: Elements that hold articles, and their bonus.
BONUS = {"article": 25.0, "main": 15.0, "section": 3.0, "div": 2.0}
#: A new element of the key ends an open one of the values, unless one of the limits lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
}
LEVELS = (1.0, 0.5, 1 / 3, 1 / 6, 1 / 9)
SIBLING_SHARE, SIBLING_CHARS, SIBLING_LINKS = 0.2, 80, 0.25


def _is_furniture(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in FURNITURE_TAGS or (tag == "header" and not in_article):
        return True
    if "=" not in attrs:
        return False
    for name, value in _ATTR.findall(attrs):
        value = value.strip("\"'").lower()
        if name.lower() in ("hidden", "aria-hidden"):
            if value != "false":
                return True
        elif not FURNITURE_LABELS.isdisjoint(_LABEL.findall(value)) and tag not in ("html", "body", "article", "main"):
            return True
    return False


class _Page:
    """Elements in page order (parents before children) and the text blocks between them."""

    def __init__(self, source: str):
        self.tags, self.parents, self.dropped = ["#root"], [0], [False]
        self.around = [0]  # of each element the nearest block element, itself included
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        # Open elements, all and by tag. A later one is a deeper one, so the nearest is the largest.
        self.stack: list[int] = [0]
        self.open: defaultdict[str, list[int]] = defaultdict(list)
        self.texts: list[str] = []
        self.links = 0
        self.read(source)

    def flush(self) -> None:
        if self.texts:
            text = " ".join("".join(self.texts).split())
            if text:
                self.blocks.append((self.around[self.stack[-1]], text, min(self.links, len(text))))
            self.texts, self.links = [], 0

    def add(self, raw: str) -> None:
        if raw and not self.dropped[self.stack[-1]]:
            text = entities.unescape(raw) if "&" in raw else raw
            self.texts.append(text)
            if self.open["a"]:
                self.links += len(text.strip())

    def push(self, tag: str, attrs: str) -> None:
        top = self.stack[-1]
        dropped = self.dropped[top] or _is_furniture(tag, attrs, bool(self.open["article"]))
        element = len(self.tags)
        self.tags.append(tag)
        self.parents.append(top)
        self.dropped.append(dropped)
        self.around.append(element if tag in BLOCK_TAGS else self.around[top])
        self.stack.append(element)
        self.open[tag].append(element)

    def pop_to(self, tag: str) -> None:
        while True:
            closed = self.tags[self.stack.pop()]
            self.open[closed].pop()
            if closed == tag:
                return

    def end_implied(self, tag: str) -> None:
        if tag in BLOCK_TAGS and self.open["p"]:
            self.pop_to("p")
        ends, limits = ENDS.get(tag, ((), ()))
        nearest = max((self.open[t][-1] for t in ends if self.open[t]), default=0)
        if nearest > max((self.open[t][-1] for t in limits if self.open[t]), default=0):
            self.pop_to(self.tags[nearest])

    def read(self, source: str) -> None:
        at = 0
        while m := _TOKEN.search(source, at):
            self.add(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if not tag:
                continue
            tag = tag.lower()
            block = tag in BLOCK_TAGS
            if block:
                self.flush()
            if m["close"]:
                if self.open[tag]:
                    self.pop_to(tag)
                continue
            if tag in RAW_TAGS and not m["attrs"].endswith("/"):
                end = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if tag == "br":
                self.add(" ")
            self.end_implied(tag)
            if tag not in VOID_TAGS and not m["attrs"].endswith("/"):
                self.push(tag, m["attrs"])
        self.add(source[at:])
        self.flush()


def main_text(source: str | None) -> str:
    """The page's main text: blocks joined by an empty line."""
    if not source:
        return ""
    page = _Page(source)
    if not page.blocks:
        return ""
    tags, parents, n = page.tags, page.parents, len(page.tags)
    points, chars, links = [BONUS.get(t, 0.0) for t in tags], [0] * n, [0] * n
    holds = [False] * n
    for element, text, in_links in page.blocks:
        chars[element] += len(text)
        links[element] += in_links
        earned = (1 + text.count(",") + len(text) / 100) * (1 - in_links / len(text))
        up = parents[element] if tags[element] in PARAGRAPH_TAGS else element
        for share in LEVELS:
            points[up] += earned * share
            holds[up] = True
            if up == 0:
                break
            up = parents[up]
    for element in range(n - 1, 0, -1):
        chars[parents[element]] += chars[element]
        links[parents[element]] += links[element]
    score = [
        p * (1 - link / size) if held and size else 0.0 for p, link, size, held in zip(points, links, chars, holds)
    ]
    best = max(range(n), key=lambda e: (score[e], -e))
    above = best
    while above and tags[above] not in ("article", "main"):
        above = parents[above]
    best = above or best
    kept = [False] * n
    for element in range(n):
        if element == best or (element and kept[parents[element]]):
            kept[element] = True
        elif best and element and parents[element] == parents[best] and chars[element]:
            few_links = links[element] / chars[element] < SIBLING_LINKS
            paragraph = tags[element] == "p" and chars[element] >= SIBLING_CHARS
            share = score[element] - BONUS.get(tags[element], 0.0) >= SIBLING_SHARE * score[best]
            kept[element] = few_links and (paragraph or share)
    return "\n\n".join(text for element, text, _ in page.blocks if kept[element])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(source.as_py()) for source in batch.column(2)]
        counts = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return map_batches(rows, "page_id long, url string, text string, n_chars long", _extract)
