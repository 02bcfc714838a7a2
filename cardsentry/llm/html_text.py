"""Main text of web pages by composite text density.

The nodes of a page's tree are its block elements; inline elements count as
tags of the block they stand in. With C characters, T tags, LC characters in
links and LT link tags in a node's subtree, and Cb and LCb those of the body,

    density = C / T * log(C * T / (LC * LT)) / log(ln-base),
    ln-base = C * LC / (C - LC) + LCb * C / Cb + e,

where 0 counts as 1 in a denominator. A node's density sum is the sum over its
children, a leaf's its own density. The node with the largest sum gives the
threshold: the smallest density on its path up to the body. Each node that
reaches it adds the subtree with the largest sum below it to the content, as
a whole. Beside these, a block next to that path whose text is prose without
many links is content too: a second part of an article may have shorter
paragraphs than the page on average.

What cannot be told by density is told by markup: some elements (scripts, menus,
footers, asides) and whole class, id or role names (``ad``, ``comments``,
``cookie-notice``) say that a block is not the article. A name that merely
contains such a word (``has-sidebar``, ``social-history``) says nothing, inline
elements are never cut out of a sentence, and a marked block stays if it holds
the page's only article or most of its unlinked text.

A page is one row and map-only; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import packed, read, unpacked

# The HTML elements by how they take part.
BLOCKS = frozenset(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "head title script style noscript template iframe object svg canvas audio video math select textarea button "
    "datalist".split()
)
# Blocks that are never the article, and one that may wrap a whole page.
ASIDE = frozenset("nav footer aside menu dialog search".split())
WRAPPER = "form"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a new element of this name ends, if it is open inside the scope named.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words that a class, id or role may be made of: some name what is not the
# article, whatever its size; some do unless it is most of the page; others only
# say where or what kind of box it is. A name with any other word says nothing.
FIRM = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox banner breadcrumb breadcrumbs "
    "comment comments consent contentinfo cookie cookies disqus footer gdpr masthead menu nav navbar navigation "
    "notice notices paywall popup reply replies respond skip sponsor sponsored".split()
)
SOFT = frozenset(
    "alert alertdialog complementary dialog form modal newsletter notification promo promoted promotion recommended "
    "related search share sharing sidebar signup social subscribe subscription toolbar widget".split()
)
NEUTRAL = frozenset(
    "area articles bar block body bottom box btn button buttons col column container content group header inner item "
    "items left link links list main news outer page panel post posts primary reader readers right row secondary "
    "section site slot stories thread top user users widgets wrap wrapper".split()
)
PAGE_HEADERS = frozenset("header site-header page-header top-header".split())
NAME_PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# A block beside the densest one is prose from this many words on, with less
# than this share of its characters in links.
PROSE_WORDS, PROSE_LINKS = 20, 0.25


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an element is clearly not shown."""
    return any(
        name == "hidden" or name == "aria-hidden" and value == "true"
        or name == "style" and value and "display:none" in value.replace(" ", "").lower()
        for name, value in attrs
    )


def marked(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether a block's markup says that it is not the article: 3 if its tag
    does, 2 if a name does firmly, 1 for a part of a page, else 0."""
    if tag in ("html", "body", "article", "main"):
        return 0
    found = 3 if tag in ASIDE else 1 if tag == WRAPPER else 0
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for token in value.split():
                words = set(NAME_PARTS.findall(CAMEL.sub("-", token).lower()))
                if words <= FIRM | SOFT | NEUTRAL:
                    found = max(found, 2 if words & FIRM else 1 if words & SOFT else 0)
    return found


class Tree(HTMLParser):
    """The block elements of a page, and its stretches of text.

    Nodes are numbered in page order, so a parent comes before its children;
    node 0 stands for the body. What a node inherits is stored with it, so deep
    pages take no longer than wide ones.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.mark = [-1], ["body"], [0]
        self.in_article, self.in_header, self.in_heading = [False], [False], [False]
        self.tags, self.link_tags = [0], [0]  # of the node itself
        self.open = [0]
        self.open_names: Counter[str] = Counter()
        self.texts: list[tuple[int, list[str], list[int]]] = []  # node, parts, characters in links
        self.fresh = True  # whether the next text begins a stretch
        self.links = 0
        self.skip: list[str] = []  # open elements without text

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            return
        if tag not in VOID and (self.skip or tag in SKIPPED or hidden(attrs)):
            if not self.skip and tag in BLOCKS:
                self._close_for(tag)
                self.fresh = True
            self.skip.append(tag)
            return
        if tag in BLOCKS:
            self._close_for(tag)
            top = self.open[-1]
            self.parent.append(top)
            self.tag.append(tag)
            mark = marked(tag, attrs)
            if not self.in_article[top]:
                # the header of an article holds its headings; others none of it
                if tag == "header":
                    mark = 3
                elif any(k == "class" and v and PAGE_HEADERS & set(v.lower().split()) for k, v in attrs):
                    mark = max(mark, 1)
            self.mark.append(mark)
            self.in_article.append(self.in_article[top] or tag in ("article", "main"))
            self.in_header.append(self.in_header[top] or tag == "header")
            self.in_heading.append(self.in_heading[top] or tag in HEADINGS)
            self.tags.append(0)
            self.link_tags.append(0)
            self.tags[top] += 1
            if tag not in VOID:
                self.open.append(len(self.parent) - 1)
                self.open_names[tag] += 1
            self.fresh, self.links = True, 0
            return
        top = self.open[-1]
        self.tags[top] += 1
        if tag == "a":
            self.link_tags[top] += 1
            self.links += 1
        elif tag == "br":
            self.handle_data(" ")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # HTML has no self-closing elements but the void ones
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
                return
            if not self.open_names[tag]:
                return
            self.skip.clear()  # the end of a block around them
        if tag in BLOCKS:
            if self.open_names[tag]:
                at = len(self.open) - 1
                while self.tag[self.open[at]] != tag:
                    at -= 1
                self._close(at)
            self.fresh, self.links = True, 0
        elif tag == "a" and self.links:
            self.links -= 1

    def _close(self, at: int) -> None:
        for node in self.open[at:]:
            self.open_names[self.tag[node]] -= 1
        del self.open[at:]

    def _close_for(self, tag: str) -> None:
        ends, scope = ENDS.get(tag, (set(), set()))
        for at in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[at]]
            if name in ends or name == "p":
                self._close(at)
            elif name in scope or name not in ends and not ends:
                break

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        top = self.open[-1]
        if self.fresh or self.texts[-1][0] != top:
            self.texts.append((top, [], []))
            self.fresh = False
        self.texts[-1][1].append(data)
        if self.links:
            self.texts[-1][2].append(len("".join(data.split())))


def dropped(tree: Tree, blocks: list[tuple[int, str, int]]) -> list[bool]:
    """Which nodes are no part of the article by their markup or that of a node
    around them.

    A marked node stays if it holds an article or main element and no such
    element is outside of marked nodes; by a soft name also if it holds most of
    the unlinked text, and by any name if all text is marked and no node has more.
    """
    n = len(tree.parent)
    article = [t in ("article", "main") for t in tree.tag]
    plain, under = [0] * n, [m > 0 for m in tree.mark]
    for node, text, linked in blocks:
        plain[node] += len(text) - linked
    for i in range(1, n):
        under[i] = under[i] or under[tree.parent[i]]
    outside = sum(c for c, u in zip(plain, under) if not u)
    free_article = any(a and not u for a, u in zip(article, under))
    for i in range(n - 1, 0, -1):
        plain[tree.parent[i]] += plain[i]
        article[tree.parent[i]] = article[tree.parent[i]] or article[i]
    most = max((plain[i] for i in range(n) if 0 < tree.mark[i] < 3), default=0)
    out = [False] * n
    for i in range(1, n):
        excused = (
            article[i] and not free_article
            or tree.mark[i] == 1 and 2 * plain[i] > plain[0]
            or tree.mark[i] < 3 and not outside and plain[i] == most
        )
        out[i] = out[tree.parent[i]] or tree.mark[i] > 0 and not excused
    return out


def densities(tree: Tree, blocks: list[tuple[int, str, int]], gone: list[bool]) -> tuple[list[float], list[float], list[tuple[int, int]]]:
    """(density, density sum, (characters, those in links)) of every node;
    ``blocks`` are stretches of text outside of nodes that are ``gone``."""
    n = len(tree.parent)
    chars, link_chars = [0] * n, [0] * n
    for node, text, linked in blocks:
        chars[node] += len(text)
        link_chars[node] += linked
    tags = [0 if g else t for t, g in zip(tree.tags, gone)]
    link_tags = [0 if g else t for t, g in zip(tree.link_tags, gone)]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i]
        link_tags[p] += link_tags[i]
    body = link_chars[0] / max(1, chars[0])
    density, total, leaf = [0.0] * n, [0.0] * n, [True] * n
    for i in range(n - 1, -1, -1):
        c, t, lc, lt = chars[i], max(1, tags[i]), link_chars[i], max(1, link_tags[i])
        if c:
            base = c * lc / max(1, c - lc) + body * c + math.e
            density[i] = c / t * max(0.0, math.log(c * t / (max(1, lc) * lt))) / math.log(base)
        if leaf[i]:
            total[i] = density[i]
        if i:
            leaf[tree.parent[i]] = False
            total[tree.parent[i]] += density[i]
    return density, total, list(zip(chars, link_chars))


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by blank lines; empty if there is none."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    blocks = []
    for node, parts, linked in tree.texts:
        if tree.in_header[node] and tree.in_article[node] and not tree.in_heading[node]:
            continue
        if text := " ".join("".join(parts).split()):
            blocks.append((node, text, sum(linked)))
    gone = dropped(tree, blocks)
    blocks = [b for b in blocks if not gone[b[0]]]
    if not blocks:
        return ""
    density, total, size = densities(tree, blocks, gone)
    n = len(density)
    # the node with the largest sum below each node; the outer one on ties
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        if total[best[i]] > total[best[p]] or total[best[i]] == total[best[p]] and best[i] < best[p]:
            best[p] = best[i]
    path = {best[0]}
    node = best[0]
    while node:
        node = tree.parent[node]
        path.add(node)
    threshold = min(density[i] for i in path)
    words = [0] * n
    for node, text, _ in blocks:
        words[node] += text.count(" ") + 1
    for i in range(n - 1, 0, -1):
        words[tree.parent[i]] += words[i]
    inside = [False] * n
    for i in range(n):
        if density[i] >= threshold:
            inside[best[i]] = True
        if i and i not in path and tree.parent[i] in path and not tree.in_article[best[0]]:
            inside[i] = inside[i] or words[i] >= PROSE_WORDS and size[i][1] < PROSE_LINKS * size[i][0]
    for i in range(1, n):
        inside[i] = inside[i] or inside[tree.parent[i]]
    return "\n\n".join(text for node, text, _ in blocks if inside[node])


def with_main_text(pages: DataFrame, out: str = "text") -> DataFrame:
    """Add the main text of every page's ``html``.

    A null or empty page, and one without an article, has an empty text. Rows
    that repeat are extracted each, an input column named like ``out`` is
    replaced, and an empty table gives an empty table.
    """

    @F.pandas_udf("string")
    def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in pages:
            yield pd.Series([main_text(x if isinstance(x, str) else None) for x in p], dtype=object)

    rows = pages.select(packed(pages), extract("html").alias("text"))
    return rows.select(*unpacked(pages.columns, {out: F.col("text")}))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    rows = with_main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
