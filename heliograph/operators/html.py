"""Article text and listing rows from saved HTML, by the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.vocab import Vocabulary

DROPPED = {"script", "style", "nav", "footer", "aside", "form"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
LONGEST, SHORTEST = 6000, 40


class _Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def find_all(self, match) -> list[_Node]:
        out, todo = [], [*reversed(self.children)]
        while todo:
            x = todo.pop()
            if isinstance(x, _Node):
                if match(x):
                    out.append(x)
                todo.extend(reversed(x.children))
        return out

    def strings(self) -> list[str]:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo.extend(reversed(x.children))
        return out

    def text(self, joint: str = " ") -> str:
        return joint.join(s for s in (x.strip() for x in self.strings()) if s)


class _Tree(HTMLParser):
    """A tree of the kept elements. ``nested``: an open <p> stays open when another starts; else that closes it.

    Dropped elements are opened and closed like all others, but hang from
    nothing; so whatever is left open in one ends with it.
    """

    def __init__(self, nested: bool):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open, self.nested = [self.root], nested

    def handle_starttag(self, tag, attrs):
        if tag == "p" and not self.nested:
            self._close("p")
        node = self._hang(tag, attrs)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self._hang(tag, attrs)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def _hang(self, tag, attrs) -> _Node:
        node = _Node(tag, {k: v or "" for k, v in attrs})
        if tag not in DROPPED:
            self.open[-1].children.append(node)
        return node

    def _close(self, tag):
        """Ends the innermost open element of that name and all that is open in it. A <p> isn't ended from within a dropped element that it holds."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return
            if tag == "p" and self.open[at].tag in DROPPED:
                return


def parse(html: str, nested: bool = False) -> _Node:
    t = _Tree(nested)
    t.feed(html)
    t.close()
    return t.root


def paragraphs(html: str | None, nested: bool = False) -> list[str]:
    """The text of every <p> in the first <article>, else the first <main>, else all; scripts, navigation and the like don't count."""
    if not html:
        return []
    root = parse(html, nested)
    for tag in ("article", "main"):
        if found := root.find_all(lambda x, tag=tag: x.tag == tag):
            root = found[0]
            break
    return [p.text() for p in root.find_all(lambda x: x.tag == "p")]


def paragraphs_of(html: Column, nested: bool = False) -> Column:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: paragraphs(h, nested))

    return extract(html)


def body_of(found: Column, vocabulary: Vocabulary, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """Paragraphs over ``shortest`` characters without boilerplate, joined and cut at ``longest``."""
    kept = F.filter(found, lambda p: F.length(p) > shortest)
    if vocabulary.boilerplate:
        kept = F.filter(kept, lambda p: ~p.rlike("(?i)" + "|".join(vocabulary.boilerplate)))
    return F.coalesce(F.substring(F.array_join(kept, " "), 1, longest), F.lit(""))


def article_bodies(pages: DataFrame, vocabulary: Vocabulary, nested: bool = False) -> DataFrame:
    """pages with body instead of html; a null html or a status other than 200, where there is one, gives the empty text."""
    html = F.when(F.col("status") == 200, F.col("html")) if "status" in pages.columns else F.col("html")
    found = pages.withColumn("__p", paragraphs_of(html, nested))
    return found.withColumn("body", body_of(F.col("__p"), vocabulary)).drop("__p", "html")


#: How a front page lists its articles: element and class of an entry, where the headline stands, and what goes before its link.
LISTINGS = {
    "err_ee": {"tag": None, "css": "news-article", "headline": "a", "prefix": ""},
    "lrt_lt": {"tag": None, "css": "news", "headline": "h3", "prefix": "https://www.lrt.lt"},
    "lsm_lv": {"tag": "article", "css": "list-article", "headline": "a", "prefix": "https://eng.lsm.lv"},
}


def listing_rows(html: str | None, tag: str | None, css: str, headline: str, prefix: str) -> list[tuple[str, str]]:
    """(url, headline) of each entry that has a link; relative links get the prefix."""
    out = []
    for entry in parse(html or "").find_all(lambda x: (tag is None or x.tag == tag) and css in x.attrs.get("class", "").split()):
        link = next(iter(entry.find_all(lambda x: x.tag == "a" and "href" in x.attrs)), None)
        title = next(iter(entry.find_all(lambda x: x.tag == headline)), None)
        if link is not None and title is not None:
            out.append((prefix + link.attrs["href"], title.text()))
    return out


def front_page_rows(pages: DataFrame, source: str) -> DataFrame:
    """url, headline and scraped_at of ``pages(html, scraped_at)`` by the source's listing; equal rows of a page once."""
    how = LISTINGS[source]

    @F.pandas_udf("array<struct<url:string,headline:string>>")
    def rows(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: [{"url": u, "headline": t} for u, t in listing_rows(h, **how)])

    return pages.select("scraped_at", F.explode(rows("html")).alias("r")).select("r.url", "r.headline", "scraped_at").dropDuplicates()
