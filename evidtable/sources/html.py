"""HTML pages: title, sections, image links, tables. Real pages aren't XML, so a tolerant parser runs behind Arrow."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import absolute_url, image_page_index

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.title, self.named, self.meta, self.images, self.links = [], [], None, [], []
        self.heading = 0
        self.sections: dict[str, list[str]] = {}
        self.open: list[tuple[int, str]] = []
        self.rows: list[list[list[str]]] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "meta" and (a.get("name") or "").lower() == "dc.title":
            self.meta = a.get("content")
        if tag == "img" and a.get("src") and any(name == "description" for _, name in self.open):
            self.images.append(a["src"])
        if tag == "a" and a.get("href"):
            self.links.append(a["href"])
        if tag in VOID:
            return
        self.stack.append(tag)
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "h1" and a.get("id") == "title":
            self.heading = len(self.stack)
        if tag == "section" and a.get("itemprop") and a["itemprop"] not in self.sections:  # the first of a name counts
            self.open.append((len(self.stack), a["itemprop"]))
            self.sections[a["itemprop"]] = []
        if tag == "table":
            self.rows.append([])
        if tag == "tr" and self.rows:
            self.rows[-1].append([])
        if tag in ("td", "th") and self.rows and self.rows[-1]:
            self.rows[-1][-1].append("")

    def read(self, html: str | None) -> _Page:
        """All of a page: what the parser holds back of an unclosed end is told by ``close``."""
        self.feed(html or "")
        self.close()
        return self

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.stack:
            return
        while self.stack:
            last = self.stack.pop()
            if len(self.stack) < self.heading:
                self.heading = 0
            self.skip -= last in ("script", "style")
            while self.open and self.open[-1][0] > len(self.stack):
                self.open.pop()
            if last == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.skip > 0:
            return
        if self.stack and self.stack[-1] == "title":
            self.title.append(data)
        if self.heading and len(self.stack) == self.heading:
            self.named.append(data)
        for _, name in self.open:
            self.sections[name].append(data)
        if self.rows and self.rows[-1] and self.rows[-1][-1] and ("td" in self.stack or "th" in self.stack):
            self.rows[-1][-1][-1] += data


_TEXTS = ("title", "description", "claims", "abstract")
FIELDS = T.StructType([*[T.StructField(c, T.StringType()) for c in _TEXTS], T.StructField("images", T.ArrayType(T.StringType())), T.StructField("n_links", T.IntegerType())])
TABLES = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))


@F.pandas_udf(FIELDS)
def html_fields(html: pd.Series) -> pd.DataFrame:
    """Title (of the metadata, else of the heading, else of the page) and sections with collapsed white space, the description's image links; without a description only the title stands."""
    rows = []
    for text in html:
        p = _Page().read(text)
        squeeze = lambda x: " ".join("".join(x).split()) or None
        said = {k: squeeze(p.sections[k]) if k in p.sections else None for k in ("description", "claims", "abstract")}
        if said["description"] is None:
            said, p.images = dict.fromkeys(said), []
        rows.append((squeeze(p.meta or "") or squeeze(p.named) or squeeze(p.title), said["description"], said["claims"], said["abstract"], list(dict.fromkeys(p.images)), len(p.links)))
    return pd.DataFrame(rows, columns=["title", "description", "claims", "abstract", "images", "n_links"])


def written_title(html: Column) -> Column:
    """The text of the first title element as the page has it, white space collapsed, only &lt; &gt; &amp; decoded; empty without one, null of a null page."""
    text = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    for name, sign in {"&lt;": "<", "&gt;": ">", "&amp;": "&"}.items():
        text = F.replace(text, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(text, r"[\t\n\f\r ]+", " "))


def page_images(links: Column, base: str) -> Column:
    """map of page number to its different absolute image URLs in order, of links whose file is a page image's."""
    known = F.filter(F.transform(links, lambda u: F.struct(image_page_index(u)["page"].alias("page"), absolute_url(u, base).alias("url"))), lambda x: x["page"].isNotNull())
    pages = F.array_distinct(F.transform(known, lambda x: x["page"]))
    return F.map_from_arrays(pages, F.transform(pages, lambda n: F.array_distinct(F.transform(F.filter(known, lambda x: x["page"] == n), lambda x: x["url"]))))


@F.pandas_udf(TABLES)
def html_tables(html: pd.Series) -> pd.Series:
    """Tables as rows of cell texts."""
    out = []
    for text in html:
        p = _Page().read(text)
        out.append([[[" ".join(c.split()) for c in r] for r in t if r] for t in p.rows])
    return pd.Series(out)


def sanitize(html: Column) -> Column:
    """A page without scripts, styles and key-shaped tokens."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", "")
    return F.regexp_replace(bare, r"AIza[0-9A-Za-z_\-]{20,}", "REDACTED")
