"""Link extraction from page tables (url, html)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import numbered_slug


def links(pages: DataFrame, pattern: str, page_id: str = "page_id", html: str = "html", group: int = 1) -> DataFrame:
    """page_id, position, link: the first occurrence of each link of a page, in page order."""
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(group))
    each = pages.select(page_id, F.posexplode(found).alias("position", "link"))
    return each.groupBy(page_id, "link").agg(F.min("position").alias("position")).select(page_id, "position", "link")


def ranked_links(pages: DataFrame, patterns: list[str], page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Links by several patterns, of which an earlier pattern's occurrence comes first."""

    def found(k: int, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)), lambda x, i: F.struct(F.lit(k).alias("method"), i.alias("position"), x.alias("link")))

    arrays = [found(k, p) for k, p in enumerate(patterns)]
    each = pages.select(page_id, F.inline(F.concat(*arrays)))
    first = each.groupBy(page_id, "link").agg(F.min(F.struct("method", "position")).alias("first"))
    return first.select(page_id, "link", "first.method", "first.position")


def _numbered(found: DataFrame, base: str, page_id: str) -> DataFrame:
    """Records of links (position, link) to numbered-slug images."""
    out = found.withColumn("slug", numbered_slug(F.element_at(F.split("link", "/"), -1)))
    own = F.substring(F.md5(F.col("link").cast("binary")), 1, 8)
    return out.select(page_id, "position", F.concat(F.lit(base), F.col("link")).alias("url"), F.coalesce("slug.id", own).alias("id"), "slug.resolution", F.coalesce(F.nullif("slug.title", F.lit("")), F.lit("Wallpaper")).alias("title"))


def download_links(pages: DataFrame, base: str, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Numbered-slug images whose anchor reads Download: page_id, position, url, id, resolution, title."""
    return _numbered(links(pages, r'(?is)<a[^>]*href="(/images/wallpapers/[^"]+)"[^>]*>\s*Download', page_id, html), base, page_id)


def dom_records(pages: DataFrame, base: str, skip: str = "featured", page_id: str = "page_id", html: str = "html") -> DataFrame:
    """As download_links, by the page's tree: image files outside of elements of a class, each once."""
    files = dom_links(pages, skip, page_id, html).where(F.col("href").rlike(r"(?i)^/images/wallpapers/.*\.(jpg|jpeg|png|webp)$"))
    return _numbered(first_of_page(files, page_id).withColumnRenamed("href", "link"), base, page_id)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, without a fragment, a query or slashes at the end."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/+$", "")
    head = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    return F.concat(F.lower(head), F.substr(bare, F.length(head) + 1))


def file_name(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/+$", ""), "/"), -1)


class _Anchors(HTMLParser):
    """Anchors with href, and whether an ancestor's class has a word that rules them out."""

    EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, skip: str):
        super().__init__()
        self.skip, self.open, self.found = skip, [], []

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        skipped = (self.open[-1][1] if self.open else False) or self.skip in (given.get("class") or "").lower()
        if tag == "a" and given.get("href"):
            self.found.append((given["href"], skipped))
        if tag not in self.EMPTY:
            self.open.append((tag, skipped))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break


def dom_links(pages: DataFrame, skip: str = "featured", page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, position, href, skipped: anchors of a page in order, with the ancestor rule that a
    pattern can't express."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            for k, page in enumerate(batch.column(1)):
                parser = _Anchors(skip)
                parser.feed(page.as_py() or "")
                owner += [k] * len(parser.found)
                found += [(n, *f) for n, f in enumerate(parser.found)]
            if found:
                position, href, skipped = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(position, pa.int32()), pa.array(href, pa.string()), pa.array(skipped, pa.bool_())], [page_id, "position", "href", "skipped"])

    return pages.select(page_id, html).mapInArrow(run, f"{page_id} {kind}, position int, href string, skipped boolean")


def first_of_page(found: DataFrame, page_id: str = "page_id", key: str = "href") -> DataFrame:
    """The first occurrence of each link of a page; skipped ones don't count."""
    rows = found.where(~F.col("skipped"))
    return rows.groupBy(page_id, key).agg(F.min("position").alias("position")).select(page_id, "position", key)
