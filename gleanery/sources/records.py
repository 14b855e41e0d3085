"""Candidate records from source-specific shapes, and local files.

Network access is no part of the engine: listings, feeds and search results are read as files or
tables that an ingest step left, with the schemas below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import post_image_url

CANDIDATE = "id string, source string, filepath string, url string, title string, artist string, metadata map<string,string>"
LISTING = "data struct<after string, children array<struct<data struct<id string, title string, score int, author string, permalink string, url string, created_utc double, over_18 boolean, removed_by_category string, is_gallery boolean, media_metadata map<string, struct<status string, s struct<u string>>>, preview struct<images array<struct<source struct<url string, width int, height int>>>>>>>>"
PHOTO_SEARCH_A = "results array<struct<id string, width int, height int, description string, alt_description string, urls struct<full string, raw string, thumb string>, links struct<html string, download_location string>, user struct<name string, links struct<html string>>>>"
PHOTO_SEARCH_B = "photos array<struct<id string, width int, height int, url string, photographer string, photographer_url string, src struct<original string, large2x string>>>"


def candidates(df: DataFrame, source: str, key: Column, url: Column, title: Column, artist: Column, metadata: dict[str, Column]) -> DataFrame:
    """Records with a source-prefixed id. Null metadata is left out."""
    entries = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in metadata.items()]), lambda e: e["v"].isNotNull())) if metadata else F.create_map().cast("map<string,string>")
    return df.select(F.concat_ws("_", F.lit(source), key.cast("string")).alias("id"), F.lit(source).alias("source"), F.lit(None).cast("string").alias("filepath"), url.alias("url"), title.alias("title"), artist.alias("artist"), entries.alias("metadata"))


def forum_posts(listing: DataFrame, min_score: int) -> DataFrame:
    """Posts of a listing that are up, of all ages allowed, with an image."""
    p = listing.select(F.explode("data.children").alias("c")).select("c.data.*").where((F.col("score") >= min_score) & F.col("removed_by_category").isNull() & ~F.col("over_18") & (F.col("author") != "[deleted]"))
    gallery = F.transform(F.map_values("media_metadata"), lambda m: F.struct(m["status"].alias("status"), m["s"]["u"].alias("u")))
    preview = F.try_element_at(F.col("preview.images"), F.lit(1))["source"]
    return p.withColumn("image_url", post_image_url(F.col("url"), F.col("is_gallery"), gallery, preview)).where("image_url is not null")


def feed_entries(feed: DataFrame, xml: str = "xml") -> DataFrame:
    """Entries of Atom feeds that have an image: id (the last part), title, link, author, image_url. The
    image is the first link to a file with an image's extension, else the first such source, else a
    link to the known host. Feeds know no scores."""
    entry = feed.select(F.explode(F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<entry>(.*?)</entry>"), F.lit(1))).alias("e"))

    def part(pattern: str, of: str = "e") -> Column:
        return F.nullif(F.regexp_extract(of, pattern, 1), F.lit(""))

    content = part(r"(?s)<content[^>]*>(.*?)</content>")
    for sign, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        content = F.replace(content, F.lit(sign), F.lit(plain))
    end = r'="(https://[^"]+\.(?:jpg|jpeg|png|webp|gif))"'
    image = F.coalesce(part(rf"(?i)href{end}", "content"), part(rf"(?i)src{end}", "content"), part(r'href="(https://i\.redd\.it/[^"]+)"', "content"))
    rows = entry.withColumn("content", content).select(
        F.element_at(F.split(part(r"(?s)<id>(.*?)</id>"), "/"), -1).alias("id"), F.coalesce(part(r"(?s)<title>(.*?)</title>"), F.lit("Untitled")).alias("title"), F.coalesce(part(r'<link[^>]*href="([^"]*)"'), F.lit("")).alias("link"),
        F.coalesce(F.replace(part(r"(?s)<name>(.*?)</name>"), F.lit("/u/"), F.lit("")), F.lit("[unknown]")).alias("author"), image.alias("image_url"),
    )
    return rows.where("image_url is not null")


def new_photos(found: DataFrame, seen: DataFrame, cap: int, order: list[str]) -> DataFrame:
    """Search results that the index (id) hasn't seen, each once, the first `cap` of them by `order`."""
    return found.dropDuplicates(["id"]).join(seen.select("id").distinct(), "id", "left_anti").orderBy(*order).limit(cap)


def until_empty(found: DataFrame, pages: DataFrame, source: str = "source", page: str = "page") -> DataFrame:
    """Records of paged sources up to the first page that has none: paging stops there."""
    bare = pages.select(source, page).join(found.select(source, page).distinct(), [source, page], "left_anti")
    ends = bare.groupBy(source).agg(F.min(page).alias("gleanery__end"))
    return found.join(ends, source, "left").where(F.col("gleanery__end").isNull() | (F.col(page) < F.col("gleanery__end"))).select(*found.columns)


def photos_a(search: DataFrame) -> DataFrame:
    p = search.select(F.explode("results").alias("p")).select("p.*")
    return p.select("id", F.col("user.name").alias("photographer"), F.coalesce("urls.full", "urls.raw").alias("photo_url"), F.coalesce("description", "alt_description", F.lit("")).alias("description"), F.coalesce("width", F.lit(0)).alias("width"), F.coalesce("height", F.lit(0)).alias("height")).dropDuplicates(["id"])


def photos_b(search: DataFrame) -> DataFrame:
    p = search.select(F.explode("photos").alias("p")).select("p.*")
    return p.select("id", "photographer", F.coalesce("src.original", "src.large2x").alias("photo_url"), F.coalesce("width", F.lit(0)).alias("width"), F.coalesce("height", F.lit(0)).alias("height")).dropDuplicates(["id"])


def local_files(spark: SparkSession, path: str) -> DataFrame:
    """Image files below a folder: source and sub-source are the first tokens of the name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,webp}").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    parts = F.split(name, "_")
    return files.select(name.alias("id"), parts[0].alias("source"), F.when(F.size(parts) > 2, parts[1]).alias("sub_source"), F.col("path").alias("filepath"), F.col("length").alias("file_size"), "content")


def source_table(spark: SparkSession, lists: dict[str, list[str | dict]], default_cap: int = 100, default_score: int = 50) -> DataFrame:
    """(kind, name, cap, min_score, place): the sub-sources, queries and pages of a configuration, each a
    name or a mapping with its own cap and score; a small table, in the order of the lists."""
    rows = []
    for kind, entries in lists.items():
        for k, e in enumerate(entries):
            given = {"name": e} if isinstance(e, str) else e
            rows.append((kind, str(given.get("name") or given.get("query") or given.get("url")), int(given.get("limit", default_cap)), int(given.get("min_score", default_score)), k))
    return spark.createDataFrame(rows, "kind string, name string, cap int, min_score int, place int")


def with_fallback(first: DataFrame, second: DataFrame, source: str) -> DataFrame:
    """Rows of `first`; from the first source on (by place) that has none there, those of `second`:
    once a listing fails, the feed is used for the rest. Both have columns source and place."""
    tried = second.select(source, "place").distinct().join(first.select(source).distinct().withColumn("found", F.lit(True)), source, "left")
    broken = tried.where("found is null").agg(F.min("place").alias("gleanery__from"))  # one row
    rest = second.crossJoin(F.broadcast(broken)).where(F.col("place") >= F.col("gleanery__from")).drop("gleanery__from")
    kept = first.crossJoin(F.broadcast(broken)).where(F.col("gleanery__from").isNull() | (F.col("place") < F.col("gleanery__from"))).drop("gleanery__from")
    return kept.unionByName(rest)
