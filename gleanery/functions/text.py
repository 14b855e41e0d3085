"""Names, slugs, categories, paths and labels from text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Image extensions in the order in which they are tried.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".gif")

#: Content types and their extensions.
CONTENT_TYPES = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif"}

SUPPORTED = (".jpg", ".jpeg", ".png", ".webp")

#: Words that titles leave out.
SLUG_STOP_WORDS = ("4k", "hd", "desktop", "wallpaper", "background", "photo", "image")

#: Keywords by category, in order.
KEYWORDS = {
    "nature": ("landscape", "mountain", "forest", "ocean", "beach", "lake", "river", "waterfall"),
    "urban": ("city", "skyline", "street", "architecture", "building", "bridge"),
    "space": ("galaxy", "nebula", "stars", "planet", "cosmos", "aurora"),
    "abstract": ("geometric", "pattern", "gradient", "fractal", "minimalist"),
    "art": ("illustration", "digital art", "painting", "concept art"),
    "technology": ("cyberpunk", "sci-fi", "futuristic", "neon"),
}

#: Category and subcategories by a part of the sub-source's name, in order.
SUB_SOURCES = {"earthporn": ("nature", ("landscape", "photography")), "cityporn": ("urban", ("cityscape", "architecture")), "amoled": ("abstract", ("dark", "amoled")), "minimal": ("abstract", ("minimalist",))}


def title_case(text: Column) -> Column:
    """Upper case after each character that isn't a letter, lower case elsewhere."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def extension(url: Column, content_type: Column | None = None) -> Column:
    """From the path, then from the content type, else .jpg."""
    path = F.lower(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", ""))
    found = F.when(F.lit(False), F.lit(""))
    for e in EXTENSIONS:
        found = found.when(F.endswith(path, F.lit(e)), F.lit(e))
    if content_type is not None:
        kind = F.trim(F.split(content_type, ";")[0])
        for name, e in CONTENT_TYPES.items():
            found = found.when(kind == name, F.lit(e))
    return found.otherwise(F.lit(".jpg"))


def is_supported(url: Column, content_type: Column | None = None) -> Column:
    return extension(url, content_type).isin(*SUPPORTED)


def post_image_url(url: Column, is_gallery: Column, gallery: Column, preview: Column, min_width: int = 1920, min_height: int = 1080) -> Column:
    """The image of a forum post: a direct link, a hosted image, the first valid gallery image, a
    single image of the known host, then a preview of sufficient size.

    gallery: array of structs (status, u); preview: struct (url, width, height)."""
    low = F.lower(url)
    direct = F.lit(False)
    for e in EXTENSIONS:
        direct = direct | F.endswith(low, F.lit(e))
    unescape = lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))
    valid = F.filter(gallery, lambda m: (m["status"] == "valid") & m["u"].isNotNull())
    host_id = F.regexp_extract(url, r"imgur\.com/(\w+)", 1)
    single = low.contains("imgur.com") & ~low.contains("/a/") & ~low.contains("/gallery/") & (host_id != "")
    big = ~((F.coalesce(preview["width"], F.lit(0)) < min_width) & (F.coalesce(preview["height"], F.lit(0)) < min_height))
    fallback = F.when(big & (preview["url"] != "") & is_supported(preview["url"]), unescape(preview["url"]))
    return (
        F.when(direct | low.contains("i.redd.it"), url).when(F.coalesce(is_gallery, F.lit(False)), unescape(F.try_element_at(valid, F.lit(1))["u"])).when(single, F.concat(F.lit("https://i.imgur.com/"), host_id, F.lit(".jpg"))).otherwise(fallback)
    )


def slug_parts(name: Column) -> Column:
    """A file name's parts without its extension."""
    return F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "-")


def slug_id(path: Column, data_id: Column | None = None) -> Column:
    """A given id, else the digits that start the file name, else a digest of the path."""
    name = F.element_at(F.split(path, "/"), -1)
    digits = F.nullif(F.regexp_extract(name, r"^(\d+)", 1), F.lit(""))
    own = F.coalesce(digits, F.substring(F.md5(path.cast("binary")), 1, 8))
    return own if data_id is None else F.coalesce(F.nullif(data_id, F.lit("")), own)


def slug_resolution(name: Column) -> Column:
    return F.try_element_at(F.filter(slug_parts(name), lambda p: p.rlike(r"^\d{3,5}x\d{3,5}$")), F.lit(1))


def slug_title(name: Column, default: Column) -> Column:
    """Parts after the first, without resolutions and stop words; the default if none is left."""
    parts = F.slice(slug_parts(name), 2, 1 << 20)
    parts = F.filter(parts, lambda p: ~p.rlike(r"^\d{3,5}x\d{3,5}$") & ~F.lower(p).isin(*SLUG_STOP_WORDS))
    return F.when(F.size(parts) > 0, title_case(F.array_join(parts, " "))).otherwise(default)


def numbered_slug(name: Column) -> Column:
    """Struct (id, resolution, title) of names such as title-words-3840x2160-2762.png."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    title = F.regexp_replace(F.regexp_replace(stem, r"-\d+$", ""), r"-\d{3,5}x\d{3,5}", "")
    return F.struct(
        F.nullif(F.regexp_extract(name, r"-(\d+)\.\w+$", 1), F.lit("")).alias("id"), F.nullif(F.regexp_extract(name, r"-(\d{3,5}x\d{3,5})-", 1), F.lit("")).alias("resolution"),
        title_case(F.trim(F.replace(title, F.lit("-"), F.lit(" ")))).alias("title"),
    )


def keyword_category(title: Column, sub_source: Column | None = None, keywords: dict[str, tuple[str, ...]] = KEYWORDS, sub_sources: dict[str, tuple[str, tuple[str, ...]]] = SUB_SOURCES) -> Column:
    """Struct (category, subcategories): by the sub-source, else by the first keyword in the title,
    which is the subcategory; general and none without either."""
    low = F.lower(F.coalesce(title, F.lit("")))

    def pair(category: str, more: tuple[str, ...]) -> Column:
        return F.struct(F.lit(category).alias("category"), F.array(*map(F.lit, more)).cast("array<string>").alias("subcategories"))

    out = F.when(F.lit(False), pair("", ()))
    if sub_source is not None:
        for part, (category, more) in sub_sources.items():
            out = out.when(F.lower(sub_source).contains(part), pair(category, more))
    for category, words in keywords.items():
        for word in words:
            out = out.when(low.contains(word), pair(category, (word,)))
    return out.otherwise(pair("general", ()))


def collection_name(url: Column) -> Column:
    """The name of a collection from the first part of its page's path: words in title case."""
    part = F.element_at(F.split(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/*", ""), "/"), 1)
    return title_case(F.regexp_replace(part, r"[-_]+", " "))


def output_id(category: Column, when: Column, key: Column) -> Column:
    """category_unixtime_nnnn, with digits from a digest of the key instead of chance."""
    digits = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 9000 + 1000
    return F.concat_ws("_", category, F.unix_seconds(when.cast("timestamp")).cast("string"), digits.cast("string"))


def object_path(when: Column, category: Column, name: Column, ext: Column) -> Column:
    return F.concat(F.date_format(when, "yyyy/MM/"), category, F.lit("/wp_"), name, ext)


def public_url(path: Column, domain: str | None, bucket_host: str) -> Column:
    return F.concat(F.lit(f"https://{domain or bucket_host}/"), path)


def duration(seconds: Column) -> Column:
    return F.when(seconds < 60, F.format_string("%.1fs", seconds)).when(seconds < 3600, F.format_string("%.1fm", seconds / 60)).otherwise(F.format_string("%.1fh", seconds / 3600))
