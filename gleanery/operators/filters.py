"""Predicates with reason codes. The first failing check of the cascade gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.config import FilterSettings
from gleanery.operators.dedup import DedupIndex


def folded_aspect(width: Column, height: Column) -> Column:
    """Aspect ratio of at least 1, whichever side is longer."""
    w, h = width.cast("double"), height.cast("double")
    return F.greatest(w / h, h / w)


def size_reason(size: Column, s: FilterSettings) -> Column:
    return F.when(size < s.min_file_size, F.lit("File too small")).when(size > s.max_file_size, F.lit("File too large"))


def resolution_reason(width: Column, height: Column, s: FilterSettings) -> Column:
    """Rejects only if both sides are too short."""
    return F.when((width < s.min_width) & (height < s.min_height), F.concat(F.lit("Resolution too low: "), width.cast("string"), F.lit("x"), height.cast("string")))


def aspect_reason(width: Column, height: Column, s: FilterSettings) -> Column:
    ratio = folded_aspect(width, height)
    return F.when(ratio < s.min_aspect, F.lit("Aspect ratio too narrow")).when(ratio > s.max_aspect, F.lit("Aspect ratio too wide"))


def integrity_reason(content: Column) -> Column:
    """By the magic bytes of JPEG, PNG and WEBP."""
    head = F.hex(F.substring(content, 1, 12))
    good = head.startswith("FFD8FF") | head.startswith("89504E470D0A1A0A") | (head.startswith("52494646") & head.endswith("57454250"))
    return F.when(~F.coalesce(good, F.lit(False)), F.lit("Corrupt or unsupported format"))


def alnum_ratio(text: Column) -> Column:
    """Share of letters and digits; 0 for an empty text."""
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", "")).cast("double"), F.length(text).cast("double")), F.lit(0.0))


def text_coverage(tokens: Column, width: Column, height: Column) -> Column:
    """Area of the words that OCR is sure of, over the image's: tokens are structs of conf, text,
    width and height; a word counts from confidence 80 and 3 letters on, half of them alphanumeric."""
    sure = F.filter(tokens, lambda t: (t["conf"] > 80) & (F.length(t["text"]) >= 3) & (alnum_ratio(t["text"]) >= 0.5))
    area = F.aggregate(sure, F.lit(0.0), lambda a, t: a + t["width"] * t["height"])
    return F.coalesce(F.try_divide(area, (width * height).cast("double")), F.lit(0.0))


def text_reason(tokens: Column, width: Column, height: Column, s: FilterSettings) -> Column:
    """Rejects by the share that sure words cover; an image without words passes."""
    covered = text_coverage(tokens, width, height)
    return F.when(covered > s.max_text_coverage, F.concat(F.lit("Too much text: "), F.format_string("%.1f%%", covered * 100)))


def fetch_reason(status: Column, content_type: Column, url: Column) -> Column:
    """What a downloaded response must be: status 200, an image, of a supported type."""
    from gleanery.functions.text import is_supported

    image = F.lower(F.coalesce(content_type, F.lit(""))).startswith("image/")
    return F.when(F.coalesce(status, F.lit(0)) != 200, F.concat(F.lit("Download failed: HTTP "), F.coalesce(status.cast("string"), F.lit("none")))).when(~image, F.lit("Download failed: no image")).when(~is_supported(url, content_type), F.lit("Download failed: type"))


def filter_cascade(df: DataFrame, reasons: list[Column]) -> DataFrame:
    """Adds reason (null if all pass) and passed."""
    reason = F.coalesce(*reasons)
    return df.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def hard_filters(df: DataFrame, s: FilterSettings, index: DedupIndex | None = None) -> DataFrame:
    """The whole cascade over id, url, filepath, file_size, content (its first bytes), width, height,
    tokens, sha256 and phash: missing file, size, integrity, resolution, aspect, text; and with an
    index, duplicates, which are looked up for the rows that pass the others only."""
    w, h = F.col("width"), F.col("height")
    missing = F.when(F.col("filepath").isNull(), F.lit("No valid filepath"))
    out = filter_cascade(df, [missing, size_reason(F.col("file_size"), s), integrity_reason(F.col("content")), resolution_reason(w, h, s), aspect_reason(w, h, s), text_reason(F.col("tokens"), w, h, s)])
    if index is None:
        return out
    found = index.check(out.where("passed").select("id", "url", "sha256", "phash")).where("is_duplicate").select("id", F.concat(F.lit("Duplicate: "), F.col("reason")).alias("gleanery__dup"))
    out = out.join(found, "id", "left").withColumn("reason", F.coalesce("reason", "gleanery__dup"))
    return out.withColumn("passed", F.col("reason").isNull()).drop("gleanery__dup")


def bar_statistics(df: DataFrame, source: Column, cropped: Column, failed: Column) -> DataFrame:
    """One row: total, forum (rows whose source may have bars), cropped and failed of these."""
    forum = F.lower(source) == "reddit"
    return df.agg(F.count("*").alias("total"), F.count_if(forum).alias("forum"), F.count_if(forum & cropped).alias("cropped"), F.count_if(forum & failed).alias("failed"))


#: Buckets in the order in which they are tried, and the parts of a reason that lead to each.
REASON_BUCKETS = (
    ("resolution", ("resolution",)),
    ("file_integrity", ("corrupt", "format")),
    ("aspect_ratio", ("aspect",)),
    ("text_detection", ("text",)),
    ("file_size", ("size", "small", "large")),
    ("duplicate", ("duplicate", "already fetched", "already processed", "exact content match", "visual match")),
    ("download_failed", ("download", "filepath", "no valid filepath")),
)


def reason_bucket(reason: Column) -> Column:
    """The first bucket with a part that the reason contains; other if it's empty or unknown."""
    low = F.lower(F.coalesce(reason, F.lit("")))
    bucket = F.when((low == "") | (low == "unknown"), F.lit("other"))
    for name, parts in REASON_BUCKETS:
        test = F.lit(False)
        for part in parts:
            test = test | low.contains(part)
        bucket = bucket.when(test, F.lit(name))
    return bucket.otherwise(F.lit("other"))
