"""Manifest records: compact projection, JSON writing and reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _some(column: Column | None, kind: str) -> Column:
    return F.lit(None).cast(kind) if column is None else column


def compact_entry(
    key: Column, title: Column, category: Column, source: Column, when: Column, width: Column, height: Column, size: Column, score: Column, quality_tier: Column, aesthetic: Column, *,
    url: Column | None = None, subcategories: Column | None = None, artist: Column | None = None, artist_url: Column | None = None, colours: Column | None = None, hue: Column | None = None, brightness: Column | None = None, contrast: Column | None = None,
    dark: Column | None = None, composition: Column | None = None, symmetry: Column | None = None, depth: Column | None = None, complexity: Column | None = None, focal_point: Column | None = None, moods: Column | None = None, styles: Column | None = None,
    vectors: dict[str, Column] | None = None, model_category: Column | None = None, model_confidence: Column | None = None, sub_source: Column | None = None, upvotes: Column | None = None, post_url: Column | None = None, source_url: Column | None = None,
    licence: Column | None = None, diversity: Column | None = None,
) -> Column:
    """A struct with short keys. Null fields are left out when it's written as JSON, which is how
    conditional fields go: a model's category only where it differs, an artist only if known, a
    diversity only above 0, and what the source says only where it says something. vectors: by
    short name, as base64 (vectors.pack_base64)."""
    text = lambda c: F.nullif(_some(c, "string"), F.lit(""))
    known = ~F.lower(F.coalesce(_some(artist, "string"), F.lit(""))).isin("unknown", "")
    point = _some(focal_point, "array<double>")
    differs = (text(model_category) != category) & text(model_category).isNotNull()
    origin = F.struct(text(sub_source).alias("sr"), F.when(_some(upvotes, "long") != 0, _some(upvotes, "long").cast("long")).alias("up"), text(post_url).alias("pu"), text(source_url).alias("su"))
    fields = {
        "id": key.cast("string"), "t": title, "cat": category, "src": source, "ts": when.cast("long"), "dim": F.array(width.cast("long"), height.cast("long")),
        "ar": F.round(F.try_divide(width.cast("double"), height.cast("double")), 2), "sz": size.cast("long"), "qs": F.round(score, 3), "qt": quality_tier, "aes": F.round(aesthetic, 1),
        "col": _some(colours, "array<string>"), "hue": _some(hue, "int").cast("int"), "bri": _some(brightness, "int").cast("int"), "ctr": F.round(_some(contrast, "double"), 1), "dark": _some(dark, "boolean"),
        "comp": F.struct(_some(composition, "string").alias("t"), F.round(_some(symmetry, "double"), 2).alias("s"), F.round(_some(depth, "double"), 1).alias("d"), _some(complexity, "string").alias("c"), F.coalesce(point, F.array(F.lit(0.5), F.lit(0.5))).alias("fp")),
        "mood": _some(moods, "array<string>"), "style": _some(styles, "array<string>"), "emb": F.struct(*[v.alias(n) for n, v in (vectors or {}).items()]) if vectors else F.lit(None).cast("struct<mn4:string>"), "v": F.lit(2),
        "url": text(url), "sub": F.when(F.size(_some(subcategories, "array<string>")) > 0, _some(subcategories, "array<string>")), "mlc": F.when(differs, text(model_category)), "mlcf": F.when(differs, F.round(_some(model_confidence, "double"), 2)),
        "srcm": F.when(F.coalesce(*[origin[c].cast("string") for c in ("sr", "up", "pu", "su")]).isNotNull(), origin), "art": F.when(known, _some(artist, "string")), "artu": F.when(known, text(artist_url)), "lic": text(licence),
        "cdiv": F.when(_some(diversity, "double") > 0, F.round(_some(diversity, "double"), 2)),
    }
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def newest_first(entries: DataFrame, when: str = "ts", key: str = "id") -> DataFrame:
    """Entries in the order of a published collection: newest first, ties by id."""
    return entries.orderBy(F.desc(when), key)


def dated_name(date: str, existing: DataFrame, name: str = "name") -> str:
    """yyyy_mm_dd.json.gz, or with the next run's number if there is one already."""
    from gleanery.operators.windows import next_run

    found = next_run(existing.where(F.startswith(name, F.lit(date))).select(F.col(name).alias("name")), "name", F.lit(date)).select("next_name").first()
    return found[0] if found else f"{date}.json.gz"


def write_dated(entries: DataFrame, entry: str, folder: str, date: str, existing: DataFrame) -> str:
    """Publish entries under their dated name; the path."""
    path = f"{folder}/{dated_name(date, existing)}"
    write_entries(entries, entry, path)
    return path


def delta(entries: DataFrame, published: DataFrame, key: str = "id") -> DataFrame:
    """Entries that aren't published yet: what a weekly delta file holds."""
    return entries.join(published.select(key).distinct(), key, "left_anti")


def statistics_json(counts: DataFrame, rejected: DataFrame, by_source: DataFrame, date: str) -> DataFrame:
    """One JSON document of a run: counts (one row: total, passed, approved, uploaded), rejections by
    bucket (bucket, n) and candidates by source (source, n): a few rows each."""
    as_map = lambda df, key: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("m"))
    one = counts.crossJoin(as_map(rejected, "bucket").withColumnRenamed("m", "rejections")).crossJoin(as_map(by_source, "source").withColumnRenamed("m", "sources"))
    gone = F.greatest(F.col("total") - F.col("approved"), F.lit(0))
    told = F.aggregate(F.map_values("rejections"), F.lit(0).cast("long"), lambda a, x: a + x)
    return one.select(F.to_json(F.struct(
        F.col("total").alias("candidates_total"), F.col("approved").alias("approved_total"), gone.alias("rejected_total"), F.col("uploaded").alias("uploaded_total"), F.col("sources").alias("by_source"), F.col("passed").alias("passed_hard_filters"),
        F.map_concat("rejections", F.create_map(F.lit("unaccounted"), F.greatest(gone - told, F.lit(0)))).alias("rejection_breakdown"), F.lit(date).alias("timestamp"),
    )).alias("value"))


def write_entries(entries: DataFrame, entry: str, path: str) -> None:
    """One compressed JSON line for each entry; files are written in parallel and committed by
    Spark's output committer."""
    entries.select(F.to_json(entry).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def read_entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def envelope(entries: DataFrame, entry: str, date: str, limit: int = 100_000) -> DataFrame:
    """One manifest document of at most `limit` entries, which bounds what one row holds."""
    n = entries.limit(limit + 1).count()
    if n > limit:
        raise ValueError(f"a manifest holds {limit} entries at most; write them with write_entries")
    return entries.agg(F.to_json(F.struct(F.lit("1.2").alias("version"), F.lit(date).alias("date"), F.count("*").alias("count"), F.array_sort(F.collect_list(entry)).alias("wallpapers"))).alias("value"))


def read_collection(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entries of manifests whose root is a list, or an object with a list named wallpapers."""
    text = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"array<struct<{schema}>>", {"mode": "PERMISSIVE"})
    wrapped = F.from_json("value", f"struct<wallpapers array<struct<{schema}>>>")["wallpapers"]
    is_list = F.ltrim("value").startswith("[")
    return text.select(F.inline(F.when(is_list, listed).otherwise(wrapped)))
