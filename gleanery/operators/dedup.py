"""Duplicate detection against an index of what was seen, and within a batch.

The index is four keyed tables: seen_urls(url), seen_ids(id), content_hashes(sha256, id, seq) and
phash_index(phash, id, seq). Of several entries for a key, the last by seq holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.operators.hamming import first_match, hamming, hamming_join  # noqa: F401


def normal_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def first_seen(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key, with `copies`, the number of its rows; null is a key. One aggregation:
    each task keeps the first row of a key that it sees."""
    rows = df.groupBy(key.alias("gleanery__key")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("gleanery__row"), F.count("*").alias("copies"))
    return rows.select("gleanery__row.*", "copies")


def unseen(df: DataFrame, seen: DataFrame, on: str) -> DataFrame:
    """Rows whose key the index doesn't have; null and empty keys are never seen."""
    return df.join(seen.select(on).where(F.col(on).isNotNull() & (F.col(on).cast("string") != "")).distinct(), on, "left_anti")


def layered_check(df: DataFrame, seen_urls: DataFrame, seen_ids: DataFrame, content_hashes: DataFrame, phash_index: DataFrame | None = None, radius: int = 10) -> DataFrame:
    """df (id, url, sha256, ...) with is_duplicate, match_id and reason of the first layer that
    matches: url, then id, then content, then, with an index of perceptual hashes (phash, id, seq)
    and a column phash, looks. Only rows that no other layer matches are looked up by their looks."""
    urls = seen_urls.select(F.col("url"), F.lit(True).alias("by_url")).distinct()
    ids = seen_ids.select(F.col("id"), F.lit(True).alias("by_id")).distinct()
    hashes = content_hashes.groupBy("sha256").agg(F.max_by("id", "seq").alias("by_content"))
    out = df.join(urls, "url", "left").join(ids, "id", "left").join(hashes, "sha256", "left")
    url_hit = F.coalesce("by_url", F.lit(False)) & (F.col("url") != "")
    known = url_hit | F.col("by_id").isNotNull() | F.col("by_content").isNotNull()
    visual = F.lit(None).cast(content_hashes.schema["id"].dataType)
    if phash_index is not None:
        queries = out.where(~F.coalesce(known, F.lit(False)) & F.col("phash").isNotNull()).select(F.col("id").alias("id_a"), F.col("phash").alias("hash_a"))
        found = first_match(queries, phash_index.select(F.col("id").alias("id_b"), F.col("phash").alias("hash_b"), "seq"), radius)
        out = out.join(found.select(F.col("id_a").alias("id"), F.col("match_id").alias("by_looks")), "id", "left")
        visual = F.col("by_looks")
    reason = F.when(url_hit, F.lit("URL already fetched")).when(F.col("by_id"), F.lit("ID already processed")).when(F.col("by_content").isNotNull(), F.lit("Exact content match")).when(visual.isNotNull(), F.lit("Visual match"))
    match = F.when(~url_hit & F.col("by_id").isNull(), F.coalesce("by_content", visual))
    return out.withColumn("match_id", match).withColumn("reason", reason).withColumn("is_duplicate", F.col("reason").isNotNull()).drop("by_url", "by_id", "by_content", "by_looks")


class DedupIndex:
    """The four tables of an index below one path, read and registered together."""

    KEYS = {"seen_urls": "url", "seen_ids": "id", "content_hashes": "sha256", "phash_index": "phash"}

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], radius: int = 10):
        missing = set(self.KEYS) - set(tables)
        if missing:
            raise ValueError(f"an index needs {', '.join(sorted(missing))}")
        self.spark, self.tables, self.radius = spark, tables, radius

    @classmethod
    def open(cls, spark: SparkSession, path: str, radius: int = 10) -> DedupIndex:
        return cls(spark, {name: spark.read.parquet(f"{path}/{name}") for name in cls.KEYS}, radius)

    def check(self, df: DataFrame) -> DataFrame:
        t = self.tables
        return layered_check(df, t["seen_urls"], t["seen_ids"], t["content_hashes"], t["phash_index"], self.radius)

    def surely_new(self, df: DataFrame, column: str) -> DataFrame:
        """df with surely_new: false for keys that the index may have, by a bit filter of fixed size,
        true for keys that it hasn't for certain."""
        name = next(n for n, key in self.KEYS.items() if key == column)
        bits = 1 << 23
        at = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(bits))
        seen = self.tables[name].groupBy(F.floor(at(column) / 32768).alias("gleanery__row")).agg(F.bitmap_construct_agg((at(column) % 32768).cast("long")).alias("gleanery__bits"))
        rows = df.withColumn("gleanery__row", F.floor(at(column) / 32768)).join(F.broadcast(seen), "gleanery__row", "left")  # 256 rows of 4 KB at most
        byte = F.conv(F.hex(F.substring("gleanery__bits", F.floor(at(column) % 32768 / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        maybe = byte.bitwiseAND(F.pow(F.lit(2), at(column) % 8).cast("int")) != 0
        return rows.withColumn("surely_new", ~F.coalesce(maybe, F.lit(False)) & F.col(column).isNotNull()).drop("gleanery__row", "gleanery__bits")


def register(index: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The index with new entries (key, id, seq): the last writer of a key holds. Registering the
    same entries again changes nothing."""
    both = index.select(key, "id", "seq").unionByName(new.select(key, "id", "seq"))
    return both.groupBy(key).agg(F.max_by("id", "seq").alias("id"), F.max("seq").alias("seq"))


def sign_hash(vector: Column, dims: int = 64) -> Column:
    """A 64-bit hash of the signs of a vector's first dimensions."""
    bits = F.transform(F.slice(vector, 1, dims), lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def collisions(df: DataFrame, key: Column) -> DataFrame:
    """hash, n of the keys of more than one row."""
    return df.groupBy(key.alias("hash")).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def collision_members(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """(hash, id): a row for each row whose key others have too."""
    rows = df.select(key.alias("hash"), F.col(id_col).alias("id"))
    return rows.join(collisions(df, key).select("hash"), "hash")


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep-first within small groups such as a page: row_number over the key."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("rn = 1").drop("rn")
