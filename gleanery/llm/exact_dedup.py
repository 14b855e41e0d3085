"""Exact dedup by a log-structured merge index of text digests.

A memtable holds up to MEMTABLE entries of one task; it keeps the smallest identifier and the number
of documents of each digest. A flush writes memtables as sorted runs, Parquet files with row-group
ranges and Bloom filters on the digest. Compaction merges all runs and the present level by ranges of
the digest: the next level is sorted throughout, holds the smallest identifier and the number of
documents of each digest, and comes with a filter of the digests that have more than one. A lookup
probes that filter and merges what passes it with the level. Digests with one document are settled by
the level alone. The others are hits: their texts are verified byte by byte against the text of the
smallest identifier, and any that only share the digest are grouped by their whole text instead.

Only DataFrame functions are used. The texts of documents without a twin are never shuffled: the
filter, at most MOST_BITS, drops them at the scan.

Defined results: null texts count as empty and equal each other; a null doc_id never stays unless
its group has no other; rows that repeat both doc_id and text are the same document, so that all
of them carry the group's size (rows counted) and the same `kept`; an empty table gives an empty
result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import heavy_keys, scratch_path, spread_join, squeeze, stored

MEMTABLE = 1 << 20  # entries
MOST_BITS = 1 << 28  # of a filter: 32 MB
#: Bits in a row of the filter: what bitmap_construct_agg gives, 4 KB.
_ROW_BITS = 32768


class DigestIndex:
    """The runs and the compacted level under one path in the shared folder."""

    def __init__(self, spark: SparkSession, path: str, memtable: int = MEMTABLE, filter_bits: int | None = None):
        self.spark, self.path, self.level, self.memtable = spark, path, 0, memtable
        self.runs: list[str] = []  # not compacted yet
        self.flushed, self.bits, self.fixed_bits = 0, 0, filter_bits

    def flush(self, entries: DataFrame) -> None:
        """Add (digest, doc_id): memtables of `memtable` rows of a task become sorted runs of (run, digest, keep_id, n)."""
        at = F.monotonically_increasing_id()  # the task, and the row's place in it
        run = F.shiftright(at, 33) * F.lit(1 << 33) + F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / self.memtable)
        tables = entries.withColumn("run", run).groupBy("run", "digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
        self.runs.append(f"{self.path}/flush={self.flushed}")
        self.flushed += 1
        self._write(tables.sortWithinPartitions("run", "digest"), self.runs[-1])

    def _write(self, entries: DataFrame, path: str) -> None:
        writer = entries.write.option("parquet.bloom.filter.enabled#digest", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(path)

    def compact(self) -> None:
        """Merge the runs and the present level into the next: digest, keep_id, n, by ranges of the
        digest. A digest has one entry a run, so no range holds a common digest's documents."""
        merged = self.spark.read.parquet(*self.runs).select("digest", "keep_id", "n")
        if self.level:
            merged = merged.unionByName(self.entries())
        # The aggregation needs no other exchange: a range holds all entries of a digest.
        merged = merged.repartitionByRange("digest").groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        self.level += 1
        self._write(merged.sortWithinPartitions("digest"), f"{self.path}/level={self.level}")
        self.runs = []
        shared = self.entries().where("n > 1")
        wanted = self.fixed_bits or min(MOST_BITS, max(1 << 23, 1 << (8 * shared.count()).bit_length()))
        self.bits = wanted
        self.bit_filter = stored(_bit_filter(shared, wanted), "digest-filter")

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/level={self.level}")

    def lookup(self, probes: DataFrame, by: Column) -> DataFrame:
        """The probes (digest, ...) that are hits, with keep_id and n: those whose digest has more
        than one document. The filter is probed first; by: a hash by which a common digest's probes are
        dealt out."""
        shared = self.entries().where("n > 1")
        total = shared.agg(F.sum("n")).first()[0] or 0
        return spread_join(_maybe_in(probes, self.bit_filter, self.bits), shared, "digest", heavy_keys(shared, "digest", "n", total), by)


def _filter_position(digest: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(bits))


def _bit_filter(digests: DataFrame, bits: int) -> DataFrame:
    """(filter_row, bitmap): at most bits / 32768 rows of 4 KB, whatever the number of digests."""
    at = _filter_position(F.col("digest"), bits)
    return digests.groupBy(F.floor(at / _ROW_BITS).cast("long").alias("filter_row")).agg(F.bitmap_construct_agg((at % _ROW_BITS).cast("long")).alias("bitmap"))


def _maybe_in(rows: DataFrame, bit_filter: DataFrame, bits: int) -> DataFrame:
    """Rows whose digest has its bit set. The broadcast side holds bits / 8 bytes at most."""
    at = _filter_position(F.col("digest"), bits)
    bit = (at % _ROW_BITS).cast("int")
    rows = rows.withColumn("filter_row", F.floor(at / _ROW_BITS).cast("long"))
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(bit_filter), "filter_row").where(byte.bitwiseAND(F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), bit % 8).cast("int")) != 0).drop("filter_row", "bitmap")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32, filter_bits: int | None = None, copies_per_task: int = 128, memtable: int = MEMTABLE) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    digest_bytes: how much of the SHA-256 the index keys on; results don't depend on it, since
    hits are verified. filter_bits: size of the filter, a power of two (by default eight bits for
    each digest of more than one document, 1 MB at least and 32 MB at most); with far more digests
    it lets more rows through and results stay the same. copies_per_task: hits of one text are dealt
    out in groups of about that many, each with its own copy of the text that stays, so that no task
    gets a whole large group.
    """
    spark = docs.sparkSession
    normal = squeeze(F.col(text_col))
    sha = F.sha2(normal.cast("binary"), 256)
    base = docs.select(F.col(id_col).alias("doc_id"), normal.alias("normal"), sha.alias("text_sha256"))
    digest = F.substring(F.unhex("text_sha256"), 1, digest_bytes).alias("digest")

    index = DigestIndex(spark, scratch_path(spark, "digest-index"), memtable, filter_bits)
    index.flush(base.select(digest, "doc_id"))
    index.compact()
    entries = index.entries()

    # A digest of one document: the index has the whole answer.
    lone = entries.where("n = 1")
    if digest_bytes < 32:
        lone = lone.join(base.select(digest, "text_sha256"), "digest")
    else:
        lone = lone.withColumn("text_sha256", F.lower(F.hex("digest")))
    lone = lone.select(F.col("keep_id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")

    hits = index.lookup(base.withColumn("digest", digest), F.xxhash64("doc_id"))
    deals = F.ceil(F.col("n") / copies_per_task).cast("long")
    # Written, as the text that stays and the texts held against it both come from these rows.
    hits = stored(hits.withColumn("deal", F.pmod(F.xxhash64("doc_id"), deals)), "digest-hits")
    stays = hits.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest", "n").agg(F.min("normal").alias("kept_text"))
    stays = stays.select("digest", "kept_text", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / copies_per_task).cast("long") - 1)).alias("deal"))
    checked = hits.join(stays.hint("merge"), ["digest", "deal"]).withColumn("same", F.col("normal") == F.col("kept_text"))
    checked = stored(checked.select("doc_id", "keep_id", "n", "digest", "text_sha256", "same", F.when(~F.col("same"), F.col("normal")).alias("normal")), "digest-checked")
    same = checked.where("same").select("doc_id", "keep_id", "n", "digest", "text_sha256")
    # Documents that only share the digest of another text: grouped by the text itself.
    other = checked.where("not same").select("doc_id", "normal", "digest", "text_sha256")
    own = other.groupBy("normal").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    other_rows = other.join(own.hint("merge"), "normal")
    wrong = other.groupBy("digest").agg(F.count("*").alias("wrong"))
    heavy = heavy_keys(entries.where("n > 1"), "digest", "n", checked.count())
    same = spread_join(same, wrong, "digest", heavy, F.xxhash64("doc_id"), "left").withColumn("group_size", F.col("n") - F.coalesce("wrong", F.lit(0)))
    twins = same.select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(other_rows.select("doc_id", "keep_id", "group_size", "text_sha256"))
    twins = twins.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return lone.unionByName(twins)
