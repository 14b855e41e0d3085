"""Filter cascade, dedup, scores and the flagship curation query.

Documents stand for candidates: their width is n_chars, their height and size follow from the id
and n_chars, so that every branch of the cascade occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.config import Settings
from gleanery.operators import dedup, filters, reports, scoring
from gleanery.plans.registry import query, table

S = Settings()

#: The share of an image that its sure words cover, where words stand for what OCR found.
COVERED = r"""coalesce(list_sum(list_transform(list_filter(list_transform(string_split(text, ' '), lambda w, i: {'w': w, 'c': 60 + ((i - 1) * 7) % 40}),
    lambda s: s.c > 80 AND length(s.w) >= 3 AND length(regexp_replace(s.w, '[^\p{L}\p{N}]', '', 'g'))::DOUBLE / length(s.w) >= 0.5), lambda s: length(s.w) * 60 * 40.0::DOUBLE)), 0)::DOUBLE"""

CANDIDATES = f"""
    c AS (SELECT doc_id, source, lang, text, n_chars, n_chars AS width, 400 + doc_id * 37 % 2400 AS height, n_chars * 300 AS file_size,
                 CASE WHEN doc_id % 97 = 0 THEN NULL ELSE 'f' || doc_id END AS filepath FROM documents),
    r AS (SELECT *, CASE
        WHEN filepath IS NULL THEN 'No valid filepath'
        WHEN file_size < 102400 THEN 'File too small'
        WHEN file_size > 20971520 THEN 'File too large'
        WHEN doc_id % 29 = 0 THEN 'Corrupt or unsupported format'
        WHEN width < 1920 AND height < 1080 THEN 'Resolution too low: ' || width || 'x' || height
        WHEN greatest(width::DOUBLE / height, height::DOUBLE / width) > 3.0 THEN 'Aspect ratio too wide'
        WHEN {COVERED} / (width * height) > 0.5 THEN 'Too much text' END AS reason FROM c)"""


def candidates(docs: DataFrame) -> DataFrame:
    """Documents as images: sizes from their length, first bytes by their id, words as what OCR found."""
    k = F.col("doc_id") % 29
    head = F.when(k == 0, F.col("text").cast("binary")).when(k == 1, F.unhex(F.lit("89504E470D0A1A0A0000000D"))).when(k == 2, F.unhex(F.lit("524946460000000057454250"))).otherwise(F.unhex(F.lit("FFD8FFE000104A4649460001")))
    tokens = F.transform(F.split("text", " ", -1), lambda w, i: F.struct((60 + (i * 7) % 40).alias("conf"), w.alias("text"), (F.length(w) * 60).alias("width"), F.lit(40.0).alias("height")))
    return docs.select(
        "doc_id", "source", "lang", "text", "n_chars", F.col("n_chars").alias("width"), (400 + F.col("doc_id") * 37 % 2400).alias("height"), (F.col("n_chars") * 300).alias("file_size"),
        F.when(F.col("doc_id") % 97 != 0, F.concat(F.lit("f"), F.col("doc_id").cast("string"))).alias("filepath"), head.alias("content"), tokens.alias("tokens"),
    )


def cascade(docs: DataFrame) -> DataFrame:
    out = filters.hard_filters(candidates(docs), S.filters)
    return out.withColumn("reason", F.regexp_replace("reason", "^(Too much text): .*$", "$1"))  # the share is measured by text_coverage_filter


@query(f"WITH {CANDIDATES} SELECT doc_id, reason, reason IS NULL AS passed FROM r")
def hard_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(table(spark, sf_dir, "documents")).select("doc_id", "reason", "passed")


BUCKET = """CASE WHEN reason IS NULL OR reason = '' OR lower(reason) = 'unknown' THEN 'other'
    WHEN lower(reason) LIKE '%resolution%' THEN 'resolution' WHEN lower(reason) LIKE '%corrupt%' OR lower(reason) LIKE '%format%' THEN 'file_integrity'
    WHEN lower(reason) LIKE '%aspect%' THEN 'aspect_ratio' WHEN lower(reason) LIKE '%text%' THEN 'text_detection'
    WHEN lower(reason) LIKE '%size%' OR lower(reason) LIKE '%small%' OR lower(reason) LIKE '%large%' THEN 'file_size'
    WHEN lower(reason) LIKE '%duplicate%' OR lower(reason) LIKE '%already fetched%' OR lower(reason) LIKE '%already processed%' OR lower(reason) LIKE '%exact content match%' OR lower(reason) LIKE '%visual match%' THEN 'duplicate'
    WHEN lower(reason) LIKE '%download%' OR lower(reason) LIKE '%filepath%' THEN 'download_failed' ELSE 'other' END"""


@query(f"WITH {CANDIDATES} SELECT {BUCKET} AS bucket, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1")
def rejection_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = cascade(table(spark, sf_dir, "documents")).where("not passed")
    return rejected.groupBy(filters.reason_bucket(F.col("reason")).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"WITH {CANDIDATES} SELECT doc_id, round({COVERED} / (width * height), 6) AS coverage, {COVERED} / (width * height) > 0.5 AS flagged FROM c")
def text_coverage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of an image that its sure words cover."""
    rows = candidates(table(spark, sf_dir, "documents")).select("doc_id", filters.text_coverage(F.col("tokens"), F.col("width"), F.col("height")).alias("coverage"))
    return rows.select("doc_id", F.round("coverage", 6).alias("coverage"), (F.col("coverage") > S.filters.max_text_coverage).alias("flagged"))


@query("""SELECT min(doc_id) AS doc_id, sha256(text) AS sha256, count(*) AS copies FROM documents GROUP BY text""")
def exact_dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return dedup.first_seen(docs, F.col("sha256"), ["doc_id"]).select("doc_id", "sha256", "copies")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def seen_id_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.unseen(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


CANONICAL = r"""(SELECT *, lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1)) || substr(bare, length(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1)) + 1) AS curl
    FROM (SELECT *, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS bare FROM pages))"""


@query(f"""SELECT page_id, curl AS url FROM {CANONICAL} WHERE curl IN (SELECT curl FROM {CANONICAL} WHERE page_id % 3 = 0)""")
def seen_url_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.sources.html import canonical_url

    pages = table(spark, sf_dir, "pages").select("page_id", canonical_url(F.col("url")).alias("url"))
    return pages.join(pages.where("page_id % 3 = 0").select("url").distinct(), "url", "left_semi").select("page_id", "url")


@query("""WITH x AS (SELECT doc_id, 'u' || (doc_id % 400) AS url, sha256(text) AS h FROM documents),
    hashes AS (SELECT h, max_by(doc_id, doc_id) AS match FROM x WHERE doc_id % 2 = 0 GROUP BY h)
    SELECT doc_id, CASE WHEN url IN (SELECT DISTINCT 'u' || (item_id * 9) FROM benchmark) THEN 'URL already fetched'
        WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'ID already processed' WHEN match IS NOT NULL THEN 'Exact content match' END AS reason,
        CASE WHEN url NOT IN (SELECT DISTINCT 'u' || (item_id * 9) FROM benchmark) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN match END AS match_id
    FROM x LEFT JOIN hashes USING (h)""")
def layered_duplicate_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("u"), (F.col("doc_id") % 400).cast("string")).alias("url"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    urls = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("u"), (F.col("item_id") * 9).cast("string")).alias("url"))
    ids = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    hashes = docs.where("id % 2 = 0").select("sha256", "id", F.col("id").alias("seq"))
    return dedup.layered_check(docs, urls, ids, hashes).select(F.col("id").alias("doc_id"), "reason", "match_id")


LOOKS = """
    h AS (SELECT vec_id, list_reduce(list_transform(embedding[1:64], lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END::UBIGINT), lambda a, b: ((a % 9223372036854775808::UBIGINT) * 2 + b)::UBIGINT, 0::UBIGINT) AS p FROM embeddings),
    x AS (SELECT vec_id AS id, 'u' || (vec_id % 50) AS url, sha256('c' || (vec_id % 100)) AS sha, p FROM h),
    hashes AS (SELECT sha, max(id) AS match FROM x WHERE id % 8 = 0 GROUP BY sha),
    looks AS (SELECT id + 1000000 AS id, xor(p, (id * 7919 % 65536)::UBIGINT) AS p FROM x WHERE id % 2 = 0),
    k AS (SELECT x.*, match, url IN (SELECT 'u' || r_regionkey FROM region) AS by_url, id IN (SELECT n_nationkey FROM nation) AS by_id FROM x LEFT JOIN hashes USING (sha)),
    v AS (SELECT k.id, min(l.id) AS seen FROM k JOIN looks l ON bit_count(xor(k.p, l.p)) <= 10 WHERE NOT by_url AND NOT by_id AND match IS NULL GROUP BY k.id),
    d AS (SELECT k.id, CASE WHEN by_url THEN 'URL already fetched' WHEN by_id THEN 'ID already processed' WHEN match IS NOT NULL THEN 'Exact content match' WHEN seen IS NOT NULL THEN 'Visual match' END AS reason,
        CASE WHEN NOT by_url AND NOT by_id THEN coalesce(match, seen) END AS match_id FROM k LEFT JOIN v USING (id))"""


def dedup_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dedup.DedupIndex]:
    """Vectors as images, and an index of all four layers; the looks of half of them, some bits off."""
    items = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.concat(F.lit("u"), (F.col("vec_id") % 50).cast("string")).alias("url"), F.sha2(F.concat(F.lit("c"), (F.col("vec_id") % 100).cast("string")).cast("binary"), 256).alias("sha256"), dedup.sign_hash(F.col("embedding")).alias("phash"))
    looks = items.where("id % 2 = 0").select((F.col("id") + 1_000_000).alias("id"), F.col("phash").bitwiseXOR(F.col("id") * 7919 % 65536).alias("phash")).withColumn("seq", F.col("id"))
    tables = {
        "seen_urls": table(spark, sf_dir, "region").select(F.concat(F.lit("u"), F.col("r_regionkey").cast("string")).alias("url")), "seen_ids": table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id")),
        "content_hashes": items.where("id % 8 = 0").select("sha256", "id", F.col("id").alias("seq")), "phash_index": looks,
    }
    return items, dedup.DedupIndex(spark, tables, S.filters.hamming_threshold)


@query(f"WITH {LOOKS} SELECT id, reason, match_id FROM d")
def full_duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four layers: url, id, content, looks."""
    items, index = dedup_index(spark, sf_dir)
    return index.check(items).select("id", "reason", "match_id")


@query(f"""WITH {LOOKS} SELECT id, CASE WHEN id % 31 = 0 THEN 'No valid filepath' WHEN id % 37 = 0 THEN 'File too small' WHEN id % 41 = 0 THEN 'Corrupt or unsupported format' WHEN id % 43 = 0 THEN 'Resolution too low: 800x600'
    WHEN id % 47 = 0 THEN 'Aspect ratio too wide' WHEN id % 53 = 0 THEN 'Too much text: 60.0%' WHEN reason IS NOT NULL THEN 'Duplicate: ' || reason END AS reason FROM d""")
def full_hard_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cascade, duplicates last; only what passes the others is looked up."""
    items, index = dedup_index(spark, sf_dir)
    k = F.col("id")
    small = k % 43 == 0
    width = F.when(small, 800).when(k % 47 == 0, 9000).otherwise(2560)
    height = F.when(small, 600).otherwise(1440)
    word = F.struct(F.lit(95).alias("conf"), F.lit("wordy").alias("text"), (width * F.when(k % 53 == 0, 0.6).otherwise(0.1)).alias("width"), height.cast("double").alias("height"))
    images = items.select("*", F.when(k % 31 != 0, "f").alias("filepath"), F.when(k % 37 == 0, 1000).otherwise(500_000).alias("file_size"), F.unhex(F.when(k % 41 == 0, "00").otherwise("FFD8FFE000104A4649460001")).alias("content"), width.alias("width"), height.alias("height"), F.array(word).alias("tokens"))
    return filters.hard_filters(images, S.filters, index).select("id", "reason")


@query("WITH i AS (SELECT DISTINCT doc_id AS id FROM labels) SELECT doc_id, doc_id NOT IN (SELECT id FROM i) AS surely_new FROM documents")
def quick_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bit filter of the index: what it calls new is new for certain."""
    none = spark.createDataFrame([], "url string, sha256 string, phash long, id long, seq long")
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    index = dedup.DedupIndex(spark, {"seen_urls": none.select("url"), "seen_ids": ids, "content_hashes": none, "phash_index": none})
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    # What the filter may have is settled by the index itself.
    screened = index.surely_new(docs, "id")
    maybe = screened.where("not surely_new").join(ids.distinct().withColumn("seen", F.lit(True)), "id", "left").select("id", F.col("seen").isNull().alias("surely_new"))
    return screened.where("surely_new").select("id", "surely_new").unionByName(maybe).select(F.col("id").alias("doc_id"), "surely_new")


@query("SELECT sha256(text) AS hash, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def hash_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.collisions(table(spark, sf_dir, "documents"), F.sha2(F.col("text").cast("binary"), 256))


@query("SELECT sha256(text) AS hash, doc_id AS id FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)")
def hash_collision_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.collision_members(table(spark, sf_dir, "documents"), F.sha2(F.col("text").cast("binary"), 256), "doc_id")


@query("""WITH e AS (SELECT sha256(text) AS h, doc_id FROM documents)
    SELECT h AS sha256, max(doc_id) AS id FROM e GROUP BY h""")
def index_upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.col("doc_id").alias("id"), F.col("doc_id").alias("seq"))
    old = dedup.register(entries.where("id % 2 = 0"), entries.limit(0), "sha256")
    once = dedup.register(old, entries.where("id % 2 = 1"), "sha256")
    return dedup.register(once, entries.where("id % 2 = 1"), "sha256").select("sha256", "id")


@query("""SELECT (SELECT count(DISTINCT url) FROM pages) AS n_urls, (SELECT count(*) FROM labels) AS n_ids, (SELECT count(DISTINCT text) FROM documents) AS n_hashes""")
def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").agg(F.count_distinct("url").alias("n_urls"))
    ids = table(spark, sf_dir, "labels").agg(F.count("*").alias("n_ids"))
    hashes = table(spark, sf_dir, "documents").agg(F.count_distinct(F.sha2(F.col("text").cast("binary"), 256)).alias("n_hashes"))
    return urls.crossJoin(ids).crossJoin(hashes)  # one row each


SIGNALS = """
    s AS (SELECT d.doc_id, CASE d.doc_id % 4 WHEN 0 THEN 'Reddit' WHEN 1 THEN 'unsplash' WHEN 2 THEN 'pexels' ELSE 'other' END AS kind, d.source,
        1 + (d.n_chars % 1000) / 100.0::DOUBLE AS raw, 1.0::DOUBLE - coalesce(l.toxic, 0) * 0.5::DOUBLE AS technical, coalesce(l.quality, 0)::DOUBLE AS suitability
        FROM documents d LEFT JOIN labels l USING (doc_id)),
    q AS (SELECT *, (greatest(1.0, least(10.0, raw)) - 1.0) / 9.0 AS aesthetic FROM s),
    f AS (SELECT *, CASE kind WHEN 'Reddit' THEN aesthetic * 0.60 + technical * 0.15 + suitability * 0.25 WHEN 'other' THEN aesthetic * 0.55 + technical * 0.15 + suitability * 0.30
        ELSE aesthetic * 0.40 + technical * 0.10 + suitability * 0.50 END AS final,
        CASE WHEN raw >= 6.5 THEN 'premium' WHEN raw >= 5.5 THEN 'standard' WHEN raw >= 4.0 THEN 'acceptable' ELSE 'low' END AS tier FROM q)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kind = F.when(F.col("doc_id") % 4 == 0, "Reddit").when(F.col("doc_id") % 4 == 1, "unsplash").when(F.col("doc_id") % 4 == 2, "pexels").otherwise("other")
    rows = docs.select("doc_id", "source", "n_chars").join(labels, "doc_id", "left").select(
        "doc_id", kind.alias("kind"), "source", (1 + (F.col("n_chars") % 1000) / 100.0).alias("raw"), (F.lit(1.0) - F.coalesce("toxic", F.lit(0)) * 0.5).alias("technical"), F.coalesce("quality", F.lit(0)).cast("double").alias("suitability"),
    )
    rows = rows.withColumn("aesthetic", scoring.normalise_aesthetic(F.col("raw")))
    final = scoring.weighted_score(F.col("kind"), F.col("aesthetic"), F.col("technical"), F.col("suitability"), S.scores)
    return rows.withColumn("final", final).withColumn("tier", scoring.tier(F.col("raw")))


@query(f"WITH {SIGNALS} SELECT doc_id, round(aesthetic, 6) AS aesthetic, round(final, 6) AS final_score FROM f")
def source_weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("doc_id", F.round("aesthetic", 6).alias("aesthetic"), F.round("final", 6).alias("final_score"))


@query(f"WITH {SIGNALS} SELECT tier, count(*) AS n, round(avg(final), 6) AS mean_score FROM f GROUP BY tier")
def quality_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("n"), F.round(F.avg("final"), 6).alias("mean_score"))


@query(f"""WITH {SIGNALS}, g AS (SELECT doc_id, kind, CASE WHEN doc_id % 3 <> 0 THEN aesthetic END AS a, CASE WHEN doc_id % 3 <> 0 THEN raw END AS r, CASE WHEN doc_id % 5 <> 0 THEN technical END AS t, CASE WHEN doc_id % 5 <> 0 THEN suitability END AS u, doc_id % 11 = 0 AS failed FROM q),
    w AS (SELECT *, coalesce(a, 0.61) AS a1, coalesce(r, 5.5) AS r1, coalesce(t, 0.5) AS t1, coalesce(u, 0.5) AS u1, a IS NULL AND t IS NULL AND u IS NULL AS none FROM g)
    SELECT doc_id, round(CASE WHEN failed THEN coalesce(a, 0.0) WHEN none THEN 0.61 WHEN kind = 'Reddit' THEN a1 * 0.60 + t1 * 0.15 + u1 * 0.25 WHEN kind = 'other' THEN a1 * 0.55 + t1 * 0.15 + u1 * 0.30 ELSE a1 * 0.40 + t1 * 0.10 + u1 * 0.50 END::DOUBLE, 6) AS final,
        CASE WHEN none THEN 'standard' WHEN r1 >= 6.5 THEN 'premium' WHEN r1 >= 5.5 THEN 'standard' WHEN r1 >= 4.0 THEN 'acceptable' ELSE 'low' END AS tier,
        round(CASE WHEN failed OR none THEN 0.0 ELSE 1.0 - sqrt((pow(a1 - (a1 + t1 + u1) / 3, 2) + pow(t1 - (a1 + t1 + u1) / 3, 2) + pow(u1 - (a1 + t1 + u1) / 3, 2)) / 3) END::DOUBLE, 6) AS confidence FROM w""")
def score_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores where models are missing or failed."""
    k = F.col("doc_id")
    s = signals(spark, sf_dir)
    some = lambda c, n: F.when(k % n != 0, F.col(c))
    out = scoring.with_fallbacks(some("aesthetic", 3), some("raw", 3), some("technical", 5), some("suitability", 5), F.col("kind"), S.scores, k % 11 == 0)
    return s.select("doc_id", out.alias("o")).select("doc_id", F.round("o.final", 6).alias("final"), "o.tier", F.round("o.confidence", 6).alias("confidence"))


@query(f"""WITH {SIGNALS}, m AS (SELECT *, (aesthetic + technical + suitability) / 3 AS mean FROM f)
    SELECT doc_id, round(1.0 - sqrt(((aesthetic - mean) ** 2 + (technical - mean) ** 2 + (suitability - mean) ** 2) / 3), 6) AS confidence FROM m""")
def score_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("doc_id", F.round(scoring.confidence([F.col("aesthetic"), F.col("technical"), F.col("suitability")]), 6).alias("confidence"))


@query(f"""WITH {SIGNALS}, t AS (SELECT max(raw) AS top FROM f), p AS (SELECT CASE WHEN top <= 1 THEN 1.0 ELSE 10.0 END AS scale, CASE WHEN top <= 1 THEN (5.5 - 1) / 9 ELSE 5.5 END AS threshold FROM t)
    SELECT count(*) AS n, max(scale)::DOUBLE AS scale, max(threshold)::DOUBLE AS threshold, count(*) FILTER (raw IS NULL) AS n_missing, count(*) FILTER (raw < 1 OR raw > scale) AS n_out_of_range,
        count(*) FILTER (raw < threshold) AS n_below, round(avg(raw), 6) AS mean FROM f, p""")
def score_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.detected_threshold(signals(spark, sf_dir), "raw", S.scores.quality_threshold).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {SIGNALS}, a AS (SELECT *, raw >= 5.5 AS ok, raw < 4 AS tracked FROM f)
    SELECT count(*) AS total, count(*) FILTER (ok) AS approved, count(*) FILTER (tracked) AS tracked, round(avg(final) FILTER (ok), 4) AS avg_score, round(min(final) FILTER (ok), 4) AS min_score, round(max(final) FILTER (ok), 4) AS max_score,
        greatest(count(*) - count(*) FILTER (ok), 0) AS rejected, greatest(greatest(count(*) - count(*) FILTER (ok), 0) - count(*) FILTER (tracked), 0) AS unaccounted,
        round(count(*) FILTER (ok) * 100.0::DOUBLE / count(*), 2) AS approval_pct FROM a""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_report(signals(spark, sf_dir), F.col("raw") >= 5.5, F.col("raw") < 4, F.col("final"))


@query("""SELECT CASE WHEN source LIKE 'src1%' THEN 'src1' ELSE source END AS source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1""")
def source_totals_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("source", F.when(F.startswith("source", F.lit("src1")), F.concat(F.lit("src1_"), "source")).otherwise(F.col("source")))
    return docs.groupBy(reports.collapse_source(F.col("source"), "src1").alias("source")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""WITH c AS (SELECT source, count(*) AS candidates FROM documents WHERE doc_id % 7 <> 0 OR source <> 'src3' GROUP BY source),
    a AS (SELECT source, count(*) AS approved FROM documents JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY source),
    b AS (SELECT coalesce(c.source, a.source) AS source, coalesce(candidates, 0) AS candidates, coalesce(approved, 0) AS approved FROM c FULL JOIN a ON c.source = a.source)
    SELECT source, candidates, approved, round(coalesce(approved * 100.0::DOUBLE / nullif(candidates, 0), 0), 4) AS rate,
        CASE WHEN approved * 100.0::DOUBLE / nullif(candidates, 0) >= 30 THEN 'high' WHEN approved * 100.0::DOUBLE / nullif(candidates, 0) >= 10 THEN 'good' WHEN approved * 100.0::DOUBLE / nullif(candidates, 0) >= 5 THEN 'low' ELSE 'poor' END AS band FROM b""")
def source_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    counts = reports.source_counts(docs.where("doc_id % 7 <> 0 or source <> 'src3'"), docs.join(labels, "doc_id"), "source")
    rate = F.coalesce(F.try_divide(F.col("approved") * 100.0, F.col("candidates").cast("double")), F.lit(0.0))
    return counts.select("source", "candidates", "approved", F.round(rate, 4).alias("rate"), reports.performance_band(rate).alias("band"))


@query(f"""WITH {CANDIDATES}, p AS (SELECT doc_id, source, text, n_chars FROM r WHERE reason IS NULL),
    k AS (SELECT p.* FROM p JOIN (SELECT text, min(doc_id) AS doc_id FROM p GROUP BY text) USING (doc_id)),
    s AS (SELECT k.doc_id, k.source, 1 + (k.n_chars % 1000) / 100.0::DOUBLE AS raw, 1.0::DOUBLE - coalesce(l.toxic, 0) * 0.5::DOUBLE AS technical, coalesce(l.quality, 0)::DOUBLE AS suitability FROM k LEFT JOIN labels l USING (doc_id)),
    q AS (SELECT *, (greatest(1.0, least(10.0, raw)) - 1.0) / 9.0 AS aesthetic FROM s)
    SELECT source, CASE WHEN raw >= 6.5 THEN 'premium' WHEN raw >= 5.5 THEN 'standard' WHEN raw >= 4.0 THEN 'acceptable' ELSE 'low' END AS tier, count(*) AS n, count(*) FILTER (raw >= 5.5) AS approved,
        round(avg(aesthetic * 0.55 + technical * 0.15 + suitability * 0.30), 6) AS mean_score FROM q GROUP BY 1, 2""")
def flagship_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, dedup, score, tier and count: the whole curation run."""
    passed = cascade(table(spark, sf_dir, "documents")).where("passed").select("doc_id", "source", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    kept = dedup.first_seen(passed, F.col("sha256"), ["doc_id"])
    rows = kept.join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("raw", 1 + (F.col("n_chars") % 1000) / 100.0)
    final = scoring.weighted_score(F.col("source"), scoring.normalise_aesthetic(F.col("raw")), F.lit(1.0) - F.coalesce("toxic", F.lit(0)) * 0.5, F.coalesce("quality", F.lit(0)).cast("double"), S.scores)
    return rows.groupBy("source", scoring.tier(F.col("raw")).alias("tier")).agg(F.count("*").alias("n"), F.count_if(F.col("raw") >= S.scores.quality_threshold).alias("approved"), F.round(F.avg(final), 6).alias("mean_score"))
