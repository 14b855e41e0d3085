"""Run history, checks, sources, manifests and streaming over the remaining tables.

Events stand for runs: a type is a source, six hours are a run, and a value over 100 is approved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import text
from gleanery.operators import checks, reports, scoring, vectors, windows
from gleanery.plans.registry import query, table
from gleanery.sources import html, manifest, records

RUNS = """runs AS (SELECT event_type, date_trunc('day', ts) + to_hours((hour(ts) // 6)::INTEGER * 6) AS run, count(*) AS candidates, count(*) FILTER (value > 100) AS approved FROM events GROUP BY 1, 2)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.date_trunc("day", "ts") + F.make_dt_interval(hours=(F.floor(F.hour("ts") / 6) * 6).cast("int"))
    return table(spark, sf_dir, "events").groupBy("event_type", start.alias("run")).agg(F.count("*").alias("candidates"), F.count_if(F.col("value") > 100).alias("approved"))


ROLLING = RUNS + """, w AS (SELECT *, round(approved::DOUBLE / candidates, 4) AS rate,
    round(sum(approved) OVER (PARTITION BY event_type ORDER BY run ROWS 29 PRECEDING)::DOUBLE / sum(candidates) OVER (PARTITION BY event_type ORDER BY run ROWS 29 PRECEDING), 4) AS rolling_rate,
    sum(candidates) OVER (PARTITION BY event_type ORDER BY run)::BIGINT AS total_candidates, sum(approved) OVER (PARTITION BY event_type ORDER BY run)::BIGINT AS total_approved FROM runs)"""


@query(f"WITH {ROLLING} SELECT event_type, strftime(run, '%Y-%m-%d %H') AS run, candidates, approved, rate, rolling_rate, total_candidates, total_approved FROM w")
def rolling_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.rolling_acceptance(runs(spark, sf_dir), "event_type", "run").withColumn("run", F.date_format("run", "yyyy-MM-dd HH"))


BANDS = "CASE WHEN {0} >= 0.30 THEN 'increase' WHEN {0} >= 0.10 THEN 'maintain' WHEN {0} >= 0.05 THEN 'reduce' ELSE 'consider_removing' END"


@query(f"WITH {ROLLING}, l AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY run DESC) AS k FROM w) SELECT event_type, rolling_rate, {BANDS.format('rolling_rate')} AS recommendation, {BANDS.format('rate')} AS last_run FROM l WHERE k = 1")
def allocation_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = windows.latest(windows.rolling_acceptance(runs(spark, sf_dir), "event_type", "run"), "event_type", "run")
    return last.select("event_type", "rolling_rate", windows.recommendation(F.col("rolling_rate")).alias("recommendation"), windows.recommendation(F.col("rate")).alias("last_run"))


@query("""WITH b AS (SELECT unnest(range(0, 10))::INTEGER AS bin), v AS (SELECT least(floor((value / 50 - 1) / 0.9), 9)::INTEGER AS bin, count(*) AS n FROM events WHERE value / 50 BETWEEN 1 AND 10 GROUP BY 1)
    SELECT bin, printf('%.2f-%.2f', 1 + bin * 0.9::DOUBLE, 1 + (bin + 1) * 0.9::DOUBLE) AS label, coalesce(n, 0) AS n FROM b LEFT JOIN v USING (bin)""")
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(table(spark, sf_dir, "events"), F.col("value") / 50, 1.0, 10.0, 10)


@query("SELECT count(*) AS n, strftime(min(o_orderdate), '%Y-%m-%d') AS oldest, strftime(max(o_orderdate), '%Y-%m-%d') AS newest, date_diff('day', min(o_orderdate), max(o_orderdate)) AS span_days, round(count(*)::DOUBLE / greatest(date_diff('day', min(o_orderdate), max(o_orderdate)), 1), 4) AS per_day FROM orders")
def collection_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.collection_statistics(table(spark, sf_dir, "orders"), F.col("o_orderdate"))


@query("SELECT p_size || 'x' || length(p_brand) AS resolution, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, resolution LIMIT 10")
def top_resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent: a top-k report."""
    r = F.concat(F.col("p_size").cast("string"), F.lit("x"), F.length("p_brand").cast("string"))
    return table(spark, sf_dir, "part").groupBy(r.alias("resolution")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "resolution").limit(10)


@query("""WITH d AS (SELECT d.*, l.quality, l.toxic, CASE WHEN d.doc_id % 5 = 0 THEN '' ELSE d.lang END AS lang2, CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.source END AS url FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'id' AS field, count(*) FILTER (doc_id IS NULL) AS n_missing FROM d UNION ALL SELECT 'lang', count(*) FILTER (nullif(lang2, '') IS NULL) FROM d
    UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM d UNION ALL SELECT 'url', count(*) FILTER (coalesce(url, nullif(lang2, '')) IS NULL) FROM d""")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases: a url may also stand in lang."""
    d = table(spark, sf_dir, "documents").drop("text").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    d = d.withColumn("lang2", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("lang"))).withColumn("url", F.when(F.col("doc_id") % 3 != 0, F.col("source")))
    return checks.missing_fields(d, {"id": [F.col("doc_id")], "lang": [F.col("lang2")], "quality": [F.col("quality")], "url": [F.col("url"), F.col("lang2")]})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


SAMPLE = "s AS (SELECT page_id, url FROM pages ORDER BY md5(url), url LIMIT 50)"


@query(f"WITH {SAMPLE} SELECT count(*) AS n, count(*) FILTER (page_id % 11 = 0) AS failures, round(count(*) FILTER (page_id % 11 = 0) * 1.0::DOUBLE / count(*), 4) AS failure_rate, count(*) FILTER (page_id % 11 = 0) * 1.0::DOUBLE / count(*) < 0.10 AS passed FROM s")
def sampled_link_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure rate of a fixed sample of links: the sample is the feature."""
    s = checks.sampled(table(spark, sf_dir, "pages").select("page_id", "url"), "url", 50)
    counts = s.agg(F.count("*").alias("n"), F.count_if(F.col("page_id") % 11 == 0).alias("failures"))
    rate = F.coalesce(F.try_divide(F.col("failures").cast("double"), F.col("n").cast("double")), F.lit(0.0))
    return counts.select("n", "failures", F.round(rate, 4).alias("failure_rate"), (rate < 0.10).alias("passed"))


LANGS = ("en", "de", "fr", "es")

CHECKS = f"""e AS (SELECT 'required_fields' AS check_name, doc_id::VARCHAR AS id, doc_id AS k FROM documents WHERE nullif(text, '') IS NULL OR nullif(source, '') IS NULL
    UNION ALL SELECT 'embedding_dimensions', vec_id::VARCHAR, vec_id FROM embeddings WHERE len(embedding) <> 64 OR vec_id % 50 = 7
    UNION ALL SELECT 'duplicate_ids', l_orderkey::VARCHAR, l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'hash_collisions', min(doc_id)::VARCHAR, min(doc_id) FROM documents GROUP BY text HAVING count(*) > 1
    UNION ALL SELECT 'score_range', event_id::VARCHAR, event_id FROM events WHERE value < 0 OR value > 300
    UNION ALL SELECT 'categories', doc_id::VARCHAR, doc_id FROM documents WHERE lang IS NULL OR lang NOT IN {LANGS[:3]}
    UNION ALL SELECT 'links', page_id::VARCHAR, page_id FROM (SELECT * FROM pages ORDER BY md5(url), url LIMIT 50) WHERE page_id % 11 = 0),
    n AS (SELECT unnest(['required_fields', 'embedding_dimensions', 'duplicate_ids', 'hash_collisions', 'score_range', 'categories', 'links']) AS check_name),
    f AS (SELECT check_name, list_sort(list(id)) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY k) AS r FROM e) WHERE r <= 20 GROUP BY check_name),
    c AS (SELECT check_name, count(e.id) AS n_errors, coalesce('["' || array_to_string(any_value(f.ids), '","') || '"]', '[]') AS detail FROM n LEFT JOIN e USING (check_name) LEFT JOIN f USING (check_name) GROUP BY check_name)"""


def _checks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    empty = F.nullif("text", F.lit("")).isNull() | F.nullif("source", F.lit("")).isNull()
    twins = docs.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1")
    links = checks.sampled(table(spark, sf_dir, "pages").select("page_id", "url"), "url", 50)
    return {
        "required_fields": checks.first_errors(docs.where(empty), "doc_id"), "embedding_dimensions": checks.first_errors(table(spark, sf_dir, "embeddings").where((F.size("embedding") != 64) | (F.col("vec_id") % 50 == 7)), "vec_id"),
        "duplicate_ids": checks.first_errors(checks.duplicate_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"), "l_orderkey"), "hash_collisions": checks.first_errors(twins, "doc_id"),
        "score_range": checks.first_errors(table(spark, sf_dir, "events").where((F.col("value") < 0) | (F.col("value") > 300)), "event_id"),
        "categories": checks.first_errors(docs.where(~F.coalesce(F.col("lang").isin(*LANGS[:3]), F.lit(False))), "doc_id"), "links": checks.first_errors(links.where("page_id % 11 = 0"), "page_id"),
    }


@query(f"WITH {CHECKS} SELECT check_name, n_errors = 0 AS passed, n_errors::BIGINT AS n_errors, detail, bool_and(n_errors = 0) OVER () AS all_passed FROM c")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven checks, with the first 20 ids of each that fail."""
    return checks.validation(_checks(spark, sf_dir))


QUICK = ("required_fields", "duplicate_ids", "score_range", "categories")


@query(f"WITH {CHECKS} SELECT check_name, n_errors = 0 AS passed, n_errors::BIGINT AS n_errors, detail, bool_and(n_errors = 0) OVER () AS all_passed FROM c WHERE check_name IN {QUICK}")
def quick_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _checks(spark, sf_dir)
    return checks.validation(every, frozenset(every) - set(QUICK), quick=True)


@query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link, generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) - 1 AS position FROM pages)
    SELECT page_id, link, min(position)::INTEGER AS position FROM l GROUP BY page_id, link""")
def html_link_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links(table(spark, sf_dir, "pages"), r'href="([^"]+)"').select("page_id", "link", "position")


SLUG = r"""p AS (SELECT page_id, url, list_extract(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/'), -1) AS name FROM pages),
    s AS (SELECT *, string_split(regexp_replace(name, '\.[^.]*$', ''), '-') AS parts FROM p)"""


@query(rf"""WITH {SLUG} SELECT page_id, coalesce(nullif(regexp_extract(name, '^(\d+)', 1), ''), substr(md5(name), 1, 8)) AS slug_id, list_filter(parts, lambda x: regexp_matches(x, '^\d{{3,5}}x\d{{3,5}}$'))[1] AS resolution,
    array_to_string(list_filter(parts[2:], lambda x: NOT regexp_matches(x, '^\d{{3,5}}x\d{{3,5}}$') AND NOT list_contains(['4k', 'hd', 'desktop', 'wallpaper', 'background', 'photo', 'image'], lower(x))), ' ') AS words,
    coalesce(nullif(array_to_string(list_transform(regexp_extract_all(lower(words), '(\p{{L}}+|\P{{L}}+)'), lambda x: upper(x[1:1]) || x[2:]), ''), ''), 'None') AS title FROM s""")
def slug_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = html.file_name(F.col("url"))
    words = F.filter(F.slice(text.slug_parts(name), 2, 1 << 20), lambda p: ~p.rlike(r"^\d{3,5}x\d{3,5}$") & ~F.lower(p).isin(*text.SLUG_STOP_WORDS))
    return table(spark, sf_dir, "pages").select("page_id", text.slug_id(name).alias("slug_id"), text.slug_resolution(name).alias("resolution"), F.array_join(words, " ").alias("words"), text.slug_title(name, F.lit("None")).alias("title"))


EXT = r"lower(regexp_replace(regexp_replace({0}, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''))"
TAILED = "url || CASE page_id % 6 WHEN 0 THEN '.JPG' WHEN 1 THEN '/x.png?s=1' WHEN 2 THEN '.webp' WHEN 3 THEN '.gif' ELSE '' END"


@query(f"""WITH x AS (SELECT page_id, {EXT.format('(' + TAILED + ')')} AS p, CASE page_id % 5 WHEN 0 THEN 'image/png; q=1' WHEN 1 THEN 'text/html' END AS kind FROM pages),
    y AS (SELECT page_id, CASE WHEN p LIKE '%.jpg' THEN '.jpg' WHEN p LIKE '%.jpeg' THEN '.jpeg' WHEN p LIKE '%.png' THEN '.png' WHEN p LIKE '%.webp' THEN '.webp' WHEN p LIKE '%.gif' THEN '.gif' WHEN kind LIKE 'image/png%' THEN '.png' ELSE '.jpg' END AS extension FROM x)
    SELECT page_id, extension, extension <> '.gif' AS supported FROM y""")
def extension_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    tail = F.when(k % 6 == 0, ".JPG").when(k % 6 == 1, "/x.png?s=1").when(k % 6 == 2, ".webp").when(k % 6 == 3, ".gif").otherwise("")
    kind = F.when(k % 5 == 0, "image/png; q=1").when(k % 5 == 1, "text/html")
    url = F.concat("url", tail)
    return table(spark, sf_dir, "pages").select("page_id", text.extension(url, kind).alias("extension"), text.is_supported(url, kind).alias("supported"))


@query("""WITH l AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]+)"', 1) AS links FROM pages), u AS (SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS position FROM l)
    SELECT page_id, position::INTEGER AS position, replace(replace(replace(replace(link, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS href, false AS skipped FROM u""")
def html_dom_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors outside of ad containers: the ancestor rule needs a parser."""
    return html.dom_links(table(spark, sf_dir, "pages"), "ad")


@query("""SELECT 'documents_' || doc_id AS id, 'documents' AS source, 'doc:' || doc_id AS url, lang AS title FROM documents UNION ALL SELECT 'pages_' || page_id, 'pages', url, NULL FROM pages
    UNION ALL SELECT 'conversations_' || conv_id || '-' || turn, 'conversations', 'conv:' || conv_id, role FROM conversations""")
def union_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, p, c = (table(spark, sf_dir, t) for t in ("documents", "pages", "conversations"))
    none = F.lit(None).cast("string")
    a = records.candidates(d, "documents", F.col("doc_id"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), F.col("lang"), none, {"source": F.col("source")})
    b = records.candidates(p, "pages", F.col("page_id"), F.col("url"), none, none, {})
    e = records.candidates(c, "conversations", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")), F.concat(F.lit("conv:"), F.col("conv_id").cast("string")), F.col("role"), none, {"turn": F.col("turn")})
    return a.unionByName(b).unionByName(e).select("id", "source", "url", "title")


@query("""WITH r AS (SELECT p_partkey, p_brand, p_size AS width, (p_partkey % 40)::BIGINT AS height, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size >= p_partkey % 40 AND p_size > 0 AND p_partkey % 40 > 0 THEN 0 ELSE 1 END, p_size * (p_partkey % 40) DESC, p_partkey) AS position FROM part)
    SELECT p_partkey, p_brand, position::INTEGER AS position FROM r WHERE position <= 5""")
def landscape_topk_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").alias("width"), (F.col("p_partkey") % 40).alias("height"))
    return windows.capped(part, "p_brand", windows.landscape_first(F.col("width"), F.col("height"), "p_partkey"), F.lit(5)).select("p_partkey", "p_brand", "position")


KEYS = {"legal": ("license",), "french": ("quele",), "spanish": ("ción",), "german": ("ung",)} | text.KEYWORDS
SUBS = text.SUB_SOURCES | {"src11": ("nature", ("landscape", "photography"))}


def _keyword_sql(part: int) -> str:
    found = [(f"lower(source) LIKE '%{name}%'", (category, ",".join(more))) for name, (category, more) in SUBS.items()]
    found += [(f"lower(text) LIKE '%{word}%'", (category, word)) for category, words in KEYS.items() for word in words]
    return "CASE " + " ".join(f"WHEN {test} THEN '{values[part]}'" for test, values in found) + f" ELSE '{('general', '')[part]}' END"


@query(f"SELECT doc_id, {_keyword_sql(0)} AS category, {_keyword_sql(1)} AS subcategories FROM documents")
def keyword_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = text.keyword_category(F.col("text"), F.col("source"), KEYS, SUBS)
    return table(spark, sf_dir, "documents").select("doc_id", c.alias("c")).select("doc_id", "c.category", F.array_join("c.subcategories", ",").alias("subcategories"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    raw = 1 + (F.col("n_chars") % 1000) / 100.0
    k = F.col("doc_id")
    entry = manifest.compact_entry(
        k, F.concat(F.lit("doc "), k.cast("string")), F.col("lang"), F.col("source"), F.lit(1704067200) + k, F.col("n_chars"), F.lit(100), F.col("n_chars") * 3, scoring.normalise_aesthetic(raw), scoring.tier(raw), raw,
        url=F.when(F.col("quality") == 1, F.concat(F.lit("https://m.example.org/"), k.cast("string"))), artist=F.when(k % 2 == 0, F.lit("Unknown")).otherwise(F.col("source")), artist_url=F.when(k % 3 == 0, F.lit("https://a.example.org")),
        colours=F.array(F.lit("#102030"), F.col("lang")), hue=k % 360, brightness=k % 256, contrast=k / 7, dark=k % 2 == 0, composition=F.lit("centered"), symmetry=k % 100 / 99, depth=F.lit(0.25), complexity=F.lit("low"),
        focal_point=F.when(k % 5 != 0, F.array(k % 10 / 10, F.lit(0.5))), moods=F.array(F.lit("calm")), styles=F.array().cast("array<string>"), subcategories=F.when(k % 4 == 0, F.array(F.lit("sub"))), model_category=F.when(k % 3 == 0, F.lit("en")), model_confidence=k % 100 / 99,
        vectors={"mn4": vectors.pack_base64(F.array(*[((k + j) % 256 - 128).cast("tinyint") for j in range(3)]))},
        sub_source=F.when(k % 6 == 0, F.col("source")), upvotes=k % 2, diversity=k % 3 / 7,
    )
    return d.select("doc_id", entry.alias("entry"))


@query("""WITH d AS (SELECT d.*, quality, d.doc_id AS k, (greatest(1.0, least(10.0, 1 + (n_chars % 1000) / 100.0::DOUBLE)) - 1.0) / 9.0 AS qs0, 1 + (n_chars % 1000) / 100.0::DOUBLE AS raw FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT k::VARCHAR AS id, 'doc ' || k AS t, lang AS cat, source AS src, 1704067200 + k AS ts, round(n_chars / 100.0::DOUBLE, 2) AS ar, n_chars * 3 AS sz, round(qs0::DOUBLE, 3) AS qs, round(raw::DOUBLE, 1) AS aes,
    CASE WHEN raw >= 6.5 THEN 'premium' WHEN raw >= 5.5 THEN 'standard' WHEN raw >= 4.0 THEN 'acceptable' ELSE 'low' END AS qt, 2 AS v, '#102030,' || lang AS col, (k % 360)::INTEGER AS hue, (k % 256)::INTEGER AS bri, round(k / 7.0::DOUBLE, 1) AS ctr, k % 2 = 0 AS dark,
    round(k % 100 / 99.0::DOUBLE, 2) AS symmetry, CASE WHEN k % 5 <> 0 THEN k % 10 / 10.0::DOUBLE ELSE 0.5 END AS focal_x,
    to_base64(unhex(printf('%02x%02x%02x', ((k % 256) + 128) % 256, ((k + 1) % 256 + 128) % 256, ((k + 2) % 256 + 128) % 256))) AS mn4,
    CASE WHEN k % 4 = 0 THEN 'sub' END AS sub, CASE WHEN k % 3 = 0 AND lang <> 'en' THEN 'en' END AS mlc, CASE WHEN k % 3 = 0 AND lang <> 'en' THEN round(k % 100 / 99.0::DOUBLE, 2) END AS mlcf,
    CASE WHEN k % 6 = 0 THEN source END AS sr, CASE WHEN k % 2 <> 0 THEN 1 END::BIGINT AS up, k % 6 = 0 OR k % 2 <> 0 AS has_origin,
    CASE WHEN quality = 1 THEN 'https://m.example.org/' || k END AS url, CASE WHEN k % 2 <> 0 THEN source END AS art, CASE WHEN k % 2 <> 0 AND k % 3 = 0 THEN 'https://a.example.org' END AS artu, CASE WHEN k % 3 > 0 THEN round(k % 3 / 7.0::DOUBLE, 2) END AS cdiv FROM d""")
def manifest_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = [f"entry.{c}" for c in ("id", "t", "cat", "src", "ts", "ar", "sz", "qs", "aes", "qt", "v", "hue", "bri", "ctr", "dark", "mlc", "mlcf", "url", "art", "artu", "cdiv")]
    return _entries(spark, sf_dir).select(
        *plain, F.array_join("entry.col", ",").alias("col"), F.col("entry.comp.s").alias("symmetry"), F.col("entry.comp.fp")[0].alias("focal_x"), "entry.emb.mn4", F.col("entry.sub")[0].alias("sub"), "entry.srcm.sr", "entry.srcm.up", F.col("entry.srcm").isNotNull().alias("has_origin"),
    )


@query("SELECT doc_id::VARCHAR AS id, true AS same FROM documents")
def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries written as compressed JSON and read again, held against what was written."""
    from gleanery.sources.scratch import scratch_path

    entries, path = _entries(spark, sf_dir), scratch_path(spark, "manifest")
    manifest.write_entries(entries, "entry", path)
    back = manifest.read_entries(spark, path, "id string, t string, cat string, src string, ts bigint, dim array<bigint>, qs double, qt string, url string")
    same = entries.select("entry.*").select("id", F.col("t").alias("t0"), F.col("qs").alias("qs0"), F.col("dim").alias("dim0"), F.col("url").alias("url0"))
    joined = back.join(same, "id")
    return joined.select("id", ((F.col("t") == F.col("t0")) & (F.col("qs") == F.col("qs0")) & (F.col("dim") == F.col("dim0")) & F.col("url").eqNullSafe(F.col("url0"))).alias("same"))


NAMES = "n AS (SELECT strftime(ts, '%Y_%m_%d') AS base, CASE WHEN event_id % 7 = 0 THEN '.json.gz' WHEN event_id % 7 < 6 THEN '-' || (event_id % 9 + 2) || '.json.gz' ELSE '-x.json.gz' END AS rest FROM events)"


@query(rf"""WITH {NAMES}, r AS (SELECT base, max(CASE WHEN rest = '.json.gz' THEN 1 ELSE try_cast(nullif(regexp_extract(rest, '^-(\d+)\.json\.gz$', 1), '') AS INTEGER) END) AS runs FROM n GROUP BY base)
    SELECT base, CASE WHEN coalesce(runs, 0) = 0 THEN base || '.json.gz' ELSE base || '-' || (runs + 1) || '.json.gz' END AS next_name FROM r""")
def next_run_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of existing manifests are derived from the events."""
    k = F.col("event_id")
    rest = F.when(k % 7 == 0, ".json.gz").when(k % 7 < 6, F.concat(F.lit("-"), (k % 9 + 2).cast("string"), F.lit(".json.gz"))).otherwise("-x.json.gz")
    names = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy_MM_dd").alias("day"), rest.alias("rest"))
    names = names.select("day", F.concat("day", "rest").alias("name"))
    return windows.next_run(names, "name", F.col("day"))


@query("WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events) SELECT event_id, event_type FROM r WHERE age > 30")
def delta_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.struct("ts", "event_id").alias("made"))
    return windows.expired(events, "event_type", "made", 30).select("event_id", "event_type")


@query("""WITH a AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus <> 'P' AS ok, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS k FROM orders),
    b AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS batch FROM a WHERE k = 1)
    SELECT o_custkey, batch::BIGINT AS batch, count(*) AS n, count(*) FILTER (ok) AS succeeded, round(sum(o_totalprice), 2) AS total FROM b GROUP BY o_custkey, batch""")
def upload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last attempt of each upload, in batches of five for each customer."""
    orders = table(spark, sf_dir, "orders").withColumn("ok", F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey", "o_totalprice", "ok", "o_orderdate")
    last = windows.latest(orders, "o_orderkey", "o_orderdate")
    return windows.batches(last, ["o_orderkey"], 5, "o_custkey").groupBy("o_custkey", "batch").agg(F.count("*").alias("n"), F.count_if("ok").alias("succeeded"), F.round(F.sum("o_totalprice"), 2).alias("total"))


STAGE_TIMES = "SELECT l_returnflag || l_linestatus AS stage, avg(l_quantity) AS ms FROM lineitem WHERE l_linenumber {} GROUP BY 1"


@query(f"""WITH n AS ({STAGE_TIMES.format('>= 4')}), b AS ({STAGE_TIMES.format('< 4')}) SELECT n.stage, round(n.ms, 6) AS current, round(b.ms * CASE WHEN n.stage LIKE 'R%' THEN 0.7 ELSE 1 END, 6) AS baseline,
    round((n.ms - b.ms * CASE WHEN n.stage LIKE 'R%' THEN 0.7 ELSE 1 END) / (b.ms * CASE WHEN n.stage LIKE 'R%' THEN 0.7 ELSE 1 END) * 100, 4) AS change_pct, (n.ms - b.ms * CASE WHEN n.stage LIKE 'R%' THEN 0.7 ELSE 1 END) / (b.ms * CASE WHEN n.stage LIKE 'R%' THEN 0.7 ELSE 1 END) > 0.20 AS regression FROM n JOIN b USING (stage)""")
def benchmark_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.concat("l_returnflag", "l_linestatus")
    items = table(spark, sf_dir, "lineitem").groupBy(stage.alias("stage")).agg(F.avg(F.when(F.col("l_linenumber") >= 4, F.col("l_quantity"))).alias("now"), F.avg(F.when(F.col("l_linenumber") < 4, F.col("l_quantity"))).alias("then"))
    now = items.where("now is not null").select("stage", F.col("now").alias("ms"))
    baseline = items.where("then is not null").select("stage", (F.col("then") * F.when(F.col("stage").startswith("R"), 0.7).otherwise(1.0)).alias("ms"))
    return reports.regressions(now, baseline, "stage", "ms").withColumn("current", F.round("current", 6)).withColumn("baseline", F.round("baseline", 6))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/') || lower(o_orderstatus) || '/wp_' || o_orderkey || '.jpg' AS path, 'https://media.example.org/' || strftime(o_orderdate, '%Y/%m/') || lower(o_orderstatus) || '/wp_' || o_orderkey || '.jpg' AS url,
    lower(o_orderstatus) || '_' || epoch(o_orderdate)::BIGINT || '_' || (('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 9000 + 1000) AS output_id,
    CASE WHEN o_custkey + 0.013 < 60 THEN printf('%.1fs', o_custkey + 0.013::DOUBLE) WHEN o_custkey + 0.013 < 3600 THEN printf('%.1fm', (o_custkey + 0.013::DOUBLE) / 60.0::DOUBLE) ELSE printf('%.1fh', (o_custkey + 0.013::DOUBLE) / 3600.0::DOUBLE) END AS took FROM orders""")
def object_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, key = F.lower("o_orderstatus"), F.col("o_orderkey").cast("string")
    path = text.object_path(F.col("o_orderdate"), kind, key, F.lit(".jpg"))
    return table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"), text.public_url(path, "media.example.org", "").alias("url"), text.output_id(kind, F.col("o_orderdate"), F.col("o_orderkey")).alias("output_id"), text.duration(F.col("o_custkey") + F.lit(0.013)).alias("took"))


@query("SELECT event_type, json_extract_string(props, '$.k')::INTEGER AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text")
def incremental_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in four batches in the order of their ids; each keeps what is new."""
    from gleanery.sources.scratch import scratch_path
    from gleanery.streaming.incremental import dedup_stream

    base = scratch_path(spark, "stream")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    bounds = rows.approxQuantile("doc_id", [0.25, 0.5, 0.75], 0.0)
    edges = [None, *bounds, None]
    for k in range(4):
        part = rows
        if edges[k] is not None:
            part = part.where(F.col("doc_id") > edges[k])
        if edges[k + 1] is not None:
            part = part.where(F.col("doc_id") <= edges[k + 1])
        part.write.parquet(f"{base}/in/arrived={k}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        dedup_stream(spark, stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).option("basePath", f"{base}/out").parquet(f"{base}/out").select("doc_id", "digest")
