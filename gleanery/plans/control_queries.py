"""Fetch caps, run control, older scores and small counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import image
from gleanery.operators import control, dedup, reports, windows
from gleanery.plans.registry import query, table

NOW = "2024-01-31 00:00:00"


@query("""WITH u AS (SELECT doc_id, source, n_chars FROM documents d WHERE n_chars >= 500 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS position FROM u) SELECT doc_id, source, position::INTEGER AS position FROM r WHERE position <= 7""")
def fetch_until_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing: a least score, no seen ids, and at most so many of each source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").where("n_chars >= 500")
    fresh = dedup.unseen(docs, table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")
    return windows.capped(fresh, "source", [F.desc("n_chars"), F.col("doc_id")], F.lit(7)).select("doc_id", "source", "position")


@query("""SELECT page_id, url FROM pages p WHERE page_id NOT IN (SELECT item_id FROM benchmark WHERE item_id % 2 = 0) AND url NOT IN (SELECT url FROM pages WHERE page_id % 5 = 0)""")
def unseen_by_id_and_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ids = table(spark, sf_dir, "benchmark").where("item_id % 2 = 0").select(F.col("item_id").alias("page_id"))
    return dedup.unseen(dedup.unseen(pages, ids, "page_id"), pages.where("page_id % 5 = 0"), "url").select("page_id", "url")


@query("""SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS k FROM documents) WHERE k = 1""")
def keep_first_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.concat_ws("/", "source", "lang").alias("k"))
    return dedup.first_seen(docs, F.col("k"), ["doc_id"]).select("doc_id", "source", "lang")


@query("""SELECT count(*) AS candidates, count(*) FILTER (n_chars >= 300) AS after_size, count(*) FILTER (n_chars >= 300 AND lang = 'en') AS after_lang, count(*) FILTER (n_chars < 300) AS rejected_size, count(*) FILTER (n_chars >= 300 AND lang <> 'en') AS rejected_lang FROM documents""")
def funnel_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    big, english = F.col("n_chars") >= 300, F.col("lang") == "en"
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("candidates"), F.count_if(big).alias("after_size"), F.count_if(big & english).alias("after_lang"), F.count_if(~big).alias("rejected_size"), F.count_if(big & ~english).alias("rejected_lang"))


@query("SELECT coalesce(nullif(CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END, ''), 'unknown') AS category, count(*) AS n FROM documents GROUP BY 1")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.col("lang")).alias("lang"))
    return reports.distribution(docs, F.col("lang")).select("category", "n")


@query("SELECT source, count(*) AS fetched FROM documents GROUP BY source")
def fetched_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("fetched"))


@query(f"SELECT event_type, count(*) FILTER (ts > TIMESTAMP '{NOW}' - INTERVAL 24 HOURS) AS recent, count(*) FILTER (NOT ts > TIMESTAMP '{NOW}' - INTERVAL 24 HOURS) AS stale FROM events GROUP BY event_type")
def state_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    young = control.is_recent(F.col("ts"), F.lit(NOW).cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(young).alias("recent"), F.count_if(~young).alias("stale"))


@query("SELECT event_id FROM events WHERE event_id % 13 <> 0 AND ts::DATE < DATE '2024-02-14' - 30")
def log_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_id") % 13 == 0, "run_latest.log").otherwise(F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd"), F.lit(".log")))
    return control.expired_logs(table(spark, sf_dir, "events").select("event_id", name.alias("name")), "name", F.lit("2024-02-14").cast("date")).select("event_id")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, o_custkey % 5 AS retry_count FROM orders) q WHERE retry_count < 3 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 2)""")
def upload_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("retry_count"))
    stored = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").select(F.col("l_orderkey").alias("o_orderkey"))
    return control.to_upload(queue, stored, "o_orderkey").select("o_orderkey")


@query("""SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus <> 'P') AS succeeded, count(*) - count(*) FILTER (o_orderstatus <> 'P') AS failed, round(sum(o_totalprice) FILTER (o_orderstatus <> 'P'), 2) AS bytes FROM orders GROUP BY 1""")
def upload_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("o_orderstatus") != "P"
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("total"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.round(F.sum(F.when(ok, F.col("o_totalprice"))), 2).alias("bytes"))


@query("""WITH e AS (SELECT 's' || user_id % 4 AS source, CASE WHEN event_type = 'error' AND value > 200 THEN 'fatal' WHEN event_type = 'error' THEN 'recoverable' ELSE 'warning' END AS category FROM events WHERE event_type IN ('error', 'signup'))
    SELECT count(DISTINCT source) FILTER (category = 'fatal') AS failed_sources, count(*) FILTER (category = 'fatal') AS n_fatal, count(*) FILTER (category = 'recoverable') AS n_recoverable, count(*) FILTER (category = 'warning') AS n_warning, count(DISTINCT source) FILTER (category = 'fatal') < 3 AS go_on FROM e""")
def degradation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.col("event_type") == "error"
    kind = F.when(error & (F.col("value") > 200), "fatal").when(error, "recoverable").otherwise("warning")
    errors = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "signup")).select(F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("source"), kind.alias("category"))
    return control.degradation(errors)


@query("""WITH h AS (SELECT vec_id, list_transform(range(5), lambda k: (degrees(atan2(embedding[2 * k + 2]::DOUBLE, embedding[2 * k + 1]::DOUBLE)) + 360) % 360) AS hues FROM embeddings),
    d AS (SELECT vec_id, least(abs(hues[i] - hues[j]), 360 - abs(hues[i] - hues[j])) AS apart FROM h, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(1, 6)) AS j) WHERE i < j)
    SELECT vec_id, round(least(sum(CASE WHEN apart > 150 AND apart < 210 THEN 1.0 WHEN apart < 45 THEN 0.5 ELSE 0 END)::DOUBLE / 5, 1.0), 6) AS harmony FROM d GROUP BY vec_id""")
def colour_harmony(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    hues = F.array(*[F.pmod(F.degrees(F.atan2(v[2 * k + 1].cast("double"), v[2 * k].cast("double"))) + 360, F.lit(360.0)) for k in range(5)])
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(image.harmony(hues), 6).alias("harmony"))


@query("""WITH c AS (SELECT vec_id, 128 + embedding[1]::DOUBLE * 200 AS r, 128 + embedding[2]::DOUBLE * 200 AS g, 128 + embedding[3]::DOUBLE * 200 AS b FROM embeddings), m AS (SELECT *, (r + g + b) / 3 AS mean FROM c)
    SELECT vec_id, round(1 - greatest(0.0, least(1.0, greatest(abs(r - mean), abs(g - mean), abs(b - mean)) / 50)), 6) AS cast_score,
        round((1 - greatest(0.0, least(1.0, greatest(abs(r - mean), abs(g - mean), abs(b - mean)) / 50))) * 0.4 + abs(r - g) / 400 * 0.3 + abs(g - b) / 400 * 0.2 + mean / 255 * 0.1, 6) AS composite FROM m""")
def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "embeddings").select("vec_id", *[(128 + F.col("embedding")[k].cast("double") * 200).alias(n) for k, n in enumerate("rgb")])
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    cast = image.colour_cast(r, g, b)
    return c.select("vec_id", F.round(cast, 6).alias("cast_score"), F.round(image.composite(cast, F.abs(r - g) / 400, F.abs(g - b) / 400, (r + g + b) / 3 / 255), 6).alias("composite"))


@query("""SELECT user_id, CASE WHEN avg(value) / 500 < 0.2 THEN 'minimal' ELSE 'more' END AS kind, round(greatest(0.0, least(1.0, CASE WHEN avg(value) / 100 BETWEEN 0.4 AND 0.7 THEN 1.0 WHEN avg(value) / 100 < 0.4 THEN avg(value) / 100 / 0.4 ELSE (1 - avg(value) / 100) / 0.3 END)), 6) AS brightness_fit,
    round(greatest(0.0, least(1.0, CASE WHEN stddev_pop(value) < 20 THEN stddev_pop(value) / 20 * 0.5 WHEN stddev_pop(value) < 40 THEN 0.5 + (stddev_pop(value) - 20) / 40 WHEN stddev_pop(value) <= 80 THEN 1.0 ELSE 1.0 - (stddev_pop(value) - 80) / 100 END)), 6) AS contrast_fit,
    round(greatest(0.0, least(1.0, (stddev_pop(value) - 20) / 50)), 6) AS interest FROM events GROUP BY user_id""")
def brightness_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
    return s.select("user_id", F.when(F.col("mean") / 500 < 0.2, "minimal").otherwise("more").alias("kind"), F.round(image.brightness_score(F.col("mean") / 100), 6).alias("brightness_fit"), F.round(image.contrast_score(F.col("deviation")), 6).alias("contrast_fit"), F.round(image.visual_interest(F.col("deviation")), 6).alias("interest"))


@query("""WITH a AS (SELECT strftime(ts, '%Y_%m_%d') || '.json.gz' AS name FROM events WHERE user_id % 2 = 0), b AS (SELECT strftime(ts, '%Y_%m_%d') || '-2.json.gz' AS name FROM events WHERE user_id % 3 = 0) SELECT name FROM a UNION SELECT name FROM b""")
def existing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy_MM_dd")
    local = events.where("user_id % 2 = 0").select(F.concat(day, F.lit(".json.gz")).alias("name"))
    remote = events.where("user_id % 3 = 0").select(F.concat(day, F.lit("-2.json.gz")).alias("name"))
    return local.unionByName(remote).distinct()


@query("""WITH t AS (SELECT 'line' || l_linenumber AS stage, sum(l_quantity) AS ms FROM lineitem GROUP BY 1)
    SELECT stage, round(ms, 4) AS ms, round(ms * 100.0::DOUBLE / sum(ms) OVER (), 2) AS share_pct, row_number() OVER (ORDER BY ms DESC, stage DESC) = 1 AS is_bottleneck FROM t""")
def stage_bottleneck(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("stage")).agg(F.sum("l_quantity").alias("ms"))
    return reports.stage_totals(times, "stage", "ms")


@query("""SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'https://m.example.org/' || doc_id END, '') AS url FROM documents LEFT JOIN labels USING (doc_id)""")
def url_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.sources.store import attach_urls

    labels = table(spark, sf_dir, "labels")
    results = labels.select(F.col("doc_id").cast("string").alias("id"), (F.col("quality") == 1).alias("success"), F.concat(F.lit("https://m.example.org/"), F.col("doc_id").cast("string")).alias("url"), F.lit(1).alias("attempts"))
    return attach_urls(table(spark, sf_dir, "documents").select("doc_id"), results, "doc_id").select("doc_id", "url")


@query("""SELECT vec_id, m AS model FROM embeddings, (SELECT unnest(['base', 'text', 'self']) AS m) WHERE NOT (m = 'base' AND vec_id % 2 = 0) AND NOT (m = 'text' AND vec_id % 3 = 0)""")
def extraction_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, model) pairs that a resumed extraction still has to run."""
    from gleanery.operators.models import to_do

    items = table(spark, sf_dir, "embeddings")
    vector = F.col("embedding").alias("vector")
    done = items.where("vec_id % 2 = 0").select("vec_id", F.lit("base").alias("model"), vector).unionByName(items.where("vec_id % 3 = 0").select("vec_id", F.lit("text").alias("model"), vector))
    return to_do(items, done, "vec_id", ["base", "text", "self"])
